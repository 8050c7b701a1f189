"""Readers and writers: catalogues, inventories, match files, manifests, job listings, keys and metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import scalars as S

#: Fixed order of the columns of a multi-exposure match file.
MATCH_COLUMNS = ("xbar", "ybar", "mbar", "xsig", "ysig", "msig", "qbar", "nf", "ng", "nm")


def read_catalogue(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One catalogue; only the columns asked for are read."""
    df = spark.read.parquet(path)
    return df.select(*[c for c in columns if c in df.columns]) if columns else df


def probe(spark: SparkSession, path: str) -> dict[str, str]:
    """Column names and types from the footer alone."""
    return dict(spark.read.parquet(path).dtypes)


def bands_of(columns: Sequence[str], prefix: str = "mag_vega_") -> list[str]:
    return sorted(c[len(prefix) :] for c in columns if c.lower().startswith(prefix))


def long_catalogue(wide: DataFrame, id_: str, bands: Sequence[str]) -> DataFrame:
    """A merged catalogue with columns per band as rows (source, band, ra, dec, mag, ...); absent columns are null."""
    kinds = {"ra": "ra_{}", "dec": "dec_{}", "mag": "mag_vega_{}", "flux": "flux_{}", "flux_err": "flux_err_{}", "sep": "sep_{}", "nmatch": "nmatch_{}"}
    have = set(wide.columns)
    rows = [F.struct(F.lit(b).alias("band"), *[(F.col(p.format(b)).cast("double") if p.format(b) in have else F.lit(None).cast("double")).alias(k) for k, p in kinds.items()]) for b in bands]
    return wide.select(F.col(id_).alias("source_id"), F.explode(F.array(*rows)).alias("r")).select("source_id", "r.*")


def inventory(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """Files below a folder with time and size, contents not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(folder)
    return files.select("path", F.col("modificationTime").alias("mtime"), F.col("length").alias("size"))


def file_hashes(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(folder)
    return files.select("path", F.sha2("content", 256).alias("sha"))


def match_rows(lines: DataFrame, line: str = "value", columns: Sequence[str] = MATCH_COLUMNS) -> DataFrame:
    """Rows of a whitespace-separated match file; comments begin with #, short lines are dropped."""
    parts = F.split(F.trim(F.col(line)), r"\s+")
    x = lines.where(~F.trim(F.col(line)).startswith("#")).withColumn("_p", parts).where(F.size("_p") >= len(columns))
    keep = [c for c in lines.columns if c != line]
    return x.select(*keep, *[F.col("_p")[i].try_cast("double").alias(c) for i, c in enumerate(columns)])


#: Files up to this size have their footers read by tasks, which takes the whole file through them; larger ones are few.
SMALL_FILE = 64 << 20


def footers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, columns) of Parquet files, columns null for those that cannot be read. Small files are looked at in tasks."""
    import pyarrow as pa

    def run(batches):
        import pyarrow.parquet as pq

        for batch in batches:
            found = []
            for content in batch.column(1):
                try:
                    found.append(pq.read_schema(pa.BufferReader(content.as_buffer())).names)
                except (pa.ArrowInvalid, OSError):
                    found.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string()))], names=["path", "columns"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    large = [r.path for r in files.where(F.col("length") > SMALL_FILE).select("path").collect()]
    small = files.where(F.col("length") <= SMALL_FILE).select("path", "content").mapInArrow(run, "path string, columns array<string>")
    rows = []
    for p in large:
        try:
            rows.append((p, spark.read.parquet(p).columns))
        except Exception as e:  # noqa: BLE001  an unreadable file is no reason to stop
            if "PARQUET" not in str(e).upper() and "SCHEMA" not in str(e).upper():
                raise
            rows.append((p, None))
    return small.unionByName(spark.createDataFrame(rows, small.schema)) if rows else small


def pooled(spark: SparkSession, paths: Sequence[str], needed: Sequence[str]) -> DataFrame:
    """Per-exposure files under one another with the file of each row; unreadable files and those without the needed columns are skipped.

    Files of one set of columns are one scan; ``skipped`` tells which are left out and why.
    """
    good = footers(spark, paths).where(F.col("columns").isNotNull()).groupBy(F.array_sort("columns").alias("columns")).agg(F.array_sort(F.collect_list("path")).alias("paths"))
    out: DataFrame | None = None
    for r in good.orderBy(F.col("paths")[0]).collect():  # one row a set of columns, with the paths that a scan must be told
        if not set(needed) <= set(r.columns):
            continue
        df = spark.read.option("ignoreCorruptFiles", True).parquet(*r.paths).withColumn("file", F.col("_metadata.file_path"))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise ValueError("no file has the columns " + ", ".join(needed))
    return out


def skipped(spark: SparkSession, paths: Sequence[str], needed: Sequence[str]) -> DataFrame:
    """(path, reason) of the files that ``pooled`` leaves out."""
    lack = F.array_except(F.array(*[F.lit(c) for c in needed]), F.col("columns"))
    reason = F.when(F.col("columns").isNull(), "unreadable").when(F.size(lack) > 0, F.concat(F.lit("lacks "), F.array_join(lack, ", ")))
    return footers(spark, paths).select("path", reason.alias("reason")).where("reason is not null")


def latest_keys(rows: DataFrame, key: str, when: str) -> DataFrame:
    """An append-only key table read back: the last row of each key."""
    return rows.groupBy(key).agg(F.max_by(F.struct(*[c for c in rows.columns if c != key]), when).alias("_r")).select(key, "_r.*")


def write_pointings(pointings: DataFrame, path: str) -> None:
    """Tab-separated pointings; raises if there are none."""
    if pointings.limit(1).count() == 0:
        raise ValueError("no pointings")
    pointings.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


def events_json(events: DataFrame) -> DataFrame:
    return events.select(F.to_json(F.struct(*events.columns)).alias("json"))


def manifest_urls(manifest: DataFrame) -> DataFrame:
    """(category, url) of a manifest's files that have an address."""
    f = manifest.select(F.explode("files").alias("f")).select("f.category", "f.url")
    return f.where(F.col("url").isNotNull() & (F.trim("url") != ""))


def write_manifest(manifest: DataFrame, path: str) -> None:
    """One folder of address lists a category, a line an address."""
    manifest_urls(manifest).repartition("category").write.mode("overwrite").partitionBy("category").text(path)


def specs(spark: SparkSession, path: str, schema: StructType, required: Sequence[str], lines: bool = False) -> tuple[DataFrame, DataFrame]:
    """Specifications that have all required keys, and those that do not with what they miss. A file is one, or with
    ``lines`` each of its lines."""
    df = spark.read.schema(schema).json(path, multiLine=not lines)
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), c) for c in required]))
    x = df.withColumn("missing", missing)
    return x.where(F.size("missing") == 0).drop("missing"), x.where(F.size("missing") > 0)


def header_store(headers: DataFrame, keywords: Sequence[str], order: str) -> DataFrame:
    """Header cards (obsid, keyword, value) as one row an observation; blank ones are absent and the last write wins."""
    x = headers.where(F.col("keyword").isin(*keywords) & (F.trim("value") != ""))
    last = x.groupBy("obsid", "keyword").agg(F.max_by("value", order).alias("value"))
    return last.groupBy("obsid").pivot("keyword", list(keywords)).agg(F.first("value"))


#: The dashes between a title's name and its observation, and the instruments in brackets after it.
DASHES, INSTRUMENTS = ("\u2014", "-"), ("NIRCam", "MIRI")


def titles(lines: DataFrame, line: str) -> tuple[DataFrame, DataFrame]:
    """Title lines 'name - jw<program>-o<obs> (instrument)', and lines that carry an observation but do not parse; other
    lines are in neither. A line is taken word by word: a dash, the observation and the bracket must follow a name."""
    text = F.trim(F.col(line))
    words = F.split(text, r"\s+")
    word = lambda i: F.get(words, i)
    token = lambda w: F.split(F.lower(w), "-")
    program = lambda w: F.when(F.get(token(w), F.lit(0)).startswith("jw"), F.substring(F.get(token(w), F.lit(0)), 3, 40))
    number = lambda w: F.when(F.get(token(w), F.lit(1)).startswith("o"), F.substring(F.get(token(w), F.lit(1)), 2, 40))
    observed = lambda w: (F.size(token(w)) == 2) & S.all_digits(program(w)) & S.all_digits(number(w)) & (F.length(number(w)) == 3)
    bracket = lambda w: F.coalesce(*[F.when(F.lower(w).startswith(f"({i.lower()})"), F.substring(w, 2, len(i))) for i in INSTRUMENTS])
    fits = lambda i: word(i).isin(*DASHES) & observed(word(i + 1)) & bracket(word(i + 2)).isNotNull()
    at = F.get(F.filter(F.sequence(F.lit(0), F.size(words)), lambda i: (i > 0) & F.coalesce(fits(i), F.lit(False))), F.lit(0))
    x = lines.withColumn("_at", at)
    seen = F.col("_at")
    # The name is what stands before the observation, less the dash, with the spaces it has.
    before = F.rtrim(F.substring(text, F.lit(1), F.instr(text, word(seen + 1)) - 1))
    name = F.rtrim(F.substring(before, F.lit(1), F.length(before) - 1))
    parsed = x.where(seen.isNotNull()).select(
        *lines.columns, program(word(seen + 1)).cast("int").alias("program"), number(word(seen + 1)).alias("obs"), bracket(word(seen + 2)).alias("instrument"), name.alias("name")
    )
    part = F.split(F.lower(text), "jw")
    digits = lambda p, i, n: S.all_digits(F.substring(p, i, n)) & (F.length(F.substring(p, i, n)) == n)
    alike = F.exists(F.slice(part, 2, F.size(part)), lambda p: digits(p, 1, 5) & (F.substring(p, 6, 2) == "-o") & digits(p, 8, 3))
    return parsed, x.where(seen.isNull() & alike).drop("_at")


def job_listing(lines: DataFrame, line: str, prefix: str, arity: int = 5) -> DataFrame:
    """Jobs of a |-delimited listing whose name begins with ``prefix``; lines of another arity are dropped."""
    x = lines.withColumn("_p", F.split(line, r"\|")).where(F.size("_p") == arity)
    names = ("id", "name", "state", "elapsed", "node")
    return x.select(*[c for c in lines.columns if c != line], *[F.trim(F.col("_p")[i]).alias(n) for i, n in enumerate(names)]).where(F.col("name").startswith(prefix))


def provenance(df: DataFrame, role: str | Column) -> DataFrame:
    """Files that a scan really reads, with their role."""
    return df.select((F.lit(role) if isinstance(role, str) else role).alias("role"), F.col("_metadata.file_path").alias("path")).distinct()


def write_stage(metrics: DataFrame, path: str) -> None:
    """Metrics of some (obsid, stage) in place of what was there; other partitions stay, so one failure keeps the rest."""
    metrics.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("obsid", "stage").parquet(path)

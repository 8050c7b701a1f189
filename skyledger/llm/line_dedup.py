r"""Line dedup over levelled sorted runs of line digests.

A line's key is the line without ASCII white space at its ends, A-Z in lower case. ``LineRuns`` keeps what is known of all
keys seen so far as *runs*: tables (digest, n_docs, has_null, last_doc) in buckets by digest, each bucket sorted, each key in
one of the runs. A batch of documents is dealt to the same buckets and merged with each run bucket by bucket, so a run
is read in place and never shuffled again; keys of the batch that no run has are its own run, one more of level 0, what it
adds to keys of runs is kept beside as increments. When a level holds ``fanout`` runs they are compacted into one run
of the next level, so a batch meets O(log batches) runs. ``frequent`` goes over the keys of the runs, adds their increments
and gives those found in many documents.

Digests are MD5 values of the key (128 bits), so unequal keys do not meet in practice.
"""

from __future__ import annotations

import hashlib
import uuid
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, new_folder, stage, text_or_empty

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACES = " \t\n\x0b\f\r"


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACES)), UPPER, LOWER)


def digest(line: Column, min_chars: int) -> Column:
    """MD5 of the line's key, null if the key is shorter than min_chars code points."""
    bare = F.btrim(line, F.lit(SPACES))
    return F.when(F.char_length(bare) >= min_chars, F.unhex(F.md5(line_key(line))))


def salt() -> Column:
    """0 for a document with an id; all rows without one are one document, which their texts spread over tasks."""
    return F.when(F.col("doc_id").isNull(), F.xxhash64(text_or_empty())).otherwise(F.lit(0)).cast("long")


def digests(docs: DataFrame, batches: int, min_chars: int) -> DataFrame:
    """(doc_id, salt, batch, digest), one row for each key of a document. A document with an id lies in one batch."""
    keys = F.array_distinct(F.filter(F.transform(lines_of(text_or_empty()), lambda x: digest(x, min_chars)), lambda x: x.isNotNull()))
    rows = docs.select("doc_id", salt().alias("salt"), F.explode(keys).alias("digest"))
    batch = F.pmod(F.xxhash64("doc_id", "salt"), F.lit(batches)).cast("int")
    return rows.distinct().select("doc_id", "salt", batch.alias("batch"), "digest")  # rows that repeat a doc_id are one document


class LineRuns:
    """Levelled sorted runs, bucketed tables of disjoint keys, and increments to their keys. ``close`` forgets the tables."""

    def __init__(self, spark: SparkSession, fanout: int = 2, buckets: int | None = None):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.increments: list[DataFrame] = []
        self.names: list[str] = []

    @property
    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def known(self) -> DataFrame:
        """All runs one under the other; no key is there twice."""
        return reduce(DataFrame.unionByName, self.runs)

    def _write(self, run: DataFrame) -> str:
        """A run in the shared folder, one sorted file a bucket; the catalog knows how it lies until close()."""
        name = f"line_run_{uuid.uuid4().hex}"
        writer = run.repartition(self.buckets, "digest").write.bucketBy(self.buckets, "digest").sortBy("digest")
        writer.option("path", new_folder(self.spark, "run")).format("parquet").saveAsTable(name)
        self.names.append(name)
        return name

    def close(self) -> None:
        for name in self.names:
            self.spark.sql(f"drop table if exists {name}")
        self.names, self.levels = [], []

    def add(self, batch: DataFrame) -> DataFrame:
        """Add a batch of rows (digest, doc_id), distinct but for null ids. Returns its run: the keys that no run had before."""
        # A null doc_id is one document, whatever the number of rows that have it.
        own = batch.groupBy("digest").agg(F.count("doc_id").alias("n_docs"), F.max(F.col("doc_id").isNull()).alias("has_null"), F.max("doc_id").alias("last_doc"))
        known = F.lit(False)
        for i, run in enumerate(self.runs):
            own = own.join(run.select("digest", F.lit(True).alias(f"_in{i}")), "digest", "left")
            known = known | F.coalesce(F.col(f"_in{i}"), F.lit(False))
        own = stage(own.select("digest", "n_docs", "has_null", "last_doc", known.alias("known")), "batch")
        if self.levels:
            self.increments.append(own.where("known").drop("known"))
        name = self._write(own.where("not known").drop("known"))
        run = self.spark.table(name)
        self._place(name, 0)
        return run

    def _place(self, run: str, level: int) -> None:
        if len(self.levels) == level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            runs, self.levels[level] = self.levels[level], []
            self._place(self._write(reduce(DataFrame.unionByName, [self.spark.table(r) for r in runs])), level + 1)

    def frequent(self, min_docs: int) -> DataFrame:
        """(digest, n_docs, last_doc) of keys found in min_docs documents or more: one row a key of the runs."""
        more = reduce(DataFrame.unionByName, self.increments) if self.increments else self.runs[0].limit(0)
        more = more.groupBy("digest").agg(F.sum("n_docs").alias("n_more"), F.max("has_null").alias("null_more"), F.max("last_doc").alias("last_more"))
        n = F.col("n_docs") + F.coalesce("n_more", F.lit(0)) + (F.col("has_null") | F.coalesce("null_more", F.lit(False))).cast("int")
        found = [r.join(more, "digest", "left").select("digest", n.alias("n_docs"), F.greatest("last_doc", "last_more").alias("last_doc")) for r in self.runs]
        return reduce(DataFrame.unionByName, found).where(F.col("n_docs") >= min_docs)


#: A key is very common if it makes one in so many of all (key, document) rows; so there are at most so many of them.
VERY_COMMON = 20_000


def lost_lines(all_digests: DataFrame, often: DataFrame) -> DataFrame:
    """(doc_id, salt, digest) of frequent keys outside their last document.

    Rows of a very common key would meet in one task of a join by key. Such keys are few by definition, whatever the
    table's size, so they are broadcast and never shuffled; all other keys are joined by key.
    """
    limit = all_digests.count() // VERY_COMMON
    common = F.broadcast(often.where(F.col("n_docs") > limit).select("digest", F.struct("last_doc").alias("_common")))
    tagged = all_digests.join(common, "digest", "left")
    rest = tagged.where("_common is null").join(often.where(F.col("n_docs") <= limit).select("digest", "last_doc"), "digest").select("doc_id", "salt", "digest", "last_doc")
    met = tagged.where("_common is not null").select("doc_id", "salt", "digest", F.col("_common.last_doc").alias("last_doc"))
    return met.unionByName(rest).where(~F.col("doc_id").eqNullSafe(F.col("last_doc"))).select("doc_id", "salt", "digest")


_LOWER = str.maketrans(UPPER, LOWER)


def kept_lines(text: str, gone: list[bytes], min_chars: int) -> str | None:
    """The text without the lines whose key's digest is in gone, in time linear in both; None if nothing is left."""
    lost = set(gone)

    def stays(line: str) -> bool:
        bare = line.strip(SPACES)
        return len(bare) < min_chars or hashlib.md5(bare.translate(_LOWER).encode()).digest() not in lost

    kept = [line for line in text.split("\n") if stays(line)]
    return "\n".join(kept) if kept else None


def without_lines(min_chars: int):
    @F.pandas_udf("string")
    def run(text: pd.Series, gone: pd.Series) -> pd.Series:
        return pd.Series([None if g is None else kept_lines(t, g, min_chars) for t, g in zip(text, gone)], dtype=object)

    return run


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int = 4, fanout: int = 2) -> DataFrame:
    r"""docs with ``kept_text``, ``n_lines`` and ``n_dropped`` added.

    A key of at least ``min_chars`` code points found in at least ``min_docs`` documents loses all its lines
    except in the document with the largest doc_id that holds it. Lines are split at \n only; a null or empty
    text is one empty line and its kept text is empty. Rows that repeat a doc_id count as one document. Rows with a null
    doc_id are one document that comes before all others. A very long text is one row like any other; each of its lines is
    looked up once. An empty table gives an empty result. Columns of docs other than doc_id and text pass through, whatever
    their names; those named like an added column are replaced.
    """
    all_digests = stage(digests(docs, batches, min_chars), "digests", partition_by="batch")
    runs = LineRuns(docs.sparkSession, fanout)
    try:
        for b in range(batches):
            runs.add(all_digests.where(F.col("batch") == b).select("digest", "doc_id"))
        often = stage(runs.frequent(min_docs), "frequent")
    finally:
        runs.close()
    doc, row, gone, left, own = (fresh(n) for n in ("doc", "salt", "lost", "stays", "own"))
    lost = lost_lines(all_digests.select("digest", "doc_id", "salt"), often).groupBy(F.col("doc_id").alias(doc), F.col("salt").alias(row)).agg(F.collect_list("digest").alias(gone))
    added = ["kept_text", "n_lines", "n_dropped"]
    read = docs.select(*[c for c in docs.columns if c not in added], salt().alias(own))
    out = read.join(lost, F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(own) == F.col(row)), "left")
    lines = lambda text: (F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"))) + 1).cast("long")
    out = out.withColumn("n_lines", lines(text_or_empty()))
    # Only texts that lose lines are handed to Python.
    hit = F.col(gone).isNotNull()
    out = out.withColumn(left, without_lines(min_chars)(F.when(hit, text_or_empty()), F.col(gone)))
    out = out.withColumn("kept_text", F.when(hit, F.coalesce(left, F.lit(""))).otherwise(text_or_empty()))
    left_lines = F.when(F.col(left).isNull(), F.lit(0)).otherwise(lines(F.col(left)))
    return out.withColumn("n_dropped", F.when(hit, F.col("n_lines") - left_lines).otherwise(0).cast("long")).drop(doc, row, own, gone, left)


ORACLE = r"""
WITH line AS (
  SELECT doc_id, i, x, translate(regexp_replace(x, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS xs FROM documents), unnest(xs) WITH ORDINALITY AS u(x, i)
), often AS (
  SELECT key, max(doc_id) AS last_doc FROM line WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT doc_id, i, x, o.key IS NOT NULL AND doc_id <> last_doc AS lost FROM line LEFT JOIN often o USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
       sha256(coalesce(string_agg(x, chr(10) ORDER BY i) FILTER (NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

"""Queries on readers and writers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..sources import io
from ..sources.staging import new_folder
from .registry import query, table
from .standins import POLL_0, POLL_1, STARS


@query("read_columns", "SELECT o_orderkey, o_totalprice FROM orders")
def read_columns(spark, d):
    return io.read_catalogue(spark, f"{d}/orders.parquet", ["o_orderkey", "o_totalprice", "no_such_column"])


@query("long_catalogue", "SELECT o_orderkey AS source_id, 'f212n' AS band, o_totalprice AS flux, NULL::DOUBLE AS mag FROM orders UNION ALL SELECT o_orderkey, 'f444w', o_totalprice / 2, o_custkey FROM orders")
def long_catalogue(spark, d):
    w = table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").alias("flux_f212n"), (F.col("o_totalprice") / 2).alias("flux_f444w"), F.col("o_custkey").alias("mag_vega_f444w"))
    return io.long_catalogue(w, "o_orderkey", ["f212n", "f444w"]).select("source_id", "band", "flux", "mag")


@query("match_file", "SELECT o_orderkey AS k, (o_orderkey % 100)::DOUBLE AS xbar, -5.5::DOUBLE AS mbar, 9.0::DOUBLE AS nm FROM orders WHERE o_orderkey % 7 > 1")
def match_file(spark, d):
    k = F.col("o_orderkey")
    line = F.when(k % 7 == 0, "# comment 1 2 3 4 5 6 7 8 9 10").when(k % 7 == 1, "1 2 3").otherwise(F.concat(F.lit("  "), (k % 100).cast("string"), F.lit("  2\t-5.5 .1 .2 .3 .4  3 4 9")))
    lines = table(spark, d, "orders").select(k.alias("k"), line.alias("value"))
    return io.match_rows(lines).select("k", "xbar", "mbar", "nm")


def many_files(spark, d):
    """Sixteen small files of orders, one that lacks a column and one that is no Parquet file."""
    root = new_folder(spark, "pool")
    table(spark, d, "orders").withColumn("part", F.col("o_orderkey") % 16).repartition(4, "part").write.partitionBy("part").parquet(f"{root}/good")
    table(spark, d, "nation").coalesce(1).write.parquet(f"{root}/poor")
    table(spark, d, "region").select("r_name").coalesce(1).write.text(f"{root}/odd")
    return [f"{root}/good", f"{root}/poor", f"{root}/odd"]


@query("pooled_rows", "SELECT count(*) AS n, count(DISTINCT o_orderkey % 16) AS files, sum(o_orderkey)::BIGINT AS keys FROM orders")
def pooled_rows(spark, d):
    p = io.pooled(spark, many_files(spark, d), ["o_orderkey"])
    return p.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("file").alias("files"), F.sum("o_orderkey").cast("long").alias("keys"))


@query("skipped_files", "SELECT 'lacks o_orderkey' AS reason, (SELECT count(*) FROM nation WHERE n_nationkey = 0) AS files UNION ALL SELECT 'unreadable', (SELECT count(*) FROM region WHERE r_regionkey = 0)")
def skipped_files(spark, d):
    x = io.skipped(spark, many_files(spark, d), ["o_orderkey"]).where(~F.col("path").rlike("/_|[.]crc$"))
    return x.groupBy("reason").agg(F.count(F.lit(1)).alias("files"))


@query("file_hashes", "SELECT n_name AS nation, sha256(string_agg(c_name || chr(10), '' ORDER BY c_custkey)) AS sha FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def file_hashes(spark, d):
    """A text file of customers for each nation."""
    root = new_folder(spark, "hashed")
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    c.repartition("n_name").sortWithinPartitions("n_name", "c_custkey").select("c_name", "n_name").write.partitionBy("n_name").text(root)
    return io.file_hashes(spark, root, "part-*").select(F.url_decode(F.regexp_extract("path", "n_name=([^/]*)/", 1)).alias("nation"), "sha")


@query("spec_files", "SELECT o_orderkey AS key, CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'target' ELSE 'field,target' END AS missing FROM orders")
def spec_files(spark, d):
    """Specifications as JSON, read back; two thirds lack one or two required keys."""
    root, k = new_folder(spark, "specs"), F.col("o_orderkey")
    x = table(spark, d, "orders").select(k.alias("key"), F.when(k % 3 < 2, F.col("o_orderpriority")).alias("field"), F.when(k % 3 == 0, F.col("o_orderstatus")).alias("target"))
    x.write.option("ignoreNullFields", True).json(root)
    schema = spark.createDataFrame([], "key long, field string, target string").schema
    good, bad = io.specs(spark, root, schema, ["field", "target"], lines=True)
    return good.select("key", F.lit("").alias("missing")).unionByName(bad.select("key", F.array_join("missing", ",").alias("missing")))


@query("manifest_files", "SELECT o_orderstatus AS category, count(*) AS n, count(DISTINCT o_orderkey) AS urls FROM orders WHERE o_orderkey % 4 >= 2 GROUP BY ALL")
def manifest_files(spark, d):
    """The lists of addresses that a manifest is written to, one folder a category."""
    k, root = F.col("o_orderkey"), new_folder(spark, "manifest")
    url = F.when(k % 4 == 0, F.lit(None)).when(k % 4 == 1, " ").otherwise(F.concat(F.lit("https://host/"), k.cast("string")))
    m = table(spark, d, "orders").groupBy("o_custkey").agg(F.collect_list(F.struct(F.col("o_orderstatus").alias("category"), url.alias("url"))).alias("files"))
    io.write_manifest(m, root)
    return spark.read.text(root).groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("value").alias("urls"))


@query(
    "state_versions",
    f"SELECT v, program, count(*) AS n FROM (SELECT 1 AS v, program FROM ({POLL_0.sql}) UNION ALL SELECT 2, program FROM ({POLL_1.sql})) GROUP BY ALL",
)
def state_versions(spark, d):
    """The state as each of two commits has it; keys are appended and read across both."""
    from ..streaming import polls

    parts = [p.df(spark, d).select("program", "obs_id") for p in (POLL_0, POLL_1)]
    state = polls.VersionedState(spark, new_folder(spark, "versions"), parts[0].schema, {"keys": polls.KEYS})
    for v, rows in enumerate(parts, 1):
        state.commit(rows, v, appended={"keys": rows.select(F.lit("seen").alias("kind"), F.col("obs_id").alias("key"), F.lit(v).cast("long").alias("batch"))})
    both = [state.load(at_most=v).groupBy("program").agg(F.count(F.lit(1)).alias("n")) for v in (1, 2)]
    keys = state.load("keys").groupBy("batch").agg(F.count(F.lit(1)).alias("kept"))
    x = both[0].withColumn("v", F.lit(1)).unionByName(both[1].withColumn("v", F.lit(2)))
    return x.join(keys.where("kept > 0"), F.col("v") == F.col("batch")).select("v", "program", "n")


@query("observation_urls", f"SELECT k, 'https://www.stsci.edu/jwst/phase2-public/' || program || '.pdf' AS program_url, right(replace('{S.SEARCH_URL}', '%d', program::VARCHAR), 40) AS search_end FROM ({POLL_1.sql})")
def observation_urls(spark, d):
    return POLL_1.df(spark, d).select("k", S.program_url(F.col("program")).alias("program_url"), F.right(S.search_url(F.col("program")), F.lit(40)).alias("search_end"))


@query("latest_keys", "SELECT o_custkey AS key, max(o_orderkey) AS at, max_by(o_orderstatus, o_orderkey) AS status FROM orders GROUP BY o_custkey")
def latest_keys(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("key"), F.col("o_orderkey").alias("at"), F.col("o_orderstatus").alias("status"))
    return io.latest_keys(o, "key", "at")


@query("events_json", f"SELECT '{{\"k\":' || k || ',\"program\":' || program || ',\"obs_id\":\"' || obs_id || '\"}}' AS json FROM ({POLL_1.sql})")
def events_json(spark, d):
    return io.events_json(POLL_1.df(spark, d).select("k", "program", "obs_id"))


@query("manifest_urls", "SELECT o_orderstatus AS category, 'https://host/' || o_orderkey AS url FROM orders WHERE o_orderkey % 4 >= 2")
def manifest_urls(spark, d):
    k = F.col("o_orderkey")
    url = F.when(k % 4 == 0, F.lit(None)).when(k % 4 == 1, " ").otherwise(F.concat(F.lit("https://host/"), k.cast("string")))
    m = table(spark, d, "orders").groupBy("o_custkey").agg(F.collect_list(F.struct(F.col("o_orderstatus").alias("category"), url.alias("url"))).alias("files"))
    return io.manifest_urls(m)


@query("header_store", "SELECT o_custkey AS obsid, max_by('v' || o_orderkey, o_orderkey) FILTER (o_orderkey % 3 = 0) AS \"TARGNAME\", max_by('v' || o_orderkey, o_orderkey) FILTER (o_orderkey % 3 = 1) AS \"FILTER\" FROM orders WHERE o_orderkey % 5 > 0 AND o_orderkey % 3 < 2 GROUP BY o_custkey")
def header_store(spark, d):
    k = F.col("o_orderkey")
    h = table(spark, d, "orders").select(F.col("o_custkey").alias("obsid"), F.when(k % 3 == 0, "TARGNAME").when(k % 3 == 1, "FILTER").otherwise("OTHER").alias("keyword"), F.when(k % 5 == 0, " ").otherwise(F.concat(F.lit("v"), k.cast("string"))).alias("value"), k.alias("at"))
    return io.header_store(h, ["TARGNAME", "FILTER"], "at")


def title_lines(spark, d):
    """Program numbers have five digits at least in titles; lines that do not parse count as alike with exactly five."""
    k, program = F.col("o_orderkey"), F.col("o_custkey")
    obs = lambda p: F.concat(F.lit("jw"), F.format_string("%05d", p), F.lit("-o"), F.format_string("%03d", k % 1000))
    good = F.concat("o_orderpriority", F.when(k % 2 == 0, " \u2014 ").otherwise(" - "), obs(program), F.when(k % 5 == 0, " (MIRI) old").otherwise(" (NIRCam)"))
    line = F.when(k % 3 == 0, good).when(k % 3 == 1, F.concat(F.lit(" renamed: "), obs(program % 100_000), F.lit(" (NIRCam)"))).otherwise("jw1 other text")
    return table(spark, d, "orders").select(k.alias("k"), line.alias("line"))


@query("title_lines", "SELECT o_orderkey AS k, o_custkey::INT AS program, lpad((o_orderkey % 1000)::VARCHAR, 3, '0') AS obs, CASE WHEN o_orderkey % 5 = 0 THEN 'MIRI' ELSE 'NIRCam' END AS instrument, o_orderpriority AS name FROM orders WHERE o_orderkey % 3 = 0")
def titles(spark, d):
    return io.titles(title_lines(spark, d), "line")[0].drop("line")


@query("odd_titles", "SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 3 = 1")
def odd_titles(spark, d):
    return io.titles(title_lines(spark, d), "line")[1].select("k")


@query("job_listing", "SELECT o_orderkey AS k, o_orderkey::VARCHAR AS id, 'brick-' || o_custkey AS name, o_orderstatus AS state FROM orders WHERE o_orderkey % 4 = 0")
def job_listing(spark, d):
    k = F.col("o_orderkey")
    name = F.when(k % 4 == 2, "other-").otherwise("brick-")
    line = F.concat(k.cast("string"), F.lit("| "), name, F.col("o_custkey").cast("string"), F.lit(" |"), F.col("o_orderstatus"), F.lit("|1:00"), F.when(k % 2 == 0, "|node").otherwise(""))
    return io.job_listing(table(spark, d, "orders").select(k.alias("k"), line.alias("line")), "line", "brick-").select("k", "id", "name", "state")


@query("provenance")
def provenance(spark, d):
    return io.provenance(spark.read.parquet(f"{d}/orders.parquet"), "catalogue").select("role", F.regexp_extract("path", r"([^/]*)$", 1).alias("file"))


@query("probe_schema")
def probe_schema(spark, d):
    """Names and types of every table's columns, from footers."""
    from functools import reduce

    parts = []
    for t in ("orders", "lineitem", "part", "supplier", "events"):
        s = io.probe(spark, f"{d}/{t}.parquet")
        one = table(spark, d, t).limit(1).select(F.lit(t).alias("table"), F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(k).alias("type")) for c, k in s.items()])).alias("s"))
        parts.append(one.select("table", "s.column", "s.type"))
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("file_inventory")
def file_inventory(spark, d):
    return io.inventory(spark, d, "*.parquet").select(F.regexp_extract("path", r"([^/]*)$", 1).alias("file"), "size")


@query("star_positions_text", f"WITH a AS ({STARS.sql}) SELECT id, printf('%.6f', ra) AS ra, printf('%.6f', dec) AS dec FROM a")
def star_positions_text(spark, d):
    return STARS.df(spark, d).select("id", F.format_string("%.6f", "ra").alias("ra"), F.format_string("%.6f", "dec").alias("dec"))

"""Helpers that several operators share: staged tables, whole-table reads, connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than ASCII white space (space, \t \n \v \f \r).
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's spark.checkpoint.dir.

    Where it is unset a local session (tests) gets a temporary one; on a cluster executors would not see that, so it raises.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not root:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back.

    This cuts the lineage, survives lost executors, and lets Spark know the table's size.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(name: str) -> str:
    """A name for an internal column that no table has."""
    return f"_{name}_{uuid.uuid4().hex}"


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col), F.lit(""))


#: A node is a hub if it has one in so many of all ends of links; so there are at most so many hubs.
HUBS = 20_000


def met(links: DataFrame, minima: DataFrame, total: int) -> DataFrame:
    """links (a, b) with m of minima (a, degree, m). Hubs' minima, at most HUBS rows whatever the table's size, are
    broadcast, so that the links of a hub, which may be a third of all, stay where they are; others meet by node."""
    limit = total // HUBS
    hubs = F.broadcast(minima.where(F.col("degree") > limit).select("a", F.col("m").alias("hub_m")))
    tagged = links.join(hubs, "a", "left")
    rest = tagged.where("hub_m is null").select("a", "b").join(minima.where(F.col("degree") <= limit).select("a", "m"), "a")
    return tagged.where("hub_m is not null").select("a", "b", F.col("hub_m").alias("m")).unionByName(rest)


def connected_components(edges: DataFrame) -> DataFrame:
    """Label each end of the links (a, b) with the smallest id that links lead to.

    Alternating large-star and small-star steps until the links no longer change, which takes about the logarithm of
    the longest chain in rounds; every link is then (node, smallest id). Links with a null end or with a = b are left out,
    repeated ones count once. A node without links has no row. Returns (node, root). Each round is a staged table, so
    lineage stays short; minima are aggregated before they are joined back, and a hub's links are not brought together.
    """
    links = edges.select(F.col("a"), F.col("b")).where("a is not null and b is not null and a <> b")
    links = stage(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    checked = (F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
    seen = tuple(links.agg(*checked).first())
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.count(F.lit(1)).alias("degree"), F.least(F.min("b"), F.first("a")).alias("m"))
        large = met(both.where("b > a"), least, 2 * seen[0]).select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = stage(large.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
        low = down.groupBy("a").agg(F.count(F.lit(1)).alias("degree"), F.min("b").alias("m"))
        small = met(down, low, seen[0])
        pairs = F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b"))))
        links = stage(small.select(pairs.alias("x")).select("x.a", "x.b").where("a <> b").distinct(), "links")
        now = tuple(links.agg(*checked).first())
        if now == seen:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = now

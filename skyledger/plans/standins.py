"""Survey tables made from the driver's tables by plain column arithmetic, in Spark and as SQL text.

An expression is one string where both dialects read it alike, else (Spark, SQL).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .registry import table

Expr = str | tuple[str, str]


class Standin:
    """A projection of one table, with an optional filter."""

    def __init__(self, source: str | Standin, columns: dict[str, Expr], where: str | None = None):
        self.source, self.columns, self.where = source, columns, where

    def df(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        x = table(spark, sf_dir, self.source) if isinstance(self.source, str) else self.source.df(spark, sf_dir)
        if self.where:
            x = x.where(self.where)
        return x.selectExpr(*[f"{e if isinstance(e, str) else e[0]} AS {c}" for c, e in self.columns.items()])

    @property
    def sql(self) -> str:
        source = self.source if isinstance(self.source, str) else f"({self.source.sql})"
        return "SELECT " + ", ".join(f"{e if isinstance(e, str) else e[1]} AS {c}" for c, e in self.columns.items()) + f" FROM {source}" + (f" WHERE {self.where}" if self.where else "")


_P = "cast(round(o_totalprice * 100) as bigint)"
DAYS = ("datediff(o_orderdate, date '1970-01-01')", "date_diff('day', date '1970-01-01', cast(o_orderdate as date))")

#: A star catalogue. A tile holds 16,384 stars, so the density stays the same at any scale.
STARS = Standin(
    "orders",
    {
        "id": "o_orderkey",
        "tile": "cast(floor(o_orderkey / 16384) as bigint)",
        "ra": f"266.40 + cast(({_P} * 48271) % 2147483647 as double) / 2147483647 * 0.02 + floor(o_orderkey / 16384) * 0.05",
        "dec": f"-28.90 + cast((({_P} + o_orderkey) * 69621) % 2147483647 as double) / 2147483647 * 0.02",
        "field": "o_orderpriority",
        "obs": "o_orderstatus",
        "module": "CASE WHEN o_custkey % 2 = 0 THEN 'A' ELSE 'B' END",
        "detector": "cast(o_custkey % 8 as int)",
        "flux": "o_totalprice",
        "flux_err": "cast(100 * (1 + o_custkey % 300) as double)",
        "mag": "-2.5 * log10(o_totalprice)",
        "cust": "o_custkey",
    },
)
_REF = {
    "id": "id",
    "tile": "tile",
    "ra": "ra + cast(100 + (cust % 21 - 10) as double) / 3600000 / cos(radians(-28.9))",
    "dec": "dec + cast((cust % 17) - 8 as double) / 3600000",
    "field": "field",
    "obs": "obs",
    "mag": "mag + cast(cust % 7 as double) / 100 + 25",
    "cust": "cust",
}
#: A reference 100 mas off, for every fifth star, and a dense one for every second.
REFERENCE = Standin(STARS, _REF, "id % 5 = 0")
DENSE_REFERENCE = Standin(STARS, _REF, "id % 2 = 0")
#: All stars as each of two modules has them, the second one 12 mas off.
MODULE_A = Standin(STARS, {c: c for c in STARS.columns})
MODULE_B = Standin(
    STARS, {c: {"ra": "ra + cast(12 + id % 5 as double) / 3600000 / cos(radians(-28.9))", "dec": "dec + cast(id % 7 - 3 as double) / 3600000"}.get(c, c) for c in STARS.columns}
)

#: Archive rows of two polls: keys, calibration level and release date.
_ARCHIVE = {
    "program": "cast(o_custkey % 40 as bigint)",
    "obs_id": "concat('jw', lpad(cast(o_custkey % 40 as string), 5, '0'), '-o', lpad(cast(o_orderkey % 1000 as string), 3, '0'), '_', cast(o_orderkey as string))",
    "k": "o_orderkey",
    "calib_level": "CASE o_orderstatus WHEN 'P' THEN -1 WHEN 'O' THEN 2 ELSE 3 END",
    "t_obs_release": (f"CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE cast({DAYS[0]} + 40587 as double) END", f"CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE cast({DAYS[1]} + 40587 as double) END"),
    "t_max": (f"CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE cast({DAYS[0]} + 40587 - o_custkey % 400 as double) END", f"CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE cast({DAYS[1]} + 40587 - o_custkey % 400 as double) END"),
    "instrument_name": "CASE o_custkey % 5 WHEN 0 THEN 'NIRCAM/IMAGE' WHEN 1 THEN 'MIRI/IMAGE' WHEN 2 THEN 'nircam' WHEN 3 THEN 'NIRISS/WFSS' ELSE NULL END",
    "filters": "CASE o_orderkey % 3 WHEN 0 THEN 'CLEAR;F212N' WHEN 1 THEN 'f444w,F470N;F444W' ELSE NULL END",
    "target_name": "concat('GC_', cast(o_orderkey % 60 as string))",
    "s_ra": ("CASE WHEN o_orderkey % 13 = 0 THEN double('NaN') WHEN o_orderkey % 17 = 0 THEN NULL ELSE 266.0 + (o_orderkey % 100) / 100.0D END", "CASE WHEN o_orderkey % 13 = 0 THEN 'NaN'::DOUBLE WHEN o_orderkey % 17 = 0 THEN NULL ELSE 266.0::DOUBLE + (o_orderkey % 100) / 100.0::DOUBLE END"),
    "s_dec": ("-29.0D + (o_orderkey % 50) / 100.0D", "-29.0::DOUBLE + (o_orderkey % 50) / 100.0::DOUBLE"),
}
POLL_0 = Standin("orders", _ARCHIVE | {"calib_level": "CASE WHEN o_orderkey % 5 = 1 THEN -1 WHEN o_orderstatus = 'P' THEN -1 WHEN o_orderstatus = 'O' THEN 2 ELSE 3 END"}, "o_orderkey % 5 <> 0")
POLL_1 = Standin("orders", _ARCHIVE, "o_orderkey % 97 <> 0")
POLL_MJD = (50900.0, 51000.0)

#: A product inventory: one row a file.
INVENTORY = Standin(
    "orders",
    {
        "field": "CASE o_orderpriority WHEN '1-URGENT' THEN 'brick' WHEN '2-HIGH' THEN 'cloudc' WHEN '3-MEDIUM' THEN 'sgrb2' WHEN '4-NOT SPECIFIED' THEN 'w51' ELSE 'sickle' END",
        "filter": "CASE o_custkey % 6 WHEN 0 THEN 'F212N' WHEN 1 THEN 'F444W' WHEN 2 THEN 'F182M' WHEN 3 THEN 'F405N' WHEN 4 THEN 'F770W' ELSE 'F187N' END",
        "obs": "lpad(cast(o_custkey % 4 + 1 as string), 3, '0')",
        "name": (
            "concat('jw02221-o', lpad(cast(o_custkey % 4 + 1 as string), 3, '0'), '_nrc', CASE WHEN o_orderkey % 2 = 0 THEN 'a' ELSE 'b' END, cast(o_orderkey % 4 + 1 as string), '_', cast(o_orderkey as string),"
            " CASE o_orderkey % 9 WHEN 0 THEN '_m8_dedup' WHEN 1 THEN '_m3' WHEN 2 THEN '_m6' WHEN 3 THEN '_20240115' WHEN 4 THEN '_destreak' WHEN 5 THEN '_segm' ELSE '' END, CASE o_orderkey % 3 WHEN 0 THEN '_cal.fits' WHEN 1 THEN '_i2d.fits' ELSE '_cat.ecsv' END)",
        )
        * 2,
        "folder": "CASE WHEN o_orderkey % 3 = 0 THEN 'pipeline' ELSE 'flat' END",
        "mtime": (f"cast({DAYS[0]} as bigint)", f"cast({DAYS[1]} as bigint)"),
        "size": "CASE WHEN o_orderkey % 401 = 0 THEN NULL ELSE cast(round(o_totalprice) as bigint) END",
        "k": "o_orderkey",
    },
)

#: Pixels: sparse ones averaged from line items, dense ones from orders.
DENSE_PIXELS = Standin(
    "orders",
    {
        "image": "cast(floor(o_orderkey / 16384) as bigint)",
        "y": "cast(floor(o_orderkey / 128) % 128 as bigint)",
        "x": "o_orderkey % 128",
        "value": "CASE WHEN o_orderkey % 211 = 0 THEN NULL ELSE o_totalprice / 1000 END",
        "dq": "o_custkey % 8",
    },
)
SPARSE_SQL = """SELECT l_linenumber AS image, l_orderkey % 128 AS y, l_partkey % 128 AS x, avg(l_extendedprice) AS value,
  max(cast(l_quantity as bigint)) AS dq FROM lineitem GROUP BY l_linenumber, l_orderkey % 128, l_partkey % 128"""


def sparse_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_linenumber", (_mod("l_orderkey")).alias("y"), (_mod("l_partkey")).alias("x"))
        .agg({"l_extendedprice": "avg", "l_quantity": "max"})
        .selectExpr("l_linenumber AS image", "y", "x", "`avg(l_extendedprice)` AS value", "cast(`max(l_quantity)` as bigint) AS dq")
    )


def _mod(c: str):
    from pyspark.sql import functions as F

    return F.col(c) % 128


#: Repeated measurements of a star: exposures are line numbers, duplicates are averaged.
EXPOSURE_SQL = """SELECT l_orderkey AS star, l_linenumber AS exposure, avg(l_extendedprice) AS flux, avg(l_discount) * 100 AS qfit,
  avg(l_quantity) AS err, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber"""


def exposures(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("star"), F.col("l_linenumber").alias("exposure"))
        .agg(F.avg("l_extendedprice").alias("flux"), (F.avg("l_discount") * 100).alias("qfit"), F.avg("l_quantity").alias("err"), F.count(F.lit(1)).alias("n"))
    )

"""Row filters and labels on catalogues, inventories and events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import scalars as S


def position_valid(df: DataFrame, sep: str, keys: Sequence[str], most: float = 0.05, least: int = 30) -> DataFrame:
    """Rows with sep <= most; a group that keeps fewer than ``least`` stays uncut. No such column: nothing is cut."""
    if sep not in df.columns:
        return df.withColumn("label", F.lit("uncut"))
    good = F.count_if(F.col(sep) <= most).over(W.partitionBy(*keys))
    x = df.withColumn("_good", good).where((F.col("_good") < least) | (F.col(sep) <= most))
    return x.withColumn("label", F.when(F.col("_good") >= least, "position valid").otherwise("uncut")).drop("_good")


def signal_cut(df: DataFrame, bands: Sequence[tuple[str, str]], over: float = 10.0) -> DataFrame:
    """Rows whose flux / error is over ``over`` in every band that has both columns."""
    for flux, error in bands:
        if flux in df.columns and error in df.columns:
            df = df.where(F.try_divide(F.col(flux), F.col(error)) > over)
    return df


def sentinel_filter(df: DataFrame, below: dict[str, float], at_least: dict[str, int], least: int, keys: Sequence[str]) -> DataFrame:
    """Rows under each column's sentinel; groups with fewer than ``least`` left have none."""
    for c, v in below.items():
        df = df.where(F.col(c) < v)
    for c, v in at_least.items():
        df = df.where(F.col(c) >= v)
    return df.withColumn("_n", F.count(F.lit(1)).over(W.partitionBy(*keys))).where(F.col("_n") >= least).drop("_n")


def event_ready(released: str = "released", level: str = "calib_level") -> Column:
    return F.coalesce(F.col(released), F.lit(False)) & (F.coalesce(F.col(level), F.lit(0)) >= 2)


def event_is_arrival() -> Column:
    """Ready, and new, newly released, or up to level 2 from below."""
    crossed = (F.col("event") == "CALIB_LEVEL_UP") & (F.coalesce(F.col("previous_calib_level"), F.lit(0)) < 2)
    return event_ready() & (F.col("event").isin("NEW_OBSERVATION", "NEWLY_RELEASED") | crossed)


def product_names(df: DataFrame, name: str, suffixes: Sequence[str], without: Sequence[str]) -> DataFrame:
    ends = F.lit(False)
    for s in suffixes:
        ends = ends | F.col(name).endswith(s)
    for w in without:
        ends = ends & ~F.col(name).contains(w)
    return df.where(ends)


def scope_to_obs(df: DataFrame, token: str, obs: Column, keys: Sequence[str]) -> DataFrame:
    """A group's files of this observation if it has any, else its files without a token; never another's."""
    own = F.count_if(F.col(token) == obs).over(W.partitionBy(*keys))
    x = df.where(F.col(token).isNull() | (F.col(token) == obs)).withColumn("_own", own)
    return x.where(F.when(F.col("_own") > 0, F.col(token).isNotNull()).otherwise(F.col(token).isNull())).drop("_own")


def prefer_undated(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    dated = S.name_tokens(F.col(name))["date"].isNotNull()
    x = df.withColumn("_dated", dated).withColumn("_plain", F.bool_or(~dated).over(W.partitionBy(*keys)))
    return x.where(~F.col("_plain") | ~F.col("_dated")).drop("_dated", "_plain")


def boxes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.min("ra").alias("ra0"), F.max("ra").alias("ra1"), F.min("dec").alias("dec0"), F.max("dec").alias("dec1"))


def footprint_crop(stars: DataFrame, reference: DataFrame, keys: Sequence[str], margin: float = 2.0, least: int = 50) -> DataFrame:
    """Reference rows in the box of a group's stars and ``margin`` arcseconds around it; fewer than ``least``: none."""
    m = margin / 3600
    x = reference.join(boxes(stars, keys), list(keys))
    x = x.where(F.col("ra").between(F.col("ra0") - m, F.col("ra1") + m) & F.col("dec").between(F.col("dec0") - m, F.col("dec1") + m))
    return x.withColumn("_n", F.count(F.lit(1)).over(W.partitionBy(*keys))).where(F.col("_n") >= least).drop("_n", "ra0", "ra1", "dec0", "dec1")


def wraps(ra0: Column, ra1: Column) -> Column:
    """A footprint that spans over 180 degrees of right ascension: one cell, no overlap test."""
    return (ra1 - ra0) > 180


def unmeasurable_reason(groups: DataFrame, stars: DataFrame, reference: DataFrame, measured: DataFrame, key: str) -> DataFrame:
    """Why a group has no offset, null if it has: catalogue, reference, footprints, cells, peak, in this order."""
    a, b = boxes(stars, [key]), boxes(reference, [key])
    b = b.select(key, *[F.col(c).alias(f"b_{c}") for c in ("ra0", "ra1", "dec0", "dec1")])
    x = groups.join(a, key, "left").join(b, key, "left").join(measured, key, "left")
    apart = (F.col("ra1") < F.col("b_ra0")) | (F.col("b_ra1") < F.col("ra0")) | (F.col("dec1") < F.col("b_dec0")) | (F.col("b_dec1") < F.col("dec0"))
    apart = apart & ~wraps(F.col("ra0"), F.col("ra1")) & ~wraps(F.col("b_ra0"), F.col("b_ra1"))
    reason = (
        F.when(F.col("ra0").isNull(), "no catalogue")
        .when(F.col("b_ra0").isNull(), "no reference")
        .when(apart, "footprints do not overlap")
        .when((F.col("peak_ratio") >= 1.5) & (F.col("n_cells") == 0), "a peak but no cell")
        .when(F.col("peak_ratio").isNull() | (F.col("peak_ratio") < 1.5), F.format_string("no peak (ratio %.2f)", F.col("peak_ratio")))
    )
    return x.select(key, reason.alias("reason"))


def physical_range(df: DataFrame, rms: str, n: str, most: float = 500.0, over: float = 0.1, least: int = 3) -> DataFrame:
    return df.where((F.col(rms) < most) & (F.col(rms) > over) & (F.col(n) >= least))


def same_system(df: DataFrame, a: str, b: str) -> DataFrame:
    """Colours need magnitudes of one system."""
    return df.where(F.col(a) == F.col(b))


def quantile_of(df: DataFrame, column: str, at: float, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.percentile(column, at).alias("q"))


def bright_end(df: DataFrame, mag: str, at: float, keys: Sequence[str], strict: bool = False) -> DataFrame:
    x = df.join(quantile_of(df, mag, at, keys), list(keys))
    return x.where(F.col(mag) < F.col("q") if strict else F.col(mag) <= F.col("q")).drop("q")


def first_existing(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """The first candidate that is a column, whatever its case; names with 'vega' come before 'ab'."""
    have = {c.lower(): c for c in df.columns}
    order = sorted(candidates, key=lambda c: 0 if "vega" in c.lower() else 1 if "ab" not in c.lower() else 2)
    return next((have[c.lower()] for c in order if c.lower() in have), None)


def restrict(df: DataFrame, target: str, columns: Sequence[str], also: Column | None = None) -> DataFrame:
    """Rows that name the target in one of the columns, whatever its case."""
    hit = F.lit(False) if also is None else also
    for c in columns:
        hit = hit | (F.lower(F.col(c)) == target.lower())
    return df.where(hit)

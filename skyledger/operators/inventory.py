"""Choices among files: which catalogue, reference, layout, detector list or band an observation uses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import scalars as S


def best_catalogue(files: DataFrame, keys: Sequence[str], name: str = "name", mtime: str = "mtime") -> DataFrame:
    """Highest tier, then newest, then first by name."""
    w = W.partitionBy(*keys).orderBy(S.catalogue_tier(F.col(name)).desc(), F.col(mtime).desc(), F.col(name))
    return files.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def round_robin(files: DataFrame, group: str, order: str, most: int, keys: Sequence[str] = ()) -> DataFrame:
    """At most ``most`` files of each key, spread over the groups: first ones of all groups, then second ones."""
    x = files.withColumn("_n", F.row_number().over(W.partitionBy(*keys, group).orderBy(order)))
    return x.withColumn("_r", F.row_number().over(W.partitionBy(*keys).orderBy("_n", group))).where(F.col("_r") <= most).drop("_n", "_r")


def stage_staleness(stages: DataFrame, keys: Sequence[str], order: str, newest: str) -> DataFrame:
    """A stage is stale if its newest file is over a second older than one of an earlier stage."""
    before = F.max(newest).over(W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1))
    return stages.withColumn("stale", F.coalesce(F.col(newest) < before - 1, F.lit(False)))


def first_passing(candidates: DataFrame, keys: Sequence[str], rank: str, least: int = 30) -> DataFrame:
    """Rows of the first source by rank that has at least ``least`` rows."""
    x = candidates.withColumn("_n", F.count(F.lit(1)).over(W.partitionBy(*keys, rank))).where(F.col("_n") >= least)
    return x.withColumn("_best", F.min(rank).over(W.partitionBy(*keys))).where(F.col(rank) == F.col("_best")).drop("_n", "_best")


def preferred_band(available: DataFrame, ranked: DataFrame, keys: Sequence[str], backed: str) -> DataFrame:
    """For each channel its first band of a ranked list, bands with an image first."""
    x = available.join(ranked, "filter").withColumn("channel", S.channel(F.col("filter")))
    return x.groupBy(*keys, "channel").agg(F.min_by("filter", F.struct(~F.col(backed), "rank")).alias("filter"))


def nearest_band(bands: DataFrame, keys: Sequence[str]) -> DataFrame:
    """For each band of a group the other one nearest in wavelength, the first by name on a tie."""
    b = bands.select(*keys, "filter").distinct()
    o = b.withColumnRenamed("filter", "other")
    x = b.join(o, list(keys)).where("filter <> other")
    far = F.abs(S.wavelength(F.col("filter")) - S.wavelength(F.col("other")))
    return x.groupBy(*keys, "filter").agg(F.min_by("other", F.struct(far, F.col("other"))).alias("partner"))


def by_pattern(files: DataFrame, patterns: Sequence[str], keys: Sequence[str], name: str = "name", last: bool = False) -> DataFrame:
    """The first pattern of a list that matches any file, and of its files the first (or last) by name."""
    rank = F.lit(None).cast("int")
    for i, p in reversed(list(enumerate(patterns))):
        rank = F.when(F.col(name).rlike(p), i).otherwise(rank)
    order = F.col(name).desc() if last else F.col(name).asc()
    x = files.withColumn("pattern", rank).where("pattern is not null")
    return x.withColumn("_r", F.row_number().over(W.partitionBy(*keys).orderBy("pattern", order))).where("_r = 1").drop("_r")


def field_vote(files: DataFrame, key: str, field: str, name: str) -> DataFrame:
    """Field with most distinct files of an observation, alphabetical on a tie; contested if several have any."""
    n = files.groupBy(key, field).agg(F.count_distinct(name).alias("n"))
    return n.groupBy(key).agg(F.min_by(field, F.struct(-F.col("n"), F.col(field))).alias("field"), F.max("n").alias("n"), (F.count(F.lit(1)) > 1).alias("contested"))


def detector_lists(files: DataFrame, keys: Sequence[str], filter_: str, name: str) -> DataFrame:
    """Sorted detectors of each filter; folders that are no filter are reported with a null list."""
    ok = F.col(filter_).rlike(S.FILTER_TOKEN)
    d = S.name_tokens(F.col(name))["detector"]
    return files.groupBy(*keys, filter_).agg(F.when(F.bool_and(ok), F.array_sort(F.collect_set(d))).alias("detectors"))


def layout_choice(files: DataFrame, keys: Sequence[str], folder: str, name: str, mtime: str, layouts: tuple[str, str] = ("pipeline", "flat")) -> DataFrame:
    """The layout with more files, the newer one on a tie; a name in both counts once in the total.

    ``split`` warns of layouts that have no name in common.
    """
    a, b = layouts
    one = files.groupBy(*keys, name).agg(F.bool_or(F.col(folder) == a).alias("a"), F.bool_or(F.col(folder) == b).alias("b"), F.max(F.when(F.col(folder) == a, F.col(mtime))).alias("ta"), F.max(F.when(F.col(folder) == b, F.col(mtime))).alias("tb"))
    x = one.groupBy(*keys).agg(F.count_if("a").alias("na"), F.count_if("b").alias("nb"), F.count_if(F.col("a") & F.col("b")).alias("both"), F.count(F.lit(1)).alias("total"), F.max("ta").alias("ta"), F.max("tb").alias("tb"))
    newer = F.coalesce(F.col("ta") >= F.col("tb"), F.col("ta").isNotNull())
    first = (F.col("na") > F.col("nb")) | ((F.col("na") == F.col("nb")) & newer)
    return x.select(*keys, F.when(first, a).otherwise(b).alias("layout"), "na", "nb", "total", ((F.col("na") > 0) & (F.col("nb") > 0) & (F.col("both") == 0)).alias("split"))


def discover(files: DataFrame, name: str) -> DataFrame:
    """Observations found from names alone: sorted filters, and the first field by name."""
    x = files.withColumn("obs", S.name_tokens(F.col(name))["obs"]).where("obs is not null")
    return x.groupBy("obs").agg(F.min("field").alias("field"), F.array_sort(F.collect_set("filter")).alias("filters"))


def shared_folder(files: DataFrame, folder: str, name: str) -> DataFrame:
    """Folders that hold files of several programs."""
    n = F.count_distinct(F.substring(F.col(name), 1, 7))
    return files.groupBy(folder).agg(n.alias("programs")).withColumn("note", F.when(F.col("programs") > 1, "shared"))


def missing_bands(nominal: DataFrame, available: DataFrame, keys: Sequence[str]) -> DataFrame:
    return nominal.select(*keys, "filter").exceptAll(available.select(*keys, "filter").distinct())


def two_modules(files: DataFrame, keys: Sequence[str], module: str, merged: Column) -> DataFrame:
    """Filters with both modules, or with a merged product."""
    m = F.collect_set(module)
    return files.groupBy(*keys).agg((F.bool_or(merged) | (F.size(F.array_intersect(m, F.array(F.lit("A"), F.lit("B")))) == 2)).alias("both"))


def with_product(bands: DataFrame, files: DataFrame, keys: Sequence[str]) -> DataFrame:
    return bands.join(files, list(keys), "left_semi")


def newest(files: DataFrame, keys: Sequence[str], path: str, mtime: str) -> DataFrame:
    return files.groupBy(*keys).agg(F.max_by(path, F.struct(mtime, path)).alias(path), F.max(mtime).alias(mtime))


def exposure_token(name: Column) -> Column:
    """vgroup<vgroup>_exp<exposure> of a name that ends in _<vgroup>_<exposure>."""
    return F.concat(F.lit("vgroup"), F.regexp_extract(name, r"_(\d+)_(\d+)$", 1), F.lit("_exp"), F.regexp_extract(name, r"_(\d+)_(\d+)$", 2))


def without_flagged(frames: DataFrame, flagged: DataFrame, name: str) -> DataFrame:
    """Frames whose name's _<vgroup>_<exposure> is not flagged as vgroup<vgroup>_exp<exposure>."""
    return frames.withColumn("_t", exposure_token(F.col(name))).join(flagged.select(F.col("token").alias("_t")), "_t", "left_anti").drop("_t")


def frame_of_catalogue(catalogues: DataFrame, frames: DataFrame, name: str = "name") -> DataFrame:
    """Calibration frame of a frame catalogue by its rewritten name, in the pipeline layout or else the flat one."""
    c = catalogues.withColumn("_n", F.regexp_replace(F.col(name), r"_cat\.ecsv$", "_cal.fits"))
    f = frames.select(F.col(name).alias("_n"), F.col("folder").alias("frame_folder"), (F.col("folder") != "pipeline").alias("_second"))
    f = f.groupBy("_n").agg(F.min_by("frame_folder", F.struct("_second", "frame_folder")).alias("frame_folder"))
    return c.join(f, "_n", "left").withColumnRenamed("_n", "frame")


def canonical_name(items: DataFrame, title: str, state: str, number: str) -> DataFrame:
    """One row for each title: an open one if there is any, then the lowest number."""
    return items.groupBy(title).agg(F.min_by(F.struct(state, number), F.struct(F.col(state) != "open", F.col(number))).alias("_m")).select(title, f"_m.{state}", f"_m.{number}")


def brightest(df: DataFrame, keys: Sequence[str], mag: str, id_: str, most: int, frame: str | None = None, frames: int | None = None) -> DataFrame:
    """At most ``most`` brightest rows of each group; with ``frames`` only those of the group's first frames."""
    if frame is not None and frames is not None:
        outer = [k for k in keys if k != frame]
        df = df.withColumn("_f", F.dense_rank().over(W.partitionBy(*outer).orderBy(frame))).where(F.col("_f") <= frames).drop("_f")
    return df.withColumn("_r", F.row_number().over(W.partitionBy(*keys).orderBy(mag, id_))).where(F.col("_r") <= most).drop("_r")


def fields_of(mapping: DataFrame, programs: DataFrame, wildcard: DataFrame) -> DataFrame:
    """Fields that a set of programs maps to, and the one that maps a program as a whole."""
    return mapping.join(programs, "program", "left_semi").select("field").unionByName(wildcard.join(programs, "program", "left_semi").select("field")).distinct()

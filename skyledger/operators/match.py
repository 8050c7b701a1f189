"""Joins on the sky. Catalogues have columns ra and dec in degrees; separations are in arcseconds.

A radius join is an equi join on sky buckets as wide as the radius: the second side takes the 3 x 3 buckets
around each of its rows, the other side its own bucket, and the exact distance decides. Right ascension wraps at
360 degrees. Rows whose position is null or NaN match nothing. Crowded buckets are dealt to several tasks, see ``crowded_cells``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from ..sources.staging import staged

ARCSEC = 3600.0
#: Rows of one side that a cell may hold before it is cut; cells a side of the blocks that are counted first.
PART, BLOCK = 5_000, 32


def separation(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    """Great-circle distance in arcseconds (haversine)."""
    a = F.pow(F.sin(F.radians(dec2 - dec1) / 2), F.lit(2.0)) + F.cos(F.radians(dec1)) * F.cos(F.radians(dec2)) * F.pow(F.sin(F.radians(ra2 - ra1) / 2), F.lit(2.0))
    return F.degrees(2 * F.asin(F.sqrt(F.least(F.lit(1.0), a)))) * ARCSEC


def tangent_offsets(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> tuple[Column, Column]:
    """(first - second) in arcseconds on the tangent plane: (dra * cos dec1, ddec)."""
    return (ra1 - ra2) * F.cos(F.radians(dec1)) * ARCSEC, (dec1 - dec2) * ARCSEC


def finite(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        df = df.where(F.col(c).isNotNull() & ~F.isnan(c))
    return df


def crowded_cells(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], part: int) -> DataFrame | None:
    """(_k0, _k1, ..., _by, _bx, _pa, _pb): cells that hold over ``part`` rows of a side, and the parts to cut each side into.

    None if there is no such cell. A first pass counts rows by blocks of 32 x 32 cells, which combine before the shuffle;
    only blocks with over ``part`` rows, and so no others' cells, are counted cell by cell.
    """
    names = [f"_k{i}" for i in range(len(on))]
    sides = [
        df.select(*[F.col(k[i]).alias(n) for k, n in zip(on, names)], "_by", "_bx", F.lit(i == 0).alias("_first"))
        for i, df in enumerate((left, right))
    ]
    rows = sides[0].unionByName(sides[1])
    block = {"_Y": F.floor(F.col("_by") / BLOCK), "_X": F.floor(F.col("_bx") / BLOCK)}
    full = rows.withColumns(block).groupBy(*names, "_Y", "_X", "_first").agg(F.count(F.lit(1)).alias("n"))
    full = staged(full.where(F.col("n") > part).select(*names, "_Y", "_X").distinct(), "blocks")
    if full.isEmpty():
        return None
    cells = rows.withColumns(block).join(full, [*names, "_Y", "_X"], "left_semi")
    n = lambda first: F.ceil(F.count_if(F.col("_first") == first) / part)
    cells = cells.groupBy(*names, "_by", "_bx").agg(n(True).cast("int").alias("_pa"), n(False).cast("int").alias("_pb"))
    cells = staged(cells.where("_pa > 0 and _pb > 0 and (_pa > 1 or _pb > 1)"), "cells")
    return None if cells.isEmpty() else cells


def neighbours(a: DataFrame, b: DataFrame, radius: float, keys: Sequence[str] = (), part: int = PART, spread: float = 0.0, wide: int = 1) -> DataFrame:
    """Pairs with equal ``keys``, under the names that radius_join gives; it has all pairs within ``radius``, and others.

    It also has all pairs at most ``radius`` apart in declination and radius / cos(dec) in right ascension, for any dec up to
    ``spread`` arcseconds from the first's. Cells are ``wide`` radii wide and b takes those that its surroundings touch: with
    many, b is repeated less and more pairs are looked at.
    """
    a, b = finite(a, "ra", "dec"), finite(b, "ra", "dec")
    height = radius / ARCSEC * 1.0001
    tall = height * wide

    def span(band: Column, degrees: float) -> Column:
        """The most degrees of right ascension that so many degrees may be in a band."""
        far = F.least(F.greatest(F.abs(band), F.abs(band + 1)) * tall + 2 * height + spread / ARCSEC, F.lit(90.0))
        half = F.asin(F.least(F.lit(1.0), math.sin(math.radians(degrees / 2)) / F.greatest(F.cos(F.radians(far)), F.lit(1e-12))))
        return F.degrees(half) * 2

    def cells(band: Column) -> Column:
        return F.greatest(F.lit(1), F.floor(360.0 / span(band, tall)).cast("long"))

    def column(ra: Column, n: Column) -> Column:
        return F.least(F.floor(F.pmod(ra, F.lit(360.0)) / 360.0 * n).cast("long"), n - 1)

    def dealt(df: DataFrame, cut: DataFrame, side: int) -> DataFrame:
        """df with its rows' part of their own side (_qa or _qb), once for each part of the other side."""
        plain = [f.name for f in df.schema.fields if isinstance(f.dataType, AtomicType)]
        same = F.lit(True)
        for i, k in enumerate(keys):
            same = same & (df[f"{'ab'[side]}_{k}"] == cut[f"_k{i}"])
        mine, others = (("_pa", "_pb"), ("_pb", "_pa"))[side]
        own, other = (("_qa", "_qb"), ("_qb", "_qa"))[side]
        x = df.join(cut, same & (df["_by"] == cut["_by"]) & (df["_bx"] == cut["_bx"]), "left")
        deal = F.explode(F.sequence(F.lit(0), F.coalesce(cut[others], F.lit(1)) - 1)).alias(other)
        return x.select(*[df[c] for c in df.columns], F.pmod(F.xxhash64(*[df[c] for c in plain]), F.coalesce(cut[mine], F.lit(1)).cast("long")).cast("int").alias(own), deal)

    band = lambda dec: F.floor(dec / tall).cast("long")
    left = a.select(*[F.col(c).alias(f"a_{c}") for c in a.columns], band(F.col("dec")).alias("_by")).withColumn("_bx", column(F.col("a_ra"), cells(F.col("_by"))))
    right = b.select(*[F.col(c).alias(f"b_{c}") for c in b.columns], F.explode(F.sequence(band(F.col("dec") - height), band(F.col("dec") + height))).alias("_by"))
    right = right.withColumns({"_n": cells(F.col("_by")), "_w": span(F.col("_by"), height)})
    place = lambda ra: F.floor(ra / 360.0 * F.col("_n")).cast("long")
    turn = F.pmod(F.col("b_ra"), F.lit(360.0))
    touched = F.transform(F.sequence(place(turn - F.col("_w")), place(turn + F.col("_w"))), lambda x: F.pmod(x, F.col("_n")))
    right = right.withColumn("_bx", F.explode(F.array_distinct(touched))).drop("_n", "_w")
    cut = crowded_cells(left, right, [(f"a_{k}", f"b_{k}") for k in keys], part)
    extra = ["_bx", "_by"]
    if cut is not None:
        left, right = dealt(left, cut, 0), dealt(right, cut, 1)
        extra += ["_qa", "_qb"]
    on = F.lit(True)
    for k in keys:
        on = on & (left[f"a_{k}"] == right[f"b_{k}"])
    for c in extra:
        on = on & (left[c] == right[c])
    return left.join(right, on).drop(*extra)


def radius_join(a: DataFrame, b: DataFrame, radius: float, keys: Sequence[str] = (), part: int = PART) -> DataFrame:
    """Pairs at most ``radius`` arcseconds apart with equal ``keys``.

    Columns of a are named a_<column>, those of b b_<column>; ``sep`` is the distance. Declination bands are as high as the
    radius, and each band has its own cells in right ascension, as wide as the radius is there: rows near a pole make
    the cells of no other band wider. b takes the 3 x 3 cells around each of its rows, so it should be the smaller side.

    A cell with over ``part`` rows of a side is cut into parts of about so many rows, by a hash of the rows, and each pair
    of a part of a with a part of b is compared by itself: no comparison is made twice or left out, and about part * part of
    them share a key, however crowded the cell (rows equal in all plain columns stay in one part).
    """
    sep = separation(F.col("a_ra"), F.col("a_dec"), F.col("b_ra"), F.col("b_dec"))
    return neighbours(a, b, radius, keys, part).withColumn("sep", sep).where(F.col("sep") <= radius)


def nearest(pairs: DataFrame, of: str, other: str, within: float | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """For each ``of`` its nearest pair, strictly within ``within``; ties go to the smaller ``other``."""
    if within is not None:
        pairs = pairs.where(F.col("sep") < within)
    w = W.partitionBy(*keys, of).orderBy("sep", other)
    return pairs.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def mutual_nearest(pairs: DataFrame, keys: Sequence[str] = (), a: str = "a_id", b: str = "b_id") -> DataFrame:
    """Pairs that are each other's nearest. A closer rival lies within the radius too, so bounded pairs do."""
    wa, wb = W.partitionBy(*keys, a).orderBy("sep", b), W.partitionBy(*keys, b).orderBy("sep", a)
    x = pairs.withColumns({"_ra": F.row_number().over(wa), "_rb": F.row_number().over(wb)})
    return x.where("_ra = 1 and _rb = 1").drop("_ra", "_rb")


def one_to_one(pairs: DataFrame, keys: Sequence[str] = (), a: str = "a_id", b: str = "b_id") -> DataFrame:
    """Nearest b of each a, and of those the closest a of each b."""
    return nearest(nearest(pairs, a, b, keys=keys), b, a, keys=keys)


def isolated(stars: DataFrame, radius: float, keys: Sequence[str] = (), id_: str = "id") -> DataFrame:
    """Stars without another star of the same catalogue within ``radius``."""
    pairs = radius_join(stars.select(*keys, id_, "ra", "dec"), stars.select(*keys, id_, "ra", "dec"), radius, keys)
    crowded = pairs.where(F.col(f"a_{id_}") != F.col(f"b_{id_}")).select(*[F.col(f"a_{k}").alias(k) for k in (*keys, id_)]).distinct()
    return finite(stars, "ra", "dec").join(crowded, [*keys, id_], "left_anti")


def unambiguous(pairs: DataFrame, near: float, clear: float, keys: Sequence[str] = (), a: str = "a_id") -> DataFrame:
    """Pairs whose a has its nearest b within ``near`` and no second one within ``clear``; pairs reach to ``clear``."""
    w = W.partitionBy(*keys, a)
    x = pairs.where(F.col("sep") <= clear).withColumn("_n", F.count(F.lit(1)).over(w))
    return x.where((F.col("_n") == 1) & (F.col("sep") < near)).drop("_n")


def two_band_colours(a: DataFrame, b: DataFrame, radius: float = 0.05, least: int = 100, keys: Sequence[str] = ()) -> DataFrame:
    """Colours a - b of mutual matches within ``radius``; a group with fewer than ``least`` has null colours and a reason.

    Catalogues in different magnitude systems (column ``system``) are refused the same way, unknown systems too.
    """
    k = [f"a_{c}" for c in keys]
    pairs = mutual_nearest(radius_join(a, b, radius, keys).where(F.col("sep") < radius), k)
    n = pairs.groupBy(*k).agg(F.count(F.lit(1)).alias("_n"))
    pairs = pairs.join(n, k) if k else pairs.crossJoin(F.broadcast(n))  # one row
    same = F.coalesce(F.col("a_system") == F.col("b_system"), F.lit(False))
    reason = F.when(F.col("_n") < least, "too few matches").when(~same, "magnitude systems differ")
    return pairs.withColumn("reason", reason).drop("_n").withColumn("colour", F.when(F.col("reason").isNull(), F.col("a_mag") - F.col("b_mag")))

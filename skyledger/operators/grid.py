"""Offsets in a grid of cells over a field, their consistency, and the adaptive choice of a grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import staged
from . import match, offset, select, stats

#: Grid, least sources a cell, floor of the peak ratio.
GRIDS = ((4, 300, 1.5), (2, 150, 1.5), (1, 100, 4.0))
SPREAD, SPURIOUS, SPURIOUS_SHARE, BAD_SHARE, COVERAGE = 30.0, 300.0, 0.02, 0.02, 0.5


def _index(u: Column, v: Column, n: int) -> Column:
    """Cells that the stretch [u, v] of 0..n touches, both edges of a cell closed."""
    low, high = F.greatest(F.ceil(u) - 1, F.lit(0)), F.least(F.floor(v), F.lit(n - 1))
    return F.when((v < 0) | (u > n), F.array().cast("array<bigint>")).otherwise(F.sequence(low.cast("bigint"), F.greatest(low, high).cast("bigint")))


def in_cells(df: DataFrame, boxes: DataFrame, keys: Sequence[str], n: int, margin: float = 0.0) -> DataFrame:
    """Each row once for each cell it touches when padded by ``margin`` degrees; rows outside have none."""
    x = df.join(boxes, list(keys))
    size = F.when(select.wraps(F.col("ra0"), F.col("ra1")), 1).otherwise(n)
    wide = lambda a, b: F.when(F.col(b) > F.col(a), (F.col(b) - F.col(a)) / n).otherwise(1.0)  # noqa: E731  all rows in one place: one cell
    w, h = wide("ra0", "ra1"), wide("dec0", "dec1")
    u, v = (F.col("ra") - F.col("ra0")) / w, (F.col("dec") - F.col("dec0")) / h
    x = x.withColumn("i", F.explode(F.when(size == 1, F.array(F.lit(0).cast("bigint"))).otherwise(_index(u - margin / w, u + margin / w, n))))
    x = x.withColumn("j", F.explode(F.when(size == 1, F.array(F.lit(0).cast("bigint"))).otherwise(_index(v - margin / h, v + margin / h, n))))
    return x.drop("ra0", "ra1", "dec0", "dec1")


def cell_offsets(stars: DataFrame, reference: DataFrame, keys: Sequence[str], n: int, least: int, floor: float, pairs_least: int | None = None, boxes: DataFrame | None = None) -> DataFrame:
    """One row for each cell with at least ``least`` stars: its offset, or why it is dropped.

    The reference is taken from the cell and 2 arcseconds around it; it needs ``least`` rows as well. A peak counts if
    its ratio reaches ``floor`` and it rests on ``pairs_least`` pairs (default: ``least``). Only groups of ``boxes`` count,
    the extents of all groups by default.
    """
    g = [*keys, "i", "j"]
    if boxes is None:
        boxes = select.boxes(match.finite(stars, "ra", "dec"), keys)
    a = staged(in_cells(stars.select(*keys, "id", "ra", "dec"), boxes, keys, n), "cell-stars")
    b = staged(in_cells(reference.select(*keys, "id", "ra", "dec"), boxes, keys, n, 2.0 / 3600), "cell-reference")
    size = a.groupBy(*g).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    size = size.join(b.groupBy(*g).agg(F.count(F.lit(1)).alias("n_ref")), g, "left").fillna(0, ["n_ref"])
    size = staged(size, "cell-sizes")
    full = size.where(F.col("n_ref") >= least).select(*g)
    x = size.join(offset.bulk_offset(a.join(full, g), b.join(full, g), g).drop("reason"), g, "left")
    ok = F.coalesce((F.col("peak_ratio") >= floor) & (F.col("npairs") >= (pairs_least or least)), F.lit(False))
    reason = F.when(F.col("n_ref") < least, "too few reference stars").when(~ok, "no clear peak")
    x = x.withColumn("reason", reason)
    good = F.col("reason").isNull()
    return x.select(*g, "n", "n_ref", *[F.when(good, F.col(c)).alias(c) for c in ("dra", "ddec", "off", "peak_ratio", "npairs")], "reason")


def adaptive_grid(stars: DataFrame, reference: DataFrame, keys: Sequence[str], grids: Sequence[tuple[int, int, float]] = GRIDS) -> DataFrame:
    """cell_offsets of the first grid that gives any cell; without any, the last grid's dropped cells and grid 0.

    A grid is laid over the groups only that the grids before gave no cell.
    """
    k, out = list(keys), None
    boxes = staged(select.boxes(match.finite(stars, "ra", "dec"), k), "boxes")
    for rank, (n, least, floor) in enumerate(grids):
        cells = staged(cell_offsets(stars, reference, k, n, least, floor, boxes=boxes), "grid")
        given = cells.where("reason is null").select(*k).distinct()
        part = cells.join(given, k, "left_semi").withColumn("grid", F.lit(n))
        out = part if out is None else out.unionByName(part)
        boxes = staged(boxes.join(given, k, "left_anti"), "boxes")
        if rank == len(grids) - 1:
            out = out.unionByName(cells.join(given, k, "left_anti").withColumn("grid", F.lit(0)))
        elif boxes.isEmpty():
            break
    return staged(out, "grids")


def consistency(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row a group: field offset (weighted median of cells), spread, coverage, and whether the cells agree.

    A spurious cell (over 300 mas from the field with under 2 % of its sources) is dropped, unless all are. A cell
    deviates beyond 30 mas; it is confirmed if a cell beside it deviates too.
    """
    g = list(keys)

    def centred(c: DataFrame) -> DataFrame:
        m = stats.weighted_median(c, g, "dra", "n").join(stats.weighted_median(c, g, "ddec", "n"), g)
        return c.join(m.select(*g, F.col("dra").alias("mra"), F.col("ddec").alias("mdec")), g).withColumn("dev", F.hypot(F.col("dra") - F.col("mra"), F.col("ddec") - F.col("mdec")))

    measured = cells.where("reason is null")
    total = measured.groupBy(*g).agg(F.sum("n").alias("_all"))
    x = centred(measured).join(total, g).withColumn("_spurious", (F.col("dev") > SPURIOUS) & (F.col("n") / F.col("_all") < SPURIOUS_SHARE))
    x = x.join(x.groupBy(*g).agg(F.every("_spurious").alias("_every")), g).withColumn("_spurious", F.col("_spurious") & ~F.col("_every"))
    x = staged(x.drop("mra", "mdec", "dev", "_every", "_all"), "cells")
    kept = centred(x.where("not _spurious").drop("_spurious")).withColumn("deviating", F.col("dev") > SPREAD)
    side = F.explode(F.array(*[F.struct((F.col("i") + a).alias("i"), (F.col("j") + b).alias("j")) for a, b in ((1, 0), (-1, 0), (0, 1), (0, -1))]))
    beside = kept.where("deviating").select(*g, side.alias("_s")).select(*g, "_s.i", "_s.j").distinct().withColumn("_near", F.lit(True))
    kept = staged(kept.join(beside, [*g, "i", "j"], "left").withColumn("confirmed", F.col("deviating") & F.coalesce("_near", F.lit(False))).drop("_near"), "kept-cells")
    spread = offset.mad_std(kept, g, "dra", "ddec").select(*g, F.hypot("dra_mad", "ddec_mad").alias("spread"))
    s = kept.groupBy(*g).agg(
        F.first("mra").alias("dra"),
        F.first("mdec").alias("ddec"),
        F.count(F.lit(1)).alias("n_cells"),
        F.count_if("deviating").alias("n_deviating"),
        F.count_if("confirmed").alias("n_confirmed"),
        F.sum("n").alias("_n"),
        F.coalesce(F.sum(F.when(F.col("confirmed"), F.col("n"))), F.lit(0)).alias("_bad"),
    )
    gone = x.where("_spurious").groupBy(*g).agg(F.count(F.lit(1)).alias("n_spurious"), F.sum("n").alias("_gone"))
    lost = cells.where("reason is not null").groupBy(*g).agg(F.count(F.lit(1)).alias("_drops"), F.sum("n").alias("_lost"))
    s = cells.select(*g).distinct().join(s, g, "left").join(gone, g, "left").join(lost, g, "left").join(spread, g, "left")
    s = s.fillna(0, ["n_spurious", "_gone", "_lost", "_drops", "n_cells", "n_deviating", "n_confirmed"])
    bad, coverage = F.col("_bad") / F.col("_n"), F.col("_n") / (F.col("_n") + F.col("_gone") + F.col("_lost"))
    agree = (F.col("n_cells") >= 4) & (bad < BAD_SHARE) & (coverage >= COVERAGE)
    return s.select(
        *g, "dra", "ddec", F.hypot("dra", "ddec").alias("off"), F.when(F.col("n_cells") >= 2, F.col("spread")).alias("spread"), "n_cells", (F.col("_drops") + F.col("n_spurious")).alias("n_dropped"),
        "n_deviating", "n_confirmed", "n_spurious", bad.alias("bad_fraction"), coverage.alias("coverage"), F.coalesce(agree, F.lit(False)).alias("consistent"),
    )

"""Offsets between two catalogues. Every offset is (first catalogue - second), in milliarcseconds unless named else."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.staging import staged
from . import match, quantiles

MAD = 1.482602218505602


def median(c: str | Column) -> Column:
    return F.percentile(c, 0.5)


def mad_std(df: DataFrame, keys: Sequence[str], *columns: str, count: str | None = None) -> DataFrame:
    """Keys and, for each column, <column>_med and <column>_mad (scaled median absolute deviation); with ``count`` the rows too.

    df is read once and staged; groups too large for one task are narrowed first (see quantiles).
    """
    g = list(keys)
    x = staged(df.select(*g, *columns), "deviations")
    most = quantiles.largest(x, g)
    found = quantiles.group_quantiles(x, g, columns, most=most)
    centre = staged(found.select(*g, *([F.col("n").alias(count)] if count else []), *[F.col(c).alias(f"{c}_med") for c in columns]), "medians")
    far = x.join(centre, g) if g else x.crossJoin(F.broadcast(centre))
    far = far.select(*g, *[F.abs(F.col(c) - F.col(f"{c}_med")).alias(f"{c}_mad") for c in columns])
    spread = quantiles.group_quantiles(far, g, [f"{c}_mad" for c in columns], most=most)
    spread = spread.select(*g, *[(F.col(f"{c}_mad") * MAD).alias(f"{c}_mad") for c in columns])
    return centre.join(spread, g) if g else centre.crossJoin(F.broadcast(spread))


def pair_offsets(pairs: DataFrame) -> DataFrame:
    """Adds dra and ddec in arcseconds, a - b, each pair with its own cosine."""
    dra, ddec = match.tangent_offsets(F.col("a_ra"), F.col("a_dec"), F.col("b_ra"), F.col("b_dec"))
    return pairs.withColumns({"dra": dra, "ddec": ddec})


def xcorr(pairs: DataFrame, keys: Sequence[str] = (), maxsep: float = 2.5, bin_: float = 0.05, least: int = 30, rounds: int = 4, fewest: int = 5, near: Callable[[DataFrame, float], DataFrame] | None = None) -> DataFrame:
    """Offset of two catalogues from the peak of the histogram of all pair offsets.

    pairs has dra and ddec in arcseconds (see pair_offsets). The peak is the fullest bin, the first by (i, j) on a
    tie; the background is the median of non-empty bins. The peak's centre is refined by up to ``rounds`` medians of
    pairs strictly within one bin of it, until fewer than ``fewest`` are there. Returns keys, dra, ddec, off (mas),
    npairs, peak_ratio (infinite without background), reason; groups with fewer than ``least`` pairs have nulls. ``near``
    gives the pairs around a centre again (see pairs_around), else ``pairs`` is read twice.
    """
    g = list(keys) or ["_all"]
    p = (pairs if keys else pairs.withColumn("_all", F.lit(0))).select(*g, "dra", "ddec")
    last = int(round(2 * maxsep / bin_)) - 1
    cell = lambda c: F.least(F.floor((F.col(c) + maxsep) / bin_), F.lit(last)).cast("int")
    inside = (F.abs("dra") <= maxsep) & (F.abs("ddec") <= maxsep)
    bins = p.where(inside).groupBy(*g, cell("dra").alias("_bi"), cell("ddec").alias("_bj")).agg(F.count(F.lit(1)).alias("n"))
    peak = bins.groupBy(*g).agg(
        F.max_by(F.struct("_bi", "_bj"), F.struct(F.col("n"), -F.col("_bi"), -F.col("_bj"))).alias("_at"), F.max("n").alias("top"), median("n").alias("background"), F.sum("n").alias("npairs")
    )
    centre = staged(peak, "peak").select(
        *g, "npairs", "top", "background", (-maxsep + (F.col("_at._bi") + 0.5) * bin_).alias("cx"), (-maxsep + (F.col("_at._bj") + 0.5) * bin_).alias("cy"), F.lit(True).alias("moving")
    )
    # The centre moves by less than a bin a round, so refinement needs no pair farther out. These few are written.
    reach = (rounds + 1) * bin_
    core = near(centre.select(*g, "cx", "cy"), reach) if near else p.join(centre, g)
    core = core.where((F.abs(F.col("dra") - F.col("cx")) < reach) & (F.abs(F.col("ddec") - F.col("cy")) < reach))
    core = staged(core.select(*g, "dra", "ddec"), "core")
    held = [*g, "npairs", "top", "background", "cx", "cy", "moving"]
    most = quantiles.largest(core, g)
    for _ in range(rounds):
        # Each round reads the centres once, so the plan grows by one join and one aggregate.
        near = F.col("moving") & (F.abs(F.col("dra") - F.col("cx")) < bin_) & (F.abs(F.col("ddec") - F.col("cy")) < bin_)
        if most <= quantiles.FEW:
            step = centre.join(core, g, "left").groupBy(*held).agg(F.count_if(near).alias("_n"), median(F.when(near, F.col("dra"))).alias("_x"), median(F.when(near, F.col("ddec"))).alias("_y"))
        else:
            found = quantiles.group_quantiles(centre.join(core, g).where(near), g, ["dra", "ddec"], most=most)
            found = found.select(*g, F.col("n").alias("_n"), F.col("dra").alias("_x"), F.col("ddec").alias("_y"))
            step = staged(centre.join(found, g, "left").withColumn("_n", F.coalesce("_n", F.lit(0))), "centres")
        go = F.col("moving") & (F.col("_n") >= fewest)
        centre = step.select(
            *g, "npairs", "top", "background", F.when(go, F.col("_x")).otherwise(F.col("cx")).alias("cx"), F.when(go, F.col("_y")).otherwise(F.col("cy")).alias("cy"), go.alias("moving")
        )
    enough = F.col("npairs") >= least
    out = centre.select(
        *g,
        F.when(enough, F.col("cx") * 1000).alias("dra"),
        F.when(enough, F.col("cy") * 1000).alias("ddec"),
        F.when(enough, F.hypot("cx", "cy") * 1000).alias("off"),
        "npairs",
        F.when(enough, F.when(F.col("background") > 0, F.col("top") / F.col("background")).otherwise(F.lit(float("inf")))).alias("peak_ratio"),
        F.when(~enough, F.concat(F.lit("fewer than "), F.lit(least), F.lit(" pairs"))).alias("reason"),
    )
    return out if keys else out.drop("_all")


def pairs_around(a: DataFrame, b: DataFrame, keys: Sequence[str], maxsep: float) -> Callable[[DataFrame, float], DataFrame]:
    """For xcorr: those pairs within ``maxsep`` whose offset is near a group's centre (cx, cy), by a join of a moved there."""
    g = list(keys)
    a, b = (x.select(*g, "id", "ra", "dec") for x in (a, b))

    def near(centre: DataFrame, reach: float) -> DataFrame:
        moved = {"ra": F.col("ra") - F.col("cx") / match.ARCSEC / F.cos(F.radians("dec")), "dec": F.col("dec") - F.col("cy") / match.ARCSEC}
        x = a.withColumns({"ra0": F.col("ra"), "dec0": F.col("dec")}).join(centre, g).withColumns(moved)
        x = match.neighbours(x, b, reach, g, spread=maxsep, wide=4)
        place = [F.col(c) for c in ("a_ra0", "a_dec0", "b_ra", "b_dec")]
        dra, ddec = match.tangent_offsets(*place)
        # The cheap comparisons go first.
        x = x.where((F.abs(dra - F.col("a_cx")) < reach) & (F.abs(ddec - F.col("a_cy")) < reach)).where(match.separation(*place) <= maxsep)
        return x.select(*[F.col(f"a_{k}").alias(k) for k in g], dra.alias("dra"), ddec.alias("ddec"), F.col("a_cx").alias("cx"), F.col("a_cy").alias("cy"))

    return near


def bulk_offset(a: DataFrame, b: DataFrame, keys: Sequence[str], maxsep: float = 2.5) -> DataFrame:
    """xcorr of all pairs of two catalogues within ``maxsep`` with equal keys. The wide join is made once, for the histogram."""
    g = list(keys)
    a, b = (x.select(*g, "id", "ra", "dec") for x in (a, b))
    pairs = pair_offsets(match.radius_join(a, b, maxsep, g)).select(*[F.col(f"a_{k}").alias(k) for k in g], "dra", "ddec")
    return xcorr(pairs, g, maxsep, near=pairs_around(a, b, g, maxsep))


def same_star_offset(matched: DataFrame, keys: Sequence[str] = (), least: int = 30, bulk: DataFrame | None = None, most_off: float = 100.0, least_ratio: float = 4.0) -> DataFrame:
    """Median offset and scatter of mutual matches (dra, ddec in arcseconds).

    With ``bulk`` (an xcorr result) a group is refused whose bulk offset exceeds ``most_off`` or whose peak ratio is
    under ``least_ratio``: matches would then be chance ones.
    """
    g = list(keys)
    x = matched.select(*g, (F.col("dra") * 1000).alias("dra"), (F.col("ddec") * 1000).alias("ddec"))
    stat = mad_std(x, g, "dra", "ddec", count="n")
    reason = F.when(F.col("n") < least, "too few matches")
    if bulk is not None:
        stat = stat.join(bulk.select(*g, F.col("off").alias("_off"), F.col("peak_ratio").alias("_ratio")), g, "left")
        reason = reason.when(F.col("_off").isNull() | (F.col("_off") > most_off) | (F.col("_ratio") < least_ratio), "no bulk agreement")
    ok = F.col("reason").isNull()
    return stat.withColumn("reason", reason).select(
        *g,
        "n",
        F.when(ok, F.col("dra_med")).alias("dra"),
        F.when(ok, F.col("ddec_med")).alias("ddec"),
        F.when(ok, F.hypot("dra_med", "ddec_med")).alias("off"),
        F.when(ok, F.hypot("dra_mad", "ddec_mad")).alias("scatter"),
        "reason",
    )


def isolated_bulk(stars: DataFrame, reference: DataFrame, keys: Sequence[str] = (), alone: float = 0.5, near: float = 0.15, clear: float = 0.4, least: tuple[int, int, int, int] = (100, 50, 20, 15)) -> DataFrame:
    """Offset from isolated stars with an unambiguous reference. ``least``: stars, references, isolated, clean.

    One cosine, that of the median declination of the clean stars, is used for a group.
    """
    g = list(keys)
    count = lambda df, name: df.groupBy(*g).agg(F.count(F.lit(1)).alias(name))
    stars, reference = (x.select(*g, "id", "ra", "dec") for x in (stars, reference))
    lone = staged(match.isolated(stars, alone, g), "isolated")
    pairs = match.radius_join(lone, reference, clear, g)
    clean = match.unambiguous(pairs, near, clear, [f"a_{k}" for k in g]).select(*[F.col(f"a_{k}").alias(k) for k in g], "a_ra", "a_dec", "b_ra", "b_dec")
    m = clean.groupBy(*g).agg(
        F.count(F.lit(1)).alias("n_clean"), median("a_dec").alias("_dec"), median(F.col("a_ra") - F.col("b_ra")).alias("_dra"), median(F.col("a_dec") - F.col("b_dec")).alias("_ddec")
    )
    x = count(stars, "n_stars").join(count(reference, "n_reference"), g, "left").join(count(lone, "n_isolated"), g, "left").join(m, g, "left")
    x = x.fillna(0, ["n_reference", "n_isolated", "n_clean"])
    reason = (
        F.when((F.col("n_stars") < least[0]) | (F.col("n_reference") < least[1]), "too few sources")
        .when(F.col("n_isolated") < least[2], "too few isolated")
        .when(F.col("n_clean") < least[3], "too few clean matches")
    )
    ok = F.col("reason").isNull()
    x = x.withColumn("reason", reason).withColumns({"dra": F.when(ok, F.col("_dra") * F.cos(F.radians("_dec")) * 3.6e6), "ddec": F.when(ok, F.col("_ddec") * 3.6e6)})
    return x.select(*g, "n_stars", "n_reference", "n_isolated", "n_clean", "dra", "ddec", F.hypot("dra", "ddec").alias("off"), "reason")


def module_offset(a: DataFrame, b: DataFrame, keys: Sequence[str] = (), radius: float = 0.1, least: int = 8) -> DataFrame:
    """Direct offset of module A from module B within ``radius``; the scatter is that of ddec alone."""
    g = [f"a_{k}" for k in keys]
    p = pair_offsets(match.radius_join(a, b, radius, keys)).withColumns({"dra": F.col("dra") * 1000, "ddec": F.col("ddec") * 1000})
    stat = mad_std(p, g, "dra", "ddec", count="n")
    ok = F.col("n") >= least
    return stat.select(
        *[F.col(f"a_{k}").alias(k) for k in keys],
        "n",
        F.when(ok, F.col("dra_med")).alias("dra"),
        F.when(ok, F.col("ddec_med")).alias("ddec"),
        F.when(ok, F.hypot("dra_med", "ddec_med")).alias("off"),
        F.when(ok, F.col("ddec_mad")).alias("scatter"),
        F.when(~ok, "too few pairs").alias("reason"),
    )


def overlap_residuals(a: DataFrame, b: DataFrame, keys: Sequence[str] = (), maxsep: float = 1.5, near: float = 0.08) -> DataFrame:
    """Module overlap rows: a shifted by its bulk offset from b, then matched one to one within ``near``.

    Returns the pairs with rdra and rddec (mas, shifted a - b) and the bulk (bulk_dra, bulk_ddec, peak_ratio, npairs).
    """
    g = list(keys)
    bulk = xcorr(pair_offsets(match.radius_join(a, b, maxsep, g)).select(*[F.col(f"a_{k}").alias(k) for k in g], "dra", "ddec"), g, maxsep)
    moved = a.join(bulk.select(*g, F.col("dra").alias("bulk_dra"), F.col("ddec").alias("bulk_ddec"), "peak_ratio", "npairs"), g)
    moved = moved.where("bulk_dra is not null")
    moved = moved.withColumns({"ra": F.col("ra") - F.col("bulk_dra") / 3.6e6 / F.cos(F.radians("dec")), "dec": F.col("dec") - F.col("bulk_ddec") / 3.6e6})
    pairs = match.one_to_one(match.radius_join(moved, b, near, g), [f"a_{k}" for k in g])
    p = pair_offsets(pairs)
    return p.withColumns({"rdra": F.col("dra") * 1000, "rddec": F.col("ddec") * 1000})


def offset_cloud(a: DataFrame, b: DataFrame, keys: Sequence[str] = (), maxsep: float = 1.5, near: float = 0.1, least: int = 20) -> DataFrame:
    """Unshifted median offset of pairs that lie within ``near`` once a is shifted by its bulk offset."""
    g = list(keys)
    bulk = xcorr(pair_offsets(match.radius_join(a, b, maxsep, g)).select(*[F.col(f"a_{k}").alias(k) for k in g], "dra", "ddec"), g, maxsep)
    moved = a.join(bulk.where("dra is not null").select(*g, F.col("dra").alias("bulk_dra"), F.col("ddec").alias("bulk_ddec")), g)
    moved = moved.withColumns({"ra": F.col("ra") - F.col("bulk_dra") / 3.6e6 / F.cos(F.radians("dec")), "dec": F.col("dec") - F.col("bulk_ddec") / 3.6e6})
    p = pair_offsets(match.radius_join(moved, b, near, g)).withColumns({"udra": F.col("dra") * 1000 + F.col("a_bulk_dra"), "uddec": F.col("ddec") * 1000 + F.col("a_bulk_ddec")})
    out = p.groupBy(*[F.col(f"a_{k}").alias(k) for k in g]).agg(F.count(F.lit(1)).alias("n"), median("udra").alias("dra"), median("uddec").alias("ddec"))
    ok = F.col("n") >= least
    return out.select(*g, "n", F.when(ok, F.col("dra")).alias("dra"), F.when(ok, F.col("ddec")).alias("ddec"))

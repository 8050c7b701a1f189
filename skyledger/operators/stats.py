"""Robust and binned statistics over groups. Percentiles are exact, with linear interpolation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.staging import staged
from . import match, quantiles
from .offset import mad_std, median


def clipped_line(df: DataFrame, keys: Sequence[str], x: str = "x", y: str = "y", rounds: int = 5, sigmas: float = 3.0, least: int = 30) -> DataFrame:
    """Line y = slope * x + intercept by fitting and up to ``rounds`` of clipping and fitting again.

    A round keeps the rows whose residual is under ``sigmas`` scaled deviations. A group stops when it keeps all its rows
    or would keep fewer than ``least``; it then has the values of its last fit. Returns keys, slope, intercept, scatter,
    n. Groups go on independently; a group of one x has null values.
    """
    g = list(keys)
    now = staged(df.select(*g, F.col(x).alias("x"), F.col(y).alias("y")), "fit")
    done: DataFrame | None = None
    for r in range(rounds + 1):
        line = now.groupBy(*g).agg(F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("intercept"), F.count(F.lit(1)).alias("n"))
        res = now.join(line, g).withColumn("r", F.col("y") - (F.col("slope") * F.col("x") + F.col("intercept")))
        stat = line.join(mad_std(res, g, "r").select(*g, F.col("r_mad").alias("scatter")), g)
        kept = res.join(stat.select(*g, "scatter"), g).groupBy(*g).agg(F.count_if(F.abs("r") < sigmas * F.col("scatter")).alias("kept"))
        # One row a group; written, so that a round's plan does not hold those of all rounds before.
        limits = staged(stat.join(kept, g).withColumn("open", (F.col("kept") < F.col("n")) & (F.col("kept") >= least) & F.lit(r < rounds)), "fit-limits")
        over = limits.where(~F.col("open")).select(*g, "slope", "intercept", "scatter", "n")
        done = over if done is None else done.unionByName(over)
        prior = limits.where("open").select(*g, F.col("slope").alias("_s"), F.col("intercept").alias("_i"), F.col("scatter").alias("_w"))
        residual = F.col("y") - (F.col("_s") * F.col("x") + F.col("_i"))
        now = now.join(prior, g).where(F.abs(residual) < sigmas * F.col("_w")).drop("_s", "_i", "_w")
    return done


def sigma_clipped(df: DataFrame, keys: Sequence[str], value: str, rounds: int = 5, sigmas: float = 3.0) -> DataFrame:
    """Mean, median and standard deviation after clipping at ``sigmas`` deviations around the median.

    Limits only narrow, so a round reads the values once and keeps what lies within the limits of all rounds before: one
    staged row a group.
    """
    g = list(keys)
    p = df.select(*g, F.col(value).alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    most = quantiles.largest(p, g)

    def stat(d: DataFrame) -> DataFrame:
        moments = [F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"), F.count(F.lit(1)).alias("n")]
        if most <= quantiles.FEW:
            return d.groupBy(*g).agg(*moments, median("v").alias("median"))
        mid = quantiles.group_quantiles(d, g, ["v"], most=most).select(*g, F.col("v").alias("median"))
        return staged(d.groupBy(*g).agg(*moments).join(mid, g) if g else d.agg(*moments).crossJoin(F.broadcast(mid)), "moments")

    s = stat(p)
    bounds = staged(s.select(*g, (F.col("median") - sigmas * F.col("std")).alias("_lo"), (F.col("median") + sigmas * F.col("std")).alias("_hi")), "clip")
    for r in range(rounds):
        s = stat(p.join(bounds, g).where((F.col("v") >= F.col("_lo")) & (F.col("v") <= F.col("_hi"))))
        if r < rounds - 1:
            x = s.join(bounds, g).select(*g, F.greatest("_lo", F.col("median") - sigmas * F.col("std")).alias("_lo"), F.least("_hi", F.col("median") + sigmas * F.col("std")).alias("_hi"))
            bounds = staged(x, "clip")
    return s


def histogram_mode(df: DataFrame, keys: Sequence[str], value: str, bins: int = 60) -> DataFrame:
    """Centre of the fullest of ``bins`` equal bins over [min, max]; the last bin is closed, the first one wins a tie."""
    g = list(keys)
    b = df.groupBy(*g).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    x = df.join(b, g).withColumn("_w", (F.col("_hi") - F.col("_lo")) / bins)
    x = x.withColumn("_i", F.when(F.col("_w") > 0, F.least(F.floor((F.col(value) - F.col("_lo")) / F.col("_w")), F.lit(bins - 1))).otherwise(0))
    n = x.groupBy(*g, "_lo", "_w", "_i").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy(*g).agg(F.max_by(F.col("_lo") + (F.col("_i") + 0.5) * F.col("_w"), F.struct(F.col("n"), -F.col("_i"))).alias("mode"), F.max("n").alias("n"))


def binned(df: DataFrame, keys: Sequence[str], x: str, y: str, width: float = 0.5, least: int = 15, bins: int = 3, positive: bool = True) -> DataFrame:
    """Median, 16th and 84th percentile and rms of y in bins of x.

    ``positive`` keeps y > 0 only (the median curve's rule; an rms curve takes all). Bins with fewer than ``least`` rows
    are dropped, groups with fewer than ``bins`` bins too.
    """
    g = list(keys)
    p = df.where(F.col(x).isNotNull() & ~F.isnan(x) & F.col(y).isNotNull() & ~F.isnan(y))
    if positive:
        p = p.where(F.col(y) > 0)
    b = p.groupBy(*g, F.floor(F.col(x) / width).alias("bin")).agg(F.percentile(y, F.array(F.lit(0.5), F.lit(0.16), F.lit(0.84))).alias("q"), F.sqrt(F.avg(F.col(y) * F.col(y))).alias("rms"), F.count(F.lit(1)).alias("n"))
    b = b.where(F.col("n") >= least).withColumn("_bins", F.count(F.lit(1)).over(W.partitionBy(*g))).where(F.col("_bins") >= bins)
    return b.select(*g, ((F.col("bin") + 0.5) * width).alias("centre"), F.col("q")[0].alias("median"), F.col("q")[1].alias("p16"), F.col("q")[2].alias("p84"), "rms", "n")


def floor_of(curve: DataFrame, keys: Sequence[str], column: str = "median") -> DataFrame:
    return curve.groupBy(*keys).agg(F.min(column).alias("floor"))


def turnover(curve: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Smallest bin centre, fainter ends left out, whose median is over twice the floor: where saturation begins."""
    g = list(keys)
    m = curve.groupBy(*g).agg(F.min("median").alias("floor"), median("centre").alias("middle"))
    hit = curve.join(m, g).groupBy(*g, "floor").agg(F.min(F.when((F.col("median") > 2 * F.col("floor")) & (F.col("centre") < F.col("middle")), F.col("centre"))).alias("turnover"))
    return hit.select(*g, "floor", "turnover")


def sky_map(df: DataFrame, keys: Sequence[str], n: int = 12, least: int = 3) -> DataFrame:
    """Median dra and ddec in n x n cells over each group's extent, x taken with cos(dec); the last bin is clamped."""
    g = list(keys)
    centre = df.groupBy(*g).agg(median("dec").alias("_d0"))
    x = df.join(centre, g).withColumn("_x", F.col("ra") * F.cos(F.radians("_d0")))
    box = x.groupBy(*g).agg(*[f(c).alias(f"_{n_}{c[-1]}") for c in ("_x", "dec") for n_, f in (("lo", F.min), ("hi", F.max))])
    x = x.join(box, g)
    cell = lambda c, lo, hi: F.least(F.floor(F.coalesce(F.try_divide(F.col(c) - F.col(lo), F.col(hi) - F.col(lo)), F.lit(0.0)) * n), F.lit(n - 1)).cast("int")
    x = x.select(*g, cell("_x", "_lox", "_hix").alias("i"), cell("dec", "_loc", "_hic").alias("j"), "dra", "ddec")
    return quantiles.group_quantiles(x, [*g, "i", "j"], ["dra", "ddec"]).where(F.col("n") >= least)


def amp90(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    return cells.groupBy(*keys).agg(F.percentile(F.hypot("dra", "ddec"), 0.9).alias("amp90"), F.count(F.lit(1)).alias("cells"))


#: Multipliers of the permutations of ranks: primes, so coprime to the number of rows of any group under 10^9.
_PRIMES = (1_000_000_007, 1_000_000_009, 1_000_000_021, 1_000_000_033, 1_000_000_087, 1_000_000_093, 1_000_000_097)


def hash_ranks(df: DataFrame, keys: Sequence[str], id_: str) -> DataFrame:
    """Rows numbered from 0 in the order of md5(id) within their group (_r), with the group's size (_m).

    The first two digits of the hash deal a group to 256 windows, whose sizes give the others their first number.
    """
    g = list(keys)
    h = F.md5(F.col(id_).cast("string"))
    x = df.withColumns({"_h": h, "_b": F.substring(h, 1, 2)})
    n = x.groupBy(*g, "_b").agg(F.count(F.lit(1)).alias("_c"))
    w = W.partitionBy(*g)
    n = n.select(*g, "_b", (F.sum("_c").over(w.orderBy("_b")) - F.col("_c")).alias("_o"), F.sum("_c").over(w).alias("_m"))
    r = F.row_number().over(W.partitionBy(*g, "_b").orderBy("_h", id_)) - 1
    return x.withColumn("_r", r).join(n, [*g, "_b"]).withColumn("_r", F.col("_r") + F.col("_o")).drop("_h", "_b", "_o")


def shuffled_null(df: DataFrame, keys: Sequence[str], id_: str = "id", permutations: int = 20, n: int = 12, least: int = 3) -> DataFrame:
    """Null of amp90 by shuffled positions: median null amplitude and p = (#(null >= amp) + 1) / (permutations + 1).

    Rows are ranked once, by a hash of their id. In permutation p the offsets of rank r meet the position of rank
    (r * prime + p * (size / permutations) + 1) modulo the group's size, for one of a few primes.
    """
    g = list(keys)
    real = amp90(sky_map(df, g, n, least), g)
    ranked = staged(hash_ranks(df.select(*g, id_, "ra", "dec", "dra", "ddec"), g, id_), "ranks")
    prime = F.element_at(F.array(*[F.lit(p) for p in _PRIMES]), (F.col("_p") % len(_PRIMES) + 1).cast("int"))
    turned = F.pmod(F.col("_r") * prime + F.col("_p") * F.floor(F.col("_m") / permutations) + 1, F.col("_m"))
    values = ranked.withColumn("_p", F.explode(F.sequence(F.lit(0), F.lit(permutations - 1)))).select(*g, "_p", "dra", "ddec", turned.alias("_r"))
    null = amp90(sky_map(values.join(ranked.select(*g, "_r", "ra", "dec"), [*g, "_r"]), [*g, "_p"], n, least), [*g, "_p"]).withColumnRenamed("amp90", "null_amp")
    x = null.join(real.select(*g, "amp90"), g)
    return x.groupBy(*g, "amp90").agg(median("null_amp").alias("null_median"), ((F.count_if(F.col("null_amp") >= F.col("amp90")) + 1) / (permutations + 1)).alias("p_value"))


def weighted_median(df: DataFrame, keys: Sequence[str], value: str, weight: str) -> DataFrame:
    """The lower one: the first value at which the cumulative weight reaches half of the total."""
    g = list(keys)
    w = W.partitionBy(*g)
    x = df.withColumn("_c", F.sum(weight).over(w.orderBy(value).rangeBetween(W.unboundedPreceding, 0))).withColumn("_t", F.sum(weight).over(w))
    return x.where(F.col("_c") >= F.col("_t") / 2).groupBy(*g).agg(F.min(value).alias(value))


def zeropoint(matched: DataFrame, keys: Sequence[str], mag: str, reference_mag: str, bright: float = 0.4, least_bright: int = 20, least: int = 50) -> DataFrame:
    """Median reference - instrumental magnitude of the bright part (all if it has under ``least_bright`` rows)."""
    g = list(keys)
    matched = staged(matched.select(*g, F.col(reference_mag).cast("double").alias("_r"), (F.col(reference_mag) - F.col(mag)).alias("zeropoint")), "matched")
    most = quantiles.largest(matched, g)
    q = quantiles.group_quantiles(matched, g, ["_r"], bright, most=most).select(*g, F.col("_r").alias("_q"), F.col("n").alias("n_matched"))
    x = matched.join(q, g).withColumn("_b", F.col("_r") <= F.col("_q"))
    # How many are bright is summed up a group, and not looked over in a window that holds it.
    n = x.groupBy(*g).agg(F.count_if("_b").alias("_nb"))
    x = x.join(n, g).where(F.col("_b") | (F.col("_nb") < least_bright))
    z = quantiles.group_quantiles(x, [*g, "n_matched"], ["zeropoint"], most=most).withColumnRenamed("n", "n_used")
    return z.select(*g, "n_matched", "n_used", F.when(F.col("n_matched") >= least, F.col("zeropoint")).alias("zeropoint"))


def detector_residuals(pairs: DataFrame, field: str, detector: str, least: int = 50) -> DataFrame:
    """Median residual of each detector against its field's median, with scatter, the field's worst detector and the
    difference of its modules' means (A - B; null where one is missing).

    pairs has dra and ddec in mas. Detectors, named nrca1 to nrcblong, with fewer than ``least`` pairs are left out.
    """
    g = [field, detector]
    x = pairs.select(*g, "dra", "ddec")
    m = mad_std(x, g, "dra", "ddec", count="n").where(F.col("n") >= least)
    f = m.groupBy(field).agg(median("dra_med").alias("_fx"), median("ddec_med").alias("_fy"))
    m = m.join(f, field).select(*g, "n", (F.col("dra_med") - F.col("_fx")).alias("dra"), (F.col("ddec_med") - F.col("_fy")).alias("ddec"), F.hypot("dra_mad", "ddec_mad").alias("scatter"))
    # Ties go to the first detector by name: fewer than a dozen rows a field are sorted.
    w = W.partitionBy(field)
    worst = F.first(detector).over(w.orderBy(F.hypot("dra", "ddec").desc(), detector).rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    side = F.upper(F.substring(detector, 4, 1))
    gap = lambda c: F.avg(F.when(side == "A", F.col(c))).over(w) - F.avg(F.when(side == "B", F.col(c))).over(w)
    return m.withColumns({"worst": worst, "module_dra": gap("dra"), "module_ddec": gap("ddec")})


def sky_groups(detections: DataFrame, keys: Sequence[str], tol: float, order: Sequence[str]) -> DataFrame:
    """Detections grouped as if taken one by one in ``order``: each that is not in a group yet opens one and takes all
    others within ``tol`` arcseconds that are in none. Adds ``leader``, the id of the one that opened the group.

    Pairs are joined once and staged. In a round a detection looks at its first neighbour before it that leads or is
    undecided: without any it leads itself, one that leads takes it, else it waits. Each round decides at least the first
    of those that are left.
    """
    g = list(keys)
    d = detections.withColumn("_o", F.struct(*order, "id"))
    k = [F.col(f"a_{c}").alias(c) for c in g]
    slim = d.select(*g, "id", "ra", "dec", "_o")
    pairs = match.radius_join(slim, slim, tol, g).where("a_id <> b_id")
    pairs = pairs.where(F.col("b__o") < F.col("a__o"))
    pairs = staged(pairs.select(*k, F.col("a_id").alias("id"), F.col("b_id").alias("other"), F.col("b__o").alias("_oo")), "near")
    node = [*g, "id"]
    open_, out = staged(d.select(*node), "open"), None
    while open_.limit(1).count():
        state = open_.withColumn("leads", F.lit(False))
        if out is not None:
            state = state.unionByName(out.where("id = leader").select(*node, F.lit(True).alias("leads")))
        live = pairs.join(open_, node, "left_semi").join(state.withColumnRenamed("id", "other"), [*g, "other"])
        first = live.groupBy(*node).agg(F.min_by(F.struct("other", "leads"), "_oo").alias("_f"))
        x = open_.join(first, node, "left").select(*node, F.when(F.col("_f").isNull(), F.col("id")).when(F.col("_f.leads"), F.col("_f.other")).alias("leader"))
        settled = staged(x.where("leader is not null"), "settled")
        out = settled if out is None else out.unionByName(settled)
        open_ = staged(open_.join(settled, node, "left_anti"), "open")
    return detections.withColumn("leader", F.col("id")) if out is None else detections.join(out, node)


def frame_scatter(detections: DataFrame, keys: Sequence[str], tol: float = 0.04, exposures: int = 3, brightest: int = 2000, fewest: int = 20, most_exposures: int = 12, least: int = 50) -> DataFrame:
    """Scatter between frames: sqrt((var ra * cos dec) + var dec) / sqrt(2) in mas and the median magnitude of each group
    of detections that ``exposures`` distinct exposures share.

    detections: keys, exposure, frame, id, ra, dec, mag. Of each frame the ``brightest`` count, and none if there are fewer
    than ``fewest``; of a key's exposures the first ``most_exposures`` by name. Groups are taken in the order of exposure,
    frame and magnitude, see sky_groups. A key with fewer than ``least`` groups, or fewer detections, has no rows.
    """
    g = list(keys)
    x = match.finite(detections, "ra", "dec", "mag")
    first = x.select(*g, "exposure").distinct().withColumn("_e", F.row_number().over(W.partitionBy(*g).orderBy("exposure"))).where(F.col("_e") <= most_exposures).drop("_e")
    x = x.join(first, [*g, "exposure"], "left_semi")
    f = W.partitionBy(*g, "exposure", "frame")
    x = x.withColumns({"_r": F.row_number().over(f.orderBy("mag", "id")), "_n": F.count(F.lit(1)).over(f)}).where((F.col("_r") <= brightest) & (F.col("_n") >= fewest)).drop("_r", "_n")
    x = staged(x, "detections")
    size = x.groupBy(*g).agg(F.count(F.lit(1)).alias("_n"), median("dec").alias("_d0")).where(F.col("_n") >= least)
    x = sky_groups(x.join(size.drop("_n"), g), g, tol, ["exposure", "frame", "mag"])
    rms = F.hypot(F.stddev_pop("ra") * F.cos(F.radians(F.first("_d0"))), F.stddev_pop("dec")) * 3.6e6 / F.sqrt(F.lit(2.0))
    m = x.groupBy(*g, "leader").agg(F.count_distinct("exposure").alias("n_exposures"), median("mag").alias("mag"), rms.alias("scatter"))
    m = m.where((F.col("n_exposures") >= exposures) & (F.col("scatter") > 0))
    n = m.groupBy(*g).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least)
    return m.join(n.drop("_n"), g)


def repeatability(df: DataFrame) -> Column:
    """Internal repeatability in mas of std_ra, std_dec (degrees) at dec."""
    return F.hypot(F.col("std_ra") * F.cos(F.radians("dec")), F.col("std_dec")) * 3.6e6 / F.sqrt(F.lit(2.0))


def exposure_quality(frames: DataFrame, exposure: Sequence[str], mag: str, qfit: str, bright: float = 0.2, least_rows: int = 50, least: int = 30) -> DataFrame:
    """Median quality of fit of each exposure's brightest part (strictly under the quantile)."""
    g = list(exposure)
    q = frames.groupBy(*g).agg(F.percentile(mag, bright).alias("_q"), F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least_rows)
    x = frames.join(q, g).where(F.col(mag) < F.col("_q"))
    return x.groupBy(*g).agg(median(qfit).alias("quality"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def streaked(quality: DataFrame, keys: Sequence[str], times: float = 2.0) -> DataFrame:
    """Exposures whose quality is over ``times`` the median over exposures."""
    m = quality.groupBy(*keys).agg(median("quality").alias("typical"))
    return quality.join(m, list(keys)).withColumn("streaked", F.col("quality") > times * F.col("typical"))


def nan_accounting(df: DataFrame, expected: DataFrame, keys: Sequence[str], value: str, least: int = 50) -> DataFrame:
    """Rows, missing values and their fraction for every expected group; absent is not the same as dead."""
    g = list(keys)
    miss = F.col(value).isNull() | F.isnan(value)
    n = df.groupBy(*g).agg(F.count(F.lit(1)).alias("n_raw"), F.count_if(miss).alias("n_nan"))
    x = expected.join(n, g, "left").fillna(0, ["n_raw", "n_nan"])
    return x.select(
        *g, "n_raw", "n_nan", F.try_divide("n_nan", "n_raw").alias("nan_fraction"), (F.col("n_raw") > 0).alias("present"), ((F.col("n_raw") > 0) & (F.col("n_raw") - F.col("n_nan") < least)).alias("dead")
    )


def density(df: DataFrame, keys: Sequence[str], x: str, y: str, xw: float, yw: float, weight: str) -> DataFrame:
    return df.groupBy(*keys, F.floor(F.col(x) / xw).alias("i"), F.floor(F.col(y) / yw).alias("j")).agg(F.count(F.lit(1)).alias("n"), F.sum(weight).alias("weight"))


def magnitude_counts(df: DataFrame, keys: Sequence[str], mag: str, width: float = 0.5) -> DataFrame:
    """Counts in bins of magnitude and the middle of the group's fullest bin (the brighter one on a tie)."""
    g = list(keys)
    n = df.groupBy(*g, F.floor(F.col(mag) / width).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    peak = F.max_by(F.col("bin"), F.struct(F.col("n"), -F.col("bin"))).over(W.partitionBy(*g))
    return n.select(*g, ((F.col("bin") + 0.5) * width).alias("centre"), "n", ((peak + 0.5) * width).alias("peak"))


def formal_precision(frames: DataFrame, keys: Sequence[str], excluded: Column | None = None, combined: str | None = None, least: int = 50) -> DataFrame:
    """hypot(x_err, y_err) * scale / sqrt(2) in mas; combined lists are skipped where exposures are excluded."""
    x = frames.where(F.col("x_err").isNotNull() & F.col("y_err").isNotNull() & ~F.isnan("x_err") & ~F.isnan("y_err"))
    if combined is not None and excluded is not None:
        x = x.where(~(F.col(combined) & excluded))
    value = F.hypot("x_err", "y_err") * F.col("scale") / F.sqrt(F.lit(2.0))
    x = x.withColumn("precision", value).withColumn("_n", F.count(F.lit(1)).over(W.partitionBy(*keys)))
    return x.where(F.col("_n") >= least).drop("_n")


def external_curve(pairs: DataFrame, keys: Sequence[str], least: int = 50, **bins) -> DataFrame:
    """Binned rms of residuals against a reference: pairs with dra, ddec (mas) and mag, group medians removed, / sqrt(2)."""
    g = list(keys)
    m = pairs.groupBy(*g).agg(median("dra").alias("_x"), median("ddec").alias("_y"), F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least)
    r = pairs.join(m, g).select(*g, "mag", (F.hypot(F.col("dra") - F.col("_x"), F.col("ddec") - F.col("_y")) / F.sqrt(F.lit(2.0))).alias("r"))
    return binned(r, g, "mag", "r", positive=False, **bins)



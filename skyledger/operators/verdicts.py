"""Composite verdicts: one row an observation (or field), with the numbers they rest on and whether it passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..sources.staging import staged
from . import grid, inventory, match, offset, quantiles, stats


def interfilter(pairs: DataFrame, keys: Sequence[str], least: int = 200, far: float = 20.0, least_sn: float = 10.0) -> DataFrame:
    """Residuals between two bands (dra, ddec in mas; S/N sn_a and sn_b over ``least_sn`` in both), the group's median
    removed: rms and share beyond ``far``."""
    g = list(keys)
    p = staged(pairs.where((F.col("sn_a") > least_sn) & (F.col("sn_b") > least_sn)).select(*g, "dra", "ddec"), "bands")
    m = quantiles.group_quantiles(p, g, ["dra", "ddec"], most=quantiles.largest(p, g)).select(*g, F.col("dra").alias("_x"), F.col("ddec").alias("_y"), F.col("n").alias("_n")).where(F.col("_n") >= least)
    r = F.hypot(F.col("dra") - F.col("_x"), F.col("ddec") - F.col("_y"))
    x = p.join(m, g).withColumn("r", r)
    return x.groupBy(*g).agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(F.col("r") * F.col("r"))).alias("rms"), F.avg((F.col("r") > far).cast("double")).alias("far"))


def images(files: DataFrame, keys: Sequence[str], module: str = "module") -> DataFrame:
    """(keys, filter) that have an image: a merged one, or that of one module if the observation has only one.

    ``module`` is 'A', 'B' or 'merged'. An observation has two modules if any of its filters is merged or has both; a filter
    of it with one module's image is half delivered, and both modules without a merged image are not merged yet.
    """
    g = list(keys)
    has = lambda m: F.bool_or(F.col(module) == m).alias(f"_{m}")
    x = files.where(F.col(module).isNotNull()).groupBy(*g, "filter").agg(has("merged"), has("A"), has("B"))
    two = x.groupBy(*g).agg(F.bool_or(F.col("_merged") | (F.col("_A") & F.col("_B"))).alias("_two"))
    return x.join(two, g).where(F.col("_merged") | ((F.col("_A") != F.col("_B")) & ~F.col("_two"))).select(*g, "filter")


def presence(nominal: DataFrame, images_: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stage 1: an image (see images) in the short channel, and in the long one if the observation has a long band."""
    g = list(keys)
    n = nominal.select(*g, "filter").distinct().join(images_.select(*g, "filter", F.lit(True).alias("_have")).distinct(), [*g, "filter"], "left").withColumn("channel", S.channel(F.col("filter")))
    have = F.coalesce("_have", F.lit(False))
    x = n.groupBy(*g).agg(
        F.count_if((F.col("channel") == "SW") & have).alias("sw"), F.count_if((F.col("channel") == "LW") & have).alias("lw"), F.count_if(F.col("channel") == "LW").alias("_lw"), F.count_if(~have).alias("missing")
    )
    return x.select(*g, "sw", "lw", "missing", ((F.col("sw") > 0) & ((F.col("lw") > 0) | (F.col("_lw") == 0))).alias("passed"))


def colour_magnitude(colours: DataFrame, bands: DataFrame, keys: Sequence[str], least: int = 500, least_high: int = 50) -> DataFrame:
    """Stage 2: over ``least`` sources. colours: mag, colour and high (S/N in both bands); bands: the filters of a group.

    The high-S/N sources are used only if there are ``least_high``. A group without a long band at all has a luminosity function
    in place of colours (single_filter), its mode over 60 bins; one that has a long band but no colours does not pass.
    """
    g = list(keys)
    b = bands.groupBy(*g).agg((~F.bool_or(S.channel(F.col("filter")) == "LW")).alias("single_filter"))
    have = F.when(F.col("single_filter"), F.col("mag").isNotNull() & ~F.isnan("mag")).otherwise(F.col("colour").isNotNull())
    c = colours.join(b, g).where(have)
    n = c.groupBy(*g).agg(F.count_if("high").alias("_h"))
    c = c.join(n, g).where(F.col("single_filter") | (F.col("_h") < least_high) | F.col("high"))
    c = staged(c.select(*g, "single_filter", "mag", "colour"), "colours")
    s = c.groupBy(*g).agg(F.count(F.lit(1)).alias("n"))
    colour = quantiles.group_quantiles(c.where("not single_filter"), g, ["colour"]).drop("n")
    mode = stats.histogram_mode(c.where("not single_filter"), g, "mag", 50).unionByName(stats.histogram_mode(c.where("single_filter"), g, "mag", 60)).select(*g, "mode")
    x = b.join(s, g, "left").join(colour, g, "left").join(mode, g, "left")
    return x.select(*g, "single_filter", F.coalesce("n", F.lit(0)).alias("n"), "colour", "mode", (F.coalesce("n", F.lit(0)) > least).alias("passed"))


def calibration(matched: DataFrame, keys: Sequence[str], x: str, y: str, least: int = 30) -> DataFrame:
    """Stage 3: slope near one and small scatter of a clipped line."""
    g = list(keys)
    n = matched.groupBy(*g).agg(F.count(F.lit(1)).alias("n_matched"))
    f = n.join(stats.clipped_line(matched, g, x, y), g, "left")
    ok = (F.col("n_matched") >= least) & (F.col("slope") > 0.8) & (F.col("slope") < 1.2) & (F.col("scatter") < 0.8)
    return f.select(*g, "n_matched", "slope", "intercept", "scatter", F.coalesce(ok, F.lit(False)).alias("passed"))


def registration(stars: DataFrame, reference: DataFrame, keys: Sequence[str], modules: DataFrame | None = None, gate: float = 75.0, module_gate: float = 15.0, clear: float = 4.0) -> DataFrame:
    """Stage 4: the larger of the cells' and the same stars' offset is under ``gate``, cells agree and cover, and the modules
    (keys, off; see offset.module_offset) are less than ``module_gate`` apart where both are measured.

    The same stars count only where the bulk offset is small and its peak clear. A map whose cells scatter beyond 300 mas
    though 50 isolated stars are clean is not trusted: the whole field's offset stands in if its peak is ``clear``, with no cells
    to agree; else the isolated stars' is shown and the stage cannot pass. A field measured as one cell has no consistency to
    judge. low_confidence: the cells and the isolated stars are over 50 mas apart, on a trusted map.
    """
    g = list(keys)
    # Each part is staged, so that the driver never plans them all at once.
    cells = grid.adaptive_grid(stars, reference, g)
    used = cells.groupBy(*g).agg(F.first("grid").alias("grid"))
    agree = grid.consistency(cells, g).select(*g, F.col("dra").alias("cell_dra"), F.col("ddec").alias("cell_ddec"), F.col("off").alias("cell_off"), "spread", "coverage", "consistent")
    agree = staged(agree, "agree")
    bulk = staged(offset.bulk_offset(stars, reference, g), "bulk")
    slim = [x.select(*g, "id", "ra", "dec") for x in (stars, reference)]
    same = offset.pair_offsets(match.mutual_nearest(match.radius_join(*slim, 0.3, g), [f"a_{k}" for k in g]))
    same = same.select(*[F.col(f"a_{k}").alias(k) for k in g], "dra", "ddec")
    tie = staged(offset.same_star_offset(same, g, bulk=bulk).select(*g, F.col("off").alias("same_off")), "same-stars")
    lone = offset.isolated_bulk(stars, reference, g).select(*g, F.col("dra").alias("lone_dra"), F.col("ddec").alias("lone_ddec"), F.col("off").alias("isolated_off"), "n_clean")
    lone = staged(lone, "isolated-bulk")
    modules = None if modules is None else staged(modules.select(*g, "off"), "modules")
    x = used.join(agree, g, "left").join(bulk.select(*g, F.col("off").alias("bulk_off"), "peak_ratio"), g, "left").join(tie, g, "left").join(lone, g, "left")
    x = x.join(modules.select(*g, F.col("off").alias("module_off")), g, "left") if modules is not None else x.withColumn("module_off", F.lit(None).cast("double"))
    trusted = ~F.coalesce((F.col("spread") > 300) & (F.col("n_clean") >= 50), F.lit(False))
    whole = F.col("bulk_off").isNotNull() & (F.col("peak_ratio") >= clear)
    gated = F.when(trusted, F.greatest("cell_off", "same_off")).when(whole, F.col("bulk_off"))
    even = ~trusted | (F.col("grid") == 1) | F.col("consistent")
    ok = (gated < gate) & even & (F.col("coverage") >= 0.5) & (F.col("module_off").isNull() | (F.col("module_off") < module_gate))
    low = trusted & (F.hypot(F.col("cell_dra") - F.col("lone_dra"), F.col("cell_ddec") - F.col("lone_ddec")) > 50)
    return x.select(
        *g, "grid", "cell_off", "same_off", "bulk_off", "isolated_off", "module_off", "spread", "coverage", "consistent", F.coalesce(gated, "isolated_off").alias("off"),
        gated.isNull().alias("unmeasurable"), F.coalesce(low, F.lit(False)).alias("low_confidence"), F.coalesce(ok, F.lit(False)).alias("passed"),
    )


def intermodule(overlap: DataFrame, missing: DataFrame, keys: Sequence[str], limit: float = 15.0, nan_limit: float = 0.05) -> DataFrame:
    """Stage 5: one module, or an overlap under ``limit`` mas; few missing values; a dead module is a red flag."""
    g = list(keys)
    m = missing.groupBy(*g).agg(F.count_if("present").alias("modules"), F.max("nan_fraction").alias("nan_fraction"), F.bool_or("dead").alias("red_flag"))
    x = m.join(overlap.select(*g, "off"), g, "left")
    ok = ((F.col("modules") < 2) | (F.col("off") < limit)) & (F.col("nan_fraction") <= nan_limit)
    return x.select(*g, "modules", "off", "nan_fraction", "red_flag", F.coalesce(ok, F.lit(False)).alias("passed"))


def precision(curves: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stage 6: floors of the curves (kind: formal, empirical); an empirical floor overrides the formal one."""
    f = stats.floor_of(curves, [*keys, "kind"]).groupBy(*keys).pivot("kind", ["formal", "empirical"]).agg(F.first("floor"))
    return f.select(*keys, "formal", "empirical", F.coalesce("empirical", "formal").alias("floor"), F.coalesce("empirical", "formal").isNotNull().alias("passed"))


def precision_with_and_without(measured: DataFrame, flagged: DataFrame, keys: Sequence[str], name: str, value: str = "value", mag: str = "mag") -> DataFrame:
    """Stage 6 with all exposures and without the streaked ones, by one scan and one set of aggregates.

    measured: keys, kind (formal or empirical), mag, value and a ``name`` whose last two tokens are the exposure's;
    flagged: tokens (keys, token) as inventory.exposure_token makes them. Every row is in the variant "all", those of exposures
    that are not flagged in "clean" too. clean_floor is null where no exposure is flagged.
    """
    g = list(keys)
    bad = flagged.select(*g, F.col("token").alias("_token"), F.lit(True).alias("_bad")).distinct()
    x = measured.withColumn("_token", inventory.exposure_token(F.col(name))).join(bad, [*g, "_token"], "left")
    x = x.select(*g, "kind", mag, value, F.explode(F.array_compact(F.array(F.lit("all"), F.when(F.col("_bad").isNull(), "clean")))).alias("variant"))
    p = precision(stats.binned(x, [*g, "variant", "kind"], mag, value), [*g, "variant"])
    n = flagged.groupBy(*g).agg(F.count_distinct("token").alias("excluded"))
    of = lambda v, c: F.max(F.when(F.col("variant") == v, F.col(c)))
    wide = p.groupBy(*g).agg(*[of("all", c).alias(c) for c in ("formal", "empirical", "floor")], of("clean", "floor").alias("clean_floor"))
    x = wide.join(n, g, "left").withColumn("excluded", F.coalesce("excluded", F.lit(0)))
    return x.select(*g, "formal", "empirical", "floor", "excluded", F.when(F.col("excluded") > 0, F.col("clean_floor")).alias("clean_floor"), F.col("floor").isNotNull().alias("passed"))


def against_archive(ours: DataFrame, theirs: DataFrame, keys: Sequence[str], slack: float = 5.0) -> DataFrame:
    """Stage 7: our offset is at most ``slack`` mas over the archive's, or one of them is unmeasured; ours unmeasured is a red flag."""
    g = list(keys)
    x = ours.select(*g, F.col("off").alias("ours"), "has_image").join(theirs.select(*g, F.col("off").alias("theirs")), g, "left")
    ok = F.col("has_image") & F.col("ours").isNotNull() & (F.col("theirs").isNull() | (F.col("ours") <= F.col("theirs") + slack))
    return x.select(*g, "ours", "theirs", F.coalesce(F.col("ours") < F.col("theirs"), F.lit(False)).alias("tighter"), F.col("ours").isNull().alias("red_flag"), ok.alias("passed"))


def distortion(pairs: DataFrame, keys: Sequence[str], groups: DataFrame | None = None, limit: float = 15.0, least: int = 3, far: float = 20.0, id_: str = "id") -> DataFrame:
    """Stage 8: amplitude of the residual map in mas against its shuffled null, from pairs (id, ra, dec, dra, ddec).

    Passes with at least ``least`` cells, whatever the amplitude, which is a red flag over ``limit``. significance is the amplitude
    over the null's median, infinite where that is 0; a map without cells has amplitude 0 and no null. Keys of ``groups`` (all that
    should be looked at) without pairs are not applicable: measurable is false and passed null, which is no defect.
    """
    g = list(keys)
    x = staged(pairs.select(*g, id_, "ra", "dec", "dra", "ddec"), "residuals")
    cells = staged(stats.sky_map(x, g, least=least), "cells")
    a = cells.groupBy(*g).agg(F.percentile(F.hypot("dra", "ddec"), 0.9).alias("_amp"), F.count(F.lit(1)).alias("_cells"), F.percentile("n", 0.5).alias("_per_cell"))
    spread = offset.mad_std(x, g, "dra", "ddec", count="n_stars").select(*g, "n_stars", F.hypot("dra_mad", "ddec_mad").alias("resid_rms"))
    tail = x.groupBy(*g).agg(F.avg((F.hypot("dra", "ddec") > far).cast("int")).alias("frac_far"))
    null = stats.shuffled_null(x, g, id_, least=least).select(*g, F.col("null_median").alias("null_amp"), "p_value")
    out = spread.join(tail, g).join(a, g, "left").join(null, g, "left").withColumn("measurable", F.lit(True))
    if groups is not None:
        out = groups.select(*g).distinct().join(out, g, "left")
    seen = F.coalesce("measurable", F.lit(False))
    amp, n, per = F.when(seen, F.coalesce("_amp", F.lit(0.0))), F.when(seen, F.coalesce("_cells", F.lit(0))), F.when(seen, F.coalesce("_per_cell", F.lit(0.0)))
    return out.select(
        *g,
        "n_stars",
        "resid_rms",
        "frac_far",
        amp.alias("amp90"),
        n.cast("long").alias("cells"),
        per.alias("stars_per_cell"),
        (F.col("resid_rms") / F.sqrt(F.greatest(per, F.lit(1.0)))).alias("cell_sem"),
        "null_amp",
        F.when(F.col("null_amp") > 0, amp / F.col("null_amp")).when(F.col("null_amp").isNotNull(), F.lit(float("inf"))).alias("significance"),
        "p_value",
        F.coalesce(amp > limit, F.lit(False)).alias("red_flag"),
        seen.alias("measurable"),
        (n >= least).alias("passed"),
    )


def photometry(checks: DataFrame) -> DataFrame:
    """Stage 9 from pixels.psf_against_aperture: scatter under 0.15 mag and a tail under 5 %; unmeasurable is a red flag."""
    passed = F.coalesce((F.col("scatter") < 0.15) & (F.col("tail") < 0.05), F.lit(False))
    return checks.withColumns({"red_flag": F.col("reason").isNotNull(), "passed": passed})


def multi_exposure(curve: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stage 10: floors and the saturation turnover; passes whenever it can be measured."""
    return stats.turnover(curve, keys).withColumn("passed", F.col("floor").isNotNull())


def exposures(quality: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stage 11: no streaked exposure."""
    x = stats.streaked(quality, keys)
    worst = F.max_by("exposure", F.struct("quality", -F.col("exposure")))
    return x.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_if("streaked").alias("n_streaked"), worst.alias("worst")).withColumn("passed", F.col("n_streaked") == 0)


def mid_infrared(fractions: DataFrame, keys: Sequence[str], least: float = 0.2) -> DataFrame:
    """Stage 12: enough finite pixels."""
    return fractions.groupBy(*keys).agg(F.max("finite").alias("finite"), F.max("saturated").alias("saturated")).withColumn("passed", F.col("finite") > least)


#: Fixed values of the audit's flags, in mas.
MODULE_FLAG, FILTER_FLAG, ABSOLUTE_FLAG = 15.0, 30.0, 75.0


def channel_anchor(detections: DataFrame, keys: Sequence[str], least_pairs: int = 5000, least_ratio: float = 4.0) -> DataFrame:
    """In each channel the band with most detections is the anchor; the others' offsets from it, flagged beyond 30 mas
    if the peak is clear and rests on many pairs. Groups with one band have none."""
    g = [*keys, "channel"]
    d = detections.withColumn("channel", S.channel(F.col("filter")))
    n = d.groupBy(*g, "filter").agg(F.count(F.lit(1)).alias("_n"))
    a = n.groupBy(*g).agg(F.max_by("filter", F.struct("_n", "filter")).alias("anchor"), F.count(F.lit(1)).alias("_bands")).where("_bands >= 2").drop("_bands")
    x = d.join(a, g)
    pairs = offset.pair_offsets(match.radius_join(x.where("filter <> anchor"), x.where("filter = anchor"), 2.5, g))
    o = offset.xcorr(pairs.select(*[F.col(f"a_{k}").alias(k) for k in (*g, "filter", "anchor")], "dra", "ddec"), [*g, "filter", "anchor"])
    return o.withColumn("flagged", F.coalesce((F.col("off") > FILTER_FLAG) & (F.col("peak_ratio") >= least_ratio) & (F.col("npairs") >= least_pairs), F.lit(False)))


def field_audit(modules: DataFrame, bands: DataFrame, absolute: DataFrame, key: str) -> DataFrame:
    """Flags of a field: modules over 15 mas, any band flagged, absolute offset over 75 mas."""
    b = bands.groupBy(key).agg(F.bool_or("flagged").alias("_b"))
    x = absolute.select(key, F.col("off").alias("absolute")).join(modules.select(key, F.col("off").alias("modules")), key, "left").join(b, key, "left")
    flag = lambda c, name: F.when(F.coalesce(c, F.lit(False)), name)
    flags = F.array_compact(F.array(flag(F.col("modules") > MODULE_FLAG, "modules"), flag(F.col("_b"), "filters"), flag(F.col("absolute") > ABSOLUTE_FLAG, "absolute")))
    return x.select(key, "absolute", "modules", flags.alias("flags"))


def whole_field(bulk: DataFrame, isolated: DataFrame, keys: Sequence[str], limit: float = 50.0) -> DataFrame:
    """Whole-field offset with the isolated one beside it; low confidence if they are over ``limit`` mas apart."""
    g = list(keys)
    bulk = staged(bulk.select(*g, "dra", "ddec", "off", "peak_ratio"), "bulk")
    x = bulk.join(staged(isolated.select(*g, F.col("dra").alias("_x"), F.col("ddec").alias("_y")), "isolated-bulk"), g, "left")
    apart = F.hypot(F.col("dra") - F.col("_x"), F.col("ddec") - F.col("_y"))
    return x.select(*g, "off", "peak_ratio", apart.alias("apart"), F.coalesce(apart > limit, F.lit(False)).alias("low_confidence"))


def verdict_rows(stages: dict[str, DataFrame], key: str) -> DataFrame:
    """One long table (key, stage, passed) of all stages' verdicts."""
    out: DataFrame | None = None
    for name, df in stages.items():
        x = df.select(key, F.lit(name).alias("stage"), F.col("passed"))
        out = x if out is None else out.unionByName(x)
    assert out is not None
    return out


def all_pass(rows: DataFrame, key: str) -> DataFrame:
    p: Column = F.coalesce("passed", F.lit(True))
    return rows.groupBy(key).agg(F.every(p).alias("passed"), F.array_sort(F.collect_set(F.when(~p, F.col("stage")))).alias("failed"))



"""Edge cases of filters, file choices and gates."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.functions import scalars
from skyledger.operators import gates, inventory, offset, select, stats, verdicts
from skyledger.sources import io


def test_position_valid_keeps_small_groups_uncut(spark):
    df = spark.createDataFrame([("a", 0.01)] * 29 + [("a", 0.2)] * 3 + [("b", 0.05)] * 30 + [("b", 0.0501)], "g string, sep double")
    got = select.position_valid(df, "sep", ["g"]).groupBy("g", "label").count().collect()
    assert {(r.g, r.label, r["count"]) for r in got} == {("a", "uncut", 32), ("b", "position valid", 30)}
    assert select.position_valid(df.drop("sep"), "sep", ["g"]).count() == df.count()


def test_signal_cut_is_strict_and_takes_zero_errors(spark):
    df = spark.createDataFrame([(10.0, 1.0), (10.1, 1.0), (5.0, 0.0), (None, 1.0)], "flux double, err double")
    assert [r.flux for r in select.signal_cut(df, [("flux", "err"), ("x", "y")]).collect()] == [10.1]


def test_scope_never_takes_another_observation(spark):
    f = spark.createDataFrame([("a", "001", 1), ("a", None, 2), ("b", "002", 3), ("b", None, 4), ("c", "002", 5)], "band string, token string, k int")
    assert {r.k for r in select.scope_to_obs(f, "token", F.lit("001"), ["band"]).collect()} == {1, 4}


def test_best_catalogue_order(spark):
    f = spark.createDataFrame([("b", "x_m8_dedup.fits", 1), ("b", "x_m7.fits", 9), ("c", "b.fits", 5), ("c", "a.fits", 5), ("c", "z.fits", 4)], "band string, name string, mtime int")
    assert {(r.band, r.name) for r in inventory.best_catalogue(f, ["band"]).collect()} == {("b", "x_m8_dedup.fits"), ("c", "a.fits")}


def test_layout_tie_goes_to_the_newer(spark):
    f = spark.createDataFrame([("d", "pipeline", "a", 1), ("d", "flat", "b", 2), ("e", "pipeline", "a", 3), ("e", "flat", "a", 2)], "det string, folder string, name string, mtime int")
    got = {r.det: (r.layout, r.total, r.split) for r in inventory.layout_choice(f, ["det"], "folder", "name", "mtime").collect()}
    assert got == {"d": ("flat", 2, True), "e": ("pipeline", 1, False)}


SCHEMA = "path string, tree boolean, pass boolean, state string, png_sha string, jpg_sha string, source_sha string"


def gate(spark, verdicts, star=False, unbound=False, images=(("a/b/c.png", "h"),)):
    i = spark.createDataFrame(list(images), "path string, sha string").withColumn("page", F.lit(1))
    c = gates.covering_verdicts(i, spark.createDataFrame(verdicts, SCHEMA))
    r = gates.release_gate(c, ["page"], F.lit(star), F.lit(unbound)).first()
    return r.ok, r.reasons


def own(ok=True, state="pass", sha="h"):
    return ("a/b/c.validation.json", False, ok, state, sha, "no", None)


def tree(root="a", ok=True, state="pass", sha="t", source="t"):
    return (root, True, ok, state, sha, None, source)


@pytest.mark.parametrize(
    "verdicts, star, unbound, want",
    [
        ([], True, True, (False, "no verdict")),
        ([own()], False, False, (True, "")),
        ([own(ok=False)], True, True, (False, "validation failed")),
        ([own(ok=None)], True, True, (False, "validation failed")),
        ([own(state="fail")], True, True, (False, "star check failed")),
        ([own(state="skipped")], False, False, (False, "star check skipped")),
        ([own(state="absent")], False, False, (False, "star check absent")),
        ([own(state=None)], False, False, (False, "star check absent")),
        ([own(state="skipped")], True, False, (True, "")),
        ([own(state="absent")], True, False, (True, "")),
        ([own(state="odd")], True, True, (False, "star check failed")),
        ([own(sha=None)], True, True, (False, "verdict without hash")),
        ([own(sha="old")], True, True, (False, "verdict of other bytes")),
        ([tree()], False, False, (True, "")),
        ([tree(source="u")], True, True, (False, "tree verdict of other bytes")),
        ([tree(source=None)], True, False, (False, "tree verdict unbound")),
        ([tree(sha=None)], True, False, (False, "tree verdict unbound")),
        ([tree(source=None)], False, True, (True, "")),
        ([tree("z")], True, True, (False, "no verdict")),
        # Any covering verdict may let an image out, near or far.
        ([own(sha="old"), tree()], False, False, (True, "")),
        ([tree("a/b", ok=False), tree("a")], False, False, (True, "")),
        ([tree("a/b", ok=False), tree("a", state="fail")], True, True, (False, "star check failed; validation failed")),
    ],
)
def test_release_gate_fails_closed(spark, verdicts, star, unbound, want):
    assert gate(spark, verdicts, star, unbound) == want


def test_release_gate_binds_each_kind_of_image_and_refuses_no_images(spark):
    both = [("a/b/c.png", "no"), ("a/b/c.jpg", "no")]
    assert gate(spark, [("a/b/c.validation.json", False, True, "pass", "no", "no", None)], images=both) == (True, "")
    assert gate(spark, [("a/b/c.validation.json", False, True, "pass", "no", "other", None)], images=both) == (False, "verdict of other bytes")
    i = spark.createDataFrame([], "path string, sha string, page int")
    c = gates.covering_verdicts(i, spark.createDataFrame([own()], SCHEMA))
    r = gates.release_gate(c, ["page"], F.lit(True), expected=spark.createDataFrame([(7,)], "page int")).collect()
    assert [(x.page, x.ok, x.reasons, x.n) for x in r] == [(7, False, "no images", 0)]


def test_literal_rules(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    text = "12345\n12346;nova\nSubmitted batch job 777\njobid: 5\n12345\n"
    assert one(scalars.job_ids(F.lit(text))) == ["12345", "12346", "777"]
    assert one(scalars.job_ids(F.lit(None).cast("string"))) == []
    assert one(scalars.download_key(F.lit(2221), F.lit("002"), F.lit(""))) == "2221-o002-NIRCam"
    assert one(scalars.download_key(F.lit(2221), F.lit("002"), F.lit("MIRI"))) == "2221-o002-MIRI"
    assert one(scalars.trigger_key(F.lit(2221), F.lit("002"))) == "2221-o002"
    assert one(scalars.downgrade_class(F.lit("CAPPED \u2014 5"))) == "CAPPED" and one(scalars.downgrade_class(F.lit("SEED RUN"))) is None
    assert [one(scalars.midpoint_band(F.lit(f))) for f in ("F1280W", "F1500W", "F212N")] == ["8um", "24um", None]
    assert one(scalars.source_label(F.lit("release x_M7.fits"), "p")) == "p m7" and one(scalars.source_label(F.lit(""), "p")) == "p catalogue"
    names = spark.createDataFrame([("cat_M5.fits", 5), ("x_m8_dedup_cat.fits", 8), ("x_m12.fits", 0), ("x_m4-v2", 4)], "name string, tier int")
    assert names.where(scalars.catalogue_tier(F.col("name")) != F.col("tier")).count() == 0
    lines = spark.createDataFrame([(" Brick \u2014 jw02221-o001 (NIRCam) ",), ("Sgr B2 - jw05365-o002 (miri)",), ("Brick: jw02221-o003",), ("meta",), (None,)], "t string")
    good, odd = io.titles(lines, "t")
    assert [(r.name, r.program, r.obs, r.instrument) for r in good.collect()] == [("Brick", 2221, "001", "NIRCam"), ("Sgr B2", 5365, "002", "miri")]
    assert [r.t for r in odd.collect()] == ["Brick: jw02221-o003"]


def test_weighted_median_is_the_lower_one(spark):
    df = spark.createDataFrame([("g", 1.0, 1), ("g", 2.0, 1), ("h", 1.0, 1), ("h", 2.0, 3)], "g string, v double, w int")
    assert {(r.g, r.v) for r in stats.weighted_median(df, ["g"], "v", "w").collect()} == {("g", 1.0), ("h", 2.0)}


def test_binned_drops_thin_bins_and_groups(spark):
    rows = [("a", b * 0.5 + 0.1, float(i + 1)) for b in range(4) for i in range(20 if b else 10)] + [("b", 0.1, 1.0)] * 50
    got = stats.binned(spark.createDataFrame(rows, "g string, x double, y double"), ["g"], "x", "y").collect()
    assert sorted((r.g, r.centre, r.median, r.n) for r in got) == [("a", 0.75, 10.5, 20), ("a", 1.25, 10.5, 20), ("a", 1.75, 10.5, 20)]


def test_mad_std_of_one_group_without_keys(spark):
    r = offset.mad_std(spark.createDataFrame([(1.0,), (2.0,), (9.0,)], "x double"), [], "x").first()
    assert r.x_med == 2.0 and abs(r.x_mad - offset.MAD) < 1e-12


def test_empty_tables_give_empty_results(spark):
    cat = spark.createDataFrame([], "field string, id long, ra double, dec double")
    from skyledger.operators import match

    assert match.radius_join(cat, cat, 1.0, ["field"]).count() == 0
    assert match.isolated(cat, 1.0, ["field"]).count() == 0
    pairs = spark.createDataFrame([], "field string, dra double, ddec double")
    assert offset.xcorr(pairs, ["field"]).count() == 0
    assert stats.clipped_line(spark.createDataFrame([], "g string, x double, y double"), ["g"]).count() == 0


def test_pointings_refuse_to_be_empty(spark, tmp_path):
    with pytest.raises(ValueError):
        io.write_pointings(spark.createDataFrame([], "program long"), str(tmp_path / "p"))


def test_staged_metrics_keep_other_stages(spark, tmp_path):
    path = str(tmp_path / "metrics")
    schema = "obsid string, stage int, metric string, value double"
    io.write_stage(spark.createDataFrame([("o", 1, "a", 1.0), ("o", 2, "a", 2.0)], schema), path)
    io.write_stage(spark.createDataFrame([("o", 2, "a", 3.0)], schema), path)
    assert sorted((r.stage, r.value) for r in spark.read.parquet(path).collect()) == [(1, 1.0), (2, 3.0)]


def test_distortion_is_measured_against_its_null_and_absence_is_no_defect(spark):
    n = 24 * 24
    star = lambda f, i: (f, i, 10 + (i % 24) / 1000, (i // 24) / 1000)
    rows = [(*star("swirl", i), (i % 24 - 11.5) * 2.0, (i // 24 - 11.5) * 2.0) for i in range(n)]
    rows += [(*star("flat", i), *xy) for i, xy in enumerate(np.random.default_rng(3).normal(0, 3, (n, 2)).tolist())]
    rows += [(*star("few", i), 1.0, 0.0) for i in range(4)]
    pairs = spark.createDataFrame(rows, "field string, id int, ra double, dec double, dra double, ddec double")
    groups = spark.createDataFrame([("swirl",), ("flat",), ("few",), ("none",), ("none",)], "field string")
    got = {r.field: r for r in verdicts.distortion(pairs, ["field"], groups).collect()}
    swirl, middle = got["swirl"], 4 * np.arange(12) - 22  # each cell's median is that of two columns and two rows
    assert len(got) == 4 and swirl.red_flag and swirl.passed and swirl.p_value == 1 / 21
    assert swirl.amp90 == pytest.approx(np.percentile(np.hypot(*np.meshgrid(middle, middle)), 90))
    assert swirl.significance == pytest.approx(swirl.amp90 / swirl.null_amp) and swirl.significance > 1
    assert got["flat"].passed and not got["flat"].red_flag and got["flat"].p_value > 1 / 21 and got["flat"].cells == 144 and got["flat"].stars_per_cell == 4
    assert (got["few"].cells, got["few"].amp90, got["few"].passed, got["few"].measurable, got["few"].null_amp) == (0, 0.0, False, True, None)
    none = got["none"]
    assert (none.n_stars, none.amp90, none.passed, none.measurable, none.red_flag) == (None, None, None, False, False)
    assert verdicts.distortion(pairs.limit(0), ["field"]).count() == 0

"""Quantiles of groups that are narrowed pass by pass, against F.percentile."""

import math
import random

import pytest
from pyspark.sql import functions as F

from skyledger.operators import offset, quantiles, stats


def rows():
    rng = random.Random(4)
    out = []
    for i in range(6000):
        v = rng.choice([rng.gauss(0, 1), rng.gauss(1e6, 1e-3), 5.0, -1e300 * rng.random()])
        out.append(("wide", 1, v, rng.random()))
        out.append(("flat", 2, 7.0, float(i % 3)))
        out.append(("tail", None, math.exp(rng.gauss(0, 8)), float(i)))
    out += [("few", 3, float(i), None) for i in range(4)] + [("none", 4, None, float("nan")), ("odd", 5, float("nan"), 1.0), ("odd", 5, 2.0, float("inf"))]
    rng.shuffle(out)
    return out


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(rows(), "g string, h int, a double, b double").repartition(5).cache()


@pytest.mark.parametrize("q", [0.9])
def test_narrowed_quantiles_equal_percentiles(table, q):
    got = {r.g: r for r in quantiles.group_quantiles(table, ["g", "h"], ["a", "b"], q, few=50).collect()}
    clean = table.select("g", *[quantiles.number(c).alias(c) for c in ("a", "b")])
    want = {r.g: r for r in clean.groupBy("g").agg(F.count(F.lit(1)).alias("n"), *[F.percentile(c, q).alias(c) for c in ("a", "b")]).collect()}
    assert set(got) == set(want)
    for g, r in want.items():
        assert got[g].n == r.n
        for c in ("a", "b"):
            assert got[g][c] == r[c] or math.isclose(got[g][c], r[c], rel_tol=1e-12), (g, c)


def test_without_keys(table):
    (got,) = quantiles.group_quantiles(table.where("g <> 'wide'"), [], ["a"], few=100).collect()
    (want,) = table.where("g <> 'wide' and not isnan(a)").agg(F.percentile("a", 0.5).alias("a")).collect()
    assert math.isclose(got.a, want.a, rel_tol=1e-12)


def test_no_task_holds_a_group(table):
    """The last windows have no more rows than ``few``, however large the group."""
    x = table.where("g = 'tail'").select("g", "a")
    (r,) = quantiles.selected(quantiles.staged(x, "x"), ["g"], ["a"], 0.5, few=10).collect()
    (want,) = x.agg(F.percentile("a", 0.5).alias("a")).collect()
    assert math.isclose(r.v, want.a, rel_tol=1e-12)


def test_robust_statistics_are_the_same_for_large_groups(spark, table, monkeypatch):
    x = table.where("g in ('wide', 'flat', 'tail')").withColumn("ra", F.col("b") / 100).withColumn("dec", F.rand(3)).withColumn("dra", F.col("b")).withColumn("ddec", F.col("b") * 2).cache()
    of = lambda: [sorted(map(str, df.select(*[F.round(c, 9).alias(c) if k == "double" else c for c, k in df.dtypes]).collect())) for df in (
        offset.mad_std(x, ["g"], "a", "b", count="n"), stats.sigma_clipped(x, ["g"], "b"), stats.zeropoint(x, ["g"], "a", "b"), stats.sky_map(x, ["g"], 4),
        offset.xcorr(x.selectExpr("g", "b % 2 - 0.3 as dra", "(b * 7) % 2 - 1 as ddec").where("g <> 'flat'"), ["g"]),
    )]
    small = of()
    monkeypatch.setattr(quantiles, "FEW", 100)
    assert of() == small

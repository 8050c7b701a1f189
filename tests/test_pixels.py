"""Apertures and stage 9 on planted stars."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.operators import pixels as P


def test_overlap_area_is_the_integral(spark):
    rng = np.random.default_rng(2)
    rows = [(float(a), float(b)) for a, b in rng.uniform(-4.2, 4.2, (150, 2))] + [(0.0, 0.0), (3.0, 0.0), (2.5, 0.5), (0.0, -3.5), (3.5, 3.5), (-2.0, 2.0)]
    for r in (3.0, 0.4, 1.25):
        got = spark.createDataFrame(rows, "dx double, dy double").select("dx", "dy", F.expr(P.overlap_area("dx", "dy", r)).cast("double").alias("a")).collect()
        u = (np.arange(500) + 0.5) / 500 - 0.5
        for x in got:
            want = (((x.dx + u[:, None]) ** 2 + (x.dy + u[None, :]) ** 2) <= r * r).mean()
            assert abs(x.a - want) < 4e-3, (x, r, want)


def test_overlap_areas_of_a_circle_add_up_to_it(spark):
    grid = spark.range(81).selectExpr("id % 9 - 4 as x", "floor(id / 9) - 4 as y").crossJoin(spark.createDataFrame([(0.0, 0.0), (0.3, -0.45), (0.5, 0.5)], "sx double, sy double"))
    got = grid.selectExpr("sx", "sy", "x - sx as dx", "y - sy as dy").groupBy("sx", "sy").agg(F.sum(F.expr(P.overlap_area("dx", "dy", 3.0)).cast("double")).alias("a")).collect()
    assert all(abs(r.a - math.pi * 9) < 1e-9 for r in got)


def field(spark, size=200, step=16, shift=0.0, faint=(), holes=(), seed=1):
    """(stars, pixels) of one image: round stars on a lattice over noise; ``shift`` moves the catalogue along x."""
    rng = np.random.default_rng(seed)
    data = rng.normal(10, 1, (size, size))
    yy, xx = np.mgrid[:size, :size]
    stars = []
    for i, (cy, cx) in enumerate((y, x) for y in range(step // 2, size, step) for x in range(step // 2, size, step)):
        sx, sy = cx + rng.uniform(-0.4, 0.4), cy + rng.uniform(-0.4, 0.4)
        flux = 20.0 if i in faint else 20_000.0 + 100 * i
        data += flux / (2 * math.pi * 1.44) * np.exp(-((xx - sx) ** 2 + (yy - sy) ** 2) / 2.88)
        if i in holes:
            data[cy, cx] = np.nan
        stars.append((0, i, float(sx + shift), float(sy), flux))
    rows = [(0, y, x, float(data[y, x]), 0) for y in range(size) for x in range(size)]
    return spark.createDataFrame(stars, "image long, id long, sx double, sy double, flux double"), spark.createDataFrame(rows, "image long, y long, x long, value double, dq int")


def test_psf_against_aperture_finds_what_was_planted(spark):
    stars, pixels = field(spark, holes=(40, 41), faint=(50, 51, 52))
    (r,) = P.psf_against_aperture(stars, pixels).collect()
    inner = sum(10 < 8 + 16 * k < 190 for k in range(12))
    assert r.isolated >= (inner - 1) ** 2 and r.n == r.isolated - 5 and r.reason is None
    assert r.shift < 0.3 and not r.mismatch
    assert abs(r.correction - -2.5 * math.log10(1 - math.exp(-9 / 2.88))) < 0.01 and r.scatter < 0.02 and r.tail == 0


@pytest.mark.parametrize(("shift", "mismatch"), [(0.0, False), (2.5, True)])
def test_a_shifted_catalogue_is_a_mismatch(spark, shift, mismatch):
    stars, pixels = field(spark, shift=shift)
    (r,) = P.psf_against_aperture(stars, pixels).collect()
    assert r.mismatch is mismatch and abs(r.shift - shift) < 0.4 and r.scatter < 0.02


def test_crowded_few_and_brightest(spark):
    stars, pixels = field(spark)
    twins = stars.unionByName(stars.withColumns({"id": F.col("id") + 1000, "sx": F.col("sx") + 12.0}))
    (r,) = P.psf_against_aperture(twins, pixels).collect()
    assert r.isolated < 50 and r.reason == "too few isolated stars" and r.scatter is None and r.mismatch is None
    (r,) = P.psf_against_aperture(stars, pixels, most=60).collect()
    assert r.isolated == 60 and r.n == 60
    (r,) = P.psf_against_aperture(stars, pixels, least_sn=1e9).collect()
    assert r.n == 0 and r.reason == "too few clean stars after quality gate" and r.shift is not None


def test_recentroid_of_stamps_at_the_edge_and_missing_pixels(spark):
    stars, pixels = field(spark, size=64, holes=(5,))
    edge = spark.createDataFrame([(0, 900, 2.2, 30.0, 1.0), (0, 901, 61.0, 30.0, 1.0)], stars.schema)
    got = {r.id: r for r in P.recentroid(stars.unionByName(edge).drop("flux"), pixels).collect()}
    assert got[900].moved == 0 and got[901].moved == 0 and got[900].cx == 2.2
    assert got[5].moved > got[6].moved  # a missing pixel counts as 0, which is the stamp's least then


def test_local_maxima_across_blocks(spark, monkeypatch):
    """Small blocks, plateaus over their borders, holes and negative coordinates, against every pixel's neighbours."""
    monkeypatch.setattr(P, "BLOCK", 4)
    monkeypatch.setattr(P.blocks, "__defaults__", (4, 1))
    rng = np.random.default_rng(6)
    data = {(i, y, x): float(rng.integers(0, 6)) for i in range(2) for y in range(-5, 14) for x in range(-3, 17) if rng.random() > 0.1}
    rows = [(i, y, x, v) for (i, y, x), v in data.items()] + [(0, 40, 40, None), (0, 41, 40, float("nan")), (1, 60, 60, 3.0)]
    data[1, 60, 60] = 3.0
    want = {}
    for (i, y, x), v in data.items():
        near = {(dy, dx): data[i, y + dy, x + dx] for dy in (-1, 0, 1) for dx in (-1, 0, 1) if (i, y + dy, x + dx) in data}
        if v > 1.0 and all(n < v or (n == v and (d == (0, 0) or d > (0, 0))) for d, n in near.items()):
            s = sum(near.values())
            want[i, y, x] = (x + sum(n * d[1] for d, n in near.items()) / s, y + sum(n * d[0] for d, n in near.items()) / s)
    pixels = spark.createDataFrame(rows, "image long, y long, x long, value double").repartition(5)
    got = P.local_maxima(pixels, spark.createDataFrame([(0, 1.0), (1, 1.0)], "image long, threshold double")).collect()
    assert {(r.image, r.y, r.x) for r in got} == set(want) and len(got) == len(want)
    assert all(math.isclose(r.sx, want[r.image, r.y, r.x][0]) and math.isclose(r.sy, want[r.image, r.y, r.x][1]) for r in got)


def project(ra, dec, w):
    """Gnomonic pixel position in plain Python, None on the far side of the sky."""
    a, d, a0, d0 = (math.radians(v) for v in (ra, dec, w["crval1"], w["crval2"]))
    c = math.sin(d0) * math.sin(d) + math.cos(d0) * math.cos(d) * math.cos(a - a0)
    if c <= 0:
        return None
    xi, eta = math.degrees(math.cos(d) * math.sin(a - a0) / c), math.degrees((math.cos(d0) * math.sin(d) - math.sin(d0) * math.cos(d) * math.cos(a - a0)) / c)
    det = w["cd11"] * w["cd22"] - w["cd12"] * w["cd21"]
    return (w["cd22"] * xi - w["cd12"] * eta) / det + w["crpix1"], (w["cd11"] * eta - w["cd21"] * xi) / det + w["crpix2"]


def test_covering_image_equals_brute_force_at_the_poles_and_across_zero(spark):
    rng = np.random.default_rng(9)
    images, names = [], ("crval1", "crval2", "crpix1", "crpix2", "cd11", "cd12", "cd21", "cd22")
    for i, (ra, dec) in enumerate([(0.0, 0.0), (359.99, -28.0), (0.02, -28.0), (266.4, -28.9), (266.42, -28.9), (10.0, 89.99), (200.0, 89.9), (77.0, -89.98), (180.0, 45.0), (12.0, 90.0)]):
        turn, scale = rng.uniform(0, 6.28), 3e-5
        cd = [-scale * math.cos(turn), scale * math.sin(turn), scale * math.sin(turn), scale * math.cos(turn)]
        images.append((i, 1200, 900, ra, dec, float(rng.uniform(-200, 1300)), float(rng.uniform(-200, 1000)), *map(float, cd)))
    positions = []
    for i, (_, _, _, ra, dec, *_) in enumerate(images):
        for _ in range(150):
            d = dec + rng.uniform(-0.08, 0.08)
            a = (ra + rng.uniform(-0.08, 0.08) / max(math.cos(math.radians(min(abs(d), 89.9999))), 1e-6)) % 360
            if abs(d) > 90:
                d, a = math.copysign(180 - abs(d), d), (a + 180) % 360
            positions.append((int(rng.integers(0, 6)), float(a), float(d)))
    positions += [(6, float(rng.uniform(0, 360)), float(rng.uniform(-90, 90))) for _ in range(300)]
    count = {}
    for g, ra, dec in positions:
        for image in images:
            at = project(ra, dec, dict(zip(names, image[3:])))
            if at and 0 <= at[0] < image[1] and 0 <= at[1] < image[2]:
                count[g, image[0]] = count.get((g, image[0]), 0) + 1
    want = {g: max(((n, -i) for (h, i), n in count.items() if h == g)) for g in {g for g, _ in count}}
    schema = "image long, nx int, ny int, " + ", ".join(f"{c} double" for c in names)
    for width in (0.02, 0.5, 7.0):
        got = P.covering_image(spark.createDataFrame(positions, "field long, ra double, dec double"), spark.createDataFrame(images, schema), ["field"], width).collect()
        assert {r.field: (r.n, -r.image) for r in got} == want

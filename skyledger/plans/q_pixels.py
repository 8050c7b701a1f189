"""Queries on pixel tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import pixels as P
from .registry import query
from .standins import DENSE_PIXELS, SPARSE_SQL, STARS, sparse_pixels

PIX = f"WITH p AS ({DENSE_PIXELS.sql})"
#: Stars on a lattice, off the pixel centres.
LATTICE = "s AS (SELECT image, y * 128 + x AS id, x + (dq - 3) / 10.0::DOUBLE AS sx, y - (dq % 3) / 10.0::DOUBLE AS sy, value AS mag FROM p WHERE x % 16 = 8 AND y % 16 = 8)"


def pix(spark, d):
    return DENSE_PIXELS.df(spark, d)


def lattice(spark, d):
    s = pix(spark, d).where("x % 16 = 8 and y % 16 = 8")
    return s.select("image", (F.col("y") * 128 + F.col("x")).alias("id"), (F.col("x") + (F.col("dq") - 3) / 10).alias("sx"), (F.col("y") - (F.col("dq") % 3) / 10).alias("sy"), F.col("value").alias("mag"))


def box(half: float, centre: str = "") -> str:
    r = (lambda c: f"round({c})") if centre else (lambda c: c)
    return f"(SELECT s.image, s.id, s.sx AS ox, s.sy AS oy, s.mag, p.x, p.y, p.value, p.dq, p.x - {r('s.sx')} AS dx, p.y - {r('s.sy')} AS dy FROM s JOIN p ON s.image = p.image AND abs(p.x - {r('s.sx')}) <= {half} AND abs(p.y - {r('s.sy')}) <= {half})"


#: Apertures on stars s and pixels p: shares of pixels, the annulus' median and scatter.
APERTURES = f"""g AS (SELECT image, id, sum(value * share) AS f, sum(CASE WHEN value IS NULL THEN share ELSE 0.0 END) AS missing, median(value) FILTER (r >= 6 AND r < 9) AS sky, stddev_pop(value) FILTER (r >= 6 AND r < 9) AS sky_std
  FROM (SELECT *, ({P.overlap_area('dx', 'dy', 3.0)})::DOUBLE AS share, sqrt(dx * dx + dy * dy) AS r FROM {{box}}) GROUP BY ALL),
aperture AS (SELECT image, id, missing, sky, sky_std, CASE WHEN missing <= 0.5 THEN coalesce(f, 0) - sky * pi() * 9 END AS flux FROM g)"""
#: Centroids of stars s on pixels p.
CENTROIDS = f"""stamp AS (SELECT image, id, dx, dy, coalesce(value, 0) - min(coalesce(value, 0)) OVER (PARTITION BY image, id) AS w FROM {box(5, 'r')}),
moment AS (SELECT image, id, sum(w) AS w, sum(w * dx) AS x, sum(w * dy) AS y, count(*) AS n FROM stamp GROUP BY ALL),
centroid AS (SELECT image, id, sx AS ox, sy AS oy, CASE WHEN n = 121 AND w > 0 THEN round(sx) + x / w ELSE sx END AS cx, CASE WHEN n = 121 AND w > 0 THEN round(sy) + y / w ELSE sy END AS cy FROM s LEFT JOIN moment USING (image, id))"""


@query(
    "aperture_flux",
    f"{PIX}, {LATTICE}, {APERTURES.format(box=box(9))} SELECT image, id, round(missing, 6) AS missing, round(sky, 6) AS sky, round(sky_std, 6) AS sky_std, round(flux, 5) AS flux FROM aperture",
)
def aperture_flux(spark, d):
    x = P.aperture_flux(lattice(spark, d).drop("mag"), pix(spark, d))
    return x.select("image", "id", F.round("missing", 6).alias("missing"), F.round("sky", 6).alias("sky"), F.round("sky_std", 6).alias("sky_std"), F.round("flux", 5).alias("flux"))


@query("recentroid", f"{PIX}, {LATTICE}, {CENTROIDS} SELECT image, id, round(cx, 6) AS cx, round(cy, 6) AS cy, round(sqrt(power(cx - ox, 2) + power(cy - oy, 2)), 6) AS moved FROM centroid")
def recentroid(spark, d):
    x = P.recentroid(lattice(spark, d).drop("mag"), pix(spark, d))
    return x.select("image", "id", F.round("cx", 6).alias("cx"), F.round("cy", 6).alias("cy"), F.round("moved", 6).alias("moved"))


PSF = f"""{PIX}, {LATTICE}, j AS (SELECT * FROM {box(4, 'r')}), g AS (SELECT image, id, bool_or(abs(dx) <= 2 AND abs(dy) <= 2 AND (value IS NULL)) AS b, max(value) AS peak, count(*) AS n FROM j GROUP BY ALL),
k AS (SELECT image, id, peak FROM g WHERE NOT b AND n = 81 AND peak > 0), q AS (SELECT *, row_number() OVER (PARTITION BY image ORDER BY peak DESC, id) AS r FROM k), u AS (SELECT image, id, peak, count(*) OVER (PARTITION BY image) AS n_stars FROM q WHERE r <= 40),
psf AS (SELECT image, dy::INT AS dy, dx::INT AS dx, n_stars, avg(value / peak) AS psf FROM j JOIN u USING (image, id) WHERE n_stars >= 10 GROUP BY ALL)"""


def stack(spark, d):
    """The lattice has no real stars: the image gets a peak of its own at each, so that the centre rule holds."""
    p = pix(spark, d)
    near = (F.col("x") % 16 == 8) & (F.col("y") % 16 == 8)
    p = p.withColumns({"value": F.when(near & F.col("value").isNotNull(), F.col("value") + 1000).otherwise(F.col("value")), "dq": F.lit(0)})
    return P.effective_psf(lattice(spark, d).drop("mag"), p, half=4)


RAISED = PSF.replace(f"WITH p AS ({DENSE_PIXELS.sql})", f"WITH p0 AS ({DENSE_PIXELS.sql}), p AS (SELECT * REPLACE (CASE WHEN x % 16 = 8 AND y % 16 = 8 THEN value + 1000 ELSE value END AS value) FROM p0)")


@query("psf_stack", f"{RAISED} SELECT image, dy, dx, n_stars, round(psf, 6) AS psf FROM psf")
def psf_stack(spark, d):
    return stack(spark, d).select("image", "dy", "dx", "n_stars", F.round("psf", 6).alias("psf"))


@query("psf_radius", f"{RAISED} SELECT image, round(sqrt(sum(greatest(psf, 0) * (dx * dx + dy * dy)) / sum(greatest(psf, 0))), 6) AS radius FROM psf GROUP BY image")
def psf_radius(spark, d):
    return P.psf_radius(stack(spark, d)).select("image", F.round("radius", 6).alias("radius"))


@query(
    "local_maxima",
    f"""{PIX}, t AS (SELECT image, quantile_cont(value, 0.9) AS th FROM p GROUP BY image), g AS (SELECT * FROM p WHERE value IS NOT NULL),
n AS (SELECT a.image, a.y, a.x, a.value, first(b.y - a.y ORDER BY b.value DESC, b.y, b.x) AS py, first(b.x - a.x ORDER BY b.value DESC, b.y, b.x) AS px, sum(b.value * (b.x - a.x)) / sum(b.value) AS ox, sum(b.value * (b.y - a.y)) / sum(b.value) AS oy
  FROM g a JOIN g b ON a.image = b.image AND b.y BETWEEN a.y - 1 AND a.y + 1 AND b.x BETWEEN a.x - 1 AND a.x + 1 GROUP BY ALL)
SELECT image, y, x, round(x + ox, 6) AS sx, round(y + oy, 6) AS sy FROM n JOIN t USING (image) WHERE py = 0 AND px = 0 AND value > th""",
)
def local_maxima(spark, d):
    p = pix(spark, d)
    t = p.groupBy("image").agg(F.percentile("value", 0.9).alias("threshold"))
    return P.local_maxima(p, t).select("image", "y", "x", F.round("sx", 6).alias("sx"), F.round("sy", 6).alias("sy"))


@query("band_limits", f"{PIX} SELECT image, round(quantile_cont(value, 0.01), 6) AS low, round(quantile_cont(value, 0.995), 6) AS high FROM p GROUP BY image")
def band_limits(spark, d):
    return P.band_limits(pix(spark, d), ["image"]).select("image", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"))


def stretch(lo: float, hi: float) -> str:
    return f"asinh(least(1.0, greatest(0.0, (value - {lo}) / {hi - lo})) / 0.1) / asinh(10.0)"


#: Odd images are blue and the next even ones red; the last blue one has no partner.
COLOUR = f"""WITH p AS (SELECT *, (image + 1) // 2 AS field FROM ({SPARSE_SQL})), b AS (SELECT field, y, x, {stretch(20000.0, 60000.0)} AS b FROM p WHERE image % 2 = 1), r AS (SELECT field, y, x, {stretch(10000.0, 80000.0)} AS r FROM p WHERE image % 2 = 0),
rgb AS (SELECT field, y, x, floor(coalesce(r, 0) * 255)::INT AS r, floor(coalesce((r + b) / 2, 0) * 255)::INT AS g, floor(coalesce(b, 0) * 255)::INT AS b, CASE WHEN r IS NULL AND b IS NULL THEN 0 ELSE 255 END AS a FROM b FULL JOIN r USING (field, y, x))"""


def bands(spark, d):
    p = sparse_pixels(spark, d).withColumn("field", F.expr("(image + 1) div 2"))
    return p.where("image % 2 = 1"), p.where("image % 2 = 0")


def rgb(spark, d):
    return P.two_colour(*bands(spark, d), (20000.0, 60000.0, 10000.0, 80000.0), ["field"])


@query("two_colour", f"{COLOUR} SELECT field, y, x, r, g, b, a FROM rgb")
def two_colour(spark, d):
    return rgb(spark, d)


@query("alpha_mismatch", f"{COLOUR}, i AS (SELECT field, y, x, b IS NULL AS bad FROM b) SELECT field, round(avg(CASE WHEN (a = 0) <> coalesce(bad, true) THEN 1.0 ELSE 0.0 END), 6) AS mismatch, count(*) AS n FROM rgb LEFT JOIN i USING (field, y, x) GROUP BY field")
def alpha_mismatch(spark, d):
    return P.alpha_mismatch(rgb(spark, d), bands(spark, d)[0], ["field"]).select("field", F.round("mismatch", 6).alias("mismatch"), "n")


RESAMPLED = f"""{PIX}, g AS (SELECT image, y, x, 0.5 * x + 0.25 * y + 3.5 AS u, 0.75 * y + 2.25 AS v FROM p), n AS (SELECT image, y, x, u, v, floor(u) + i AS sx, floor(v) + j AS sy FROM g, (VALUES (0), (1)) a(i), (VALUES (0), (1)) b(j)),
w AS (SELECT n.*, (1 - abs(u - sx)) * (1 - abs(v - sy)) AS w, s.value FROM n LEFT JOIN (SELECT image, x, y, value FROM p WHERE value IS NOT NULL) s ON s.image = n.image AND s.x = sx AND s.y = sy),
r AS (SELECT image, y, x, CASE WHEN bool_and(value IS NOT NULL) FILTER (w > 0) THEN sum(w * value) FILTER (w > 0) END AS value FROM w GROUP BY ALL)"""


def resampled(spark, d):
    p = pix(spark, d)
    return P.resample(p, p.select("image", "y", "x"), (0.5 * F.col("x") + 0.25 * F.col("y") + 3.5, 0.75 * F.col("y") + 2.25), ["image"])


@query("resample", f"{RESAMPLED} SELECT image, y, x, round(value, 9) AS value FROM r")
def resample(spark, d):
    return resampled(spark, d).select("image", "y", "x", F.round("value", 9).alias("value"))


@query("covered_fraction", f"{RESAMPLED} SELECT image, round(avg(CASE WHEN value IS NULL THEN 0.0 ELSE 1.0 END), 6) AS covered FROM r GROUP BY image")
def covered_fraction(spark, d):
    return P.covered_fraction(resampled(spark, d), ["image"]).select("image", F.round("covered", 6).alias("covered"))


@query("finite_fraction", f"{PIX} SELECT image, round(avg(CASE WHEN value IS NULL THEN 0.0 ELSE 1.0 END), 6) AS finite, round(avg(CASE WHEN (dq & 2) > 0 THEN 1.0 ELSE 0.0 END), 6) AS saturated, count(*) AS n FROM p GROUP BY image")
def finite_fraction(spark, d):
    return P.finite_fraction(pix(spark, d), ["image"]).select("image", F.round("finite", 6).alias("finite"), F.round("saturated", 6).alias("saturated"), "n")


@query(
    "saturated_fraction",
    f"WITH p AS ({SPARSE_SQL}), f AS (SELECT image, avg(CASE WHEN (dq & 2) > 0 THEN 1.0 ELSE 0.0 END) AS s FROM p GROUP BY image) SELECT image % 2 AS side, round(median(s), 6) AS median, round(max(s), 6) AS most, first(image ORDER BY s DESC, image) AS worst FROM f GROUP BY 1",
)
def saturated_fraction(spark, d):
    f = P.finite_fraction(sparse_pixels(spark, d), ["image"]).withColumn("side", F.col("image") % 2)
    return P.worst_frame(f, ["side"], "image").select("side", F.round("median", 6).alias("median"), F.round("most", 6).alias("most"), "worst")


PEAK = f"""{PIX}, {LATTICE}, j AS (SELECT *, max(value) OVER (PARTITION BY image, id) AS top FROM {box(4, 'r')} WHERE value IS NOT NULL),
m AS (SELECT image, id, ox, oy, count(*) AS n, avg(x) AS ax, avg(y) AS ay, first(x ORDER BY y, x) AS fx, first(y ORDER BY y, x) AS fy, bool_or(abs(dx) = 4 OR abs(dy) = 4) AS border, bool_or((dq & 2) > 0) AS saturated FROM j WHERE value = top GROUP BY ALL),
pk AS (SELECT image, id, ox, oy, n, CASE WHEN NOT border THEN CASE WHEN n >= 3 THEN ax ELSE fx END END AS px, CASE WHEN NOT border THEN CASE WHEN n >= 3 THEN ay ELSE fy END END AS py, saturated FROM m)"""


@query("plateau_peak", f"{PEAK} SELECT image, id, n, px::DOUBLE AS px, py::DOUBLE AS py, saturated FROM pk")
def plateau_peak(spark, d):
    return P.plateau_peak(lattice(spark, d), pix(spark, d)).select("image", "id", "n", F.col("px").cast("double").alias("px"), F.col("py").cast("double").alias("py"), "saturated")


@query(
    "star_positions",
    f"""{PEAK.replace('value AS mag FROM p WHERE x % 16 = 8 AND y % 16 = 8)', 'value AS mag FROM p WHERE x % 16 = 8 AND y % 16 = 8 AND value IS NOT NULL)')}, c AS (SELECT *, sqrt(power(px - ox, 2) + power(py - oy, 2)) AS far, count(*) FILTER (NOT saturated) OVER (PARTITION BY image) AS clear FROM pk),
g AS (SELECT image, count(*) AS used, median(far) AS distance, avg(CASE WHEN px IS NULL THEN 0.0 ELSE 1.0 END) AS matched FROM c WHERE clear < 20 OR NOT saturated GROUP BY image)
SELECT image, used, round(distance, 6) AS distance, round(matched, 6) AS matched, coalesce(used >= 20 AND distance <= 2 AND matched >= 0.5, false) AS pass FROM g""",
)
def star_positions(spark, d):
    x = P.star_positions(lattice(spark, d).where("mag is not null"), pix(spark, d))
    return x.select("image", "used", F.round("distance", 6).alias("distance"), F.round("matched", 6).alias("matched"), "pass")


WCS = [("north", 266.41, -28.885, 400.0, 300.0), ("south", 266.41, -28.897, 400.0, 300.0)]


@query(
    "covering_tile",
    f"""WITH a AS ({STARS.sql}), w(image, v1, v2) AS (VALUES ('north', 266.41, -28.885), ('south', 266.41, -28.897)), t AS (SELECT tile, field, image, radians(ra - tile * 0.05) AS al, radians(dec) AS de, radians(v1) AS a0, radians(v2) AS d0 FROM a, w),
c AS (SELECT *, sin(d0) * sin(de) + cos(d0) * cos(de) * cos(al - a0) AS cc FROM t), q AS (SELECT tile, field, image, degrees(cos(de) * sin(al - a0) / cc) / -2e-5 + 400 AS x, degrees((cos(d0) * sin(de) - sin(d0) * cos(de) * cos(al - a0)) / cc) / 2e-5 + 300 AS y FROM c),
n AS (SELECT tile, field, image, count(*) FILTER (x >= 0 AND x < 800 AND y >= 0 AND y < 600) AS n FROM q GROUP BY ALL) SELECT tile, field, first(image ORDER BY n DESC, image) AS image, max(n) AS n FROM n GROUP BY ALL""",
)
def covering_tile(spark, d):
    a = STARS.df(spark, d)
    wcs = a.select("tile").distinct().join(F.broadcast(spark.createDataFrame(WCS, "image string, crval1 double, crval2 double, crpix1 double, crpix2 double")), F.lit(True))
    wcs = wcs.withColumns({"crval1": F.col("crval1") + F.col("tile") * 0.05, "cd11": F.lit(-2e-5), "cd12": F.lit(0.0), "cd21": F.lit(0.0), "cd22": F.lit(2e-5)})
    return P.covering_tile(a.select("tile", "field", "ra", "dec"), wcs, (600, 800))


@query(
    "covering_image",
    f"""WITH a AS ({STARS.sql}), w(name, v1, v2) AS (VALUES ('north', 266.41, -28.885), ('south', 266.41, -28.897)), i AS (SELECT DISTINCT tile || name AS image, radians(v1 + tile * 0.05) AS a0, radians(v2) AS d0 FROM a, w),
t AS (SELECT tile, field, image, radians(ra) AS al, radians(dec) AS de, a0, d0 FROM a, i), c AS (SELECT *, sin(d0) * sin(de) + cos(d0) * cos(de) * cos(al - a0) AS cc FROM t),
q AS (SELECT tile, field, image, degrees(cos(de) * sin(al - a0) / cc) / -2e-5 + 400 AS x, degrees((cos(d0) * sin(de) - sin(d0) * cos(de) * cos(al - a0)) / cc) / 2e-5 + 300 AS y FROM c WHERE cc > 0),
n AS (SELECT tile, field, image, count(*) AS n FROM q WHERE x >= 0 AND x < 800 AND y >= 0 AND y < 600 GROUP BY ALL) SELECT tile, field, first(image ORDER BY n DESC, image) AS image, max(n) AS n FROM n GROUP BY ALL""",
)
def covering_image(spark, d):
    """Images of all tiles against stars of all tiles: which lie above which is found by sky cells."""
    a = STARS.df(spark, d)
    tiles = a.select("tile").distinct().join(F.broadcast(spark.createDataFrame(WCS, "name string, crval1 double, crval2 double, crpix1 double, crpix2 double")), F.lit(True))
    shape = {"nx": F.lit(800), "ny": F.lit(600), "cd11": F.lit(-2e-5), "cd12": F.lit(0.0), "cd21": F.lit(0.0), "cd22": F.lit(2e-5)}
    images = tiles.select(F.concat(F.col("tile").cast("string"), "name").alias("image"), (F.col("crval1") + F.col("tile") * 0.05).alias("crval1"), "crval2", "crpix1", "crpix2").withColumns(shape)
    return P.covering_image(a, images, ["tile", "field"])


@query("isolated_sources", f"{PIX}, s AS (SELECT image, y * 128 + x AS id, x + (dq - 3) * 2.0 AS sx, y - (dq % 3) * 2.0 AS sy FROM p WHERE x % 16 = 8 AND y % 16 = 8) SELECT image, id FROM s WHERE NOT EXISTS (SELECT 1 FROM s o WHERE o.image = s.image AND o.id <> s.id AND sqrt(power(s.sx - o.sx, 2) + power(s.sy - o.sy, 2)) <= 12)")
def isolated_sources(spark, d):
    s = pix(spark, d).where("x % 16 = 8 and y % 16 = 8").select("image", (F.col("y") * 128 + F.col("x")).alias("id"), (F.col("x") + (F.col("dq") - 3) * 2.0).alias("sx"), (F.col("y") - (F.col("dq") % 3) * 2.0).alias("sy"))
    return P.isolated_sources(s, 12.0).select("image", "id")


#: A solution for each image, and the same with a small error in its scale that grows with the image's number.
SOLUTION = {
    "crval1": "266.4D + image / 100.0D", "crval2": "-28.9D", "crpix1": "64.5D + image * 100", "crpix2": "30.0D", "cd11": "-8.0e-6D", "cd12": "1.0e-6D", "cd21": "1.2e-6D", "cd22": "8.2e-6D"
}
OFF_SCALE = "8.2e-6D * (1 + image * 2.0e-4D + 1.0e-6D)"


def sky_sql(x: str, y: str, cd22: str, tag: str) -> str:
    u, v = f"({x} - (64.5::DOUBLE + image * 100))", f"({y} - 30)"
    xi, eta = f"radians(-8.0e-6::DOUBLE * {u} + 1.0e-6::DOUBLE * {v})", f"radians(1.2e-6::DOUBLE * {u} + {cd22} * {v})"
    low = f"(cos(radians(-28.9)) - {eta} * sin(radians(-28.9)))"
    return f"radians(266.4::DOUBLE + image / 100.0::DOUBLE) + atan2({xi}, {low}) AS r{tag}, atan2(sin(radians(-28.9)) + {eta} * cos(radians(-28.9)), sqrt({xi} * {xi} + {low} * {low})) AS d{tag}"


@query(
    "wcs_round_trip",
    f"""{PIX}, i AS (SELECT image, max(x) + 1 AS nx, max(y) + 1 AS ny FROM p GROUP BY image), c AS (SELECT image, greatest(0, least(64.5 + image * 100, nx - 1))::DOUBLE AS x, greatest(0, least(30, ny - 1))::DOUBLE AS y FROM i UNION ALL SELECT image, 0, 0 FROM i UNION ALL SELECT image, nx - 1, 0 FROM i UNION ALL SELECT image, 0, ny - 1 FROM i UNION ALL SELECT image, nx - 1, ny - 1 FROM i),
s AS (SELECT image, {sky_sql('x', 'y', '8.2e-6::DOUBLE', '1')}, {sky_sql('x', 'y', '(8.2e-6::DOUBLE * (1 + image * 2.0e-4::DOUBLE + 1.0e-6::DOUBLE))', '2')} FROM c)
SELECT image, round(max(2 * degrees(asin(sqrt(power(sin((d2 - d1) / 2), 2) + cos(d1) * cos(d2) * power(sin((r2 - r1) / 2), 2)))) * 3600), 6) AS offset, max(2 * degrees(asin(sqrt(power(sin((d2 - d1) / 2), 2) + cos(d1) * cos(d2) * power(sin((r2 - r1) / 2), 2)))) * 3600) < 0.1 AS passed FROM s GROUP BY image""",
)
def wcs_round_trip(spark, d):
    i = pix(spark, d).groupBy("image").agg((F.max("x") + 1).alias("nx"), (F.max("y") + 1).alias("ny")).withColumns({c: F.expr(e) for c, e in SOLUTION.items()})
    return P.wcs_round_trip(i, i.withColumn("cd22", F.expr(OFF_SCALE))).withColumn("offset", F.round("offset", 6))

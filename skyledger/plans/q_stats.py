"""Queries on robust and binned statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import match, offset, stats
from .q_match import AB, MUTUAL, near
from .registry import query
from .standins import EXPOSURE_SQL, REFERENCE, STARS, exposures

STAR = f"WITH a AS ({STARS.sql})"
EXP = f"WITH e AS ({EXPOSURE_SQL})"
M = offset.MAD


def fit_rounds(rounds: int, source: str) -> str:
    out, now = "", source
    for r in range(rounds + 1):
        out += f""", l{r} AS (SELECT field, regr_slope(y, x) AS s, regr_intercept(y, x) AS i, count(*) AS n FROM {now} GROUP BY field),
m{r} AS (SELECT field, s, i, n, median(y - (s * x + i)) AS c FROM {now} JOIN l{r} USING (field) GROUP BY ALL),
w{r} AS (SELECT field, s, i, n, median(abs(y - (s * x + i) - c)) * {M} AS w FROM {now} JOIN m{r} USING (field) GROUP BY ALL),
k{r} AS (SELECT field, s, i, n, w, count(*) FILTER (abs(y - (s * x + i)) < 3 * w) AS kept FROM {now} JOIN w{r} USING (field) GROUP BY ALL),
f{r} AS (SELECT *, kept < n AND kept >= 30 AND {r} < {rounds} AS open FROM k{r}),
p{r} AS (SELECT field, x, y FROM {now} JOIN f{r} USING (field) WHERE open AND abs(y - (s * x + i)) < 3 * w)"""
        now = f"p{r}"
    return out + " " + " UNION ALL ".join(f"SELECT field, round(s, 6) AS slope, round(i, 5) AS intercept, round(w, 6) AS scatter, n FROM f{r} WHERE NOT open" for r in range(rounds + 1))


@query("clipped_fit", f"{STAR}, q AS (SELECT field, mag AS x, mag * 0.98 + (cust % 50) / 100.0::DOUBLE + CASE WHEN cust % 37 = 0 THEN 4 ELSE 0 END AS y FROM a) {fit_rounds(5, 'q')}")
def clipped_fit(spark, d):
    y = F.col("mag") * 0.98 + (F.col("cust") % 50) / 100 + F.when(F.col("cust") % 37 == 0, 4).otherwise(0)
    x = stats.clipped_line(STARS.df(spark, d).select("field", F.col("mag").alias("x"), y.alias("y")), ["field"])
    return x.select("field", F.round("slope", 6).alias("slope"), F.round("intercept", 5).alias("intercept"), F.round("scatter", 6).alias("scatter"), "n")


def clip_sql(rounds: int) -> str:
    out, now = "", "q"
    for r in range(rounds + 1):
        out += f", s{r} AS (SELECT detector, avg(v) AS mean, median(v) AS med, stddev_pop(v) AS std, count(*) AS n FROM {now} GROUP BY detector)"
        if r < rounds:
            out += f", c{r} AS (SELECT detector, v FROM {now} JOIN s{r} USING (detector) WHERE abs(v - med) <= 3 * std)"
            now = f"c{r}"
    return out + f" SELECT detector, round(mean, 5) AS mean, round(med, 5) AS median, round(std, 5) AS std, n FROM s{rounds}"


@query("sigma_clip", f"{STAR}, q AS (SELECT detector, mag AS v FROM a) {clip_sql(5)}")
def sigma_clip(spark, d):
    x = stats.sigma_clipped(STARS.df(spark, d), ["detector"], "mag")
    return x.select("detector", *[F.round(c, 5).alias(c) for c in ("mean", "median", "std")], "n")


@query(
    "hist_mode",
    f"""{STAR}, b AS (SELECT field, min(mag) AS lo, (max(mag) - min(mag)) / 60 AS w FROM a GROUP BY field), h AS (SELECT field, lo, w, least(floor((mag - lo) / w), 59) AS i, count(*) AS n FROM a JOIN b USING (field) GROUP BY ALL)
SELECT field, round(first(lo + (i + 0.5::DOUBLE) * w ORDER BY n DESC, i), 6) AS mode, max(n) AS n FROM h GROUP BY field""",
)
def hist_mode(spark, d):
    return stats.histogram_mode(STARS.df(spark, d), ["field"], "mag").select("field", F.round("mode", 6).alias("mode"), "n")


BINS = """b AS (SELECT {k}, floor({x} / 0.5) AS bin, quantile_cont({y}, [0.5, 0.16, 0.84]) AS q, sqrt(avg({y} * {y})) AS rms, count(*) AS n FROM {t} WHERE {w} GROUP BY ALL HAVING count(*) >= 15),
curve AS (SELECT {k}, (bin + 0.5::DOUBLE) * 0.5 AS centre, q[1] AS median, q[2] AS p16, q[3] AS p84, rms, n FROM (SELECT *, count(*) OVER (PARTITION BY {k}) AS nb FROM b) WHERE nb >= 3)"""


@query("binned_stat", f"{STAR}, {BINS.format(k='field', x='mag', y='flux_err', t='a', w='flux_err > 0')} SELECT field, centre, round(median, 6) AS median, round(p16, 6) AS p16, round(p84, 6) AS p84, n FROM curve")
def binned_stat(spark, d):
    x = stats.binned(STARS.df(spark, d), ["field"], "mag", "flux_err")
    return x.select("field", "centre", *[F.round(c, 6).alias(c) for c in ("median", "p16", "p84")], "n")


@query("binned_rms", f"{STAR}, q AS (SELECT detector, mag, (cust % 41 - 20) * 1.0::DOUBLE AS r FROM a), {BINS.format(k='detector', x='mag', y='r', t='q', w='TRUE')} SELECT detector, centre, round(rms, 6) AS rms, n FROM curve")
def binned_rms(spark, d):
    q = STARS.df(spark, d).withColumn("r", (F.col("cust") % 41 - 20).cast("double"))
    return stats.binned(q, ["detector"], "mag", "r", positive=False).select("detector", "centre", F.round("rms", 6).alias("rms"), "n")


OFFS = f"""{AB}, {near('a0', 'b0', 0.3, more=', a.field AS field, a.mag AS mag, a.flux AS flux, a.flux_err AS flux_err, a.detector AS detector, a.obs AS obs, b.mag AS bmag')},
o AS (SELECT field, detector, obs, mag, bmag, flux, flux_err, a_id AS id, a_ra AS ra, a_dec AS dec, (a_ra - b_ra) * cos(radians(a_dec)) * 3600000 AS dra, (a_dec - b_dec) * 3600000 AS ddec FROM {MUTUAL} WHERE r1 = 1 AND r2 = 1)"""


def offsets(spark, d):
    p = match.mutual_nearest(match.radius_join(STARS.df(spark, d), REFERENCE.df(spark, d), 0.3, ["tile"]), ["a_tile"])
    p = offset.pair_offsets(p).withColumns({"dra": F.col("dra") * 1000, "ddec": F.col("ddec") * 1000})
    return p.select(*[F.col(f"a_{c}").alias(c) for c in ("field", "detector", "obs", "mag", "flux", "flux_err", "id", "ra", "dec")], F.col("b_mag").alias("bmag"), "dra", "ddec")


def map_ctes(key: str) -> str:
    return f"""{OFFS}, d0 AS (SELECT {key}, median(dec) AS d0 FROM o GROUP BY {key}), x AS (SELECT o.*, ra * cos(radians(d0)) AS px FROM o JOIN d0 USING ({key})),
box AS (SELECT {key}, min(px) AS x0, max(px) AS x1, min(dec) AS y0, max(dec) AS y1 FROM x GROUP BY {key}),
c AS (SELECT {key}, least(floor((px - x0) / (x1 - x0) * 12), 11)::INT AS i, least(floor((dec - y0) / (y1 - y0) * 12), 11)::INT AS j, dra, ddec FROM x JOIN box USING ({key})),
cells AS (SELECT {key}, i, j, count(*) AS n, median(dra) AS dra, median(ddec) AS ddec FROM c GROUP BY ALL HAVING count(*) >= 3)"""


def null_ctes(key: str) -> str:
    """The real map's amplitude and those of twenty shuffled ones, after map_ctes."""
    return f"""real AS (SELECT {key}, quantile_cont(sqrt(dra * dra + ddec * ddec), 0.9) AS amp90 FROM cells GROUP BY {key}), k AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY md5(id::VARCHAR), id) - 1 AS r, count(*) OVER (PARTITION BY {key}) AS m FROM o),
v AS (SELECT {key}, p, dra, ddec, (r * [{", ".join(str(p) for p in stats._PRIMES)}][p % {len(stats._PRIMES)} + 1] + p * floor(m / 20)::BIGINT + 1) % m AS r FROM k, unnest(range(20)) AS u(p)),
j AS (SELECT v.{key}, p, ra, dec, v.dra, v.ddec FROM v JOIN k ON v.{key} = k.{key} AND v.r = k.r), e0 AS (SELECT {key}, p, median(dec) AS d0 FROM j GROUP BY ALL), x2 AS (SELECT j.*, ra * cos(radians(d0)) AS px FROM j JOIN e0 USING ({key}, p)),
box2 AS (SELECT {key}, p, min(px) AS x0, max(px) AS x1, min(dec) AS y0, max(dec) AS y1 FROM x2 GROUP BY ALL), c2 AS (SELECT {key}, p, least(floor((px - x0) / (x1 - x0) * 12), 11)::INT AS i, least(floor((dec - y0) / (y1 - y0) * 12), 11)::INT AS j, dra, ddec FROM x2 JOIN box2 USING ({key}, p)),
cells2 AS (SELECT {key}, p, i, j, median(dra) AS dra, median(ddec) AS ddec FROM c2 GROUP BY ALL HAVING count(*) >= 3), n AS (SELECT {key}, p, quantile_cont(sqrt(dra * dra + ddec * ddec), 0.9) AS a FROM cells2 GROUP BY ALL)"""


MAP = map_ctes("obs")


@query("binned_median_2d", f"{MAP} SELECT obs, i, j, n, round(dra, 5) AS dra, round(ddec, 5) AS ddec FROM cells")
def binned_median_2d(spark, d):
    return stats.sky_map(offsets(spark, d), ["obs"]).select("obs", "i", "j", "n", F.round("dra", 5).alias("dra"), F.round("ddec", 5).alias("ddec"))


@query("amp90", f"{MAP} SELECT obs, round(quantile_cont(sqrt(dra * dra + ddec * ddec), 0.9), 5) AS amp90, count(*) AS cells FROM cells GROUP BY obs")
def amp90(spark, d):
    return stats.amp90(stats.sky_map(offsets(spark, d), ["obs"]), ["obs"]).select("obs", F.round("amp90", 5).alias("amp90"), "cells")


@query(
    "shuffled_null",
    f"""{MAP}, {null_ctes("obs")}
SELECT obs, round(amp90, 5) AS amp90, round(median(a), 5) AS null_median, round((count(*) FILTER (a >= amp90) + 1) / 21, 6) AS p_value FROM n JOIN real USING (obs) GROUP BY obs, amp90""",
)
def shuffled_null(spark, d):
    x = stats.shuffled_null(offsets(spark, d), ["obs"])
    return x.select("obs", F.round("amp90", 5).alias("amp90"), F.round("null_median", 5).alias("null_median"), F.round("p_value", 6).alias("p_value"))


@query(
    "zeropoint",
    f"""{OFFS}, z AS (SELECT *, quantile_cont(bmag, 0.4) OVER (PARTITION BY field) AS q, count(*) OVER (PARTITION BY field) AS n_matched FROM o),
y AS (SELECT *, count(*) FILTER (bmag <= q) OVER (PARTITION BY field) AS nb FROM z)
SELECT field, n_matched, count(*) AS n_used, CASE WHEN n_matched >= 50 THEN round(median(bmag - mag), 6) END AS zeropoint FROM y WHERE bmag <= q OR nb < 20 GROUP BY field, n_matched""",
)
def zeropoint(spark, d):
    z = stats.zeropoint(offsets(spark, d), ["field"], "mag", "bmag")
    return z.select("field", "n_matched", "n_used", F.round("zeropoint", 6).alias("zeropoint"))


@query("depth_zeropoint", f"{AB}, {near('a0', 'b0', 0.2, more=', a.field AS field, a.mag AS mag, b.mag AS bmag')}, n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tile, b_id ORDER BY sep, a_id) AS r FROM pairs WHERE sep < 0.2) WHERE r = 1) SELECT field, count(*) AS n, CASE WHEN count(*) >= 30 THEN round(median(mag - bmag), 6) END AS zeropoint FROM n GROUP BY field")
def depth_zeropoint(spark, d):
    p = match.nearest(match.radius_join(STARS.df(spark, d), REFERENCE.df(spark, d), 0.2, ["tile"]), "b_id", "a_id", 0.2, ["a_tile"])
    z = p.groupBy(F.col("a_field").alias("field")).agg(F.count(F.lit(1)).alias("n"), offset.median(F.col("a_mag") - F.col("b_mag")).alias("z"))
    return z.select("field", "n", F.when(F.col("n") >= 30, F.round("z", 6)).alias("zeropoint"))


@query(
    "detector_residuals",
    f"""{OFFS.replace('o AS (SELECT field, detector,', "o AS (SELECT field, 'nrc' || CASE WHEN detector < 4 THEN 'a' ELSE 'b' END || (detector % 4 + 1) AS detector,")}, m AS (SELECT field, detector, count(*) AS n, median(dra) AS mx, median(ddec) AS my FROM o GROUP BY ALL), dv AS (SELECT field, detector, median(abs(dra - mx)) * {M} AS sx, median(abs(ddec - my)) * {M} AS sy FROM o JOIN m USING (field, detector) GROUP BY ALL),
k AS (SELECT * FROM m JOIN dv USING (field, detector) WHERE n >= 10), f AS (SELECT field, median(mx) AS fx, median(my) AS fy FROM k GROUP BY field),
r AS (SELECT field, detector, n, mx - fx AS dra, my - fy AS ddec, sqrt(sx * sx + sy * sy) AS scatter FROM k JOIN f USING (field))
SELECT field, detector, n, round(dra, 5) AS dra, round(ddec, 5) AS ddec, round(scatter, 5) AS scatter, first(detector) OVER (PARTITION BY field ORDER BY sqrt(dra * dra + ddec * ddec) DESC, detector) AS worst,
  round(avg(dra) FILTER (contains(detector, 'nrca')) OVER (PARTITION BY field) - avg(dra) FILTER (contains(detector, 'nrcb')) OVER (PARTITION BY field), 5) AS module_dra FROM r""",
)
def detector_residuals(spark, d):
    named = F.concat(F.lit("nrc"), F.when(F.col("detector") < 4, "a").otherwise("b"), (F.col("detector") % 4 + 1).cast("string"))
    x = stats.detector_residuals(offsets(spark, d).withColumn("detector", named), "field", "detector", 10)
    return x.select("field", "detector", "n", *[F.round(c, 5).alias(c) for c in ("dra", "ddec", "scatter", "module_dra")], "worst")


SECOND = "flux * (1 + id % 7) / 4 / flux_err"  # the other band's S/N


@query(
    "interfilter_residual",
    f"""{OFFS}, g AS (SELECT *, count(*) OVER (PARTITION BY field) AS n FROM o WHERE flux / flux_err > 10 AND {SECOND} > 10), m AS (SELECT field, median(dra) AS mx, median(ddec) AS my FROM g WHERE n >= 200 GROUP BY field),
r AS (SELECT field, sqrt((dra - mx) * (dra - mx) + (ddec - my) * (ddec - my)) AS r FROM g JOIN m USING (field))
SELECT field, count(*) AS n, round(sqrt(avg(r * r)), 5) AS rms, round(avg(CASE WHEN r > 20 THEN 1.0 ELSE 0.0 END), 6) AS far FROM r GROUP BY field""",
)
def interfilter_residual(spark, d):
    from ..operators.verdicts import interfilter

    x = interfilter(offsets(spark, d).withColumns({"sn_a": F.col("flux") / F.col("flux_err"), "sn_b": F.expr(SECOND)}), ["field"])
    return x.select("field", "n", F.round("rms", 5).alias("rms"), F.round("far", 6).alias("far"))


FRAMES = """SELECT star * 8 + exposure AS id, exposure, 0 AS tile, 266.4::DOUBLE + (star % 100) / 3600.0::DOUBLE + (flux::BIGINT % 13 - 6) / 3600000.0::DOUBLE AS ra, -28.9::DOUBLE + floor(star / 100) / 3600.0::DOUBLE + (flux::BIGINT % 7 - 3) / 3600000.0::DOUBLE AS dec, -2.5 * log10(flux) AS mag FROM e"""


def frames(spark, d):
    e, whole = exposures(spark, d), F.round("flux").cast("long")
    return e.select(
        (F.col("star") * 8 + F.col("exposure")).alias("id"),
        "exposure",
        F.lit(0).alias("tile"),
        (266.4 + (F.col("star") % 100) / 3600 + (whole % 13 - 6) / 3.6e6).alias("ra"),
        (-28.9 + F.floor(F.col("star") / 100) / 3600 + (whole % 7 - 3) / 3.6e6).alias("dec"),
        (-2.5 * F.log10("flux")).alias("mag"),
    )


def leader_rounds(rounds: int) -> str:
    """CTEs that take detections one by one in the order of o: ``g`` has each one's leader."""
    out = "u0 AS MATERIALIZED (SELECT tile, id FROM d)"
    for r in range(rounds):
        leaders = "".join(f" UNION ALL SELECT id, true FROM t{q} WHERE id = leader" for q in range(r))
        out += f""", s{r} AS MATERIALIZED (SELECT id, false AS leads FROM u{r}{leaders}), v{r} AS MATERIALIZED (SELECT a_id AS id, first(b_id ORDER BY bo) AS b, first(leads ORDER BY bo) AS leads FROM pairs p JOIN u{r} a ON p.a_id = a.id JOIN s{r} b ON p.b_id = b.id WHERE bo < ao GROUP BY a_id),
t{r} AS MATERIALIZED (SELECT u.id, CASE WHEN b IS NULL THEN u.id ELSE b END AS leader FROM u{r} u LEFT JOIN v{r} v ON u.id = v.id WHERE b IS NULL OR leads), u{r + 1} AS MATERIALIZED (SELECT * FROM u{r} WHERE id NOT IN (SELECT id FROM t{r}))"""
    return out + ", g AS (" + " UNION ALL ".join(f"SELECT * FROM t{r}" for r in range(rounds)) + ")"


JITTER = FRAMES.replace("flux::BIGINT % 13 - 6", "round(flux)::BIGINT % 81 - 40").replace("(flux::BIGINT", "(round(flux)::BIGINT").replace("0 AS tile", "star % 4 AS tile")


@query(
    "frame_scatter",
    f"""{EXP}, x AS ({JITTER}), r AS (SELECT *, row_number() OVER (PARTITION BY tile, exposure ORDER BY mag, id) AS r, count(*) OVER (PARTITION BY tile, exposure) AS nf FROM x),
d AS MATERIALIZED (SELECT * FROM r WHERE r <= 2000 AND nf >= 20 AND exposure <= 12), {near('d', 'd', 0.04, more=', (a.exposure, a.mag, a.id) AS ao, (b.exposure, b.mag, b.id) AS bo').replace('pairs AS (', 'pairs AS MATERIALIZED (', 1)}, {leader_rounds(12)},
c AS (SELECT tile, median(dec) AS d0 FROM d GROUP BY tile HAVING count(*) >= 50), m AS (SELECT d.tile, leader, count(DISTINCT exposure) AS n_exposures, median(mag) AS mag, sqrt(power(stddev_pop(ra) * cos(radians(first(d0))), 2) + power(stddev_pop(dec), 2)) * 3600000 / sqrt(2) AS s FROM d JOIN g USING (id) JOIN c ON d.tile = c.tile GROUP BY d.tile, leader)
SELECT tile, leader, n_exposures, round(mag, 5) AS mag, round(s, 1) AS scatter FROM (SELECT *, count(*) OVER (PARTITION BY tile) AS n FROM m WHERE n_exposures >= 3 AND s > 0) WHERE n >= 50""",
)
def frame_scatter(spark, d):
    e, whole = exposures(spark, d), F.round("flux").cast("long")
    ra = 266.4 + (F.col("star") % 100) / 3600 + (whole % 81 - 40) / 3.6e6
    moved = e.select((F.col("star") * 8 + F.col("exposure")).alias("id"), (F.col("star") % 4).alias("tile"), ra.alias("ra"))
    f = frames(spark, d).drop("tile", "ra").join(moved, "id").withColumn("frame", F.col("exposure"))
    return stats.frame_scatter(f, ["tile"]).select("tile", "leader", "n_exposures", F.round("mag", 5).alias("mag"), F.round("scatter", 1).alias("scatter"))


@query("internal_rms", f"{EXP}, s AS (SELECT star, stddev_pop(qfit) / 1e7 AS std_ra, stddev_pop(err) / 1e8 AS std_dec, -28.9 AS dec, count(*) AS n FROM e GROUP BY star HAVING count(*) >= 3) SELECT star, round(sqrt(power(std_ra * cos(radians(dec)), 2) + std_dec * std_dec) * 3600000 / sqrt(2), 6) AS rms FROM s")
def internal_rms(spark, d):
    s = exposures(spark, d).groupBy("star").agg((F.stddev_pop("qfit") / 1e7).alias("std_ra"), (F.stddev_pop("err") / 1e8).alias("std_dec"), F.count(F.lit(1)).alias("n")).where("n >= 3").withColumn("dec", F.lit(-28.9))
    return s.select("star", F.round(stats.repeatability(s), 6).alias("rms"))


@query("formal_precision", f"{EXP}, f AS (SELECT *, qfit / 100 AS x_err, err / 1000 AS y_err, CASE WHEN exposure <= 4 THEN 31.0 ELSE 63.0 END AS scale FROM e WHERE NOT (exposure = 7 AND star % 2 = 0)) SELECT star, exposure, round(sqrt(x_err * x_err + y_err * y_err) * scale / sqrt(2), 6) AS precision FROM f")
def formal_precision(spark, d):
    e = exposures(spark, d).withColumns({"x_err": F.col("qfit") / 100, "y_err": F.col("err") / 1000, "scale": F.when(F.col("exposure") <= 4, 31.0).otherwise(63.0), "combined": F.col("exposure") == 7})
    return stats.formal_precision(e, ["exposure"], F.col("star") % 2 == 0, "combined").select("star", "exposure", F.round("precision", 6).alias("precision"))


@query(
    "external_rms",
    f"""{OFFS}, m AS (SELECT field, median(dra) AS mx, median(ddec) AS my FROM o GROUP BY field HAVING count(*) >= 50), r AS (SELECT field, mag, sqrt((dra - mx) * (dra - mx) + (ddec - my) * (ddec - my)) / sqrt(2) AS r FROM o JOIN m USING (field)),
{BINS.format(k='field', x='mag', y='r', t='r', w='TRUE')} SELECT field, centre, round(rms, 5) AS rms, n FROM curve""",
)
def external_rms(spark, d):
    return stats.external_curve(offsets(spark, d), ["field"]).select("field", "centre", F.round("rms", 5).alias("rms"), "n")


QUAL = f"""{EXP}, f AS (SELECT exposure, star % 3 AS vgroup, -2.5 * log10(flux) AS m, qfit * CASE WHEN exposure = 5 THEN 3 ELSE 1 END AS q FROM e), p AS (SELECT vgroup, exposure, quantile_cont(m, 0.2) AS p, count(*) AS c FROM f GROUP BY ALL HAVING count(*) >= 50),
quality AS (SELECT vgroup, exposure, median(q) AS quality, count(*) AS n FROM f JOIN p USING (vgroup, exposure) WHERE m < p GROUP BY ALL HAVING count(*) >= 30)"""


def quality(spark, d):
    f = exposures(spark, d).withColumns({"vgroup": F.col("star") % 3, "m": -2.5 * F.log10("flux"), "q": F.col("qfit") * F.when(F.col("exposure") == 5, 3).otherwise(1)})
    return stats.exposure_quality(f, ["vgroup", "exposure"], "m", "q")


@query("exposure_quality", f"{QUAL} SELECT vgroup, exposure, round(quality, 6) AS quality, n FROM quality")
def exposure_quality(spark, d):
    return quality(spark, d).select("vgroup", "exposure", F.round("quality", 6).alias("quality"), "n")


@query("streaked_exposures", f"{QUAL}, t AS (SELECT vgroup, median(quality) AS typical FROM quality GROUP BY vgroup) SELECT vgroup, exposure, quality > 2 * typical AS streaked FROM quality JOIN t USING (vgroup)")
def streaked_exposures(spark, d):
    return stats.streaked(quality(spark, d), ["vgroup"]).select("vgroup", "exposure", "streaked")


TURN = BINS.format(k="detector", x="m", y="s", t="q", w="s > 0")


@query(
    "saturation_turnover",
    f"""{STAR}, q AS (SELECT detector, mag + 14 AS m, CASE WHEN mag < -13.9 THEN 50 ELSE 5 END + cust % 10 AS s FROM a), {TURN}, t AS (SELECT detector, min(median) AS floor, median(centre) AS middle FROM curve GROUP BY detector)
SELECT detector, round(floor, 6) AS floor, min(centre) FILTER (median > 2 * floor AND centre < middle) AS turnover FROM curve JOIN t USING (detector) GROUP BY detector, floor""",
)
def saturation_turnover(spark, d):
    q = STARS.df(spark, d).withColumns({"m": F.col("mag") + 14, "s": (F.when(F.col("mag") < -13.9, 50).otherwise(5) + F.col("cust") % 10).cast("double")})
    return stats.turnover(stats.binned(q, ["detector"], "m", "s"), ["detector"]).select("detector", F.round("floor", 6).alias("floor"), "turnover")


@query(
    "nan_accounting",
    f"""{STAR}, x AS (SELECT module, field, CASE WHEN cust % 9 = 0 OR (module = 'B' AND field = '5-LOW') THEN 'NaN'::DOUBLE ELSE mag END AS v FROM a WHERE NOT (module = 'A' AND field = '2-HIGH')),
g AS (SELECT module, field FROM (VALUES ('A'), ('B')) t(module), (SELECT DISTINCT field FROM a)), n AS (SELECT module, field, count(*) AS n_raw, count(*) FILTER (isnan(v)) AS n_nan FROM x GROUP BY ALL)
SELECT module, field, coalesce(n_raw, 0) AS n_raw, coalesce(n_nan, 0) AS n_nan, n_nan / n_raw AS nan_fraction, n_raw IS NOT NULL AS present, coalesce(n_raw - n_nan < 50, false) AS dead FROM g LEFT JOIN n USING (module, field)""",
)
def nan_accounting(spark, d):
    a = STARS.df(spark, d)
    bad = (F.col("cust") % 9 == 0) | ((F.col("module") == "B") & (F.col("field") == "5-LOW"))
    x = a.where(~((F.col("module") == "A") & (F.col("field") == "2-HIGH"))).withColumn("v", F.when(bad, float("nan")).otherwise(F.col("mag")))
    expected = a.select("field").distinct().withColumn("module", F.explode(F.array(F.lit("A"), F.lit("B"))))
    return stats.nan_accounting(x, expected, ["module", "field"], "v")


@query("density_counts", f"{STAR} SELECT detector, floor(mag / 0.25)::BIGINT AS i, floor(flux_err / 1000)::BIGINT AS j, count(*) AS n, sum(cust)::BIGINT AS weight FROM a GROUP BY ALL")
def density_counts(spark, d):
    return stats.density(STARS.df(spark, d), ["detector"], "mag", "flux_err", 0.25, 1000.0, "cust")


@query("magnitude_counts", f"{STAR}, c AS (SELECT field, floor(mag / 0.5) AS b, count(*) AS n FROM a GROUP BY ALL) SELECT field, (b + 0.5::DOUBLE) * 0.5 AS centre, n, (first(b) OVER (PARTITION BY field ORDER BY n DESC, b) + 0.5::DOUBLE) * 0.5 AS peak FROM c")
def magnitude_counts(spark, d):
    return stats.magnitude_counts(STARS.df(spark, d), ["field"], "mag")


@query(
    "depth_counts",
    f"""{STAR}, b AS ({REFERENCE.sql}), w AS (SELECT tile, median(ra) AS r, median(dec) AS e FROM a GROUP BY tile), u AS (SELECT tile, 'ours' AS which, ra, dec, mag FROM a UNION ALL SELECT tile, 'theirs', ra, dec, mag - 25 FROM b)
SELECT tile, which, (floor(mag / 0.5) + 0.5::DOUBLE) * 0.5 AS centre, count(*) AS n FROM u JOIN w USING (tile) WHERE abs(ra - r) <= 0.005 AND abs(dec - e) <= 0.005 GROUP BY ALL""",
)
def depth_counts(spark, d):
    from ..operators.pixels import common_window

    a, b = STARS.df(spark, d), REFERENCE.df(spark, d).withColumn("mag", F.col("mag") - 25)
    both = a.select("tile", F.lit("ours").alias("which"), "ra", "dec", "mag").unionByName(b.select("tile", F.lit("theirs").alias("which"), "ra", "dec", "mag"))
    x = common_window(both, a, ["tile"], 0.005)
    return x.groupBy("tile", "which", ((F.floor(F.col("mag") / 0.5) + 0.5) * 0.5).alias("centre")).agg(F.count(F.lit(1)).alias("n"))


@query("weighted_median", f"{STAR}, c AS (SELECT field, mag, sum(cust) OVER (PARTITION BY field ORDER BY mag) AS c, sum(cust) OVER (PARTITION BY field) AS t FROM a) SELECT field, round(min(mag), 6) AS mag FROM c WHERE c >= t / 2 GROUP BY field")
def weighted_median(spark, d):
    return stats.weighted_median(STARS.df(spark, d), ["field"], "mag", "cust").select("field", F.round("mag", 6).alias("mag"))

"""Queries on composite verdicts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import match, offset, stats
from ..operators import pixels as P
from ..operators import verdicts as V
from .q_match import AB, ISOLATED, OFF, near, refine
from .q_pixels import APERTURES, CENTROIDS, PIX, box, pix
from .q_stats import BINS, QUAL, STAR, exposures, fit_rounds, map_ctes, null_ctes, offsets, quality
from .registry import query
from .standins import DENSE_PIXELS, DENSE_REFERENCE, INVENTORY, MODULE_A, MODULE_B, REFERENCE, STARS

INV = f"WITH f AS ({INVENTORY.sql})"
CH = "CASE WHEN substr(filter, 2, 3)::INT <= 212 THEN 'SW' ELSE 'LW' END"


#: Images of the inventory: those of one detector's module, or merged ones.
MODULE = "CASE WHEN k % 9 = 0 THEN 'merged' WHEN k % 2 = 0 THEN 'A' ELSE 'B' END"


@query(
    "stage_presence",
    f"""{INV}, n AS (SELECT DISTINCT field, obs, filter FROM f WHERE NOT (field = 'w51' AND {CH} = 'LW')), i AS (SELECT field, obs, filter, {MODULE} AS module FROM f WHERE mtime % 90 = 1),
p AS (SELECT field, obs, filter, bool_or(module = 'merged') AS m, bool_or(module = 'A') AS a, bool_or(module = 'B') AS b FROM i GROUP BY ALL), two AS (SELECT field, obs, bool_or(m OR (a AND b)) AS two FROM p GROUP BY ALL),
h AS (SELECT field, obs, filter, true AS have FROM p JOIN two USING (field, obs) WHERE m OR (a <> b AND NOT two)), j AS (SELECT field, obs, {CH} AS c, coalesce(have, false) AS have FROM n LEFT JOIN h USING (field, obs, filter)),
g AS (SELECT field, obs, count(*) FILTER (c = 'SW' AND have) AS sw, count(*) FILTER (c = 'LW' AND have) AS lw, count(*) FILTER (c = 'LW') AS l, count(*) FILTER (NOT have) AS missing FROM j GROUP BY ALL) SELECT field, obs, sw, lw, missing, sw > 0 AND (lw > 0 OR l = 0) AS passed FROM g""",
)
def stage_presence(spark, d):
    f = INVENTORY.df(spark, d)
    nominal = f.where(~((F.col("field") == "w51") & (V.S.channel(F.col("filter")) == "LW")))
    return V.presence(nominal, V.images(f.where("mtime % 90 = 1").withColumn("module", F.expr(MODULE)), ["field", "obs"]), ["field", "obs"])


#: Bands of a field: one has no long band, another's long band has no colours.
BANDS = "CASE WHEN field = '5-LOW' OR detector % 2 = 0 THEN 'F212N' ELSE 'F405N' END"
COLOUR = "CASE WHEN field = '3-MEDIUM' OR field = '5-LOW' THEN NULL ELSE (cust % 31) / cast(10 as double) END"
MODE = "b{n} AS (SELECT field, min(mag) AS lo, (max(mag) - min(mag)) / {n} AS w FROM u WHERE {w} GROUP BY field), g{n} AS (SELECT field, lo, w, least(floor((mag - lo) / w), {n} - 1) AS i, count(*) AS k FROM u JOIN b{n} USING (field) GROUP BY ALL), m{n} AS (SELECT field, first(lo + (i + 0.5::DOUBLE) * w ORDER BY k DESC, i) AS mode FROM g{n} GROUP BY field)"


@query(
    "stage_colour_magnitude",
    f"""{STAR}, c AS (SELECT field, mag, {COLOUR} AS colour, flux / flux_err > 10 AS high FROM a), band AS (SELECT field, NOT bool_or({CH.replace('filter', BANDS)} = 'LW') AS single_filter FROM a GROUP BY field),
v AS (SELECT * FROM c JOIN band USING (field) WHERE CASE WHEN single_filter THEN mag IS NOT NULL ELSE colour IS NOT NULL END), h AS (SELECT *, count(*) FILTER (high) OVER (PARTITION BY field) AS nh FROM v), u AS (SELECT * FROM h WHERE single_filter OR nh < 50 OR high),
{MODE.format(n=50, w='NOT single_filter')}, {MODE.format(n=60, w='single_filter')}, m AS (SELECT * FROM m50 UNION ALL SELECT * FROM m60), s AS (SELECT field, count(*) AS n, median(colour) FILTER (NOT single_filter) AS colour FROM u GROUP BY field)
SELECT field, single_filter, coalesce(n, 0) AS n, round(colour, 6) AS colour, round(mode, 6) AS mode, coalesce(n, 0) > 500 AS passed FROM band LEFT JOIN s USING (field) LEFT JOIN m USING (field)""",
)
def stage_colour_magnitude(spark, d):
    a = STARS.df(spark, d)
    c = a.select("field", "mag", F.expr(COLOUR).alias("colour"), (F.col("flux") / F.col("flux_err") > 10).alias("high"))
    x = V.colour_magnitude(c, a.select("field", F.expr(BANDS).alias("filter")).distinct(), ["field"])
    return x.select("field", "single_filter", "n", F.round("colour", 6).alias("colour"), F.round("mode", 6).alias("mode"), "passed")


@query(
    "stage_calibration",
    f"{STAR}, q AS (SELECT field, mag AS x, mag * 0.98 + (cust % 50) / 100.0::DOUBLE AS y FROM a), z AS (SELECT field, count(*) AS n_matched FROM q GROUP BY field), res AS (WITH q1 AS (SELECT * FROM q) {fit_rounds(5, 'q1').lstrip()}) SELECT field, n_matched, slope, scatter, slope > 0.8 AND slope < 1.2 AND scatter < 0.8 AS passed FROM z JOIN res USING (field)",
)
def stage_calibration(spark, d):
    a = STARS.df(spark, d).select("field", F.col("mag").alias("x"), (F.col("mag") * 0.98 + (F.col("cust") % 50) / 100).alias("y"))
    return V.calibration(a, ["field"], "x", "y").select("field", "n_matched", F.round("slope", 6).alias("slope"), F.round("scatter", 6).alias("scatter"), "passed")


@query("stage_registration")
def stage_registration(spark, d):
    """Verdicts of the stars, with the modules' own offset."""
    modules = offset.module_offset(MODULE_A.df(spark, d), MODULE_B.df(spark, d), ["tile"])
    x = V.registration(STARS.df(spark, d), DENSE_REFERENCE.df(spark, d), ["tile"], modules)
    return x.select("tile", "grid", *[F.round(c, 4).alias(c) for c in ("cell_off", "same_off", "bulk_off", "isolated_off", "module_off", "off")], "consistent", "unmeasurable", "low_confidence", "passed")


@query(
    "stage_intermodule",
    f"""{STAR}, m AS (SELECT field, count(DISTINCT module) AS modules, max(r) AS nan_fraction, bool_or(n - k < 50) AS red_flag FROM (SELECT field, module, count(*) AS n, count(*) FILTER (cust % 30 = 0) AS k, count(*) FILTER (cust % 30 = 0) / count(*) AS r FROM a GROUP BY ALL) GROUP BY field)
SELECT field, modules, CASE WHEN field = '5-LOW' THEN 20.0 ELSE 5.0 END AS off, round(nan_fraction, 6) AS nan_fraction, red_flag, CASE WHEN field = '5-LOW' THEN false ELSE nan_fraction <= 0.05 END AS passed FROM m""",
)
def stage_intermodule(spark, d):
    a = STARS.df(spark, d).withColumn("v", F.when(F.col("cust") % 30 == 0, float("nan")).otherwise(F.col("mag")))
    acc = stats.nan_accounting(a, a.select("field", "module").distinct(), ["field", "module"], "v")
    off = a.select("field").distinct().withColumn("off", F.when(F.col("field") == "5-LOW", 20.0).otherwise(5.0))
    return V.intermodule(off, acc, ["field"]).withColumn("nan_fraction", F.round("nan_fraction", 6))


#: Measurements of exposures: formal errors of all, repeated positions of one group.
MEASURED = "SELECT e.star % 3 AS vgroup, 'jw_' || (e.star % 3) || '_' || e.exposure AS name, exposure, -2.5 * log10(flux) + 30 AS mag, err * CASE WHEN exposure = 5 THEN 1 + star % 4 ELSE 2 END AS value, CASE WHEN star % 3 = 1 AND star % 5 = 0 THEN 'empirical' ELSE 'formal' END AS kind FROM e"
FLOORS = "floor_{v} AS (SELECT vgroup, kind, min(median) AS floor FROM curve_{v} GROUP BY ALL), wide_{v} AS (SELECT vgroup, max(floor) FILTER (kind = 'formal') AS formal, max(floor) FILTER (kind = 'empirical') AS empirical FROM floor_{v} GROUP BY vgroup)"


def curve(v: str, rows: str) -> str:
    x = BINS.format(k="vgroup, kind", x="mag", y="value", t=rows, w="value > 0").replace("b AS", f"b_{v} AS").replace("FROM b)", f"FROM b_{v})").replace("curve AS", f"curve_{v} AS")
    return f"{x}, {FLOORS.format(v=v)}"


@query(
    "stage_precision",
    f"""{QUAL}, t AS (SELECT vgroup, median(quality) AS typical FROM quality GROUP BY vgroup), bad AS (SELECT vgroup, exposure FROM quality JOIN t USING (vgroup) WHERE quality > 2 * typical), q AS ({MEASURED}),
clean AS (SELECT q.* FROM q ANTI JOIN bad USING (vgroup, exposure)), {curve('all', 'q')}, {curve('clean', 'clean')}, x AS (SELECT vgroup, count(*) AS excluded FROM bad GROUP BY vgroup)
SELECT vgroup, round(a.formal, 6) AS formal, round(a.empirical, 6) AS empirical, round(coalesce(a.empirical, a.formal), 6) AS floor, coalesce(excluded, 0) AS excluded, CASE WHEN excluded > 0 THEN round(coalesce(c.empirical, c.formal), 6) END AS clean_floor, coalesce(a.empirical, a.formal) IS NOT NULL AS passed
FROM wide_all a LEFT JOIN wide_clean c USING (vgroup) LEFT JOIN x USING (vgroup)""",
)
def stage_precision(spark, d):
    flagged = stats.streaked(quality(spark, d), ["vgroup"]).where("streaked")
    tokens = flagged.select("vgroup", F.format_string("vgroup%d_exp%d", "vgroup", "exposure").alias("token"))
    e = exposures(spark, d)
    mag, value = -2.5 * F.log10("flux") + 30, F.col("err") * F.when(F.col("exposure") == 5, 1 + F.col("star") % 4).otherwise(2)
    kind = F.when((F.col("star") % 3 == 1) & (F.col("star") % 5 == 0), "empirical").otherwise("formal")
    measured = e.select((F.col("star") % 3).alias("vgroup"), F.format_string("jw_%d_%d", F.col("star") % 3, F.col("exposure")).alias("name"), mag.alias("mag"), value.cast("double").alias("value"), kind.alias("kind"))
    x = V.precision_with_and_without(measured, tokens, ["vgroup"], "name")
    return x.select("vgroup", *[F.round(k, 6).alias(k) for k in ("formal", "empirical", "floor")], "excluded", F.round("clean_floor", 6).alias("clean_floor"), "passed")


@query(
    "stage_archive",
    f"{STAR}, o AS (SELECT field, obs, CASE WHEN count(*) % 4 <> 0 THEN (count(*) % 37)::DOUBLE END AS ours, count(*) % 5 <> 0 AS img, CASE WHEN count(*) % 3 <> 0 THEN (count(*) % 29)::DOUBLE END AS theirs FROM a GROUP BY ALL) SELECT field, obs, ours, theirs, coalesce(ours < theirs, false) AS tighter, ours IS NULL AS red_flag, img AND ours IS NOT NULL AND (theirs IS NULL OR ours <= theirs + 5) AS passed FROM o",
)
def stage_archive(spark, d):
    c = STARS.df(spark, d).groupBy("field", "obs").agg(F.count(F.lit(1)).alias("c"))
    ours = c.select("field", "obs", F.when(F.col("c") % 4 != 0, (F.col("c") % 37).cast("double")).alias("off"), (F.col("c") % 5 != 0).alias("has_image"))
    theirs = c.where("c % 3 <> 0").select("field", "obs", (F.col("c") % 29).cast("double").alias("off"))
    return V.against_archive(ours, theirs, ["field", "obs"])


@query(
    "stage_distortion",
    f"""{map_ctes("field")}, {null_ctes("field")}, far AS (SELECT field, count(*) AS n_stars, {offset.MAD} * sqrt(pow(mad(dra), 2) + pow(mad(ddec), 2)) AS rms, avg((sqrt(dra * dra + ddec * ddec) > 20)::INT) AS frac_far FROM o GROUP BY field),
per AS (SELECT field, count(*) AS cells, median(n)::DOUBLE AS stars_per_cell FROM cells GROUP BY field), nulls AS (SELECT field, median(a) AS null_amp, (count(*) FILTER (a >= amp90) + 1) / 21 AS p_value FROM n JOIN real USING (field) GROUP BY field),
every AS (SELECT DISTINCT field FROM ({STARS.sql}))
SELECT field, n_stars, round(rms, 5) AS resid_rms, round(frac_far, 6) AS frac_far, CASE WHEN n_stars > 0 THEN round(coalesce(amp90, 0), 5) END AS amp90, CASE WHEN n_stars > 0 THEN coalesce(cells, 0) END AS cells, CASE WHEN n_stars > 0 THEN coalesce(stars_per_cell, 0) END AS stars_per_cell,
round(rms / sqrt(greatest(coalesce(stars_per_cell, 0), 1)), 5) AS cell_sem, round(null_amp, 5) AS null_amp, CASE WHEN null_amp > 0 THEN round(amp90 / null_amp, 5) WHEN null_amp = 0 THEN 'inf'::DOUBLE END AS significance, round(p_value, 6) AS p_value,
coalesce(amp90, 0) > 15 AS red_flag, n_stars IS NOT NULL AS measurable, CASE WHEN n_stars > 0 THEN coalesce(cells, 0) >= 3 END AS passed
FROM every LEFT JOIN far USING (field) LEFT JOIN per USING (field) LEFT JOIN real USING (field) LEFT JOIN nulls USING (field)""",
)
def stage_distortion(spark, d):
    x = V.distortion(offsets(spark, d), ["field"], STARS.df(spark, d))
    rounded = {c: F.round(c, 5) for c in ("resid_rms", "amp90", "cell_sem", "null_amp", "significance")}
    return x.withColumns({**rounded, "frac_far": F.round("frac_far", 6), "p_value": F.round("p_value", 6)})


#: Pixels with a round star of scale 1.2 near each node of a lattice 14 apart, over the noise that the prices are.
NODE = {"gx": "11 + 14 * cast(floor((x - 4) / 14.0) as bigint)", "gy": "11 + 14 * cast(floor((y - 4) / 14.0) as bigint)"}
SUB = {"ox": "((gx * 7 + gy * 3) % 7 - 3) / cast(10 as double)", "oy": "((gx * 3 + gy * 5) % 7 - 3) / cast(10 as double)", "amp": "400 + (gx * 13 + gy * 5) % 300"}
GLOW = "CASE WHEN value IS NULL AND dq = 3 THEN NULL ELSE coalesce(value, 0) / 100 END + amp * exp(-(power(x - gx - ox, 2) + power(y - gy - oy, 2)) / cast(2.88 as double))"
PLANTED = {"id": "gy * 128 + gx", "sx": "gx + ox + (gx % 3) / cast(5 as double)", "sy": "gy + oy", "flux": "amp * cast(9.05 as double) * (1 + ((gx * 5 + gy) % 21 - 10) / cast(400 as double))"}


def columns(x: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {c}" for c, e in x.items())


@query(
    "stage_photometry",
    f"""WITH p0 AS ({DENSE_PIXELS.sql}), p1 AS (SELECT *, {columns(NODE)} FROM p0), p2 AS (SELECT *, {columns(SUB)} FROM p1), p AS (SELECT image, y, x, dq, {GLOW} AS value FROM p2),
s0 AS (SELECT image, {columns(PLANTED)} FROM p2 WHERE x = gx AND y = gy), size AS (SELECT image, max(x) + 1 AS nx, max(y) + 1 AS ny FROM p GROUP BY image),
alone AS (SELECT * FROM s0 JOIN size USING (image) WHERE sx > 10 AND sx < nx - 10 AND sy > 10 AND sy < ny - 10 AND NOT EXISTS (SELECT 1 FROM s0 o WHERE o.image = s0.image AND o.id <> s0.id AND sqrt(power(s0.sx - o.sx, 2) + power(s0.sy - o.sy, 2)) <= 12)),
taken AS (SELECT *, 0 AS mag FROM alone QUALIFY row_number() OVER (PARTITION BY image ORDER BY flux DESC, id) <= 20000), moved AS (WITH s AS (SELECT * FROM taken), {CENTROIDS} SELECT image, id, cx, cy, sqrt(power(cx - ox, 2) + power(cy - oy, 2)) AS moved FROM centroid),
measured AS (WITH s AS (SELECT image, id, cx AS sx, cy AS sy, 0 AS mag FROM moved), {APERTURES.format(box=box(9))} SELECT * FROM aperture),
x AS (SELECT t.image, m.moved, CASE WHEN a.flux > 0 AND t.flux > 0 AND a.flux / nullif(a.sky_std * sqrt(pi() * 9), 0) > 30 AND m.moved < 3 THEN -2.5 * log10(CASE WHEN a.flux > 0 THEN a.flux END) + 2.5 * log10(t.flux) END AS dm FROM taken t JOIN moved m USING (image, id) LEFT JOIN measured a USING (image, id)),
shift AS (SELECT image, count(*) AS isolated, median(moved) AS shift, count(dm) AS n FROM x GROUP BY image), good AS (SELECT * FROM x JOIN shift USING (image) WHERE dm IS NOT NULL AND isolated >= 50 AND n >= 50),
mid AS (SELECT image, median(dm) AS correction FROM good GROUP BY image), off AS (SELECT image, correction, median(abs(dm - correction)) * {offset.MAD} AS scatter, avg(CASE WHEN abs(dm - correction) > 0.3 THEN 1.0 ELSE 0.0 END) AS tail FROM good JOIN mid USING (image) GROUP BY ALL)
SELECT image, coalesce(isolated, 0) AS isolated, CASE WHEN isolated >= 50 THEN n END AS n, CASE WHEN isolated >= 50 THEN round(shift, 6) END AS shift, CASE WHEN isolated >= 50 THEN shift > 2 END AS mismatch, round(correction, 6) AS correction, round(scatter, 6) AS scatter, round(tail, 6) AS tail,
  CASE WHEN coalesce(isolated, 0) < 50 THEN 'too few isolated stars' WHEN n < 50 THEN 'too few clean stars after quality gate' END AS reason, coalesce(isolated, 0) < 50 OR n < 50 AS red_flag, coalesce(scatter < 0.15 AND tail < 0.05, false) AS passed
FROM (SELECT DISTINCT image FROM s0) LEFT JOIN shift USING (image) LEFT JOIN off USING (image)""",
)
def stage_photometry(spark, d):
    p = pix(spark, d)
    for step in (NODE, SUB):
        p = p.withColumns({c: F.expr(e) for c, e in step.items()})
    stars = p.where("x = gx and y = gy").select("image", *[F.expr(e).alias(c) for c, e in PLANTED.items()])
    x = V.photometry(P.psf_against_aperture(stars, p.select("image", "y", "x", "dq", F.expr(GLOW).alias("value"))))
    return x.withColumns({c: F.round(c, 6) for c in ("shift", "correction", "scatter", "tail")})


@query(
    "stage_multi_exposure",
    f"""{STAR}, q AS (SELECT field, mag + 14 AS m, CASE WHEN mag < -13.9 THEN 50 ELSE 5 END + cust % 10 AS s FROM a), {BINS.format(k='field', x='m', y='s', t='q', w='s > 0')}, t AS (SELECT field, min(median) AS floor, median(centre) AS middle FROM curve GROUP BY field)
SELECT field, round(floor, 6) AS floor, min(centre) FILTER (median > 2 * floor AND centre < middle) AS turnover, true AS passed FROM curve JOIN t USING (field) GROUP BY field, floor""",
)
def stage_multi_exposure(spark, d):
    q = STARS.df(spark, d).withColumns({"m": F.col("mag") + 14, "s": (F.when(F.col("mag") < -13.9, 50).otherwise(5) + F.col("cust") % 10).cast("double")})
    return V.multi_exposure(stats.binned(q, ["field"], "m", "s"), ["field"]).withColumn("floor", F.round("floor", 6))


@query(
    "stage_exposures",
    f"{QUAL}, t AS (SELECT vgroup, median(quality) AS typical FROM quality GROUP BY vgroup) SELECT vgroup, count(*) AS n, count(*) FILTER (quality > 2 * typical) AS n_streaked, first(exposure ORDER BY quality DESC, exposure) AS worst, count(*) FILTER (quality > 2 * typical) = 0 AS passed FROM quality JOIN t USING (vgroup) GROUP BY vgroup",
)
def stage_exposures(spark, d):
    return V.exposures(quality(spark, d), ["vgroup"])


@query("stage_mid_infrared", f"{PIX}, f AS (SELECT image, avg(CASE WHEN value IS NULL THEN 0.0 ELSE 1.0 END) AS f, avg(CASE WHEN (dq & 2) > 0 THEN 1.0 ELSE 0.0 END) AS s FROM p GROUP BY image) SELECT image, round(f, 6) AS finite, round(s, 6) AS saturated, f > 0.2 AS passed FROM f")
def stage_mid_infrared(spark, d):
    x = V.mid_infrared(P.finite_fraction(pix(spark, d), ["image"]), ["image"])
    return x.select("image", F.round("finite", 6).alias("finite"), F.round("saturated", 6).alias("saturated"), "passed")


BAND = "CASE detector % 4 WHEN 0 THEN 'F182M' WHEN 1 THEN 'F212N' WHEN 2 THEN 'F405N' ELSE 'F444W' END"


@query(
    "channel_anchor",
    f"""{STAR}, q AS (SELECT id, tile, ra, dec, {BAND} AS filter, CASE WHEN detector % 4 < 2 THEN 'SW' ELSE 'LW' END AS channel FROM a), n AS (SELECT tile, channel, filter, count(*) AS c FROM q GROUP BY ALL), h AS (SELECT tile, channel, first(filter ORDER BY c DESC, filter DESC) AS anchor FROM n GROUP BY ALL HAVING count(*) > 1),
t AS (SELECT id, ra, dec, filter, channel, anchor, tile AS field, tile * 10 + (channel = 'SW')::INT AS tile FROM q JOIN h USING (tile, channel)), t1 AS (SELECT * FROM t WHERE filter <> anchor), t2 AS (SELECT * FROM t WHERE filter = anchor),
{near('t1', 't2', 2.5, more=', a.filter AS filter, a.anchor AS anchor, a.channel AS channel, a.field AS field')}, g AS (SELECT DISTINCT tile, filter, anchor, channel, field FROM pairs), off AS ({OFF.format(keys='tile', pairs='pairs')}), {refine('tile', 2.5)}
SELECT field AS tile, channel, filter, anchor, round(sqrt(cx * cx + cy * cy) * 1000, 4) AS off, npairs, coalesce(sqrt(cx * cx + cy * cy) * 1000 > 30 AND top / background >= 4 AND npairs >= 100, false) AS flagged FROM c4 JOIN g USING (tile)""",
)
def channel_anchor(spark, d):
    a = STARS.df(spark, d).selectExpr("id", "tile", "ra", "dec", f"{BAND} AS filter")
    x = V.channel_anchor(a, ["tile"], 100)
    return x.select("tile", "channel", "filter", "anchor", F.round("off", 4).alias("off"), "npairs", "flagged")


@query(
    "field_audit",
    f"""{AB}, {near('a0', 'b0', 2.5, more=', a.field AS field')}, off AS ({OFF.format(keys='field', pairs='pairs')}), {refine('field', 2.5)}, x AS (SELECT field, sqrt(cx * cx + cy * cy) * 1000 AS o FROM c4)
SELECT field, round(o, 5) AS absolute, CASE WHEN field = '5-LOW' THEN 16.0 ELSE 3.0 END AS modules, concat_ws('|', CASE WHEN field = '5-LOW' THEN 'modules' END, CASE WHEN field < '3' THEN 'filters' END, CASE WHEN o > 75 THEN 'absolute' END) AS flags FROM x""",
)
def field_audit(spark, d):
    p = offset.pair_offsets(match.radius_join(STARS.df(spark, d), REFERENCE.df(spark, d), 2.5, ["tile"])).select(F.col("a_field").alias("field"), "dra", "ddec")
    absolute = offset.xcorr(p, ["field"])
    fields = STARS.df(spark, d).select("field").distinct()
    modules = fields.withColumn("off", F.when(F.col("field") == "5-LOW", 16.0).otherwise(3.0))
    x = V.field_audit(modules, fields.withColumn("flagged", F.col("field") < "3"), absolute, "field")
    return x.select("field", F.round("absolute", 5).alias("absolute"), "modules", F.array_join("flags", "|").alias("flags"))


@query(
    "whole_field",
    f"""{AB}, {near('a0', 'b0', 2.5, name='wide')}, off AS ({OFF.format(keys='tile', pairs='wide')}), {refine('tile', 2.5)}, {ISOLATED},
w AS (SELECT tile, sqrt(cx * cx + cy * cy) * 1000 AS off, top / background AS ratio, sqrt(power(cx * 1000 - x, 2) + power(cy * 1000 - y, 2)) AS apart FROM c4 LEFT JOIN (SELECT * FROM k WHERE reason IS NULL) USING (tile) WHERE c4.npairs >= 30)
SELECT tile, round(off, 4) AS off, round(ratio, 4) AS peak_ratio, round(apart, 4) AS apart, coalesce(apart > 50, false) AS low_confidence FROM w""",
)
def whole_field(spark, d):
    a, b = STARS.df(spark, d), REFERENCE.df(spark, d)
    bulk = offset.bulk_offset(a, b, ["tile"])
    x = V.whole_field(bulk, offset.isolated_bulk(a, b, ["tile"]), ["tile"])
    return x.select("tile", *[F.round(c, 4).alias(c) for c in ("off", "peak_ratio", "apart")], "low_confidence")


@query("verdict_table", f"{INV}, s AS (SELECT field, count(*) % 2 = 0 AS p1, count(*) % 3 = 0 AS p2 FROM f GROUP BY field) SELECT field, p1 AND p2 AND field <> 'w51' OR (field = 'w51' AND p1 AND p2) AS passed, concat_ws('|', CASE WHEN NOT p1 THEN 'stage1' END, CASE WHEN NOT p2 THEN 'stage2' END) AS failed FROM s")
def verdict_table(spark, d):
    s = INVENTORY.df(spark, d).groupBy("field").agg(F.count(F.lit(1)).alias("c"))
    rows = V.verdict_rows({"stage1": s.withColumn("passed", F.col("c") % 2 == 0), "stage2": s.withColumn("passed", F.col("c") % 3 == 0), "stage8": s.withColumn("passed", F.lit(None).cast("boolean"))}, "field")
    return V.all_pass(rows, "field").select("field", "passed", F.array_join("failed", "|").alias("failed"))

"""Queries on scalar rules and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import select as P
from .registry import query, table
from .standins import INVENTORY, POLL_1, REFERENCE, STARS, EXPOSURE_SQL, exposures

POLL = f"WITH p AS ({POLL_1.sql})"
INV = f"WITH f AS ({INVENTORY.sql})"
STAR = f"WITH a AS ({STARS.sql})"


@query(
    "parse_obs_id",
    f"""{POLL}, x AS (SELECT k, CASE k % 3 WHEN 0 THEN obs_id WHEN 1 THEN 'jw02221' || lpad((k % 1000)::VARCHAR, 3, '0') || '001_x' ELSE 'hst_' || k END AS obs_id FROM p)
SELECT k, obs_id, coalesce(nullif(regexp_extract(obs_id, '^jw(\\d{{5}})-o(\\d{{3}})', 2), ''), regexp_extract(obs_id, '^jw(\\d{{5}})(\\d{{3}})\\d{{3}}', 2)) AS obsnum FROM x""",
)
def parse_obs_id(spark, d):
    other = F.concat(F.lit("jw02221"), F.lpad((F.col("k") % 1000).cast("string"), 3, "0"), F.lit("001_x"))
    x = POLL_1.df(spark, d).select("k", F.when(F.col("k") % 3 == 0, F.col("obs_id")).when(F.col("k") % 3 == 1, other).otherwise(F.concat(F.lit("hst_"), "k")).alias("obs_id"))
    return x.select("k", "obs_id", S.obsnum(F.col("obs_id")).alias("obsnum"))


@query(
    "parse_filters",
    f"""{POLL}, x AS (SELECT k, [u for u in [upper(trim(t)) for t in string_split_regex(coalesce(filters, ''), '[;,]')] if regexp_matches(u, '^F\\d{{3,4}}[WNM]2?$')] AS l FROM p)
SELECT k, array_to_string(list_filter(l, lambda t, i: list_position(l, t) = i), '|') AS filters FROM x""",
)
def parse_filters(spark, d):
    return POLL_1.df(spark, d).select("k", F.array_join(S.parse_filters(F.col("filters")), "|").alias("filters"))


@query(
    "instrument_class",
    f"""{POLL}, x AS (SELECT k, upper(trim(split_part(coalesce(instrument_name, ''), '/', 1))) AS h FROM p)
SELECT k, CASE WHEN starts_with(h, 'NIRCAM') THEN 'NIRCam' WHEN starts_with(h, 'MIRI') THEN 'MIRI' ELSE upper(h[1:1]) || lower(h[2:]) END AS instrument FROM x""",
)
def instrument_class(spark, d):
    return POLL_1.df(spark, d).select("k", S.instrument_class(F.col("instrument_name")).alias("instrument"))


@query(
    "mjd_iso",
    f"""{POLL} SELECT k, coalesce(strftime(make_timestamp(((t_obs_release + 0.25 - 40587.0) * 86400000000)::BIGINT), '%Y-%m-%d %H:%M UTC'), 'unknown') AS released,
  CASE WHEN isnan(s_ra) THEN NULL ELSE s_ra END AS s_ra, round(t_obs_release + 0.25 - 40587, 6) AS days FROM p""",
)
def mjd_iso(spark, d):
    mjd = F.col("t_obs_release") + 0.25
    return POLL_1.df(spark, d).select("k", S.mjd_to_text(mjd).alias("released"), S.none_if_nan(F.col("s_ra")).alias("s_ra"), F.round(S.timestamp_to_mjd(F.timestamp_seconds((mjd - 40587) * 86400)) - 40587, 6).alias("days"))


@query(
    "pm_propagate",
    f"{STAR} SELECT id, round(ra + (cust % 9) * 3.5 / 3600000 / cos(radians(dec)), 9) AS ra, round(CASE WHEN cust % 7 = 0 THEN dec ELSE dec + (cust % 11 - 5) * 3.5 / 3600000 END, 9) AS dec FROM a",
)
def pm_propagate(spark, d):
    pm_dec = F.when(F.col("cust") % 7 == 0, F.lit(float("nan"))).otherwise((F.col("cust") % 11 - 5).cast("double"))
    ra, dec = S.propagate(F.col("ra"), F.col("dec"), (F.col("cust") % 9).cast("double"), pm_dec, F.lit(3.5))
    return STARS.df(spark, d).select("id", F.round(ra, 9).alias("ra"), F.round(dec, 9).alias("dec"))


@query(
    "sigma_propagate",
    f"{STAR} SELECT id, round(sqrt(power(detector + 1, 2) + power(6.25 * CASE WHEN cust % 3 = 0 THEN 2.0 ELSE cust % 5 END, 2)), 6) AS sigma FROM a",
)
def sigma_propagate(spark, d):
    e = F.when(F.col("cust") % 3 != 0, (F.col("cust") % 5).cast("double"))
    return STARS.df(spark, d).select("id", F.round(S.propagated_sigma((F.col("detector") + 1).cast("double"), e, F.lit(-6.25)), 6).alias("sigma"))


WCS = {"crval1": 266.41, "crval2": -28.89, "crpix1": 512.5, "crpix2": 500.0, "cd11": -8.0e-6, "cd12": 1.0e-6, "cd21": 1.2e-6, "cd22": 8.2e-6}


@query(
    "tan_project",
    f"""{STAR}, w AS (SELECT *, radians(ra) AS al, radians(dec) AS de, radians(266.41) AS a0, radians(-28.89) AS d0 FROM a),
c AS (SELECT *, sin(d0) * sin(de) + cos(d0) * cos(de) * cos(al - a0) AS cc FROM w),
t AS (SELECT id, degrees(cos(de) * sin(al - a0) / cc) AS xi, degrees((cos(d0) * sin(de) - sin(d0) * cos(de) * cos(al - a0)) / cc) AS eta FROM c)
SELECT id, round((8.2e-6 * xi - 1e-6 * eta) / (-8e-6 * 8.2e-6 - 1e-6 * 1.2e-6) + 512.5, 5) AS x, round((-8e-6 * eta - 1.2e-6 * xi) / (-8e-6 * 8.2e-6 - 1e-6 * 1.2e-6) + 500, 5) AS y, true AS back FROM t""",
)
def tan_project(spark, d):
    w = {k: F.lit(v) for k, v in WCS.items()}
    x, y = S.tan_to_pixel(F.col("ra"), F.col("dec"), w)
    ra, dec = S.pixel_to_tan(F.col("x"), F.col("y"), w)
    p = STARS.df(spark, d).withColumns({"x": x, "y": y})
    return p.select("id", F.round("x", 5).alias("x"), F.round("y", 5).alias("y"), ((F.abs(ra - F.col("ra")) < 1e-9) & (F.abs(dec - F.col("dec")) < 1e-9)).alias("back"))


@query(
    "catalogue_tier",
    f"""{INV} SELECT k, name, CASE WHEN contains(name, 'm8_dedup') THEN 8 WHEN contains(name, '_m3') THEN 3 WHEN contains(name, '_m6') THEN 6 ELSE 0 END AS tier,
  CASE k % 4 WHEN 0 THEN CASE WHEN contains(name, '_m8') THEN 'release m8' WHEN contains(name, '_m3') THEN 'release m3' WHEN contains(name, '_m6') THEN 'release m6' ELSE 'release' END WHEN 1 THEN 'per-filter DAO positions' WHEN 2 THEN 'MAST catalogue' ELSE 'release catalogue' END AS label FROM f""",
)
def catalogue_tier(spark, d):
    k = F.col("k")
    source = F.when(k % 4 == 0, F.concat(F.lit("release: "), "name")).when(k % 4 == 1, "per-filter Dao").when(k % 4 == 2, F.concat(F.lit("MAST "), "name"))
    return INVENTORY.df(spark, d).select("k", "name", S.catalogue_tier(F.upper("name")).alias("tier"), S.source_label(source).alias("label"))


@query(
    "name_tokens",
    f"""{INV} SELECT k, nullif(regexp_extract(name, '-o(\\d{{3}})', 1), '') AS obs, nullif(regexp_extract(name, '_(20\\d{{6}})(?:[_.]|$)', 1), '') AS date, upper(nullif(regexp_extract(name, 'nrc([ab])', 1), '')) AS module,
  nullif(regexp_extract(name, '(nrc[ab](?:\\d|long))', 1), '') AS detector, CASE WHEN substr(filter, 2, 3)::INT <= 212 THEN 'SW' ELSE 'LW' END AS channel FROM f""",
)
def name_tokens(spark, d):
    t = S.name_tokens(F.col("name"))
    return INVENTORY.df(spark, d).select("k", *[t[c].alias(c) for c in ("obs", "date", "module", "detector")], S.channel(F.col("filter")).alias("channel"))


@query(
    "epoch",
    f"""{POLL} SELECT k, round(CASE WHEN t_obs_release IS NOT NULL THEN 2000 + (t_obs_release - 51544.5) / 365.25 ELSE nullif(regexp_extract(n, '(?:^|[_-])((?:19|20)\\d{{2}}(?:\\.\\d+)?)(?:[_-]|\\.[a-z]|$)', 1), '')::DOUBLE END, 6) AS epoch
FROM (SELECT *, CASE WHEN k % 2 = 0 THEN 'ref_20' || lpad((k % 30)::VARCHAR, 2, '0') || '.5_x.fits' ELSE 'plain.fits' END AS n FROM p)""",
)
def epoch(spark, d):
    n = F.when(F.col("k") % 2 == 0, F.concat(F.lit("ref_20"), F.lpad((F.col("k") % 30).cast("string"), 2, "0"), F.lit(".5_x.fits"))).otherwise("plain.fits")
    return POLL_1.df(spark, d).select("k", F.round(S.epoch(F.col("t_obs_release"), n), 6).alias("epoch"))


@query(
    "asinh_stretch",
    f"{STAR} SELECT id, round(asinh(least(1.0, greatest(0.0, (flux - 50000) / 300000)) / 0.1) / asinh(10.0), 6) AS stretched, round(-2.5 * log10(flux), 6) AS mag, (cust & 2) > 0 AS saturated FROM a",
)
def asinh_stretch(spark, d):
    return STARS.df(spark, d).select(
        "id", F.round(S.asinh_stretch(F.col("flux"), F.lit(50000.0), F.lit(350000.0)), 6).alias("stretched"), F.round(S.instrumental_mag(F.col("flux")), 6).alias("mag"), S.saturated(F.col("cust")).alias("saturated")
    )


@query(
    "keys_and_text",
    f"""{POLL}, o AS (SELECT *, right(obs_id, 3) AS obs FROM p) SELECT k, printf('jw%05d-o%s', program, obs) AS obsid, program || '-o' || obs AS trigger, program || '-o' || obs || CASE WHEN k % 3 = 2 THEN '-MIRI' ELSE '-NIRCam' END AS download,
  'GC ' || chr(8212) || printf(' jw%05d-o%s (MIRI)', program, obs) AS title, printf('jw%05d-o%s', program, obs) || CASE WHEN k % 2 = 0 THEN '-002-998' ELSE '' END AS mosaic, '/base/brick/*/pipeline/' || printf('jw%05d-o%s', program, obs) || '*_t001_nircam_*i2d.fits' AS product_glob,
  k % 6 < 3 AS token_ok, CASE k % 4 WHEN 0 THEN 'LOW DISK' WHEN 1 THEN 'CAPPED' END AS downgrade, CASE WHEN k % 5 = 0 THEN NULL WHEN k % 5 = 1 THEN NULL ELSE k + 0.5::DOUBLE END AS number FROM o""",
)
def keys_and_text(spark, d):
    k, program, obs = F.col("k"), F.col("program"), F.expr("right(obs_id, 3)")
    inst = F.when(k % 3 == 0, "NIRCam").when(k % 3 == 1, "").otherwise("MIRI")
    token = F.element_at(F.array(*[F.lit(t) for t in ("1", "001-002", "9999", "12345", "001-", "x1")]), (k % 6 + 1).cast("int"))
    notice = F.when(k % 4 == 0, "LOW DISK: 3.1 TB free").when(k % 4 == 1, "CAPPED \u2014 9 group(s)").when(k % 4 == 2, "SEED RUN, LOW DISK")
    text = F.when(k % 5 == 0, "n/a").when(k % 5 == 1, "NaN").otherwise((k + 0.5).cast("string"))
    return POLL_1.df(spark, d).select(
        "k",
        S.obsid(program, obs).alias("obsid"),
        S.trigger_key(program, obs).alias("trigger"),
        S.download_key(program, obs, inst).alias("download"),
        S.observation_title(F.lit("GC"), program, obs, F.lit("MIRI")).alias("title"),
        S.mosaic_obsid(program, obs, F.when(k % 2 == 0, F.array(F.lit("002"), F.lit("998")))).alias("mosaic"),
        S.product_glob(F.lit("/base"), F.lit("brick"), program, obs, F.lit("NIRCam")).alias("product_glob"),
        S.is_obs_token(token).alias("token_ok"),
        S.downgrade_class(notice).alias("downgrade"),
        S.safe_double(text).alias("number"),
    )


@query(
    "midpoint_band",
    """SELECT o_orderkey AS k, ['8um', '8um', '8um', '8um', '8um', '24um', '24um', '24um', '24um', NULL, NULL][o_orderkey % 11 + 1] AS band FROM orders""",
)
def midpoint_band(spark, d):
    names = ("F560W", "f770w", "F1000W", "F1130W", "F1280W", "F1500W", "F1800W", "F2100W", "F2550W", "F212N", "F1000M")
    name = F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("o_orderkey") % 11 + 1).cast("int"))
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), S.midpoint_band(name).alias("band"))


@query(
    "job_ids",
    """SELECT o_orderkey AS k, CASE o_orderkey % 3 WHEN 0 THEN o_custkey || '|' || (o_custkey + 9000007) || '|777' WHEN 1 THEN o_custkey || '|' || (o_custkey + 9000007) ELSE '' END AS jobs FROM orders WHERE o_custkey <> 777""",
)
def job_ids(spark, d):
    n, m = F.col("o_custkey").cast("string"), (F.col("o_custkey") + 9000007).cast("string")
    bare = F.concat(n, F.lit("\n"), m, F.lit(";nova\nSubmitted batch job 777\njobid: 5"))
    told = F.concat(F.lit("Submitted batch job "), n, F.lit("\nSubmitted batch job "), m, F.lit("\n  "), n, F.lit("  \nnot 3"))
    text = F.when(F.col("o_orderkey") % 3 == 0, bare).when(F.col("o_orderkey") % 3 == 1, told)
    return table(spark, d, "orders").where("o_custkey <> 777").select(F.col("o_orderkey").alias("k"), F.array_join(S.job_ids(text), "|").alias("jobs"))


#: Verdicts with the state of their star check and whether they pass.
VERDICTS = [
    ('{"pass": true, "checks": {"star_positions": {"pass": true}}}', "pass", True), ('{"pass": false, "checks": {"star_positions": {"pass": false}}}', "fail", False),
    ('{"pass": 1, "checks": {"star_positions": {"pass": true, "skipped": true}}}', "skipped", True), ('{"pass": 0, "checks": {"star_positions": null}}', "absent", False),
    ('{"pass": "yes", "checks": {"star_positions": {}}}', "fail", True), ('{"pass": "", "checks": {"star_positions": {"skipped": "no catalogue"}}}', "skipped", False),
    ('{"pass": [], "checks": {"star_positions": {"skipped": "", "pass": 1}}}', "pass", False), ('{"checks": "none"}', "absent", False), ("not json", "absent", False),
]
_LIST = lambda i: "[" + ", ".join(str(v[i]) if isinstance(v[i], bool) else f"'{v[i]}'" for v in VERDICTS) + "]"


@query(
    "verdict_state",
    f"SELECT o_orderkey AS k, {_LIST(1)}[o_orderkey % 9 + 1] AS state, {_LIST(2)}[o_orderkey % 9 + 1] AS passes, (CASE WHEN o_custkey % 8 >= 4 THEN 'N' ELSE 'S' END) || (CASE WHEN o_orderkey % 4 >= 2 THEN 'E' ELSE 'W' END) AS quadrant FROM orders",
)
def verdict_state(spark, d):
    k = F.col("o_orderkey")
    json = F.element_at(F.array(*[F.lit(v[0]) for v in VERDICTS]), (k % 9 + 1).cast("int"))
    return table(spark, d, "orders").select(k.alias("k"), S.verdict_state(json).alias("state"), S.verdict_passes(json).alias("passes"), S.quadrant(k % 4 * 2, F.col("o_custkey") % 8, 8).alias("quadrant"))


# Predicates ------------------------------------------------------------------------------------------------


@query("finite_filter", f"{POLL} SELECT k, s_ra, s_dec FROM p WHERE s_ra IS NOT NULL AND NOT isnan(s_ra)")
def finite_filter(spark, d):
    return POLL_1.df(spark, d).where(S.finite(F.col("s_ra"))).select("k", "s_ra", "s_dec")


@query(
    "position_valid",
    f"""{STAR}, s AS (SELECT id, field, detector, CASE WHEN detector = 3 THEN (cust % 100) / 10.0 ELSE (cust % 100) / 1000.0 END AS sep FROM a),
n AS (SELECT *, count(*) FILTER (sep <= 0.05) OVER (PARTITION BY field, detector) AS good FROM s)
SELECT id, CASE WHEN good >= 30 THEN 'position valid' ELSE 'uncut' END AS label FROM n WHERE good < 30 OR sep <= 0.05""",
)
def position_valid(spark, d):
    sep = F.when(F.col("detector") == 3, (F.col("cust") % 100) / 10).otherwise((F.col("cust") % 100) / 1000)
    return P.position_valid(STARS.df(spark, d).withColumn("sep", sep), "sep", ["field", "detector"]).select("id", "label")


@query("sn_cut", f"{STAR} SELECT id FROM a WHERE flux / flux_err > 10")
def sn_cut(spark, d):
    return P.signal_cut(STARS.df(spark, d), [("flux", "flux_err"), ("no_flux", "no_err")]).select("id")


@query(
    "sentinel_filter",
    f"""WITH e AS ({EXPOSURE_SQL}), f AS (SELECT *, count(*) OVER (PARTITION BY exposure) AS c FROM e WHERE flux > 1000 AND n >= 1 AND err < 40 AND qfit < 9.999)
SELECT star, exposure FROM f WHERE c >= 50""",
)
def sentinel_filter(spark, d):
    e = exposures(spark, d).withColumn("m", -F.col("flux") + 1000)
    return P.sentinel_filter(e, {"m": 0.0, "err": 40.0, "qfit": 9.999}, at_least={"n": 1}, least=50, keys=["exposure"]).select("star", "exposure")


@query(
    "event_ready",
    f"{POLL}, x AS (SELECT *, t_obs_release IS NOT NULL AND t_obs_release <= 51000 AS released FROM p) SELECT k, released AND coalesce(calib_level, 0) >= 2 AS ready, released AND coalesce(calib_level, 0) >= 2 AND (k % 3 < 2 OR k % 4 < 2) AS arrival FROM x",
)
def event_ready(spark, d):
    x = POLL_1.df(spark, d).withColumn("released", F.col("t_obs_release").isNotNull() & (F.col("t_obs_release") <= 51000))
    x = x.withColumn("event", F.when(F.col("k") % 3 == 0, "NEW_OBSERVATION").when(F.col("k") % 3 == 1, "NEWLY_RELEASED").otherwise("CALIB_LEVEL_UP")).withColumn("previous_calib_level", (F.col("k") % 4).cast("int"))
    return x.select("k", P.event_ready().alias("ready"), P.event_is_arrival().alias("arrival"))


@query(
    "product_filter",
    f"{INV} SELECT k FROM f WHERE (ends_with(name, '_cal.fits') OR ends_with(name, '_i2d.fits')) AND NOT contains(name, 'destreak') AND NOT contains(name, 'segm') AND NOT contains(name, '_nrcb')",
)
def product_filter(spark, d):
    return P.product_names(INVENTORY.df(spark, d), "name", ["_cal.fits", "_i2d.fits"], ["destreak", "segm", "_nrcb"]).select("k")


@query(
    "obs_scope",
    f"""{INV}, t AS (SELECT k, field, filter, CASE WHEN k % 3 = 0 OR obs = '004' THEN NULL ELSE obs END AS token FROM f), w AS (SELECT *, count(*) FILTER (token = '002') OVER (PARTITION BY field, filter) AS own FROM t WHERE token IS NULL OR token = '002')
SELECT k FROM w WHERE (own > 0 AND token = '002') OR (own = 0 AND token IS NULL)""",
)
def obs_scope(spark, d):
    f = INVENTORY.df(spark, d).withColumn("token", F.when((F.col("k") % 3 == 0) | (F.col("obs") == "004"), None).otherwise(F.col("obs")))
    return P.scope_to_obs(f, "token", F.lit("002"), ["field", "filter"]).select("k")


@query(
    "prefer_undated",
    f"""{INV}, t AS (SELECT *, regexp_extract(name, '_(20\\d{{6}})(?:[_.]|$)', 1) <> '' AS dated FROM f), w AS (SELECT *, bool_or(NOT dated) OVER (PARTITION BY field, filter, obs, folder) AS plain FROM t) SELECT k FROM w WHERE NOT plain OR NOT dated""",
)
def prefer_undated(spark, d):
    return P.prefer_undated(INVENTORY.df(spark, d), "name", ["field", "filter", "obs", "folder"]).select("k")


@query(
    "footprint_crop",
    f"""{STAR}, b AS ({REFERENCE.sql}), box AS (SELECT field, min(ra) AS r0, max(ra) AS r1, min(dec) AS d0, max(dec) AS d1 FROM a WHERE detector = 1 AND ra < 266.41 GROUP BY field),
c AS (SELECT b.id, b.field, count(*) OVER (PARTITION BY field) AS n FROM b JOIN box USING (field) WHERE b.ra BETWEEN r0 - 2.0 / 3600 AND r1 + 2.0 / 3600 AND b.dec BETWEEN d0 - 2.0 / 3600 AND d1 + 2.0 / 3600)
SELECT id, field FROM c WHERE n >= 50""",
)
def footprint_crop(spark, d):
    a = STARS.df(spark, d).where("detector = 1 and ra < 266.41")
    return P.footprint_crop(a, REFERENCE.df(spark, d), ["field"]).select("id", "field")


@query(
    "unmeasurable_reason",
    f"""{STAR}, b AS ({REFERENCE.sql}), f AS (SELECT DISTINCT field FROM a), ca AS (SELECT field, min(ra) AS r0, max(ra) AS r1, min(dec) AS d0, max(dec) AS d1 FROM a WHERE field <> '5-LOW' GROUP BY field),
cb AS (SELECT field, min(ra + CASE WHEN field = '2-HIGH' THEN 10 ELSE 0 END) AS r0, max(ra + CASE WHEN field = '2-HIGH' THEN 10 ELSE 0 END) AS r1, min(dec) AS d0, max(dec) AS d1 FROM b WHERE field <> '1-URGENT' GROUP BY field)
SELECT field, CASE WHEN ca.r0 IS NULL THEN 'no catalogue' WHEN cb.r0 IS NULL THEN 'no reference' WHEN ca.r1 < cb.r0 OR cb.r1 < ca.r0 OR ca.d1 < cb.d0 OR cb.d1 < ca.d0 THEN 'footprints do not overlap'
  WHEN field = '3-MEDIUM' THEN 'no peak (ratio 1.20)' END AS reason FROM f LEFT JOIN ca USING (field) LEFT JOIN cb USING (field)""",
)
def unmeasurable_reason(spark, d):
    a, b = STARS.df(spark, d), REFERENCE.df(spark, d)
    fields = a.select("field").distinct()
    ratio = fields.select("field", F.when(F.col("field") == "3-MEDIUM", 1.2).otherwise(9.0).alias("peak_ratio"), F.lit(4).alias("n_cells"))
    b = b.where("field <> '1-URGENT'").withColumn("ra", F.col("ra") + F.when(F.col("field") == "2-HIGH", 10).otherwise(0))
    return P.unmeasurable_reason(fields, a.where("field <> '5-LOW'"), b, ratio, "field")


@query(
    "range_cuts",
    f"WITH e AS ({EXPOSURE_SQL}), s AS (SELECT star, stddev_pop(qfit) AS rms, count(*) AS nmatch FROM e GROUP BY star) SELECT star, round(rms, 6) AS rms, nmatch FROM s WHERE rms < 500 AND rms > 0.1 AND nmatch >= 3",
)
def range_cuts(spark, d):
    s = exposures(spark, d).groupBy("star").agg(F.stddev_pop("qfit").alias("rms"), F.count(F.lit(1)).alias("nmatch"))
    return P.physical_range(s, "rms", "nmatch").select("star", F.round("rms", 6).alias("rms"), "nmatch")


@query("bright_end", f"{STAR}, p AS (SELECT field, quantile_cont(mag, 0.4) AS p40, quantile_cont(mag, 0.2) AS p20 FROM a GROUP BY field) SELECT id, mag < p20 AS brightest FROM a JOIN p USING (field) WHERE mag <= p40")
def bright_end(spark, d):
    x = P.bright_end(STARS.df(spark, d), "mag", 0.4, ["field"])
    return x.join(P.quantile_of(STARS.df(spark, d), "mag", 0.2, ["field"]), "field").select("id", (F.col("mag") < F.col("q")).alias("brightest"))


@query("exclude_fields", f"{INV} SELECT k, field FROM f WHERE field NOT IN ('w51', 'brick') AND NOT regexp_matches(name, '(?i)SEGM') AND (field = 'sgrb2' OR obs = '002')")
def exclude_fields(spark, d):
    x = INVENTORY.df(spark, d).where(~F.col("field").isin("w51", "brick") & ~F.col("name").rlike("(?i)SEGM"))
    return P.restrict(x, "SGRB2", ["obs", "field"], also=F.col("obs") == "002").select("k", "field")

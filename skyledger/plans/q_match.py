"""Queries on matching and offsets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import match, offset
from .registry import query
from .standins import MODULE_A, MODULE_B, REFERENCE, STARS

SEP = "degrees(2 * asin(sqrt(least(1.0, power(sin(radians(b.dec - a.dec) / 2), 2.0) + cos(radians(a.dec)) * cos(radians(b.dec)) * power(sin(radians(b.ra - a.ra) / 2), 2.0))))) * 3600"


def near(a: str, b: str, r: float, keys: str = "tile", name: str = "pairs", more: str = "") -> str:
    """SQL of a radius join through a declination band join."""
    w = r / 3600 * 1.0001
    return f"""{name} AS (
  SELECT * FROM (
    SELECT {", ".join(f"a.{k} AS a_{k}, b.{k} AS b_{k}" for k in ("id", "ra", "dec"))}, a.{keys} AS {keys}{more}, {SEP} AS sep
    FROM (SELECT *, floor(dec / {w}) AS band, floor(ra / {w * 1.3}) AS strip FROM {a}) a
    JOIN (SELECT *, unnest([floor(dec / {w}) - 1, floor(dec / {w}), floor(dec / {w}) + 1]) AS band FROM (SELECT *, unnest([floor(ra / {w * 1.3}) - 1, floor(ra / {w * 1.3}), floor(ra / {w * 1.3}) + 1]) AS strip FROM {b})) b
      ON a.band = b.band AND a.strip = b.strip AND a.{keys} = b.{keys}
  ) WHERE sep <= {r})"""


def stars(spark, d):
    return STARS.df(spark, d)


def reference(spark, d):
    return REFERENCE.df(spark, d)


A, B = f"a0 AS ({STARS.sql})", f"b0 AS ({REFERENCE.sql})"
AB = f"WITH {A}, {B}"


@query("radius_pairs", f"{AB}, {near('a0', 'b0', 0.3)} SELECT tile, a_id, b_id, round(sep, 6) AS sep FROM pairs")
def radius_pairs(spark, d):
    p = match.radius_join(stars(spark, d), reference(spark, d), 0.3, ["tile"])
    return p.select(F.col("a_tile").alias("tile"), "a_id", "b_id", F.round("sep", 6).alias("sep"))


@query(
    "nearest_match",
    f"{AB}, {near('b0', 'a0', 0.2)} SELECT a_id AS id, b_id AS nearest_id, round(sep, 6) AS sep FROM (SELECT *, row_number() OVER (PARTITION BY tile, a_id ORDER BY sep, b_id) AS r FROM pairs WHERE sep < 0.2) WHERE r = 1",
)
def nearest_match(spark, d):
    p = match.radius_join(reference(spark, d), stars(spark, d), 0.2, ["tile"])
    return match.nearest(p, "a_id", "b_id", 0.2, ["a_tile"]).select(F.col("a_id").alias("id"), F.col("b_id").alias("nearest_id"), F.round("sep", 6).alias("sep"))


MUTUAL = "(SELECT *, row_number() OVER (PARTITION BY tile, a_id ORDER BY sep, b_id) AS r1, row_number() OVER (PARTITION BY tile, b_id ORDER BY sep, a_id) AS r2 FROM pairs)"


@query("mutual_nearest", f"{AB}, {near('a0', 'b0', 0.3)} SELECT a_id, b_id, round(sep, 6) AS sep FROM {MUTUAL} WHERE r1 = 1 AND r2 = 1")
def mutual(spark, d):
    p = match.radius_join(stars(spark, d), reference(spark, d), 0.3, ["tile"])
    return match.mutual_nearest(p, ["a_tile"]).select("a_id", "b_id", F.round("sep", 6).alias("sep"))


@query(
    "one_to_one",
    f"""{AB}, {near('a0', 'b0', 0.3)}, n1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tile, a_id ORDER BY sep, b_id) AS r FROM pairs) WHERE r = 1)
SELECT a_id, b_id, round(sep, 6) AS sep FROM (SELECT *, row_number() OVER (PARTITION BY tile, b_id ORDER BY sep, a_id) AS r2 FROM n1) WHERE r2 = 1""",
)
def one_to_one(spark, d):
    p = match.radius_join(stars(spark, d), reference(spark, d), 0.3, ["tile"])
    return match.one_to_one(p, ["a_tile"]).select("a_id", "b_id", F.round("sep", 6).alias("sep"))


@query("isolated_stars", f"WITH {A}, {near('a0', 'a0', 0.5)} SELECT id, field FROM a0 WHERE NOT EXISTS (SELECT 1 FROM pairs p WHERE p.a_id = a0.id AND p.b_id <> a0.id)")
def isolated_stars(spark, d):
    return match.isolated(stars(spark, d), 0.5, ["tile"]).select("id", "field")


@query("unambiguous_match", f"{AB}, {near('a0', 'b0', 0.4)} SELECT a_id, min(b_id) AS b_id, round(min(sep), 6) AS sep FROM pairs GROUP BY a_id HAVING count(*) = 1 AND min(sep) < 0.15")
def unambiguous(spark, d):
    p = match.radius_join(stars(spark, d), reference(spark, d), 0.4, ["tile"])
    return match.unambiguous(p, 0.15, 0.4).select("a_id", "b_id", F.round("sep", 6).alias("sep"))


def refine(keys: str, maxsep: float, rounds: int = 4, name: str = "") -> str:
    """CTEs of the histogram peak and its refinement rounds over ``off{name}`` (keys, dra, ddec)."""
    last = int(round(2 * maxsep / 0.05)) - 1
    on = keys
    out = f"""hist{name} AS (SELECT {keys}, least(floor((dra + {maxsep}) / 0.05), {last})::INT AS i, least(floor((ddec + {maxsep}) / 0.05), {last})::INT AS j, count(*) AS n
  FROM off{name} WHERE abs(dra) <= {maxsep} AND abs(ddec) <= {maxsep} GROUP BY ALL),
peak{name} AS (SELECT {keys}, first(i ORDER BY n DESC, i, j) AS i, first(j ORDER BY n DESC, i, j) AS j, max(n) AS top, median(n) AS background, sum(n)::BIGINT AS npairs FROM hist{name} GROUP BY {keys}),
c{name}0 AS (SELECT {keys}, npairs, top, background, -{maxsep} + (i + 0.5::DOUBLE) * 0.05::DOUBLE AS cx, -{maxsep} + (j + 0.5::DOUBLE) * 0.05::DOUBLE AS cy, true AS moving FROM peak{name})"""
    for r in range(rounds):
        out += f""",
s{name}{r} AS (SELECT {keys}, count(*) AS n, median(dra) AS mx, median(ddec) AS my FROM off{name} JOIN c{name}{r} USING ({on}) WHERE moving AND abs(dra - cx) < 0.05 AND abs(ddec - cy) < 0.05 GROUP BY {keys}),
c{name}{r + 1} AS (SELECT {keys}, npairs, top, background, CASE WHEN moving AND coalesce(n, 0) >= 5 THEN mx ELSE cx END AS cx, CASE WHEN moving AND coalesce(n, 0) >= 5 THEN my ELSE cy END AS cy,
  moving AND coalesce(n, 0) >= 5 AS moving FROM c{name}{r} LEFT JOIN s{name}{r} USING ({on}))"""
    return out


OFF = "SELECT {keys}, (a_ra - b_ra) * cos(radians(a_dec)) * 3600 AS dra, (a_dec - b_dec) * 3600 AS ddec FROM {pairs}"


def xcorr_columns(keys: str, c: str) -> str:
    return f"SELECT {keys}, round(cx * 1000, 6) AS dra, round(cy * 1000, 6) AS ddec, round(sqrt(cx * cx + cy * cy) * 1000, 6) AS off, npairs, round(top / background, 6) AS peak_ratio FROM {c}"


def xcorr_of(spark, d, key: str):
    p = offset.pair_offsets(match.radius_join(stars(spark, d), reference(spark, d), 2.5, ["tile"]))
    p = p.select(F.col(f"a_{key}").alias(key), "dra", "ddec")
    x = offset.xcorr(p, [key])
    return x.select(key, *[F.round(c, 6).alias(c) for c in ("dra", "ddec", "off")], "npairs", F.round("peak_ratio", 6).alias("peak_ratio"))


@query("xcorr_offset", f"{AB}, {near('a0', 'b0', 2.5)}, off AS ({OFF.format(keys='tile', pairs='pairs')}), {refine('tile', 2.5)} {xcorr_columns('tile', 'c4')}")
def xcorr_offset(spark, d):
    return xcorr_of(spark, d, "tile")


@query(
    "xcorr_by_field",
    f"{AB}, {near('a0', 'b0', 2.5, more=', a.field AS field')}, off AS ({OFF.format(keys='field', pairs='pairs')}), {refine('field', 2.5)} {xcorr_columns('field', 'c4')}",
)
def xcorr_by_field(spark, d):
    return xcorr_of(spark, d, "field")


def stat_sql(source: str, keys: str, least: int, scatter: str) -> str:
    return f"""m AS (SELECT {keys}, count(*) AS n, median(dra) AS mx, median(ddec) AS my FROM {source} GROUP BY {keys}),
dev AS (SELECT {keys}, median(abs(dra - mx)) * {offset.MAD} AS sx, median(abs(ddec - my)) * {offset.MAD} AS sy FROM {source} JOIN m USING ({keys}) GROUP BY {keys})
SELECT {keys}, n, CASE WHEN n >= {least} THEN round(mx, 6) END AS dra, CASE WHEN n >= {least} THEN round(my, 6) END AS ddec, CASE WHEN n >= {least} THEN round(sqrt(mx * mx + my * my), 6) END AS off,
  CASE WHEN n >= {least} THEN round({scatter}, 6) END AS scatter FROM m JOIN dev USING ({keys})"""


def rounded(df, *keys):
    return df.select(*keys, "n", *[F.round(c, 6).alias(c) for c in ("dra", "ddec", "off", "scatter")])


@query(
    "same_star_offset",
    f"{AB}, {near('a0', 'b0', 0.3, more=', a.field AS field')}, o AS (SELECT field, (a_ra - b_ra) * cos(radians(a_dec)) * 3600000 AS dra, (a_dec - b_dec) * 3600000 AS ddec FROM {MUTUAL} WHERE r1 = 1 AND r2 = 1), {stat_sql('o', 'field', 30, 'sqrt(sx * sx + sy * sy)')}",
)
def same_star(spark, d):
    p = match.mutual_nearest(match.radius_join(stars(spark, d), reference(spark, d), 0.3, ["tile"]), ["a_tile"])
    return rounded(offset.same_star_offset(offset.pair_offsets(p).withColumnRenamed("a_field", "field"), ["field"]), "field")


ISOLATED = f"""{near('a0', 'a0', 0.5, name='selfpairs')}, lone AS (SELECT * FROM a0 WHERE NOT EXISTS (SELECT 1 FROM selfpairs p WHERE p.a_id = a0.id AND p.b_id <> a0.id)),
{near('lone', 'b0', 0.4)}, clean AS (SELECT tile, min(a_ra) AS a_ra, min(a_dec) AS a_dec, min(b_ra) AS b_ra, min(b_dec) AS b_dec FROM pairs GROUP BY tile, a_id HAVING count(*) = 1 AND min(sep) < 0.15),
m AS (SELECT tile, count(*) AS n_clean, median(a_ra - b_ra) * cos(radians(median(a_dec))) * 3600000 AS x, median(a_dec - b_dec) * 3600000 AS y FROM clean GROUP BY tile),
n AS (SELECT tile, count(*) AS n_stars FROM a0 GROUP BY tile), r AS (SELECT tile, count(*) AS n_reference FROM b0 GROUP BY tile), l AS (SELECT tile, count(*) AS n_isolated FROM lone GROUP BY tile),
j AS (SELECT tile, n_stars, coalesce(n_reference, 0) AS n_reference, coalesce(n_isolated, 0) AS n_isolated, coalesce(n_clean, 0) AS n_clean, x, y FROM n LEFT JOIN r USING (tile) LEFT JOIN l USING (tile) LEFT JOIN m USING (tile)),
k AS (SELECT *, CASE WHEN n_stars < 100 OR n_reference < 50 THEN 'too few sources' WHEN n_isolated < 20 THEN 'too few isolated' WHEN n_clean < 15 THEN 'too few clean matches' END AS reason FROM j)"""


@query(
    "isolated_bulk",
    f"""{AB}, {ISOLATED}
SELECT tile, n_stars, n_reference, n_isolated, n_clean, CASE WHEN reason IS NULL THEN round(x, 6) END AS dra, CASE WHEN reason IS NULL THEN round(y, 6) END AS ddec, CASE WHEN reason IS NULL THEN round(sqrt(x * x + y * y), 6) END AS off, reason FROM k""",
)
def isolated_bulk(spark, d):
    x = offset.isolated_bulk(stars(spark, d), reference(spark, d), ["tile"])
    return x.select("tile", "n_stars", "n_reference", "n_isolated", "n_clean", *[F.round(c, 6).alias(c) for c in ("dra", "ddec", "off")], "reason")


MODULES = f"WITH m_a AS ({MODULE_A.sql}), m_b AS ({MODULE_B.sql})"


@query(
    "module_offset",
    f"{MODULES}, {near('m_a', 'm_b', 0.1, more=', a.field AS field')}, o AS (SELECT field, (a_ra - b_ra) * cos(radians(a_dec)) * 3600000 AS dra, (a_dec - b_dec) * 3600000 AS ddec FROM pairs WHERE TRUE), {stat_sql('o', 'field', 8, 'sy')}",
)
def module_offset(spark, d):
    a, b = MODULE_A.df(spark, d), MODULE_B.df(spark, d)
    p = match.radius_join(a, b, 0.1, ["tile"])
    x = offset.pair_offsets(p).select(F.col("a_field").alias("field"), (F.col("dra") * 1000).alias("dra"), (F.col("ddec") * 1000).alias("ddec"))
    s = offset.mad_std(x, ["field"], "dra", "ddec").join(x.groupBy("field").agg(F.count(F.lit(1)).alias("n")), "field")
    ok = F.col("n") >= 8
    return s.select(
        "field", "n", F.when(ok, F.round("dra_med", 6)).alias("dra"), F.when(ok, F.round("ddec_med", 6)).alias("ddec"), F.when(ok, F.round(F.hypot("dra_med", "ddec_med"), 6)).alias("off"), F.when(ok, F.round("ddec_mad", 6)).alias("scatter")
    )


BULK = f"{MODULES}, {near('m_a', 'm_b', 1.5, name='wide')}, off AS ({OFF.format(keys='tile', pairs='wide')}), {refine('tile', 1.5)}, moved AS (SELECT a.* EXCLUDE (ra, dec), ra - cx / 3600 / cos(radians(dec)) AS ra, dec - cy / 3600 AS dec, cx, cy FROM m_a a JOIN c4 USING (tile) WHERE npairs >= 30)"


@query(
    "module_overlap",
    f"""{BULK}, {near('moved', 'm_b', 0.08)}, n1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tile, a_id ORDER BY sep, b_id) AS r FROM pairs) WHERE r = 1),
n2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tile, b_id ORDER BY sep, a_id) AS r2 FROM n1) WHERE r2 = 1),
o AS (SELECT tile, (a_ra - b_ra) * cos(radians(a_dec)) * 3600000 AS dra, (a_dec - b_dec) * 3600000 AS ddec FROM n2), {stat_sql('o', 'tile', 20, 'sqrt(sx * sx + sy * sy)')}""",
)
def module_overlap(spark, d):
    p = offset.overlap_residuals(MODULE_A.df(spark, d), MODULE_B.df(spark, d), ["tile"])
    x = p.select(F.col("a_tile").alias("tile"), F.col("rdra").alias("dra"), F.col("rddec").alias("ddec"))
    s = offset.mad_std(x, ["tile"], "dra", "ddec").join(x.groupBy("tile").agg(F.count(F.lit(1)).alias("n")), "tile")
    ok = F.col("n") >= 20
    return s.select(
        "tile", "n", F.when(ok, F.round("dra_med", 6)).alias("dra"), F.when(ok, F.round("ddec_med", 6)).alias("ddec"), F.when(ok, F.round(F.hypot("dra_med", "ddec_med"), 6)).alias("off"),
        F.when(ok, F.round(F.hypot("dra_mad", "ddec_mad"), 6)).alias("scatter"),
    )


@query(
    "offset_cloud",
    f"""{BULK}, {near('moved', 'm_b', 0.1, more=', a.cx AS cx, a.cy AS cy')}
SELECT tile, count(*) AS n, CASE WHEN count(*) >= 20 THEN round(median((a_ra - b_ra) * cos(radians(a_dec)) * 3600000 + cx * 1000), 5) END AS dra, CASE WHEN count(*) >= 20 THEN round(median((a_dec - b_dec) * 3600000 + cy * 1000), 5) END AS ddec FROM pairs GROUP BY tile""",
)
def offset_cloud(spark, d):
    x = offset.offset_cloud(MODULE_A.df(spark, d), MODULE_B.df(spark, d), ["tile"])
    return x.select("tile", "n", F.round("dra", 5).alias("dra"), F.round("ddec", 5).alias("ddec"))


@query(
    "two_band_colours",
    f"""{MODULES}, {near('m_a', 'm_b', 0.05, keys='field', more=', a.mag AS a_mag, b.mag AS b_mag')}
SELECT a_id, b_id, round(CASE WHEN count(*) OVER (PARTITION BY field) >= 100 AND field NOT IN ('5-LOW', '2-HIGH') THEN a_mag - b_mag END, 6) AS colour, CASE WHEN count(*) OVER (PARTITION BY field) < 100 THEN 'too few matches' WHEN field IN ('5-LOW', '2-HIGH') THEN 'magnitude systems differ' END AS reason
FROM (SELECT *, row_number() OVER (PARTITION BY field, a_id ORDER BY sep, b_id) AS r1, row_number() OVER (PARTITION BY field, b_id ORDER BY sep, a_id) AS r2 FROM pairs WHERE sep < 0.05) WHERE r1 = 1 AND r2 = 1""",
)
def two_band_colours(spark, d):
    a = MODULE_A.df(spark, d).withColumn("system", F.lit("Vega"))
    b = MODULE_B.df(spark, d).withColumn("system", F.when(F.col("field") == "5-LOW", "AB").when(F.col("field") != "2-HIGH", "Vega"))
    return match.two_band_colours(a, b, keys=["field"]).select("a_id", "b_id", F.round("colour", 6).alias("colour"), "reason")

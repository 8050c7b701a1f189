"""Queries on file inventories and gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import gates as G
from ..operators import inventory as I
from .registry import query, table
from ..operators import pixels, select
from .standins import EXPOSURE_SQL, INVENTORY, STARS, exposures

INV = f"WITH f AS ({INVENTORY.sql})"
TIER = "CASE WHEN contains(name, 'm8_dedup') THEN 8 WHEN regexp_extract(name, '_m([1-8])(?:_|\\.|$)', 1) <> '' THEN regexp_extract(name, '_m([1-8])(?:_|\\.|$)', 1)::INT ELSE 0 END"


def inv(spark, d):
    return INVENTORY.df(spark, d)


def first(order: str, by: str, source: str = "f") -> str:
    return f"(SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY {order}) AS r FROM {source})"


@query("best_catalogue", f"{INV} SELECT field, filter, obs, name FROM {first(f'{TIER} DESC, mtime DESC, name', 'field, filter, obs')} WHERE r = 1")
def best_catalogue(spark, d):
    return I.best_catalogue(inv(spark, d), ["field", "filter", "obs"]).select("field", "filter", "obs", "name")


@query(
    "round_robin_cap",
    f"{INV}, a AS (SELECT *, regexp_extract(name, '(nrc[ab]\\d)', 1) AS det FROM f), b AS (SELECT *, row_number() OVER (PARTITION BY field, det ORDER BY name) AS n FROM a) SELECT k FROM (SELECT *, row_number() OVER (PARTITION BY field ORDER BY n, det) AS r FROM b) WHERE r <= 64",
)
def round_robin_cap(spark, d):
    x = inv(spark, d).withColumn("det", F.regexp_extract("name", r"(nrc[ab]\d)", 1))
    return I.round_robin(x, "det", "name", 64, ["field"]).select("k")


@query(
    "stage_staleness",
    f"{INV}, s AS (SELECT field, obs, k % 7 AS stage, max(mtime) AS newest FROM f GROUP BY ALL) SELECT field, obs, stage, coalesce(newest < max(newest) OVER (PARTITION BY field, obs ORDER BY stage ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 1, false) AS stale FROM s",
)
def stage_staleness(spark, d):
    s = inv(spark, d).groupBy("field", "obs", (F.col("k") % 7).alias("stage")).agg(F.max("mtime").alias("newest"))
    return I.stage_staleness(s, ["field", "obs"], "stage", "newest").select("field", "obs", "stage", "stale")


@query("source_fallback", f"{INV}, c AS (SELECT *, count(*) OVER (PARTITION BY field, obs, filter, mtime % 40) AS n, mtime % 40 AS rank FROM f), g AS (SELECT *, min(rank) OVER (PARTITION BY field, obs, filter) AS best FROM c WHERE n >= 5) SELECT k, rank FROM g WHERE rank = best")
def source_fallback(spark, d):
    return I.first_passing(inv(spark, d).withColumn("rank", F.col("mtime") % 40), ["field", "obs", "filter"], "rank", 5).select("k", "rank")


RANKED = [("F212N", 0), ("F182M", 1), ("F187N", 2), ("F405N", 0), ("F444W", 1), ("F770W", 2)]


@query(
    "preferred_filter",
    f"""{INV}, r(filter, rank) AS (VALUES {', '.join(f"('{a}', {b})" for a, b in RANKED)}), a AS (SELECT field, obs, filter, bool_or(k % 97 = 0) AS image FROM f GROUP BY ALL)
SELECT field, obs, CASE WHEN substr(filter, 2, 3)::INT <= 212 THEN 'SW' ELSE 'LW' END AS channel, first(filter ORDER BY image DESC, rank) AS filter FROM a JOIN r USING (filter) GROUP BY ALL""",
)
def preferred_filter(spark, d):
    a = inv(spark, d).groupBy("field", "obs", "filter").agg(F.bool_or(F.col("k") % 97 == 0).alias("image"))
    return I.preferred_band(a, spark.createDataFrame(RANKED, "filter string, rank int"), ["field", "obs"], "image")


W = "substr({}, 2, 3)::INT"


@query("nearest_band", f"{INV}, b AS (SELECT DISTINCT field, filter FROM f) SELECT a.field, a.filter, first(b.filter ORDER BY abs({W.format('a.filter')} - {W.format('b.filter')}), b.filter) AS partner FROM b a JOIN b ON a.field = b.field AND a.filter <> b.filter GROUP BY ALL")
def nearest_band(spark, d):
    return I.nearest_band(inv(spark, d), ["field"])


@query("reference_by_obs", f"{INV} SELECT field, filter, max(name) AS name FROM f WHERE obs = '002' GROUP BY ALL")
def reference_by_obs(spark, d):
    from ..operators.select import scope_to_obs

    x = scope_to_obs(inv(spark, d), "obs", F.lit("002"), ["field", "filter"])
    return x.groupBy("field", "filter").agg(F.max("name").alias("name"))


@query(
    "pattern_priority",
    f"{INV}, p AS (SELECT *, CASE WHEN regexp_matches(name, '_m8_dedup.*ecsv$') THEN 0 WHEN regexp_matches(name, 'ecsv$') THEN 1 WHEN regexp_matches(name, '_cal.fits$') THEN 2 END AS pattern FROM f) SELECT field, filter, obs, name, pattern FROM {first('pattern, name', 'field, filter, obs', '(SELECT * FROM p WHERE pattern IS NOT NULL)')} WHERE r = 1",
)
def pattern_priority(spark, d):
    x = I.by_pattern(inv(spark, d), ["_m8_dedup.*ecsv$", "ecsv$", "_cal.fits$"], ["field", "filter", "obs"])
    return x.select("field", "filter", "obs", "name", "pattern")


@query("field_vote", f"{INV}, n AS (SELECT obs, field, count(DISTINCT name) AS n FROM f GROUP BY ALL) SELECT obs, first(field ORDER BY n DESC, field) AS field, max(n) AS n, count(*) > 1 AS contested FROM n GROUP BY obs")
def field_vote(spark, d):
    return I.field_vote(inv(spark, d), "obs", "field", "name")


@query("detector_inventory", f"{INV}, g AS (SELECT *, CASE WHEN k % 50 = 0 THEN 'logs' ELSE filter END AS fd FROM f) SELECT field, fd, CASE WHEN fd <> 'logs' THEN string_agg(DISTINCT regexp_extract(name, '(nrc[ab](?:\\d|long))', 1), ',' ORDER BY regexp_extract(name, '(nrc[ab](?:\\d|long))', 1)) END AS detectors FROM g GROUP BY field, fd")
def detector_inventory(spark, d):
    x = inv(spark, d).withColumn("fd", F.when(F.col("k") % 50 == 0, "logs").otherwise(F.col("filter")))
    return I.detector_lists(x, ["field"], "fd", "name").select("field", "fd", F.array_join("detectors", ",").alias("detectors"))


@query(
    "layout_choice",
    f"""{INV}, g AS (SELECT *, regexp_extract(name, '(nrc[ab]\\d)', 1) AS det, 'n' || mtime % 50 AS base FROM f), o AS (SELECT field, det, base, bool_or(folder = 'pipeline') AS a, bool_or(folder = 'flat') AS b, max(mtime) FILTER (folder = 'pipeline') AS ta, max(mtime) FILTER (folder = 'flat') AS tb FROM g GROUP BY ALL),
x AS (SELECT field, det, count(*) FILTER (a) AS na, count(*) FILTER (b) AS nb, count(*) FILTER (a AND b) AS common, count(*) AS total, max(ta) AS ta, max(tb) AS tb FROM o GROUP BY ALL)
SELECT field, det, CASE WHEN na > nb OR (na = nb AND coalesce(ta >= tb, ta IS NOT NULL)) THEN 'pipeline' ELSE 'flat' END AS layout, na, nb, total, na > 0 AND nb > 0 AND common = 0 AS split FROM x""",
)
def layout_choice(spark, d):
    x = inv(spark, d).withColumns({"det": F.regexp_extract("name", r"(nrc[ab]\d)", 1), "base": F.concat(F.lit("n"), (F.col("mtime") % 50).cast("string"))})
    return I.layout_choice(x, ["field", "det"], "folder", "base", "mtime")


@query("discover_obs", f"{INV} SELECT obs, min(field) AS field, string_agg(DISTINCT filter, ',' ORDER BY filter) AS filters FROM f GROUP BY obs")
def discover_obs(spark, d):
    return I.discover(inv(spark, d).drop("obs"), "name").select("obs", "field", F.array_join("filters", ",").alias("filters"))


@query("shared_folder", f"{INV} SELECT folder, count(DISTINCT substr(name, 1, 7)) AS programs, NULL::VARCHAR AS note FROM f GROUP BY folder")
def shared_folder(spark, d):
    return I.shared_folder(inv(spark, d), "folder", "name")


@query("missing_bands", f"{INV}, n AS (SELECT DISTINCT field, obs, filter FROM f), a AS (SELECT DISTINCT field, obs, filter FROM f WHERE mtime % 100 = 7) SELECT * FROM n EXCEPT SELECT * FROM a")
def missing_bands(spark, d):
    return I.missing_bands(inv(spark, d).select("field", "obs", "filter").distinct(), inv(spark, d).where("mtime % 100 = 7"), ["field", "obs"])


@query("two_modules", f"{INV}, m AS (SELECT field, filter, mtime % 400 AS day, k, upper(regexp_extract(name, 'nrc([ab])', 1)) AS module FROM f) SELECT field, filter, day, bool_or(k % 61 = 0) OR count(DISTINCT module) = 2 AS both FROM m GROUP BY ALL")
def two_modules(spark, d):
    x = inv(spark, d).withColumns({"day": F.col("mtime") % 400, "module": S.name_tokens(F.col("name"))["module"]})
    return I.two_modules(x, ["field", "filter", "day"], "module", F.col("k") % 61 == 0)


@query("bands_with_product", f"{INV} SELECT DISTINCT field, filter, obs, mtime FROM f WHERE EXISTS (SELECT 1 FROM f g WHERE g.field = f.field AND g.filter = f.filter AND g.obs = f.obs AND g.mtime = f.mtime AND g.name LIKE '%i2d.fits')")
def bands_with_product(spark, d):
    keys = ["field", "filter", "obs", "mtime"]
    return I.with_product(inv(spark, d).select(*keys).distinct(), inv(spark, d).where("endswith(name, 'i2d.fits')"), keys)


@query("newest_version", f"{INV} SELECT field, filter, first(name ORDER BY mtime DESC, name DESC) AS name, max(mtime) AS mtime FROM f GROUP BY ALL")
def newest_version(spark, d):
    return I.newest(inv(spark, d), ["field", "filter"], "name", "mtime")


@query("exclude_flagged", "SELECT l_orderkey AS k, l_linenumber AS n, count(*) AS c FROM lineitem WHERE NOT (l_orderkey % 10 = 3 AND l_linenumber = 2) GROUP BY ALL")
def exclude_flagged(spark, d):
    x = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), F.concat(F.lit("jw_"), (F.col("l_orderkey") % 10).cast("string"), F.lit("_"), F.col("l_linenumber").cast("string")).alias("name"))
    return I.without_flagged(x, spark.createDataFrame([("vgroup3_exp2",)], "token string"), "name").groupBy("k", "n").agg(F.count(F.lit(1)).alias("c"))


@query(
    "frame_of_catalogue",
    f"""{INV}, n AS (SELECT k, 'x' || mtime || regexp_extract(name, '_[a-z0-9]+[.][a-z]+$') AS name, CASE WHEN k % 2 = 0 THEN 'pipeline' ELSE 'flat' END AS folder FROM f), c AS (SELECT k, replace(name, '_cat.ecsv', '_cal.fits') AS frame FROM n WHERE name LIKE '%cat.ecsv'),
r AS (SELECT name AS frame, CASE WHEN bool_or(folder = 'pipeline') THEN 'pipeline' ELSE 'flat' END AS frame_folder FROM n GROUP BY 1) SELECT k, frame, frame_folder FROM c LEFT JOIN r USING (frame)""",
)
def frame_of_catalogue(spark, d):
    name = F.concat(F.lit("x"), F.col("mtime").cast("string"), F.regexp_extract("name", "_[a-z0-9]+[.][a-z]+$", 0))
    r = inv(spark, d).select("k", name.alias("name"), F.when(F.col("k") % 2 == 0, "pipeline").otherwise("flat").alias("folder"))
    c = r.where("endswith(name, 'cat.ecsv')").select("k", "name")
    return I.frame_of_catalogue(c, r).select("k", "frame", "frame_folder")


@query("canonical_title", "SELECT o_custkey::VARCHAR AS title, first(CASE o_orderstatus WHEN 'O' THEN 'open' ELSE 'closed' END ORDER BY o_orderstatus <> 'O', o_orderkey) AS state, first(o_orderkey ORDER BY o_orderstatus <> 'O', o_orderkey) AS number FROM orders GROUP BY o_custkey")
def canonical_title(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("title"), F.when(F.col("o_orderstatus") == "O", "open").otherwise("closed").alias("state"), F.col("o_orderkey").alias("number"))
    return I.canonical_name(o, "title", "state", "number")


@query(
    "brightest_cap",
    f"WITH e AS ({EXPOSURE_SQL}), d AS (SELECT star, exposure, -2.5 * log10(flux) AS m, dense_rank() OVER (ORDER BY exposure) AS f FROM e) SELECT star, exposure FROM (SELECT *, row_number() OVER (PARTITION BY exposure ORDER BY m, star) AS r FROM d WHERE f <= 5) WHERE r <= 2000",
)
def brightest_cap(spark, d):
    e = exposures(spark, d).withColumns({"m": -2.5 * F.log10("flux"), "g": F.lit(0)})
    return I.brightest(e, ["g", "exposure"], "m", "star", 2000, "exposure", 5).select("star", "exposure")


@query("program_fields", f"{INV} SELECT DISTINCT field FROM f WHERE k % 40 IN (3, 11) UNION SELECT 'treasury'")
def program_fields(spark, d):
    m = inv(spark, d).select((F.col("k") % 40).alias("program"), "field")
    programs = m.where("program in (3, 7, 11)").select("program").distinct()
    return I.fields_of(m.where("program <> 7"), programs, programs.where("program = 7").withColumn("field", F.lit("treasury")))


@query("first_column", "SELECT 'o_totalprice' AS name, sum(o_totalprice) > 0 AS positive FROM orders")
def first_column(spark, d):
    o = table(spark, d, "orders")
    c = select.first_existing(o, ["flux_ab", "O_TotalPrice", "o_custkey"])
    return o.agg(F.lit(c).alias("name"), (F.sum(c) > 0).alias("positive"))


@query("window_crop", f"WITH a AS ({STARS.sql}) SELECT field, greatest(0, least(floor(median(cust) - 300), 899))::BIGINT AS low, least(greatest(0, least(floor(median(cust) - 300), 899)) + 600, 1499)::BIGINT AS high FROM a GROUP BY field")
def window_crop(spark, d):
    m = STARS.df(spark, d).groupBy("field").agg(F.percentile("cust", 0.5).alias("c"))
    low, high = pixels.clipped_window(F.col("c"), 300, 1500)
    return m.select("field", low.cast("long").alias("low"), high.cast("long").alias("high"))


# Gates -----------------------------------------------------------------------------------------------------

IMAGES = f"{INV}, im AS (SELECT field, k, field || '/' || obs || '/t' || k % 7 || '/' || k || CASE WHEN k % 2 = 0 THEN '.png' ELSE '.jpg' END AS path, md5(k::VARCHAR) AS sha FROM f)"
#: Tile trees: root, pass, state of the star check, hash that the verdict is bound to, hash of the source image now.
TREES = [("brick", True, "pass", "t", "t"), ("brick/002", False, "pass", "t", "t"), ("cloudc", True, "pass", "t", None), ("sgrb2", True, "skipped", "t", "t"), ("sickle/001", True, "pass", "t", "u"), ("w51/003", None, "pass", "t", "t")]


def images(spark, d):
    path = F.concat_ws("/", "field", "obs", F.concat(F.lit("t"), (F.col("k") % 7).cast("string")), F.concat(F.col("k").cast("string"), F.when(F.col("k") % 2 == 0, ".png").otherwise(".jpg")))
    return inv(spark, d).select("field", "k", path.alias("path"), F.md5(F.col("k").cast("string")).alias("sha"))


def verdicts(spark, d):
    k = F.col("k")
    own = images(spark, d).where("k % 3 <> 0").select(
        F.concat(G.stem(F.col("path")), F.lit(".validation.json")).alias("path"),
        F.lit(False).alias("tree"),
        F.when(k % 13 != 0, k % 4 != 2).alias("pass"),
        F.when(k % 5 == 0, "fail").when(k % 5 == 1, "skipped").when(k % 5 == 2, "absent").otherwise("pass").alias("state"),
        F.when(k % 11 == 0, "other").when(k % 17 == 0, None).otherwise(F.col("sha")).alias("_h"),
    )
    png = F.col("path").isNotNull() & (k % 2 == 0)
    own = own.join(images(spark, d).select(F.concat(G.stem(F.col("path")), F.lit(".validation.json")).alias("path"), "k"), "path")
    own = own.select("path", "tree", "pass", "state", F.when(png, F.col("_h")).otherwise("x").alias("png_sha"), F.when(png, "x").otherwise(F.col("_h")).alias("jpg_sha"), F.lit(None).cast("string").alias("source_sha"))
    trees = spark.createDataFrame([(root, True, ok, state, bound, None, source) for root, ok, state, bound, source in TREES], own.schema)
    return own.unionByName(trees)


_ROWS = ", ".join(f"('{r}', {'NULL' if p is None else p}, '{s}', '{b}', {'NULL' if h is None else repr(h)})" for r, p, s, b, h in TREES)
COVERED = f"""{IMAGES}, tr(root, pass, state, bound, source) AS (VALUES {_ROWS}), own AS (SELECT path, CASE WHEN k % 13 <> 0 THEN k % 4 <> 2 END AS pass, ['fail', 'skipped', 'absent', 'pass', 'pass'][k % 5 + 1] AS state, CASE WHEN k % 11 = 0 THEN 'other' WHEN k % 17 = 0 THEN NULL ELSE sha END AS bound FROM im WHERE k % 3 <> 0),
v AS (SELECT path, false AS tree, pass, state, bound, NULL AS source FROM own UNION ALL SELECT path, true, pass, state, bound, source FROM im JOIN tr ON starts_with(path, root || '/')),
c AS (SELECT im.*, v.tree, v.pass, v.state, CASE WHEN tree IS NULL THEN 'no verdict' WHEN pass IS NOT TRUE THEN 'validation failed' WHEN state = 'fail' THEN 'star check failed' WHEN state <> 'pass' AND k % 7 >= 3 THEN 'star check ' || state
  WHEN NOT tree AND bound IS NULL THEN 'verdict without hash' WHEN NOT tree AND bound <> sha THEN 'verdict of other bytes' WHEN tree AND bound <> source THEN 'tree verdict of other bytes' WHEN tree AND source IS NULL AND k % 2 = 1 THEN 'tree verdict unbound' END AS problem FROM im LEFT JOIN v USING (path))"""


def covered(spark, d):
    return G.covering_verdicts(images(spark, d), verdicts(spark, d))


def acknowledged():
    return F.expr("k % 7 < 3"), F.expr("k % 2 = 0")


@query("covering_verdict", f"{COVERED} SELECT path, tree, pass, state, problem FROM c")
def covering_verdict(spark, d):
    return covered(spark, d).select("path", "v.tree", "v.pass", "v.state", G.verdict_problem(*acknowledged()).alias("problem"))


@query(
    "release_gate",
    f"""{COVERED}, i AS (SELECT field, k % 40 AS page, path, bool_or(problem IS NULL) AS ok FROM c GROUP BY ALL), g AS (SELECT field, page, bool_and(ok) AS ok, count(*) AS n FROM i GROUP BY ALL),
w AS (SELECT c.field, k % 40 AS page, string_agg(DISTINCT problem, '; ' ORDER BY problem) AS reasons FROM c JOIN i USING (path) WHERE NOT i.ok GROUP BY ALL)
SELECT field, page, ok, coalesce(reasons, '') AS reasons, n FROM g LEFT JOIN w USING (field, page) UNION ALL SELECT DISTINCT field, 99, false, 'no images', 0 FROM f""",
)
def release_gate(spark, d):
    c = covered(spark, d).withColumn("page", F.col("k") % 40)
    pages = c.select("field", "page").unionByName(c.select("field", F.lit(99).cast("long").alias("page")))
    return G.release_gate(c, ["field", "page"], *acknowledged(), expected=pages)


@query("extra_files", f"{INV}, p AS (SELECT field || '/' || obs || '/' || name AS path FROM f) SELECT path FROM p WHERE NOT (ends_with(path, '_i2d.fits') OR ends_with(path, '.ecsv')) AND NOT starts_with(path, 'brick/002/')")
def extra_files(spark, d):
    p = inv(spark, d).select(F.concat_ws("/", "field", "obs", "name").alias("path"))
    return G.uncovered(p, spark.createDataFrame([("brick/002",)], "path string"), ["_i2d.fits"], [".ecsv"])


@query(
    "tile_plan",
    f"{INV}, s AS (SELECT DISTINCT field, filter FROM f), r AS (SELECT DISTINCT field, filter FROM f WHERE mtime % 331 = 5), p AS (SELECT DISTINCT field, filter FROM f WHERE mtime % 331 < 2) SELECT field, filter, CASE WHEN (field, filter) IN (SELECT (field, filter) FROM r) THEN 'present' WHEN (field, filter) IN (SELECT (field, filter) FROM p) THEN 'new' ELSE 'missing' END AS plan FROM s",
)
def tile_plan(spark, d):
    f = inv(spark, d)
    return G.tile_plan(f.select("field", "filter").distinct(), f.where("mtime % 331 = 5"), f.where("mtime % 331 < 2"), ["field", "filter"])


@query(
    "sticky_checklist",
    "WITH o AS (SELECT o_custkey AS issue, CASE o_orderkey % 6 WHEN 5 THEN 'item1' ELSE 'item' || o_orderkey % 6 END AS item, bool_or(o_orderstatus = 'F') AS checked FROM orders WHERE o_orderkey % 3 < 2 GROUP BY ALL), n AS (SELECT o_custkey AS issue, CASE o_orderkey % 6 WHEN 5 THEN 'item1' ELSE 'item' || o_orderkey % 6 END AS item, bool_or(o_orderstatus = 'O') AS checked FROM orders WHERE o_orderkey % 3 > 0 GROUP BY ALL) SELECT issue, item, coalesce(o.checked, false) OR coalesce(n.checked, false) AS checked FROM o FULL JOIN n USING (issue, item)",
)
def sticky_checklist(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("issue"), F.concat(F.lit("item"), (F.col("o_orderkey") % 6).cast("string")).alias("item"), "o_orderstatus", (F.col("o_orderkey") % 3).alias("r"))
    old = o.where("r < 2").withColumn("checked", F.col("o_orderstatus") == "F")
    new = o.where("r > 0").withColumn("checked", F.col("o_orderstatus") == "O")
    return G.sticky_union(old, new, spark.createDataFrame([("item5", "item1")], "old string, new string"), ["issue"])


@query("checklist", "SELECT o_custkey::VARCHAR AS obsid, coalesce(max(CASE WHEN o_orderkey % 3 = 1 THEN o_totalprice END) < 400000, false) AS frame_ok, count(*) FILTER (o_orderkey % 3 = 0) > 0 AS image_ok FROM orders GROUP BY o_custkey")
def checklist(spark, d):
    o = table(spark, d, "orders").groupBy(F.col("o_custkey").cast("string").alias("obsid"), F.when(F.col("o_orderkey") % 3 == 0, "stage1").when(F.col("o_orderkey") % 3 == 1, "stage4").otherwise("stage2").alias("stage"))
    m = o.agg(F.max("o_totalprice").cast("string").alias("value")).withColumn("metric", F.lit("off"))
    return G.checklist(m, {"frame_ok": "cast(stage4_off as double) < 400000", "image_ok": "stage1_off is not null"}, ["stage1_off", "stage4_off"])


@query("staged_release", f"{INV}, v AS (SELECT field, filter, mtime AS version, max(k % 2) = 1 AS marker FROM f GROUP BY ALL) SELECT field, filter, max(version) AS version, first(marker ORDER BY version DESC) OR (max(version) % 5 = 0) AS ok FROM v GROUP BY ALL")
def staged_release(spark, d):
    v = inv(spark, d).groupBy(F.concat_ws("|", "field", "filter").alias("key"), F.col("mtime").alias("version")).agg((F.max(F.col("k") % 2) == 1).alias("marker"))
    x = G.staged_release(v, v.where("version % 5 = 0"), "key")
    return x.select(F.split_part("key", F.lit("|"), F.lit(1)).alias("field"), F.split_part("key", F.lit("|"), F.lit(2)).alias("filter"), "version", "ok")


@query(
    "staleness",
    f"""{INV}, c AS (SELECT field, filter, max(mtime) AS catalogue FROM f WHERE k % 3 = 2 GROUP BY ALL), t AS (SELECT field, filter, CASE WHEN bool_or(k % 401 = 1) THEN 'locked' ELSE 'consensus' END AS kind, coalesce(max(mtime) FILTER (k % 401 = 1), max(mtime) FILTER (k % 401 <> 1)) AS table_time FROM f WHERE k % 3 <> 2 GROUP BY ALL)
SELECT field, filter, catalogue, kind, table_time, coalesce(catalogue < table_time - 1, false) AS stale FROM c LEFT JOIN t USING (field, filter)""",
)
def staleness(spark, d):
    f = inv(spark, d)
    t = f.where("k % 3 <> 2").withColumn("kind", F.when(F.col("k") % 401 == 1, "locked").otherwise("consensus"))
    return G.catalogue_staleness(f.where("k % 3 = 2"), t, ["field", "filter"])


@query(
    "progress",
    f"""{INV}, t AS (SELECT field, obs, min(mtime) + 600 AS tt FROM f GROUP BY ALL), s AS (SELECT field, obs, CASE k % 3 WHEN 0 THEN 'calibrated' WHEN 1 THEN 'image' ELSE 'catalogue' END AS stage, count(*) AS n, max(mtime) AS newest, count(*) FILTER (mtime >= tt) AS n_realigned FROM f JOIN t USING (field, obs) WHERE NOT (field = 'w51' AND k % 3 = 1) GROUP BY ALL),
p(position, stage) AS (VALUES (0, 'calibrated'), (1, 'image'), (2, 'catalogue')), r AS (SELECT DISTINCT field, obs, position, p.stage FROM f, p),
x AS (SELECT r.*, coalesce(n, 0) AS n, newest, coalesce(n_realigned, 0) AS n_realigned, max(newest) OVER (PARTITION BY field, obs ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier FROM r LEFT JOIN s USING (field, obs, stage))
SELECT field, obs, position, stage, n, newest, n_realigned, CASE WHEN n = 0 THEN 'none' WHEN newest < earlier - 1 THEN 'stale' ELSE 'done' END AS status FROM x""",
)
def progress(spark, d):
    kind = F.when(F.col("k") % 3 == 0, "calibrated").when(F.col("k") % 3 == 1, "image").otherwise("catalogue")
    f = inv(spark, d).withColumn("stage", kind)
    table_time = f.groupBy("field", "obs").agg((F.min("mtime") + 600).alias("table_time"))
    return G.progress(f.where("not (field = 'w51' and stage = 'image')"), ["field", "obs"], table_time, ["calibrated", "image", "catalogue"])


@query("metrics_upsert", "SELECT o_custkey AS obsid, o_orderkey % 5 AS stage, 'price' AS metric, max(o_totalprice) AS value FROM orders WHERE o_orderkey % 5 <> 2 GROUP BY ALL UNION ALL SELECT o_custkey, 2, 'price', max(CASE WHEN o_custkey % 3 = 0 THEN -o_totalprice ELSE o_totalprice END) FROM orders WHERE o_orderkey % 5 = 2 GROUP BY ALL")
def metrics_upsert(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("obsid"), (F.col("o_orderkey") % 5).alias("stage"), F.lit("price").alias("metric"), "o_totalprice")
    old = o.groupBy("obsid", "stage", "metric").agg(F.max("o_totalprice").alias("value"))
    new = o.where("stage = 2 and obsid % 3 = 0").groupBy("obsid", "stage", "metric").agg(F.max(-F.col("o_totalprice")).alias("value"))
    return G.metrics_upsert(old, new)


@query(
    "provenance_digest",
    f"""{INV}, g AS (SELECT field, filter AS role, field || '/' || folder AS folder, list_sort(list(DISTINCT name)) AS l FROM f GROUP BY ALL)
SELECT field, role, folder, len(l) AS n, CASE WHEN len(l) > 12 THEN array_to_string(l[1:3], ', ') || ' ... ' || l[-1] || ' (' || len(l) || ')' ELSE array_to_string(l, ', ') END AS names FROM g""",
)
def provenance_digest(spark, d):
    x = inv(spark, d).select("field", F.col("filter").alias("role"), F.concat_ws("/", "field", "folder", "name").alias("path"))
    return G.provenance_digest(x, ["field"])

"""Queries on the archive monitor."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import monitor as M
from ..operators import select
from .registry import query, table
from .standins import INVENTORY, POLL_0, POLL_1, POLL_MJD

OBSNUM = "coalesce(nullif(regexp_extract(obs_id, '^jw(\\d{5})-o(\\d{3})', 2), ''), '')"
INST = "CASE WHEN starts_with(upper(coalesce(instrument_name, '')), 'NIRCAM') THEN 'NIRCam' WHEN starts_with(upper(coalesce(instrument_name, '')), 'MIRI') THEN 'MIRI' WHEN instrument_name IS NULL THEN '' ELSE 'Niriss' END"
BASE = f"""WITH o AS (SELECT *, t_obs_release IS NOT NULL AND t_obs_release <= {POLL_MJD[0]} AS released FROM ({POLL_0.sql})), n AS (SELECT *, t_obs_release IS NOT NULL AND t_obs_release <= {POLL_MJD[1]} AS released, {OBSNUM} AS obsnum, {INST} AS instrument FROM ({POLL_1.sql})),
j AS (SELECT n.*, o.released AS was, o.calib_level AS plevel, o.obs_id IS NOT NULL AS known FROM n LEFT JOIN o USING (program, obs_id)),
e AS (SELECT *, 'NEW_OBSERVATION' AS event, NULL AS previous FROM j WHERE NOT known UNION ALL SELECT *, 'NEWLY_RELEASED', NULL FROM j WHERE known AND released AND NOT was
  UNION ALL SELECT *, 'CALIB_LEVEL_UP', plevel FROM j WHERE known AND coalesce(calib_level, 0) > coalesce(plevel, 0))"""
FIELD = "CASE WHEN program = 7 THEN 'treasury' WHEN program % 4 = 3 THEN '' ELSE 'f' || (program % 5)::VARCHAR END"
READY = "(released AND coalesce(calib_level, 0) >= 2)"
ARRIVAL = f"({READY} AND (event <> 'CALIB_LEVEL_UP' OR coalesce(previous, 0) < 2))"
GROUPS = f"""{BASE}, g AS (SELECT program, obsnum, instrument, count(*) AS n_events, bool_or({READY}) AS ready, bool_or({ARRIVAL}) AS arrival, min(t_obs_release) FILTER ({READY}) AS oldest, any_value({FIELD}) AS field FROM e WHERE obsnum <> '' GROUP BY ALL)"""
KEYED = f"""{GROUPS}, k AS (SELECT *, program || '-o' || obsnum || '-' || CASE WHEN instrument = '' THEN 'NIRCam' ELSE instrument END AS dk, program || '-o' || obsnum AS tk FROM g WHERE field <> '' AND ready),
spent AS (SELECT program || '-o' || {OBSNUM} || CASE k % 3 WHEN 0 THEN '' ELSE '-' || CASE {INST} WHEN '' THEN 'NIRCam' ELSE {INST} END END AS key FROM ({POLL_0.sql}) WHERE k % 3 < 2), act AS (SELECT * FROM k WHERE dk NOT IN (SELECT key FROM spent) OR (instrument = 'NIRCam' AND tk NOT IN (SELECT key FROM spent)))"""


def old(spark, d):
    return M.summarize(POLL_0.df(spark, d), POLL_MJD[0]).withColumn("missing_since", F.lit(None).cast("double"))


def new(spark, d):
    return M.summarize(POLL_1.df(spark, d), POLL_MJD[1])


def events(spark, d):
    return M.diff_events(old(spark, d), new(spark, d))


def mapped(spark, d):
    e = events(spark, d)
    programs = e.select("program").distinct()
    mapping = e.where("program % 4 <> 3").select("program", "obsnum", F.lit(None).cast("string").alias("instrument"), F.concat(F.lit("f"), (F.col("program") % 5).cast("string")).alias("field")).distinct()
    names = programs.select(F.concat(F.lit("f"), (F.col("program") % 5).cast("string")).alias("field")).distinct().withColumn("display", F.upper("field"))
    return M.with_field(e, mapping, programs.where("program = 7").withColumn("field", F.lit("treasury")), names)


def spent(spark, d):
    x = M.S.obsnum(F.col("obs_id"))
    p, inst = F.col("program"), M.S.instrument_class(F.col("instrument_name"))
    key = F.when(F.col("k") % 3 == 0, M.S.trigger_key(p, x)).otherwise(M.S.download_key(p, x, inst))
    return POLL_0.df(spark, d).where("k % 3 < 2").select(key.alias("key")).distinct()


def actions(spark, d):
    s = spent(spark, d)
    return M.actionable(M.groups(mapped(spark, d)), s, s)


@query("summarize_poll", f"SELECT k, t_obs_release IS NOT NULL AND t_obs_release <= {POLL_MJD[0]} AS released, calib_level FROM ({POLL_0.sql})")
def summarize_poll(spark, d):
    p = POLL_0.df(spark, d).withColumn("turn", F.lit(1)).unionByName(POLL_0.df(spark, d).withColumns({"turn": F.lit(0), "calib_level": F.lit(9)}))
    return M.summarize(p, POLL_MJD[0], F.col("turn")).select("k", "released", "calib_level")


@query("diff_events", f"{BASE} SELECT program, obs_id, event, obsnum, instrument, calib_level, previous, released FROM e")
def diff_events(spark, d):
    return events(spark, d).select("program", "obs_id", "event", "obsnum", "instrument", "calib_level", F.col("previous_calib_level").alias("previous"), "released")


@query("disappeared", f"{BASE} SELECT program, obs_id, {POLL_MJD[1]}::DOUBLE AS missing_since FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.obs_id = o.obs_id)")
def disappeared(spark, d):
    return M.next_state(old(spark, d), new(spark, d), POLL_MJD[1]).where("missing_since is not null").select("program", "obs_id", "missing_since")


@query(
    "state_after_poll",
    f"{BASE} SELECT program, obs_id, calib_level, released FROM n WHERE program % 6 <> 5 UNION ALL SELECT program, obs_id, calib_level, released FROM o WHERE program % 6 = 5 OR NOT EXISTS (SELECT 1 FROM n WHERE n.obs_id = o.obs_id)",
)
def state_after_poll(spark, d):
    failed = new(spark, d).where("program % 6 = 5").select("program").distinct()
    return M.next_state(old(spark, d), new(spark, d), POLL_MJD[1], failed).select("program", "obs_id", "calib_level", "released")


@query("arrivals", f"{BASE} SELECT program, obs_id, event FROM e WHERE {ARRIVAL}")
def arrivals(spark, d):
    return events(spark, d).where(select.event_is_arrival()).select("program", "obs_id", "event")


@query("seeded", f"{BASE} SELECT program, obs_id, event FROM e WHERE program % 9 = 4")
def seeded(spark, d):
    state = old(spark, d).where("program % 9 <> 4 and program % 9 <> 5")
    known = old(spark, d).where("program % 9 = 5").select("program").distinct()
    return M.unseeded(events(spark, d), known, state).select("program", "obs_id", "event")


@query("event_fields", f"{BASE} SELECT program, obs_id, event, {FIELD} AS field, CASE WHEN program = 7 THEN 'treasury' WHEN program % 4 = 3 THEN '' ELSE upper({FIELD}) END AS display FROM e")
def event_fields(spark, d):
    return mapped(spark, d).select("program", "obs_id", "event", "field", "display")


@query("event_groups", f"{GROUPS} SELECT program, obsnum, instrument, n_events, ready, arrival, oldest, field FROM g")
def event_groups(spark, d):
    return M.groups(mapped(spark, d)).drop("obs_ids")


@query("actionable", f"{KEYED} SELECT program, obsnum, instrument, n_events, oldest FROM act")
def actionable(spark, d):
    return actions(spark, d).select("program", "obsnum", "instrument", "n_events", "oldest")


RANKED = f"{KEYED}, ranked AS (SELECT *, row_number() OVER (ORDER BY coalesce(oldest, 'inf'::DOUBLE), program, obsnum, instrument) AS rank FROM act)"


@query("capped", f"{RANKED} SELECT program, obsnum, instrument, rank, rank <= 4 AS acts FROM ranked")
def capped(spark, d):
    return M.capped(actions(spark, d)).select("program", "obsnum", "instrument", "rank", "acts")


@query(
    "capped_labels",
    f"{RANKED} SELECT string_agg(program || '-o' || obsnum || '-' || CASE instrument WHEN '' THEN '?' ELSE instrument END, ', ' ORDER BY rank) FILTER (rank <= 10) || CASE WHEN count(*) > 10 THEN ', and ' || (count(*) - 10) || ' more' ELSE '' END AS labels FROM ranked",
)
def capped_labels(spark, d):
    return M.labels(M.capped(actions(spark, d)))


@query(
    "deferred_state",
    f"""{RANKED}, def AS (SELECT DISTINCT e.program, e.obs_id FROM e JOIN ranked r USING (program, obsnum, instrument) WHERE rank > 4), s AS (SELECT program, obs_id, calib_level, released FROM n UNION ALL SELECT program, obs_id, calib_level, released FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.obs_id = o.obs_id))
SELECT * FROM s WHERE (program, obs_id) NOT IN (SELECT (program, obs_id) FROM def) UNION ALL SELECT program, obs_id, calib_level, released FROM o WHERE (program, obs_id) IN (SELECT (program, obs_id) FROM def)""",
)
def deferred_state(spark, d):
    later = M.capped(actions(spark, d)).where("not acts").select(*M.GROUP)
    deferred = events(spark, d).join(later, M.GROUP, "left_semi")
    state = M.next_state(old(spark, d), new(spark, d), POLL_MJD[1])
    return M.revert_deferred(state, old(spark, d), deferred).select("program", "obs_id", "calib_level", "released")


@query("in_flight", f"{KEYED} SELECT program, obsnum, instrument FROM act WHERE NOT (program % 10 = 2 AND obsnum < '500')")
def in_flight(spark, d):
    a = actions(spark, d)
    jobs = a.where("program % 10 = 2 and obsnum < '500'").select(F.concat("field", F.col("program").cast("string"), F.lit("-o"), "obsnum", F.lit("-run1")).alias("name"))
    return M.in_flight(a, jobs).select("program", "obsnum", "instrument")


@query("rearm", f"{KEYED} SELECT DISTINCT key FROM spent WHERE key NOT IN ('3-o003', '3-o003-NIRCam', '3-o003-MIRI', '3-o003-Niriss') UNION ALL SELECT '3-o003-004' UNION ALL SELECT '3-o003-004-MIRI'")
def rearm(spark, d):
    more = spark.createDataFrame([("3-o003",), ("3-o003-MIRI",), ("3-o003-004",), ("3-o003-004-MIRI",)], "key string")
    return M.rearm(spent(spark, d).unionByName(more), "3-o003").distinct()


@query("recorded_keys", f"WITH s AS (SELECT DISTINCT o_custkey::VARCHAR AS key FROM orders WHERE o_custkey % 3 = 0), a AS (SELECT DISTINCT o_custkey::VARCHAR AS key FROM orders WHERE o_orderkey % 2 = 0 AND o_orderstatus <> 'F') SELECT key, 1::BIGINT AS batch FROM s UNION ALL SELECT key, 2 FROM a WHERE key NOT IN (SELECT key FROM s)")
def recorded_keys(spark, d):
    o = table(spark, d, "orders").withColumn("key", F.col("o_custkey").cast("string"))
    keys = o.where("o_custkey % 3 = 0").select("key", F.lit(1).cast("long").alias("batch")).distinct()
    acted = o.select("key", (F.col("o_orderkey") % 2 == 0).alias("ok"), (F.col("o_orderstatus") == "F").alias("planned"))
    once = M.record_keys(keys, acted, 2)
    return M.record_keys(once, acted, 2)


@query(
    "routing",
    f"""{BASE}, x AS (SELECT CASE WHEN {FIELD} = 'treasury' THEN 'rolling' ELSE program || '-o' || obsnum || ' (' || CASE instrument WHEN '' THEN 'NIRCam' ELSE instrument END || ')' END AS target, {ARRIVAL} AS arrival, (program, obsnum, instrument) AS g FROM e WHERE {FIELD} = 'treasury' OR obsnum <> ''), r(run, fresh) AS (VALUES (0, false), (1, false), (2, true), (3, true), (4, false))
SELECT run, target, CASE WHEN bool_or(arrival OR fresh) THEN 'comment' ELSE 'edit' END AS route, count(DISTINCT g) AS n_groups FROM x, r GROUP BY run, target""",
)
def routing(spark, d):
    from functools import reduce

    e = mapped(spark, d)
    runs = [(None, None), ("CAPPED \u2014 9 group(s)", "CAPPED"), ("LOW DISK: 1 TB", "CAPPED"), ("LOW DISK: 1 TB", None), ("SEED RUN", None)]
    each = [M.routed(e, None if n is None else F.lit(n), memo, "treasury").withColumn("run", F.lit(i)) for i, (n, memo) in enumerate(runs)]
    return reduce(lambda a, b: a.unionByName(b), each)


@query(
    "event_lines",
    f"""{BASE} SELECT rpad(event, 16, ' ') || ' ' || program || ' ' || obs_id || ' [field=' || coalesce(nullif({FIELD}, ''), '?unmapped?') || ' tile=' || target_name || ' filters=' || coalesce(filters, '?') || ']' ||
  CASE WHEN event = 'CALIB_LEVEL_UP' THEN ' (level ' || coalesce(previous::VARCHAR, 'None') || ' -> ' || calib_level || ')' ELSE ' calib=' || coalesce(calib_level::VARCHAR, 'None') || ' release=' || coalesce(strftime(make_timestamp(((t_obs_release - 40587) * 86400000000)::BIGINT), '%Y-%m-%d %H:%M UTC'), 'unknown') END ||
  CASE WHEN {READY} THEN '' ELSE ' PLANNED(no released calibrated data yet)' END AS line FROM e""",
)
def event_lines(spark, d):
    e = mapped(spark, d).withColumns({"ready": select.event_ready(), "tile": F.col("target_name")})
    return e.select(M.S.event_text({c: F.col(c) for c in e.columns}).alias("line"))


@query(
    "notice_memo",
    """WITH r AS (SELECT DISTINCT o_custkey AS run, ['LOW DISK', 'CAPPED', NULL, NULL][o_custkey % 4 + 1] AS class, CASE WHEN o_custkey % 2 = 0 THEN 'CAPPED' END AS memo FROM orders), p AS (SELECT o_custkey AS run, bool_and(o_orderkey % 97 <> 0 AND o_orderstatus <> 'F') AS ok FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1)
SELECT run, CASE WHEN class IS NULL THEN NULL WHEN ok THEN class ELSE memo END AS memo FROM r LEFT JOIN p USING (run)""",
)
def notice_memo(spark, d):
    o = table(spark, d, "orders").withColumn("run", F.col("o_custkey"))
    notices = [F.when(F.col("run") % 4 == i, n) for i, n in ((0, "LOW DISK: 2 TB"), (1, "CAPPED \u2014 9"), (3, "SEED RUN"))]
    runs = o.select("run", F.coalesce(*notices).alias("notice"), F.when(F.col("run") % 2 == 0, "CAPPED").alias("memo")).distinct()
    posts = o.select("run", (F.col("o_orderkey") % 2 == 0).alias("notifies"), F.when(F.col("o_orderkey") % 97 != 0, F.col("o_orderstatus") != "F").alias("ok"))
    return M.memo_after(runs, posts)


SIZES = f"f AS ({INVENTORY.sql}), z AS (SELECT field, filter, obs, CASE WHEN count(size) = count(*) THEN sum(size)::BIGINT END AS bytes, count(*) AS n_products FROM f WHERE ends_with(name, '_cal.fits') OR ends_with(name, '_i2d.fits') GROUP BY ALL)"


@query("size_budget", f"WITH {SIZES} SELECT field, filter, obs, bytes, n_products, CASE WHEN bytes IS NULL THEN 'unknown size' WHEN bytes / 1e6 > 20 THEN 'over headroom' END AS skip, bytes IS NOT NULL AND bytes / 1e6 <= 20 AS admitted FROM z")
def size_budget(spark, d):
    return M.admitted(M.download_size(INVENTORY.df(spark, d), ["field", "filter", "obs"], ["_cal.fits", "_i2d.fits"]), 20.0, 1e6)


@query(
    "pointings",
    f"""{BASE}, u AS (SELECT *, row_number() OVER (PARTITION BY program, obsnum ORDER BY obs_id) AS r FROM n WHERE obsnum <> '' AND s_ra IS NOT NULL AND NOT isnan(s_ra))
SELECT program, obsnum, target_name AS tile, printf('%.7f', s_ra) AS ra_deg, printf('%.7f', s_dec) AS dec_deg, coalesce(calib_level, -1) AS calib, released FROM u WHERE r = 1""",
)
def pointings(spark, d):
    return M.pointings(new(spark, d))


@query(
    "registry_build",
    f"""{BASE}, t AS (SELECT program, obsnum, instrument, t_max, unnest(CASE WHEN filters IS NULL THEN ['-'] ELSE [upper(x) for x in string_split_regex(filters, '[;,]')] END) AS f FROM n WHERE obsnum <> '' AND coalesce(calib_level, 0) >= 2)
SELECT program, obsnum, CASE instrument WHEN '' THEN 'NIRCam' ELSE instrument END AS instrument, coalesce(string_agg(DISTINCT f, '|' ORDER BY f) FILTER (regexp_matches(f, '^F\\d{{3,4}}[WNM]2?$')), '') AS filters, (min(t_max) - 40587)::BIGINT AS first_day FROM t GROUP BY ALL""",
)
def registry_build(spark, d):
    r = M.registry(new(spark, d))
    return r.select(*M.GROUP, F.array_join("filters", "|").alias("filters"), F.unix_date("first_date").cast("long").alias("first_day"))


@query("coverage_gap", f"{BASE} SELECT DISTINCT program, obsnum FROM n WHERE obsnum <> '' AND program % 4 <> 1 AND NOT (program % 4 = 2 AND obsnum >= '300')")
def coverage_gap(spark, d):
    seen = new(spark, d).select("program", M.S.obsnum(F.col("obs_id")).alias("obsnum")).where("obsnum <> ''").distinct()
    whole = seen.where("program % 4 = 1").select("program", F.lit(None).cast("string").alias("obsnum")).distinct()
    return M.coverage_gap(seen, seen.where("program % 4 = 2 and obsnum >= '300'").unionByName(whole))


@query("poll_digest", f"{BASE} SELECT (SELECT count(DISTINCT program) FROM (SELECT program FROM o UNION SELECT program FROM n)) AS programs, (SELECT count(*) FROM (SELECT obs_id FROM o UNION SELECT obs_id FROM n)) AS observations, (SELECT count(*) FROM o WHERE obs_id NOT IN (SELECT obs_id FROM n)) AS missing, '1998-07-06 00:00 UTC' AS last_poll")
def poll_digest(spark, d):
    return M.poll_digest(M.next_state(old(spark, d), new(spark, d), POLL_MJD[1]), F.lit(POLL_MJD[1]))


@query(
    "filter_tokens",
    f"""WITH x AS (SELECT program, k, i, upper(t) AS t FROM ({POLL_1.sql}), unnest(string_split_regex(coalesce(filters, ''), '[;,]')) WITH ORDINALITY AS u(t, i)), y AS (SELECT program, t, min(k * 10 + i) AS pos FROM x WHERE regexp_matches(t, '^F\\d{{3,4}}[WNM]2?$') GROUP BY ALL)
SELECT p.program, coalesce(string_agg(t, '|' ORDER BY pos), '') AS filters FROM (SELECT DISTINCT program FROM x) p LEFT JOIN y USING (program) GROUP BY p.program""",
)
def filter_tokens(spark, d):
    x = POLL_1.df(spark, d).withColumn("filters", M.S.parse_filters(F.col("filters")))
    return M.token_union(x, ["program"], "filters", "k").select("program", F.array_join("filters", "|").alias("filters"))


@query("observation_numbers", f"SELECT program, string_agg(DISTINCT {OBSNUM}, ',' ORDER BY {OBSNUM}) AS numbers FROM ({POLL_1.sql}) GROUP BY program")
def observation_numbers(spark, d):
    x = POLL_1.df(spark, d).groupBy("program").agg(F.array_sort(F.collect_set(M.S.obsnum(F.col("obs_id")))).alias("n"))
    return x.select("program", F.array_join("n", ",").alias("numbers"))


@query(
    "streamed_polls",
    f"""{BASE}, x AS (SELECT 0::BIGINT AS batch, program, obs_id, 'NEW_OBSERVATION' AS event FROM o WHERE program % 6 <> 5 UNION ALL SELECT 1, program, obs_id, event FROM e WHERE program % 6 <> 5 UNION ALL SELECT 1, program, obs_id, 'NEW_OBSERVATION' FROM n WHERE program % 6 = 5)
SELECT batch, program, obs_id, event FROM x""",
)
def streamed_polls(spark, d):
    """Both polls through the stream: each run takes what is new as one micro-batch and commits a state version.

    A sixth of the programs fails in the first poll and is new in the second; each row has an outdated double before it.
    """
    from ..sources.staging import new_folder
    from ..streaming import polls

    root = new_folder(spark, "polls")
    shape = old(spark, d).schema
    state = polls.VersionedState(spark, f"{root}/state", shape)
    sink = lambda e, i: e.select(F.lit(i).cast("long").alias("batch"), "program", "obs_id", "event").write.mode("overwrite").parquet(f"{root}/events/run={i}")
    failed = lambda b: b.where("program % 6 = 5 and poll_mjd < 51000").select("program")
    run = polls.commit_poll(state, lambda b: b.agg(F.max("poll_mjd")).first()[0], sink, F.col("turn"), failed=failed)
    for part, mjd in zip((POLL_0, POLL_1), POLL_MJD):
        rows = part.df(spark, d).withColumns({"poll_mjd": F.lit(mjd), "turn": F.lit(1)})
        rows = rows.unionByName(rows.withColumns({"turn": F.lit(0), "calib_level": F.lit(9)}))
        rows.write.mode("append").parquet(f"{root}/polls")
        polls.watch(spark, f"{root}/polls", rows.schema, run, f"{root}/checkpoint", None).awaitTermination()
    return spark.read.schema("batch long, program long, obs_id string, event string").parquet(f"{root}/events/run=0", f"{root}/events/run=1")

"""Poll scenarios, in batch and as a stream."""

import pytest
from pyspark.sql import functions as F

from skyledger.operators import monitor as M
from skyledger.streaming import polls

SCHEMA = "program long, obs_id string, calib_level int, t_obs_release double, instrument_name string, filters string"
STATE = SCHEMA + ", released boolean, missing_since double"


def row(obs, level=2, release=100.0, program=2221, inst="NIRCAM/IMAGE"):
    return (program, obs, level, release, inst, "F212N")


def poll(spark, rows, mjd):
    return M.summarize(spark.createDataFrame(rows, SCHEMA), mjd)


def with_missing(df):
    return df.withColumn("missing_since", F.lit(None).cast("double"))


def events(old, new):
    return sorted((r.obs_id, r.event) for r in M.diff_events(old, new).collect())


A, B = "jw02221-o001_t001_nircam", "jw02221002001_x"


def test_diff_cases(spark):
    empty = spark.createDataFrame([], STATE)
    new = poll(spark, [row(A), row(B, None, None)], 200.0)
    assert events(empty, new) == [(A, "NEW_OBSERVATION"), (B, "NEW_OBSERVATION")]
    old = with_missing(poll(spark, [row(A, 1, 300.0), row(B, -1, None)], 200.0))
    assert events(old, poll(spark, [row(A, 2, 150.0), row(B, None, None)], 200.0)) == [(A, "CALIB_LEVEL_UP"), (A, "NEWLY_RELEASED"), (B, "CALIB_LEVEL_UP")]
    assert events(with_missing(poll(spark, [row(A, None)], 200.0)), poll(spark, [row(A, -1)], 200.0)) == []
    assert events(old, poll(spark, [row(A, 1, 300.0)], 200.0)) == []


def test_vanish_and_return(spark):
    s0 = with_missing(poll(spark, [row(A), row(B)], 200.0))
    s1 = M.next_state(s0, poll(spark, [row(A)], 201.0), 201.0)
    s2 = M.next_state(s1, poll(spark, [row(A)], 202.0), 202.0)
    assert {r.obs_id: r.missing_since for r in s2.collect()} == {A: None, B: 201.0}
    back = poll(spark, [row(A), row(B)], 203.0)
    assert events(s2, back) == []
    assert {r.missing_since for r in M.next_state(s2, back, 203.0).collect()} == {None}


def test_cap_defers_and_drains(spark):
    none = spark.createDataFrame([], "key string")
    names = [f"jw02221-o{i:03d}_x" for i in range(1, 8)]
    old = spark.createDataFrame([], STATE)
    seen, state = [], old
    for turn in range(3):
        new = poll(spark, [row(n, 2, 100.0 - i) for i, n in enumerate(names)], 200.0)
        ev = M.diff_events(state, new).withColumn("field", F.lit("brick"))
        ranked = M.capped(M.actionable(M.groups(ev), none, none), 3)
        acted = sorted(r.obsnum for r in ranked.where("acts").collect())
        later = ev.join(ranked.where("not acts").select(*M.GROUP), M.GROUP, "left_semi")
        state = spark.createDataFrame(M.revert_deferred(M.next_state(state, new, 200.0), state, later).collect(), STATE)
        seen.append(acted)
    assert seen == [["005", "006", "007"], ["002", "003", "004"], ["001"]]


def test_rearm(spark):
    keys = spark.createDataFrame([("1-o001",), ("1-o001-MIRI",), ("1-o001-002",), ("1-o001-002-MIRI",), ("1-o0011",)], "key string")
    assert [r.key for r in M.rearm(keys, "1-o001").collect()] == ["1-o001-002", "1-o001-002-MIRI", "1-o0011"]
    assert [r.key for r in M.rearm(keys, "1-o001-002", downloads=False).collect()] == ["1-o001", "1-o001-MIRI", "1-o001-002-MIRI", "1-o0011"]
    with pytest.raises(KeyError):
        M.rearm(keys, "9-o001")
    with pytest.raises(ValueError):
        M.rearm(keys, "1-o")


def test_stream_commits_versions_once(spark, tmp_path):
    src, root = str(tmp_path / "polls"), str(tmp_path / "state")
    schema = spark.createDataFrame([], SCHEMA).schema
    for i, rows in enumerate([[row(A, 1, 300.0)], [row(A, 2, 150.0), row(B)], [row(B)]]):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)
    state = polls.VersionedState(spark, root, spark.createDataFrame([], STATE).schema)
    assert state.load().count() == 0
    got = []
    run = polls.commit_poll(state, lambda b: 200.0, lambda e, i: got.extend((i, r.obs_id, r.event) for r in e.collect()), F.col("obs_id"))
    polls.watch(spark, src, schema, run, str(tmp_path / "ck")).awaitTermination()
    assert state.version() == 3 and {r.obs_id for r in state.load().collect()} == {A, B}
    before = list(got)
    run(spark.createDataFrame([row("jw02221-o009_x")], SCHEMA), 1)  # a replayed batch changes nothing
    assert got == before and state.version() == 3


def test_a_crash_between_steps_loses_no_state_and_repeats_the_batch(spark, tmp_path, monkeypatch):
    state = polls.VersionedState(spark, str(tmp_path / "state"), spark.createDataFrame([], STATE).schema)
    got = []
    run = polls.commit_poll(state, lambda b: 200.0, lambda e, i: got.append((i, sorted((r.obs_id, r.event) for r in e.collect()))), F.col("obs_id"))
    run(spark.createDataFrame([row(A, 1, 300.0)], SCHEMA), 0)
    second = spark.createDataFrame([row(A, 2, 150.0), row(B)], SCHEMA)
    with monkeypatch.context() as m:
        m.setattr(state, "commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            run(second, 1)
    # A write that died: rows are there, the mark of success is not.
    state.commit(state.load(), 2)
    (tmp_path / "state" / "version=2" / "_SUCCESS").unlink()
    assert state.version() == 1 and [r.obs_id for r in state.load().collect()] == [A]
    run(second, 1)
    assert got[1] == got[2] and got[1][0] == 1 and state.version() == 2 and state.load().count() == 2


def test_stream_seeds_caps_defers_and_isolates(spark, tmp_path):
    of = lambda name, schema: polls.VersionedState(spark, str(tmp_path / name), spark.createDataFrame([], schema).schema)
    state, seeded = of("state", STATE), of("seeded", "program long")
    acted = []
    run = polls.commit_poll(
        state, lambda b: 200.0, lambda e, i: None, F.col("obs_id"), seeded=seeded, failed=lambda b: b.where("filters = 'failed'").select("program"),
        with_field=lambda e: e.withColumn("field", F.lit("brick")), act=lambda g, i: acted.append((i, sorted(r.obsnum for r in g.collect()))), most=2,
    )
    ids = [f"jw02221-o{n:03d}_t001_nircam" for n in range(1, 6)]
    run(spark.createDataFrame([row(ids[0])], SCHEMA), 0)
    run(spark.createDataFrame([row(i) for i in ids], SCHEMA), 1)
    run(spark.createDataFrame([row(i) for i in ids], SCHEMA), 2)
    bad = spark.createDataFrame([row(ids[0])], SCHEMA).withColumn("filters", F.lit("failed"))
    run(bad, 3)
    assert acted == [(0, []), (1, ["002", "003"]), (2, ["004", "005"]), (3, [])]
    assert {r.obs_id: r.missing_since for r in state.load().collect()} == dict.fromkeys(ids)
    assert [r.program for r in seeded.load().collect()] == [2221]


def full_state(spark, root):
    schema = spark.createDataFrame([], STATE).schema
    return polls.VersionedState(spark, str(root), schema, {"seeded": polls.SEEDED, "keys": polls.KEYS})


class Outside:
    """What actions do beyond Spark: a list of the groups acted on. ``crash`` raises before or after the outcome is given."""

    def __init__(self):
        self.done = []

    def act(self, groups, batch):
        for r in groups.orderBy("rank").collect():
            self.done.append((batch, r.program, r.obsnum))
            rows = [(r.program, r.obsnum, r.instrument, k, f"{r.program}-o{r.obsnum}" + ("-NIRCam" if k == "download" else ""), True, False) for k in ("download", "trigger")]
            yield groups.sparkSession.createDataFrame(rows, polls.OUTCOMES)

    def resolve(self, groups, batch):
        known = {(p, o) for b, p, o in self.done if b == batch}
        rows = [(r.program, r.obsnum, r.instrument, k, f"{r.program}-o{r.obsnum}" + ("-NIRCam" if k == "download" else ""), True, False) for r in groups.collect() if (r.program, r.obsnum) in known for k in ("download", "trigger")]
        return groups.sparkSession.createDataFrame(rows, polls.OUTCOMES)


def turns(spark):
    """Program 2221 begins, program 9 begins later, more groups than the cap, one that vanishes, one level up."""
    ids = [f"jw02221-o{n:03d}_t001_nircam" for n in range(1, 5)]
    other = [f"jw00009-o{n:03d}_t001_nircam" for n in (1, 2)]
    of = lambda rows: spark.createDataFrame(rows, SCHEMA)
    return [
        of([row(ids[0], 1)]),
        of([row(i) for i in ids] + [row(other[0], program=9)]),
        of([row(i) for i in ids[:3]] + [row(o, program=9) for o in other]),
    ]


def play(spark, root, numbers, outside, crash=None):
    """Turns through commit_poll; with ``crash`` = (durable step, before or after it) the run dies there and is replayed."""
    state, events = full_state(spark, root), {}
    run = polls.commit_poll(
        state, lambda b: 200.0, lambda e, i: events.__setitem__(i, sorted((r.obs_id, r.event) for r in e.collect())), F.col("obs_id"),
        with_field=lambda e: e.withColumn("field", F.lit("brick")), act=outside.act, resolve=outside.resolve, most=2,
    )
    steps, put, batches, died = 0, state._put, turns(spark), False

    def dying(df, folder):
        nonlocal steps
        steps += 1
        if crash == (steps, "before"):
            raise OSError("lost")
        put(df, folder)
        if crash == (steps, "after"):
            raise OSError("lost")

    for turn in numbers:
        steps, state._put = 0, dying
        try:
            run(batches[turn], turn)
        except OSError:
            died, state._put = True, put
            run(batches[turn], turn)
    return {t: sorted(map(str, state.load(t).collect())) for t in state.schemas}, events, steps, died


def test_a_crash_at_any_step_changes_nothing(spark, tmp_path):
    import shutil

    first = Outside()
    play(spark, tmp_path / "begun", [0, 1], first)
    shutil.copytree(tmp_path / "begun", tmp_path / "whole")
    outside = Outside()
    tables, events, steps, _ = play(spark, tmp_path / "whole", [2], outside)
    assert first.done == [(1, 2221, "001"), (1, 2221, "002")] and outside.done == [(2, 9, "002"), (2, 2221, "003")] and steps == 7
    assert len(tables["keys"]) == 8 and len(tables["seeded"]) == 2
    for at in range(1, steps + 1):
        side = "after" if at == 1 else "before"  # after a step is before the next, but for the first
        shutil.copytree(tmp_path / "begun", tmp_path / f"{at}{side}")
        again = Outside()
        got = play(spark, tmp_path / f"{at}{side}", [2], again, (at, side))
        assert got[3] and got[:2] == (tables, events) and again.done == outside.done, (at, side)


def test_open_intents_without_a_resolver_are_acted_on_again_and_written_ones_are_not(spark, tmp_path):
    state, calls = full_state(spark, tmp_path / "s"), []

    def act(groups, batch):
        calls.append(sorted(r.obsnum for r in groups.collect()))
        if len(calls) == 2:
            yield groups.where("obsnum = '001'").selectExpr("program", "obsnum", "instrument", "'download' as kind", "concat(program, '-o', obsnum, '-NIRCam') as key", "false as ok", "false as planned")
            raise OSError("lost")

    run = polls.commit_poll(state, lambda b: 200.0, lambda e, i: None, F.col("obs_id"), with_field=lambda e: e.withColumn("field", F.lit("brick")), act=act)
    first, second, _ = turns(spark)
    run(first, 0)
    with pytest.raises(OSError):
        run(second, 1)
    run(second, 1)
    assert calls == [[], ["001", "002", "003", "004"], ["002", "003", "004"]]
    assert state.load("keys").count() == 0  # a failure spends no key


def test_appended_tables_are_compacted_and_pruned(spark, tmp_path, monkeypatch):
    import datetime
    import os

    monkeypatch.setattr(polls, "PIECES", 3)
    state = full_state(spark, tmp_path / "s")
    for v in range(1, 8):
        state.commit(spark.createDataFrame([], STATE), v, appended={"keys": spark.createDataFrame([("download", f"k{v}", v)], polls.KEYS)})
    assert {r.key for r in state.load("keys").collect()} == {f"k{v}" for v in range(1, 8)} and len(state._record(7)["keys"]) <= 3
    assert {r.key for r in state.load("keys", at_most=2).collect()} == {"k1", "k2"}
    before = len(os.listdir(tmp_path / "s" / "data"))
    state.prune(datetime.datetime.now(datetime.UTC).date())
    assert [v for v, _ in state.versions()] == [6, 7] and len(os.listdir(tmp_path / "s" / "data")) < before
    assert {r.key for r in state.load("keys").collect()} == {f"k{v}" for v in range(1, 8)}


def test_first_version_of_a_day_is_kept_fourteen_days(spark, tmp_path):
    import datetime
    import os

    state = polls.VersionedState(spark, str(tmp_path / "s"), spark.createDataFrame([], "program long").schema)
    day = lambda n: datetime.datetime(2026, 1, n, 12, tzinfo=datetime.UTC)
    for v, n in enumerate([1, 1, 2, 2, 2, 10, 17, 17], 1):
        state.commit(spark.range(v).select(F.col("id").alias("program")), v)
        os.utime(tmp_path / "s" / f"version={v}" / "_SUCCESS", (day(n).timestamp() + v,) * 2)
    assert state.backups() == {day(2).date(): 2, day(10).date(): 5, day(17).date(): 6}
    state.prune(day(17).date())
    assert [v for v, _ in state.versions()] == [5, 6, 7, 8]


def test_registered_names_are_unique_and_oracles_belong():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and len(e.queries()) > 150


def test_per_key_stream_gives_the_events_of_the_diff(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    schema = "program long, obs_id string, released boolean, calib_level int, poll long"
    turns = [[(1, "a", False, 1, 0), (1, "b", True, None, 0)], [(1, "a", True, 2, 1), (1, "b", True, -1, 1), (2, "c", True, 3, 1)], [(1, "a", True, 2, 2), (1, "b", True, 2, 2)]]
    for i, rows in enumerate(turns):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"turn={i}"))
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True)
    stream = polls.event_stream(reader.parquet(str(tmp_path / "in")))
    stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
    got = sorted((r.poll, r.obs_id, r.event) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [
        (0, "a", "NEW_OBSERVATION"),
        (0, "b", "NEW_OBSERVATION"),
        (1, "a", "CALIB_LEVEL_UP"),
        (1, "a", "NEWLY_RELEASED"),
        (1, "c", "NEW_OBSERVATION"),
        (2, "b", "CALIB_LEVEL_UP"),
    ]


def test_per_key_stream_goes_on_from_a_committed_state(spark, tmp_path):
    """Half of the polls in batch, the others by a stream with a fresh checkpoint, against all of them in batch."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    state = "program long, obs_id string, released boolean, calib_level int, missing_since double"
    turns = [
        [(1, "a", False, 1), (1, "b", True, None), (2, "x", True, 2), (3, "p", True, 1)],
        [(1, "a", False, 1), (2, "x", True, 2), (2, "y", False, 0)],
        [(1, "b", True, 2), (2, "y", True, 0), (3, "p", True, 1)],
        [(1, "a", True, 3), (1, "c", True, 1), (3, "q", True, None)],
        [(2, "z", True, 1), (3, "q", True, -1), (3, "p", True, 1)],
    ]
    old, events, states = spark.createDataFrame([], state), [], []
    for i, rows in enumerate(turns):
        new = spark.createDataFrame(rows, "program long, obs_id string, released boolean, calib_level int").withColumn("instrument_name", F.lit("NIRCAM"))
        known = old.withColumn("instrument_name", F.lit("NIRCAM"))
        events += [(i, r.obs_id, r.event) for r in M.diff_events(known, new).collect()]
        old = spark.createDataFrame(M.next_state(old, new, float(i)).collect(), state)
        states.append(old)
        if i >= 2:
            spark.createDataFrame([(*r, i) for r in rows], polls.RECORDS).coalesce(1).write.parquet(str(tmp_path / "in" / f"turn={i}"))
    reader = spark.readStream.schema(polls.RECORDS).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True)
    start = states[1].withColumn("missing_since", F.col("missing_since").cast("long"))
    stream = polls.event_stream(reader.parquet(str(tmp_path / "in")), start, shards=3)
    stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
    changes = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.poll, r.obs_id, r.event) for r in changes if r.event not in ("MISSING", "SEEN_AGAIN")) == sorted(e for e in events if e[0] >= 2)
    missing = {(r.program, r.obs_id): r.missing_since for r in states[1].collect()}
    for r in sorted(changes, key=lambda r: r.poll):
        if r.event in ("MISSING", "SEEN_AGAIN", "NEW_OBSERVATION"):
            missing[r.program, r.obs_id] = r.missing_since
    assert missing == {(r.program, r.obs_id): r.missing_since for r in states[-1].collect()} and any(v is not None for v in missing.values())

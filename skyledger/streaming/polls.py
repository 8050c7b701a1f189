"""The monitor as a stream: each micro-batch is a poll, and each commit a new version of all its tables at once.

A commit is a record of where each table lies - the state, the seeded programs, the spent keys -, and it counts once Spark
has marked the record's write as a success. Tables are written before it into folders of their own that nothing overwrites,
and readers follow the highest record only. So a run that dies at any step leaves the commit before it in place, whole; a
batch that is replayed begins from that commit, and one whose record is there does nothing.

Actions reach out of Spark, so no commit can hold them. Which groups a batch acts on is written down before it acts (its
intents) and what came of it as it is known (its outcomes): a replay keeps to the intents, leaves out what has an outcome
and may ask the outside about the rest.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from ..operators import monitor
from ..sources.staging import staged

#: Schemas of the tables that a monitor keeps beside its state, by the names commit_poll knows.
SEEDED, KEYS = "program long", "kind string, key string, batch long"
INTENTS = "program long, obsnum string, instrument string, field string, oldest double, rank int, acts boolean"
OUTCOMES = "program long, obsnum string, instrument string, kind string, key string, ok boolean, planned boolean"
#: An appended table of more pieces is written anew as one.
PIECES = 30


class VersionedState:
    """Tables in ``root`` that are committed together; the first is called "state", ``tables`` names others with their schemas.

    Commit N is the record ``root``/version=N: rows (name, place, path), each table being the union of its paths, which lie
    below ``root``/data. A table that no commit has is empty; a broken one raises when it is read.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType, tables: dict[str, str] | None = None):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.schemas = {"state": schema} | {name: spark.createDataFrame([], s).schema for name, s in (tables or {}).items()}

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path

    def _names(self, folder: str) -> list[str]:
        fs, path = self._fs()
        return [x.getPath().getName() for x in fs.listStatus(path(folder))] if fs.exists(path(folder)) else []

    def _done(self, folder: str) -> bool:
        fs, path = self._fs()
        return fs.exists(path(f"{folder}/_SUCCESS"))

    def _put(self, df: DataFrame, folder: str) -> None:
        """Every durable step goes through here: a write that counts when Spark marks it as a success."""
        df.write.mode("overwrite").parquet(folder)

    def versions(self) -> list[tuple[int, datetime.date]]:
        """Complete commits in order, with the (UTC) day on which each was made."""
        fs, path = self._fs()
        out = []
        for name in self._names(self.root):
            if name.startswith("version=") and self._done(f"{self.root}/{name}"):
                when = fs.getFileStatus(path(f"{self.root}/{name}/_SUCCESS")).getModificationTime() / 1000
                out.append((int(name[8:]), datetime.datetime.fromtimestamp(when, datetime.UTC).date()))
        return sorted(out)

    def version(self) -> int | None:
        found = self.versions()
        return found[-1][0] if found else None

    def _record(self, version: int | None) -> dict[str, list[str]]:
        """The paths of each table, from one commit's record: a few rows."""
        out: dict[str, list[str]] = {}
        if version is not None:
            rows = self.spark.read.schema("name string, place int, path string").option("mode", "FAILFAST").parquet(f"{self.root}/version={version}")
            for r in rows.orderBy("name", "place").collect():
                out.setdefault(r.name, []).append(r.path)
        return out

    def load(self, name: str = "state", at_most: int | None = None) -> DataFrame:
        """A table as the last commit has it, or the last one whose number is at most ``at_most``."""
        found = [v for v, _ in self.versions() if at_most is None or v <= at_most]
        paths = self._record(found[-1] if found else None).get(name)
        if not paths:
            return self.spark.createDataFrame([], self.schemas[name])
        return self.spark.read.schema(self.schemas[name]).option("mode", "FAILFAST").parquet(*[f"{self.root}/{p}" for p in paths])

    def commit(self, state: DataFrame, version: int, replaced: dict[str, DataFrame] | None = None, appended: dict[str, DataFrame] | None = None) -> None:
        """Write the tables, then the record that names them. Tables that are not given stay as the last commit has them.

        What is ``appended`` adds a piece to its table, which is not read or written again but for once in PIECES commits.
        """
        found = [v for v, _ in self.versions() if v < version]
        record = self._record(found[-1] if found else None)

        def put(name: str, df: DataFrame) -> str:
            path = f"data/{name}-{version}-{uuid.uuid4().hex}"
            self._put(df.select(*self.schemas[name].fieldNames()), f"{self.root}/{path}")
            return path

        for name, df in (appended or {}).items():
            if len(record.get(name, ())) >= PIECES:
                record[name] = [put(name, self.load(name, at_most=version - 1).unionByName(df))]
            else:
                record[name] = [*record.get(name, ()), put(name, df)]
        for name, df in {**(replaced or {}), "state": state}.items():
            record[name] = [put(name, df)]
        rows = [(name, place, path) for name, paths in record.items() for place, path in enumerate(paths)]
        self._put(self.spark.createDataFrame(rows, "name string, place int, path string").coalesce(1), f"{self.root}/version={version}")

    def backups(self) -> dict[datetime.date, int]:
        """For each day with a commit, the version that the day's first commit replaced: the tables as the day began."""
        found = self.versions()
        first: dict[datetime.date, int] = {}
        for (before, was), (_, day) in zip(found, found[1:]):
            if was < day:
                first.setdefault(day, before)
        return first

    def prune(self, today: datetime.date, keep_days: int = 14) -> None:
        """Remove commits that are neither the last two nor the backup of one of the last ``keep_days`` days, the tables that
        only they name, and the intents and outcomes of batches that are committed."""
        fs, path = self._fs()
        found = self.versions()
        if not found:
            return
        last = found[-1][0]
        keep = {v for v, _ in found[-2:]} | {v for day, v in self.backups().items() if (today - day).days <= keep_days}
        for v, _ in found:
            if v not in keep:
                fs.delete(path(f"{self.root}/version={v}"), True)
        named = {p for v in keep for paths in self._record(v).values() for p in paths}
        for name in self._names(f"{self.root}/data"):
            if f"data/{name}" not in named and int(name.split("-")[-2]) <= last:
                fs.delete(path(f"{self.root}/data/{name}"), True)
        for kind in ("intents", "outcomes"):
            for name in self._names(f"{self.root}/{kind}"):
                if int(name[6:]) < last:
                    fs.delete(path(f"{self.root}/{kind}/{name}"), True)

    def intents(self, batch: int) -> DataFrame | None:
        """The ranked groups that a run of this batch has written down, None if none has."""
        folder = f"{self.root}/intents/batch={batch}"
        return self.spark.read.schema(INTENTS).parquet(folder) if self._done(folder) else None

    def intend(self, ranked: DataFrame, batch: int) -> DataFrame:
        self._put(ranked.select(*[c.split()[0] for c in INTENTS.split(", ")]), f"{self.root}/intents/batch={batch}")
        return self.intents(batch)

    def outcomes(self, batch: int) -> DataFrame:
        """What is known to have come of a batch's actions."""
        folder = f"{self.root}/outcomes/batch={batch}"
        parts = [f"{folder}/{p}" for p in self._names(folder) if self._done(f"{folder}/{p}")]
        return self.spark.read.schema(OUTCOMES).parquet(*parts) if parts else self.spark.createDataFrame([], OUTCOMES)

    def note(self, outcomes: DataFrame | Iterable[DataFrame] | None, batch: int) -> None:
        """Write outcomes down; of several tables each as soon as it is there."""
        for df in [] if outcomes is None else [outcomes] if isinstance(outcomes, DataFrame) else outcomes:
            self._put(df.select(*[c.split()[0] for c in OUTCOMES.split(", ")]), f"{self.root}/outcomes/batch={batch}/part-{uuid.uuid4().hex}")


Programs = Callable[[DataFrame], DataFrame]
Outcomes = DataFrame | Iterable[DataFrame] | None


def spent_keys(keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(downloaded, triggered) of a table of KEYS."""
    return keys.where("kind = 'download'").select("key"), keys.where("kind = 'trigger'").select("key")


def commit_poll(
    state: VersionedState,
    poll_mjd: Callable[[DataFrame], float],
    sink: Callable[[DataFrame, int], None],
    order: Column,
    *,
    failed: Programs | None = None,
    seeded: VersionedState | None = None,
    with_field: Callable[[DataFrame], DataFrame] | None = None,
    spent: Callable[[], tuple[DataFrame, DataFrame]] | None = None,
    act: Callable[[DataFrame, int], Outcomes] | None = None,
    resolve: Callable[[DataFrame, int], Outcomes] | None = None,
    most: int = 4,
) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: diff the poll against the committed state, hand on events and actions, commit.

    Of rows with one key the last by ``order`` wins. Programs that ``failed`` names (a column program) keep their records.
    ``sink`` has all events. With ``act``, groups of events of programs that had a baseline - records, or a row among the
    seeded programs - are ranked once ``with_field`` has mapped them: the first ``most`` go to ``act``, the records of the
    others are committed as they were before the poll, so that they come again. A program's first poll is committed and
    nothing follows.

    ``state`` may hold the tables "seeded" (SEEDED) and "keys" (KEYS); they are then part of the same commit. Spent keys are
    those of "keys" unless ``spent`` gives others. ``seeded`` may also be a state of its own: it is written first and read
    at the version that ``state`` has committed, so what a run that died has left there does not count.

    Everything up to the record can happen again after a crash, with the same batch id: ``sink`` is called at least once a
    batch and should overwrite by the id. ``act`` gets the groups of the batch's intents that have no outcome. It returns
    outcomes (OUTCOMES), as one table or one after the other; successes that were not only planned spend their keys. A group
    whose outcome is written is not acted on again and its key is not lost. What a run left open - intents without an
    outcome - goes to ``resolve`` first, which returns the outcomes it can find out; the rest is acted on again.
    """

    def acted(groups: Callable[[], DataFrame], batch_id: int) -> DataFrame:
        """The batch's ranked groups; those that act have been acted on."""
        intents = state.intents(batch_id)
        again = intents is not None
        if not again:
            intents = state.intend(groups(), batch_id)
        left = lambda: intents.where("acts").join(state.outcomes(batch_id), monitor.GROUP, "left_anti")
        if again and resolve is not None and left().limit(1).count():
            state.note(resolve(left(), batch_id), batch_id)
        if not again or left().limit(1).count():
            state.note(act(left(), batch_id), batch_id)
        return intents

    def run(batch: DataFrame, batch_id: int) -> None:
        if (state.version() or 0) >= batch_id + 1 or batch.limit(1).count() == 0:
            return
        mjd, old, bad = poll_mjd(batch), state.load(), failed(batch) if failed else None
        new = monitor.summarize(batch, mjd, order)
        if bad is not None:
            new = new.join(bad.select("program").distinct(), "program", "left_anti")
        new = staged(new, "poll")
        events = staged(monitor.diff_events(old, new), "events")
        sink(events, batch_id)
        after = monitor.next_state(old, new, mjd, bad)
        known = old.select("program")
        if "seeded" in state.schemas:
            known = known.unionByName(state.load("seeded"))
        if seeded is not None:
            known = known.unionByName(seeded.load(at_most=state.version() or 0).select("program"))
        known = known.distinct()
        replaced, appended = {}, {}
        if act is not None:
            mapped = events.join(known, "program", "left_semi")

            def groups() -> DataFrame:
                none = batch.sparkSession.createDataFrame([], "key string")
                keys = spent() if spent else spent_keys(state.load("keys")) if "keys" in state.schemas else (none, none)
                return monitor.capped(monitor.actionable(monitor.groups(with_field(mapped) if with_field else mapped), *keys), most)

            ranked = acted(groups, batch_id)
            later = mapped.join(ranked.where("not acts").select(*monitor.GROUP), monitor.GROUP, "left_semi")
            after = monitor.revert_deferred(after, old, later)
            if "keys" in state.schemas:
                done = state.outcomes(batch_id).where("ok and not planned").select("kind", "key").distinct()
                appended["keys"] = done.join(state.load("keys"), ["kind", "key"], "left_anti").withColumn("batch", F.lit(batch_id).cast("long"))
        programs = known.unionByName(new.select("program")).distinct()
        if "seeded" in state.schemas:
            replaced["seeded"] = programs
        if seeded is not None:
            seeded.commit(programs, batch_id + 1)
        state.commit(after, batch_id + 1, replaced, appended)

    return run


def watch(spark: SparkSession, folder: str, schema: StructType, run: Callable[[DataFrame, int], None], checkpoint: str, files_a_poll: int | None = 1):
    """Start the stream over a folder of snapshot files. A poll is so many files, or with None all that are new."""
    reader = spark.readStream.schema(schema)
    polls = (reader.option("maxFilesPerTrigger", files_a_poll) if files_a_poll else reader).parquet(folder)
    return polls.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


RECORDS = "program long, obs_id string, released boolean, calib_level int, poll long"
CHANGES = "program long, obs_id string, event string, poll long, missing_since long"


class EventsOf(StatefulProcessor):
    """Per-key form of diff_events and next_state for transformWithStateInPandas.

    A key is a program's shard. Its state maps obs_id to (released, calib_level, missing_since); a poll that names the program
    reaches every shard, so keys that it does not have are missed at once.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "obs_id string", "released boolean, calib_level int, missing_since long")

    @staticmethod
    def number(x) -> int | None:
        return None if pd.isna(x) else int(x)

    def handleInitialState(self, key, rows: pd.DataFrame, timer_values) -> None:
        for r in rows.itertuples():
            self.seen.updateValue((r.obs_id,), (bool(r.released), self.number(r.calib_level), self.number(r.missing_since)))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        out = []
        polls = pd.concat(list(rows)).sort_values("poll", kind="stable")
        for poll, records in polls.groupby("poll", sort=True):
            here = {r.obs_id: (bool(r.released), self.number(r.calib_level)) for r in records.itertuples() if r.obs_id is not None}
            for obs_id, (released, level) in here.items():
                if not self.seen.containsKey((obs_id,)):
                    out.append((key[0], obs_id, "NEW_OBSERVATION", poll, None))
                else:
                    was_released, was_level, missing = self.seen.getValue((obs_id,))
                    if released and not was_released:
                        out.append((key[0], obs_id, "NEWLY_RELEASED", poll, None))
                    if (level or 0) > (was_level or 0):
                        out.append((key[0], obs_id, "CALIB_LEVEL_UP", poll, None))
                    if missing is not None:
                        out.append((key[0], obs_id, "SEEN_AGAIN", poll, None))
                self.seen.updateValue((obs_id,), (released, level, None))
            for (obs_id,), (released, level, missing) in list(self.seen.iterator()):
                if obs_id not in here and missing is None:
                    out.append((key[0], obs_id, "MISSING", poll, poll))
                    self.seen.updateValue((obs_id,), (released, level, int(poll)))
        frame = pd.DataFrame(out, columns=["program", "obs_id", "event", "poll", "missing_since"])
        yield frame.astype({"missing_since": "Int64"})

    def close(self) -> None:
        pass


def sharded(records: DataFrame, shards: int) -> DataFrame:
    return records.withColumn("shard", F.pmod(F.xxhash64("obs_id"), F.lit(shards)).cast("int"))


def with_heartbeats(polls: DataFrame, shards: int) -> DataFrame:
    """Records with their shard, and for each poll of a program in a batch of rows one row without obs_id a shard."""
    names = [c.split()[0] for c in RECORDS.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            beats = rows[["program", "poll"]].drop_duplicates().merge(pd.DataFrame({"shard": range(shards)}), how="cross")
            beats["shard"] = beats["shard"].astype("int32")
            yield pd.concat([rows.astype({"calib_level": "Int32", "released": "object"}), beats.assign(obs_id=None, released=None, calib_level=pd.array([None] * len(beats), "Int32"))[rows.columns]])

    return sharded(polls.select(*names), shards).mapInPandas(run, RECORDS + ", shard int")


def event_stream(polls: DataFrame, initial: DataFrame | None = None, shards: int = 1) -> DataFrame:
    """Changes (CHANGES) of a stream of RECORDS: events of the diff, and MISSING with missing_since or SEEN_AGAIN.

    A poll of a program must come in one micro-batch. ``initial`` has the records (program, obs_id, released, calib_level,
    missing_since as a poll) to begin from when the checkpoint is new, so a stream can go on from a committed state.
    A program's keys are spread over ``shards`` tasks; programs that a poll does not name keep their state.
    """
    start = sharded(initial, shards).groupBy("program", "shard") if initial is not None else None
    return with_heartbeats(polls, shards).groupBy("program", "shard").transformWithStateInPandas(EventsOf(), CHANGES, "Append", "None", start)

"""The archive monitor: successive polls of archive rows become events, actions and a new state.

State rows are (program, obs_id, calib_level, t_obs_release, released, missing_since, ...). Every function takes and
returns DataFrames for all programs at once. An event's key is (program, obs_id), a group's (program, obsnum,
instrument). One-shot keys are rows (key, when) in a table that only grows.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import scalars as S
from . import select

KEY = ["program", "obs_id"]
GROUP = ["program", "obsnum", "instrument"]


def summarize(poll: DataFrame, poll_mjd: float | Column, order: Column | None = None) -> DataFrame:
    """One record for each key, the last row by ``order``; released means a release date not after the poll."""
    rel = F.col("t_obs_release")
    x = poll.withColumn("released", F.coalesce(S.finite(rel) & (rel <= poll_mjd), F.lit(False)))
    if order is None:
        return x
    row = F.max_by(F.struct(*x.columns), order)
    return x.groupBy(*KEY).agg(row.alias("_r")).select("_r.*")


def diff_events(old: DataFrame, new: DataFrame) -> DataFrame:
    """Events of the records in ``new``: NEW_OBSERVATION alone for a new key, else any of the two others.

    A null level counts as 0, -1 as -1. Records that were missing and are back are not new.
    """
    o = old.select(*KEY, F.col("released").alias("_released"), F.col("calib_level").alias("previous_calib_level"), F.lit(True).alias("_known"))
    x = new.join(o, KEY, "left")
    level = lambda c: F.coalesce(F.col(c), F.lit(0))
    newly = F.when(F.col("released") & ~F.coalesce("_released", F.lit(False)), "NEWLY_RELEASED")
    up = F.when(level("calib_level") > level("previous_calib_level"), "CALIB_LEVEL_UP")
    events = F.when(F.col("_known").isNull(), F.array(F.lit("NEW_OBSERVATION"))).otherwise(F.array_compact(F.array(newly, up)))
    x = x.withColumn("event", F.explode(events)).withColumn("obsnum", S.obsnum(F.col("obs_id"))).withColumn("instrument", S.instrument_class(F.col("instrument_name")))
    return x.withColumn("previous_calib_level", F.when(F.col("event") == "CALIB_LEVEL_UP", F.col("previous_calib_level"))).drop("_released", "_known")


def next_state(old: DataFrame, new: DataFrame, poll_mjd: float, failed: DataFrame | None = None) -> DataFrame:
    """State after a poll: fresh records, and those that disappeared with the first time they were missed.

    Programs in ``failed`` (a column program) keep their old records, whatever the poll has of them.
    """
    if failed is not None:
        kept = old.join(failed, "program", "left_semi")
        old, new = old.join(failed, "program", "left_anti"), new.join(failed, "program", "left_anti")
    fresh = new.withColumn("missing_since", F.lit(None).cast("double"))
    polled = new.select("program").distinct()
    gone = old.join(polled, "program", "left_semi").join(new, KEY, "left_anti").withColumn("missing_since", F.coalesce("missing_since", F.lit(poll_mjd)))
    other = old.join(polled, "program", "left_anti")
    columns = old.columns
    out = fresh.select(*columns).unionByName(gone.select(*columns)).unionByName(other.select(*columns))
    return out.unionByName(kept.select(*columns)) if failed is not None else out


def unseeded(events: DataFrame, seeded: DataFrame, state: DataFrame) -> DataFrame:
    """Events of programs without a baseline: they are committed, but no action follows."""
    known = seeded.select("program").unionByName(state.select("program")).distinct()
    return events.join(known, "program", "left_anti")


def with_field(events: DataFrame, mapping: DataFrame, wholesale: DataFrame, names: DataFrame) -> DataFrame:
    """Field of each event: the program's own wherever it maps as a whole, else by (program, obsnum); '' if unmapped.

    An instrument's own row of the mapping wins over the row without one. ``names`` adds the display name.
    """
    by_instrument = mapping.where("instrument is not null").select("program", "obsnum", "instrument", F.col("field").alias("_fi"))
    plain = mapping.where("instrument is null").select("program", "obsnum", F.col("field").alias("_fp"))
    whole = wholesale.select("program", F.col("field").alias("_fw"))
    x = events.join(whole, "program", "left").join(by_instrument, GROUP, "left").join(plain, ["program", "obsnum"], "left")
    x = x.withColumn("field", F.coalesce("_fw", "_fi", "_fp", F.lit(""))).drop("_fw", "_fi", "_fp")
    return x.join(names, "field", "left").withColumn("display", F.coalesce("display", "field"))


def groups(events: DataFrame) -> DataFrame:
    """Events by group; those without an observation number are left out. The field is that of the group's first event."""
    first = F.struct("obs_id", "event")
    return (
        events.where("obsnum <> ''")
        .withColumn("ready", select.event_ready())
        .withColumn("arrival", select.event_is_arrival())
        .groupBy(*GROUP)
        .agg(
            F.count(F.lit(1)).alias("n_events"),
            F.bool_or("ready").alias("ready"),
            F.bool_or("arrival").alias("arrival"),
            F.min(F.when(F.col("ready"), F.col("t_obs_release"))).alias("oldest"),
            F.min_by("field", first).alias("field"),
            F.array_sort(F.collect_set("obs_id")).alias("obs_ids"),
        )
    )


def actionable(grouped: DataFrame, downloaded: DataFrame, triggered: DataFrame, download: bool = True, trigger: bool = True, extra: bool = False) -> DataFrame:
    """Groups that this run would act on: mapped, ready, and with an action whose one-shot key is not spent.

    A download is keyed with 'NIRCam' where the instrument is blank; the trigger and the extra action need NIRCam
    itself, and the extra action is never retired.
    """
    x = grouped.where("field <> '' and ready")
    x = x.withColumns({"_dk": S.download_key(F.col("program"), F.col("obsnum"), F.col("instrument")), "_tk": S.trigger_key(F.col("program"), F.col("obsnum"))})
    x = x.join(downloaded.select(F.col("key").alias("_dk"), F.lit(True).alias("_d")).distinct(), "_dk", "left")
    x = x.join(triggered.select(F.col("key").alias("_tk"), F.lit(True).alias("_t")).distinct(), "_tk", "left")
    nircam = F.col("instrument") == "NIRCam"
    want = (F.lit(download) & F.col("_d").isNull()) | (F.lit(trigger) & nircam & F.col("_t").isNull()) | (F.lit(extra) & nircam)
    return x.where(want).drop("_dk", "_tk", "_d", "_t")


def capped(groups_: DataFrame, most: int = 4) -> DataFrame:
    """Groups in the order they are acted on, oldest ready release first, undated last; ``acts`` for the first ``most``.

    Groups are few (one row an observation and instrument), so one task ranks them.
    """
    w = W.orderBy(F.coalesce("oldest", F.lit(float("inf"))), *GROUP)
    return groups_.withColumn("rank", F.row_number().over(w)).withColumn("acts", F.col("rank") <= most)


def labels(ranked: DataFrame, most: int = 10) -> DataFrame:
    """One row: the labels of all groups in order, at most ``most`` and the number of the others."""
    label = F.concat(F.col("program").cast("string"), F.lit("-o"), "obsnum", F.lit("-"), F.when(F.col("instrument") == "", "?").otherwise(F.col("instrument")))
    x = ranked.agg(F.array_sort(F.collect_list(F.when(F.col("rank") <= most, F.struct("rank", label.alias("label"))))).alias("l"), F.count(F.lit(1)).alias("n"))
    shown = F.array_join(F.transform("l", lambda s: s["label"]), ", ")
    return x.select(F.when(F.col("n") > most, F.concat(shown, F.lit(", and "), (F.col("n") - most).cast("string"), F.lit(" more"))).otherwise(shown).alias("labels"))


def revert_deferred(state: DataFrame, old: DataFrame, deferred: DataFrame) -> DataFrame:
    """The new state with the deferred events' records as they were before the poll; a new one is taken out."""
    ids = deferred.select(*KEY).distinct()
    return state.join(ids, KEY, "left_anti").unionByName(old.join(ids, KEY, "left_semi").select(*state.columns))


def in_flight(groups_: DataFrame, jobs: DataFrame) -> DataFrame:
    """Groups without a running job whose name begins with '<field><program>-o<observation>-'.

    A job's name is cut after each of its dashes, so the prefix test is an equi join.
    """
    parts = F.split("name", "-")
    heads = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda n: F.array_join(F.slice(parts, 1, n), "-"))
    busy = jobs.where(F.col("name").contains("-")).select(F.explode(heads).alias("_job")).distinct()
    prefix = F.concat("field", F.col("program").cast("string"), F.lit("-o"), "obsnum")
    return groups_.join(busy, F.col("_job") == prefix, "left_anti")


def rearm(keys: DataFrame, key: str, downloads: bool = True) -> DataFrame:
    """One-shot keys without this one ('program-oNNN', joint observations too) and, with ``downloads``, its forms with an
    instrument. Another observation that begins with this one stays. Raises if the key is malformed or none matches."""
    if not re.fullmatch(rf"[0-9]+-o{S.OBS_TOKEN}", key or ""):
        raise ValueError(f"{key!r} is not <program>-o<obs>")
    hit = F.col("key") == key
    if downloads:
        hit = hit | F.col("key").rlike(rf"^{key}-[A-Za-z0-9]*[A-Za-z][A-Za-z0-9]*\z")
    if keys.where(hit).limit(1).count() == 0:
        raise KeyError(f"no spent key matches {key}")
    return keys.where(~hit)


def record_keys(keys: DataFrame, acted: DataFrame, batch: int) -> DataFrame:
    """Keys with those of successful actions added (columns key, ok, planned). Replaying a batch adds nothing."""
    new = acted.where("ok and not planned").select("key", F.lit(batch).cast("long").alias("batch"))
    return keys.unionByName(new.join(keys, "key", "left_anti").dropDuplicates(["key"]))


def routed(events: DataFrame, notice: Column | None, memo: str | None, rolling_field: str) -> DataFrame:
    """Where events report: a new comment for an arrival or a fresh downgrade of the run, else an edit of the last one.

    Each group (program, obsnum, instrument) has its own page; events of ``rolling_field`` share one. The run's ``notice``
    is a downgrade by how it begins, and fresh when its class is not the memorised one; it then notifies on every page.
    """
    rolling = F.coalesce(F.col("field") == rolling_field, F.lit(False))
    instrument = F.coalesce(F.nullif("instrument", F.lit("")), F.lit("NIRCam"))
    own = F.concat(F.col("program").cast("string"), F.lit("-o"), "obsnum", F.lit(" ("), instrument, F.lit(")"))
    x = events.where(rolling | (F.col("obsnum") != "")).withColumn("target", F.when(rolling, F.lit("rolling")).otherwise(own))
    reason = S.downgrade_class(F.lit(None).cast("string") if notice is None else notice)
    fresh = F.coalesce(reason != F.lit(memo or ""), F.lit(False))
    x = x.withColumn("_new", select.event_is_arrival() | fresh)
    return x.groupBy("target").agg(F.when(F.bool_or("_new"), "comment").otherwise("edit").alias("route"), F.count_distinct(*GROUP).alias("n_groups"))


def memo_after(runs: DataFrame, posts: DataFrame, run: str = "run") -> DataFrame:
    """The memo after each run: (run, notice, memo) as it was, and posts (run, notifies, ok).

    A downgrade is memorised once every notifying post succeeded and there was one; a run without a downgrade forgets it;
    else the memo stays as it was.
    """
    p = posts.where("notifies").groupBy(run).agg(F.every(F.coalesce("ok", F.lit(False))).alias("_ok"))
    reason = S.downgrade_class(F.col("notice"))
    x = runs.join(p, run, "left")
    return x.select(run, F.when(reason.isNull(), F.lit(None).cast("string")).when(F.coalesce("_ok", F.lit(False)), reason).otherwise(F.col("memo")).alias("memo"))


def download_size(products: DataFrame, keys: Sequence[str], suffixes: Sequence[str]) -> DataFrame:
    """Bytes that a download would take; unknown (null) if a product's size is."""
    x = select.product_names(products, "name", suffixes, [])
    return x.groupBy(*keys).agg(F.when(F.count("size") == F.count(F.lit(1)), F.sum("size")).alias("bytes"), F.count(F.lit(1)).alias("n_products"))


def admitted(sizes: DataFrame, headroom: float, unit: float = 1e12, force: bool = False) -> DataFrame:
    size = F.col("bytes") / unit
    why = F.when(F.col("bytes").isNull(), F.lit(None if force else "unknown size")).when(size > headroom, "over headroom")
    return sizes.withColumn("skip", why).withColumn("admitted", F.col("skip").isNull())


def pointings(state: DataFrame) -> DataFrame:
    """First usable row of each observation by obs_id: (program, obsnum, tile, ra_deg, dec_deg, calib, released)."""
    x = state.withColumn("obsnum", S.obsnum(F.col("obs_id"))).where("obsnum <> ''")
    x = x.where(S.finite(F.col("s_ra")) & S.finite(F.col("s_dec")))
    x = x.withColumn("_r", F.row_number().over(W.partitionBy("program", "obsnum").orderBy("obs_id"))).where("_r = 1")
    deg = lambda c: F.format_string("%.7f", F.col(c))
    return x.select("program", "obsnum", F.col("target_name").alias("tile"), deg("s_ra").alias("ra_deg"), deg("s_dec").alias("dec_deg"), F.coalesce("calib_level", F.lit(-1)).alias("calib"), F.coalesce("released", F.lit(False)).alias("released"))


def registry(state: DataFrame, fields: DataFrame | None = None) -> DataFrame:
    """Observations with calibrated data: sorted distinct filters and the date of the earliest end of exposure (t_max) of
    (program, obsnum, instrument); a blank instrument is NIRCam."""
    named = F.coalesce(F.nullif(S.instrument_class(F.col("instrument_name")), F.lit("")), F.lit("NIRCam"))
    x = state.withColumns({"obsnum": S.obsnum(F.col("obs_id")), "instrument": named})
    x = x.where((F.col("obsnum") != "") & (F.coalesce("calib_level", F.lit(-1)) >= 2))
    if fields is not None:
        x = x.join(fields, ["program", "obsnum"], "left_semi")
    f = F.array_sort(F.array_distinct(F.flatten(F.collect_set(S.parse_filters(F.col("filters"))))))
    return x.groupBy(*GROUP).agg(f.alias("filters"), F.to_date(F.timestamp_seconds((F.min(S.none_if_nan(F.col("t_max"))) - 40587) * 86400)).alias("first_date"))


def coverage_gap(observed: DataFrame, registered: DataFrame) -> DataFrame:
    """Observations that no registry row covers; a row without an observation covers its whole program."""
    exact = observed.join(registered.where("obsnum is not null"), ["program", "obsnum"], "left_anti")
    return exact.join(registered.where("obsnum is null").select("program"), "program", "left_anti")


def poll_digest(state: DataFrame, last_poll: Column | None = None) -> DataFrame:
    """Programs, observations, missing ones and, where given, the time of the last poll as text."""
    when = [] if last_poll is None else [S.mjd_to_text(F.max(last_poll)).alias("last_poll")]
    return state.agg(F.count_distinct("program").alias("programs"), F.count_distinct(*KEY).alias("observations"), F.count_if(F.col("missing_since").isNotNull()).alias("missing"), *when)


def token_union(df: DataFrame, keys: Sequence[str], tokens: str, order: str) -> DataFrame:
    """Distinct tokens of a group, in the order in which rows first bring them; only a token's first place is gathered."""
    one = df.select(*keys, order, F.posexplode_outer(tokens).alias("_i", "_t"))
    first = one.groupBy(*keys, "_t").agg(F.min(F.struct(order, "_i")).alias("_at"))
    rows = F.array_sort(F.collect_list(F.when(F.col("_t").isNotNull(), F.struct("_at", "_t"))))
    return first.groupBy(*keys).agg(F.transform(rows, lambda r: r["_t"]).alias(tokens))

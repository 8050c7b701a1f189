"""Release gates, plans and checklists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def stem(path: Column) -> Column:
    return F.regexp_replace(path, r"\.[^./]*$", "")


def ancestors(path: Column) -> Column:
    """Folders above a path, the nearest first."""
    parts = F.split(path, "/")
    n = F.size(parts) - 1
    return F.when(n > 0, F.transform(F.sequence(n, F.lit(1), F.lit(-1)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))).otherwise(F.array().cast("array<string>"))


SIDECAR = r"\.(validation\.)?json$"


def covering_verdicts(images: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Every verdict that covers an image: its sibling's, and those of all tile trees above it; a null ``v`` without any.

    images: path, sha. verdicts: path (the sibling's file, or the root folder of a tile tree), tree (boolean), pass, state
    (of the star check), png_sha and jpg_sha (hashes that the verdict was made for) and, for a tree, source_sha (hash of
    its source image as it is now, null if that is gone). All columns of images stay.
    """
    v = F.struct("path", "tree", "pass", "state", "png_sha", "jpg_sha", "source_sha").alias("v")
    plain = ~F.coalesce("tree", F.lit(False))
    own = verdicts.where(plain).select(F.regexp_replace("path", SIDECAR, "").alias("_s"), v)
    trees = verdicts.where(~plain).select(F.col("path").alias("_dir"), v)
    sibling = images.select("path", stem(F.col("path")).alias("_s")).join(own, "_s").select("path", "v")
    above = images.select("path", F.explode(ancestors(F.col("path"))).alias("_dir")).join(trees, "_dir").select("path", "v")
    return images.join(sibling.unionByName(above), "path", "left")


def verdict_problem(no_star_check: Column, accept_unbound_tree: Column) -> Column:
    """Why a covering verdict ``v`` does not let its image (path, sha) out; null if it does.

    What is not known to be good is a problem: a verdict passes only if it says so, its star check passes or was left out
    and that is acknowledged, and it is bound to the bytes. A failed verdict or star check has no way around it.
    """
    yes = lambda c: F.coalesce(c, F.lit(False))
    state = F.coalesce("v.state", F.lit("absent"))
    expected = F.when(F.lower("path").endswith(".png"), F.col("v.png_sha")).otherwise(F.col("v.jpg_sha"))
    tree, bound = yes(F.col("v.tree")), F.col("v.png_sha").isNotNull() & F.col("v.source_sha").isNotNull()
    return (
        F.when(F.col("v").isNull(), "no verdict")
        .when(~yes(F.col("v.pass")), "validation failed")
        .when(~state.isin("pass", "skipped", "absent"), "star check failed")
        .when((state != "pass") & ~yes(no_star_check), F.concat(F.lit("star check "), state))
        .when(~tree & expected.isNull(), "verdict without hash")
        .when(~tree & ~yes(expected == F.col("sha")), "verdict of other bytes")
        .when(tree & bound & (F.col("v.png_sha") != F.col("v.source_sha")), "tree verdict of other bytes")
        .when(tree & ~bound & ~yes(accept_unbound_tree), "tree verdict unbound")
    )


def release_gate(covered: DataFrame, keys: Sequence[str], no_star_check: Column, accept_unbound_tree: Column | None = None, expected: DataFrame | None = None) -> DataFrame:
    """Whether all images of a group may go out. Fail-closed: an image goes if one of its covering verdicts has no problem.

    covered: see covering_verdicts. With ``expected`` (a table of keys), groups without images are there too, and refused.
    Returns keys, ok, reasons (of the images that are refused), n (images).
    """
    g = list(keys)
    x = covered.withColumn("_p", verdict_problem(no_star_check, F.lit(False) if accept_unbound_tree is None else accept_unbound_tree))
    image = x.groupBy(*g, "path").agg(F.bool_or(F.col("_p").isNull()).alias("_ok"), F.collect_set("_p").alias("_why"))
    out = image.groupBy(*g).agg(F.bool_and("_ok").alias("ok"), F.array_distinct(F.flatten(F.collect_set(F.when(~F.col("_ok"), F.col("_why"))))).alias("_why"), F.count(F.lit(1)).alias("n"))
    if expected is not None:
        out = expected.select(*g).distinct().join(out, g, "left")
    why = F.when(F.col("n").isNull(), F.array(F.lit("no images"))).otherwise(F.array_sort("_why"))
    return out.select(*g, F.coalesce("ok", F.lit(False)).alias("ok"), F.array_join(why, "; ").alias("reasons"), F.coalesce("n", F.lit(0)).alias("n"))


def uncovered(files: DataFrame, trees: DataFrame, images: Sequence[str], sidecars: Sequence[str]) -> DataFrame:
    """Manifest files that no gate looks at: not an image, not a sidecar, not in a tile tree."""
    ends = F.lit(False)
    for s in (*images, *sidecars):
        ends = ends | F.lower(F.col("path")).endswith(s)
    up = files.select("path", F.explode(ancestors(F.col("path"))).alias("_dir")).join(trees.select(F.col("path").alias("_dir")), "_dir").select("path").distinct()
    return files.where(~ends).join(up, "path", "left_anti")


def tile_plan(spec: DataFrame, registered: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Class of each planned (field, band): present on disk, new, or missing its input."""
    k = list(keys)
    x = spec.join(registered.select(*k, F.lit(True).alias("_r")).distinct(), k, "left").join(present.select(*k, F.lit(True).alias("_p")).distinct(), k, "left")
    return x.select(*k, F.when(F.col("_r").isNotNull(), "present").when(F.col("_p").isNotNull(), "new").otherwise("missing").alias("plan"))


def sticky_union(old: DataFrame, new: DataFrame, alias: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Checklists (item, checked) joined: checked in either stays checked; renamed items count as their new names."""
    def renamed(d: DataFrame) -> DataFrame:
        return d.join(alias.select(F.col("old").alias("item"), F.col("new").alias("_n")), "item", "left").withColumn("item", F.coalesce("_n", "item")).groupBy(*keys, "item").agg(F.bool_or("checked").alias("checked"))

    o, n = renamed(old), renamed(new)
    x = o.withColumnRenamed("checked", "_o").join(n.withColumnRenamed("checked", "_c"), [*keys, "item"], "full_outer")
    return x.select(*keys, "item", (F.coalesce("_o", F.lit(False)) | F.coalesce("_c", F.lit(False))).alias("checked"))


def checklist(metrics: DataFrame, rules: dict[str, str], metrics_used: Sequence[str]) -> DataFrame:
    """Booleans of an observation from metrics (obsid, stage, metric, value as text).

    rules are expressions over columns stage_metric, of which ``metrics_used`` names those that there are.
    """
    wide = metrics.withColumn("_m", F.concat_ws("_", "stage", "metric")).groupBy("obsid").pivot("_m", list(metrics_used)).agg(F.first("value"))
    return wide.select("obsid", *[F.coalesce(F.expr(e), F.lit(False)).alias(c) for c, e in rules.items()])


def staged_release(versions: DataFrame, acknowledged: DataFrame, key: str) -> DataFrame:
    """The newest version passes the gate if it has its marker or is acknowledged."""
    last = versions.groupBy(key).agg(F.max_by(F.struct("version", "marker"), "version").alias("_v")).select(key, "_v.version", "_v.marker")
    a = acknowledged.select(key, "version", F.lit(True).alias("_a")).distinct()
    return last.join(a, [key, "version"], "left").select(key, "version", (F.col("marker") | F.coalesce("_a", F.lit(False))).alias("ok"))


def catalogue_staleness(catalogues: DataFrame, tables: DataFrame, keys: Sequence[str], slack: float = 1.0) -> DataFrame:
    """Catalogues older than the operative alignment table less a day; locked tables come before consensus ones."""
    k = list(keys)
    c = catalogues.groupBy(*k).agg(F.max("mtime").alias("catalogue"))
    newest = tables.groupBy(*k, "kind").agg(F.max("mtime").alias("mtime"))
    t = newest.groupBy(*k).agg(F.min_by(F.struct("kind", "mtime"), F.struct(F.col("kind") != "locked", "kind")).alias("_t")).select(*k, "_t.kind", F.col("_t.mtime").alias("table_time"))
    return c.join(t, k, "left").withColumn("stale", F.coalesce(F.col("catalogue") < F.col("table_time") - slack, F.lit(False)))


def progress(inventory: DataFrame, keys: Sequence[str], alignment: DataFrame, stages: Sequence[str], slack: float = 1.0) -> DataFrame:
    """Pipeline stages of an observation in their order: files, newest file, frames re-aligned since the alignment table,
    and a status: 'none', 'stale' (newest file older than an earlier stage's by more than ``slack``) or 'done'.

    Every stage of every observation has a row. ``offset`` is the alignment table's, with its own row in the caller's join.
    """
    k = list(keys)
    x = inventory.join(alignment.select(*k, "table_time"), k, "left")
    n = x.groupBy(*k, "stage").agg(F.count(F.lit(1)).alias("n"), F.max("mtime").alias("newest"), F.count_if(F.col("mtime") >= F.col("table_time")).alias("n_realigned"))
    rows = inventory.select(*k).distinct().withColumn("_s", F.explode(F.array(*[F.struct(F.lit(i).alias("position"), F.lit(s).alias("stage")) for i, s in enumerate(stages)])))
    x = rows.select(*k, "_s.position", "_s.stage").join(n, [*k, "stage"], "left").fillna(0, ["n", "n_realigned"])
    earlier = F.max("newest").over(W.partitionBy(*k).orderBy("position").rowsBetween(W.unboundedPreceding, -1))
    status = F.when(F.col("n") == 0, "none").when(F.coalesce(F.col("newest") < earlier - slack, F.lit(False)), "stale").otherwise("done")
    return x.select(*k, "position", "stage", "n", "newest", "n_realigned", status.alias("status"))


def metrics_upsert(old: DataFrame, new: DataFrame) -> DataFrame:
    """Metrics (obsid, stage, metric, value) with those of new (obsid, stage) in place of the old ones."""
    return old.join(new.select("obsid", "stage").distinct(), ["obsid", "stage"], "left_anti").unionByName(new)


def provenance_digest(inputs: DataFrame, keys: Sequence[str], most: int = 12) -> DataFrame:
    """Inputs by role and folder: up to ``most`` names in order, else the first three, the last and the count.

    Names are ranked rather than gathered, so a folder of any size costs its sort and a dozen names.
    """
    g = [*keys, "role", "folder"]
    folder, name = F.regexp_replace("path", r"/[^/]*$", ""), F.regexp_extract("path", r"([^/]*)$", 1)
    x = inputs.select(*keys, "role", folder.alias("folder"), name.alias("name")).distinct()
    x = x.withColumn("_r", F.row_number().over(W.partitionBy(*g).orderBy("name")))
    x = x.groupBy(*g).agg(F.count(F.lit(1)).alias("n"), F.max("name").alias("_last"), F.array_sort(F.collect_list(F.when(F.col("_r") <= most, F.col("name")))).alias("l"))
    n = F.col("n")
    short = F.concat(F.array_join(F.slice("l", 1, 3), ", "), F.lit(" ... "), F.col("_last"), F.lit(" ("), n.cast("string"), F.lit(")"))
    return x.select(*g, n, F.when(n > most, short).otherwise(F.array_join("l", ", ")).alias("names"))

"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Only DataFrame and SQL functions. The mix is planned in words:

1. every source gets a target: its weight's share of all words, at most ``max_repeat`` times its own
   words; what the capped sources leave is shared among the others by weight;
2. the mix has round(words / block_words) blocks of equal size. Each goes to the source with the
   highest quotient target / (2k + 1), k being the blocks it has (Sainte-Laguë);
3. a source is split into shards of about ``shard_words`` words by a seeded digest of doc_id, so that no
   source, however large, is handled in one task; the source's blocks go to its shards the same way, by words, and
   where it has more than ``region_shards`` shards first to regions of so many and then to the shards of each;
4. in a shard the documents stand on a line in seeded order. The shard's quota is taken from that line
   as whole passes over it and then one run of consecutive blocks that starts at a seeded block and wraps
   around. So the shard's words are met exactly and only the documents at the run's ends are cut.

Quotients are never listed for all blocks: a source's seats lie within a few of its share, so only the
quotients near the cut are ranked (a few rows for each source or shard).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, fresh, stage, text_or_empty


def sized(docs: DataFrame, seed: int) -> DataFrame:
    """(doc_id, source, text_hash, size, place): place is a seeded digest that orders documents."""
    return docs.select(
        F.col("doc_id"),
        F.col("source"),
        F.xxhash64(text_or_empty()).alias("text_hash"),
        F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null:"), F.md5(text_or_empty()))))).alias("place"),
    )


def hex_number(digest: Column) -> Column:
    """The first 8 hexadecimal digits as a number."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], max_repeat: int) -> DataFrame:
    """(source, source_size, target): one row a source, ordered by code point with null last."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = W.orderBy(F.col("source").asc_nulls_last())
    total = W.partitionBy()
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("rank", F.row_number().over(everything)).withColumn("weight", weight)
    per = per.withColumn("cap", (F.col("source_size") * max_repeat).cast("double")).withColumn("words", F.sum("source_size").over(total).cast("double"))
    # By cap / weight, a source is capped if, those before it being capped, its share is over its cap.
    rising = W.orderBy(F.col("cap") / F.col("weight"), F.col("rank"))
    before = F.coalesce(F.sum("cap").over(rising.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(rising.rowsBetween(0, W.unboundedFollowing))
    per = per.withColumn("capped", F.col("cap") * rest < F.col("weight") * (F.col("words") - before))
    spent = F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(total), F.lit(0.0))
    open_weight = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(total)
    share = F.col("weight") * (F.col("words") - spent) / open_weight
    return per.select("source", "rank", "source_size", F.when(F.col("capped"), F.col("cap")).otherwise(F.coalesce(share, F.col("cap"))).alias("target"))


def apportion(votes: DataFrame, group: list[str], key: str, vote: str, seats: Column) -> DataFrame:
    """Add ``seats``: Sainte-Laguë seats for each row of a group, ``seats`` being the group's total.

    With n rows, V votes and N seats the last seat's divisor lies between V/(N + n/2) and V/(N - n/2),
    which bounds each row's seats from below and above; only quotients between are ranked. Equal
    quotients go by ``key``. Rows without votes get none.
    """
    g = W.partitionBy(*group)
    v = F.col(vote).cast("double")
    x = votes.withColumn("_total", seats.cast("long")).withColumn("_n", F.count(F.when(v > 0, 1)).over(g)).withColumn("_v", F.sum(v).over(g))
    lower = F.when(v > 0, F.greatest(F.lit(0), F.floor(v * (F.col("_total") - F.col("_n") / 2) / F.col("_v") + 0.5) - 2)).otherwise(0).cast("long")
    upper = F.when(v > 0, F.floor(v * (F.col("_total") + F.col("_n") / 2) / F.col("_v") + 0.5) + 2).otherwise(0).cast("long")
    x = x.withColumn("_low", lower).withColumn("_up", upper)
    x = x.withColumn("_left", F.col("_total") - F.sum("_low").over(g))
    quotient = x.where("_up > _low").select(*group, key, "_left", v.alias("_w"), F.explode(F.sequence("_low", F.col("_up") - 1)).alias("_k"))
    best = W.partitionBy(*group).orderBy((F.col("_w") / (2 * F.col("_k") + 1)).desc(), F.col(key))
    won = quotient.withColumn("_r", F.row_number().over(best)).where("_r <= _left").groupBy(*group, key).agg(F.count(F.lit(1)).alias("_won"))
    out = x.join(won, [*group, key], "left").withColumn("seats", F.col("_low") + F.coalesce(F.col("_won"), F.lit(0)))
    return out.drop("_total", "_n", "_v", "_low", "_up", "_left", "_won")


def overlap(a: Column, b: Column, c: Column, d: Column) -> Column:
    return F.greatest(F.lit(0), F.least(b, d) - F.greatest(a, c))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    max_repeat: int = 3,
    seed: int = 17,
    block_words: int = 32,
    shard_words: int = 200_000,
    region_shards: int = 4_096,
) -> DataFrame:
    """Plan the mix: one row for each row of docs.

    Returns doc_id, source, text_hash (xxhash64 of the text), size, source_size, target, taken, copies.
    ``taken`` counts the words the mix takes of this row, repeats included, 0 to max_repeat * size;
    ``copies`` is taken / size rounded half up, for users who place whole documents only.

    A null or empty text has size 0 and is taken 0 times; a null source is a source of its own, last in
    order; a null doc_id is a document like any other, and its text decides its place. Documents with equal places stand
    on the line by doc_id, size and text, rows that repeat another row one after the other. A very long text may be cut
    by the run's ends like any other. An empty table gives an empty result. Extra columns of docs are not read, whatever
    their names.
    """
    sizes = stage(sized(docs, seed), "sizes")
    sources = stage(source_targets(sizes, weights, max_repeat).withColumn("g", F.lit(0)), "sources")
    blocks = F.round(F.sum("source_size").over(W.partitionBy("g")) / block_words)
    sources = apportion(sources, ["g"], "rank", "target", blocks).select(
        "source", "rank", "source_size", "target", F.col("seats").alias("source_seats"), F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).alias("shards")
    )
    sources = stage(sources, "quotas")
    s = sources.withColumnRenamed("source", "_source")
    placed = sizes.join(s, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    placed = placed.withColumn("shard", F.pmod(hex_number(F.col("place")), F.col("shards")))
    shards = placed.groupBy("rank", "shard").agg(F.sum("size").alias("shard_size"), F.first("source_seats").alias("source_seats"), F.first("source").alias("source"), F.first("shards").alias("shards"))
    # No window ranks more than region_shards rows, or one row for each region of a source.
    count = F.ceil(F.col("shards") / region_shards)
    shards = stage(shards.withColumn("region", F.pmod(F.col("shard"), count)), "shards")
    regions = shards.groupBy("rank", "region").agg(F.sum("shard_size").alias("region_size"), F.first("source_seats").alias("source_seats"))
    regions = apportion(regions, ["rank"], "region", "region_size", F.col("source_seats")).select("rank", "region", F.col("seats").alias("region_seats"))
    shards = apportion(shards.join(regions, ["rank", "region"]), ["rank", "region"], "shard", "shard_size", F.col("region_seats"))
    wanted = F.least(F.col("seats") * block_words, F.col("shard_size") * max_repeat)
    start = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("null")), F.lit(":"), F.col("shard").cast("string")))
    shards = shards.withColumn("wanted", wanted).select(
        "rank",
        "shard",
        "shard_size",
        F.when(F.col("shard_size") > 0, F.floor(F.col("wanted") / F.col("shard_size"))).otherwise(0).cast("long").alias("passes"),
        F.when(F.col("shard_size") > 0, F.expr("wanted % shard_size")).otherwise(0).cast("long").alias("run"),
        (F.pmod(hex_number(start), F.greatest(F.lit(1), F.ceil(F.col("shard_size") / block_words))) * block_words).cast("long").alias("first"),
    )
    line = W.partitionBy("rank", "shard").orderBy("place", "doc_id", "size", "text_hash").rowsBetween(W.unboundedPreceding, -1)
    placed = placed.withColumn("at", F.coalesce(F.sum("size").over(line), F.lit(0))).join(shards, ["rank", "shard"])
    at, to, first, last, all_ = F.col("at"), F.col("at") + F.col("size"), F.col("first"), F.col("first") + F.col("run"), F.col("shard_size")
    taken = F.col("passes") * F.col("size") + overlap(at, to, first, last) + overlap(at, to, first - all_, last - all_)
    placed = placed.withColumn("taken", taken.cast("long"))
    copies = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(0).cast("int")
    return placed.select("doc_id", "source", "text_hash", "size", "source_size", "target", "taken", copies.alias("copies"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: docs' rows, each as often as ``copies`` says, with docs' columns.

    Rows with equal doc_id, source and text share the larger of their quotas. Nulls, ties and empty texts: see mix.
    Internal columns have names of their own, so docs may have any.
    """
    doc, source, hashed, copies = (fresh(n) for n in ("doc", "source", "hash", "copies"))
    plan = mix(docs, **options).groupBy("doc_id", "source", "text_hash").agg(F.max("copies").alias(copies)).where(F.col(copies) > 0)
    plan = plan.select(F.col("doc_id").alias(doc), F.col("source").alias(source), F.col("text_hash").alias(hashed), copies)
    same = F.col("doc_id").eqNullSafe(F.col(doc)) & F.col("source").eqNullSafe(F.col(source)) & (F.xxhash64(text_or_empty()) == F.col(hashed))
    out = docs.join(plan, same).withColumn(fresh("copy"), F.explode(F.sequence(F.lit(1), F.col(copies))))
    return out.select(*docs.columns)


ORACLE = r"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('17:' || coalesce(doc_id::VARCHAR, 'null:' || md5(coalesce(text, '')))) AS place
  FROM documents
), per AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank
  FROM sizes GROUP BY source
), weighed AS (
  SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
         (3 * source_size)::DOUBLE AS cap, (sum(source_size) OVER ())::DOUBLE AS words
  FROM per
), flagged AS (
  SELECT *, cap * sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
            < weight * (words - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS capped
  FROM weighed
), targets AS (
  SELECT source, rank, source_size,
         CASE WHEN capped THEN cap ELSE coalesce(weight * (words - coalesce(sum(CASE WHEN capped THEN cap END) OVER (), 0))
              / sum(CASE WHEN NOT capped THEN weight END) OVER (), cap) END AS target
  FROM flagged
), seats AS (
  SELECT rank, count(*) AS seats FROM (
    SELECT rank, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, rank) AS r
    FROM targets, (SELECT unnest(range(0, (SELECT (sum(source_size) / 32)::BIGINT + 1 FROM targets))) AS k) WHERE target > 0
  ) WHERE r <= (SELECT round(sum(source_size) / 32.0) FROM targets) GROUP BY rank
), placed AS (
  SELECT s.*, t.rank, t.source_size, t.target, coalesce(q.seats, 0) AS source_seats,
         ('0x' || place[1:8])::BIGINT % greatest(1, ceil(source_size / 200000.0)::BIGINT) AS shard
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source LEFT JOIN seats q USING (rank)
), shards AS (
  SELECT rank, shard, any_value(source) AS source, sum(size)::BIGINT AS shard_size, any_value(source_seats) AS source_seats
  FROM placed GROUP BY rank, shard
), shard_seats AS (
  SELECT rank, shard, count(*) AS seats FROM (
    SELECT rank, shard, source_seats, row_number() OVER (PARTITION BY rank ORDER BY shard_size::DOUBLE / (2 * k + 1) DESC, shard) AS r
    FROM shards, unnest(range(0, source_seats)) AS u(k) WHERE shard_size > 0
  ) WHERE r <= source_seats GROUP BY rank, shard
), quotas AS (
  SELECT rank, shard, shard_size, least(coalesce(seats, 0) * 32, 3 * shard_size) AS wanted,
         ('0x' || (md5('17:' || coalesce('s' || source, 'null') || ':' || shard::VARCHAR))[1:8])::BIGINT % greatest(1, ceil(shard_size / 32.0)::BIGINT) * 32 AS first
  FROM shards LEFT JOIN shard_seats USING (rank, shard)
), line AS (
  SELECT p.*, q.shard_size, q.first, CASE WHEN q.shard_size > 0 THEN wanted // q.shard_size ELSE 0 END AS passes,
         CASE WHEN q.shard_size > 0 THEN wanted % q.shard_size ELSE 0 END AS run,
         coalesce(sum(size) OVER (PARTITION BY p.rank, p.shard ORDER BY place, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS here
  FROM placed p JOIN quotas q ON p.rank = q.rank AND p.shard = q.shard
)
SELECT doc_id, size, source_size, target,
       (passes * size + greatest(0, least(here + size, first + run) - greatest(here, first))
        + greatest(0, least(here + size, first + run - shard_size) - greatest(here, first - shard_size)))::BIGINT AS taken
FROM line
"""

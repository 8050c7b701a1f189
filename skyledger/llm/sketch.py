"""Document fingerprints: threshold-scaled sketches of word shingles, by DataFrame functions only.

A sketch keeps every shingle hash below a fixed fraction of the hash range, so sketches of texts of very unequal
length are comparable: the sketch of a union of shingle sets is the union of their sketches, and the share of one
sketch that another holds estimates containment without bias. A text of few shingles may have an empty sketch; two
empty sketches tell nothing of each other, so likeness and containment are then null, and ``fingerprint_documents``
goes by whether the texts are equal.

A document's neighbour in doc_id order is found without a global sort of texts: ids alone are dealt out by range,
each range is walked by a window, and the ends of ranges, one row each, are joined up. Texts are shuffled once, by
doc_id; of a neighbour's text only the head that is needed travels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import SPACE, stage, text_or_empty

#: Words in a shingle, and one hash in how many is kept.
SHINGLE, SCALE = 5, 6


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def sketch(text: Column, shingle: int = SHINGLE, scale: int = SCALE) -> Column:
    """Sorted distinct hashes that are kept of the text's shingles.

    Fewer words than a shingle has make one shingle of all of them; no words make an empty sketch.
    """
    # Hashing an array chains over its elements, so shingles are never put together as strings.
    hashes = F.transform(words_of(text), lambda w: F.xxhash64(w))
    return _kept(hashes, shingle, scale)


def _kept(hashes: Column, shingle: int, scale: int) -> Column:
    def rolled(h: Column) -> Column:
        many = F.transform(F.sequence(F.lit(1), F.greatest(F.size(h) - (shingle - 1), F.lit(1))), lambda i: F.xxhash64(F.slice(h, i, shingle)))
        return F.when(F.size(h) > 0, many).otherwise(F.array().cast("array<long>"))

    # Hashes are signed: those below the fraction are the lowest 1/scale of the signed range.
    limit = -(1 << 63) + (1 << 64) // scale
    return F.array_sort(F.array_distinct(F.filter(_let(hashes, rolled), lambda x: x < F.lit(limit))))


def _let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def likeness(a: Column, b: Column) -> Column:
    """Estimated resemblance of two texts, 0 to 1: shared hashes among all. Null for two empty sketches."""
    both = F.size(F.array_union(a, b))
    return F.when(both > 0, F.size(F.array_intersect(a, b)) / both).cast("double")


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's text that b's text holds. Null where a's sketch is empty."""
    return F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.size(a)).cast("double")


def as_text(s: Column) -> Column:
    """16 hexadecimal digits a hash."""
    return F.array_join(F.transform(s, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


#: Rows without a doc_id, which all have one neighbour, are dealt to so many keys.
NULL_KEYS = 256


def _key(doc_id: str, salt: Column) -> list[Column]:
    """doc_id as two columns without nulls, so that joins and groups on it share one shuffle. Where it is null the key is
    ``salt``: an array stands for all of its keys, one row each."""
    return [F.coalesce(F.col(doc_id).cast("long"), salt.cast("long")).alias("_k"), F.col(doc_id).isNull().alias("_none")]


def _all_keys(df: DataFrame, doc_id: str) -> DataFrame:
    """df with a row for each key that rows with this doc_id may have."""
    salts = F.when(F.col(doc_id).isNull(), F.sequence(F.lit(0), F.lit(NULL_KEYS - 1))).otherwise(F.array(F.lit(0)))
    return df.withColumn("_salt", F.explode(salts)).withColumns(dict(zip(("_k", "_none"), _key(doc_id, F.col("_salt"))))).drop("_salt")


def neighbours(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, next_id, before_id, before_chars) in ascending doc_id order, around the end.

    One row for each distinct doc_id; a null doc_id comes first. n_chars is that of the longest text of the id.
    """
    ids = docs.groupBy("doc_id").agg(F.max(F.char_length(text_or_empty())).alias("n_chars"))
    ranges = stage(ids.repartitionByRange(F.col("doc_id").asc_nulls_first()).withColumn("part", F.spark_partition_id()), "ids")
    order = W.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_first())
    own = ranges.select(
        "*",
        F.row_number().over(order).alias("at"),
        F.lead(F.struct("doc_id")).over(order).alias("next"),
        F.lag(F.struct("doc_id", "n_chars")).over(order).alias("before"),
    )
    # One row for each range; so few that one task joins them up.
    key = F.struct("doc_id", "n_chars")
    ends = ranges.groupBy("part").agg(F.min_by(key, F.struct(F.col("doc_id").isNotNull(), "doc_id")).alias("low"), F.max_by(key, F.struct(F.col("doc_id").isNotNull(), "doc_id")).alias("high"))
    round_ = W.orderBy("part")
    all_ = round_.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    ends = ends.select(
        "part",
        F.coalesce(F.lead("low").over(round_), F.first("low").over(all_)).alias("low_after"),
        F.coalesce(F.lag("high").over(round_), F.last("high").over(all_)).alias("high_before"),
    )
    joined = own.join(ends, "part")
    first = F.col("at") == 1
    return joined.select(
        "doc_id",
        "n_chars",
        F.when(F.col("next").isNotNull(), F.col("next.doc_id")).otherwise(F.col("low_after.doc_id")).alias("next_id"),
        F.when(first, F.col("high_before.doc_id")).otherwise(F.col("before.doc_id")).alias("before_id"),
        F.when(first, F.col("high_before.n_chars")).otherwise(F.col("before.n_chars")).alias("before_chars"),
    )


def fingerprint_documents(docs: DataFrame, shingle: int = SHINGLE, scale: int = SCALE) -> DataFrame:
    """Sketches of each row's text, of its edited text, and of the next document's text.

    The edited text has the last floor(n_chars / 4) code points replaced by the first as many (or all) of the
    next document in ascending doc_id order (after the last: the first). Returns doc_id, text, edited, sketch,
    edited_sketch, next_sketch, near_edited, near_next. The last two are the likeness of sketches; two empty sketches
    are equal ones, so their likeness is 1.

    A null text counts as empty and its sketch is empty. A very long text is one row's sketch and nothing more. A null
    doc_id comes before all others; rows with it are dealt to many tasks. Rows that repeat a doc_id have the same next document, the row with the next larger doc_id;
    if that id is repeated, the row whose text has the smallest hash. A single document is its own next. An empty
    table gives an empty result; other columns are not read, whatever their names.
    """
    links = _all_keys(stage(neighbours(docs), "neighbours"), "doc_id").select("_k", "_none", "before_id", "before_chars")
    full = docs.select("doc_id", text_or_empty().alias("text"))
    full = full.select("doc_id", "text", *_key("doc_id", F.pmod(F.xxhash64("text"), F.lit(NULL_KEYS))))
    # Both uses read the same shuffled texts. Sketches are made after that shuffle, so it carries texts alone.
    joined = full.join(links, ["_k", "_none"])
    head = F.substring(F.col("text"), F.lit(1), F.floor(F.col("before_chars") / 4).cast("int"))
    heads = joined.select(
        "before_id",
        F.struct(head.alias("head"), sketch(F.col("text"), shingle, scale).alias("next_sketch")).alias("next"),
        F.xxhash64("text", "doc_id").alias("_hash"),  # with doc_id, so that both uses read the same columns
    )
    # Keyed before they are grouped, so that group and join share one shuffle.
    heads = _all_keys(heads, "before_id").groupBy("_k", "_none").agg(F.min_by("next", "_hash").alias("next"))
    out = joined.select("_k", "_none", "doc_id", "text").join(heads, ["_k", "_none"], "left")
    n = F.char_length("text")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.coalesce("next.head", F.lit("")), F.lit(1), cut))
    out = out.withColumn("edited", edited)
    sketches = [sketch(F.col(c), shingle, scale) for c in ("text", "edited")]
    out = out.select("doc_id", "text", "edited", sketches[0].alias("sketch"), sketches[1].alias("edited_sketch"), F.col("next.next_sketch").alias("next_sketch"))
    near = lambda other: F.coalesce(likeness(F.col("sketch"), F.col(other)), F.lit(1.0))
    return out.withColumns({"near_edited": near("edited_sketch"), "near_next": near("next_sketch")})

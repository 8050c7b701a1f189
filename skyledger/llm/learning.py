"""Folds and bounded samples of labelled documents, for the operators that learn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Folds by crc32 of doc_id as text; fold 0 is held out and never learned from.
FOLDS = 5


def fold(doc_id: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS))


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the held-out fold. A null doc_id has no fold: it is not held out, and no label belongs to it."""
    return F.coalesce(fold(doc_id) == 0, F.lit(False))


def sample_ids(ids: DataFrame, bound: int, seed: int) -> DataFrame:
    """About ``bound`` rows of ids, or all if there are fewer, chosen by a hash of doc_id and text: the same at every run.

    With the text, rows that share a doc_id, or have none, do not all come or stay away together.
    """
    n = ids.count()
    part = F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in ("doc_id", "text") if c in ids.columns]), F.lit(1_000_000))
    return ids.where(part < F.lit(min(1_000_000, int(1_000_000 * bound / max(n, 1)) + 1)))


def training_labels(labels: DataFrame, column: str) -> DataFrame:
    """(doc_id, label) of rows outside the held-out fold; a doc_id with several labels has their maximum."""
    rows = labels.select("doc_id", F.col(column).cast("int").alias("label")).where("doc_id is not null and label is not null").where(~held_out())
    return rows.groupBy("doc_id").agg(F.max("label").alias("label"))

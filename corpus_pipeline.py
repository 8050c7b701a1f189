"""A corpus pipeline: five stages over the documents table, each written as Parquet and read again.

Texts that the quality classifier rejects go; lines that many documents repeat go; of each group of near copies one
document stays; sources are mixed to target weights, so a document may go or stand several times; what is left is
encoded to token ids. Every stage works on all that the one before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import bpe, line_dedup, mixing, quality, resemblance
from skyledger.llm.common import documents, stage, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their repeated lines; n_chars is that of the new text."""
    kept = line_dedup.dedup_lines(docs)
    new = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    return kept.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five words a shingle; all pairs that are 0.8 alike or more link: SimHash groups first, then what they miss."""
    return resemblance.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_common_lines),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


#: The classifier, SimHash and the tokenizer are beyond SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None

"""The registered queries opN_<name> and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, divergence, embeddings, line_dedup, mixing, pii, quality, recompress, simhash, sketch, toxicity, warc, whitening
from .common import documents, table


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = sketch.fingerprint_documents(documents(spark, sf_dir))
    return x.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        sketch.as_text(F.col("sketch")).alias("fingerprint"),
        sketch.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(documents(spark, sf_dir))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(documents(spark, sf_dir)).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


def op4_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_groups(table(spark, sf_dir, "embeddings"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    rank_file = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_documents(documents(spark, sf_dir), rank_file, public_tokenizers.PATTERN, keep_ids=False).drop("ids")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the offending offsets, as start:end joined by commas."""
    scored = toxicity.score_documents(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return scored.withColumn("spans", spans)


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = recompress.remove_repeats(documents(spark, sf_dir))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """deviation is null where a long does not hold it; the operator's own column is a decimal."""
    white = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return white.withColumn("deviation", F.expr("try_cast(deviation as long)"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(documents(spark, sf_dir))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = warc.archive_and_index(table(spark, sf_dir, "pages"))
    return captures.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_fingerprints": op1_fingerprints,
        "op2_simhash": op2_simhash,
        "op3_pii": op3_pii,
        "op4_embeddings": op4_embeddings,
        "op5_bpe": op5_bpe,
        "op6_quality": op6_quality,
        "op7_line_dedup": op7_line_dedup,
        "op8_toxicity": op8_toxicity,
        "op9_substrings": op9_substrings,
        "op10_mixing": op10_mixing,
        "op11_whitening": op11_whitening,
        "op12_divergence": op12_divergence,
        "op13_warc": op13_warc,
    }


def oracle_sql() -> dict[str, str]:
    return {"op7_line_dedup": line_dedup.ORACLE, "op10_mixing": mixing.ORACLE, "op12_divergence": divergence.ORACLE, "op13_warc": warc.ORACLE}

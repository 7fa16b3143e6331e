"""One query per operator over the whole given tables, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimstrata.llm import (
    decontaminate,
    divergence,
    exact_dedup,
    line_dedup,
    mixing,
    near_dup,
    parse_dedup,
    preference,
    repetition,
    token_counts,
    toxicity,
    turn_repair,
    url_rules,
)

VOCABULARY = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A url is labelled by the document whose number ends its path; low quality or toxic is bad."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    labels = _table(spark, sf_dir, "labels").groupBy("doc_id").agg(
        F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad")
    )
    _, path = url_rules.split_url(F.col("url"))
    number = F.regexp_extract(path, "([0-9]+)[^0-9]*$", 1).try_cast("long")
    labelled = pages.withColumn("number", number).join(labels, F.col("number") == F.col("doc_id"))
    judged = url_rules.judge(pages, labelled.select("url", "bad"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return repetition.quality(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_covered_words"
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, public_tokenizers.path(VOCABULARY))
    return counted.drop("text")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return toxicity.toxicity(docs, labels).select("doc_id", "held_out", "score", "predicted")


def op5_parse_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_dedup.remove_repeats(_table(spark, sf_dir, "documents")).drop("kept")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.line_figures(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", "chars_removed")


def op7_preference_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = preference.swapped_replies(_table(spark, sf_dir, "conversations"))
    made = preference.format_preferences(pairs)
    text = {side: F.array_join(F.col(f"{side}.text"), "") for side in ("chosen", "rejected")}
    trained = {
        side: F.array_join(F.filter(side, lambda x: x["trained"])["text"], "") for side in text
    }
    return made.select(
        "conv_id",
        "partner_id",
        "prompt_turns",
        "prompt",
        *(text[side].alias(side) for side in text),
        *(trained[side].alias(f"{side}_trained") for side in text),
    )


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.decontaminate(docs, _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        decontaminate.items_digest(F.col("items")).alias("items_sha256"),
        "contaminated",
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.interleave(_table(spark, sf_dir, "documents").select("doc_id", "source"))


def op10_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dup.near_duplicates(_table(spark, sf_dir, "documents"), size=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(_table(spark, sf_dir, "documents"))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = turn_repair.damaged(_table(spark, sf_dir, "conversations"))
    return turn_repair.repair(rows).withColumnRenamed("conv", "conv_id")


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.copies(_table(spark, sf_dir, "documents"), with_digest=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_rules": op1_url_rules,
    "op2_quality_rules": op2_quality_rules,
    "op3_token_counts": op3_token_counts,
    "op4_toxicity": op4_toxicity,
    "op5_parse_dedup": op5_parse_dedup,
    "op6_line_dedup": op6_line_dedup,
    "op7_preference_chats": op7_preference_chats,
    "op8_decontamination": op8_decontamination,
    "op9_mixing": op9_mixing,
    "op10_near_dup": op10_near_dup,
    "op11_divergence": op11_divergence,
    "op12_turn_repair": op12_turn_repair,
    "op13_exact_dedup": op13_exact_dedup,
}

"""The queries opN_<name> over the driver's tables, with the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionflow.sources import new_work_path

from . import (
    attention_lm,
    bitplane,
    bpe,
    decontaminate,
    filter_audit,
    html_extract,
    importance,
    language_id,
    licenses,
    nbsvm,
    quality_rules,
    simhash,
    substring_dedup,
)
from .sql import SQL
from .store import stored

__all__ = ["QUERIES", "SQL"]


WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_RANKS = "byte_bpe_multi_50k.tiktoken"
PIECES = "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extract.extracted(pages, html_extract.trained(pages))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN
    return bpe.digests(bpe.round_trip(table(spark, sf_dir, "documents"), path, pattern))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = quality_rules.Rules()
    measured = stored(
        quality_rules.measured_documents(table(spark, sf_dir, "documents"), rules), "measured"
    )
    cutoffs = quality_rules.certified_cutoffs(measured, table(spark, sf_dir, "labels"), rules)
    return quality_rules.with_verdict(measured, cutoffs, rules).select(
        "doc_id",
        *(
            f"m.{c}"
            for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        ),
        "base_failed",
        "kept",
    )


def op5_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return nbsvm.scored(docs, nbsvm.trained(docs, table(spark, sf_dir, "labels")))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.kept_words(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op7_bitplane(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_work_path(spark, "ids")
    files = bitplane.written(
        table(spark, sf_dir, "documents"), path, public_tokenizers.path(WORD_TOKENIZER)
    )
    return bitplane.read_back(spark, path, files)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_components(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def op10_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention_lm.lm_scores(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path(BYTE_RANKS),
        public_tokenizers.PATTERN,
    )


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES)
    return language_id.identified(docs, language_id.trained(docs, path), path)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resampled(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_html_extract": op2_html_extract,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_quality_rules": op4_quality_rules,
    "op5_nbsvm": op5_nbsvm,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_bitplane": op7_bitplane,
    "op8_decontaminate": op8_decontaminate,
    "op9_simhash": op9_simhash,
    "op10_attention_lm": op10_attention_lm,
    "op11_language_id": op11_language_id,
    "op12_filter_audit": op12_filter_audit,
    "op13_importance": op13_importance,
}
"""A corpus pipeline: quality rules, one document of each group of near copies, repeated passages,
benchmark passages, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's docs. All but the last return the columns of docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionflow.llm import bpe, decontaminate, quality_rules, simhash, substring_dedup
from sessionflow.llm.queries import BYTE_RANKS
from sessionflow.llm.store import remove_stored, stored, stored_count


def reject_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the certified cutoffs keep."""
    rules = quality_rules.Rules()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    measured = stored(quality_rules.measured_rows(docs, rules), "measured")
    cutoffs = quality_rules.certified_cutoffs(measured, labels, rules)
    return quality_rules.kept_rows(measured, cutoffs, rules)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of the least doc_id."""
    return simhash.one_of_each(docs)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that stand earlier in the corpus, n_chars brought in line."""
    done = substring_dedup.without_repeats(docs)
    if "n_chars" in done.columns:
        kind = done.schema["n_chars"].dataType
        done = done.withColumn("n_chars", F.length("text").cast(kind))
    return done


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (unsigned 32-bit, little-endian) and the text decoded from them."""
    path, pattern = public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN
    rows = bpe.round_trip(docs, path, pattern)
    return rows.select("doc_id", "n_tokens", "ids", F.decode("decoded", "UTF-8").alias("text"))


STAGES = [
    ("quality_rules", reject_by_rules),
    ("simhash", drop_near_copies),
    ("substring_dedup", remove_repeated_passages),
    ("decontaminate", remove_contaminated),
    ("byte_bpe", encode_texts),
]

#: No SQL: fingerprints and byte-level BPE cannot be expressed in it; tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages. Each stage's own tables, and its input, are removed when its result
    is written."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    mark = stored_count()
    for name, stage in STAGES:
        rows = stored(stage(spark, rows, sf_dir), f"stage-{name}")
        remove_stored(spark, mark, but_last=True)
    return rows

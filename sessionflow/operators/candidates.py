"""Which stored rows a new batch can affect."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionflow.config import SessionConfig
from sessionflow.functions import epoch, utc_date, widened_dates
from sessionflow.schema import PAIR, PARTITIONS
from sessionflow.sources.table import empty_sessions, read_session_table

# Longest list of partitions put into a plan as literals.
MAX_PARTITION_LITERALS = 5000


def prune_dates(new_events: DataFrame, cfg: SessionConfig = SessionConfig()) -> DataFrame:
    """(product_code, event_date) the batch touches, each date widened by the timeout's reach.

    Distinct before and after the widening, so the shuffles carry dates and not events.
    """
    touched = batch_partitions(new_events)
    return touched.select(
        "product_code", widened_dates(F.col("event_date"), cfg.reach_days).alias("event_date")
    ).distinct()


def batch_partitions(new_events: DataFrame) -> DataFrame:
    """(product_code, event_date) of the batch's events themselves."""
    return new_events.select(
        "product_code", utc_date(epoch("timestamp")).alias("event_date")
    ).distinct()


def partition_filter(
    partitions: DataFrame, max_literals: int = MAX_PARTITION_LITERALS
) -> Column | None:
    """A literal filter for these partitions, or None if there are more than ``max_literals``.

    The list is as long as the number of table directories the batch touches, and its length
    is checked while it is fetched.
    """
    found = partitions.select(*PARTITIONS).distinct().limit(max_literals + 1).collect()
    if len(found) > max_literals:
        return None
    by_product: dict[str | None, list[date | None]] = {}
    for product, day in found:
        by_product.setdefault(product, []).append(day)
    condition = F.lit(False)
    for product, days in by_product.items():
        known = [day for day in days if day is not None]
        in_days = F.col("event_date").isin(known) if known else F.lit(False)
        if None in days:
            in_days = in_days | F.col("event_date").isNull()
        condition = condition | (F.col("product_code").eqNullSafe(F.lit(product)) & in_days)
    return condition


def in_partitions(
    rows: DataFrame, partitions: DataFrame, max_literals: int = MAX_PARTITION_LITERALS
) -> DataFrame:
    """Rows in the given (product_code, event_date) partitions.

    A literal filter prunes directories when the plan is made. A list too long for that
    becomes one range of dates for each product, and a semi join.
    """
    condition = partition_filter(partitions, max_literals)
    if condition is not None:
        return rows.where(condition)
    wanted = partitions.select(*PARTITIONS).distinct()
    by_product = wanted.groupBy("product_code").agg(
        F.min("event_date").alias("first"),
        F.max("event_date").alias("last"),
        F.count_if(F.col("event_date").isNull()).alias("undated"),
    )
    ranges = by_product.limit(MAX_PARTITION_LITERALS + 1).collect()
    if len(ranges) <= MAX_PARTITION_LITERALS:
        condition = F.lit(False)
        for product, first, last, undated in ranges:
            days = F.col("event_date").isNull() if undated else F.lit(False)
            if first is not None:
                days = days | F.col("event_date").between(F.lit(first), F.lit(last))
            condition = condition | (F.col("product_code").eqNullSafe(F.lit(product)) & days)
        rows = rows.where(condition)
    kept = rows.alias("kept")
    wanted = wanted.alias("wanted")
    return kept.join(
        wanted,
        F.col("kept.product_code").eqNullSafe(F.col("wanted.product_code"))
        & F.col("kept.event_date").eqNullSafe(F.col("wanted.event_date")),
        "left_semi",
    )


def in_ranges(
    rows: DataFrame, ranges: DataFrame, max_literals: int = MAX_PARTITION_LITERALS
) -> DataFrame:
    """Rows of the products in ``ranges`` with ``event_date`` from ``first_date`` to ``last_date``; a
    bound that is NULL is none.

    One literal range for each product, so that partitions of others are not read. More products
    than ``max_literals`` are joined.
    """
    ranges = ranges.select("product_code", "first_date", "last_date")
    found = ranges.limit(max_literals + 1).collect()
    if len(found) > max_literals:
        return rows.join(
            ranges.withColumnRenamed("product_code", "wanted"),
            F.col("product_code").eqNullSafe(F.col("wanted"))
            & (F.col("first_date").isNull() | (F.col("event_date") >= F.col("first_date")))
            & (F.col("last_date").isNull() | (F.col("event_date") <= F.col("last_date"))),
            "left_semi",
        )
    condition = F.lit(False)
    for product, first, last in found:
        one = F.col("product_code").eqNullSafe(F.lit(product))
        if first is not None:
            one = one & (F.col("event_date") >= F.lit(first))
        if last is not None:
            one = one & (F.col("event_date") <= F.lit(last))
        condition = condition | one
    return rows.where(condition)


def from_dates(
    rows: DataFrame, first_dates: DataFrame, max_literals: int = MAX_PARTITION_LITERALS
) -> DataFrame:
    """Rows of the products in ``first_dates``, from the ``event_date`` there on (NULL: all)."""
    ranges = first_dates.select(
        "product_code",
        F.col("event_date").alias("first_date"),
        F.lit(None).cast("date").alias("last_date"),
    )
    return in_ranges(rows, ranges, max_literals)


def of_batch_pairs(rows: DataFrame, new_events: DataFrame) -> DataFrame:
    """Rows of the (user, product) pairs of the batch.

    A semi join: Spark broadcasts the pairs if they turn out small, and splits a hot pair on
    the row side otherwise.
    """
    return rows.join(new_events.select(*PAIR).distinct(), PAIR, "left_semi")


def existing_candidates(
    existing: DataFrame, new_events: DataFrame, cfg: SessionConfig = SessionConfig()
) -> DataFrame:
    """Stored rows near the batch: touched partitions, pairs of the batch."""
    if cfg.idle_cutoff:
        existing = in_partitions(existing, prune_dates(new_events, cfg))
    return of_batch_pairs(existing, new_events)


def read_existing_sessions(
    spark: SparkSession,
    table_path: str,
    new_events: DataFrame,
    cfg: SessionConfig = SessionConfig(),
) -> DataFrame:
    """``existing_candidates`` of a session table; empty where there is no table yet."""
    user_type = new_events.schema["user_id"].dataType
    stored = read_session_table(spark, table_path, user_type)
    if stored is None:
        return empty_sessions(spark, user_type)
    return existing_candidates(stored, new_events, cfg)

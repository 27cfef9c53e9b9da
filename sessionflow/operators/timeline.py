"""Session state of pairs that are too large for one task.

A slice is never wider than the timeout, so all user actions in it belong to one session, and
only the first of them can start a session. The first and the last action of each slice are
therefore all that is needed to find every session. They come from an aggregation with a
map-side part.

What lies before a slice is a maximum over earlier slices, found by a scan in two levels: the
slices of a pair and day are ordered by one task, and so are the days of a pair, one row each. A
task sees the slices of a day or the days of the data, however many events the pair has and
however short the timeout is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionflow.config import DAY_SECS, SessionConfig
from sessionflow.functions import slice_of
from sessionflow.schema import PAIR
from sessionflow.sources.files import new_work_path


def active_slices(items: DataFrame, cfg: SessionConfig) -> DataFrame:
    """First (``lo``) and last (``hi``) user action of each slice that has any item."""
    return items.groupBy(*PAIR, slice_of(F.col("t"), cfg.slice_secs).alias("slice")).agg(
        F.min(F.when(F.col("hi").isNotNull(), F.col("t"))).alias("lo"), F.max("hi").alias("hi")
    )


def with_earlier_max(state: DataFrame, value: Column, name: str) -> DataFrame:
    """``state`` with the maximum of ``value`` over the earlier slices of the pair."""
    days = Window.partitionBy(*PAIR).orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    in_day = (
        Window.partitionBy(*PAIR, "day").orderBy("slice").rangeBetween(Window.unboundedPreceding, -1)
    )
    by_day = (
        state.groupBy(*PAIR, "day")
        .agg(F.max(value).alias("of_day"))
        .select(*PAIR, "day", F.max("of_day").over(days).alias("of_days_before"))
    )
    return (
        state.withColumn("before_in_day", F.max(value).over(in_day))
        .join(by_day, [*PAIR, "day"])
        # of two maxima the one that is there, or the greater
        .withColumn(name, F.greatest("of_days_before", "before_in_day"))
        .drop("of_days_before", "before_in_day")
    )


def carried_state(items: DataFrame, cfg: SessionConfig, with_stored: bool = False) -> DataFrame:
    """What lies before each slice: one row per (user, product, slice) with

    before_t  the latest user action before the slice
    before    the session of that action: its start, or ``with_stored`` a struct
              (start, stored_id)

    ``items`` have the columns user_id, product_code, t, hi and, ``with_stored``, stored_id; see
    ``assign_sessions``. The slices are written once, as both levels of both scans read them.
    """
    state = active_slices(items, cfg)
    start = opener = F.col("lo")
    if with_stored:
        # The ids of stored sessions come as rows of their own beside the slice rows.
        stored = items.where("stored_id is not null").select(
            *PAIR,
            slice_of(F.col("t"), cfg.slice_secs).alias("slice"),
            F.col("t").alias("lo"),
            "hi",
            "stored_id",
        )
        state = state.withColumn("stored_id", F.lit(None).cast("string")).unionByName(stored)
        start = F.col("first")["lo"]
        opener = F.struct(start.alias("start"), F.col("first")["stored_id"].alias("stored_id"))
    day = F.floor(F.col("slice") * F.lit(cfg.slice_secs) / F.lit(DAY_SECS)).alias("day")
    spark, path = items.sparkSession, new_work_path(items.sparkSession, "slices")
    state = state.select("*", day)
    state.write.parquet(path)
    state = spark.read.schema(state.schema).parquet(path)
    if with_stored:
        # The earliest action of the slice; a stored session goes before a new event.
        same = (
            Window.partitionBy(*PAIR, "day")
            .orderBy("slice")
            .rangeBetween(Window.currentRow, Window.currentRow)
        )
        candidate = F.when(
            F.col("lo").isNotNull(),
            F.struct("lo", F.col("stored_id").isNull().alias("is_new"), "stored_id"),
        )
        state = state.withColumn("first", F.min(candidate).over(same))
    opened = F.when(
        start.isNotNull()
        & (
            F.col("before_t").isNull()
            | (start - F.col("before_t") > F.lit(cfg.timeout_secs))
        ),
        opener,
    )
    state = with_earlier_max(state, F.col("hi"), "before_t").withColumn("opened", opened)
    state = with_earlier_max(state, F.col("opened"), "before")
    if with_stored:
        state = state.where("stored_id is null")
    return state.select(*PAIR, "slice", "before_t", "before")

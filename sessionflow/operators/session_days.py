"""What each session does on each date: a small table beside the session table.

A row names a pair, a session (or NULL for events without one) and a date on which it has events,
with its first and last user action on that date, if any. Its partitions are those of the
session table. It answers what would else need the events: which stored sessions lie near a batch,
on which dates a session has rows, and which session was the last before a time.

It is kept by rules and not counted anew: a batch adds its rows and renames sessions. User actions
are exact at all times; of product events a row may be left for a date that has no more of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from sessionflow.config import SessionConfig
from sessionflow.functions import epoch, utc_date
from sessionflow.operators.candidates import from_dates, in_ranges
from sessionflow.schema import PAIR

DAY_COLUMNS = ["user_id", "session_id", "first_t", "last_t", "product_code", "event_date"]


def day_schema(user_type: DataType | None = None) -> StructType:
    return StructType(
        [
            StructField("user_id", user_type or StringType()),
            StructField("session_id", StringType()),
            StructField("first_t", LongType()),
            StructField("last_t", LongType()),
            StructField("product_code", StringType()),
            StructField("event_date", DateType()),
        ]
    )


def _merged(days: DataFrame) -> DataFrame:
    return (
        days.groupBy(*PAIR, "event_date", "session_id")
        .agg(F.min("first_t").alias("first_t"), F.max("last_t").alias("last_t"))
        .select(*DAY_COLUMNS)
    )


def _actions(user_actions: tuple[str, ...] | list[str]) -> list[Column]:
    t = F.when(F.col("event_id").isin(*user_actions), epoch("timestamp"))
    return [F.min(t).alias("first_t"), F.max(t).alias("last_t")]


def session_days(rows: DataFrame, user_actions: tuple[str, ...] | list[str]) -> DataFrame:
    """The table of these session rows. Events collapse before they are shuffled."""
    return (
        rows.groupBy(*PAIR, "event_date", "session_id")
        .agg(*_actions(user_actions))
        .select(*DAY_COLUMNS)
    )


def touched_sessions(rows: DataFrame, cfg: SessionConfig) -> DataFrame:
    """The table of these rows, with the number of ``events`` of each of its rows."""
    return (
        rows.groupBy(*PAIR, "event_date", "session_id")
        .agg(F.count(F.lit(1)).alias("events"), *_actions(cfg.user_actions))
        .select(*DAY_COLUMNS, "events")
    )


def days_of(touched: DataFrame) -> DataFrame:
    return touched.select(*DAY_COLUMNS)


def renamed(days: DataFrame, id_changes: DataFrame, touched: DataFrame) -> DataFrame:
    """``days`` after a batch: ids of renamed sessions replaced, the batch's own days added."""
    changes = id_changes.select(
        *PAIR, F.col("original_session_id").alias("session_id"), "final_session_id"
    )
    kept = (
        days.join(changes, [*PAIR, "session_id"], "left")
        .withColumn("session_id", F.coalesce("final_session_id", "session_id"))
        .select(*DAY_COLUMNS)
    )
    return _merged(kept.unionByName(days_of(touched)))


# --- look-ups -------------------------------------------------------------------------------


def sessions_of(days: DataFrame) -> DataFrame:
    """(user_id, product_code, session_id, t, hi): sessions by their first and last user action."""
    return (
        days.where("session_id is not null and first_t is not null")
        .groupBy(*PAIR, "session_id")
        .agg(F.min("first_t").alias("t"), F.max("last_t").alias("hi"))
    )


def session_dates(
    near: DataFrame,
    near_dates: DataFrame | None,
    days: DataFrame,
    id_changes: DataFrame,
    cfg: SessionConfig,
) -> DataFrame:
    """(product_code, event_date) on which renamed sessions have rows.

    ``near`` are the days of the batch's pairs in the partitions ``near_dates``, or if that is None
    all days of sessions that can be renamed. Only a session that may go on where those end, as
    it has a row within reach of a date that is not among them, is looked for in later partitions.
    """
    changes = id_changes.select(*PAIR, F.col("original_session_id").alias("session_id"))
    its = near.join(changes, [*PAIR, "session_id"], "left_semi")
    found = its.select("product_code", "event_date")
    if near_dates is None:
        return found.distinct()
    ahead = its.select(
        *PAIR,
        "session_id",
        F.explode(F.sequence(F.lit(1), F.lit(cfg.reach_days))).alias("ahead"),
        "event_date",
    ).withColumn("event_date", F.date_add("event_date", F.col("ahead")))
    open_ones = ahead.join(
        near_dates.select("product_code", "event_date"), ["product_code", "event_date"], "left_anti"
    )
    first = open_ones.groupBy("product_code").agg(F.min("event_date").alias("event_date"))
    later = from_dates(days, first).join(
        open_ones.select(*PAIR, "session_id").distinct(), [*PAIR, "session_id"], "left_semi"
    )
    return found.unionByName(later.select("product_code", "event_date")).distinct()


def batch_bounds(batch: DataFrame) -> DataFrame:
    """(user_id, product_code, lo_t, hi_t) of the batch's pairs; incomplete rows have none."""
    t = epoch("timestamp")
    return (
        batch.where("user_id is not null and product_code is not null and timestamp is not null")
        .groupBy(*PAIR)
        .agg(F.min(t).alias("lo_t"), F.max(t).alias("hi_t"))
    )


def days_from_batch_on(days: DataFrame, bounds: DataFrame, cfg: SessionConfig) -> DataFrame:
    """Days of the batch's pairs that the batch can change without the idle cutoff.

    From the date of a pair's first event in the batch, up to the date of its first session that
    starts more than the timeout after the pair's last event there: that session and all
    events after its start stay as they are. No session that starts before the batch is renamed.
    """
    first = utc_date(F.col("lo_t"))
    products = bounds.groupBy("product_code").agg(F.min(first).alias("event_date"))
    later = (
        from_dates(days, products).join(bounds, PAIR).where(F.col("event_date") >= first)
    )
    starts = later.where("session_id is not null").groupBy(*PAIR, "hi_t", "session_id").agg(
        F.min("first_t").alias("start_t")
    )
    ends = (
        starts.where(F.col("start_t") > F.col("hi_t") + F.lit(cfg.timeout_secs))
        .groupBy(*PAIR)
        .agg(F.min("start_t").alias("end_t"))
    )
    within = F.col("end_t").isNull() | (F.col("event_date") <= utc_date(F.col("end_t")))
    return later.join(ends, PAIR, "left").where(within).select(*DAY_COLUMNS)


def days_before_batch(days: DataFrame, bounds: DataFrame) -> DataFrame:
    """For each pair of the batch its last day with user actions before the date of its first event
    there, as of which product events carry an id without the idle cutoff."""
    first = utc_date(F.col("lo_t"))
    products = bounds.groupBy("product_code").agg(F.date_sub(F.max(first), 1).alias("last_date"))
    ranges = products.select("product_code", F.lit(None).cast("date").alias("first_date"), "last_date")
    last = F.max_by(F.struct("session_id", "first_t", "last_t", "event_date"), "last_t")
    return (
        in_ranges(days, ranges)
        .where("session_id is not null and last_t is not null")
        .join(bounds, PAIR)
        .where(F.col("event_date") < first)
        .groupBy(*PAIR)
        .agg(last.alias("last"))
        .select(*PAIR, "last.*")
        .select(*DAY_COLUMNS)
    )

"""Session bounds and per-user summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionflow.schema import PAIR


def session_bounds(sessions: DataFrame, prefix: str) -> DataFrame:
    """First and last time and date of each session; rows without a session form one group
    per pair."""
    return sessions.groupBy(*PAIR, F.col("session_id").alias(f"{prefix}_session_id")).agg(
        F.min("timestamp").alias(f"{prefix}_session_min_time"),
        F.max("timestamp").alias(f"{prefix}_session_max_time"),
        F.min("event_date").alias(f"{prefix}_min_date"),
        F.max("event_date").alias(f"{prefix}_max_date"),
    )


def sessions_by_user(sessions: DataFrame) -> DataFrame:
    """Sessions, events and time in sessions of each user.

    Two aggregations, by session and then by user: a user with very many events is reduced to
    session rows before its key is shuffled alone.
    """
    by_session = (
        sessions.where("session_id is not null")
        .groupBy(*PAIR, "session_id")
        .agg(
            F.count(F.lit(1)).alias("events"),
            (F.unix_seconds(F.max("timestamp")) - F.unix_seconds(F.min("timestamp"))).alias("secs"),
            F.min("timestamp").alias("first_time"),
        )
    )
    return by_session.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("sessions"),
        F.sum("events").alias("events"),
        F.sum("secs").alias("session_secs"),
        F.max("secs").alias("longest_secs"),
        F.min("first_time").alias("first_session_time"),
    )

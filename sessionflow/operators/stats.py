"""Batch statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def batch_stats(rows: DataFrame) -> DataFrame:
    """Events and distinct sessions of a batch in one pass. NULL is no session.

    Rows are first counted by session id, so the global step only adds up small partial sums.
    """
    return (
        rows.groupBy("session_id")
        .agg(F.count(F.lit(1)).alias("events"))
        .agg(
            F.coalesce(F.sum("events"), F.lit(0)).alias("events"),
            F.count("session_id").alias("sessions"),
        )
    )

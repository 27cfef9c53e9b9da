"""Micro-batch processing with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DataType

from sessionflow.config import SessionConfig
from sessionflow.functions import epoch, user_action_filter
from sessionflow.operators.assign import assign_sessions, hot_pairs
from sessionflow.plans.pipeline import process_batch
from sessionflow.schema import EVENT_KEY, PAIR
from sessionflow.sources.events import stream_events


def start_session_stream(
    spark: SparkSession,
    raw_path: str,
    table_path: str | None,
    checkpoint: str,
    cfg: SessionConfig = SessionConfig(),
    archive_dir: str | None = None,
    interval: str | None = None,
    max_files_per_trigger: int | None = None,
    user_type: DataType | None = None,
    table_name: str | None = None,
) -> StreamingQuery:
    """Keep the session table up to date with the files arriving in ``raw_path``. It is a Parquet
    folder, or with ``table_name`` a catalog table with row-level operations.

    Without ``interval`` ("60 seconds") all waiting files are processed and the query ends.
    The checkpoint remembers consumed files. A batch that is retried after a failure is
    upserted again with the same result.
    """
    events = stream_events(spark, raw_path, archive_dir, max_files_per_trigger, user_type)

    def apply(batch: DataFrame, batch_id: int) -> None:
        process_batch(batch.sparkSession, batch, table_path, cfg, table_name)

    writer = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(apply)
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def session_windows(
    events: DataFrame,
    cfg: SessionConfig = SessionConfig(),
    late_days: int | None = None,
    append: bool = False,
) -> DataFrame:
    """Start, end and number of user actions of each session, for batches and streams.

    The end is the last action plus the timeout. ``late_days`` is how late events of a stream
    may be; a session of a stream is final once the watermark has passed its end. Copies of an
    event count once; in a stream those that come while the watermark lets them.

    ``append`` says that a stream with ``late_days`` is written in append mode. Its actions then
    meet by pair only after they have been counted by pair and second, in a stateful step of its
    own, so what is shuffled and kept by pair is bounded by the time span and not by the events.
    Complete mode has no place for such a step.
    """
    if append and late_days is None:
        raise ValueError("append mode needs late_days")
    actions = events.where(user_action_filter(cfg)).where(
        "user_id is not null and product_code is not null and timestamp is not null"
    )
    if not events.isStreaming:
        return _batch_session_windows(actions, cfg)
    time, counted = F.col("timestamp"), F.count(F.lit(1))
    if late_days is None:
        rows = actions.dropDuplicates(EVENT_KEY)
    else:
        rows = actions.withWatermark("timestamp", f"{late_days} days")
        rows = rows.dropDuplicatesWithinWatermark(EVENT_KEY)
    if append:
        # Times are whole seconds, so a window of the least width holds the actions of one second,
        # and the time of such a window is the second itself.
        by_second = F.window("timestamp", "1 microsecond").alias("second")
        rows = rows.groupBy(*PAIR, by_second).agg(counted.alias("events"))
        time, counted = F.window_time("second"), F.sum("events")
    window = F.session_window(time, f"{cfg.timeout_secs} seconds")
    return (
        rows.groupBy(*PAIR, window.alias("w"))
        .agg(counted.alias("actions"))
        .select(
            *PAIR,
            F.col("w.start").alias("session_start"),
            F.col("w.end").alias("session_end"),
            "actions",
        )
    )


def _batch_session_windows(actions: DataFrame, cfg: SessionConfig) -> DataFrame:
    """Without a stream's state the pairs can be split, and copies collapse before they do."""
    hot = hot_pairs(actions, cfg)
    # One shuffle by pair serves the counts and the windows, unless a pair is hot.
    rows = actions.repartition(*PAIR) if hot is None else actions
    items = (
        rows.select(*EVENT_KEY)
        .distinct()
        .groupBy(*PAIR, epoch("timestamp").alias("t"))
        .agg(F.count(F.lit(1)).alias("events"))
        .withColumn("hi", F.col("t"))
    )
    return (
        assign_sessions(items, cfg, hot)
        .groupBy(*PAIR, "start_t")
        .agg(F.max("t").alias("last_t"), F.sum("events").alias("actions"))
        .select(
            *PAIR,
            F.timestamp_seconds("start_t").alias("session_start"),
            F.timestamp_seconds(F.col("last_t") + F.lit(cfg.timeout_secs)).alias("session_end"),
            "actions",
        )
    )

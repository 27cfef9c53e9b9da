"""Session ids for a set of events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionflow.config import SessionConfig
from sessionflow.functions import make_session_id, utc_date
from sessionflow.operators.assign import (
    as_items,
    assign_sessions,
    hot_pairs,
    without_copies,
)
from sessionflow.schema import EVENT_KEY, SESSION_COLUMNS


def distinct_events(events: DataFrame) -> DataFrame:
    """One row per event key. Copies collapse in the map-side part of the aggregation."""
    return events.select(*EVENT_KEY).distinct()


def _assigned(events: DataFrame, cfg: SessionConfig) -> DataFrame:
    rows = events.select(*EVENT_KEY)
    hot = hot_pairs(rows, cfg)
    items = as_items(without_copies(rows, hot), cfg)
    return assign_sessions(items, cfg, hot, with_copies=as_items(rows, cfg))


def identify_sessions(events: DataFrame, cfg: SessionConfig = SessionConfig()) -> DataFrame:
    """Sessions by user and product. Events outside every session keep a NULL id.

    ``events`` are normalized events (timestamps in whole seconds).
    """
    return (
        _assigned(events, cfg)
        .withColumn(
            "session_id", F.when(F.col("in_session"), make_session_id(F.col("start_t")))
        )
        .withColumn("event_date", utc_date(F.col("t")))
        .select(*SESSION_COLUMNS)
    )


def user_activity(events: DataFrame, cfg: SessionConfig = SessionConfig()) -> DataFrame:
    """The parts the session rule is made of, one row per event:

    is_user_event    the event is a user action
    last_user_t      latest user action at or before the event
    prev_user_t      latest user action strictly before the event
    inactivity_gap   seconds since prev_user_t
    is_new_session   the event is a user action that starts a session
    start_t          start of the latest session at or before the event

    Times are epoch seconds.
    """
    rows = _assigned(events, cfg).withColumn("is_user_event", F.col("hi").isNotNull())
    return rows.select(
        *EVENT_KEY,
        "t",
        "is_user_event",
        "last_user_t",
        "prev_user_t",
        (F.col("t") - F.col("prev_user_t")).alias("inactivity_gap"),
        F.coalesce(F.col("is_user_event") & (F.col("start_t") == F.col("t")), F.lit(False)).alias(
            "is_new_session"
        ),
        "start_t",
    )

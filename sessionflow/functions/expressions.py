"""Column expressions used by the operators. All of them are Spark built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sessionflow.config import DAY_SECS, SessionConfig


def epoch(ts: Column | str) -> Column:
    """Whole seconds since 1970, rounded down."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_seconds(ts.cast("timestamp"))


def whole_seconds(ts: Column | str) -> Column:
    return F.timestamp_seconds(epoch(ts))


def zoneless_seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970 of a timestamp without a time zone, read as UTC."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return (
        F.unix_date(F.to_date(ts)) * F.lit(DAY_SECS).cast("bigint")
        + F.hour(ts) * 3600
        + F.minute(ts) * 60
        + F.second(ts)
    )


def utc_date(t: Column) -> Column:
    """Date of an epoch second, whatever the session time zone is."""
    return F.date_from_unix_date(F.floor(t / F.lit(DAY_SECS)).cast("int"))


def slice_of(t: Column, width: int) -> Column:
    return F.floor(t / F.lit(width)).cast("bigint")


def is_user_action(cfg: SessionConfig) -> Column:
    """A flag that is never NULL."""
    return F.coalesce(user_action_filter(cfg), F.lit(False))


def user_action_filter(cfg: SessionConfig) -> Column:
    """The same as a filter, in the form that is pushed down to Parquet."""
    return F.col("event_id").isin(*cfg.user_actions)


def make_session_id(start: Column) -> Column:
    """``user#product#start``; NULL as soon as one part is NULL."""
    return F.concat(
        F.col("user_id").cast("string"),
        F.lit("#"),
        F.col("product_code"),
        F.lit("#"),
        start.cast("string"),
    )


def widened_dates(date: Column, days: int) -> Column:
    """The date with ``days`` dates before and after it, one row each."""
    return F.explode(F.sequence(F.date_sub(date, days), F.date_add(date, days)))

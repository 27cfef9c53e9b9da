"""Row types and key columns."""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    DateType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

PAIR = ["user_id", "product_code"]
EVENT_KEY = ["user_id", "product_code", "event_id", "timestamp"]
PARTITIONS = ["product_code", "event_date"]
SESSION_COLUMNS = [*EVENT_KEY, "session_id", "event_date"]


def raw_schema(user_type: DataType | None = None) -> StructType:
    return StructType(
        [
            StructField("user_id", user_type or StringType()),
            StructField("event_id", StringType()),
            StructField("timestamp", TimestampType()),
            StructField("product_code", StringType()),
        ]
    )


def session_schema(user_type: DataType | None = None) -> StructType:
    return StructType(
        [
            StructField("user_id", user_type or StringType()),
            StructField("product_code", StringType()),
            StructField("event_id", StringType()),
            StructField("timestamp", TimestampType()),
            StructField("session_id", StringType()),
            StructField("event_date", DateType()),
        ]
    )

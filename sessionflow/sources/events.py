"""Raw event batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from sessionflow.functions import whole_seconds, zoneless_seconds
from sessionflow.schema import raw_schema


def normalize_events(events: DataFrame) -> DataFrame:
    """The four raw columns, with timestamps cut to whole seconds. Timestamps without a time zone are
    UTC, whatever the zone of the session is."""
    if events.schema["timestamp"].dataType.typeName() == "timestamp_ntz":
        seconds = F.timestamp_seconds(zoneless_seconds("timestamp"))
    else:
        seconds = whole_seconds("timestamp")
    return events.select(
        "user_id",
        "event_id",
        seconds.alias("timestamp"),
        "product_code",
    )


def read_events(
    spark: SparkSession, path: str | list[str], user_type: DataType | None = None
) -> DataFrame:
    """All Parquet files of a batch directory. No file at all gives an empty frame."""
    raw = (
        spark.read.schema(raw_schema(user_type))
        .option("pathGlobFilter", "*.parquet")
        .parquet(*([path] if isinstance(path, str) else path))
    )
    return normalize_events(raw)


def stream_events(
    spark: SparkSession,
    path: str,
    archive_dir: str | None = None,
    max_files_per_trigger: int | None = None,
    user_type: DataType | None = None,
) -> DataFrame:
    """The same directory as a stream; each file is read once.

    With ``archive_dir`` Spark moves a file there after the batch that read it has been
    committed.
    """
    reader = (
        spark.readStream.schema(raw_schema(user_type))
        .option("pathGlobFilter", "*.parquet")
    )
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive_dir is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return normalize_events(reader.parquet(path))

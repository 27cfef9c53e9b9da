"""The session table: Parquet, partitioned by product and date, with what is known about it.

    product_code=.../event_date=.../     rows
    _state/table.json                    schema of the table, user actions of the day table
    _state/session_days/                 the day table, in the same partitions

Spark ignores names that begin with an underscore, so ``spark.read.parquet`` reads just the rows.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType, DateType, StringType, StructField, StructType

from sessionflow.schema import SESSION_COLUMNS, session_schema
from sessionflow.sources.files import path_exists, read_text

STATE = "_state"


def state_file(path: str) -> str:
    return f"{path.rstrip('/')}/{STATE}/table.json"


def days_path(path: str) -> str:
    return f"{path.rstrip('/')}/{STATE}/session_days"


def read_state(spark: SparkSession, path: str) -> dict:
    """What the last commit noted: ``schema`` of the table, and ``user_actions`` if the day table is
    kept. Empty for a table that others wrote."""
    text = read_text(spark, state_file(path))
    return {} if text is None else json.loads(text)


def read_session_table(
    spark: SparkSession,
    path: str,
    user_type: DataType | None = None,
    schema: StructType | None = None,
) -> DataFrame | None:
    """The stored sessions, or None where the path is absent. Any other problem is an error.

    The types of the partition columns are given and not guessed from directory names, so a
    product code such as ``007`` stays a string. Columns beyond the known six are kept, also
    those that only some files have. Their names come from ``schema`` or from the state of the
    table, which every commit writes; only a table without it has the footers of all its files
    merged, by a Spark job.
    """
    if not path_exists(spark, path):
        return None
    if schema is None:
        noted = read_state(spark, path).get("schema")
        schema = None if noted is None else StructType.fromJson(noted)
    if schema is not None:
        return spark.read.schema(schema).parquet(path).select(*schema.names)
    try:
        stored = spark.read.option("mergeSchema", "true").parquet(path).schema
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return empty_sessions(spark, user_type)
    fixed = {"product_code": StringType(), "event_date": DateType()}
    schema = StructType([StructField(f.name, fixed.get(f.name, f.dataType)) for f in stored])
    extra = [f.name for f in schema if f.name not in SESSION_COLUMNS]
    return spark.read.schema(schema).parquet(path).select(*SESSION_COLUMNS, *extra)


def empty_sessions(spark: SparkSession, user_type: DataType | None = None) -> DataFrame:
    return spark.createDataFrame([], session_schema(user_type))

"""Upsert into the session table."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sessionflow.operators.candidates import MAX_PARTITION_LITERALS, in_partitions
from sessionflow.operators.session_days import day_schema, session_days
from sessionflow.schema import EVENT_KEY, PARTITIONS, SESSION_COLUMNS
from sessionflow.sources.files import (
    at_once,
    child_folders,
    path_exists,
    read_text,
    remove_file,
    remove_folder,
    replace_folder,
    write_text,
)
from sessionflow.sources.table import (
    days_path,
    read_session_table,
    read_state,
    state_file,
)

# Spark ignores files and folders whose names begin with an underscore.
PENDING = "_pending_upsert"
STAGED = "_staged-"


def one_row_per_event(rows: DataFrame) -> DataFrame:
    """Rows without repeated event keys. Copies that disagree keep the smallest id."""
    return rows.groupBy(*EVENT_KEY, "event_date").agg(F.min("session_id").alias("session_id"))


def _same_event(left: str, right: str) -> Column:
    condition = F.lit(True)
    for key in EVENT_KEY:
        condition = condition & F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
    return condition


def merged_rows(target: DataFrame, source: DataFrame, flagged: bool = False) -> DataFrame:
    """``target`` with the ids of ``source``; source rows without a match are added.

    A matched row keeps all its other columns. If ``source`` is ``flagged``, its column ``inserted``
    says which of its rows have no match, and the target is read once. Else an inner join of the
    keys finds them. Rows of the large side stay where they are if Spark can broadcast ``source``.
    """
    extra = [c for c in target.columns if c not in SESSION_COLUMNS]
    known = source.where("not inserted") if flagged else source
    old = target.alias("old")
    new = known.select(*SESSION_COLUMNS).withColumn("in_source", F.lit(True)).alias("new")
    updated = old.join(new, _same_event("old", "new"), "left").select(
        *(F.col(f"old.{c}") for c in [*EVENT_KEY, "event_date"]),
        F.when(F.col("in_source"), F.col("new.session_id"))
        .otherwise(F.col("old.session_id"))
        .alias("session_id"),
        *(F.col(f"old.{c}") for c in extra),
    )
    if flagged:
        added = source.where("inserted").select(*SESSION_COLUMNS)
    else:
        keys = source.select(*EVENT_KEY).alias("new")
        found = (
            target.select(*EVENT_KEY)
            .alias("old")
            .join(keys, _same_event("old", "new"))
            .select(*(F.col(f"new.{c}") for c in EVENT_KEY))
            .alias("found")
        )
        added = source.select(*SESSION_COLUMNS).alias("new").join(
            found, _same_event("new", "found"), "left_anti"
        )
    return updated.unionByName(added, allowMissingColumns=True)


# --- commits --------------------------------------------------------------------------------


def write_staged(rows: DataFrame, path: str) -> None:
    """Write rows in the layout of the table.

    The rebalance gathers a partition into few files and splits a hot one over many tasks.
    """
    (
        rows.hint("rebalance", *(F.col(c) for c in PARTITIONS))
        .write.partitionBy(*PARTITIONS)
        .parquet(path)
    )


def staged_partitions(spark: SparkSession, path: str) -> list[str]:
    """The partition folders of a staged table, relative to it."""
    products = [f"{path}/{p}" for p in child_folders(spark, path) if "=" in p]
    found = at_once(lambda p: [f"{p}/{d}" for d in child_folders(spark, p) if "=" in d], products)
    return [p.removeprefix(f"{path}/") for part in found for p in part]


def pending_marker(table_path: str) -> str:
    return f"{table_path.rstrip('/')}/{PENDING}"


def stage_folder(table_path: str) -> str:
    """A new folder beside the rows of a table, on the same file system."""
    return f"{table_path.rstrip('/')}/{STAGED}{uuid.uuid4().hex}"


def commit_partitions(
    spark: SparkSession,
    rows: DataFrame,
    table_path: str,
    days: DataFrame | None = None,
    user_actions: tuple[str, ...] | list[str] | None = None,
) -> None:
    """Replace the partitions that occur in ``rows`` in a way that a crash cannot leave halfway.

    The rows are written once, beside the table and in its layout. Then a marker in the table lists
    the folders to swap, and each is put in its place by renames. Whoever finds the marker does
    the swaps that are left. ``days`` are the same partitions of the day table, for these
    ``user_actions``; without it they are counted from the rows if the table has one.
    """
    staged = stage_folder(table_path)
    if days is not None:
        both = [(rows, f"{staged}/rows"), (days, f"{staged}/days")]
        at_once(lambda one: write_staged(*one), both)
    else:
        write_staged(rows, f"{staged}/rows")
        user_actions = read_state(spark, table_path).get("user_actions")
        if user_actions is not None:
            written = spark.read.schema(rows.schema).parquet(f"{staged}/rows")
            write_staged(session_days(written, user_actions), f"{staged}/days")
    commit_staged(spark, table_path, staged, rows.schema, user_actions)


def commit_staged(
    spark: SparkSession,
    table_path: str,
    staged: str,
    schema: StructType,
    user_actions: tuple[str, ...] | list[str] | None,
) -> None:
    """Commit what has been staged in the folders ``rows`` and, if there is one, ``days``."""
    table = table_path.rstrip("/")
    below = days_path(table).removeprefix(f"{table}/")
    swaps = [[f"rows/{p}", p] for p in staged_partitions(spark, f"{staged}/rows")]
    swaps += [[f"days/{p}", f"{below}/{p}"] for p in staged_partitions(spark, f"{staged}/days")]
    state = {"schema": schema.jsonValue(), "user_actions": user_actions and list(user_actions)}
    pending = {"staged": staged, "swaps": swaps, "state": state}
    write_text(spark, pending_marker(table), json.dumps(pending))
    finish_commit(spark, table)


def finish_commit(spark: SparkSession, table_path: str) -> bool:
    """Finish the commit that a marker names; whether there was one. Called before every batch, and
    removes what a writer left that died before its marker."""
    table = table_path.rstrip("/")
    text = read_text(spark, pending_marker(table))
    if text is not None:
        pending = json.loads(text)
        staged = pending["staged"]
        at_once(
            lambda swap: replace_folder(
                spark, f"{staged}/{swap[0]}", f"{table}/{swap[1]}", f"{staged}/old/{swap[0]}"
            ),
            pending["swaps"],
        )
        remove_file(spark, state_file(table))
        write_text(spark, state_file(table), json.dumps(pending["state"]))
        remove_file(spark, pending_marker(table))
    for name in child_folders(spark, table):
        if name.startswith(STAGED):
            remove_folder(spark, f"{table}/{name}")
    return text is not None


def stored_days(
    spark: SparkSession, table_path: str, stored: DataFrame, user_actions: tuple[str, ...]
) -> DataFrame:
    """The day table. A table that has none for these user actions gets one, counted from all its
    rows once."""
    table, state = table_path.rstrip("/"), read_state(spark, table_path)
    if state.get("user_actions") != list(user_actions):
        staged = stage_folder(table)
        write_staged(session_days(stored, user_actions), f"{staged}/days")
        remove_folder(spark, days_path(table))
        if path_exists(spark, f"{staged}/days"):
            replace_folder(spark, f"{staged}/days", days_path(table), f"{staged}/old")
        state = {"schema": stored.schema.jsonValue(), "user_actions": list(user_actions)}
        remove_file(spark, state_file(table))
        write_text(spark, state_file(table), json.dumps(state))
        remove_folder(spark, staged)
    schema = day_schema(stored.schema["user_id"].dataType)
    return spark.read.schema(schema).parquet(days_path(table)).select(*schema.names)


def upsert_sessions(
    spark: SparkSession,
    rows: DataFrame,
    table_path: str,
    unique_keys: bool = False,
    max_literals: int = MAX_PARTITION_LITERALS,
    schema: StructType | None = None,
) -> None:
    """Matched events get the new ``session_id``, other rows are inserted.

    Copy-on-write of the touched partitions, one writer at a time. ``rows`` must not depend on
    the table itself; write them to a table first if they do. ``unique_keys`` says that no event
    key is repeated in them, which saves an aggregation; ``schema`` is the table's, if known.
    """
    finish_commit(spark, table_path)
    source = rows.select(*SESSION_COLUMNS) if unique_keys else one_row_per_event(rows)
    target = read_session_table(spark, table_path, rows.schema["user_id"].dataType, schema)
    if target is not None:
        target = in_partitions(target, rows.select(*PARTITIONS), max_literals)
        source = merged_rows(target, source)
    commit_partitions(spark, source, table_path)


def merge_into_table(rows: DataFrame, table_name: str, unique_keys: bool = False) -> None:
    """The same upsert as one atomic MERGE, for catalog tables with row-level operations."""
    source = rows.select(*SESSION_COLUMNS) if unique_keys else one_row_per_event(rows)
    (
        source.alias("source")
        .mergeInto(table_name, _same_event(table_name, "source"))
        .whenMatched()
        .update({"session_id": F.col("source.session_id")})
        .whenNotMatched()
        .insert({c: F.col(f"source.{c}") for c in SESSION_COLUMNS})
        .merge()
    )

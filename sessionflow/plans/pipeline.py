"""One batch from raw files to the session table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sessionflow.config import SessionConfig
from sessionflow.operators.candidates import (
    batch_partitions,
    from_dates,
    in_partitions,
    of_batch_pairs,
    prune_dates,
)
from sessionflow.operators.reconcile import is_loose, plan_reconciliation
from sessionflow.operators.session_days import (
    batch_bounds,
    days_before_batch,
    days_from_batch_on,
    days_of,
    renamed,
    session_dates,
    sessions_of,
    touched_sessions,
)
from sessionflow.operators.sessionize import identify_sessions
from sessionflow.operators.upsert import (
    commit_partitions,
    commit_staged,
    finish_commit,
    merge_into_table,
    merged_rows,
    stage_folder,
    stored_days,
    write_staged,
)
from sessionflow.schema import EVENT_KEY, PAIR, PARTITIONS, SESSION_COLUMNS
from sessionflow.sources.events import read_events
from sessionflow.sources.files import archive_files, waiting_files, work_scope
from sessionflow.sources.table import read_session_table

# Files of one group of a backlog.
MAX_FILES = 10_000

Written = Callable[[DataFrame, str], DataFrame]


@dataclass(frozen=True)
class BatchStats:
    events: int
    sessions: int


@dataclass(frozen=True)
class Changes:
    """What a batch does to the table: rows to upsert, the sessions among them, renamed sessions."""

    rows: DataFrame
    touched: DataFrame
    id_changes: DataFrame | None
    stats: BatchStats


def process_batch(
    spark: SparkSession,
    new_events: DataFrame,
    table_path: str | None = None,
    cfg: SessionConfig = SessionConfig(),
    table_name: str | None = None,
) -> BatchStats:
    """Sessionize a batch of normalized events, reconcile it with the table and upsert it.

    The table is a Parquet folder, or with ``table_name`` a catalog table with row-level operations,
    which is updated by one MERGE. Applying the same batch again changes nothing.

    The batch is read once, and results that are used more than once are written, all under
    ``spark.checkpoint.dir``: they outlive lost executors, cut the lineage to the table that is
    about to be rewritten, and have a known size.
    """
    if (table_path is None) == (table_name is None):
        raise ValueError("give either table_path or table_name")
    with work_scope(spark, "batch") as work:

        def written(rows: DataFrame, name: str) -> DataFrame:
            rows.write.parquet(f"{work}/{name}")
            return spark.read.schema(rows.schema).parquet(f"{work}/{name}")

        batch = written(new_events, "events")
        if batch.isEmpty():
            return BatchStats(0, 0)
        if table_name is not None:
            changes = _catalog_changes(spark.table(table_name), batch, cfg, written)
            merge_into_table(changes.rows, table_name, unique_keys=True)
            return changes.stats
        finish_commit(spark, table_path)
        stored = read_session_table(spark, table_path, batch.schema["user_id"].dataType)
        if stored is None:
            rows, staged = identify_sessions(batch, cfg), stage_folder(table_path)
            write_staged(rows, f"{staged}/rows")
            rows = spark.read.schema(rows.schema).parquet(f"{staged}/rows")
            changes = _changes(rows, None, cfg, written)
            write_staged(days_of(changes.touched), f"{staged}/days")
            commit_staged(spark, table_path, staged, rows.schema, cfg.user_actions)
            return changes.stats
        known = stored_days(spark, table_path, stored, cfg.user_actions)
        changes = _table_changes(stored, known, batch, cfg, written)
        # What the table has as it is needs no write, as after a batch that is applied again.
        changed = changes.rows.where("changed")
        partitions = written(changed.select(*PARTITIONS).distinct(), "partitions")
        if partitions.isEmpty():
            return changes.stats
        touched = in_partitions(changes.touched, partitions)
        target = merged_rows(in_partitions(stored, partitions), changed, flagged=True)
        days = renamed(in_partitions(known, partitions), changes.id_changes, touched)
        commit_partitions(spark, target, table_path, days, cfg.user_actions)
        return changes.stats


def _changes(
    rows: DataFrame, id_changes: DataFrame | None, cfg: SessionConfig, written: Written
) -> Changes:
    """Events are observed while the days of the rows are written, and sessions counted from these."""
    seen = Observation("batch")
    touched = written(
        touched_sessions(rows, cfg).observe(seen, F.sum("events").alias("events")), "touched"
    )
    sessions = touched.where("session_id is not null").select(*PAIR, "session_id").distinct()
    stats = BatchStats(seen.get["events"] or 0, sessions.count())
    return Changes(rows, touched, id_changes, stats)


def _table_changes(
    stored: DataFrame, days: DataFrame, batch: DataFrame, cfg: SessionConfig, written: Written
) -> Changes:
    """Stored sessions come from the day table. Events are read from three places only: partitions
    of the batch's own events, partitions in which its pairs have events whose id must be found
    anew, and, if sessions are renamed, the partitions in which they have rows."""
    own = batch_partitions(batch)
    if cfg.idle_cutoff:
        dates = prune_dates(batch, cfg)
        near = written(of_batch_pairs(in_partitions(days, dates), batch), "near")
        sessions = sessions_of(near)
        loose_days = near.where("session_id is null")
    else:
        # An id reaches any later event, and the last one before the batch comes into it.
        dates = None
        bounds = written(batch_bounds(batch), "bounds")
        near = written(days_from_batch_on(days, bounds, cfg), "near")
        sessions = sessions_of(near.unionByName(days_before_batch(days, bounds)))
        loose_days = near
    wanted = own.unionByName(loose_days.select("product_code", "event_date")).distinct()
    again = batch.select(*EVENT_KEY).distinct().withColumn("again", F.lit(True)).alias("again")
    same = F.lit(True)
    for c in EVENT_KEY:
        same = same & F.col(f"old.{c}").eqNullSafe(F.col(f"again.{c}"))
    pair_days = loose_days.select(*PAIR, "event_date").distinct().withColumn("its", F.lit(True))
    rows = (
        in_partitions(stored, wanted)
        .select(*SESSION_COLUMNS)
        .join(pair_days, [*PAIR, "event_date"], "left")
        .alias("old")
        .join(again, same, "left")
        .select(*(F.col(f"old.{c}") for c in SESSION_COLUMNS), "old.its", "again.again")
        .where("its or again")
    )
    rows = written(rows, "existing")
    plan = plan_reconciliation(batch, rows.where("its").where(is_loose(cfg)), cfg, sessions)
    plan = replace(plan, assigned=written(plan.assigned, "assigned"))
    id_changes = written(plan.existing_id_changes(), "changes")
    moved = in_partitions(stored, session_dates(near, dates, days, id_changes, cfg))
    found = plan.flagged_rows(moved, id_changes, rows.where("again"))
    return _changes(written(found, "rows"), id_changes, cfg, written)


def _catalog_changes(
    stored: DataFrame, batch: DataFrame, cfg: SessionConfig, written: Written
) -> Changes:
    """For a table whose commits are not made here: no day table, all from the stored rows."""
    dates = written(prune_dates(batch, cfg), "dates")
    first_dates = dates.groupBy("product_code").agg(F.min("event_date").alias("event_date"))
    if cfg.idle_cutoff:
        near = in_partitions(stored, dates)
    else:
        near = of_batch_pairs(
            from_dates(stored, first_dates.withColumn("event_date", F.lit(None).cast("date"))),
            batch,
        )
    plan = plan_reconciliation(batch, near, cfg)
    plan = replace(plan, assigned=written(plan.assigned, "assigned"))
    id_changes = written(plan.existing_id_changes(), "changes")
    # A renamed session starts near the batch, but may go on after it.
    products = id_changes.select("product_code").distinct()
    moved = from_dates(stored, first_dates.join(products, "product_code", "left_semi"))
    return _changes(written(plan.rows(moved, id_changes), "rows"), id_changes, cfg, written)


def run_batch(
    spark: SparkSession,
    raw_path: str,
    table_path: str | None = None,
    archive_dir: str | None = None,
    cfg: SessionConfig = SessionConfig(),
    table_name: str | None = None,
    max_files: int = MAX_FILES,
) -> BatchStats:
    """Process all files that wait in ``raw_path`` and move them to ``archive_dir``.

    A long backlog is worked on in groups of ``max_files`` files in order of their time, each
    upserted and moved before the next one is read; the statistics add up the groups, so a session
    that several of them touch counts with each. No waiting file, or no folder yet, is no work. The
    table is written before the files move, and a crash in between only means that a group is
    applied once more.
    """
    events = sessions = 0
    for waiting in waiting_files(spark, raw_path, max_files):
        stats = process_batch(spark, read_events(spark, waiting), table_path, cfg, table_name)
        events, sessions = events + stats.events, sessions + stats.sessions
        if archive_dir is not None:
            archive_files(spark, waiting, archive_dir)
    return BatchStats(events, sessions)

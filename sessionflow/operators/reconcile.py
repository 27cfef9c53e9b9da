"""Merging a new batch with the sessions stored so far.

Stored sessions take part as intervals, one row each, and only events without a session take
part one by one: a session never loses a row when events are added, it can only be extended
or merged into an earlier one. So stored rows are aggregated to sessions before they are
shuffled, and are read again only for sessions that do get another id.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionflow.config import SessionConfig
from sessionflow.functions import (
    epoch,
    is_user_action,
    make_session_id,
    user_action_filter,
    utc_date,
)
from sessionflow.operators.assign import (
    as_items,
    assign_sessions,
    hot_pairs,
    without_copies,
)
from sessionflow.operators.candidates import of_batch_pairs
from sessionflow.operators.sessionize import identify_sessions
from sessionflow.schema import EVENT_KEY, PAIR, SESSION_COLUMNS
from sessionflow.sources.files import new_work_path

NEW, LOOSE, STORED = "new", "loose", "stored"


def is_loose(cfg: SessionConfig) -> Column:
    """Stored rows whose id must be found anew, and not through their session's id.

    Without the idle cutoff a product event belongs to whatever session came last, so a late
    user action can take it out of the session it was in.
    """
    loose = F.col("session_id").isNull()
    if not cfg.idle_cutoff:
        loose = loose | ~is_user_action(cfg)
    return loose


def _with_date(rows: DataFrame) -> DataFrame:
    return rows.withColumn("event_date", utc_date(epoch("timestamp"))).select(*SESSION_COLUMNS)


@dataclass(frozen=True)
class Reconciliation:
    """The plan for one batch; nothing of it runs before an action.

    ``assigned`` has one row for each event of the batch (kind new), for each stored row near
    it that is bound to no session (kind loose), and for each stored session near it (kind
    stored): the id it had, ``old_id``, and the id it gets, ``session_id``.
    """

    assigned: DataFrame
    existing: DataFrame
    cfg: SessionConfig

    def written(self) -> Reconciliation:
        """The same with ``assigned`` written and read back."""
        spark = self.assigned.sparkSession
        path = new_work_path(spark, "assigned")
        self.assigned.write.parquet(path)
        return replace(self, assigned=spark.read.schema(self.assigned.schema).parquet(path))

    def labelled_rows(self) -> DataFrame:
        """The batch with its final ids, and stored rows that get a session only now (or
        another one, without idle cutoff)."""
        same_id = F.col("session_id").eqNullSafe(F.col("old_id"))
        return self.assigned.where(
            (F.col("kind") == NEW) | ((F.col("kind") == LOOSE) & ~same_id)
        ).select(*EVENT_KEY, "session_id")

    def existing_id_changes(self) -> DataFrame:
        """Stored sessions that get another id, one row each."""
        return self.assigned.where(
            (F.col("kind") == STORED) & (F.col("session_id") != F.col("old_id"))
        ).select(
            *PAIR,
            F.col("old_id").alias("original_session_id"),
            F.col("session_id").alias("final_session_id"),
        )

    def moved_rows(
        self, stored: DataFrame | None = None, id_changes: DataFrame | None = None
    ) -> DataFrame:
        """All rows of those sessions, looked up in ``stored`` (default: the existing rows).

        ``id_changes`` may be a written copy of ``existing_id_changes``: Spark then knows its
        size and broadcasts it if it is small.
        """
        rows = self.existing if stored is None else stored
        changes = self.existing_id_changes() if id_changes is None else id_changes
        changes = changes.withColumnRenamed("original_session_id", "session_id")
        return (
            rows.where(~is_loose(self.cfg))
            .select(*EVENT_KEY, "session_id")
            .join(changes, [*PAIR, "session_id"])
            .select(*EVENT_KEY, F.col("final_session_id").alias("session_id"))
        )

    def rows(
        self, stored: DataFrame | None = None, id_changes: DataFrame | None = None
    ) -> DataFrame:
        """Rows to upsert: the batch and every stored row whose id changes.

        An event that was stored before and is delivered again is one row.
        """
        found = self.labelled_rows().unionByName(self.moved_rows(stored, id_changes))
        return _with_date(found.groupBy(*EVENT_KEY).agg(F.min("session_id").alias("session_id")))

    def flagged_rows(
        self, stored: DataFrame, id_changes: DataFrame, delivered_again: DataFrame
    ) -> DataFrame:
        """The same with ``inserted``: whether no stored row has the event's key, and ``changed``: whether
        the table does not have the row as it is.

        ``delivered_again`` are the stored rows whose keys the batch has. The flags ride on the
        aggregation that makes the rows unique, so no join looks for their keys.
        """
        is_new = F.col("kind") == NEW
        none = F.lit(None).cast("struct<id: string>").alias("had")
        labelled = self.assigned.where(
            is_new
            | ((F.col("kind") == LOOSE) & ~F.col("session_id").eqNullSafe(F.col("old_id")))
        ).select(*EVENT_KEY, "session_id", is_new.alias("inserted"), none)
        no = F.lit(False).alias("inserted")
        again = delivered_again.select(
            *EVENT_KEY,
            F.lit(None).cast("string").alias("session_id"),
            no,
            F.struct(F.col("session_id").alias("id")).alias("had"),
        )
        moved = self.moved_rows(stored, id_changes).select(*EVENT_KEY, "session_id", no, none)
        found = labelled.unionByName(moved).unionByName(again).groupBy(*EVENT_KEY).agg(
            F.min("session_id").alias("session_id"),
            F.bool_and("inserted").alias("inserted"),
            # stored copies may disagree
            F.min("had").alias("least"),
            F.max("had").alias("most"),
        )
        own = F.struct(F.col("session_id").alias("id"))
        kept = F.col("least").eqNullSafe(own) & F.col("most").eqNullSafe(own)
        return found.withColumns(
            {"event_date": utc_date(epoch("timestamp")), "changed": ~kept}
        ).select(*SESSION_COLUMNS, "inserted", "changed")


def plan_reconciliation(
    new_events: DataFrame,
    existing: DataFrame,
    cfg: SessionConfig = SessionConfig(),
    sessions: DataFrame | None = None,
) -> Reconciliation:
    """``new_events`` are raw or sessionized rows of the batch, ``existing`` stored rows that
    include every row within the timeout's reach of the batch (more rows do no harm). With
    ``sessions``, the stored sessions (user_id, product_code, session_id, t, hi) within reach, only
    rows whose id must be found anew are needed."""
    if sessions is None:
        sessions = (
            existing.where(user_action_filter(cfg) & F.col("session_id").isNotNull())
            .groupBy(*PAIR, "session_id")
            .agg(F.min(epoch("timestamp")).alias("t"), F.max(epoch("timestamp")).alias("hi"))
        )
    sessions = of_batch_pairs(sessions, new_events)
    loose = of_batch_pairs(
        existing.where(is_loose(cfg)).select(*EVENT_KEY, "session_id"), new_events
    )
    no_id = F.lit(None).cast("string")

    events = (
        new_events.select(*EVENT_KEY)
        .withColumns({"kind": F.lit(NEW), "old_id": no_id})
        .unionByName(
            loose.withColumnRenamed("session_id", "old_id").withColumn("kind", F.lit(LOOSE))
        )
    )
    intervals = sessions.select(
        *PAIR,
        no_id.alias("event_id"),
        F.timestamp_seconds("t").alias("timestamp"),
        F.lit(STORED).alias("kind"),
        F.col("session_id").alias("old_id"),
        "t",
        "hi",
        F.col("session_id").alias("stored_id"),
    )
    items = as_items(events, cfg).withColumn("stored_id", no_id).unionByName(intervals)
    hot = hot_pairs(new_events.select(*PAIR).unionByName(loose.select(*PAIR)), cfg)
    assigned = assign_sessions(
        without_copies(items, hot), cfg, hot, with_stored=True, with_copies=items
    ).select(
        *EVENT_KEY,
        "kind",
        "old_id",
        F.when(
            F.col("in_session"), F.coalesce("start_id", make_session_id(F.col("start_t")))
        ).alias("session_id"),
    )
    return Reconciliation(assigned, existing, cfg)


def reconcile_sessions(
    new_events: DataFrame,
    existing: DataFrame,
    cfg: SessionConfig = SessionConfig(),
    stored: DataFrame | None = None,
) -> DataFrame:
    """Rows to upsert for a batch.

    Sessions that become connected are merged, over any number of links, and the id at the
    earliest user action survives. ``stored`` may name a wider set of rows in which the rows
    of renamed sessions are looked up.

    The assignment is needed for the batch and for the stored sessions; it is written once under
    ``spark.checkpoint.dir`` and read twice.
    """
    return plan_reconciliation(new_events, existing, cfg).written().rows(stored)


def _alone_and_final(
    new_events: DataFrame, existing: DataFrame, cfg: SessionConfig
) -> DataFrame:
    """Each event of the batch with its id in the batch alone and its final id."""
    alone = identify_sessions(new_events, cfg).withColumnRenamed("session_id", "alone_id")
    final = plan_reconciliation(new_events, existing, cfg).assigned.where(F.col("kind") == NEW)
    final = final.select(*(F.col(c).alias(f"its_{c}") for c in EVENT_KEY), "session_id")
    same_event = F.lit(True)
    for c in EVENT_KEY:
        same_event = same_event & F.col(c).eqNullSafe(F.col(f"its_{c}"))
    return alone.join(final, same_event).drop(*(f"its_{c}" for c in EVENT_KEY))


def new_id_changes(
    new_events: DataFrame, existing: DataFrame, cfg: SessionConfig = SessionConfig()
) -> DataFrame:
    """Sessions of the batch taken alone that get another id with the stored ones."""
    return (
        _alone_and_final(new_events, existing, cfg)
        .where("alone_id <> session_id")
        .select(
            *PAIR,
            F.col("alone_id").alias("original_session_id"),
            F.col("session_id").alias("final_session_id"),
        )
        .distinct()
    )


def adopted_rows(
    new_events: DataFrame, existing: DataFrame, cfg: SessionConfig = SessionConfig()
) -> DataFrame:
    """Events of the batch that have no session in the batch alone, but have one with the
    stored sessions."""
    return (
        _alone_and_final(new_events, existing, cfg)
        .where("alone_id is null and session_id is not null")
        .select(*SESSION_COLUMNS)
    )

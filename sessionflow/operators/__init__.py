from sessionflow.operators.bounds import session_bounds, sessions_by_user
from sessionflow.operators.candidates import (
    existing_candidates,
    in_partitions,
    of_batch_pairs,
    partition_filter,
    prune_dates,
    read_existing_sessions,
)
from sessionflow.operators.overlap import overlap_decision, overlap_pairs
from sessionflow.operators.reconcile import (
    adopted_rows,
    new_id_changes,
    plan_reconciliation,
    reconcile_sessions,
)
from sessionflow.operators.sessionize import distinct_events, identify_sessions, user_activity
from sessionflow.operators.stats import batch_stats
from sessionflow.operators.upsert import merge_into_table, upsert_sessions

__all__ = [
    "adopted_rows",
    "batch_stats",
    "distinct_events",
    "existing_candidates",
    "identify_sessions",
    "in_partitions",
    "merge_into_table",
    "new_id_changes",
    "of_batch_pairs",
    "overlap_decision",
    "overlap_pairs",
    "partition_filter",
    "plan_reconciliation",
    "prune_dates",
    "read_existing_sessions",
    "reconcile_sessions",
    "session_bounds",
    "sessions_by_user",
    "upsert_sessions",
    "user_activity",
]

"""Which new session touches which stored session, and whose id is kept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionflow.config import SessionConfig
from sessionflow.functions import epoch, slice_of, user_action_filter
from sessionflow.operators.bounds import session_bounds
from sessionflow.schema import PAIR

BIN_SECS = 3600


def _binned(sessions: DataFrame, prefix: str, cfg: SessionConfig, margin: int) -> DataFrame:
    """Sessions by their user actions, one row for each time bin they reach."""
    width = max(BIN_SECS, cfg.timeout_secs)
    low = epoch(f"{prefix}_session_min_time") - F.lit(margin)
    high = epoch(f"{prefix}_session_max_time") + F.lit(margin)
    return (
        session_bounds(sessions.where(user_action_filter(cfg)), prefix)
        .where(f"{prefix}_session_id is not null")
        .drop(f"{prefix}_min_date", f"{prefix}_max_date")
        .withColumn(f"{prefix}_bin", slice_of(low, width))
        .withColumn("bin", F.explode(F.sequence(slice_of(low, width), slice_of(high, width))))
    )


def _touching(
    new_sessions: DataFrame, existing_sessions: DataFrame, cfg: SessionConfig, how: str
) -> DataFrame:
    """New sessions by bin, joined with the stored ones whose gap is at most the timeout."""
    new = _binned(new_sessions, "new", cfg, cfg.timeout_secs).alias("new")
    existing = _binned(existing_sessions, "existing", cfg, 0).alias("existing")
    same_bin = F.lit(True)
    for c in (*PAIR, "bin"):
        same_bin = same_bin & (F.col(f"new.{c}") == F.col(f"existing.{c}"))
    to_start = epoch("existing_session_min_time") - epoch("new_session_max_time")
    from_end = epoch("new_session_min_time") - epoch("existing_session_max_time")
    near = (
        (F.col("new.bin") == F.greatest("new_bin", "existing_bin"))
        & (to_start <= F.lit(cfg.timeout_secs))
        & (from_end <= F.lit(cfg.timeout_secs))
    )
    return new.join(existing, same_bin & near, how).select(
        *(F.col(f"new.{c}") for c in PAIR), *NEW, *EXISTING
    )


NEW = [f"new_session_{x}" for x in ("id", "min_time", "max_time")]
EXISTING = [f"existing_session_{x}" for x in ("id", "min_time", "max_time")]


def overlap_pairs(
    new_sessions: DataFrame, existing_sessions: DataFrame, cfg: SessionConfig = SessionConfig()
) -> DataFrame:
    """Pairs of a new and a stored session whose gap is at most the timeout.

    A session lasts from its first to its last user action; product events in it or after it do
    not prolong it, as in ``reconcile_sessions``.

    An interval join on time bins: both sides list the bins they reach, the join key is
    (user, product, bin), and a pair is emitted in the first bin it has in common. Sessions of
    one side are more than a timeout apart, so a bin holds few of them even for a pair of
    user and product with very many sessions.
    """
    return _touching(new_sessions, existing_sessions, cfg, "inner")


def overlap_decision(
    new_sessions: DataFrame, existing_sessions: DataFrame, cfg: SessionConfig = SessionConfig()
) -> DataFrame:
    """Relation of each new session to the stored sessions it touches.

    A new session that touches none has one row with NULL on the stored side and keeps its id.
    The earlier start wins, a tie keeps the stored id.
    """
    found = F.when(F.col("existing_session_id").isNotNull(), F.struct(*EXISTING))
    decided = (
        _touching(new_sessions, existing_sessions, cfg, "left")
        # the stored sessions that one new session touches; NULLs of other bins are not collected
        .groupBy(*PAIR, *NEW)
        .agg(F.collect_list(found).alias("found"))
        .select(*PAIR, *NEW, F.explode_outer("found").alias("x"))
        .select(*PAIR, *NEW, "x.*")
        .withColumns(
            {
                "time_to_existing_start": epoch("existing_session_min_time")
                - epoch("new_session_max_time"),
                "time_from_existing_end": epoch("new_session_min_time")
                - epoch("existing_session_max_time"),
            }
        )
    )
    no = F.lit(False)
    extends = F.col("time_from_existing_end").between(0, cfg.timeout_secs)
    precedes = F.col("time_to_existing_start").between(0, cfg.timeout_secs)
    overlaps = (F.col("time_to_existing_start") <= 0) & (F.col("time_from_existing_end") <= 0)
    earlier = F.col("new_session_min_time") < F.col("existing_session_min_time")
    return decided.withColumns(
        {
            "extends_existing_session": F.coalesce(extends, no),
            "precedes_existing_session": F.coalesce(precedes, no),
            "overlaps_existing_session": F.coalesce(overlaps, no),
            "is_earlier_start": F.coalesce(earlier, no),
            "final_session_id": F.when(earlier, F.col("new_session_id")).otherwise(
                F.coalesce("existing_session_id", "new_session_id")
            ),
        }
    )

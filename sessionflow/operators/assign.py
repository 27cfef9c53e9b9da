"""The session rule, applied to events and to sessions that are stored already."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionflow.config import SessionConfig
from sessionflow.functions import epoch, is_user_action, slice_of
from sessionflow.operators.timeline import carried_state
from sessionflow.schema import PAIR
from sessionflow.sources.files import new_work_path

# More hot pairs than this are not put into the plan as local rows.
MAX_LOCAL_PAIRS = 10_000
# Rows without a complete key need no window; they are spread over so many lanes.
NULL_LANES = 1024


def hot_pairs(events: DataFrame, cfg: SessionConfig) -> DataFrame | None:
    """Pairs with more than ``split_rows`` events, or None if there is none.

    Runs a count by pair, which shuffles one row per pair and task. The list is fetched with
    a check of its length and broadcast; a longer list is written once and read where it is
    needed, joined as Spark sees fit.
    """
    hot = (
        events.groupBy(*PAIR)
        .agg(F.count(F.lit(1)).alias("events"))
        .where(F.col("events") > F.lit(cfg.split_rows))
        .select(*PAIR)
    )
    found = hot.limit(MAX_LOCAL_PAIRS + 1).collect()
    if not found:
        return None
    if len(found) > MAX_LOCAL_PAIRS:
        spark = events.sparkSession
        path = new_work_path(spark, "hot-pairs")
        hot.write.parquet(path)
        return spark.read.schema(hot.schema).parquet(path)
    return F.broadcast(events.sparkSession.createDataFrame(found, hot.schema))


def lane() -> Column:
    """0, or for rows with a NULL user, product or time one of many numbers, fixed by the row.

    Such rows belong to no session. Without lanes all rows of, say, the NULL user would meet
    in one task.
    """
    incomplete = (
        F.col("user_id").isNull() | F.col("product_code").isNull() | F.col("timestamp").isNull()
    )
    own = F.pmod(F.xxhash64("user_id", "product_code", "timestamp", "event_id"), F.lit(NULL_LANES))
    return F.when(incomplete, own + 1).otherwise(F.lit(0).cast("bigint"))


def without_copies(rows: DataFrame, hot: DataFrame | None) -> DataFrame:
    """Distinct rows, laid out for the windows of ``assign_sessions``.

    Without a hot pair one shuffle by pair serves both. A hot pair may be hot because of copies,
    so these are collapsed map-side first, and the shuffle by slice comes after.
    """
    if hot is not None:
        return rows.distinct()
    return rows.withColumn("lane", lane()).repartition(*PAIR, "lane").distinct()


def as_items(events: DataFrame, cfg: SessionConfig) -> DataFrame:
    """Adds ``t``, the time in epoch seconds, and ``hi``, the same for user actions only."""
    t = epoch("timestamp")
    return events.withColumns({"t": t, "hi": F.when(is_user_action(cfg), t)})


def assign_sessions(
    items: DataFrame,
    cfg: SessionConfig,
    hot: DataFrame | None,
    with_stored: bool = False,
    with_copies: DataFrame | None = None,
) -> DataFrame:
    """Find the session of each item. Items are

    events           ``t`` is the time, ``hi`` the same for a user action, else NULL
    stored sessions  with ``with_stored``: ``t`` is the first and ``hi`` the last known user
                     action, ``stored_id`` the id (NULL for events)

    Columns added:

    last_user_t, prev_user_t  latest user action at or before, and strictly before the item
    start_t                   start of the last session at or before the item
    start_id                  stored id of that session, with ``with_stored``
    in_session                whether the item belongs to that session

    A pair is one window partition, sorted by time. A hot pair is one partition per slice, and
    what lies before a slice is joined to its rows; that join and the windows share one
    shuffle. Frames are by value of ``t``, so the order of items in one second is irrelevant.

    ``with_copies`` may give the items as they were before copies were removed. The state
    before a slice is the same and needs no shuffle of events when taken from there.
    """
    keys = [*PAIR, "lane"]
    if "lane" not in items.columns:
        own_lane = lane() if "timestamp" in items.columns else F.lit(0).cast("bigint")
        items = items.withColumn("lane", own_lane)
    before_t = before = None
    if hot is not None:
        named = hot.select(*(F.col(c).alias(f"hot_{c}") for c in PAIR))
        same_pair = F.lit(True)
        for c in PAIR:
            same_pair = same_pair & F.col(c).eqNullSafe(F.col(f"hot_{c}"))
        source = items if with_copies is None else with_copies
        state = carried_state(
            source.where("user_id is not null and product_code is not null and t is not null").join(
                hot, PAIR, "left_semi"
            ),
            cfg,
            with_stored,
        )
        items = items.join(named.withColumn("hot", F.lit(True)), same_pair, "left").withColumn(
            "slice", F.when(F.col("hot"), slice_of(F.col("t"), cfg.slice_secs))
        )
        items = items.drop("hot", *(f"hot_{c}" for c in PAIR)).join(
            state, [*PAIR, "slice"], "left"
        )
        keys.append("slice")
        before_t, before = F.col("before_t"), F.col("before")

    by_time = Window.partitionBy(*keys).orderBy("t")
    so_far = by_time.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = by_time.rangeBetween(Window.unboundedPreceding, -1)
    same = by_time.rangeBetween(Window.currentRow, Window.currentRow)

    def at_least(found, carried):
        return found if carried is None else F.greatest(found, carried)

    columns = {
        "last_user_t": at_least(F.max("hi").over(so_far), before_t),
        "prev_user_t": at_least(F.max("hi").over(earlier), before_t),
    }
    opener = F.col("t")
    if with_stored:
        columns["first_id"] = F.min("stored_id").over(same)
        opener = F.struct(F.col("t").alias("start"), F.col("first_id").alias("stored_id"))
    opened = F.when(
        F.col("hi").isNotNull()
        & (
            F.col("prev_user_t").isNull()
            | (F.col("t") - F.col("prev_user_t") > F.lit(cfg.timeout_secs))
        ),
        opener,
    )
    found = items.withColumns(columns).withColumn("opened", opened)
    found = found.withColumn("start", at_least(F.max("opened").over(so_far), before))
    start = F.col("start")
    in_session = start.isNotNull()
    if cfg.idle_cutoff:
        in_session = in_session & (
            F.col("t") - F.col("last_user_t") <= F.lit(cfg.timeout_secs)
        )
    has_pair = F.col("user_id").isNotNull() & F.col("product_code").isNotNull()
    result = {
        "last_user_t": F.when(has_pair, F.col("last_user_t")),
        "prev_user_t": F.when(has_pair, F.col("prev_user_t")),
        "start_t": F.when(has_pair, start["start"] if with_stored else start),
        "in_session": F.coalesce(has_pair & in_session, F.lit(False)),
    }
    if with_stored:
        result["start_id"] = start["stored_id"]
    kept = [c for c in items.columns if c not in ("lane", "slice", "before_t", "before")]
    return found.select(*kept, *(column.alias(name) for name, column in result.items()))

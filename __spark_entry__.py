"""Queries over the driver's tables, and the SQL their results must equal.

The ``events`` table plays the raw event batches: ``event_id`` is its event type, the product
code is derived from ``props``. Each event arrives up to four days after it happened, so the
table splits into what has been stored before the cut date and what arrives after it. The
events are sparse, so sessions break after six hours by default.
"""

from __future__ import annotations

import logging
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from sessionflow import SessionConfig
from sessionflow.functions import epoch, is_user_action, utc_date, zoneless_seconds
from sessionflow.operators import (
    adopted_rows,
    batch_stats,
    existing_candidates,
    identify_sessions,
    new_id_changes,
    overlap_decision,
    overlap_pairs,
    plan_reconciliation,
    prune_dates,
    reconcile_sessions,
    session_bounds,
    sessions_by_user,
    user_activity,
)
from sessionflow.operators.sessionize import distinct_events
from sessionflow.plans import process_batch, run_batch
from sessionflow.schema import EVENT_KEY
from sessionflow.sources import (
    new_work_path,
    normalize_events,
    read_session_table,
    stream_events,
)
from sessionflow.streaming import session_windows, start_session_stream

try:
    import corpus_pipeline
    import sessionflow.llm.queries as llm_queries
except ImportError as missing:
    # The other queries need neither the subpackage nor its libraries.
    logging.getLogger(__name__).warning("queries of sessionflow.llm are left out: %s", missing)
    corpus_pipeline = llm_queries = None

ACTIONS = ("click", "purchase", "view")
NULLED_EVENT = "signup"
CUT = "2024-01-20"
LATE_DAYS = 5
CONFIG = SessionConfig(timeout_secs=21600, user_actions=ACTIONS)
CONFIG_300S = SessionConfig(timeout_secs=300, user_actions=ACTIONS)
CONFIG_NO_CUTOFF = SessionConfig(timeout_secs=21600, user_actions=ACTIONS, idle_cutoff=False)


# --- inputs ---------------------------------------------------------------------------------


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events with the date on which they arrive."""
    happened = F.timestamp_seconds(zoneless_seconds("ts"))
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "user_id",
        F.col("event_type").alias("event_id"),
        happened.alias("timestamp"),
        F.concat(
            F.lit("P"), (F.get_json_object("props", "$.k").cast("int") % 3).cast("string")
        ).alias("product_code"),
        F.date_add(utc_date(epoch(happened)), (F.col("event_id") % 5).cast("int")).alias(
            "arrival_date"
        ),
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_events(arrivals(spark, sf_dir))


def stored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_events(arrivals(spark, sf_dir).where(F.col("arrival_date") <= F.lit(CUT)))


def late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_events(arrivals(spark, sf_dir).where(F.col("arrival_date") > F.lit(CUT)))


def stored_sessions(spark: SparkSession, sf_dir: str, cfg: SessionConfig = CONFIG) -> DataFrame:
    """The sessions of the earlier arrivals, written and read back as stored rows are."""
    path = new_work_path(spark, "stored")
    rows = identify_sessions(stored_events(spark, sf_dir), cfg)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


# --- result shape ---------------------------------------------------------------------------


def with_seconds(rows: DataFrame) -> DataFrame:
    """Timestamps as epoch seconds: ``timestamp`` becomes ``t``, other names stay."""
    columns = []
    for field in rows.schema:
        column = F.col(field.name)
        if field.dataType.typeName() == "timestamp":
            column = F.unix_seconds(column)
        columns.append(column.alias("t" if field.name == "timestamp" else field.name))
    return rows.select(*columns)


def activity(*columns: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = user_activity(raw_events(spark, sf_dir), CONFIG)
        return rows.select("user_id", "product_code", "event_id", "t", *columns)

    return query


def sessions(cfg: SessionConfig) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return with_seconds(identify_sessions(raw_events(spark, sf_dir), cfg))

    return query


# --- queries --------------------------------------------------------------------------------


def events_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw_events(spark, sf_dir)
    return with_seconds(rows.withColumn("event_date", utc_date(epoch("timestamp"))))


def user_action_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = distinct_events(raw_events(spark, sf_dir))
    return with_seconds(rows.withColumn("is_user_event", is_user_action(CONFIG)))


def bounds_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = identify_sessions(raw_events(spark, sf_dir), CONFIG)
    return with_seconds(session_bounds(rows, "new"))


def sessions_by_user_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = identify_sessions(raw_events(spark, sf_dir), CONFIG)
    return with_seconds(sessions_by_user(rows))


def prune_dates_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prune_dates(late_events(spark, sf_dir), CONFIG)


def existing_candidates_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = existing_candidates(
        stored_sessions(spark, sf_dir), late_events(spark, sf_dir), CONFIG
    )
    return with_seconds(rows)


def overlap_pairs_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = identify_sessions(late_events(spark, sf_dir), CONFIG)
    return with_seconds(overlap_pairs(new, stored_sessions(spark, sf_dir), CONFIG))


def overlap_decision_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = identify_sessions(late_events(spark, sf_dir), CONFIG)
    return with_seconds(overlap_decision(new, stored_sessions(spark, sf_dir), CONFIG))


def changed_new_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return new_id_changes(late_events(spark, sf_dir), stored_sessions(spark, sf_dir), CONFIG)


def changed_existing_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = plan_reconciliation(
        late_events(spark, sf_dir), stored_sessions(spark, sf_dir), CONFIG
    )
    return plan.existing_id_changes()


def adopted_rows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adopted_rows(late_events(spark, sf_dir), stored_sessions(spark, sf_dir), CONFIG)
    return with_seconds(rows)


def adopted_rows_null_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where one product event has no event id."""
    late = late_events(spark, sf_dir).withColumn(
        "event_id", F.nullif("event_id", F.lit(NULLED_EVENT))
    )
    return with_seconds(adopted_rows(late, stored_sessions(spark, sf_dir), CONFIG))


def reconciled(cfg: SessionConfig) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        existing = stored_sessions(spark, sf_dir, cfg)
        return with_seconds(reconcile_sessions(late_events(spark, sf_dir), existing, cfg))

    return query


def table_rows(spark: SparkSession, path: str) -> DataFrame:
    return with_seconds(read_session_table(spark, path, LongType()))


def upserted(
    replays: int, cfg: SessionConfig = CONFIG
) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = new_work_path(spark, "table")
        process_batch(spark, stored_events(spark, sf_dir), path, cfg)
        for _ in range(1 + replays):
            process_batch(spark, late_events(spark, sf_dir), path, cfg)
        return table_rows(spark, path)

    return query


def upsert_keeps_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column that only the files of one product have, after a batch into all products."""
    path = new_work_path(spark, "table")
    rows = identify_sessions(stored_events(spark, sf_dir), CONFIG)
    noted = rows.where("product_code = 'P0'").withColumn(
        "note", F.concat("event_id", F.lit("!"))
    )
    for part in (noted, rows.where("product_code <> 'P0'")):
        part.write.mode("append").partitionBy("product_code", "event_date").parquet(path)
    process_batch(spark, late_events(spark, sf_dir), path, CONFIG)
    return table_rows(spark, path)


def decision_agrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New and stored sessions that touch each other and nothing else: the id by the rule of the
    pair, and the id that reconciliation gives the rows of the new session."""
    late, existing = late_events(spark, sf_dir), stored_sessions(spark, sf_dir)
    new = identify_sessions(late, CONFIG)
    pair = ["user_id", "product_code"]
    decided = overlap_decision(new, existing, CONFIG).where("existing_session_id is not null")
    alone = decided
    for side in ("new_session_id", "existing_session_id"):
        once = decided.groupBy(*pair, side).agg(F.count(F.lit(1)).alias("n")).where("n = 1")
        alone = alone.join(once.drop("n"), [*pair, side], "left_semi")
    final = reconcile_sessions(late, existing, CONFIG)
    ids = (
        new.where("session_id is not null")
        .select(*EVENT_KEY, F.col("session_id").alias("new_session_id"))
        .join(final.select(*EVENT_KEY, "session_id"), EVENT_KEY)
        .where(is_user_action(CONFIG))
        .groupBy(*pair, "new_session_id")
        .agg(F.min("session_id").alias("reconciled_id"), F.max("session_id").alias("last_id"))
    )
    return alone.join(ids, [*pair, "new_session_id"]).select(
        *pair, "new_session_id", "final_session_id", "reconciled_id", "last_id"
    )


def batch_stats_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    existing = stored_sessions(spark, sf_dir)
    return batch_stats(reconcile_sessions(late_events(spark, sf_dir), existing, CONFIG))


def write_batches(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The events as arriving Parquet files: first those up to the cut, then the late ones."""
    stored_events(spark, sf_dir).write.mode("append").parquet(path)
    late_events(spark, sf_dir).write.mode("append").parquet(path)


def batch_files_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, path = new_work_path(spark, "raw"), new_work_path(spark, "table")
    archive = new_work_path(spark, "archive")
    for batch in (stored_events(spark, sf_dir), late_events(spark, sf_dir)):
        batch.withColumn("user_id", F.col("user_id").cast("string")).write.mode(
            "append"
        ).parquet(raw)
        run_batch(spark, raw, path, archive, CONFIG)
    rows = read_session_table(spark, path)
    return with_seconds(rows.withColumn("user_id", F.col("user_id").cast("bigint")))


def stream_upserted_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, path = new_work_path(spark, "raw"), new_work_path(spark, "table")
    write_batches(spark, sf_dir, raw)
    files = len(spark.read.parquet(raw).inputFiles())
    start_session_stream(
        spark,
        raw,
        path,
        checkpoint=new_work_path(spark, "checkpoint"),
        cfg=CONFIG,
        max_files_per_trigger=max(1, -(-files // 2)),
        user_type=LongType(),
    ).awaitTermination()
    return table_rows(spark, path)


def session_windows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_seconds(session_windows(raw_events(spark, sf_dir), CONFIG))


def stream_session_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions a stream has closed when all files are read: those before the watermark."""
    raw, closed = new_work_path(spark, "raw"), new_work_path(spark, "closed")
    # Files of one batch are in no order of time, so one trigger reads the whole first batch.
    stored_events(spark, sf_dir).write.parquet(raw)
    files = len(spark.read.parquet(raw).inputFiles())
    late_events(spark, sf_dir).write.mode("append").parquet(raw)
    events = stream_events(spark, raw, max_files_per_trigger=files, user_type=LongType())
    (
        session_windows(events, CONFIG, LATE_DAYS, append=True)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", closed)
        .option("checkpointLocation", new_work_path(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return with_seconds(spark.read.parquet(closed))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "events_normalized": events_normalized,
    "user_action_flag": user_action_flag,
    "last_user_action": activity("last_user_t"),
    "prev_user_action": activity("prev_user_t"),
    "inactivity_gap": activity("inactivity_gap"),
    "session_starts": activity("is_new_session"),
    "session_start_carry": activity("start_t"),
    "session_ids": sessions(CONFIG),
    "session_ids_300s": sessions(CONFIG_300S),
    "session_ids_no_cutoff": sessions(CONFIG_NO_CUTOFF),
    "session_bounds": bounds_query,
    "sessions_by_user": sessions_by_user_query,
    "prune_dates": prune_dates_query,
    "existing_candidates": existing_candidates_query,
    "overlap_pairs": overlap_pairs_query,
    "overlap_decision": overlap_decision_query,
    "changed_new_ids": changed_new_ids,
    "changed_existing_ids": changed_existing_ids,
    "adopted_rows": adopted_rows_query,
    "adopted_rows_null_event": adopted_rows_null_event,
    "decision_agrees": decision_agrees,
    "reconciled_rows": reconciled(CONFIG),
    "reconciled_rows_300s": reconciled(CONFIG_300S),
    "reconciled_rows_no_cutoff": reconciled(CONFIG_NO_CUTOFF),
    "batch_stats": batch_stats_query,
    "upserted_table": upserted(replays=0),
    "upserted_table_no_cutoff": upserted(replays=0, cfg=CONFIG_NO_CUTOFF),
    "upsert_replay": upserted(replays=1),
    "upsert_keeps_columns": upsert_keeps_columns,
    "batch_files_table": batch_files_table,
    "stream_upserted_table": stream_upserted_table,
    "session_windows": session_windows_query,
    "stream_session_windows": stream_session_windows,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: sessions of each user."""
    return sessions_by_user_query(spark, os.environ.get("ENTRY_SF_DIR", "/root/testdata/sf0.001"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    if llm_queries is None:
        return dict(QUERIES)
    return QUERIES | llm_queries.QUERIES | {"pipeline": corpus_pipeline.run}


# --- the same in SQL ------------------------------------------------------------------------

EVENTS_SQL = """
raw as (
  select user_id, event_type as event_id,
         cast(floor(epoch(ts)) as bigint) as t,
         'P' || cast(cast(regexp_extract(props, '[0-9]+') as integer) % 3 as varchar)
           as product_code,
         cast(ts as date) + cast(event_id % 5 as integer) as arrival_date
  from events
)"""

EVENT_COLUMNS = "user_id, product_code, event_id, t"
DATE_SQL = "cast(date '1970-01-01' + cast(t // 86400 as integer) as date)"


def sessions_sql(name: str, where: str, timeout: int = 21600, cutoff: bool = True) -> str:
    """CTEs that sessionize the raw events chosen by ``where`` in one go."""
    member = f"t - last_user_t <= {timeout}" if cutoff else "start_t is not null"
    actions = ", ".join(f"'{a}'" for a in ACTIONS)
    over = "over (partition by user_id, product_code order by t range between unbounded preceding"
    return f"""
{name}_e as (
  select distinct {EVENT_COLUMNS}, event_id in ({actions}) as u from raw where {where}
),
{name}_a as (
  select *,
         max(case when u then t end) {over} and 1 preceding) as prev_user_t,
         max(case when u then t end) {over} and current row) as last_user_t
  from {name}_e
),
{name}_b as (
  select *, coalesce(u and (prev_user_t is null or t - prev_user_t > {timeout}), false) as is_start
  from {name}_a
),
{name}_c as (
  select *, max(case when is_start then t end) {over} and current row) as start_t from {name}_b
),
{name} as (
  select {EVENT_COLUMNS},
         case when {member}
              then user_id || '#' || product_code || '#' || start_t end as session_id,
         {DATE_SQL} as event_date
  from {name}_c
)"""


def bounds_sql(name: str, prefix: str, source: str) -> str:
    return f"""
{name} as (
  select user_id, product_code, session_id as {prefix}_session_id,
         min(t) as {prefix}_session_min_time, max(t) as {prefix}_session_max_time,
         min(event_date) as {prefix}_min_date, max(event_date) as {prefix}_max_date
  from {source} group by user_id, product_code, session_id
)"""


def oracle_sql() -> dict[str, str]:
    found = session_sql()
    if llm_queries is not None:
        found |= llm_queries.SQL
        if corpus_pipeline.ORACLE_SQL is not None:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


def session_sql() -> dict[str, str]:
    all_rows = sessions_sql("final", "true")
    stored = sessions_sql("stored", f"arrival_date <= date '{CUT}'")
    late = sessions_sql("late", f"arrival_date > date '{CUT}'")
    actions_list = ", ".join(f"'{a}'" for a in ACTIONS)

    def with_ctes(*ctes: str, select: str) -> str:
        return "with " + ",".join([EVENTS_SQL, *ctes]) + "\n" + select

    def activity_sql(column: str) -> str:
        return with_ctes(all_rows, select=f"select {EVENT_COLUMNS}, {column} from final_c")

    def ids_sql(timeout: int, cutoff: bool = True) -> str:
        return with_ctes(sessions_sql("final", "true", timeout, cutoff), select="select * from final")

    def reconciled_sql(timeout: int = 21600, cutoff: bool = True) -> str:
        return with_ctes(
            sessions_sql("final", "true", timeout, cutoff),
            sessions_sql("stored", f"arrival_date <= date '{CUT}'", timeout, cutoff),
            f"""
late_keys as (
  select distinct {EVENT_COLUMNS} from raw where arrival_date > date '{CUT}'
),
reconciled as (
  select f.*
  from final f
  left join stored s using ({EVENT_COLUMNS})
  left join (select *, true as is_late from late_keys) l using ({EVENT_COLUMNS})
  where l.is_late or s.session_id is distinct from f.session_id
)""",
            select="",
        )

    pairs = [
        late,
        stored,
        bounds_sql("n", "new", f"late where event_id in ({actions_list})"),
        bounds_sql("x", "existing", f"stored where event_id in ({actions_list})"),
        """
pairs as (
  select n.user_id, n.product_code, new_session_id, new_session_min_time,
         new_session_max_time, existing_session_id, existing_session_min_time,
         existing_session_max_time
  from n join x
    on n.user_id = x.user_id and n.product_code = x.product_code
   and new_session_min_time - 21600 <= existing_session_max_time
   and new_session_max_time + 21600 >= existing_session_min_time
  where new_session_id is not null and existing_session_id is not null
)""",
    ]
    decided_ctes = """
, decided as (
  select n.user_id, n.product_code, n.new_session_id, n.new_session_min_time,
         n.new_session_max_time, existing_session_id, existing_session_min_time,
         existing_session_max_time,
         existing_session_min_time - n.new_session_max_time as time_to_existing_start,
         n.new_session_min_time - existing_session_max_time as time_from_existing_end
  from n left join pairs p
    on n.user_id = p.user_id and n.product_code = p.product_code
   and n.new_session_id = p.new_session_id
  where n.new_session_id is not null
),
flags as (
  select *,
         coalesce(time_from_existing_end between 0 and 21600, false) as extends_existing_session,
         coalesce(time_to_existing_start between 0 and 21600, false) as precedes_existing_session,
         coalesce(new_session_min_time <= existing_session_max_time
                  and new_session_max_time >= existing_session_min_time, false)
           as overlaps_existing_session,
         coalesce(new_session_min_time < existing_session_min_time, false) as is_earlier_start
  from decided
),
decision as (
select *,
       case when (overlaps_existing_session or precedes_existing_session) and is_earlier_start
            then new_session_id
            when overlaps_existing_session or extends_existing_session then existing_session_id
            else new_session_id end as final_session_id
from flags
)"""
    decision = decided_ctes + " select * from decision"
    agrees = (
        decided_ctes
        + f""",
touching as (
  select *, count(*) over (partition by user_id, product_code, new_session_id) as n_new,
         count(*) over (partition by user_id, product_code, existing_session_id) as n_existing
  from decision where existing_session_id is not null
),
ids as (
  select l.user_id, l.product_code, l.session_id as new_session_id,
         min(f.session_id) as reconciled_id, max(f.session_id) as last_id
  from late l join final f using ({EVENT_COLUMNS})
  where l.session_id is not null and l.event_id in ({actions_list})
  group by l.user_id, l.product_code, l.session_id
)
select t.user_id, t.product_code, t.new_session_id, final_session_id, reconciled_id, last_id
from touching t join ids i
  on t.user_id = i.user_id and t.product_code = i.product_code
 and t.new_session_id = i.new_session_id
where n_new = 1 and n_existing = 1"""
    )
    touched_dates = f"""
late_dates as (
  select distinct product_code, {DATE_SQL} as d from raw where arrival_date > date '{CUT}'
),
near_dates as (
  select distinct product_code, cast(d + o as date) as event_date
  from late_dates, (values (-1), (0), (1)) offsets(o)
)"""

    def changes_sql(source: str) -> str:
        return f"""
select distinct o.user_id, o.product_code, o.session_id as original_session_id,
       f.session_id as final_session_id
from {source} o join final f using ({EVENT_COLUMNS})
where o.session_id is not null and o.session_id <> f.session_id"""

    whole_table = with_ctes(all_rows, select="select * from final")
    windows_sql = with_ctes(
        f"""
actions as (
  select * from raw where event_id in ({", ".join(f"'{a}'" for a in ACTIONS)})
),
gaps as (
  select *, lag(t) over (partition by user_id, product_code order by t) as prev_t from actions
),
islands as (
  select *, sum(case when prev_t is null or t - prev_t > 21600 then 1 else 0 end)
              over (partition by user_id, product_code order by t
                    rows between unbounded preceding and current row) as island
  from gaps
),
windows as (
  select user_id, product_code, min(t) as session_start, max(t) + 21600 as session_end,
         count(distinct (event_id, t)) as actions
  from islands group by user_id, product_code, island
)""",
        select="",
    )
    actions = ", ".join(f"'{a}'" for a in ACTIONS)
    return {
        "events_normalized": with_ctes(
            select=f"select user_id, event_id, t, product_code, {DATE_SQL} as event_date from raw"
        ),
        "user_action_flag": with_ctes(
            select=f"select distinct {EVENT_COLUMNS}, event_id in ({actions}) as is_user_event "
            "from raw"
        ),
        "last_user_action": activity_sql("last_user_t"),
        "prev_user_action": activity_sql("prev_user_t"),
        "inactivity_gap": activity_sql("t - prev_user_t as inactivity_gap"),
        "session_starts": activity_sql("is_start as is_new_session"),
        "session_start_carry": activity_sql("start_t"),
        "session_ids": ids_sql(21600),
        "session_ids_300s": ids_sql(300),
        "session_ids_no_cutoff": ids_sql(21600, cutoff=False),
        "session_bounds": with_ctes(
            all_rows, bounds_sql("b", "new", "final"), select="select * from b"
        ),
        "sessions_by_user": with_ctes(
            all_rows,
            """
by_session as (
  select user_id, session_id, count(*) as n, max(t) - min(t) as secs, min(t) as first_t
  from final where session_id is not null group by user_id, session_id
)""",
            select="""
select user_id, count(*) as sessions, cast(sum(n) as bigint) as events,
       cast(sum(secs) as bigint) as session_secs, max(secs) as longest_secs,
       min(first_t) as first_session_time
from by_session group by user_id""",
        ),
        "prune_dates": with_ctes(touched_dates, select="select * from near_dates"),
        "existing_candidates": with_ctes(
            stored,
            touched_dates,
            select=f"""
select * from stored
where (product_code, event_date) in (select product_code, event_date from near_dates)
  and (user_id, product_code) in
      (select user_id, product_code from raw where arrival_date > date '{CUT}')""",
        ),
        "overlap_pairs": with_ctes(*pairs, select="select * from pairs"),
        "overlap_decision": with_ctes(*pairs, select="").rstrip() + decision,
        "changed_new_ids": with_ctes(all_rows, late, select=changes_sql("late")),
        "changed_existing_ids": with_ctes(all_rows, stored, select=changes_sql("stored")),
        "adopted_rows": with_ctes(
            all_rows,
            late,
            select=f"""
select f.* from final f join late o using ({EVENT_COLUMNS})
where o.session_id is null and f.session_id is not null""",
        ),
        "reconciled_rows": reconciled_sql() + "select * from reconciled",
        "reconciled_rows_300s": reconciled_sql(300) + "select * from reconciled",
        "reconciled_rows_no_cutoff": reconciled_sql(cutoff=False) + "select * from reconciled",
        "batch_stats": reconciled_sql()
        + "select count(*) as events, count(distinct session_id) as sessions from reconciled",
        "adopted_rows_null_event": with_ctes(
            sessions_sql("final", "true"),
            late,
            select=f"""
select f.user_id, f.product_code, nullif(f.event_id, '{NULLED_EVENT}') as event_id, f.t,
       f.session_id, f.event_date
from final f join late o using ({EVENT_COLUMNS})
where o.session_id is null and f.session_id is not null""",
        ),
        "decision_agrees": with_ctes(all_rows, *pairs, select="").rstrip() + agrees,
        "upserted_table": whole_table,
        "upserted_table_no_cutoff": with_ctes(
            sessions_sql("final", "true", cutoff=False), select="select * from final"
        ),
        "upsert_keeps_columns": with_ctes(
            all_rows,
            stored,
            select=f"""
select f.*, case when s.t is not null and f.product_code = 'P0' then f.event_id || '!' end as note
from final f left join stored s using ({EVENT_COLUMNS})""",
        ),
        "upsert_replay": whole_table,
        "batch_files_table": whole_table,
        "stream_upserted_table": whole_table,
        "session_windows": windows_sql + " select * from windows",
        "stream_session_windows": windows_sql
        + f"""
select * from windows
where session_end <= (select max(t) - {LATE_DAYS} * 86400 from actions)""",
    }

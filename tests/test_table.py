"""Files, the session table, pruning and upserts."""

import os

import pytest
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import functions as F
from rows import at, ids, raw, stored, table

from sessionflow import SessionConfig
from sessionflow.operators import (
    batch_stats,
    existing_candidates,
    identify_sessions,
    in_partitions,
    merge_into_table,
    prune_dates,
    read_existing_sessions,
    upsert_sessions,
)
from sessionflow.plans import BatchStats, process_batch, run_batch
from sessionflow.sources import new_work_path, read_events, read_session_table

EVENTS = [
    ("u", "a", "10:00", "007"),
    ("u", "d", "10:01", 'it"s'),
    ("u", "a", "10:02", 'it"s'),
    ("v", "a", "2025-03-20 09:00:00", "p"),
]


def waiting_files(path):
    return sorted(f for f in os.listdir(path) if f.endswith(".parquet"))


def test_read_events_cuts_fractions_and_takes_only_parquet(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw(spark, EVENTS).withColumn(
        "timestamp", F.expr("timestamp + interval 999 milliseconds")
    ).write.parquet(path)
    (tmp_path / "raw" / "note.txt").write_text("not an event")
    found = read_events(spark, path)
    assert sorted(map(str, found.collect())) == sorted(
        map(str, raw(spark, EVENTS).select(*found.columns).collect())
    )


def test_read_events_without_time_zone(spark, tmp_path):
    """Files whose timestamps carry no zone are read as UTC."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    (tmp_path / "raw").mkdir()
    time = at("10:00").replace(tzinfo=None)
    pq.write_table(
        pa.table({"user_id": ["u"], "event_id": ["a"], "timestamp": pa.array([time], pa.timestamp("us")), "product_code": ["p"]}),
        tmp_path / "raw" / "2025-03-10_0123abcd.parquet",
    )
    found = read_events(spark, str(tmp_path / "raw"))
    assert found.select(F.unix_seconds("timestamp")).first()[0] == int(at("10:00").timestamp())


def test_run_batch_moves_files_and_ignores_an_empty_folder(spark, tmp_path):
    source, archive = str(tmp_path / "raw"), str(tmp_path / "archive")
    target = str(tmp_path / "table")
    assert run_batch(spark, source, target, archive) == BatchStats(0, 0)
    os.makedirs(source)
    assert run_batch(spark, source, target, archive) == BatchStats(0, 0)
    raw(spark, EVENTS[:2]).write.mode("append").parquet(source)
    files = waiting_files(source)
    assert run_batch(spark, source, target, archive) == BatchStats(2, 1)
    assert waiting_files(source) == [] and waiting_files(archive) == files
    raw(spark, EVENTS[2:]).write.mode("append").parquet(source)
    assert run_batch(spark, source, target, archive) == BatchStats(2, 2)
    assert table(read_session_table(spark, target)) == table(identify_sessions(raw(spark, EVENTS)))
    left = os.listdir(spark.conf.get("spark.checkpoint.dir"))
    assert [name for name in left if name.startswith("sessionflow-batch-")] == []


@pytest.mark.parametrize("archived", [True, False])
def test_a_backlog_of_many_files_in_groups(spark, tmp_path, monkeypatch, archived):
    """More files than a group, and more than one listing remembers: the same table, in order of time."""
    from sessionflow.plans import pipeline

    source, target, archive = (str(tmp_path / n) for n in ("raw", "table", "archive"))
    for i, event in enumerate(EVENTS * 2):
        raw(spark, [event]).coalesce(1).write.mode("append").parquet(f"{source}/more" if i % 2 else source)
    names = [os.path.join(d, n) for d, _, files in os.walk(source) for n in files if n.endswith(".parquet")]
    for i, name in enumerate(sorted(names)):
        os.utime(name, (1000 + i % 5, 1000 + i % 5))
    os.makedirs(f"{source}/_temporary")
    os.link(names[0], f"{source}/_temporary/part.parquet")
    groups, original = [], pipeline.read_events
    monkeypatch.setattr(
        pipeline, "read_events", lambda s, files: groups.append(files) or original(s, files)
    )
    find = pipeline.waiting_files
    monkeypatch.setattr(pipeline, "waiting_files", lambda s, f, n: find(s, f, n, listed=4))
    stats = run_batch(spark, source, target, archive if archived else None, max_files=3)
    assert [len(g) for g in groups] == [3, 3, 2] and stats.events >= len(EVENTS)
    times = [os.path.getmtime(os.path.join(archive, os.path.basename(f)) if archived else f.removeprefix("file:")) for g in groups for f in g]
    assert times == sorted(times)
    assert len(waiting_files(archive)) == 8 if archived else not os.path.exists(archive)
    assert table(read_session_table(spark, target)) == table(identify_sessions(raw(spark, EVENTS)))


def test_replay_after_the_table_was_written(spark, tmp_path):
    """Files that were not moved because of a crash are processed once more, with no effect."""
    source, target = str(tmp_path / "raw"), str(tmp_path / "table")
    raw(spark, EVENTS).write.parquet(source)
    run_batch(spark, source, target)
    before = table(read_session_table(spark, target))
    run_batch(spark, source, target)
    assert table(read_session_table(spark, target)) == before


def test_partition_values_keep_their_type(spark, tmp_path):
    target = str(tmp_path / "table")
    upsert_sessions(spark, identify_sessions(raw(spark, EVENTS)), target)
    found = read_session_table(spark, target)
    assert dict(found.dtypes)["product_code"] == "string"
    assert {r.product_code for r in found.collect()} == {"007", 'it"s', "p"}


def test_absent_and_empty_tables(spark, tmp_path):
    new = raw(spark, EVENTS)
    absent = str(tmp_path / "absent")
    assert read_session_table(spark, absent) is None
    assert read_existing_sessions(spark, absent, new).count() == 0
    empty = tmp_path / "empty"
    empty.mkdir()
    assert read_session_table(spark, str(empty)).count() == 0
    assert process_batch(spark, new, str(empty)).events == 4
    assert read_session_table(spark, str(empty)).count() == 4
    assert process_batch(spark, raw(spark, []), absent) == BatchStats(0, 0)
    assert read_session_table(spark, absent) is None


def test_a_broken_table_is_an_error(spark, tmp_path):
    (tmp_path / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        read_existing_sessions(spark, str(tmp_path), raw(spark, EVENTS)).count()


def test_prune_dates(spark):
    found = {(r.product_code, str(r.event_date)) for r in prune_dates(raw(spark, EVENTS[2:])).collect()}
    assert found == {
        ('it"s', "2025-03-09"), ('it"s', "2025-03-10"), ('it"s', "2025-03-11"),
        ("p", "2025-03-19"), ("p", "2025-03-20"), ("p", "2025-03-21"),
    }
    wide = SessionConfig(timeout_secs=2 * 86400)
    assert prune_dates(raw(spark, EVENTS[3:]), wide).count() == 5


@pytest.mark.parametrize("max_literals", [100, 2])
def test_in_partitions(spark, max_literals):
    rows = stored(
        spark,
        [("u", "a", f"2025-03-{day:02d} 10:00:00", p, None) for day in range(5, 25) for p in ("p", 'it"s')],
    )
    found = in_partitions(rows, prune_dates(raw(spark, EVENTS)), max_literals)
    assert sorted((r.product_code, r.event_date.day) for r in found.collect()) == [
        ('it"s', 9), ('it"s', 10), ('it"s', 11), ("p", 19), ("p", 20), ("p", 21),
    ]


def test_candidates_are_pruned_when_the_table_is_scanned(spark, tmp_path):
    target = str(tmp_path / "table")
    upsert_sessions(spark, identify_sessions(raw(spark, EVENTS)), target)
    found = existing_candidates(read_session_table(spark, target), raw(spark, EVENTS[3:]))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "event_date" in plan.split("PartitionFilters: [")[1]
    assert [(r.user_id, r.product_code) for r in found.collect()] == [("v", "p")]
    assert len(found.inputFiles()) >= 1


def test_upsert_changes_only_the_id_and_touches_only_its_partitions(spark, tmp_path):
    target = str(tmp_path / "table")
    first = stored(
        spark,
        [("u", "a", "10:00", "p", "A"), ("u", "b", "10:01", "p", "A"), ("w", "a", "2025-03-12 10:00:00", "p", "W")],
    ).withColumn("note", F.concat("event_id", F.lit("!")))
    first.write.partitionBy("product_code", "event_date").parquet(target)
    other = f"{target}/product_code=p/event_date=2025-03-12"
    before = sorted(os.listdir(other))
    change = stored(
        spark,
        [("u", "b", "10:01", "p", "B"), ("u", "c", "10:02", "p", "B"), ("u", "c", "10:02", "p", "B"), ("x", "a", "10:00", "q", None)],
    )
    upsert_sessions(spark, change, target)
    found = read_session_table(spark, target)
    assert ids(found) == {
        ("u", "a", "10:00:00"): "A",
        ("u", "b", "10:01:00"): "B",
        ("u", "c", "10:02:00"): "B",
        ("x", "a", "10:00:00"): None,
        ("w", "a", "10:00:00"): "W",
    }
    notes = {(r.user_id, r.event_id): r.note for r in found.collect()}
    assert notes[("u", "b")] == "b!" and notes[("u", "c")] is None
    assert sorted(os.listdir(other)) == before


@pytest.mark.parametrize("max_literals", [100, 0])
def test_rows_with_null_keys_are_upserted_once(spark, tmp_path, max_literals):
    target = str(tmp_path / "table")
    rows = identify_sessions(
        raw(spark, [(None, "a", "10:00", "p"), ("u", None, "10:00", "p"), ("u", "a", "10:00", None), ("u", "a", None, "p"), ("u", "a", "10:00", "p")])
    )
    for _ in range(2):
        upsert_sessions(spark, rows, target, max_literals=max_literals)
    assert table(read_session_table(spark, target)) == table(rows)


def test_merge_needs_a_catalog_with_row_level_operations(spark):
    spark.sql("create table if not exists plain_sessions (user_id string, product_code string, event_id string, timestamp timestamp, session_id string, event_date date) using parquet")
    try:
        with pytest.raises(UnsupportedOperationException, match="MERGE"):
            merge_into_table(identify_sessions(raw(spark, EVENTS)), "plain_sessions")
    finally:
        spark.sql("drop table plain_sessions")


def test_stats_do_not_count_null_as_a_session(spark):
    rows = stored(spark, [("u", "a", "10:00", "p", "A"), ("u", "b", "10:01", "p", "A"), ("u", "d", "12:00", "p", None)])
    assert tuple(batch_stats(rows).first()) == (3, 1)
    assert tuple(batch_stats(rows.limit(0)).first()) == (0, 0)


def test_work_path_is_in_the_shared_folder(spark):
    assert new_work_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))

"""Upserts that lose nothing: schemas of many files, crashes, plans, lookups, names of files."""

import os

import pytest
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import functions as F
from rows import ids, raw, stored, table

from sessionflow import SessionConfig
from sessionflow.operators import (
    adopted_rows,
    identify_sessions,
    overlap_decision,
    reconcile_sessions,
    upsert_sessions,
)
from sessionflow.operators import assign, upsert
from sessionflow.plans import process_batch, run_batch
from sessionflow.sources import archive_files, read_session_table
from sessionflow.sources import files as work

FIRST = [
    ("u", "a", "10:00", "p"),
    ("u", "b", "10:04", "p"),
    ("v", "a", "2025-03-12 09:00:00", "p"),
    ("w", "a", "2025-03-14 09:00:00", "q"),
]
LATE = [("u", "c", "09:57", "p"), ("u", "d", "10:06", "p"), ("x", "a", "10:00", "q")]


def files_with_two_schemas(spark, path):
    rows = identify_sessions(raw(spark, FIRST))
    rows.where("product_code = 'p'").write.partitionBy("product_code", "event_date").parquet(path)
    noted = rows.where("product_code = 'q'").withColumn("note", F.lit("n"))
    noted.write.mode("append").partitionBy("product_code", "event_date").parquet(path)


def test_a_column_of_some_files_stays(spark, tmp_path):
    path = str(tmp_path / "t")
    files_with_two_schemas(spark, path)
    process_batch(spark, raw(spark, [*LATE, ("w", "b", "2025-03-14 09:01:00", "q")]), path)
    notes = {(r.user_id, r.event_id): r.note for r in read_session_table(spark, path).collect()}
    assert notes[("w", "a")] == "n" and notes[("w", "b")] is None and notes[("u", "a")] is None


NEXT = [("z", "a", "10:00", "q")]


class Lost(RuntimeError):
    pass


def crashing(monkeypatch, module, name, calls, after):
    """The function fails at the given call, before or after it did its work."""
    original, seen = getattr(module, name), []

    def call(*args, **kwargs):
        seen.append(args)
        if len(seen) != calls:
            return original(*args, **kwargs)
        if after:
            original(*args, **kwargs)
        raise Lost(name)

    monkeypatch.setattr(module, name, call)


# two moves for each partition, of the rows and of the day table
STEPS = [
    ("write_staged", 1, True),
    ("write_staged", 2, True),
    ("write_text", 1, False),
    ("write_text", 1, True),
    *(("move_folder", k, after) for k in (1, 2, 5) for after in (False, True)),
    ("remove_file", 1, False),
    ("remove_file", 1, True),
    ("write_text", 2, False),
    ("remove_file", 2, False),
    ("remove_file", 2, True),
    ("remove_folder", 1, False),
]


@pytest.fixture(scope="module")
def before_and_change(spark, tmp_path_factory):
    """A table of the first batch, the rows that the second one upserts, and the table after it."""
    path, change = (str(tmp_path_factory.mktemp("commit") / n) for n in ("t", "change"))
    process_batch(spark, raw(spark, FIRST), path)
    rows = identify_sessions(raw(spark, [*FIRST, *LATE]))
    rows.where("event_date = '2025-03-10'").write.parquet(change)
    return path, spark.read.parquet(change), table(rows)


@pytest.mark.parametrize("name,calls,after", STEPS)
def test_a_crash_at_any_step_loses_nothing(
    spark, tmp_path, monkeypatch, before_and_change, name, calls, after
):
    """The commit has not happened at all, or the next one finishes it."""
    import shutil

    first, change, expected = before_and_change
    path = str(tmp_path / "t")
    shutil.copytree(first, path)
    old = table(read_session_table(spark, path))
    monkeypatch.setattr(work, "MOVES_AT_ONCE", 1)  # so that moves come one after the other
    with monkeypatch.context() as m:
        crashing(m, work if name == "move_folder" else upsert, name, calls, after)
        with pytest.raises(Lost):
            upsert_sessions(spark, change, path)
    upsert.finish_commit(spark, path)
    committed = not (name == "write_staged" or (name, calls, after) == ("write_text", 1, False))
    assert table(read_session_table(spark, path)) == (expected if committed else old)
    upsert_sessions(spark, change, path)
    assert table(read_session_table(spark, path)) == expected
    assert not [n for n in os.listdir(path) if n.startswith("_") and n != "_state"]


def test_a_batch_after_a_crash_finishes_the_commit(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    process_batch(spark, raw(spark, FIRST), path)
    with monkeypatch.context() as m:
        crashing(m, work, "move_folder", 3, False)
        with pytest.raises(Lost):
            process_batch(spark, raw(spark, LATE), path)
    process_batch(spark, raw(spark, NEXT), path)
    expected = identify_sessions(raw(spark, [*FIRST, *LATE, *NEXT]))
    assert table(read_session_table(spark, path)) == table(expected)


def test_rows_are_written_once_and_other_partitions_stay(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    process_batch(spark, raw(spark, FIRST), path)
    other = os.path.join(path, "product_code=p", "event_date=2025-03-12")
    before = sorted(os.listdir(other))
    written = []
    original = upsert.write_staged
    monkeypatch.setattr(
        upsert, "write_staged", lambda rows, to: written.append(to) or original(rows, to)
    )
    process_batch(spark, raw(spark, LATE), path)
    assert [os.path.basename(to) for to in written] == ["rows", "days"]
    assert sorted(os.listdir(other)) == before


def test_the_schema_is_noted_and_footers_are_merged_once(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameReader

    path = str(tmp_path / "t")
    files_with_two_schemas(spark, path)
    merged = []
    original = DataFrameReader.option
    monkeypatch.setattr(
        DataFrameReader,
        "option",
        lambda self, key, value: merged.append(key) or original(self, key, value),
    )
    process_batch(spark, raw(spark, LATE[:1]), path)
    assert merged.count("mergeSchema") == 1
    process_batch(spark, raw(spark, LATE[1:]), path)
    process_batch(spark, raw(spark, [("w", "b", "2025-03-14 09:01:00", "q")]), path)
    rows = read_session_table(spark, path)
    assert merged.count("mergeSchema") == 1
    notes = {(r.user_id, r.event_id): r.note for r in rows.collect()}
    assert notes[("w", "a")] == "n" and notes[("w", "b")] is None and notes[("u", "a")] is None


def test_a_folder_of_rows_alone_is_a_table(spark, tmp_path):
    """Without its state a table is read from its files, and the next batch writes the state anew."""
    import shutil

    path = str(tmp_path / "t")
    process_batch(spark, raw(spark, FIRST), path)
    shutil.rmtree(os.path.join(path, "_state"))
    process_batch(spark, raw(spark, LATE), path)
    assert os.path.exists(os.path.join(path, "_state", "table.json"))
    expected = identify_sessions(raw(spark, [*FIRST, *LATE]))
    assert table(read_session_table(spark, path)) == table(expected)


def test_no_work_is_left_behind(spark, tmp_path):
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    path = str(tmp_path / "t")
    for batch in (FIRST, LATE):
        process_batch(spark, raw(spark, batch), path)
    process_batch(spark, raw(spark, LATE), path, SessionConfig(split_rows=1))
    assert set(os.listdir(shared)) - before == set()
    assert not [n for n in os.listdir(path) if n.startswith("_staged")]


def test_batches_and_streams_reach_merge(spark, tmp_path):
    spark.sql(
        "create table if not exists merged_sessions (user_id string, product_code string, event_id string, "
        "timestamp timestamp, session_id string, event_date date) using parquet"
    )
    try:
        with pytest.raises(UnsupportedOperationException, match="MERGE"):
            process_batch(spark, raw(spark, FIRST), table_name="merged_sessions")
        source = str(tmp_path / "raw")
        raw(spark, FIRST).write.parquet(source)
        with pytest.raises(UnsupportedOperationException, match="MERGE"):
            run_batch(spark, source, table_name="merged_sessions")
    finally:
        spark.sql("drop table merged_sessions")
    with pytest.raises(ValueError, match="either"):
        process_batch(spark, raw(spark, FIRST), "path", table_name="name")


def test_product_events_do_not_prolong_a_stored_session(spark):
    existing = stored(
        spark, [("u", "a", "10:00", "p", "X"), ("u", "d", "10:04", "p", "X")]
    )
    new = raw(spark, [("u", "a", "10:08", "p")])
    (row,) = overlap_decision(identify_sessions(new), existing).collect()
    assert row.existing_session_id is None
    assert row.final_session_id == row.new_session_id
    assert set(ids(reconcile_sessions(new, existing)).values()) == {row.new_session_id}


def test_decision_names_each_stored_session(spark):
    """One new session between two stored ones, longer than a time bin, and one that touches none."""
    existing = stored(
        spark,
        [("u", "a", "10:00", "p", "A"), ("u", "a", "13:04", "p", "B"), ("v", "a", "10:00", "p", "C")],
    )
    steps = [("u", "a", f"{10 + m // 60}:{m % 60:02d}", "p") for m in range(4, 181, 4)]
    new = identify_sessions(raw(spark, [*steps, ("v", "b", "20:00", "p")]))
    found = {
        (r.user_id, r.existing_session_id): r.final_session_id == r.existing_session_id
        for r in overlap_decision(new, existing).collect()
    }
    assert found == {("u", "A"): True, ("u", "B"): False, ("v", None): False}


def test_adoption_of_an_event_without_id(spark):
    existing = stored(spark, [("u", "a", "10:00", "p", "X")])
    new = raw(spark, [("u", None, "10:01", "p"), ("u", "d", "10:02", "p")])
    found = {(r.event_id, r.session_id) for r in adopted_rows(new, existing).collect()}
    assert found == {(None, "X"), ("d", "X")}


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_a_small_batch_does_not_shuffle_the_target(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_sessions(spark, identify_sessions(raw(spark, FIRST)), path)
    change = str(tmp_path / "change")
    identify_sessions(raw(spark, LATE)).write.parquet(change)
    merged = upsert.merged_rows(read_session_table(spark, path), spark.read.parquet(change))
    plan = plan_of(merged)
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 3
    assert "hashpartitioning" not in plan


def test_the_target_is_read_once(spark, tmp_path):
    path, change = str(tmp_path / "t"), str(tmp_path / "change")
    upsert_sessions(spark, identify_sessions(raw(spark, FIRST)), path)
    rows = identify_sessions(raw(spark, [*LATE, FIRST[0]]))
    rows.withColumn("inserted", F.col("event_id") != "a").write.parquet(change)
    target = read_session_table(spark, path).withColumn("note", F.lit("n"))
    merged = upsert.merged_rows(target, spark.read.parquet(change), flagged=True)
    plan = plan_of(merged)
    assert plan.count(f"{tmp_path}/t]") == 1
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 1
    assert "hashpartitioning" not in plan


@pytest.mark.parametrize("max_literals", [100, 0])
def test_from_dates(spark, max_literals):
    from datetime import date

    from sessionflow.operators.candidates import from_dates

    rows = identify_sessions(raw(spark, [*FIRST, ("n", "a", "10:00", None)]))
    wanted = spark.createDataFrame(
        [("p", date(2025, 3, 11)), (None, None)], "product_code string, event_date date"
    )
    found = from_dates(rows, wanted, max_literals)
    assert sorted(r.user_id for r in found.collect()) == ["n", "v"]


def test_folders_with_spaces_and_equal_names(spark, tmp_path):
    source, archive = str(tmp_path / "my raw%20files"), str(tmp_path / "arch ive")
    target = str(tmp_path / "t")
    for batch in (FIRST, LATE):
        os.makedirs(source, exist_ok=True)
        raw(spark, batch).coalesce(1).write.parquet(str(tmp_path / f"one{len(batch)}"))
        (part,) = [n for n in os.listdir(tmp_path / f"one{len(batch)}") if n.endswith(".parquet")]
        os.rename(tmp_path / f"one{len(batch)}" / part, os.path.join(source, "day 1.parquet"))
        assert run_batch(spark, source, target, archive).events > 0
        assert [n for n in os.listdir(source) if n.endswith(".parquet")] == []
    kept = [n for n in os.listdir(archive) if n.endswith(".parquet")]
    assert len(kept) == 2 and "day 1.parquet" in kept
    assert table(read_session_table(spark, target)) == table(
        identify_sessions(raw(spark, [*FIRST, *LATE]))
    )


def test_archive_on_another_file_system(spark, tmp_path):
    """The same disk under another scheme is another file system object."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.box.link./out", f"file://{tmp_path}/out")
    (tmp_path / "out").mkdir()
    (tmp_path / "x.parquet").write_text("x")
    names = [str(tmp_path / "x.parquet"), str(tmp_path / "gone.parquet")]
    assert archive_files(spark, names, "viewfs://box/out") == 1
    assert os.listdir(tmp_path / "out") == ["x.parquet"] or "x.parquet" in os.listdir(tmp_path / "out")
    assert not (tmp_path / "x.parquet").exists()


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Session:
        class conf:
            values = {"spark.master": "spark://host:7077"}

            @classmethod
            def get(cls, key, default=None):
                return cls.values.get(key, default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work.work_dir(Session)
    Session.conf.values["spark.master"] = "local[2]"
    assert os.path.isdir(work.work_dir(Session))


def test_null_keys_are_spread_and_have_no_session(spark):
    rows = [(None, "a", f"10:{m:02d}", "p") for m in range(40)]
    rows += [("u", "a", f"10:{m:02d}", None) for m in range(40)] + [("u", "a", "10:00", "p")]
    found = identify_sessions(raw(spark, rows + rows))
    assert found.count() == 81
    assert found.where("session_id is not null").count() == 1
    lanes = raw(spark, rows).select(assign.lane().alias("lane")).distinct().count()
    assert lanes > 20


def test_a_long_list_of_hot_pairs_is_written_once(spark, monkeypatch):
    monkeypatch.setattr(assign, "MAX_LOCAL_PAIRS", 0)
    cfg = SessionConfig(split_rows=1)
    events = raw(spark, [*FIRST, *LATE])
    hot = assign.hot_pairs(events, cfg)
    assert hot.inputFiles() and table(identify_sessions(events, cfg)) == table(
        identify_sessions(events)
    )


def test_times_without_zone_are_utc_in_any_session_zone(spark):
    from sessionflow.sources import normalize_events

    rows = spark.sql(
        "select 'u' user_id, 'a' event_id, timestamp_ntz'2025-03-10 23:59:59.9' timestamp, 'p' product_code"
    )
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        found = normalize_events(rows).select(F.unix_seconds("timestamp")).head()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert found == 1741651199

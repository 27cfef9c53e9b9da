"""A batch that is applied again writes nothing; what it changes is written where it changes."""

import os

import pytest
from rows import at, ids, raw, stored, table

from sessionflow import SessionConfig
from sessionflow.plans import process_batch
from sessionflow.sources import new_work_path, read_session_table

CFG = SessionConfig(3600)
ROWS = [
    ("u", "a", "2025-03-10 10:00", "p"),
    ("u", "x", "2025-03-10 10:10", "p"),
    ("u", "a", "2025-03-11 09:00", "p"),
    ("v", "b", "2025-03-12 12:00", "q"),
    (None, "a", "2025-03-12 12:00", "q"),
    ("v", None, "2025-03-12 15:00", "q"),
]


def files(path):
    return sorted(
        os.path.join(folder, name) for folder, _, names in os.walk(path) for name in names if name.endswith(".parquet")
    )


def days(spark, path):
    return sorted(map(str, spark.read.parquet(f"{path}/_state/session_days").collect()))


@pytest.mark.parametrize("cutoff", [True, False])
def test_a_replay_writes_nothing(spark, cutoff):
    cfg, path = SessionConfig(3600, idle_cutoff=cutoff), new_work_path(spark, "table")
    first = process_batch(spark, raw(spark, ROWS[:2]), path, cfg)
    second = process_batch(spark, raw(spark, ROWS), path, cfg)
    before, rows, known = files(path), table(read_session_table(spark, path)), days(spark, path)
    again = process_batch(spark, raw(spark, ROWS), path, cfg)
    assert files(path) == before
    assert table(read_session_table(spark, path)) == rows and days(spark, path) == known
    assert (first.events, first.sessions) == (2, 1)
    assert again == second and (again.events, again.sessions) == (6, 3)


def test_only_changed_partitions_are_written(spark):
    path = new_work_path(spark, "table")
    process_batch(spark, raw(spark, ROWS), path, CFG)
    before, known = files(path), days(spark, path)
    more = [*ROWS, ("u", "a", "2025-03-11 09:30", "p")]
    stats = process_batch(spark, raw(spark, more), path, CFG)
    assert stats.events == 7
    gone = {f.removeprefix(path) for f in set(before) - set(files(path))}
    assert gone and all("/product_code=p/event_date=2025-03-11/" in f for f in gone)
    assert len(read_session_table(spark, path).collect()) == 7
    assert len(days(spark, path)) == len(known)


def test_stored_copies_that_disagree_are_mended(spark):
    path = new_work_path(spark, "table")
    right = f"u#p#{int(at('10:00').timestamp())}"
    stored(
        spark,
        [("u", "a", "10:00", "p", right), ("u", "a", "10:00", "p", None), ("u", "x", "10:05", "p", right)],
    ).write.partitionBy("product_code", "event_date").parquet(path)
    process_batch(spark, raw(spark, [("u", "a", "10:00", "p")]), path, CFG)
    found = read_session_table(spark, path).where("event_id = 'a'").collect()
    assert [r.session_id for r in found] == [right, right]
    assert ids(read_session_table(spark, path).distinct())

"""The day table: right after every batch, and what it saves from being read."""

import random

import pytest
from model import START, from_frame, model, random_events, to_frame
from rows import raw

from sessionflow import SessionConfig
from sessionflow.operators import identify_sessions, upsert_sessions
from sessionflow.operators import session_days as sd
from sessionflow.plans import pipeline, process_batch
from sessionflow.sources import new_work_path, read_session_table
from sessionflow.sources.table import days_path

HOUR, DAY = 3600, 86400
BASE = int(START.timestamp())


def days_found(spark, path):
    schema = sd.day_schema()
    rows = spark.read.schema(schema).parquet(days_path(path)).collect()
    found = {
        (r.user_id, r.product_code, str(r.event_date), r.session_id): (r.first_t, r.last_t)
        for r in rows
    }
    assert len(found) == len(rows)
    return found


def days_expected(spark, path, cfg):
    rows = sd.session_days(read_session_table(spark, path), cfg.user_actions).collect()
    return {
        (r.user_id, r.product_code, str(r.event_date), r.session_id): (r.first_t, r.last_t)
        for r in rows
    }


@pytest.mark.parametrize("cutoff", [True, False])
def test_days_follow_the_rows(spark, cutoff):
    cfg = SessionConfig(10800, idle_cutoff=cutoff, split_rows=50)
    rows = random_events(11, cfg, users=9)
    rows += [(None, "a", BASE + 5, "p"), ("u", "d", BASE + 7, None)]
    random.Random(11).shuffle(rows)
    path, arrived = new_work_path(spark, "table"), []
    for k in range(3):
        batch = rows[k::3]
        process_batch(spark, to_frame(spark, batch), path, cfg)
        arrived += batch
        found, expected = days_found(spark, path), days_expected(spark, path, cfg)
        assert set(found) >= set(expected)
        assert {k: found[k] for k in expected} == expected
        # what is left over from events that moved on has no user action
        assert all(found[k] == (None, None) for k in set(found) - set(expected))
        incomplete = {r for r in arrived if r[0] is None or r[3] is None}
        complete = [r for r in arrived if r not in incomplete]
        rows_found = from_frame(read_session_table(spark, path).where("user_id is not null and product_code is not null"))
        assert rows_found == model(complete, cfg)


def test_first_batch_of_a_foreign_table_counts_the_days(spark, tmp_path):
    path = str(tmp_path / "t")
    first = [("u", "a", "10:00", "p"), ("v", "a", "2025-03-12 09:00:00", "q")]
    rows = identify_sessions(raw(spark, first))
    rows.write.partitionBy("product_code", "event_date").parquet(path)
    process_batch(spark, raw(spark, [("u", "b", "10:03", "p")]), path)
    cfg = SessionConfig()
    assert days_found(spark, path) == days_expected(spark, path, cfg)
    # Other user actions make it another table, and direct upserts keep it.
    wide = SessionConfig(user_actions=("a", "b", "c", "d"))
    process_batch(spark, raw(spark, [("u", "d", "10:04", "p")]), path, wide)
    assert days_found(spark, path) == days_expected(spark, path, wide)
    change = identify_sessions(raw(spark, [("u", "d", "10:09", "p"), ("w", "a", "10:00", "r")]), wide)
    change.write.parquet(str(tmp_path / "change"))
    upsert_sessions(spark, spark.read.parquet(str(tmp_path / "change")), path)
    assert days_found(spark, path) == days_expected(spark, path, wide)


class Reads:
    """Partition lists with which the stored rows are read."""

    def __init__(self, monkeypatch):
        self.of, self.original = [], pipeline.in_partitions
        monkeypatch.setattr(pipeline, "in_partitions", self)

    def __call__(self, rows, partitions, *args):
        if "event_id" in rows.columns:
            found = partitions.select("product_code", "event_date").distinct().collect()
            self.of.append({(r.product_code, str(r.event_date)) for r in found})
        result = self.original(rows, partitions, *args)
        self.last = result
        return result


def year_of_events(user="u", product="p"):
    """One session in the morning of every tenth day, and a product event in the evening."""
    rows = []
    for day in range(0, 360, 10):
        t = BASE + day * DAY + 9 * HOUR
        rows += [(user, "a", t, product), (user, "b", t + 100, product), (user, "d", t + 9 * HOUR, product)]
    return rows


def test_an_event_a_year_late_reads_the_partitions_of_its_session(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    rows = year_of_events() + year_of_events("v", "q")
    process_batch(spark, to_frame(spark, rows), path)
    late = [("u", "a", BASE + 10 * DAY + 9 * HOUR - 60, "p")]
    reads = Reads(monkeypatch)
    process_batch(spark, to_frame(spark, late), path)
    # its own partition for the key and the loose evening event, the renamed session, the upsert
    assert reads.of == [{("p", "2025-03-20")}] * 3
    plan = reads.last._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "2025-03-20" in filters or "20167" in filters
    assert from_frame(read_session_table(spark, path)) == model(rows + late, SessionConfig())


def test_a_renamed_session_is_followed_to_its_last_date(spark, tmp_path, monkeypatch):
    cfg = SessionConfig(10800)
    earlier = [("u", "a", BASE + 20 * HOUR, "p"), ("u", "b", BASE + 21 * HOUR, "p")]
    later = [("u", "abd"[i % 3], BASE + 26 * HOUR + i * HOUR, "p") for i in range(120)]
    other = [("u", "a", BASE + 60 * DAY, "p")]
    bridge = [("u", "c", BASE + 23 * HOUR + 1800, "p")]
    path = str(tmp_path / "t")
    process_batch(spark, to_frame(spark, earlier + later + other), path, cfg)
    reads = Reads(monkeypatch)
    process_batch(spark, to_frame(spark, bridge), path, cfg)
    dates = {("p", f"2025-03-{day}") for day in range(11, 17)}
    assert reads.of[1] == dates
    assert from_frame(read_session_table(spark, path)) == model(
        earlier + later + other + bridge, cfg
    )


def test_without_cutoff_nothing_before_the_batch_is_read(spark, tmp_path, monkeypatch):
    cfg = SessionConfig(300, idle_cutoff=False)
    rows = year_of_events() + year_of_events("v", "p")
    path = str(tmp_path / "t")
    process_batch(spark, to_frame(spark, rows), path, cfg)
    # a product event that only the session of 30 days before can name, and a user action before
    # events of the session before it
    product_event = [("u", "d", BASE + 48 * DAY, "p")]
    reads = Reads(monkeypatch)
    process_batch(spark, to_frame(spark, product_event), path, cfg)
    assert reads.of[0] == {("p", "2025-04-27"), ("p", "2025-04-29")}
    action = [("u", "c", BASE + 100 * DAY + 12 * HOUR, "p")]
    reads.of.clear()
    process_batch(spark, to_frame(spark, action), path, cfg)
    assert reads.of[0] == {("p", "2025-06-18"), ("p", "2025-06-28")}
    arrived = rows + product_event + action
    assert from_frame(read_session_table(spark, path)) == model(arrived, cfg)


@pytest.mark.parametrize("seed", [21, 22, 23])
def test_random_late_events_without_cutoff(spark, seed):
    """Late events anywhere, so that ids are carried over many dates and taken back."""
    cfg = SessionConfig(1800, idle_cutoff=False)
    rng = random.Random(seed)
    rows = [
        (f"u{rng.randrange(3)}", rng.choice("abdef"), BASE + rng.randrange(40 * DAY), f"p{rng.randrange(2)}")
        for _ in range(150)
    ]
    rows += [(u, rng.choice("abd"), t + rng.randrange(-2000, 2000), p) for u, _, t, p in rows[:60]]
    rng.shuffle(rows)
    path, arrived = new_work_path(spark, "table"), []
    for batch in (rows[:120], rows[120:180], rows[180:195], rows[195:]):
        process_batch(spark, to_frame(spark, batch), path, cfg)
        arrived += batch
        assert from_frame(read_session_table(spark, path)) == model(arrived, cfg)


def test_statistics_need_no_job_after_the_upsert(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    process_batch(spark, raw(spark, [("u", "a", "10:00", "p")]), path)
    jobs = []
    original = pipeline.commit_partitions

    def commit(*args):
        original(*args)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup("stats")))

    monkeypatch.setattr(pipeline, "commit_partitions", commit)
    spark.sparkContext.setJobGroup("stats", "stats")
    try:
        stats = process_batch(spark, raw(spark, [("u", "b", "10:01", "p"), ("u", "d", "12:00", "p")]), path)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup("stats")))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert (stats.events, stats.sessions) == (2, 1)
    assert jobs[0] == jobs[1] > 0

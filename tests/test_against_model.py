"""Spark plans against the brute-force model, with and without splitting of hot pairs."""

import random

import pytest
from model import START, from_frame, model, random_events, to_frame

from sessionflow import SessionConfig
from sessionflow.operators import (
    identify_sessions,
    reconcile_sessions,
    session_bounds,
    user_activity,
)
from sessionflow.plans import process_batch
from sessionflow.sources import new_work_path, read_session_table

CONFIGS = {
    "five minutes": SessionConfig(300),
    "five minutes, split": SessionConfig(300, split_rows=10),
    "three hours, split": SessionConfig(10800, split_rows=10),
    "two days, split": SessionConfig(100_000, split_rows=10),
    "no cutoff": SessionConfig(3600, idle_cutoff=False),
    "no cutoff, split": SessionConfig(3600, idle_cutoff=False, split_rows=10),
}


@pytest.mark.parametrize("name", CONFIGS)
def test_sessions(spark, name):
    cfg = CONFIGS[name]
    rows = random_events(1, cfg, users=24)
    assert from_frame(identify_sessions(to_frame(spark, rows + rows[:50]), cfg)) == model(rows, cfg)


def test_more_hot_pairs_than_fit_a_local_list(spark, monkeypatch):
    monkeypatch.setattr("sessionflow.operators.assign.MAX_LOCAL_PAIRS", 2)
    cfg = CONFIGS["five minutes, split"]
    rows = random_events(6, cfg)
    assert from_frame(identify_sessions(to_frame(spark, rows), cfg)) == model(rows, cfg)


@pytest.mark.parametrize("split_rows", [10, 10_000])
def test_activity(spark, split_rows):
    cfg = SessionConfig(300, split_rows=split_rows)
    rows = random_events(2, cfg)
    for r in user_activity(to_frame(spark, rows), cfg).collect():
        actions = sorted(
            t
            for user, event, t, product in rows
            if (user, product) == (r.user_id, r.product_code) and event in cfg.user_actions
        )
        assert r.last_user_t == max((t for t in actions if t <= r.t), default=None)
        assert r.prev_user_t == max((t for t in actions if t < r.t), default=None)
        gap = None if r.prev_user_t is None else r.t - r.prev_user_t
        assert r.inactivity_gap == gap
        starts = r.is_user_event and (gap is None or gap > 300)
        assert r.is_new_session == starts


@pytest.mark.parametrize("name", CONFIGS)
def test_reconciled_batch(spark, name):
    cfg = CONFIGS[name]
    rows = random_events(3, cfg)
    random.Random(3).shuffle(rows)
    old, new = rows[: len(rows) // 2], rows[len(rows) // 2 :]
    new = new + old[:5]  # delivered again
    existing = identify_sessions(to_frame(spark, old), cfg)
    found = from_frame(reconcile_sessions(to_frame(spark, new), existing, cfg))
    before, after = model(old, cfg), model(rows, cfg)
    delivered = {(u, p, e, t) for u, e, t, p in new}
    assert found == {
        key: value
        for key, value in after.items()
        if key in delivered or before[key] != value
    }


@pytest.mark.parametrize("name", CONFIGS)
def test_table_equals_recomputation_after_each_batch(spark, name):
    """Batches of some dates at a time, so that long sessions reach out of what is read."""
    cfg = CONFIGS[name]
    rng = random.Random(4)
    rows = random_events(4, cfg)
    batches = [[], [], [], []]
    part_of_day = {}
    for row in rows:
        day = row[2] // 86400
        home = part_of_day.setdefault((row[0], day), rng.randrange(4))
        batches[home if rng.random() < 0.7 else rng.randrange(4)].append(row)
    path = new_work_path(spark, "table")
    arrived = []
    for batch in batches:
        stats = process_batch(spark, to_frame(spark, batch), path, cfg)
        assert stats.events >= len(set(batch))
        arrived += batch
        assert from_frame(read_session_table(spark, path)) == model(arrived, cfg)
    before = from_frame(read_session_table(spark, path))
    process_batch(spark, to_frame(spark, batches[1]), path, cfg)
    assert from_frame(read_session_table(spark, path)) == before


@pytest.mark.parametrize("split_rows", [5, 10_000])
def test_long_session_is_renamed_beyond_the_dates_read(spark, split_rows):
    """A late event joins a session to an earlier one. Its rows on later dates, some of them on
    dates the batch does not reach, and another late event in it follow."""
    cfg = SessionConfig(10800, split_rows=split_rows)
    hour, base = 3600, int(START.timestamp())
    earlier = [("u", "a", base + 20 * hour, "p"), ("u", "b", base + 21 * hour, "p")]
    later = [("u", "abd"[i % 3], base + 26 * hour + i * hour, "p") for i in range(120)]
    bridge = [("u", "c", base + 23 * hour + 1800, "p")]
    inside = [("u", "d", base + 26 * hour + 100 * hour + 60, "p")]
    path = new_work_path(spark, "table")
    process_batch(spark, to_frame(spark, earlier + later), path, cfg)
    assert len(set(from_frame(read_session_table(spark, path)).values())) == 2
    process_batch(spark, to_frame(spark, bridge + inside), path, cfg)
    found = from_frame(read_session_table(spark, path))
    assert set(found.values()) == {f"u#p#{base + 20 * hour}"}
    assert found == model(earlier + later + bridge + inside, cfg)


def test_session_gaps(spark):
    """No session has a longer break than the timeout between user actions."""
    cfg = SessionConfig(300)
    rows = random_events(5, cfg)
    sessions = identify_sessions(to_frame(spark, rows), cfg)
    bounds = session_bounds(sessions.where("event_id in ('a','b','c')"), "s").collect()
    for b in bounds:
        times = sorted(
            t
            for user, event, t, product in rows
            if (user, product) == (b.user_id, b.product_code)
            and event in cfg.user_actions
            and b.s_session_min_time.timestamp() <= t <= b.s_session_max_time.timestamp()
        )
        assert all(y - x <= 300 for x, y in zip(times, times[1:]))
        assert b.s_session_id.endswith(f"#{times[0]}")

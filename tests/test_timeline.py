"""The scan in two levels: equal results for short timeouts over long spans, and small tasks."""

import random

import pytest
from model import START, from_frame, model, to_frame
from pyspark.sql import functions as F

from sessionflow import SessionConfig
from sessionflow.operators import identify_sessions, timeline
from sessionflow.operators.assign import as_items
from sessionflow.plans import process_batch
from sessionflow.sources import new_work_path, read_session_table

DAY = 86400
BASE = int(START.timestamp())


def years_of_events(seed, timeout):
    """One pair over three years: bursts around midnight and long breaks, and another pair."""
    rng, rows = random.Random(seed), []
    for _ in range(60):
        t = BASE + rng.randrange(3 * 365) * DAY + rng.choice([0, DAY - 3, rng.randrange(DAY)])
        for _ in range(rng.randrange(1, 9)):
            rows.append(("u", rng.choice("abcd"), t, "p"))
            t += rng.choice([0, 1, timeout - 1, timeout, timeout + 1, rng.randrange(3 * timeout)])
    return rows + [("v", "a", BASE, "p"), ("u", "a", BASE, "q")]


@pytest.mark.parametrize("timeout,cutoff", [(5, True), (5, False), (300, True), (DAY, True), (3 * DAY, False)])
def test_years_in_slices(spark, timeout, cutoff):
    cfg = SessionConfig(timeout, idle_cutoff=cutoff, split_rows=10)
    rows = years_of_events(timeout, timeout)
    found = identify_sessions(to_frame(spark, rows), cfg)
    assert from_frame(found) == model(rows, cfg)


def test_a_batch_with_a_hot_pair_over_years(spark):
    cfg = SessionConfig(5, split_rows=10)
    rows = years_of_events(9, 5)
    random.Random(9).shuffle(rows)
    path = new_work_path(spark, "table")
    for part in (rows[: len(rows) // 2], rows[len(rows) // 2 :]):
        process_batch(spark, to_frame(spark, part), path, cfg)
    assert from_frame(read_session_table(spark, path)) == model(rows, cfg)


def test_no_window_sees_more_than_a_day_or_the_days(spark):
    cfg = SessionConfig(5)
    rows = spark.range(40 * 2000).select(
        F.lit("u").alias("user_id"),
        F.lit("p").alias("product_code"),
        F.lit("a").alias("event_id"),
        F.timestamp_seconds(F.lit(BASE) + F.col("id") * 43).alias("timestamp"),
    )
    state = timeline.carried_state(as_items(rows, cfg), cfg)
    plan = state._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    by_slice = [line for line in windows if "slice#" in line]
    by_day = [line for line in windows if "slice#" not in line]
    assert by_slice and all(", day#" in line.split("windowspecdefinition(")[1] for line in by_slice)
    assert by_day and all("of_day" in line for line in by_day)
    assert state.count() == 40 * 2000
    assert state.where("before_t is null").count() == 1
    assert state.where("before <> before_t").count() == 0  # each action is a session of its own

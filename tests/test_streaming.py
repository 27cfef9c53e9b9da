"""Structured Streaming gives what the batch job gives."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F
from model import START, to_frame
from rows import raw, table

from sessionflow import SessionConfig
from sessionflow.operators import identify_sessions
from sessionflow.sources import read_session_table, stream_events
from sessionflow.streaming import session_windows, start_session_stream

BATCHES = [
    [("u", "a", "10:00", "p"), ("u", "d", "10:07", "p"), ("v", "a", "11:00", "p")],
    [("u", "b", "10:04", "p"), ("v", "c", "10:56", "p")],
    [("u", "c", "10:08", "p"), ("u", "d", "10:30", "p"), ("v", "d", "11:04", "q")],
]


def deliver(spark, path, batch):
    raw(spark, batch).coalesce(1).write.mode("append").parquet(path)


def test_stream_equals_one_batch(spark, tmp_path):
    source, target = str(tmp_path / "raw"), str(tmp_path / "table")
    archive, checkpoint = str(tmp_path / "archive"), str(tmp_path / "checkpoint")
    os.makedirs(source)
    for i, batch in enumerate(BATCHES):
        deliver(spark, source, batch)
        start_session_stream(
            spark, source, target, checkpoint, archive_dir=archive, max_files_per_trigger=1
        ).awaitTermination()
        arrived = [row for b in BATCHES[: i + 1] for row in b]
        expected = identify_sessions(raw(spark, arrived))
        assert table(read_session_table(spark, target)) == table(expected)
    # Nothing new: nothing happens.
    start_session_stream(spark, source, target, checkpoint).awaitTermination()
    assert read_session_table(spark, target).count() == sum(map(len, BATCHES))


def test_interval_stream(spark, tmp_path):
    source, target = str(tmp_path / "raw"), str(tmp_path / "table")
    os.makedirs(source)
    deliver(spark, source, BATCHES[0])
    query = start_session_stream(
        spark, source, target, str(tmp_path / "checkpoint"), interval="1 second"
    )
    try:
        query.processAllAvailable()
        deliver(spark, source, BATCHES[1])
        query.processAllAvailable()
    finally:
        query.stop()
    expected = identify_sessions(raw(spark, BATCHES[0] + BATCHES[1]))
    assert table(read_session_table(spark, target)) == table(expected)


def test_session_windows_of_stream_and_batch(spark, tmp_path):
    source = str(tmp_path / "raw")
    for batch in BATCHES:
        deliver(spark, source, batch + batch[:1])
    cfg = SessionConfig(300)
    query = (
        session_windows(stream_events(spark, source), cfg, late_days=5)
        .writeStream.outputMode("complete")
        .format("memory")
        .queryName("windows")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    streamed = sorted(map(str, spark.table("windows").collect()))
    events = raw(spark, [row for b in BATCHES for row in b + b[:1]])
    assert streamed == sorted(map(str, session_windows(events, cfg).collect()))
    split = SessionConfig(300, split_rows=1)
    assert streamed == sorted(map(str, session_windows(events, split).collect()))
    # A gap of exactly the timeout does not break a session.
    exact = raw(spark, [("u", "a", "10:00", "p"), ("u", "b", "10:05", "p")])
    assert session_windows(exact, cfg).select(F.sum("actions"), F.count("*")).first() == (2, 1)


def appended(spark, tmp_path, events, cfg, append, files):
    source, closed = str(tmp_path / "raw"), str(tmp_path / f"closed-{append}")
    if not os.path.exists(source):
        for rows in events:
            to_frame(spark, rows).coalesce(1).write.mode("append").parquet(source)
    query = (
        session_windows(stream_events(spark, source, max_files_per_trigger=files), cfg, 1, append)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", closed)
        .option("checkpointLocation", str(tmp_path / f"checkpoint-{append}"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    states = [json.loads(p.json)["stateOperators"] for p in query.recentProgress]
    return sorted(map(str, spark.read.parquet(closed).collect())), states


def test_stream_that_counts_seconds_first_gives_the_same_sessions(spark, tmp_path):
    """A hot pair among others: sessions are those of the one-step form and of the batch, and state by
    pair and the shuffle to it see seconds, not events."""
    base, rng = int(START.timestamp()), random.Random(5)
    hot = [("u", rng.choice("abc"), base + rng.randrange(600), "p") for _ in range(3000)]
    rows = hot + [(f"v{i % 9}", "abcd"[i % 4], base + rng.randrange(40_000), "q") for i in range(300)]
    rows += [("w", "a", base + 4 * 86400, "p")]  # moves the watermark past the others
    cfg = SessionConfig(300)
    two, states = appended(spark, tmp_path, [rows], cfg, True, 10)
    one, _ = appended(spark, tmp_path, [rows], cfg, False, 10)
    batch = session_windows(to_frame(spark, rows[:-1]), SessionConfig(300, split_rows=5))
    assert two == one == sorted(map(str, batch.collect()))
    seconds = len({(u, t, p) for u, e, t, p in rows if e in "abc"})
    events = len({r for r in rows if r[1] in "abc"})
    assert [len(s) for s in states] == [3] * len(states)
    most = [max(s[k]["numRowsTotal"] for s in states) for k in range(3)]
    # by session, by second, by event (operators are listed from the last to the first)
    assert most[1] == seconds < events == most[2] and most[0] <= seconds
    with pytest.raises(ValueError, match="late_days"):
        session_windows(to_frame(spark, rows), cfg, append=True)

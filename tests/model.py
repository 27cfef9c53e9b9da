"""Brute-force model of the session rules, and random events to try them on."""

import random
from datetime import datetime, timedelta, timezone

from sessionflow.functions import epoch

START = datetime(2025, 3, 10, tzinfo=timezone.utc)


def model(events, cfg):
    """{(user, product, event, t): session_id} for (user, event, t, product) rows."""
    found = {}
    pairs = {}
    for user, event, t, product in set(events):
        pairs.setdefault((user, product), []).append((t, event))
    for (user, product), rows in pairs.items():
        actions = sorted({t for t, event in rows if event in cfg.user_actions})
        start_of = {}
        for i, t in enumerate(actions):
            linked = i > 0 and t - actions[i - 1] <= cfg.timeout_secs
            start_of[t] = start_of[actions[i - 1]] if linked else t
        for t, event in rows:
            before = [a for a in actions if a <= t]
            inside = before and (not cfg.idle_cutoff or t - before[-1] <= cfg.timeout_secs)
            found[(user, product, event, t)] = (
                f"{user}#{product}#{start_of[before[-1]]}" if inside else None
            )
    return found


def random_events(seed, cfg, users=12, days=6):
    """Events around the timeout's scale: bursts, exact gaps, chains over several days."""
    rng = random.Random(seed)
    base = int(START.timestamp())
    rows = []
    for n in range(users):
        user, product = f"u{n % 7}", f"p{n % 3}"
        t = base + rng.randrange(days * 86400)
        chain = n % 4 == 0
        for _ in range(60 if chain else 25):
            step = cfg.timeout_secs
            if chain:
                gap = rng.randrange(step // 2, step + 1)
            else:
                gap = rng.choice(
                    [0, 1, step - 1, step, step + 1, rng.randrange(2 * step), rng.randrange(86400)]
                )
            t += gap
            share = 0.9 if chain else 0.6
            event = rng.choice("abc") if rng.random() < share else rng.choice("defgh")
            rows.append((user, event, t, product))
    return rows


def to_frame(spark, rows):
    from sessionflow.schema import raw_schema

    return spark.createDataFrame(
        [
            (u, e, datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(seconds=t), p)
            for u, e, t, p in rows
        ],
        raw_schema(),
    )


def from_frame(frame):
    rows = frame.select(
        "user_id", "product_code", "event_id", epoch("timestamp").alias("t"), "session_id"
    ).collect()
    found = {(r.user_id, r.product_code, r.event_id, r.t): r.session_id for r in rows}
    assert len(found) == len(rows), "repeated event keys"
    return found

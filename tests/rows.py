"""Literal rows for the tests."""

from datetime import datetime, timezone

from sessionflow.schema import raw_schema, session_schema

DAY = "2025-03-10"


def at(text):
    """'10:00', '10:00:30' on the fixture day, or a full date and time; UTC."""
    if len(text) <= 8:
        text = f"{DAY} {text}"
    if text.count(":") == 1:
        text += ":00"
    return datetime.strptime(text, "%Y-%m-%d %H:%M:%S").replace(tzinfo=timezone.utc)


def raw(spark, rows):
    """rows: (user, event, time, product)"""
    return spark.createDataFrame(
        [(u, e, at(t) if t else None, p) for u, e, t, p in rows], raw_schema()
    )


def stored(spark, rows):
    """rows: (user, event, time, product, session_id)"""
    return spark.createDataFrame(
        [(u, p, e, at(t), i, at(t).date()) for u, e, t, p, i in rows], session_schema()
    )


def ids(frame):
    """{(user, event, 'HH:MM:SS'): session_id}, failing on repeated keys."""
    rows = frame.selectExpr(
        "user_id", "product_code", "event_id", "date_format(timestamp, 'HH:mm:ss') t", "session_id"
    ).collect()
    found = {(r.user_id, r.event_id, r.t): r.session_id for r in rows}
    assert len(found) == len(rows)
    return found


def table(frame):
    """All rows as a sorted list of strings, to compare two frames."""
    columns = ["user_id", "product_code", "event_id", "timestamp", "session_id", "event_date"]
    return sorted(str(tuple(r)) for r in frame.select(*columns).collect())

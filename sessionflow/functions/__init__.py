from sessionflow.functions.expressions import (
    epoch,
    is_user_action,
    make_session_id,
    slice_of,
    user_action_filter,
    utc_date,
    whole_seconds,
    widened_dates,
    zoneless_seconds,
)

__all__ = [
    "epoch",
    "is_user_action",
    "make_session_id",
    "slice_of",
    "user_action_filter",
    "utc_date",
    "whole_seconds",
    "widened_dates",
    "zoneless_seconds",
]

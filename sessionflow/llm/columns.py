"""Column expressions and small checks that the text operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\f\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where lambdas refer to it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def whole_text(text: Column) -> Column:
    """The text; NULL is empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def space_words(text: Column) -> Column:
    """Words between white space, as an array."""
    return let(
        F.btrim(whole_text(text), F.lit(SPACES)),
        lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(
            F.split(t, SPACE_RUN)
        ),
    )


def numbers(first: Column | int, last: Column) -> Column:
    """first..last as an array, empty where last < first (``sequence`` would count down)."""
    first = F.lit(first) if isinstance(first, int) else first
    return F.when(last >= first, F.sequence(first.cast("int"), last.cast("int"))).otherwise(
        F.array().cast("array<int>")
    )


def free_name(df: DataFrame, name: str) -> str:
    """``name``, prolonged until no column of ``df`` has it, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name

"""Tables written to the shared folder, so that what follows neither computes them again nor
depends on an executor staying alive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sessionflow.sources import delete_path, new_work_path

#: Paths of the tables that this process has written and not removed.
_written: list[str] = []


def stored(rows: DataFrame, name: str) -> DataFrame:
    """``rows``, written as Parquet under the session's spark.checkpoint.dir and read back.

    The table stays until ``remove_stored``, since lazy results may read it at any time.
    """
    path = new_work_path(rows.sparkSession, name)
    rows.write.parquet(path)
    _written.append(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def stored_count() -> int:
    """A mark for ``remove_stored``."""
    return len(_written)


def remove_stored(spark: SparkSession, since: int = 0, but_last: bool = False) -> None:
    """Delete the tables stored after the mark ``since``, or all but the last of them."""
    gone = _written[since : len(_written) - 1 if but_last else None]
    kept = _written[len(_written) - 1 :] if but_last else []
    _written[since:] = kept
    for path in gone:
        delete_path(spark, path)

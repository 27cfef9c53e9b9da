"""A Spark session with the settings the engine expects."""

from __future__ import annotations

from pyspark.sql import SparkSession


def create_spark_session(
    app_name: str = "sessionflow",
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Operators take any session; this one is for jobs that have none yet.

    Memory, cores and the number of shuffle partitions belong to the cluster and are left to
    it or to ``settings``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
        .config("spark.ui.enabled", "false")
    )
    if master is not None:
        builder = builder.master(master)
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

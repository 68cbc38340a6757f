"""Session settings the operators are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Joins here are left to the adaptive planner on purpose: it looks at the real
# size of a finished stage before it broadcasts, and splits hot partitions of a
# sort-merge join otherwise.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # Call sites in error messages cost a stack walk per column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app: str = "orderlens",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings above; the master is left to spark-submit by default."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**SETTINGS, **(extra or {})}
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

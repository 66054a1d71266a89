"""Session settings the jobs are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE starts wide and shrinks, so one setting serves a laptop and a large
# cluster; ANSI stays on and the operators use try_cast for outside data.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM does not compile methods beyond 8000 bytes; splitting such a
    # generated stage into operators is faster than interpreting it.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Recording a call site per Column doubles the time to build wide plans.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def lake_session(app: str, **extra: str) -> SparkSession:
    """Build a session; the master and sizes come from ``spark-submit``."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

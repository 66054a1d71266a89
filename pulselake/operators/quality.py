"""Counts and latency figures."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table; no columns are read."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def latency_summary(events: DataFrame) -> DataFrame:
    """Mean and sample deviation of source-to-ingest delay, per event type.

    The deviation of a single event is 0.
    """
    delay = (F.unix_micros("kafka_ingest_time") - F.unix_micros("source_timestamp")) / F.lit(1e6)
    measured = events.select("event_type", delay.alias("delay")).filter(F.col("delay").isNotNull())
    return measured.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"),
        F.avg("delay").alias("mean_seconds"),
        F.coalesce(F.stddev_samp("delay"), F.lit(0.0)).alias("sd_seconds"),
    )

"""Baseline readings per exported hour."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselake.functions.lenient import number_or_null
from pulselake.operators.ingest import identified
from pulselake.operators.unique import first_per_key

def baseline_pool(hourly: DataFrame, daily: DataFrame, newest_first: Sequence[Column]) -> DataFrame:
    """One entry per hourly row, with the daily values of its user and date.

    ``newest_first`` orders the daily rows of one user and date; the first is
    used. Readings that are missing or unreadable stay NULL. The lookup side has one row per key, so a crowded key on the hourly
    side can be split freely by the join.
    """
    lookup = first_per_key(identified(daily, "id", "date"), ["id", "date"], newest_first).select(
        "id",
        "date",
        number_or_null(F.col("rmssd")).alias("_rmssd"),
        number_or_null(F.col("full_sleep_breathing_rate")).alias("_breathing"),
    )
    hours = identified(hourly, "id", "date").select("id", "date", "hour", "bpm")
    return hours.join(lookup, on=["id", "date"], how="left").select(
        F.col("id").alias("user_id"),
        F.col("date").alias("event_date"),
        F.coalesce(F.col("hour"), F.lit("0")).alias("event_hour"),
        number_or_null(F.col("bpm")).alias("base_bpm"),
        F.col("_rmssd").alias("base_rmssd"),
        F.col("_breathing").alias("base_breathing"),
    )

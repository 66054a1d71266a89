"""CSV export -> topic events."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pulselake.operators.ingest import daily_events, hourly_events
from pulselake.sources.csv_export import read_export
from pulselake.sources.lake import Lake
from pulselake.sources.topic_log import append_events

EXPORTS = {"hourly": hourly_events, "daily": daily_events}


def ingest_export(lake: Lake, path: str, kind: str) -> DataFrame:
    """Send every event of an hourly or daily export; returns the events."""
    events = EXPORTS[kind](read_export(lake.spark, path))
    append_events(events, lake.config)
    return events

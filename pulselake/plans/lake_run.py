"""The daily run: checks, Silver, insights, Gold, publishing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulselake.operators.anomaly import TooFewWindows
from pulselake.operators.quality import table_counts
from pulselake.plans.gold import BUILDERS, run_gold
from pulselake.plans.insights import NoInsightInput, run_insights
from pulselake.plans.silver import run_silver
from pulselake.sources.jdbc import Writer, publish_all
from pulselake.sources.lake import BRONZE, GOLD, SILVER, Lake
from pulselake.sources.workspace import scratch
from pulselake.specs import TOPICS

LAYER_TABLES = {
    BRONZE: tuple(TOPICS),
    SILVER: tuple(TOPICS),
    GOLD: (*BUILDERS, "ai_insights"),
}


class LayerMissing(RuntimeError):
    """A stage was started before any of its inputs exist."""


def layer_presence(lake: Lake, layer: str) -> DataFrame:
    """One row per expected table: whether it exists and its row count, counted in one job."""
    found = {name: lake.read(layer, name) for name in LAYER_TABLES[layer]}
    there = {name: table for name, table in found.items() if table is not None}
    absent = lake.spark.createDataFrame([(name, False, None) for name in found if name not in there], "table_name string, table_exists boolean, n bigint")
    if not there:
        return absent
    return table_counts(there).select("table_name", F.lit(True).alias("table_exists"), "n").unionByName(absent)


def require_layer(lake: Lake, layer: str) -> None:
    if not any(lake.read(layer, name) is not None for name in LAYER_TABLES[layer]):
        raise LayerMissing(f"no {layer} table exists yet")


def run_lake(lake: Lake, *, writer: Writer | None = None, with_insights: bool = True,
             since: dt.date | None = None, full: bool = False, **silver_options) -> dict[str, object]:
    """All stages in order, each behind a check of the layer it reads.

    Silver takes in the batches since the last run and Gold the dates they
    touched, unless ``full`` redoes all. Insights run before publishing, and
    only tables that this run brought up to date are published: without a model the report says why under ``insights_skipped``
    and an earlier run's ``ai_insights`` stays unpublished. ``since`` limits the
    Gold rebuild to later dates.
    """
    with scratch(lake.spark):  # everything a run keeps is in the lake
        return _run_stages(lake, writer, with_insights, since, full, silver_options)


def _run_stages(lake: Lake, writer: Writer | None, with_insights: bool, since: dt.date | None, full: bool, silver_options: dict) -> dict[str, object]:
    report: dict[str, object] = {}
    require_layer(lake, BRONZE)
    report["silver"] = run_silver(lake, **{"new_only": not full, **silver_options})
    require_layer(lake, SILVER)
    if with_insights:
        try:
            report["insights"] = run_insights(lake)
        except (TooFewWindows, NoInsightInput) as reason:
            report["insights_skipped"] = str(reason)
    report["gold"] = run_gold(lake, since=since, full=full)
    current = [*report["gold"], *(["ai_insights"] if "insights" in report else [])]
    require_layer(lake, GOLD)
    if writer is not None or lake.config.jdbc_url is not None:
        report["published"] = publish_all(lake, writer, current)
    return report

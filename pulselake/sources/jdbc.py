"""Publishing Gold tables to a relational database."""

from __future__ import annotations

import logging
from collections.abc import Callable, Collection

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pulselake.config import LakeConfig
from pulselake.sources.lake import GOLD, Lake

# Published tables.
PUBLISHED = (
    "daily_vitals_summary",
    "daily_activity_summary",
    "daily_context_summary",
    "daily_sleep_summary",
    "daily_vitals_daily_summary",
    "daily_intraday_summary",
    "daily_wellness_profile",
    "ai_insights",
)

log = logging.getLogger(__name__)

Writer = Callable[[DataFrame, str], None]


def jdbc_writer(config: LakeConfig) -> Writer:
    """Refill a database table, keeping its definition.

    Each partition holds a connection, so partitions are merged down to the
    configured number of connections; rows are sent in batches.
    """
    if config.jdbc_url is None:
        raise ValueError("no JDBC url configured")

    def write(rows: DataFrame, table: str) -> None:
        (
            rows.write.mode("overwrite")
            .option("truncate", "true")
            .option("numPartitions", config.jdbc_connections)
            .option("batchsize", 10000)
            .jdbc(config.jdbc_url, table, properties=dict(config.jdbc_properties))
        )

    return write


def publish(lake: Lake, name: str, write: Writer) -> int | None:
    """Send one Gold table; returns its row count, None if it does not exist.

    Rows are counted while they are written instead of in a second scan.
    """
    table = lake.read(GOLD, name)
    if table is None:
        log.info("%s: no Gold table, skipped", name)
        return None
    seen = Observation()
    write(table.observe(seen, F.count(F.lit(1)).alias("rows")), name)
    rows = seen.get["rows"]
    log.info("%s: %d rows published", name, rows)
    return rows


def publish_all(lake: Lake, write: Writer | None = None, names: Collection[str] = PUBLISHED) -> dict[str, int]:
    """Send every published table that exists and is among ``names``; row count per table sent."""
    write = write or jdbc_writer(lake.config)
    counts = {name: publish(lake, name, write) for name in PUBLISHED if name in names}
    return {name: n for name, n in counts.items() if n is not None}

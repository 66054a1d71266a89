"""Silver -> Gold."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulselake.operators import daily, spine
from pulselake.sources.lake import GOLD, SILVER, Lake, within_dates
from pulselake.sources.seals import in_batches
from pulselake.sources.workspace import settle
from pulselake.specs import PROFILE, TOPICS

log = logging.getLogger(__name__)


def audited(rows: DataFrame) -> DataFrame:
    return rows.withColumn("gold_updated_at", F.current_timestamp())


@dataclass(frozen=True)
class GoldInput:
    """The tables of a lake: whole, from one date on, or on given dates only."""

    lake: Lake
    strict_schema: bool = False
    since: dt.date | None = None
    dates: DataFrame | None = None

    @property
    def whole(self) -> bool:
        return self.since is None and self.dates is None

    def daily(self, layer: str, name: str) -> DataFrame | None:
        table = self.lake.read(layer, name)
        if table is not None and self.since is not None:
            table = table.filter(F.col("event_date") >= F.lit(self.since))
        if table is not None and self.dates is not None:
            table = within_dates(table, self.dates)
        return table

    def profile(self) -> DataFrame | None:
        """One row per user, whatever the date it was received on."""
        return self.lake.read(SILVER, "profile")


def _summary(silver_name: str, summarise: Callable[[DataFrame], DataFrame]) -> Callable[[GoldInput], DataFrame | None]:
    def build(source: GoldInput) -> DataFrame | None:
        table = source.daily(SILVER, silver_name)
        return None if table is None else summarise(table)

    return build


def _activity(source: GoldInput) -> DataFrame | None:
    return _summary("activity", lambda rows: daily.activity_summary(rows, source.profile()))(source)


def _intraday(source: GoldInput) -> DataFrame | None:
    tables = [source.daily(SILVER, f"{part}_intraday") for part in ("heart_rate", "hrv", "breathing")]
    if all(t is None for t in tables):
        return None
    return daily.intraday_summary(*tables, strict_schema=source.strict_schema)


def _wellness(source: GoldInput) -> DataFrame | None:
    tables = {name: source.daily(GOLD, name) for name in spine.WELLNESS_METRICS}
    if all(t is None for t in tables.values()):
        return None
    return spine.wellness_profile(tables, source.profile(), strict_schema=source.strict_schema)


# In build order: the wellness profile reads the tables before it.
BUILDERS: dict[str, Callable[[GoldInput], DataFrame | None]] = {
    "daily_vitals_summary": _summary("vitals", daily.vitals_summary),
    "daily_activity_summary": _activity,
    "daily_context_summary": _summary("context", daily.context_summary),
    "daily_sleep_summary": _summary("sleep", daily.sleep_summary),
    "daily_vitals_daily_summary": _summary("vitals_daily", daily.vitals_daily_summary),
    "daily_intraday_summary": _intraday,
    "daily_wellness_profile": _wellness,
}


def build_gold(source: GoldInput, name: str) -> bool:
    """Build one Gold table; False when it has no input.

    A Gold row depends on the Silver rows of its own date, so a part of the
    dates replaces those and leaves the others in place.
    """
    rows = BUILDERS[name](source)
    if rows is None:
        log.info("%s: no input, skipped", name)
        return False
    if source.whole:
        source.lake.overwrite(audited(rows), GOLD, name)
    else:
        source.lake.overwrite_dates(audited(rows), name)
    return True


def _covered(name: str) -> str:
    """Name under which Gold records the batches of a topic it has covered."""
    return f"gold/{name}"


def changed_dates(lake: Lake, refined: dict[str, dict[str, int]]) -> DataFrame:
    """Dates whose Gold rows may have changed by the batches ``refined`` of each topic.

    Those are the dates of all batches that Silver took in since Gold last
    covered them, however old the dates; a new profile changes every date of
    its user.
    """
    parts = [lake.spark.createDataFrame([], "event_date string")]
    for name, batches in refined.items():
        done = lake.refined_batches(_covered(name))
        fresh = {s: n for s, n in batches.items() if n > done.get(s, -1)}
        if not fresh:
            continue
        rows = lake.read_bronze(name, upto=batches).filter(in_batches(done, fresh))
        if name == PROFILE.name:
            users = rows.select("user_id").distinct()
            tables = [lake.read(SILVER, n) for n in TOPICS if n != name]
            parts += [t.join(users, "user_id", "left_semi").select(F.col("event_date").cast("string")) for t in tables if t is not None]
        else:
            parts.append(rows.select("event_date"))
    return settle(reduce(DataFrame.union, parts).distinct())


def run_gold(lake: Lake, *, strict_schema: bool = False, since: dt.date | None = None, full: bool = False) -> list[str]:
    """Bring all Gold tables that have input up to date; names of the tables built.

    By default only the dates that changed since the last run are rebuilt; all
    are with ``full``, for the first run, and where ``strict_schema`` may change
    the columns. ``since`` rebuilds the later dates, whatever changed.
    """
    refined = None
    source = GoldInput(lake, strict_schema, since)
    if since is None:
        refined = {name: lake.refined_batches(name) for name in TOPICS}
        # A rebuild of all dates does not ask which of them changed.
        if not (full or strict_schema or lake.read(GOLD, "daily_wellness_profile") is None):
            source = GoldInput(lake, dates=changed_dates(lake, refined))
    built = [name for name in BUILDERS if build_gold(source, name)]
    for name, batches in (refined or {}).items():
        if batches:
            lake.note_refined(_covered(name), batches)
    return built

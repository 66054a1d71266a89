"""Tables whose rebuilds appear at once: versioned folders and a small manifest.

Every rebuild writes a folder of its own. When it is complete, one manifest file
lists the folders that now make up the table: a whole version and, beside it,
versions of single dates, each with the dates it holds. A reader takes the last
manifest, so a rebuild that fails half-way changes nothing. A date belongs to
one version only; when there are many, the next rebuild of dates writes the
table anew as a whole.

Folders of the manifest before the last are kept for readers that have begun;
older ones are deleted. The first version of a table lies in the folder of its
name; without a manifest, that folder is the table if its write was finished.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulselake.sources.files import delete, exists

_MANIFEST = "name string, number int, version string, whole boolean, event_date date"
_MOST_PARTS = 12


@dataclass(frozen=True)
class Part:
    """A version and the dates it gives the table; None for all that no other part gives."""

    version: str
    dates: frozenset[dt.date | None] | None = None


def _on(dates: frozenset[dt.date | None]) -> Column:
    known = sorted(d for d in dates if d is not None)
    wanted = F.col("event_date").isin(known) if known else F.lit(False)
    return F.coalesce(wanted, F.lit(False)) | (F.col("event_date").isNull() if None in dates else F.lit(False))


class Versions:
    """The versioned tables of one folder. One writer at a time per table."""

    def __init__(self, spark: SparkSession, folder: str, read: Callable[[str, str], DataFrame | None]):
        self.spark, self.folder, self.read_folder = spark, folder, read
        self.manifests = f"{folder}_manifests"

    def _history(self, name: str) -> dict[int, list[Part]]:
        """Manifests of a table by number."""
        from pulselake.sources.lake import read_if_exists

        rows = read_if_exists(self.spark, "parquet", self.manifests, _MANIFEST)
        found: dict[int, dict[str, set | None]] = {}
        for r in [] if rows is None else rows.filter(F.col("name") == name).collect():  # bounded by the calendar
            parts = found.setdefault(r["number"], {})
            if r["whole"]:
                parts[r["version"]] = None
            else:
                parts.setdefault(r["version"], set()).add(r["event_date"])
        return {n: [Part(v, None if d is None else frozenset(d)) for v, d in parts.items()] for n, parts in found.items()}

    def live(self, name: str) -> list[Part]:
        history = self._history(name)
        if history:
            return history[max(history)]
        return [Part(name)] if exists(self.spark, f"{self.folder}/{name}/_SUCCESS") else []

    def read(self, name: str) -> DataFrame | None:
        parts = self.live(name)
        replaced = frozenset().union(*(p.dates for p in parts if p.dates is not None))
        tables = []
        for part in parts:
            rows = self.read_folder(name, f"{self.folder}/{part.version}")
            if rows is not None:
                tables.append(rows.filter(~_on(replaced) if part.dates is None else _on(part.dates)) if replaced else rows)
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables) if tables else None

    def replace(self, name: str, write: Callable[[str], None], ahead: Callable[[], object] = lambda: None) -> None:
        """Replace the table by what ``write`` puts into the folder it is given; ``ahead`` is done just before readers see it."""
        version = self._written(name, write)
        ahead()
        self._commit(name, [Part(version)])

    def replace_dates(self, name: str, write: Callable[[str], None]) -> None:
        """Replace the dates that ``write`` puts into the folder it is given, and keep all others."""
        old = self.live(name)
        if not old:
            self.replace(name, write)
            return
        version = self._written(name, write)
        rows = self.read_folder(name, f"{self.folder}/{version}")
        dates = frozenset() if rows is None else frozenset(r["event_date"] for r in rows.select("event_date").distinct().collect())
        if not dates:
            delete(self.spark, f"{self.folder}/{version}")
            return
        kept = [Part(p.version, None if p.dates is None else p.dates - dates) for p in old]
        self._commit(name, [*(p for p in kept if p.dates is None or p.dates), Part(version, dates)])

    def crowded(self, name: str) -> bool:
        """Whether the table consists of so many versions that it should be written anew."""
        return len(self.live(name)) > _MOST_PARTS

    def _written(self, name: str, write: Callable[[str], None]) -> str:
        """A new version; nothing is left of one that fails."""
        version = f"{name}@{uuid.uuid4().hex}" if exists(self.spark, f"{self.folder}/{name}") else name
        try:
            write(f"{self.folder}/{version}")
        except BaseException:
            delete(self.spark, f"{self.folder}/{version}")
            raise
        return version

    def _commit(self, name: str, parts: list[Part]) -> None:
        history = self._history(name)
        number = max(history, default=0) + 1
        rows = [(name, number, p.version, p.dates is None, d) for p in parts for d in ([None] if p.dates is None else sorted(p.dates, key=str))]
        self.spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("append").parquet(self.manifests)
        needed = {p.version for p in [*parts, *history.get(number - 1, [Part(name)])]}
        for version in {p.version for old in history.values() for p in old} - needed:
            delete(self.spark, f"{self.folder}/{version}")

"""Declared schemas of stored tables, and how they may change.

A table's schema is kept beside it as numbered JSON files, the last of which
holds. Writers declare what they are about to write: new columns are added as a
new version, a column of another type is refused before any file is written,
and columns that rows lack stay declared. Readers read with the declared schema
and not with that of some file, so older files give NULL for columns that came
later, whichever file is listed first. A table that is rebuilt as a whole takes
the schema of its rows.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from pulselake.config import LakeConfig
from pulselake.sources.files import names_in, read_text, write_text


class SchemaClash(ValueError):
    """Rows hold a column that is stored with another type."""


def _named(schema: T.StructType) -> dict[str, T.StructField]:
    return {f.name.lower(): f for f in schema}


def evolved(old: T.StructType | None, new: T.StructType, table: str) -> T.StructType:
    """The old fields and then the new ones; all may be NULL."""
    fields = {} if old is None else _named(old)
    for name, field in _named(new).items():
        known = fields.setdefault(name, field)
        if known.dataType.simpleString() != field.dataType.simpleString():
            raise SchemaClash(f"{table}.{field.name} is stored as {known.dataType.simpleString()}, not {field.dataType.simpleString()}")
    return T.StructType([T.StructField(f.name, f.dataType) for f in fields.values()])


class Schemas:
    """The declared schemas of a lake."""

    def __init__(self, spark: SparkSession, config: LakeConfig):
        self.spark, self.root = spark, config.layer("schemas")

    def _versions(self, layer: str, name: str) -> list[int]:
        found = names_in(self.spark, f"{self.root}/{layer}/{name}")
        return sorted(int(n.removesuffix(".json")) for n in found if n.removesuffix(".json").isdigit())

    def stored(self, layer: str, name: str) -> T.StructType | None:
        versions = self._versions(layer, name)
        return T.StructType.fromJson(json.loads(read_text(self.spark, f"{self.root}/{layer}/{name}/{versions[-1]}.json"))) if versions else None

    def declare(self, layer: str, name: str, rows: T.StructType, *, anew: bool = False) -> T.StructType:
        """Make room for rows of this schema; ``anew`` forgets what was declared."""
        old = self.stored(layer, name)
        schema = evolved(None if anew else old, rows, f"{layer}.{name}")
        if schema != old:
            number = max(self._versions(layer, name), default=0) + 1
            write_text(self.spark, f"{self.root}/{layer}/{name}/{number}.json", json.dumps(schema.jsonValue()))
        return schema

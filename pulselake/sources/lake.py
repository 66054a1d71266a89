"""Stored tables of the lake, partitioned by event date."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pulselake.config import LakeConfig
from pulselake.operators.refine import not_stored
from pulselake.sources.schemas import Schemas, evolved
from pulselake.sources.seals import Generations, Seals, in_batches
from pulselake.sources.versions import Versions
from pulselake.sources.workspace import freeing_shuffles, scratch, settle
from pulselake.specs import BRONZE_SCHEMA, TOPICS

BRONZE, SILVER, GOLD = "bronze", "silver", "gold"

_PROGRESS = "name string, stream_id string, batch_id long"
_ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_if_exists(spark: SparkSession, table_format: str, path: str, schema: StructType | str | None = None,
                   **options: str) -> DataFrame | None:
    """The table at ``path``, or None when nothing was ever written there."""
    reader = spark.read.format(table_format).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.load(path)
    except AnalysisException as problem:
        if str(problem.getCondition() or "").split(".")[0] in _ABSENT:
            return None
        raise


def by_date(rows: DataFrame) -> DataFrame:
    """Gather rows by date ahead of a partitioned write.

    Without it every task of the preceding shuffle would write a file into
    every date. The rebalance lets adaptive execution split a crowded date over
    several tasks and merge small ones, so no date is tied to one task.
    """
    return rows.hint("rebalance", F.col("event_date"))


class Lake:
    """Reads and writes of one lake. One writer at a time per table."""

    def __init__(self, spark: SparkSession, config: LakeConfig):
        self.spark = spark
        self.config = config
        self.seals = Seals(spark, config)
        self.generations = Generations(spark, config)
        self.schemas = Schemas(spark, config)
        self.gold = Versions(spark, config.layer(GOLD), lambda name, path: self._read_folder(GOLD, name, path))

    def schema(self, layer: str, name: str) -> StructType | None:
        """The declared schema of a table; that of a Silver table also follows from its topic."""
        stored = self.schemas.stored(layer, name)
        if layer == SILVER and name in TOPICS and stored is not None:
            return evolved(stored, TOPICS[name].silver_schema, f"{layer}.{name}")
        return stored

    def _read_folder(self, layer: str, name: str, path: str) -> DataFrame | None:
        table = read_if_exists(self.spark, self.config.table_format, path, self.schema(layer, name))
        # A table whose only dates are missing would be inferred as text.
        return None if table is None else table.withColumn("event_date", F.col("event_date").cast("date"))

    def read(self, layer: str, name: str) -> DataFrame | None:
        """The stored table, or None if it does not exist."""
        if layer == BRONZE:
            return self.read_bronze(name)
        return self.gold.read(name) if layer == GOLD else self._read_folder(layer, name, self.config.table(layer, name))

    def require(self, layer: str, name: str) -> DataFrame:
        table = self.read(layer, name)
        if table is None:
            raise FileNotFoundError(f"{layer} table {name} does not exist")
        return table

    def read_bronze(self, name: str, after_batch: int | None = None, upto: dict[str, int] | None = None) -> DataFrame | None:
        """Raw rows of one topic in sealed batches, optionally only those after a given one.

        ``upto`` names the last batch of each stream to read; without it, that
        is what is sealed now. Rows come from the generations that hold them and
        otherwise from the batches. The schema is declared, so dates stay text;
        topic, and stream and batch outside generations, are partition columns
        and prune the file listing.
        """
        upto = self.newest_batches(name) if upto is None else upto
        live = self.generations.live()
        parts = [rows.filter(~live.holds()) for rows in [self.read_batches(name)] if rows is not None]
        for generation in live.names:
            folder = self.generations.folder(generation)
            rows = read_if_exists(self.spark, self.config.table_format, f"{folder}/topic={name}", BRONZE_SCHEMA, basePath=folder)
            parts += [] if rows is None else [rows]
        if not parts or not upto:
            return None
        rows = reduce(DataFrame.unionByName, parts).filter(in_batches({}, upto))
        return rows if after_batch is None else rows.filter(F.col("batch_id") > after_batch)

    def read_batches(self, name: str | None = None) -> DataFrame | None:
        """Rows as they landed, of one topic or of all, whether sealed or rewritten or not."""
        root = self.config.layer(BRONZE)
        return read_if_exists(
            self.spark, self.config.table_format, root if name is None else f"{root}/topic={name}", BRONZE_SCHEMA, basePath=root
        )

    def append(self, rows: DataFrame, layer: str, name: str) -> None:
        self.schemas.declare(layer, name, rows.schema)
        self._write(rows, layer, name, "append")

    def overwrite(self, rows: DataFrame, layer: str, name: str) -> None:
        """Replace the table, schema included; a Gold table at once, when all is written."""
        if layer == GOLD:
            self.gold.replace(name, lambda folder: self._save(rows, folder, "overwrite"), lambda: self.schemas.declare(GOLD, name, rows.schema, anew=True))
        else:
            self.schemas.declare(layer, name, rows.schema, anew=True)
            self._write(rows, layer, name, "overwrite")

    def overwrite_dates(self, rows: DataFrame, name: str) -> None:
        """Replace the dates of a Gold table that ``rows`` contain, at once, and keep all others."""
        self.schemas.declare(GOLD, name, rows.schema)
        self.gold.replace_dates(name, lambda folder: self._save(rows, folder, "overwrite"))
        if self.gold.crowded(name):
            self.overwrite(self.require(GOLD, name), GOLD, name)

    def newest_batches(self, name: str) -> dict[str, int]:
        """Highest sealed batch of each stream with rows of the topic."""
        return self.seals.newest(name)

    def refined_batches(self, name: str) -> dict[str, int]:
        """Highest batch of each stream recorded as refined."""
        noted = read_if_exists(self.spark, "parquet", self.config.layer("progress"), _PROGRESS)
        if noted is None:
            return {}
        found = noted.filter(F.col("name") == name).groupBy("stream_id").agg(F.max("batch_id").alias("n"))
        return {r["stream_id"]: r["n"] for r in found.collect()}

    def note_refined(self, name: str, batches: dict[str, int]) -> None:
        rows = self.spark.createDataFrame([(name, s, n) for s, n in batches.items()], _PROGRESS)
        rows.coalesce(1).write.mode("append").parquet(self.config.layer("progress"))

    def insert_only(self, rows: DataFrame, layer: str, name: str, keys: Iterable[str],
                    dates: DataFrame | None = None) -> None:
        """Add the rows whose key is new; stored rows are never changed.

        ``dates`` holds the candidate dates of ``rows``. When the key implies
        the date, naming them confines the read of stored keys to the touched
        partitions; the dates are then taken from the rows themselves.
        """
        stored = self.read(layer, name)
        if stored is None:
            self.overwrite(rows, layer, name)
            return
        with scratch(self.spark):
            batch = settle(rows)  # read several times, and its size decides how the keys are joined
            if dates is not None:
                stored = within_dates(stored, batch if "event_date" in batch.columns else dates)
            self.append(not_stored(batch, stored, tuple(keys)), layer, name)

    def _write(self, rows: DataFrame, layer: str, name: str, mode: str) -> None:
        self._save(rows, self.config.table(layer, name), mode)

    def _save(self, rows: DataFrame, folder: str, mode: str) -> None:
        with freeing_shuffles(self.spark):
            by_date(rows).write.format(self.config.table_format).mode(mode).partitionBy("event_date").save(folder)


def within_dates(stored: DataFrame, dates: DataFrame) -> DataFrame:
    """Stored rows on any of ``dates``.

    A semi-join on the partition column: dynamic partition pruning then reads
    the touched dates only, however many they are, and none reach the driver.
    """
    days = dates.select(F.col("event_date").try_cast("date").alias("event_date")).distinct()
    return stored.join(days, "event_date", "left_semi")

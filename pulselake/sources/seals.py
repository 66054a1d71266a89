"""Which Bronze batches are complete, and which of them were rewritten.

Two small records stand beside the Bronze files. A seal is written after all
files of a micro-batch are in place, and a sealed batch is never written again;
readers take the seals first and then only rows of sealed batches, so they see
a batch whole or not at all. A generation is a rewrite of sealed batches into
few files: of all rows with dates before ``cut`` (or without one) in batches up
to a number per stream. Cuts and numbers only grow, so each generation holds
what the ones before do not, unless it is ``whole`` and replaces them. The
record of a generation is written after its files; from then on readers take
its rows from there and not from the batches.

Seals of a stream are written in the order of its batches, so one number per
stream says all. Both records are Parquet files in one flat folder each; a
record is one file, which the committer moves into place in one step.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulselake.config import LakeConfig
from pulselake.sources.files import delete_reported

_SEALS = "stream_id string, batch_id long, topic string, n long"
_GENERATIONS = "number int, generation string, whole boolean, cut string, stream_id string, batch_id long"


def in_batches(after: Mapping[str, int], upto: Mapping[str, int]) -> Column:
    """Rows of the batches beyond ``after``, up to ``upto``, stream by stream."""
    spans = [(F.col("stream_id") == s) & F.col("batch_id").between(after.get(s, -1) + 1, n) for s, n in upto.items()]
    return reduce(Column.__or__, spans, F.lit(False))


def _record(spark: SparkSession, path: str, schema: str, rows: list[tuple]) -> None:
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def _recorded(spark: SparkSession, path: str, schema: str) -> DataFrame:
    from pulselake.sources.lake import read_if_exists

    found = read_if_exists(spark, "parquet", path, schema)
    return spark.createDataFrame([], schema) if found is None else found


class Seals:
    """The seals of a lake's Bronze."""

    def __init__(self, spark: SparkSession, config: LakeConfig):
        self.spark, self.path = spark, config.layer("bronze_seals")

    def all(self) -> DataFrame:
        """``stream_id, batch_id, topic, n``: rows per topic of every sealed batch."""
        return _recorded(self.spark, self.path, _SEALS)

    def seal(self, stream_id: str, batch_id: int, rows: Mapping[str, int]) -> None:
        _record(self.spark, self.path, _SEALS, [(stream_id, batch_id, topic, n) for topic, n in rows.items()])

    def is_sealed(self, stream_id: str, batch_id: int) -> bool:
        """Whether this batch or a later one of its stream is sealed."""
        later = (F.col("stream_id") == stream_id) & (F.col("batch_id") >= batch_id)
        return not self.all().filter(later).isEmpty()

    def fold(self) -> None:
        """Put all seals into one file: the last batch and all rows of each stream and topic."""
        rows = self.all()
        if rows.isEmpty():
            return
        files = [r["file_path"] for r in rows.select("_metadata.file_path").distinct().collect()]
        folded = rows.groupBy("stream_id", "topic").agg(F.max("batch_id").alias("batch_id"), F.sum("n").alias("n")).collect()
        if len(files) > 1:
            _record(self.spark, self.path, _SEALS, [(r["stream_id"], r["batch_id"], r["topic"], r["n"]) for r in folded])
            for file in files:
                delete_reported(self.spark, file)

    def newest(self, topic: str | None = None) -> dict[str, int]:
        """Highest sealed batch of each stream, with rows of ``topic`` if it is given.

        There is one stream per checkpoint that ever landed rows.
        """
        found = self.all() if topic is None else self.all().filter((F.col("topic") == topic) & (F.col("n") > 0))
        return {r["stream_id"]: r["batch_id"] for r in found.groupBy("stream_id").agg(F.max("batch_id").alias("batch_id")).collect()}


@dataclass(frozen=True)
class Rewritten:
    """What the live generations hold: their names, the first date they lack, and the last batch of each stream."""

    names: tuple[str, ...] = ()
    cut: str = ""
    batches: Mapping[str, int] | None = None
    number: int = 0

    def holds(self) -> Column:
        """Whether a row of a batch is in a generation."""
        if not self.batches:
            return F.lit(False)
        return in_batches({}, self.batches) & F.coalesce(F.col("event_date") < self.cut, F.lit(True))


class Generations:
    """The record of rewritten batches."""

    def __init__(self, spark: SparkSession, config: LakeConfig):
        self.spark, self.path = spark, config.layer("bronze_generations_record")
        self.root = config.layer("bronze_generations")

    def folder(self, generation: str) -> str:
        return f"{self.root}/generation={generation}"

    def live(self) -> Rewritten:
        rows = _recorded(self.spark, self.path, _GENERATIONS).collect()  # one per generation and stream
        if not rows:
            return Rewritten()
        last = max(r["number"] for r in rows)
        base = max((r["number"] for r in rows if r["whole"]), default=0)
        names = {r["number"]: r["generation"] for r in rows if r["number"] >= base}
        latest = [r for r in rows if r["number"] == last]
        return Rewritten(tuple(names[n] for n in sorted(names)), latest[0]["cut"], {r["stream_id"]: r["batch_id"] for r in latest}, last)

    def superseded(self) -> list[str]:
        """Generations that a later whole one has replaced."""
        live = set(self.live().names)
        return sorted({r["generation"] for r in _recorded(self.spark, self.path, _GENERATIONS).select("generation").distinct().collect()} - live)

    def add(self, generation: str, number: int, cut: str, batches: Mapping[str, int], whole: bool) -> None:
        _record(self.spark, self.path, _GENERATIONS, [(number, generation, whole, cut, s, n) for s, n in batches.items()])

"""Continuous landing of topic events in Bronze, and rewriting of what has landed."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pulselake.config import LakeConfig
from pulselake.operators.envelope import to_bronze
from pulselake.sources.files import delete, delete_reported
from pulselake.sources.lake import BRONZE, Lake, read_if_exists
from pulselake.sources.seals import Rewritten, Seals
from pulselake.sources.topic_log import topic_stream
from pulselake.sources.workspace import COMPRESSION, freeing_shuffles
from pulselake.specs import BRONZE_SCHEMA, TOPICS


def stream_identity(spark: SparkSession, checkpoint: str) -> str:
    """Name of the stream that ``checkpoint`` belongs to, made on its first start.

    Batch numbers are unique within a checkpoint only. The name is kept inside
    it, so a lost or renewed checkpoint gets a new one, and its batches, which
    start at 0 again, never replace those landed before.
    """
    path = f"{checkpoint}/stream_id"
    known = read_if_exists(spark, "parquet", path, "stream_id string")
    found = None if known is None else known.agg(F.min("stream_id")).first()[0]
    if found is None:
        found = uuid.uuid4().hex
        spark.createDataFrame([(found,)], "stream_id string").coalesce(1).write.mode("append").parquet(path)
    return found


def land_batch(batch: DataFrame, batch_id: int, config: LakeConfig, stream_id: str, *, gather: bool = False) -> None:
    """Write one micro-batch and then its seal, which shows it to readers.

    A batch without a seal may be a part of one; writing it again replaces its
    own partitions. A sealed batch is left as it is. The rows per topic that
    the seal records are counted while they are written.

    A single write splits the batch by topic and date. It is map-only by
    default: topic partitions already hold one topic each and a short batch
    spans few dates. A backlog spans many, and every task would open a file in
    each; ``gather`` then brings rows of one topic and date together, letting
    adaptive execution split the crowded ones.
    """
    seals = Seals(batch.sparkSession, config)
    if seals.is_sealed(stream_id, batch_id):
        return
    seen = Observation()
    rows = batch.observe(seen, *[F.count_if(F.col("topic") == name).alias(name) for name in TOPICS])
    if gather:
        rows = rows.hint("rebalance", F.col("topic"), F.col("event_date"))
    rows = rows.withColumn("stream_id", F.lit(stream_id)).withColumn("batch_id", F.lit(batch_id).cast("long"))
    with freeing_shuffles(batch.sparkSession):
        (
            rows.write.format(config.table_format)
            .mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", COMPRESSION)
            .partitionBy("topic", "event_date", "stream_id", "batch_id")
            .save(config.layer(BRONZE))
        )
    seals.seal(stream_id, batch_id, {name: n for name, n in seen.get.items() if n})


def compact_bronze(lake: Lake, before: dt.date | str, *, whole: bool = False) -> str | None:
    """Rewrite sealed batches with dates before ``before`` into few files; the new generation, or None if nothing was left.

    Rows without a date go along. The stream may run meanwhile: batches that
    are sealed later, and later rows of the same dates, belong to the next
    generation. ``whole`` takes in the earlier generations too and replaces them.
    One topic is gathered at a time, so what is shuffled at once is a topic's
    share; the record covers them all.
    """
    upto = lake.seals.newest()
    live = lake.generations.live()
    cut = max(str(before), live.cut)
    if not upto:
        return None
    ahead = Rewritten(cut=cut, batches=upto)
    loose = lake.read_batches()
    rows = [] if loose is None else [loose.filter(ahead.holds() & ~live.holds())]
    if whole:
        root = lake.generations.root
        earlier = read_if_exists(lake.spark, lake.config.table_format, root, f"generation string, {_columns()}", basePath=root)
        rows += [] if earlier is None else [earlier.filter(F.col("generation").isin(*live.names)).drop("generation")]
    generation = uuid.uuid4().hex
    folder = lake.generations.folder(generation)
    if not rows:
        return None
    left = reduce(DataFrame.unionByName, rows)
    topics = [r["topic"] for r in left.select("topic").distinct().collect()]
    for topic in topics:
        gathered = left.filter(F.col("topic").eqNullSafe(F.lit(topic))).hint("rebalance", F.col("topic"), F.col("event_date"))
        with freeing_shuffles(lake.spark):
            (
                gathered.write.format(lake.config.table_format)
                .mode("append")
                .option("compression", COMPRESSION)
                .partitionBy("topic", "event_date")
                .save(folder)
            )
    if not topics:
        return None
    lake.generations.add(generation, live.number + 1, cut, upto, whole)
    return generation


def _columns() -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in BRONZE_SCHEMA)


def clear_bronze(lake: Lake) -> int:
    """Delete the files of batches that a generation holds, and replaced generations, and fold the seals; the number of folders deleted.

    Readers that began before the generation was recorded must have ended, so
    this is a step of its own, for a quiet moment or the next day.
    """
    live = lake.generations.live()
    loose = lake.read_batches()
    deleted = 0
    for generation in lake.generations.superseded():
        delete(lake.spark, lake.generations.folder(generation))
        deleted += 1
    if loose is not None and live.batches:
        place = F.regexp_replace("_metadata.file_path", "/[^/]+$", "")
        # A folder is one topic, date, stream and batch, all of it in a generation.
        for row in loose.filter(live.holds()).select(place.alias("place")).distinct().toLocalIterator():
            delete_reported(lake.spark, row["place"])
            deleted += 1
    lake.seals.fold()
    return deleted


def start_bronze(spark: SparkSession, config: LakeConfig, *, drain: bool = False, name: str = "bronze") -> StreamingQuery:
    """Start landing. ``drain`` works off the backlog and stops; ``name`` is that of the checkpoint."""
    checkpoint = f"{config.layer('checkpoints')}/{name}"
    stream_id = stream_identity(spark, checkpoint)

    def sink(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            land_batch(batch, batch_id, config, stream_id, gather=drain)

    writer = (
        to_bronze(topic_stream(spark, config))
        .writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"availableNow": True} if drain else {"processingTime": config.trigger}
    return writer.trigger(**trigger).start()

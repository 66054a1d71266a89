"""Keyed topics: Kafka where configured, otherwise a Parquet log.

Both carry the columns ``topic, key, value, timestamp``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulselake.config import LakeConfig
from pulselake.sources.workspace import COMPRESSION, freeing_shuffles
from pulselake.specs import TOPICS, TRANSPORT_SCHEMA


def append_events(events: DataFrame, config: LakeConfig) -> None:
    """Send transport rows; Kafka acknowledges on all replicas and retries."""
    if config.kafka_servers:
        (
            events.select("topic", "key", "value")
            .write.format("kafka")
            .option("kafka.bootstrap.servers", config.kafka_servers)
            .option("kafka.acks", "all")
            .option("kafka.retries", "3")
            .save()
        )
    else:
        with freeing_shuffles(events.sparkSession):
            events.select(*TRANSPORT_SCHEMA.names).write.mode("append").option("compression", COMPRESSION).parquet(config.layer("topics"))


def topic_stream(spark: SparkSession, config: LakeConfig) -> DataFrame:
    """The unbounded transport rows of all topics."""
    if config.kafka_servers:
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", config.kafka_servers)
            .option("subscribe", ",".join(spec.topic for spec in TOPICS.values()))
            .option("startingOffsets", config.starting_offsets)
            .option("failOnDataLoss", "false")
        )
        if config.max_offsets_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", config.max_offsets_per_trigger)
        return reader.load().select(*TRANSPORT_SCHEMA.names)
    reader = spark.readStream.schema(TRANSPORT_SCHEMA)
    if config.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", config.max_files_per_trigger)
    return reader.parquet(config.layer("topics"))

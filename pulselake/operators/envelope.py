"""Transport rows -> Bronze columns -> typed envelope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselake.functions.lenient import narrow_to_int
from pulselake.specs import PROMOTED, TOPICS


def decode(transport: DataFrame) -> DataFrame:
    """Key, value and broker time of a transport row as typed columns."""
    return transport.select(
        "topic",
        F.col("key").cast("string").alias("user_id"),
        F.col("value").cast("string").alias("document"),
        F.col("timestamp").alias("kafka_ingest_time"),
    )


def promote(decoded: DataFrame) -> DataFrame:
    """Lift the envelope fields out of the document, payload kept as JSON text.

    ``json_tuple`` reads all fields in one parse of the document.
    """
    return decoded.select(
        "topic", "user_id", "kafka_ingest_time", F.json_tuple("document", *PROMOTED).alias(*PROMOTED)
    )


def route(promoted: DataFrame) -> DataFrame:
    """Keep known topics and replace the topic by its table name."""
    names = F.create_map(*[F.lit(text) for spec in TOPICS.values() for text in (spec.topic, spec.name)])
    known = promoted.filter(F.col("topic").isin([spec.topic for spec in TOPICS.values()]))
    return known.withColumn("topic", F.try_element_at(names, F.col("topic")))


def to_bronze(transport: DataFrame) -> DataFrame:
    """The whole Bronze projection; map-only."""
    return route(promote(decode(transport)))


def typed_fields() -> dict[str, Column]:
    """Envelope text as date, int hour and timestamps; unreadable text is NULL.

    The hour goes through float because ``"7.0"`` is not int text.
    """
    return {
        "user_id": F.col("user_id"),
        "kafka_ingest_time": F.col("kafka_ingest_time"),
        "event_date": F.col("event_date").try_cast("date"),
        "event_hour": narrow_to_int(F.col("event_hour").try_cast("float")),
        "event_timestamp": F.col("event_timestamp").try_cast("timestamp"),
        "source_timestamp": F.col("source_timestamp").try_cast("timestamp"),
        "trace_id": F.col("trace_id"),
        "event_type": F.col("event_type"),
    }


def type_envelope(bronze: DataFrame) -> DataFrame:
    """The typed envelope and the payload as it is."""
    return bronze.select(*[field.alias(name) for name, field in typed_fields().items()], "payload")

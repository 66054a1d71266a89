"""Bronze rows of one topic -> clean, unique Silver rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselake.functions.lenient import narrow_to_int
from pulselake.functions.wellness import accepts
from pulselake.operators.envelope import type_envelope, typed_fields
from pulselake.operators.unique import first_per_key
from pulselake.specs import ENVELOPE, PROMOTED, Metric, TopicSpec


def _metric(metric: Metric) -> Column:
    wire = F.col(f"_wire_{metric.key}")
    if metric.kind == "whole":
        wire = narrow_to_int(wire)
    elif metric.kind == "flag":
        wire = wire.cast("boolean")
    elif metric.kind == "text_flag":
        wire = wire.try_cast("boolean")
    return wire.alias(metric.silver)


def _carried(spec: TopicSpec) -> list[str]:
    """Intraday rows keep their trace id: it is what makes them unique."""
    return ["trace_id"] if spec.intraday else []


def with_trace(bronze: DataFrame) -> DataFrame:
    """Give readings without a trace id one that their stored delivery determines.

    It is a digest of everything Bronze holds of the delivery, its arrival time
    included, so refining a delivery again changes nothing and two deliveries
    stay two readings.
    """
    stored = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("user_id", "kafka_ingest_time", *PROMOTED) if c != "trace_id"]
    return bronze.withColumn(
        "trace_id", F.coalesce("trace_id", F.concat(F.lit("untraced-"), F.md5(F.concat_ws("\x1f", *stored))))
    )


def parse_payload(bronze: DataFrame, spec: TopicSpec) -> DataFrame:
    """Typed envelope plus one column per metric.

    The payload is unfolded by a generator rather than read as a struct
    column: filters on the metrics then stay above it and each payload is
    parsed exactly once.
    """
    typed = type_envelope(with_trace(bronze) if spec.intraday else bronze)
    wire = [f"_wire_{m.key}" for m in spec.metrics]
    parsed = F.inline_outer(F.array(F.from_json("payload", spec.payload_schema))).alias(*wire)
    unfolded = typed.select(*ENVELOPE, *_carried(spec), parsed)
    return unfolded.select(*ENVELOPE, *_carried(spec), *[_metric(m) for m in spec.metrics])


def in_range(spec: TopicSpec) -> Column:
    """Conjunction of the topic's range rules; one bad field rejects the row."""
    rules = [
        accepts(F.col(m.silver), m.low, m.high)
        for m in spec.metrics
        if m.low is not None or m.high is not None
    ]
    return reduce(lambda a, b: a & b, rules, F.lit(True))


def validate(parsed: DataFrame, spec: TopicSpec) -> DataFrame:
    """Rows with their required fields and all values in range."""
    return parsed.dropna(subset=list(spec.required)).filter(in_range(spec))


def deduplicate(valid: DataFrame, spec: TopicSpec) -> DataFrame:
    """One row per key: the earliest delivery, metrics as tie-break."""
    order = [F.col("kafka_ingest_time").asc_nulls_last(), "event_timestamp", "event_type",
             *[F.col(c) for c in spec.columns]]
    return first_per_key(valid, spec.keys, order)


def refine(bronze: DataFrame, spec: TopicSpec, *, unique: bool = True, audit: bool = True) -> DataFrame:
    """The Silver rows of one topic.

    ``unique=False`` keeps every delivery (append-only intraday form).
    """
    rows = validate(parse_payload(bronze, spec), spec)
    if unique:
        rows = deduplicate(rows, spec)
    return rows.withColumn("processed_at", F.current_timestamp()) if audit else rows


def unstored(bronze: DataFrame, stored: DataFrame, spec: TopicSpec) -> DataFrame:
    """Bronze rows whose key is not stored yet, told by their envelope.

    A key goes or stays with all of its deliveries, so the rows left refine to
    the same new rows; payloads of stored keys are neither parsed nor ranked.
    Rows that lack a required field never become Silver rows and would share
    the missing keys, so they go before the keys are compared.
    """
    fields = typed_fields()
    rows = with_trace(bronze) if spec.intraday else bronze
    rows = rows.withColumns({f"_read_{name}": fields[name] for name in dict.fromkeys((*spec.keys, *spec.required))})
    rows = rows.dropna(subset=[f"_read_{name}" for name in spec.required])
    known = stored.select(*[F.col(name).alias(f"_read_{name}") for name in spec.keys])
    return rows.join(known, on=[f"_read_{name}" for name in spec.keys], how="left_anti").select(*bronze.columns)


def not_stored(batch: DataFrame, stored: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Batch rows whose key is not stored yet.

    Stored keys are first reduced to those of the batch. A batch that was
    settled has a known size: a small one is broadcast, so stored keys are
    filtered where they are read and not shuffled, and only the few that match
    meet the batch again; for a large one Spark joins both sides by key.
    """
    known = stored.select(*keys).join(batch.select(*keys), on=list(keys), how="left_semi")
    return batch.join(known, on=list(keys), how="left_anti")

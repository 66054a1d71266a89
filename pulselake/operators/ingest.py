"""Device export rows -> keyed JSON events on the transport schema."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselake.functions.lenient import (
    clock_hour,
    clock_text,
    decimal_text,
    finite,
    millisecond_text,
    text_or_null,
)
from pulselake.operators.unique import first_per_key
from pulselake.specs import (
    BREATHING_INTRADAY,
    DAILY_TOPICS,
    HEART_RATE_INTRADAY,
    HOURLY_TOPICS,
    HRV_INTRADAY,
    PROFILE,
    Metric,
    TopicSpec,
)

# The ``source`` field of each export.
HOURLY_SOURCE = "fitbit_csv"
DAILY_SOURCE = "fitbit_daily_csv"
INTRADAY_SOURCE = "synthetic_intraday"
INTRADAY_TOPICS = (HEART_RATE_INTRADAY, HRV_INTRADAY, BREATHING_INTRADAY)


def _cell(present: Collection[str], name: str) -> Column:
    """An export cell; a column the export lacks reads as missing."""
    return F.col(f"`{name}`") if name in present else F.lit(None).cast("string")


def _read_cells(present: Collection[str], specs: Sequence[TopicSpec]) -> dict[str, Column]:
    """Each topic's cells, read once: text cells and decimals."""
    metrics = {m.export_column: m for spec in specs for m in spec.metrics}
    return {
        f"_cell_{name}": (text_or_null if m.export_is_text else decimal_text)(_cell(present, name))
        for name, m in metrics.items()
    }


def _payload(metrics: Sequence[Metric]) -> Column:
    """Payload struct over the cells read before."""
    fields = []
    for metric in metrics:
        cell = F.col(f"`_cell_{metric.export_column}`")
        fields.append((cell if metric.export_is_text else finite(cell)).alias(metric.key))
    return F.struct(*fields)


def _documents(rows: DataFrame, specs: Sequence[TopicSpec], envelope: Sequence[Column], key: Column,
               payloads: dict[str, Column], ingest_time: Column) -> DataFrame:
    """One transport row per row and topic, in one pass over the rows."""
    documents = {
        spec.topic: F.to_json(
            F.struct(*envelope, F.lit(spec.name).alias("event_type"), payloads[spec.name].alias("payload"))
        )
        for spec in specs
    }
    key, moment = key.cast("binary").alias("key"), ingest_time.alias("timestamp")
    if len(documents) == 1:
        [(topic, document)] = documents.items()
        return rows.select(F.lit(topic).alias("topic"), key, document.cast("binary").alias("value"), moment)
    events = [
        F.struct(F.lit(topic).alias("topic"), document.alias("document")) for topic, document in documents.items()
    ]
    return rows.select(key, moment, F.explode(F.array(*events)).alias("event")).select(
        "event.topic", "key", F.col("event.document").cast("binary").alias("value"), "timestamp"
    )


def identified(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows whose identifying cells are neither missing nor empty."""
    present = set(rows.columns)
    for name in columns:
        rows = rows.filter(text_or_null(_cell(present, name)).isNotNull())
    return rows


def first_profile_rows(rows: DataFrame, ingest_time: Column | None = None) -> DataFrame:
    """The earliest row of each user (by date, then hour).

    Rows alike in date, hour and all profile cells differ only in their arrival
    time, so ``ingest_time`` is the last tie rule: the earliest arrival stays.
    """
    present = set(rows.columns)
    clock = clock_hour(finite(decimal_text(_cell(present, "hour"))))
    ties = [F.col(f"`{m.export_column}`").asc_nulls_last()
            for m in PROFILE.metrics if m.export_column in present]
    if ingest_time is not None:
        ties.append(ingest_time.asc_nulls_last())
    return first_per_key(rows, ["id"], [F.col("date").asc_nulls_last(), clock.asc(), *ties])


def export_events(rows: DataFrame, specs: Sequence[TopicSpec], *, source: str, hourly: bool,
                  ingest_time: Column | None = None, profile_once: bool = True) -> DataFrame:
    """Turn export rows into transport rows for the given topics.

    Non-profile topics are a map-only explode. The profile of a user is sent
    once, from the first row, unless ``profile_once`` is off.
    """
    rows = identified(rows, "id")
    ingest_time = F.current_timestamp() if ingest_time is None else ingest_time
    present = set(rows.columns)
    raw_hour = _cell(present, "hour") if hourly and "hour" in present else F.lit("0")
    date = text_or_null(_cell(present, "date"))

    def emit(part: DataFrame, chosen: Sequence[TopicSpec]) -> DataFrame:
        # Text is read in a projection of its own: later expressions that use
        # a value twice then do not parse it twice.
        read = part.select(
            F.col("id").alias("_id"),
            date.alias("_date"),
            raw_hour.alias("_hour"),
            decimal_text(raw_hour).alias("_clock"),
            ingest_time.alias("_ingest_time"),
            *[value.alias(name) for name, value in _read_cells(present, chosen).items()],
        )
        # The moment's text is in all documents of a row and is written once.
        moment = clock_text(F.col("_date"), clock_hour(finite(F.col("_clock"))))
        read = read.withColumn("_moment", F.when(F.col("_date").isNotNull(), moment))
        envelope = [
            F.col("_id").alias("user_id"),
            F.col("_date").alias("event_date"),
            F.col("_hour").alias("event_hour"),
            F.col("_moment").alias("event_timestamp"),
            F.lit(source).alias("source"),
        ]
        payloads = {spec.name: _payload(spec.metrics) for spec in chosen}
        return _documents(read, chosen, envelope, F.col("_id"), payloads, F.col("_ingest_time"))

    steady = [s for s in specs if not (profile_once and s is PROFILE)]
    parts = [emit(rows, steady)] if steady else []
    if len(steady) < len(specs):
        parts.append(emit(first_profile_rows(rows, ingest_time), [PROFILE]))
    events = parts[0]
    for part in parts[1:]:
        events = events.unionByName(part)
    return events


def hourly_events(rows: DataFrame, ingest_time: Column | None = None,
                  specs: Sequence[TopicSpec] = HOURLY_TOPICS) -> DataFrame:
    """Hourly export -> vitals, activity, context and profile events."""
    return export_events(rows, specs, source=HOURLY_SOURCE, hourly=True, ingest_time=ingest_time)


def daily_events(rows: DataFrame, ingest_time: Column | None = None,
                 specs: Sequence[TopicSpec] = DAILY_TOPICS) -> DataFrame:
    """Daily export -> sleep, HRV, breathing, daily vitals and profile events."""
    return export_events(rows, specs, source=DAILY_SOURCE, hourly=False, ingest_time=ingest_time)


def intraday_events(readings: DataFrame, *, bpm: Column, rmssd: Column, breaths: Column,
                    emitted: Column, trace_id: Column, ingest_time: Column | None = None,
                    specs: Sequence[TopicSpec] = INTRADAY_TOPICS) -> DataFrame:
    """Continuous readings -> an intraday event per row and topic, of all three topics by default.

    ``readings`` needs ``user_id``, ``event_date`` and ``event_hour``. The event
    timestamp is the emission time to the second, ``source_timestamp`` keeps
    its milliseconds. Readings are sent as measured, to three decimals; judging
    them is left to Silver.
    """
    ingest_time = F.current_timestamp() if ingest_time is None else ingest_time
    # What all documents of a reading repeat is written once.
    readings = readings.withColumns({
        "_event_timestamp": F.date_format(emitted, "yyyy-MM-dd'T'HH:mm:ss"),
        "_source_timestamp": millisecond_text(emitted),
        "_trace_id": trace_id,
    })
    envelope = [
        F.col("user_id"),
        F.col("event_date"),
        F.col("event_hour"),
        F.col("_event_timestamp").alias("event_timestamp"),
        F.col("_source_timestamp").alias("source_timestamp"),
        F.col("_trace_id").alias("trace_id"),
        F.lit(INTRADAY_SOURCE).alias("source"),
    ]
    values = dict(zip(INTRADAY_TOPICS, (bpm, rmssd, breaths)))
    payloads = {
        spec.name: F.struct(F.round(finite(values[spec]), 3).alias(spec.metrics[0].key)) for spec in specs
    }
    return _documents(readings, specs, envelope, F.col("user_id"), payloads, ingest_time)

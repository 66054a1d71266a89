"""The eleven topics, declared once.

Each topic lists its metrics: the key inside the JSON payload, the column of
the device export it comes from, the Silver column it becomes, its kind and
its accepted range. Payload schemas, flattening, casts, range checks and key
handling are all derived from these records.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import types as T

USER_DAY = ("user_id", "event_date")

# Columns every Silver table starts with.
ENVELOPE = (
    "user_id",
    "kafka_ingest_time",
    "event_date",
    "event_hour",
    "event_timestamp",
    "event_type",
)

_ENVELOPE_TYPES = (T.StringType(), T.TimestampType(), T.DateType(), T.IntegerType(), T.TimestampType(), T.StringType())
ENVELOPE_FIELDS = tuple(T.StructField(name, kind) for name, kind in zip(ENVELOPE, _ENVELOPE_TYPES, strict=True))

TOPIC_PREFIX = "wearable_"


@dataclass(frozen=True)
class Metric:
    """One payload field.

    ``kind``: ``real`` (float), ``whole`` (float on the wire, int in Silver),
    ``flag`` (0/1 float on the wire, boolean in Silver), ``text`` or
    ``text_flag`` ("True"/"False" text, boolean in Silver).
    ``sent_as_text`` marks numbers that the export sends as JSON strings.
    """

    key: str
    kind: str = "real"
    column: str | None = None
    export: str | None = None
    low: float | None = None
    high: float | None = None
    sent_as_text: bool = False

    @property
    def silver(self) -> str:
        return self.column or self.key

    @property
    def export_column(self) -> str:
        return self.export or self.key

    @property
    def wire_type(self) -> T.DataType:
        return T.StringType() if self.kind in ("text", "text_flag") else T.FloatType()

    @property
    def silver_type(self) -> T.DataType:
        kinds = {"real": T.FloatType(), "whole": T.IntegerType(), "text": T.StringType()}
        return kinds.get(self.kind, T.BooleanType())

    @property
    def export_is_text(self) -> bool:
        return self.sent_as_text or self.kind in ("text", "text_flag")


@dataclass(frozen=True)
class TopicSpec:
    """One topic: its metrics, identity and write mode."""

    name: str
    metrics: tuple[Metric, ...]
    required: tuple[str, ...] = ("user_id", "event_timestamp", "event_date")
    keys: tuple[str, ...] = ("user_id", "event_timestamp")
    intraday: bool = False

    @property
    def topic(self) -> str:
        return TOPIC_PREFIX + self.name

    @cached_property
    def payload_schema(self) -> T.StructType:
        return T.StructType([T.StructField(m.key, m.wire_type) for m in self.metrics])

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(m.silver for m in self.metrics)

    @cached_property
    def silver_schema(self) -> T.StructType:
        """The columns of the topic's Silver table."""
        carried = [T.StructField("trace_id", T.StringType())] if self.intraday else []
        metrics = [T.StructField(m.silver, m.silver_type) for m in self.metrics]
        return T.StructType([*ENVELOPE_FIELDS, *carried, *metrics, T.StructField("processed_at", T.TimestampType())])


def _flags(*names: str, prefix: str = "", renamed: dict[str, str] | None = None) -> tuple[Metric, ...]:
    renamed = renamed or {}
    return tuple(
        Metric(name, "flag", column=prefix + name.lower(), export=renamed.get(name)) for name in names
    )


# ---------------------------------------------------------------------------
# Payload keys, export columns, Silver names and inclusive bounds.
# ---------------------------------------------------------------------------
VITALS = TopicSpec(
    "vitals",
    (
        Metric("bpm", low=30, high=220),
        Metric("temperature"),
        Metric("scl_avg", low=0, high=30),
    ),
)

ACTIVITY = TopicSpec(
    "activity",
    (
        Metric("calories", low=0),
        Metric("distance", low=0),
        Metric("steps", "whole", low=0, high=30000),
        Metric("activityType", "text", column="activity_type"),
        Metric("minutes_in_default_zone_1", "whole", column="minutes_zone_1"),
        Metric("minutes_in_default_zone_2", "whole", column="minutes_zone_2"),
        Metric("minutes_in_default_zone_3", "whole", column="minutes_zone_3"),
        Metric("minutes_below_default_zone_1", "whole", column="minutes_below_zone_1"),
    ),
)

CONTEXT = TopicSpec(
    "context",
    (
        Metric("mindfulness_session", "text_flag"),
        *_flags(
            "ALERT", "HAPPY", "NEUTRAL", "RESTED_RELAXED", "SAD", "TENSE_ANXIOUS", "TIRED",
            renamed={"RESTED_RELAXED": "RESTED/RELAXED", "TENSE_ANXIOUS": "TENSE/ANXIOUS"},
        ),
        *_flags(
            "ENTERTAINMENT", "GYM", "HOME", "HOME_OFFICE", "OTHER", "OUTDOORS", "TRANSIT", "WORK_SCHOOL",
            prefix="loc_",
            renamed={"WORK_SCHOOL": "WORK/SCHOOL"},
        ),
    ),
)

PROFILE = TopicSpec(
    "profile",
    (
        Metric("badgeType", "text", column="badge_type"),
        Metric("age", "text"),
        Metric("gender", "text"),
        Metric("bmi", "text"),
        Metric("step_goal", "text"),
        Metric("min_goal", sent_as_text=True),
        Metric("max_goal", sent_as_text=True),
        Metric("step_goal_label", "text"),
    ),
    required=("user_id",),
    keys=("user_id",),
)

SLEEP = TopicSpec(
    "sleep",
    (
        Metric("sleep_duration", column="sleep_duration_ms"),
        Metric("minutes_to_fall_asleep", export="minutesToFallAsleep"),
        Metric("minutes_asleep", export="minutesAsleep", low=0),
        Metric("minutes_awake", export="minutesAwake"),
        Metric("minutes_after_wakeup", export="minutesAfterWakeup"),
        Metric("sleep_efficiency", low=0, high=100),
        Metric("sleep_deep_ratio"),
        Metric("sleep_wake_ratio"),
        Metric("sleep_light_ratio"),
        Metric("sleep_rem_ratio"),
    ),
)

HRV_SUMMARY = TopicSpec(
    "hrv_summary",
    (Metric("nremhr", low=30, high=150), Metric("rmssd", low=0, high=300)),
)

BREATHING_SUMMARY = TopicSpec(
    "breathing_summary",
    (Metric("full_sleep_breathing_rate", column="breathing_rate", low=5, high=40),),
)

VITALS_DAILY = TopicSpec(
    "vitals_daily",
    (
        Metric("spo2", low=70, high=100),
        Metric("stress_score", low=0, high=100),
        Metric("resting_hr", low=30, high=150),
        Metric("filtered_demographic_vo2max", column="vo2max", export="filteredDemographicVO2Max"),
        Metric("nightly_temperature"),
        Metric("daily_temperature_variation"),
        Metric("sleep_points_pct", export="sleep_points_percentage"),
        Metric("exertion_points_pct", export="exertion_points_percentage"),
        Metric("responsiveness_points_pct", export="responsiveness_points_percentage"),
    ),
)

HEART_RATE_INTRADAY = TopicSpec(
    "heart_rate_intraday",
    (Metric("bpm", low=30, high=220),),
    keys=("user_id", "event_timestamp", "trace_id"),
    intraday=True,
)

HRV_INTRADAY = TopicSpec(
    "hrv_intraday",
    (Metric("rmssd", low=0, high=300),),
    keys=("user_id", "event_timestamp", "trace_id"),
    intraday=True,
)

BREATHING_INTRADAY = TopicSpec(
    "breathing_intraday",
    (Metric("breaths_per_minute", low=5, high=40),),
    keys=("user_id", "event_timestamp", "trace_id"),
    intraday=True,
)
# ---------------------------------------------------------------------------

HOURLY_TOPICS = (VITALS, ACTIVITY, CONTEXT, PROFILE)
DAILY_TOPICS = (SLEEP, HRV_SUMMARY, BREATHING_SUMMARY, VITALS_DAILY, PROFILE)
INTRADAY_TOPICS = (HEART_RATE_INTRADAY, HRV_INTRADAY, BREATHING_INTRADAY)

TOPICS: dict[str, TopicSpec] = {
    spec.name: spec
    for spec in (
        VITALS, ACTIVITY, CONTEXT, PROFILE,
        SLEEP, HRV_SUMMARY, BREATHING_SUMMARY, VITALS_DAILY,
        *INTRADAY_TOPICS,
    )
}

TRANSPORT_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# Envelope fields promoted out of the JSON document, all kept as text.
PROMOTED = (
    "event_date",
    "event_hour",
    "event_timestamp",
    "source_timestamp",
    "trace_id",
    "event_type",
    "payload",
)

BRONZE_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("kafka_ingest_time", T.TimestampType()),
        *[T.StructField(name, T.StringType()) for name in PROMOTED if name != "event_date"],
        T.StructField("topic", T.StringType()),
        T.StructField("event_date", T.StringType()),
        T.StructField("stream_id", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

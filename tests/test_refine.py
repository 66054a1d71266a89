import pytest
from pyspark.sql import functions as F

from pulselake.operators.envelope import to_bronze, type_envelope
from pulselake.operators.refine import refine
from pulselake.specs import BRONZE_SCHEMA, ENVELOPE, TOPICS
from tests.rows import bronze, bronze_row, moment, one, transport


def refined(spark, name, *rows, **options):
    return refine(bronze(spark, *rows), TOPICS[name], audit=False, **options)


@pytest.mark.parametrize("name", sorted(TOPICS))
def test_silver_columns(spark, name):
    spec = TOPICS[name]
    trace = ["trace_id"] if spec.intraday else []
    silver = refine(bronze(spark), spec)
    assert silver.columns == [*ENVELOPE, *trace, *spec.columns, "processed_at"]


def test_numeric_text_in_a_float_field_is_null(spark):
    row = one(refined(spark, "vitals", bronze_row({"bpm": "72.5", "temperature": 1.5})))
    assert row["bpm"] is None and row["temperature"] == 1.5


@pytest.mark.parametrize("name, payload, kept", [
    ("vitals", {"bpm": 30}, 1), ("vitals", {"bpm": 220}, 1), ("vitals", {"bpm": 221}, 0), ("vitals", {"bpm": 29.9}, 0),
    ("vitals", {"bpm": None}, 1), ("vitals", {"scl_avg": 30.1}, 0), ("vitals", {"temperature": -99}, 1),
    ("activity", {"steps": 0}, 1), ("activity", {"steps": 30000}, 1), ("activity", {"steps": 30001}, 0),
    ("activity", {"steps": 30000.9}, 1), ("activity", {"steps": -0.5}, 1), ("activity", {"steps": 3e10}, 0),
    ("activity", {"steps": -1}, 0), ("activity", {"calories": -0.1}, 0), ("activity", {"distance": -0.1}, 0),
    ("sleep", {"sleep_efficiency": 100.1}, 0), ("sleep", {"minutes_asleep": -1}, 0), ("sleep", {"minutes_awake": -1}, 1),
    ("hrv_summary", {"nremhr": 29}, 0), ("hrv_summary", {"rmssd": 300.1}, 0), ("hrv_summary", {"nremhr": 150}, 1),
    ("breathing_summary", {"full_sleep_breathing_rate": 4.9}, 0),
    ("breathing_summary", {"full_sleep_breathing_rate": 40}, 1),
    ("vitals_daily", {"spo2": 69.9}, 0), ("vitals_daily", {"resting_hr": 151}, 0),
    ("vitals_daily", {"stress_score": 100.5}, 0), ("vitals_daily", {"stress_score": 100}, 1),
    ("heart_rate_intraday", {"bpm": 221}, 0), ("hrv_intraday", {"rmssd": -1}, 0),
    ("breathing_intraday", {"breaths_per_minute": 40.5}, 0), ("breathing_intraday", {"breaths_per_minute": 5}, 1),
])
def test_bounds(spark, name, payload, kept):
    assert refined(spark, name, bronze_row(payload, trace="t")).count() == kept


def test_narrowed_values(spark):
    row = one(refined(spark, "activity", bronze_row(
        {"steps": 134.9, "minutes_in_default_zone_1": 3e10, "activityType": "Walk"})))
    assert (row["steps"], row["minutes_zone_1"], row["activity_type"]) == (134, 2147483647, "Walk")


def test_flags(spark):
    row = one(refined(spark, "context", bronze_row(
        {"mindfulness_session": "True", "ALERT": 1.0, "HAPPY": 0.0, "SAD": None, "HOME": 2})))
    assert (row["mindfulness_session"], row["alert"], row["happy"], row["sad"], row["loc_home"]) == (
        True, True, False, None, True)
    odd = one(refined(spark, "context", bronze_row({"mindfulness_session": "0.0"})))
    assert odd["mindfulness_session"] is None


def test_profile_goals_sent_as_text_are_null(spark):
    row = one(refined(spark, "profile", bronze_row({"min_goal": "5", "step_goal": "5000", "badgeType": "x"})))
    assert (row["min_goal"], row["step_goal"], row["badge_type"]) == (None, "5000", "x")


@pytest.mark.parametrize("fields, kept", [
    ({"user": None}, 0), ({"stamp": "2021-05-24T24:00:00"}, 0), ({"stamp": None}, 0), ({"date": None}, 0),
    ({"date": "bad"}, 0), ({"hour": "x"}, 1), ({"hour": None}, 1),
])
def test_required_fields(spark, fields, kept):
    assert refined(spark, "vitals", bronze_row({"bpm": 70}, **fields)).count() == kept


def test_profile_needs_a_user_only(spark):
    assert refined(spark, "profile", bronze_row({}, stamp=None, date=None)).count() == 1
    assert refined(spark, "profile", bronze_row({}, user=None)).count() == 0


def test_unreadable_payload_keeps_the_row(spark):
    assert one(refined(spark, "vitals", bronze_row("{broken")))["bpm"] is None
    assert one(refined(spark, "vitals", bronze_row(None)))["bpm"] is None


def test_hours(spark):
    hours = type_envelope(bronze(spark, *[bronze_row({}, hour=h) for h in ("7.0", "0.0", "0", "x", None)]))
    assert [r["event_hour"] for r in hours.collect()] == [7, 0, 0, None, None]


def test_bare_nan_loses_the_row(spark):
    value = '{"event_date":"2021-05-24","event_timestamp":"2021-05-24T07:00:00","payload":{"bpm":NaN}}'
    rows = transport(spark, ("wearable_vitals", "u", value, "2021-05-24T08:00:00"))
    assert refine(to_bronze(rows), TOPICS["vitals"]).count() == 0


def test_earliest_delivery_wins(spark):
    row = one(refined(
        spark, "vitals",
        bronze_row({"bpm": 80}, ingest="2021-05-25T00:00:02"),
        bronze_row({"bpm": 70}, ingest="2021-05-25T00:00:01"),
        bronze_row({"bpm": 500}, ingest="2021-05-25T00:00:00"),
    ))
    assert row["bpm"] == 70.0


def test_equal_deliveries_break_ties_by_value(spark):
    rows = [bronze_row({"bpm": b}) for b in (90, 71, 80)]
    assert one(refined(spark, "vitals", *rows))["bpm"] == 71.0
    assert one(refined(spark, "vitals", *rows[::-1]))["bpm"] == 71.0


def test_crowded_key_is_limited_before_the_shuffle(spark):
    silver = refined(spark, "vitals", bronze_row({"bpm": 70}))
    plan = silver._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange hashpartitioning(user_id") < plan.index("Partial")


def test_payload_is_parsed_once(spark):
    plan = refined(spark, "activity", bronze_row({"steps": 1}))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_intraday_refines_in_one_scan(spark, folder):
    bronze(spark, bronze_row({"bpm": 70}, trace="a"), bronze_row({"bpm": 71})).write.parquet(f"{folder}/b")
    rows = spark.read.schema(BRONZE_SCHEMA).parquet(f"{folder}/b")
    plan = refine(rows, TOPICS["heart_rate_intraday"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("from_json(") == 1


def test_readings_out_of_range_are_rejected(spark):
    for kind, field, good, bad in (("heart_rate_intraday", "bpm", 220.0, 250.0), ("hrv_intraday", "rmssd", 250.0, 301.0),
                                   ("breathing_intraday", "breaths_per_minute", 5.0, 3.0)):
        rows = [bronze_row({field: good}, trace="a", kind=kind), bronze_row({field: bad}, trace="b", kind=kind)]
        assert [r[field] for r in refined(spark, kind, *rows).collect()] == [good]


def test_intraday_trace_identifies_a_reading(spark):
    rows = [bronze_row({"bpm": 70}, trace="a"), bronze_row({"bpm": 70}, trace="a", ingest="2021-05-26T00:00:00"),
            bronze_row({"bpm": 71}, trace="b"), bronze_row({"bpm": 72}), bronze_row({"bpm": 72}, ingest="2021-05-26T00:00:00")]
    assert refined(spark, "heart_rate_intraday", *rows).count() == 4
    assert refined(spark, "heart_rate_intraday", *rows, unique=False).count() == 5


def test_source_timestamp_is_typed(spark):
    row = one(type_envelope(bronze(spark, bronze_row({}, source="2026-01-01T00:00:00.123", trace="t"))))
    assert row["source_timestamp"] == moment("2026-01-01T00:00:00.123")

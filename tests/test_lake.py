import json

import pytest
from pyspark.sql import functions as F

from pulselake.config import LakeConfig
from pulselake.operators.envelope import to_bronze
from pulselake.operators.quality import latency_summary
from pulselake.plans.gold import run_gold
from pulselake.plans.insights import score_lake, score_stored
from pulselake.plans.lake_run import LayerMissing, layer_presence, run_lake
from pulselake.plans.silver import refine_topic, run_silver
from pulselake.sources.jdbc import jdbc_writer, publish, publish_all
from pulselake.sources.lake import BRONZE, GOLD, SILVER, Lake, within_dates
from pulselake.sources.topic_log import append_events
from pulselake.specs import TOPICS
from pulselake.streaming.bronze import land_batch, start_bronze, stream_identity
from tests.rows import bronze, bronze_row, day, moment, one, transport
from workload import device

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def lake(spark, folder):
    return Lake(spark, LakeConfig(f"{folder}/lake"))


def land(lake, batch, *rows, stream="s1"):
    land_batch(bronze(lake.spark, *rows).drop("batch_id", "stream_id"), batch, lake.config, stream)


def test_missing_tables(lake):
    assert all(lake.read(layer, "vitals") is None for layer in (BRONZE, SILVER, GOLD))
    with pytest.raises(FileNotFoundError):
        lake.require(SILVER, "vitals")
    assert run_silver(lake) == [] and run_gold(lake) == []
    with pytest.raises(LayerMissing):
        run_lake(lake)


def test_replayed_batch_adds_nothing(lake):
    rows = [bronze_row({"bpm": 70}), bronze_row({"bpm": 71}, user="u2"), bronze_row({}, kind="sleep", date=None)]
    for batch in (0, 1, 1, 0):
        land(lake, batch, *rows)
    assert lake.read_bronze("vitals").count() == 4
    assert lake.read_bronze("sleep").count() == 2
    assert lake.read_bronze("vitals", after_batch=0).count() == 2
    assert dict(lake.read_bronze("vitals").dtypes)["event_date"] == "string"


def test_gathered_backlog_has_one_file_per_topic_and_date(spark, lake):
    import glob
    rows = [bronze_row({"bpm": 70}, user=f"u{i}", date=f"2021-05-{1 + i % 3:02d}") for i in range(60)]
    batch = bronze(spark, *rows).drop("batch_id", "stream_id").repartition(8)
    land_batch(batch, 0, lake.config, "s1", gather=True)
    assert len(glob.glob(f"{lake.config.layer(BRONZE)}/topic=vitals/*/*/batch_id=0/*.parquet")) == 3
    land_batch(batch, 0, lake.config, "s1")
    assert lake.read_bronze("vitals").count() == 60


def test_a_new_checkpoint_replaces_nothing(spark, lake):
    import shutil

    checkpoint = f"{lake.config.layer('checkpoints')}/bronze"
    spec = TOPICS["heart_rate_intraday"]

    def arrive(*stamps):
        documents = [json.dumps({"user_id": "u1", "event_date": s[:10], "event_hour": "7.0", "event_timestamp": s,
                                 "event_type": spec.name, "payload": {"bpm": 70.0}}) for s in stamps]
        append_events(transport(spark, *[(spec.topic, "u1", d, s) for d, s in zip(documents, stamps)]), lake.config)
        start_bronze(spark, lake.config, drain=True).awaitTermination()

    arrive("2021-05-24T07:00:00", "2021-05-24T07:00:01")
    first = stream_identity(spark, checkpoint)
    assert refine_topic(lake, spec, new_only=True)
    shutil.rmtree(checkpoint)
    shutil.rmtree(lake.config.layer("topics"))  # old events have expired
    arrive("2021-05-24T09:00:00")
    assert stream_identity(spark, checkpoint) != first
    assert lake.read_bronze(spec.name).count() == 3
    assert lake.read_bronze(spec.name).select("stream_id").distinct().count() == 2
    assert refine_topic(lake, spec, new_only=True)
    assert lake.require(SILVER, spec.name).count() == 3
    assert len(lake.refined_batches(spec.name)) == 2


def test_untraced_readings_are_refined_once(lake):
    kind = "heart_rate_intraday"
    land(lake, 0, bronze_row({"bpm": 70}, kind=kind), bronze_row({"bpm": 71}, kind=kind, trace="t"))
    for _ in range(3):
        run_silver(lake)
    assert lake.require(SILVER, kind).count() == 2
    # The same reading delivered again, later, is a reading of its own.
    land(lake, 1, bronze_row({"bpm": 70}, kind=kind, ingest="2021-05-26T00:00:00"))
    for _ in range(2):
        run_silver(lake)
    assert lake.require(SILVER, kind).count() == 3


def test_silver_twice_is_silver_once(lake):
    land(lake, 0, bronze_row({"bpm": 70}), bronze_row({"bpm": 80}, trace="t", kind="heart_rate_intraday"))
    for _ in range(2):
        assert run_silver(lake) == ["vitals", "heart_rate_intraday"]
    assert lake.require(SILVER, "vitals").count() == 1
    assert lake.require(SILVER, "heart_rate_intraday").count() == 1


def test_later_delivery_never_replaces(lake):
    land(lake, 0, bronze_row({"bpm": 70}))
    run_silver(lake)
    land(lake, 1, bronze_row({"bpm": 99}), bronze_row({"bpm": 60}, stamp="2021-05-24T08:00:00", hour="8.0"))
    run_silver(lake, after_batch=0)
    rows = {r["event_hour"]: r["bpm"] for r in lake.require(SILVER, "vitals").collect()}
    assert rows == {7: 70.0, 8: 60.0}


def test_profile_is_kept_once_for_ever(lake):
    land(lake, 0, bronze_row({"age": "<30"}, kind="profile"))
    run_silver(lake)
    land(lake, 1, bronze_row({"age": ">=30"}, kind="profile", date="2021-06-01", stamp="2021-06-01T00:00:00"))
    run_silver(lake)
    assert one(lake.require(SILVER, "profile"))["age"] == "<30"


def test_append_only_intraday_grows(lake):
    land(lake, 0, bronze_row({"bpm": 80}, trace="t", kind="heart_rate_intraday"))
    for _ in range(2):
        refine_topic(lake, TOPICS["heart_rate_intraday"], append_only_intraday=True)
    assert lake.require(SILVER, "heart_rate_intraday").count() == 2


def test_new_only_reads_each_batch_once(lake):
    spec = TOPICS["heart_rate_intraday"]
    land(lake, 0, bronze_row({"bpm": 80}, kind=spec.name))
    for _ in range(2):
        assert refine_topic(lake, spec, new_only=True, append_only_intraday=True)
    assert lake.require(SILVER, spec.name).count() == 1 and lake.refined_batches(spec.name) == {"s1": 0}
    land(lake, 1, bronze_row({"bpm": 81}, kind=spec.name))
    assert refine_topic(lake, spec, new_only=True, append_only_intraday=True)
    assert lake.require(SILVER, spec.name).count() == 2 and lake.refined_batches(spec.name) == {"s1": 1}
    assert not refine_topic(lake, TOPICS["sleep"], new_only=True)


def test_gold_of_all_dates_does_not_ask_which_changed(lake, monkeypatch):
    land(lake, 0, bronze_row({"bpm": 70}))
    run_silver(lake)
    with monkeypatch.context() as patched:
        patched.setattr("pulselake.plans.gold.changed_dates", None)
        assert "daily_wellness_profile" in run_gold(lake) and run_gold(lake, full=True)
    land(lake, 1, bronze_row({"bpm": 90}, stamp="2021-05-24T09:00:00"))
    run_silver(lake)
    run_gold(lake)
    assert one(lake.require(GOLD, "daily_wellness_profile"))["avg_bpm"] == 80.0


def test_gold_since_leaves_earlier_dates(lake):
    land(lake, 0, bronze_row({"bpm": 70}), bronze_row({"bpm": 80}, date="2021-05-25", stamp="2021-05-25T07:00:00"))
    run_silver(lake)
    run_gold(lake)
    land(lake, 1, bronze_row({"bpm": 90}, stamp="2021-05-24T09:00:00"),
         bronze_row({"bpm": 100}, date="2021-05-25", stamp="2021-05-25T09:00:00"))
    run_silver(lake)
    run_gold(lake, since=day("2021-05-25"))
    for name in ("daily_vitals_summary", "daily_wellness_profile"):
        rows = {str(r["event_date"]): r["avg_bpm"] for r in lake.require(GOLD, name).collect()}
        assert rows == {"2021-05-24": 70.0, "2021-05-25": 90.0}
    run_gold(lake)
    rows = {str(r["event_date"]): r["avg_bpm"] for r in lake.require(GOLD, "daily_wellness_profile").collect()}
    assert rows == {"2021-05-24": 80.0, "2021-05-25": 90.0}


def test_gold_follows_late_rows(lake):
    days = ("2021-05-24", "2021-05-25")
    land(lake, 0, *[bronze_row({"bpm": 70}, date=d, stamp=f"{d}T07:00:00") for d in days],
         *[bronze_row({"steps": 100.0, "calories": 1.0, "distance": 1.0}, kind="activity", date=d, stamp=f"{d}T07:00:00") for d in days])
    run_silver(lake, new_only=True)
    run_gold(lake)
    before = {r["event_date"]: r["gold_updated_at"] for r in lake.require(GOLD, "daily_vitals_summary").collect()}
    # A late row for the earlier day, in a batch of its own.
    land(lake, 1, bronze_row({"bpm": 90}, stamp="2021-05-24T09:00:00"))
    run_silver(lake, new_only=True)
    run_gold(lake)
    rows = {r["event_date"]: r for r in lake.require(GOLD, "daily_vitals_summary").collect()}
    assert rows[day(days[0])]["avg_bpm"] == 80.0 and rows[day(days[1])]["avg_bpm"] == 70.0
    assert rows[day(days[1])]["gold_updated_at"] == before[day(days[1])] < rows[day(days[0])]["gold_updated_at"]
    assert {r["event_date"]: r["avg_bpm"] for r in lake.require(GOLD, "daily_wellness_profile").collect()} == {
        day(days[0]): 80.0, day(days[1]): 70.0}
    # A profile that comes later changes all days of its user.
    land(lake, 2, bronze_row({"age": "<30", "step_goal": "50"}, kind="profile", date="2021-06-01", stamp="2021-06-01T00:00:00"))
    run_silver(lake, new_only=True)
    run_gold(lake)
    found = lake.require(GOLD, "daily_wellness_profile").collect()
    assert {(r["age"], r["goal_met_steps"]) for r in found} == {("<30", True)} and len(found) == 2
    # Nothing new: nothing is rebuilt.
    stamps = sorted(r["gold_updated_at"] for r in found)
    run_gold(lake)
    assert sorted(r["gold_updated_at"] for r in lake.require(GOLD, "daily_wellness_profile").collect()) == stamps


def test_merge_reads_touched_dates_only(spark, lake):
    rows = spark.createDataFrame([("u", day(f"2021-01-0{i}")) for i in (1, 2, 3)], "user_id string, event_date date")
    lake.overwrite(rows, SILVER, "t")
    dates = spark.createDataFrame([("2021-01-02",), ("bad",), (None,)], "event_date string")
    touched = within_dates(lake.require(SILVER, "t"), dates)
    assert one(touched)["event_date"] == day("2021-01-02")
    assert "LeftSemi" in touched._jdf.queryExecution().executedPlan().toString()
    many = spark.createDataFrame([("2021-01-01",), ("2021-01-03",)], "event_date string")
    assert within_dates(lake.require(SILVER, "t"), many).count() == 2
    assert within_dates(lake.require(SILVER, "t"), dates.filter("false")).count() == 0


def test_write_leaves_one_file_per_small_date(spark, lake):
    import glob
    rows = spark.range(0, 1000, 1, 8).select(
        F.col("id").cast("string").alias("user_id"), F.expr("date_add(date'2021-01-01', cast(id % 5 as int))").alias("event_date"))
    lake.overwrite(rows, GOLD, "t")
    assert len(glob.glob(f"{lake.config.table(GOLD, 't')}/event_date=*/*.parquet")) == 5


def test_overwrite_changes_the_schema(spark, lake):
    lake.overwrite(spark.createDataFrame([("u", day("2021-01-01"), 1)], "user_id string, event_date date, a int"), GOLD, "t")
    lake.overwrite(spark.createDataFrame([("u", day("2021-01-02"), "x")], "user_id string, event_date date, b string"), GOLD, "t")
    assert lake.require(GOLD, "t").columns == ["user_id", "b", "event_date"]
    assert lake.require(GOLD, "t").count() == 1


def test_table_of_missing_dates_only_reads_as_date(spark, lake):
    lake.overwrite(spark.createDataFrame([("u", None)], "user_id string, event_date date"), SILVER, "t")
    assert dict(lake.require(SILVER, "t").dtypes)["event_date"] == "date"


def test_unknown_topics_are_not_landed(spark, lake):
    append_events(transport(spark, ("other", "u", "{}", "2021-05-24T00:00:00"), (None, "u", "{}", "2021-05-24T00:00:00")),
                  lake.config)
    start_bronze(spark, lake.config, drain=True).awaitTermination()
    assert layer_presence(lake, BRONZE).filter("table_exists").count() == 0


def test_stream_resumes_from_its_checkpoint(spark, lake):
    event = '{"event_date":"2021-05-24","event_timestamp":"2021-05-24T07:00:00","event_type":"vitals","payload":{"bpm":70}}'
    for n in (1, 2):
        append_events(transport(spark, ("wearable_vitals", "u", event, "2021-05-24T08:00:00")), lake.config)
        start_bronze(spark, lake.config, drain=True).awaitTermination()
        assert lake.read_bronze("vitals").count() == n
    batches = {r["batch_id"] for r in lake.read_bronze("vitals").select("batch_id").distinct().collect()}
    assert len(batches) == 2


def test_whole_lake(spark, lake):
    append_events(device.all_transport(spark, SF), lake.config)
    start_bronze(spark, lake.config, drain=True).awaitTermination()
    sent = {}

    def writer(rows, table):
        rows.write.mode("overwrite").parquet(f"{lake.config.root}/published/{table}")
        sent[table] = rows.columns

    report = run_lake(lake, writer=writer)
    assert report["silver"] == list(TOPICS)
    assert report["insights"]["model_version"] == "1"
    assert len(report["gold"]) == 7 and len(report["published"]) == 8
    for name, count in report["published"].items():
        assert lake.require(GOLD, name).count() == count > 0
    assert "gold_updated_at" in sent["daily_wellness_profile"] and "gold_updated_at" not in sent["ai_insights"]
    before = {n: c for n, c in report["published"].items()}
    assert run_lake(lake, writer=writer)["published"] == before
    presence = layer_presence(lake, GOLD).collect()
    assert all(r["table_exists"] and r["n"] > 0 for r in presence)
    # The present windows, standardised as the stored model was, score as they did in the run.
    assert score_lake(lake).count() == lake.require(GOLD, "ai_insights").count()


def test_only_tables_of_this_run_are_published(lake):
    land(lake, 0, bronze_row({"bpm": 70}))
    stale = lake.spark.createDataFrame([("old", day("2021-01-01"))], "run string, event_date date")
    lake.overwrite(stale, GOLD, "ai_insights")
    report = run_lake(lake, writer=lambda rows, table: rows.count())
    assert "no Silver table" in report["insights_skipped"] and "insights" not in report
    assert set(report["published"]) == {"daily_vitals_summary", "daily_wellness_profile"}


def test_publish_skips_missing_and_needs_a_url(lake):
    assert publish(lake, "ai_insights", lambda rows, table: None) is None
    assert publish_all(lake, lambda rows, table: None) == {}
    with pytest.raises(ValueError):
        jdbc_writer(lake.config)


def test_latency(spark):
    rows = spark.createDataFrame(
        [("a", moment("2021-01-01T00:00:01"), moment("2021-01-01T00:00:00")),
         ("a", moment("2021-01-01T00:00:03"), moment("2021-01-01T00:00:00")),
         ("b", moment("2021-01-01T00:00:05"), moment("2021-01-01T00:00:00")),
         ("b", moment("2021-01-01T00:00:05"), None)],
        "event_type string, kafka_ingest_time timestamp, source_timestamp timestamp")
    found = {r["event_type"]: r for r in latency_summary(rows).collect()}
    assert found["a"]["mean_seconds"] == 2.0 and found["a"]["sd_seconds"] == pytest.approx(2 ** 0.5)
    assert (found["b"]["events"], found["b"]["sd_seconds"]) == (1, 0.0)

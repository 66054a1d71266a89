"""The driver's tables as device exports.

``events`` stands for the device exports: every event is one hourly row, one
daily row and one continuous reading of its user. ``customer`` stands for the
profile export. All cells are text, as a CSV reader would deliver them; a
missing cell is NULL. Ranges are chosen so that every range rule rejects some
rows and every tie rule decides some groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulselake.operators.envelope import to_bronze
from pulselake.operators.ingest import DAILY_SOURCE, HOURLY_SOURCE, INTRADAY_TOPICS, export_events, intraday_events
from pulselake.operators.refine import refine
from pulselake.sources.workspace import fresh_folder
from pulselake.specs import BRONZE_SCHEMA, DAILY_TOPICS, HOURLY_TOPICS, PROFILE, TOPICS, TopicSpec

# Tasks per core that make documents, so that slow ones even out.
_WAVES = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, read as it is."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(rows: DataFrame, key: str) -> DataFrame:
    """The rows over all cores, however few parts of a file hold them.

    A scan has one task per row group at most, and a narrow row becomes eleven
    documents: dealing the rows out costs far less than one task making them all.
    """
    return rows.repartition(_WAVES * rows.sparkSession.sparkContext.defaultParallelism, key)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Read ahead of the dealing, which the exports share: each row's JSON is then read once and does not travel.
    rows = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    return dealt(rows, "event_id")


def _text(value: Column, name: str, missing: Column | None = None) -> Column:
    cell = value.cast("string")
    return (cell if missing is None else F.when(~missing, cell)).alias(name)


def _pick(selector: Column, *labels: str | None) -> Column:
    choice = F.lit(None).cast("string")
    for i, label in enumerate(labels):
        if label is not None:
            choice = F.when(selector % len(labels) == i, F.lit(label)).otherwise(choice)
    return choice


def _flag(test: Column) -> Column:
    return F.when(test, F.lit("1.0")).otherwise(F.lit("0.0"))


def _identity() -> list[Column]:
    return [
        _text(F.col("user_id"), "id"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.concat(F.hour("ts").cast("string"), F.lit(".0")).alias("hour"),
        F.col("ts").cast("timestamp").alias("delivered"),
    ]


def hourly_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly export."""
    k, v, user = F.col("k"), F.col("value"), F.col("user_id")
    moods = {
        "ALERT": k % 2 == 0, "HAPPY": k % 3 == 0, "NEUTRAL": k % 5 == 0, "RESTED/RELAXED": k % 4 == 1,
        "TENSE/ANXIOUS": k % 7 == 2, "TIRED": k % 2 == 1,
    }
    places = ("ENTERTAINMENT", "GYM", "HOME", "HOME_OFFICE", "OTHER", "OUTDOORS", "TRANSIT", "WORK/SCHOOL")
    return _events(spark, sf_dir).select(
        *_identity(),
        _text(40 + 2 * k, "bpm", k % 10 == 0),
        _text(v - 10, "temperature"),
        _text(v, "scl_avg"),
        _text(10 * v - 5, "calories"),
        _text(v, "distance"),
        _text((350 * k).cast("double"), "steps"),
        F.when(k % 7 != 0, _pick(k, "Bike", "Run", "Sport", "Walk")).alias("activityType"),
        _text((k % 60).cast("double"), "minutes_in_default_zone_1"),
        _text((k % 30).cast("double"), "minutes_in_default_zone_2", k % 6 == 0),
        _text((k % 15).cast("double"), "minutes_in_default_zone_3"),
        _text((60 - k % 60).cast("double"), "minutes_below_default_zone_1"),
        F.when(k % 9 == 0, "True").otherwise("False").alias("mindfulness_session"),
        *[_flag(test).alias(name) for name, test in moods.items()],
        F.when(k % 11 != 0, _flag(k % 3 == 0)).alias("SAD"),
        *[_flag(k % 8 == i).alias(name) for i, name in enumerate(places)],
        _pick(k, "LIFETIME_DISTANCE", "DAILY_STEPS").alias("badgeType"),
        _pick(k, "<30", ">=30", None).alias("age"),
        _pick(user, "MALE", "FEMALE").alias("gender"),
        _pick(k, "<19", None, "<25", ">=30").alias("bmi"),
        F.when(k % 4 == 0, ">=10").when(k % 4 != 1, (k * 100).cast("string")).alias("step_goal"),
        _text(k * 100.0, "min_goal"),
        _text(k * 200.0, "max_goal"),
        _pick(k, "low", "medium", "high").alias("step_goal_label"),
    )


def daily_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily export; users with ids ending in 9 have no SpO2 sensor."""
    k, v, user = F.col("k"), F.col("value"), F.col("user_id")
    return _events(spark, sf_dir).select(
        *_identity(),
        _text(k * 360000.0, "sleep_duration"),
        _text(k % 20, "minutesToFallAsleep"),
        _text(4 * k - 8, "minutesAsleep", k % 3 == 0),
        _text(k % 45, "minutesAwake"),
        _text(k % 5, "minutesAfterWakeup"),
        _text(k + 5, "sleep_efficiency"),
        _text(k / 128.0, "sleep_deep_ratio"),
        _text((k % 10) / 64.0, "sleep_wake_ratio"),
        _text((k % 50) / 64.0, "sleep_light_ratio"),
        _text(v / 1024.0, "sleep_rem_ratio"),
        _text(60 + k, "nremhr"),
        _text(k * 3.25, "rmssd", k % 13 == 0),
        _text(4 + k * 0.375, "full_sleep_breathing_rate"),
        _text(69 + k * 0.3125, "spo2", user % 10 == 9),
        _text(k + 5, "stress_score", k % 4 == 0),
        _text(28 + k * 1.25, "resting_hr", k % 5 == 0),
        _text(20 + k * 0.25, "filteredDemographicVO2Max"),
        _text(v / 16.0, "nightly_temperature"),
        _text((k - 50) / 8.0, "daily_temperature_variation"),
        _text(k / 128.0, "sleep_points_percentage"),
        _text((k % 40) / 64.0, "exertion_points_percentage"),
        _text((k % 25) / 32.0, "responsiveness_points_percentage"),
    )


def profile_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile export: one row per customer."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    return table(spark, sf_dir, "customer").select(
        _text(key, "id"),
        F.lit("2024-01-01").alias("date"),
        F.lit("0.0").alias("hour"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("delivered"),
        _pick(nation, "LIFETIME_DISTANCE", "DAILY_STEPS").alias("badgeType"),
        F.col("c_mktsegment").alias("age"),
        _pick(key, "MALE", "FEMALE").alias("gender"),
        _pick(nation, "<19", None, "<25").alias("bmi"),
        F.when(key % 3 == 0, ">=10").when(key % 3 == 1, (1000 + nation * 1500).cast("string")).alias("step_goal"),
        _text(nation * 100.0, "min_goal"),
        _text(nation * 200.0, "max_goal"),
        _pick(nation, "low", "medium", "high").alias("step_goal_label"),
    )


def intraday_transport(spark: SparkSession, sf_dir: str, untraced: bool = False,
                       specs: Sequence[TopicSpec] = INTRADAY_TOPICS) -> DataFrame:
    """The continuous readings as transport rows; ``untraced`` leaves a third without a trace id."""
    readings = _events(spark, sf_dir).select(
        F.col("user_id").cast("string").alias("user_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("event_date"),
        F.concat(F.hour("ts").cast("string"), F.lit(".0")).alias("event_hour"),
        "event_id",
        "k",
        "value",
        F.col("ts").cast("timestamp").alias("emitted"),
    )
    k = F.col("k")
    return intraday_events(
        readings,
        bpm=30 + 2 * k + F.col("value") / 10,
        rmssd=k * 3.25,
        breaths=4 + k * 0.375,
        emitted=F.col("emitted"),
        trace_id=F.when(F.lit(not untraced) | (k % 3 != 0), F.lpad(F.col("event_id").cast("string"), 32, "0")),
        ingest_time=F.timestamp_micros(F.unix_micros("emitted") + k * 10000),
        specs=specs,
    )


def transport(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Transport rows of one topic."""
    spec = TOPICS[name]
    if spec.intraday:
        return intraday_transport(spark, sf_dir, specs=[spec])
    if spec is PROFILE:
        rows, source, hourly = profile_rows(spark, sf_dir), HOURLY_SOURCE, True
    elif spec in HOURLY_TOPICS:
        rows, source, hourly = hourly_rows(spark, sf_dir), HOURLY_SOURCE, True
    else:
        rows, source, hourly = daily_rows(spark, sf_dir), DAILY_SOURCE, False
    return export_events(rows, [spec], source=source, hourly=hourly, ingest_time=F.col("delivered"))


def all_transport(spark: SparkSession, sf_dir: str, untraced: bool = False) -> DataFrame:
    """Transport rows of all eleven topics."""
    delivered = F.col("delivered")
    hourly = [s for s in HOURLY_TOPICS if s is not PROFILE]
    daily = [s for s in DAILY_TOPICS if s is not PROFILE]
    return (
        export_events(hourly_rows(spark, sf_dir), hourly, source=HOURLY_SOURCE, hourly=True, ingest_time=delivered)
        .unionByName(export_events(daily_rows(spark, sf_dir), daily, source=DAILY_SOURCE, hourly=False,
                                   ingest_time=delivered))
        .unionByName(intraday_transport(spark, sf_dir, untraced))
        .unionByName(transport(spark, sf_dir, PROFILE.name))
    )


def bronze(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return to_bronze(transport(spark, sf_dir, name))


def silver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return refine(bronze(spark, sf_dir, name), TOPICS[name], audit=False)


def landed(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Bronze rows of transport rows, made once and stored by topic."""
    folder = fresh_folder(spark, "topics")
    to_bronze(events).write.partitionBy("topic").parquet(folder)
    return spark.read.schema(BRONZE_SCHEMA).parquet(folder)


def landed_silver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The Silver rows of all topics, their events made and parsed once and stored by topic."""
    bronze = landed(spark, all_transport(spark, sf_dir))
    return {name: refine(bronze.filter(F.col("topic") == name), spec, audit=False) for name, spec in TOPICS.items()}

"""The registered queries, one per operator or published table."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulselake.config import LakeConfig
from pulselake.functions.stats import mean_squared_error
from pulselake.operators import daily, spine, timeline
from pulselake.operators.anomaly import WindowModel, error_stats, flat_cells, insights, label_errors, severity_rates
from pulselake.operators.baseline import baseline_pool
from pulselake.operators.envelope import decode, promote, to_bronze, type_envelope
from pulselake.operators.ingest import daily_events, first_profile_rows, hourly_events
from pulselake.operators.quality import latency_summary, table_counts
from pulselake.operators.refine import deduplicate, parse_payload, refine, validate
from pulselake.plans.insights import fit_and_label, prepare_windows, score_stored
from pulselake.plans.lake_run import layer_presence, run_lake
from pulselake.plans.silver import refine_topic, run_silver
from pulselake.sources.csv_export import read_export
from pulselake.sources.files import delete
from pulselake.sources.lake import BRONZE, GOLD, SILVER, Lake
from pulselake.sources.topic_log import append_events
from pulselake.sources.workspace import COMPRESSION, freeing_shuffles, fresh_folder, settle
from pulselake.specs import ACTIVITY, DAILY_TOPICS, HOURLY_TOPICS, PROFILE, TOPICS, USER_DAY, VITALS, TopicSpec
from pulselake.streaming.bronze import clear_bronze, compact_bronze, start_bronze
from workload import device

Query = Callable[[SparkSession, str], DataFrame]


def comparable(rows: DataFrame) -> DataFrame:
    """Types every engine prints alike: text dates, whole microseconds, 0/1
    flags, doubles rounded to six places without a negative zero."""

    def plain(field: T.StructField) -> Column:
        value = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            value = value.cast("string")
        elif isinstance(field.dataType, T.TimestampType):
            value = F.unix_micros(value)
        elif isinstance(field.dataType, T.BooleanType):
            value = value.cast("int")
        elif isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            value = F.round(value.cast("double"), 6)
            value = F.when(value == 0, F.lit(0.0)).otherwise(value)
        return value.alias(field.name)

    return rows.select(*[plain(f) for f in rows.schema.fields])


# -- Bronze and Silver -------------------------------------------------------

def json_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export rows to JSON documents and back to promoted fields, all topics of the hourly export."""
    rows = promote(decode(hourly_events(device.hourly_rows(spark, sf_dir), F.col("delivered"),
                                        specs=HOURLY_TOPICS)))
    return comparable(
        rows.select(
            "topic", "user_id", "kafka_ingest_time", "event_date", "event_hour", "event_timestamp",
            "source_timestamp", "trace_id", "event_type",
            F.get_json_object("payload", "$.bpm").cast("double").alias("payload_bpm"),
            F.get_json_object("payload", "$.activityType").alias("payload_activity"),
            F.get_json_object("payload", "$.ALERT").cast("double").alias("payload_alert"),
            F.get_json_object("payload", "$.step_goal_label").alias("payload_goal"),
        )
    )


def typed_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = type_envelope(to_bronze(device.intraday_transport(spark, sf_dir)))
    return comparable(typed.drop("payload"))


def payload_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every activity document parsed and flattened, before any filter."""
    return comparable(parse_payload(device.bronze(spark, sf_dir, "activity"), ACTIVITY))


def range_filter_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Required fields and ranges, before de-duplication."""
    return comparable(validate(parse_payload(device.bronze(spark, sf_dir, "activity"), ACTIVITY), ACTIVITY))


def dedup_user_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every delivery of an hour reduced to its first, without range rules."""
    parsed = parse_payload(device.bronze(spark, sf_dir, "vitals"), VITALS)
    return comparable(deduplicate(parsed, VITALS))


def dedup_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One profile per user out of hourly rows that all carry one."""
    rows = device.hourly_rows(spark, sf_dir)
    sent = device.export_events(rows, [PROFILE], source="fitbit_csv", hourly=True,
                                ingest_time=F.col("delivered"), profile_once=False)
    kept = refine(to_bronze(sent), PROFILE, audit=False)
    return comparable(kept.select("user_id", "kafka_ingest_time", "event_timestamp", *PROFILE.columns))


def silver_query(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(device.silver(spark, sf_dir, name))

    return query


def insert_only_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vitals arrive again with other values after the mornings were stored."""
    lake = Lake(spark, LakeConfig(fresh_folder(spark, "merge")))
    arriving = device.silver(spark, sf_dir, "vitals")
    lake.overwrite(arriving.filter(F.col("event_hour") < 12), SILVER, "vitals")
    changed = arriving.withColumn("temperature", F.lit(-1.0).cast("float"))
    lake.insert_only(changed, SILVER, "vitals", VITALS.keys, changed.select("event_date"))
    return comparable(lake.require(SILVER, "vitals").drop("processed_at"))


def intraday_redelivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reading delivered twice; the trace id keeps one."""
    spec = TOPICS["heart_rate_intraday"]
    once = device.bronze(spark, sf_dir, spec.name)
    again = once.withColumn("kafka_ingest_time", F.timestamp_micros(F.unix_micros("kafka_ingest_time") + 1))
    return comparable(refine(once.unionByName(again), spec, audit=False).drop("event_type"))


def intraday_append_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The append form: two deliveries stay two rows."""
    spec = TOPICS["heart_rate_intraday"]
    lake = Lake(spark, LakeConfig(fresh_folder(spark, "append")))
    rows = refine(device.bronze(spark, sf_dir, spec.name), spec, unique=False, audit=False)
    lake.append(rows, SILVER, spec.name)
    lake.append(rows, SILVER, spec.name)
    stored = lake.require(SILVER, spec.name)
    return comparable(stored.groupBy(*USER_DAY).agg(F.count(F.lit(1)).alias("n"), F.sum("bpm").alias("bpm_sum")))


# -- Gold --------------------------------------------------------------------

def daily_vitals_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(daily.vitals_summary(device.silver(spark, sf_dir, "vitals")))


def _activity_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.activity_summary(device.silver(spark, sf_dir, "activity"), device.silver(spark, sf_dir, "profile"))


def daily_activity_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_activity_summary(spark, sf_dir))


def daily_context_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(daily.context_summary(device.silver(spark, sf_dir, "context")))


def daily_sleep_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(daily.sleep_summary(device.silver(spark, sf_dir, "sleep")))


def daily_vitals_daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(daily.vitals_daily_summary(device.silver(spark, sf_dir, "vitals_daily")))


def _intraday_tables(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [device.silver(spark, sf_dir, f"{p}_intraday") for p in ("heart_rate", "hrv", "breathing")]


def daily_intraday_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(daily.intraday_summary(*_intraday_tables(spark, sf_dir)))


def _gold_tables(silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "daily_vitals_summary": daily.vitals_summary(silver["vitals"]),
        "daily_activity_summary": daily.activity_summary(silver["activity"], silver["profile"]),
        "daily_context_summary": daily.context_summary(silver["context"]),
        "daily_sleep_summary": daily.sleep_summary(silver["sleep"]),
        "daily_intraday_summary": daily.intraday_summary(*[silver[f"{n}_intraday"] for n in ("heart_rate", "hrv", "breathing")]),
        "daily_vitals_daily_summary": daily.vitals_daily_summary(silver["vitals_daily"]),
    }


def daily_wellness_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = device.landed_silver(spark, sf_dir)
    return comparable(spine.wellness_profile(_gold_tables(silver), silver["profile"]))


def mode_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = device.silver(spark, sf_dir, "activity")
    return comparable(daily.mode_per_group(rows, USER_DAY, "activity_type", "dominant_activity_type"))


def value_counts_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(daily.value_counts(device.silver(spark, sf_dir, "activity"), USER_DAY, "activity_type"))


def dominant_mood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_context_summary(spark, sf_dir).select(*USER_DAY, "dominant_mood")


def goal_compliance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users and days by goal result, NULL meaning no numeric goal."""
    return daily_activity_summary(spark, sf_dir).groupBy("user_id", "goal_met_steps").agg(
        F.count(F.lit(1)).alias("days")
    )


def key_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {n: device.silver(spark, sf_dir, n) for n in ("vitals", "sleep", "vitals_daily")}
    return comparable(spine.covered_days(tables))


def spine_left_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chained form of the wide profile: spine, daily metrics of all tables, user attributes."""
    # Settled, since the days come from all tables and their metrics from each again.
    tables = {n: settle(t) for n, t in _gold_tables(device.landed_silver(spark, sf_dir)).items()}
    days = spine.covered_days(tables).select(*USER_DAY)
    parts = [spine.Attributes(tables[n], USER_DAY, tuple(columns)) for n, columns in spine.WELLNESS_METRICS.items()]
    parts.append(spine.Attributes(device.silver(spark, sf_dir, "profile"), ("user_id",), spine.PROFILE_COLUMNS))
    return comparable(spine.enrich(days, [*parts, spine.Attributes(None, USER_DAY, ("never",))]))


# -- Features and windows ----------------------------------------------------

def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.feature_matrix(*[device.silver(spark, sf_dir, n) for n in ("vitals_daily", "sleep", "activity")])


def feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_features(spark, sf_dir))


def feature_outer_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same features by full outer joins."""
    vitals = device.silver(spark, sf_dir, "vitals_daily").select(*USER_DAY, "resting_hr", "stress_score", "spo2")
    sleep = device.silver(spark, sf_dir, "sleep").select(*USER_DAY, "minutes_asleep", "sleep_efficiency")
    activity = timeline.daily_activity_totals(device.silver(spark, sf_dir, "activity"))
    return comparable(spine.outer_join_daily([vitals, sleep, activity]).dropna(subset=list(USER_DAY)))


def daily_activity_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(timeline.daily_activity_totals(device.silver(spark, sf_dir, "activity")))


def forward_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(timeline.forward_fill(_features(spark, sf_dir)))


def cross_user_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(timeline.fill_gaps(_features(spark, sf_dir)))


def mean_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = settle(timeline.forward_fill(_features(spark, sf_dir)))  # read for the means and for the rows
    return comparable(timeline.fit_scaler(filled).impute(filled))


def standardised_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = timeline.fill_gaps(_features(spark, sf_dir))
    return comparable(timeline.fit_scaler(filled).transform(filled))


def sliding_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every window of the standardised features, one row per window row."""
    windows = prepare_windows(_features(spark, sf_dir)).windows
    cells = windows.select(*USER_DAY, F.posexplode("window").alias("position", "cells"))
    return comparable(
        cells.select(*USER_DAY, "position",
                     *[F.col("cells")[i].alias(name) for i, name in enumerate(timeline.FEATURES)])
    )


def window_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean squared error of each raw window against an all-zero reconstruction."""
    windows = timeline.sliding_windows(timeline.fill_gaps(_features(spark, sf_dir)),
                                       ("minutes_asleep", "sleep_efficiency"))
    flat = flat_cells(F.col("window"))
    zeros = F.transform(flat, lambda _: F.lit(0.0))
    return comparable(windows.select(*USER_DAY, mean_squared_error(flat, zeros).alias("error")))


def _value_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = device.table(spark, sf_dir, "events").select("event_id", F.col("value").alias("error"))
    return label_errors(events, error_stats(events, "error"), "error")


def zscore_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severity with the event value taken as the error."""
    return comparable(_value_errors(spark, sf_dir).select("event_id", "z_score", "severity"))


def severity_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(severity_rates(_value_errors(spark, sf_dir)))


def pca_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit, score and label all windows."""
    _, labelled = fit_and_label(_features(spark, sf_dir))
    return comparable(labelled.drop("model_version"))


def rescored_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows scored by the model as stored and loaded again."""
    lake = Lake(spark, LakeConfig(fresh_folder(spark, "model")))
    features = settle(_features(spark, sf_dir))  # read to fit and to score again
    model, _ = fit_and_label(features)
    model.save(lake.config.layer("models"), spark)
    filled = timeline.fill_gaps(features)
    return comparable(score_stored(lake, timeline.sliding_windows(model.scaler.transform(filled))))


def _corner_model(scaler: timeline.FeatureScaler) -> WindowModel:
    """A model with hand-set components: it reproduces the first eight cells of a window and no others."""
    cells = len(timeline.FEATURES) * timeline.WINDOW_ROWS
    return WindowModel(scaler, np.zeros(cells), np.eye(cells)[:, :8])


def _corner_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All windows scored by that model as stored and loaded again."""
    lake = Lake(spark, LakeConfig(fresh_folder(spark, "corner")))
    prepared = prepare_windows(_features(spark, sf_dir))
    _corner_model(prepared.scaler).save(lake.config.layer("models"), spark)
    return score_stored(lake, prepared.windows)


def fixed_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_corner_scores(spark, sf_dir))


def ai_insights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published table for hand-set components: error, z-score and severity."""
    scored = settle(_corner_scores(spark, sf_dir))
    return comparable(insights(label_errors(scored, error_stats(scored)), "fixed"))


def pca_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variance of the cells by the fitted model: what it leaves, over the share it does not explain."""
    prepared = prepare_windows(_features(spark, sf_dir))
    windows = settle(prepared.windows)
    model = WindowModel.fit(windows, prepared.scaler)
    left = F.avg("reconstruction_error") / (1 - model.explained)
    return comparable(model.score(windows).agg(left.alias("cell_variance"), F.count(F.lit(1)).alias("windows")))


# -- Exports, pool, checks ---------------------------------------------------

def csv_hourly_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly export written as CSV, read back and turned into events."""
    folder = fresh_folder(spark, "hourly-csv")
    device.hourly_rows(spark, sf_dir).write.option("header", True).option("escape", '"').csv(folder)
    rows = read_export(spark, folder)
    bronze = to_bronze(hourly_events(rows, F.col("delivered").try_cast("timestamp")))
    # One parse per payload, ahead of the grouping: its sort then carries three cells and no payload.
    cells = F.json_tuple("payload", "bpm", "steps", "step_goal_label").alias("bpm", "steps", "goal_label")
    return comparable(
        bronze.select("topic", *USER_DAY, "event_timestamp", cells).groupBy("topic", *USER_DAY).agg(
            F.count(F.lit(1)).alias("events"),
            F.countDistinct("event_timestamp").alias("moments"),
            F.sum(F.col("bpm").cast("double")).alias("bpm_sum"),
            F.sum(F.col("steps").cast("double")).alias("steps_sum"),
            F.max("goal_label").alias("goal_label"),
        )
    )


def csv_daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "daily-csv")
    device.daily_rows(spark, sf_dir).write.option("header", True).option("escape", '"').csv(folder)
    sent = daily_events(read_export(spark, folder), F.col("delivered").try_cast("timestamp"))
    return comparable(
        to_bronze(sent).groupBy("topic", "user_id", "event_hour").agg(
            F.count(F.lit(1)).alias("events"),
            F.countDistinct("event_timestamp").alias("moments"),
            F.sum(F.get_json_object("payload", "$.spo2").cast("double")).alias("spo2_sum"),
            F.sum(F.get_json_object("payload", "$.rmssd").cast("double")).alias("rmssd_sum"),
        )
    )


def csv_all_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every metric of both exports after CSV, documents and Bronze: known values and their total.

    Both exports send profiles, one for each user; the daily one has none of their cells.
    """
    found = []
    for purpose, rows, events, specs in (
        ("hourly-csv", device.hourly_rows, hourly_events, HOURLY_TOPICS), ("daily-csv", device.daily_rows, daily_events, DAILY_TOPICS)
    ):
        folder = fresh_folder(spark, purpose)
        rows(spark, sf_dir).write.option("header", True).option("escape", '"').csv(folder)
        bronze = device.landed(spark, events(read_export(spark, folder), F.col("delivered").try_cast("timestamp"), specs))
        for spec in specs:
            found.append(_metric_totals(parse_payload(bronze.filter(F.col("topic") == spec.name), spec), spec))
    return comparable(reduce(DataFrame.unionByName, found))


def _metric_totals(parsed: DataFrame, spec: TopicSpec) -> DataFrame:
    def total(name: str, kind: str) -> Column:
        value = F.length(name) if kind == "text" else F.col(name).cast("int") if kind in ("flag", "text_flag") else F.col(name)
        return F.round(F.coalesce(F.sum(value.cast("double")), F.lit(0.0)), 3)

    cells = [F.struct(F.lit(m.silver).alias("metric"), F.count(m.silver).alias("known"), total(m.silver, m.kind).alias("total")) for m in spec.metrics]
    return parsed.agg(F.array(*cells).alias("cells")).select(F.lit(spec.name).alias("topic"), F.inline("cells"))


def first_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = first_profile_rows(device.hourly_rows(spark, sf_dir))
    return comparable(rows.select("id", "date", "hour"))


def baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    pool = baseline_pool(
        device.hourly_rows(spark, sf_dir), device.daily_rows(spark, sf_dir), [F.desc("delivered")]
    )
    return comparable(pool)


def counts_per_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_counts({n: device.silver(spark, sf_dir, n) for n in TOPICS})


def latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = type_envelope(to_bronze(device.intraday_transport(spark, sf_dir)))
    return comparable(latency_summary(events))


# -- Whole lake --------------------------------------------------------------

def _landed(spark: SparkSession, sf_dir: str, purpose: str, events: DataFrame) -> Lake:
    lake = Lake(spark, LakeConfig(fresh_folder(spark, purpose)))
    append_events(events, lake.config)
    start_bronze(spark, lake.config, drain=True).awaitTermination()
    return lake


@contextmanager
def _held(events: DataFrame) -> Iterator[DataFrame]:
    """Transport rows made once and stored until all of their parts are sent."""
    spark = events.sparkSession
    folder = fresh_folder(spark, "held")
    try:
        with freeing_shuffles(spark):
            events.write.option("compression", COMPRESSION).parquet(folder)
        yield spark.read.schema(events.schema).parquet(folder)
    finally:
        delete(spark, folder)


def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All topics streamed into Bronze; rows per topic and date."""
    lake = _landed(spark, sf_dir, "stream", device.all_transport(spark, sf_dir))
    return _per_topic_and_date([lake.read_bronze(name) for name in TOPICS])


def _per_topic_and_date(tables: list[DataFrame | None]) -> DataFrame:
    stacked = reduce(DataFrame.unionByName, [t for t in tables if t is not None])
    return stacked.groupBy("topic", "event_date").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("users")
    )


def bronze_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second checkpoint reads all topics again into the same Bronze: nothing is replaced."""
    lake = _landed(spark, sf_dir, "restart", device.all_transport(spark, sf_dir))
    start_bronze(spark, lake.config, drain=True, name="renewed").awaitTermination()
    stacked = reduce(DataFrame.unionByName, [lake.read_bronze(name) for name in TOPICS])
    return stacked.groupBy("topic", "event_date").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("stream_id").alias("streams")
    )


def silver_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All topics refined again and again, a third of the readings without a trace id: rows per Silver table.

    A batch lands while the first run is half through, the second run takes in
    what is new, the third reads everything.
    """
    late = F.pmod(F.xxhash64("key", "topic", "timestamp"), F.lit(3)) == 0
    specs, half = list(TOPICS.values()), len(TOPICS) // 2
    with _held(device.all_transport(spark, sf_dir, untraced=True)) as events:  # sent in two parts
        lake = _landed(spark, sf_dir, "rerun", events.filter(~late))
        for spec in specs[:half]:
            refine_topic(lake, spec, new_only=True)
        append_events(events.filter(late), lake.config)
    start_bronze(spark, lake.config, drain=True).awaitTermination()
    for spec in specs[half:]:
        refine_topic(lake, spec, new_only=True)
    run_silver(lake, new_only=True)
    run_silver(lake)
    return table_counts({n: lake.require(SILVER, n) for n in TOPICS})


def bronze_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All topics landed in several batches, of which two rewrites leave few files; rows per topic and date."""
    part = F.pmod(F.xxhash64("key", "topic", "timestamp"), F.lit(3))
    dates = device.table(spark, sf_dir, "events").agg(F.min("ts").cast("date").alias("low"), F.max("ts").cast("date").alias("high")).first()
    lake = Lake(spark, LakeConfig(fresh_folder(spark, "compacted")))

    def take_in(n: int) -> None:
        start_bronze(spark, lake.config, drain=True).awaitTermination()
        if n:
            # The last dates are still open; the second rewrite holds what came later for dates of the first.
            compact_bronze(lake, dates["low"] + (dates["high"] - dates["low"]) * n / 2)
            clear_bronze(lake)

    with _held(device.all_transport(spark, sf_dir)) as events:  # sent in three parts
        for n in range(3):
            append_events(events.filter(part == n), lake.config)
            if n < 2:
                take_in(n)
    take_in(2)
    return _per_topic_and_date([lake.read_bronze(name) for name in TOPICS])


def stored_insights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ai_insights`` as read back after a first and a second run replaced each other."""
    lake = Lake(spark, LakeConfig(fresh_folder(spark, "insights")))
    scored = settle(_corner_scores(spark, sf_dir))
    labelled = label_errors(scored, error_stats(scored))
    for run in ("first", "fixed"):
        lake.overwrite(insights(labelled.filter(F.lit(run == "fixed") | (F.col("severity") != "normal")), run), GOLD, "ai_insights")
    return comparable(lake.require(GOLD, "ai_insights"))


def lake_wellness_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic log -> Bronze stream -> Silver -> Gold, read back from storage."""
    lake = _landed(spark, sf_dir, "lake", device.all_transport(spark, sf_dir))
    run_lake(lake)
    return comparable(lake.require(GOLD, "daily_wellness_profile").drop("gold_updated_at"))


def lake_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which Bronze tables exist, and their sizes, after streaming the intraday topics."""
    lake = _landed(spark, sf_dir, "presence", device.intraday_transport(spark, sf_dir))
    return comparable(layer_presence(lake, BRONZE))


QUERIES: dict[str, Query] = {
    "json_envelope": json_envelope,
    "typed_envelope": typed_envelope,
    "payload_parse": payload_parse,
    "range_filter_activity": range_filter_activity,
    "dedup_user_hour": dedup_user_hour,
    "dedup_profile": dedup_profile,
    **{f"silver_{name}": silver_query(name) for name in TOPICS},
    "insert_only_merge": insert_only_merge,
    "intraday_redelivery": intraday_redelivery,
    "intraday_append_only": intraday_append_only,
    "daily_vitals_summary": daily_vitals_summary,
    "daily_activity_summary": daily_activity_summary,
    "daily_context_summary": daily_context_summary,
    "daily_sleep_summary": daily_sleep_summary,
    "daily_vitals_daily_summary": daily_vitals_daily_summary,
    "daily_intraday_summary": daily_intraday_summary,
    "daily_wellness_profile": daily_wellness_profile,
    "mode_activity": mode_activity,
    "value_counts_activity": value_counts_activity,
    "dominant_mood": dominant_mood,
    "goal_compliance": goal_compliance,
    "key_spine": key_spine,
    "spine_left_joins": spine_left_joins,
    "feature_matrix": feature_matrix,
    "feature_outer_join": feature_outer_join,
    "daily_activity_totals": daily_activity_totals,
    "forward_fill": forward_fill,
    "cross_user_backfill": cross_user_backfill,
    "mean_impute": mean_impute,
    "standardised_features": standardised_features,
    "sliding_windows": sliding_windows,
    "window_error": window_error,
    "zscore_severity": zscore_severity,
    "severity_rates": severity_share,
    "pca_scores": pca_scores,
    "rescored_windows": rescored_windows,
    "fixed_model_scores": fixed_model_scores,
    "ai_insights": ai_insights,
    "pca_variance": pca_variance,
    "csv_hourly_events": csv_hourly_events,
    "csv_daily_events": csv_daily_events,
    "csv_all_metrics": csv_all_metrics,
    "first_profile": first_profile,
    "baseline_pool": baseline,
    "table_counts": counts_per_table,
    "latency_summary": latency,
    "stream_bronze": stream_bronze,
    "bronze_restart": bronze_restart,
    "silver_rerun": silver_rerun,
    "bronze_compacted": bronze_compacted,
    "stored_insights": stored_insights,
    "lake_wellness_profile": lake_wellness_profile,
    "lake_presence": lake_presence,
}

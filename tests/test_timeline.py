import datetime as dt
import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.util import PythonEvalType

from pulselake.operators import timeline
from pulselake.operators.anomaly import (
    TooFewWindows, WindowModel, error_stats, insights, label_errors, require_windows, severity_rates,
)
from pulselake.operators.spine import outer_join_daily
from pulselake.plans.insights import fit_and_label, prepare_windows
from pulselake.sources.workspace import settle
from tests.rows import day, one

COLUMNS = ("a", "b", "c")
SCHEMA = "user_id string, event_date date, a double, b double, c double"


def random_rows(seed, users=9, days=12):
    rng = random.Random(seed)
    rows = []
    for u in range(users):
        silent = {c for c in COLUMNS if rng.random() < 0.4}
        for d in sorted(rng.sample(range(40), rng.randint(1, days))):
            cells = [None if c in silent or rng.random() < 0.4 else float(rng.randint(0, 50)) for c in COLUMNS]
            rows.append((f"u{u}", dt.date(2021, 1, 1) + dt.timedelta(days=d), *cells))
    rng.shuffle(rows)
    return rows


def by_pandas(rows):
    frame = pd.DataFrame(rows, columns=["user_id", "event_date", *COLUMNS])
    frame[list(COLUMNS)] = frame[list(COLUMNS)].astype("float64")
    frame = frame.sort_values(["user_id", "event_date"]).reset_index(drop=True)
    frame[list(COLUMNS)] = frame.groupby("user_id")[list(COLUMNS)].ffill().bfill()
    return frame


def plain(rows):
    clean = [(r[0], r[1], *[None if v is None or v != v else round(v, 9) + 0.0 for v in r[2:]]) for r in rows]
    return sorted(clean, key=str)


@pytest.mark.parametrize("seed", range(4))
def test_fill_gaps_equals_whole_frame_fill(spark, seed):
    rows = random_rows(seed)
    filled = timeline.fill_gaps(spark.createDataFrame(rows, SCHEMA), COLUMNS)
    expected = by_pandas(rows)
    assert plain(filled.collect()) == plain(expected.itertuples(index=False, name=None))

    means = expected[list(COLUMNS)].mean()
    imputed = expected.fillna(means.to_dict())
    scale = imputed[list(COLUMNS)].std(ddof=0).replace(0, 1)
    scaled = imputed.copy()
    scaled[list(COLUMNS)] = (imputed[list(COLUMNS)] - imputed[list(COLUMNS)].mean()) / scale
    scaler = timeline.fit_scaler(filled, COLUMNS)
    assert plain(scaler.impute(filled).collect()) == plain(imputed.itertuples(index=False, name=None))
    ours = plain(scaler.transform(filled).collect())
    theirs = plain(scaled.itertuples(index=False, name=None))
    assert [r[:2] for r in ours] == [r[:2] for r in theirs]
    numbers = lambda rs: np.array([[np.nan if v is None else v for v in r[2:]] for r in rs], dtype=float)
    np.testing.assert_allclose(numbers(ours), numbers(theirs), atol=1e-8)


def users_with(spark, values):
    rows = [(u, day("2021-01-01"), v, 1.0, 1.0) for u, v in values]
    return spark.createDataFrame(rows, SCHEMA)


def test_carry_crosses_many_slices(spark):
    values = [(f"u{i:04d}", 5.0 if i == 399 else None) for i in range(400)]
    rows = timeline.fill_gaps(users_with(spark, values), ("a",)).collect()
    assert {r["a"] for r in rows} == {5.0}


def test_last_user_without_values_takes_the_mean(spark):
    filled = timeline.fill_gaps(users_with(spark, [("u1", None), ("u2", 5.0), ("u3", 7.0), ("u4", None)]), COLUMNS)
    assert {r["user_id"]: r["a"] for r in filled.collect()} == {"u1": 5.0, "u2": 5.0, "u3": 7.0, "u4": None}
    scaler = timeline.fit_scaler(filled, COLUMNS)
    assert {r["user_id"]: r["a"] for r in scaler.impute(filled).collect()}["u4"] == pytest.approx(17 / 3)


def test_empty_column_stays_null_and_constant_scales_by_one(spark):
    filled = users_with(spark, [("u1", None), ("u2", None)])
    scaler = timeline.fit_scaler(filled, COLUMNS)
    assert scaler.means == (None, 1.0, 1.0) and scaler.scales == (None, 1.0, 1.0)
    assert {(r["a"], r["b"]) for r in scaler.transform(filled).collect()} == {(None, 0.0)}


def test_windows_count_rows_not_days(spark):
    rows = []
    for user, count in (("six", 6), ("seven", 7), ("nine", 9)):
        for i in range(count):
            rows.append((user, dt.date(2021, 1, 1) + dt.timedelta(days=3 * i), float(i), None, 0.0))
    windows = timeline.sliding_windows(spark.createDataFrame(rows, SCHEMA), COLUMNS)
    counts = {r["user_id"]: r["count"] for r in windows.groupBy("user_id").count().collect()}
    assert counts == {"seven": 1, "nine": 3}
    first = one(windows.filter("user_id = 'seven'"))
    assert first["event_date"] == dt.date(2021, 1, 19)
    assert first["window"] == [[float(i), None, 0.0] for i in range(7)]


def test_feature_matrix_equals_outer_joins(spark):
    key = "user_id string, event_date date"
    d1, d2 = day("2021-01-01"), day("2021-01-02")
    vitals = spark.createDataFrame([("u1", d1, 60.0, 50.0, 97.0), ("u2", d1, None, 1.0, None), (None, d1, 1.0, 1.0, 1.0)],
                                   f"{key}, resting_hr float, stress_score float, spo2 float")
    sleep = spark.createDataFrame([("u1", d2, 400.0, 90.0), ("u1", d1, None, 80.0)],
                                  f"{key}, minutes_asleep float, sleep_efficiency float")
    activity = spark.createDataFrame([("u1", d1, 5, 1.5), ("u1", d1, 6, None), ("u3", None, 1, 1.0), ("u3", d1, None, None)],
                                     f"{key}, steps int, calories float")
    joined = outer_join_daily([vitals, sleep, timeline.daily_activity_totals(activity)]).dropna(
        subset=["user_id", "event_date"])
    stacked = timeline.feature_matrix(vitals, sleep, activity)
    assert sorted(map(str, stacked.collect())) == sorted(map(str, joined.select(*stacked.columns).collect()))
    assert dict(stacked.dtypes)["steps"] == "bigint" and dict(stacked.dtypes)["calories"] == "double"


def features(spark, users=12, days=20, seed=1):
    rng = random.Random(seed)
    rows = []
    for u in range(users):
        for d in range(days):
            base = rng.gauss(0, 1)
            cells = [base * (i + 1) + rng.gauss(0, 0.1) for i in range(5)]
            rows.append((f"u{u}", dt.date(2021, 1, 1) + dt.timedelta(days=d), *cells, int(1000 + 100 * base), 2.0 * base))
    kinds = ", ".join(f"{c} {'bigint' if c == 'steps' else 'double'}" for c in timeline.FEATURES)
    return spark.createDataFrame(rows, f"user_id string, event_date date, {kinds}")


def test_model_scores_match_numpy_and_survive_storage(spark, folder):
    prepared = prepare_windows(features(spark))
    windows = settle(prepared.windows)
    model = WindowModel.fit(windows, prepared.scaler, rank=5)
    scored = {(r["user_id"], r["event_date"]): r["reconstruction_error"] for r in model.score(windows).collect()}

    rows = windows.collect()
    x = np.array([np.array(r["window"], dtype="float64").ravel() for r in rows])
    centred = x - x.mean(axis=0)
    _, _, vt = np.linalg.svd(centred, full_matrices=False)
    rebuilt = centred @ vt[:5].T @ vt[:5]
    expected = ((centred - rebuilt) ** 2).mean(axis=1)
    np.testing.assert_allclose([scored[r["user_id"], r["event_date"]] for r in rows], expected, rtol=1e-6, atol=1e-9)

    assert model.save(f"{folder}/models", spark) == "1"
    assert model.save(f"{folder}/models", spark) == "2"
    loaded = WindowModel.load(f"{folder}/models", spark)
    assert loaded.version == "2" and loaded.scaler == model.scaler
    again = {(r["user_id"], r["event_date"]): r["reconstruction_error"] for r in loaded.score(windows).collect()}
    assert again == pytest.approx(scored)
    assert WindowModel.load(f"{folder}/models", spark, "1").version == "1"
    with pytest.raises(FileNotFoundError):
        WindowModel.load(f"{folder}/nothing", spark)


def test_windows_are_scored_as_arrow_buffers(spark):
    """No object per window; a window with a missing cell has no error."""
    windows = spark.createDataFrame(
        [("u1", day("2021-01-07"), [[float(i), 1.0] for i in range(7)]), ("u2", day("2021-01-07"), [[float(i), None] for i in range(7)])],
        "user_id string, event_date date, window array<array<float>>")
    model = WindowModel(timeline.FeatureScaler(("a", "b"), (0.0, 0.0), (1.0, 1.0)), np.zeros(14), np.eye(14)[:, :2])
    scored = model.score(windows)
    assert {r["user_id"]: r["reconstruction_error"] for r in scored.collect()} == {"u1": pytest.approx((91 + 6) / 14), "u2": None}
    assert model.score(windows.limit(0)).collect() == []
    kind = PythonEvalType.SQL_SCALAR_ARROW_UDF
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert re.search(rf"ArrowEvalPython \[distance.*\], {kind}\b", plan), plan


def test_wrong_window_shape_fails(spark):
    prepared = prepare_windows(features(spark))
    model = WindowModel.fit(prepared.windows, prepared.scaler, rank=2)
    short = prepared.windows.withColumn("window", F.slice("window", 1, 3))
    with pytest.raises(Exception, match="window is not 7 x 7"):
        model.score(short).collect()


def test_labels_are_global(spark):
    _, labelled = fit_and_label(features(spark), rank=3)
    rows = labelled.collect()
    errors = np.array([r["reconstruction_error"] for r in rows])
    z = (errors - errors.mean()) / (errors.std() + 1e-8)
    np.testing.assert_allclose([r["z_score"] for r in rows], z, atol=1e-9)
    rates = one(severity_rates(labelled))
    assert rates["anomaly_rate_red"] == pytest.approx((z >= 1.65).mean())
    published = insights(labelled, "run")
    assert dict(published.dtypes) == {
        "user_id": "string", "event_date": "date", "reconstruction_error": "float", "z_score": "float",
        "severity": "string", "mlflow_run_id": "string"}


def test_insights_reject_nulls(spark):
    rows = spark.createDataFrame([("u1", day("2021-01-01"), None)], "user_id string, event_date date, reconstruction_error double")
    with pytest.raises(Exception, match="reconstruction_error must not be null"):
        insights(label_errors(rows, error_stats(spark.range(1).selectExpr("1D AS reconstruction_error"))), "run").collect()


def test_too_few_windows(spark):
    few = timeline.sliding_windows(features(spark, users=2, days=10))
    with pytest.raises(TooFewWindows):
        require_windows(few)
    require_windows(few, 8)


def test_feature_without_values_cannot_be_fitted(spark):
    rows = features(spark).withColumn("spo2", F.lit(None).cast("double"))
    with pytest.raises(ValueError, match="spo2"):
        fit_and_label(rows)

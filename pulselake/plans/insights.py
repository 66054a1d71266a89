"""Silver -> scored windows -> ``ai_insights``."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame

from pulselake.operators.anomaly import (
    WindowModel,
    error_stats,
    insights,
    label_errors,
    require_windows,
    severity_rates,
)
from pulselake.operators.timeline import feature_matrix, fill_gaps, fit_scaler, sliding_windows
from pulselake.sources.lake import GOLD, SILVER, Lake
from pulselake.sources.workspace import settle


@dataclass(frozen=True)
class Prepared:
    windows: DataFrame
    scaler: object


def prepare_windows(features: DataFrame) -> Prepared:
    """Fill, standardise and window a feature matrix."""
    filled = fill_gaps(features)
    scaler = fit_scaler(filled)
    return Prepared(sliding_windows(scaler.transform(filled)), scaler)


def fit_and_label(features: DataFrame, rank: int = 8) -> tuple[WindowModel, DataFrame]:
    """Fit on all windows and label each by its reconstruction error.

    Windows feed the guard, the fit and the scoring, and errors feed the
    statistics and the labels, so both are settled once.
    """
    prepared = prepare_windows(features)
    windows = settle(prepared.windows)
    require_windows(windows)
    model = WindowModel.fit(windows, prepared.scaler, rank)
    scored = settle(model.score(windows))
    return model, label_errors(scored, error_stats(scored))


class NoInsightInput(RuntimeError):
    """A Silver table that the features need does not exist."""


def stored_features(lake: Lake) -> DataFrame:
    tables = {name: lake.read(SILVER, name) for name in ("vitals_daily", "sleep", "activity")}
    if absent := [name for name, table in tables.items() if table is None]:
        raise NoInsightInput(f"no Silver table {', '.join(absent)}")
    return feature_matrix(*tables.values())


def run_insights(lake: Lake, *, rank: int = 8, run_id: str | None = None) -> dict[str, float | str]:
    """Fit, store the model, publish ``ai_insights``; the run's key figures."""
    run_id = run_id or uuid.uuid4().hex
    model, labelled = fit_and_label(stored_features(lake), rank)
    version = model.save(lake.config.layer("models"), lake.spark)
    lake.overwrite(insights(labelled, run_id), GOLD, "ai_insights")
    rates = severity_rates(labelled).first().asDict()
    return {"run_id": run_id, "model_version": version, **rates}


def score_lake(lake: Lake, version: str | None = None) -> DataFrame:
    """Score the windows of the lake's present features with a stored model and its own scaler."""
    model = WindowModel.load(lake.config.layer("models"), lake.spark, version)
    return model.score(sliding_windows(model.scaler.transform(fill_gaps(stored_features(lake)))))


def score_stored(lake: Lake, windows: DataFrame, version: str | None = None) -> DataFrame:
    """Score standardised windows with a stored model, the latest by default."""
    return WindowModel.load(lake.config.layer("models"), lake.spark, version).score(windows)

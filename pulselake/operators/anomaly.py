"""Window scoring by distributed linear reconstruction."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulselake.functions.stats import severity, z_score
from pulselake.operators.moments import Moments, moments
from pulselake.operators.timeline import FEATURES, WINDOW_ROWS, FeatureScaler

# Fixed value: fewest windows worth fitting on.
FEWEST_WINDOWS = 50


class TooFewWindows(RuntimeError):
    """The data does not cover enough user-weeks to fit a model."""


def require_windows(windows: DataFrame, fewest: int = FEWEST_WINDOWS) -> None:
    """Raise unless there are at least ``fewest`` windows; reads no more than that."""
    found = windows.limit(fewest).count()
    if found < fewest:
        raise TooFewWindows(f"only {found} windows, {fewest} needed")


def flat_cells(window: Column) -> Column:
    """The window as one flat array, row by row."""
    return F.flatten(window)


@dataclass(frozen=True)
class WindowModel:
    """Principal components of flattened windows, and the scaler used for them."""

    scaler: FeatureScaler
    center: np.ndarray
    components: np.ndarray
    version: str = "unsaved"
    length: int = WINDOW_ROWS
    explained: float | None = None

    @classmethod
    def fit(cls, windows: DataFrame, scaler: FeatureScaler, rank: int = 8,
            length: int = WINDOW_ROWS) -> "WindowModel":
        """Fit on all windows in one pass; only cells x cells matrices reach the driver."""
        found = moments(windows.select(flat_cells(F.col("window")).alias("cells")), "cells")
        if found is None:
            raise TooFewWindows("no windows to fit on")
        return cls.from_moments(found, scaler, rank, length)

    @classmethod
    def from_moments(cls, found: Moments, scaler: FeatureScaler, rank: int = 8, length: int = WINDOW_ROWS) -> "WindowModel":
        """The principal components of windows by their moments, which may come from several parts."""
        missing = [c for c, mean in zip(scaler.columns, scaler.means) if mean is None]
        if missing:
            raise ValueError(f"features without any value: {', '.join(missing)}")
        values, axes = np.linalg.eigh(found.covariance)
        order = np.argsort(-values, kind="stable")[:rank]
        total = values.sum()
        explained = float(values[order].sum() / total) if total > 0 else 1.0
        return cls(scaler, found.mean, axes[:, order], length=length, explained=explained)

    def error(self, flat: Column) -> Column:
        """Mean squared distance of a flat window from its projection on the components.

        The principal component model does not centre its input, so the mean
        is handled here. Whole Arrow batches go through one matrix product, and
        one number per window comes back. The cells of a batch lie in one buffer,
        which becomes the matrix without an object per window.
        """
        center, components = self.center, self.components

        @F.arrow_udf("double")
        def distance(cells: pa.Array) -> pa.Array:
            if not len(cells):
                return pa.array([], pa.float64())
            matrix = cells.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(len(cells), -1) - center
            # A window with a missing cell has no error.
            return pa.array(((matrix - matrix @ components @ components.T) ** 2).mean(axis=1), from_pandas=True)

        return distance(flat)

    def score(self, windows: DataFrame) -> DataFrame:
        """Reconstruction error of every window, on its cells as float32."""
        shaped = windows.withColumn("_flat", self._checked(F.col("window")))
        return shaped.select(
            "user_id",
            "event_date",
            self.error(F.col("_flat")).alias("reconstruction_error"),
            F.lit(self.version).alias("model_version"),
        )

    def _checked(self, window: Column) -> Column:
        width = len(self.scaler.columns)
        fits = (F.size(window) == self.length) & F.forall(window, lambda row: F.size(row) == width)
        wrong = F.raise_error(F.lit(f"window is not {self.length} x {width}")).cast("array<float>")
        return F.when(fits, flat_cells(window)).otherwise(wrong)

    def save(self, root: str, spark: SparkSession) -> str:
        """Store as the next version under ``root`` and return the version."""
        stored = stored_versions(root, spark)
        version = str(max(stored, default=0) + 1)
        numbers = [
            (list(self.scaler.columns), list(self.scaler.means), list(self.scaler.scales),
             self.center.tolist(), self.components.tolist(), self.length)
        ]
        schema = ("columns array<string>, means array<double>, scales array<double>, center array<double>, "
                  "components array<array<double>>, length int")
        spark.createDataFrame(numbers, schema).coalesce(1).write.parquet(f"{root}/numbers/version={version}")
        return version

    @classmethod
    def load(cls, root: str, spark: SparkSession, version: str | None = None) -> "WindowModel":
        """A stored model; the latest unless a version is named."""
        stored = stored_versions(root, spark)
        if not stored:
            raise FileNotFoundError(f"no model stored under {root}")
        version = version or str(max(stored))
        numbers = spark.read.parquet(f"{root}/numbers/version={version}").first()
        scaler = FeatureScaler(tuple(numbers["columns"]), tuple(numbers["means"]), tuple(numbers["scales"]))
        return cls(scaler, np.array(numbers["center"]), np.array(numbers["components"]), version, numbers["length"])


def stored_versions(root: str, spark: SparkSession) -> list[int]:
    from pulselake.sources.lake import read_if_exists

    numbers = read_if_exists(spark, "parquet", f"{root}/numbers")
    if numbers is None:
        return []
    return [int(r["version"]) for r in numbers.select("version").distinct().collect()]


@dataclass(frozen=True)
class ErrorStats:
    """Mean and population deviation of all errors."""

    mean: float
    deviation: float


def error_stats(scored: DataFrame, error: str = "reconstruction_error") -> ErrorStats:
    row = scored.agg(F.avg(error).alias("mean"), F.stddev_pop(error).alias("deviation")).first()
    if row["mean"] is None:
        raise ValueError("no errors to summarise")
    return ErrorStats(row["mean"], row["deviation"])


def label_errors(scored: DataFrame, stats: ErrorStats, error: str = "reconstruction_error") -> DataFrame:
    """Add the z-score over all windows and its severity."""
    z = z_score(F.col(error), stats.mean, stats.deviation)
    return scored.withColumn("z_score", z).withColumn("severity", severity(F.col("z_score")))


def severity_rates(labelled: DataFrame) -> DataFrame:
    """Share of rows in each alarming class, as one row."""

    def share(name: str) -> Column:
        hit = F.when(F.col("severity") == name, 1.0).otherwise(0.0)
        return F.avg(hit).alias(f"anomaly_rate_{name}")

    return labelled.agg(share("red"), share("yellow"), share("green"))


def insights(labelled: DataFrame, run_id: str) -> DataFrame:
    """The published columns, failing on any NULL."""

    def required(value: Column, name: str, kind: str) -> Column:
        missing = F.raise_error(F.lit(f"{name} must not be null")).cast(kind)
        return F.coalesce(value.cast(kind), missing).alias(name)

    return labelled.select(
        required(F.col("user_id"), "user_id", "string"),
        required(F.col("event_date"), "event_date", "date"),
        required(F.col("reconstruction_error"), "reconstruction_error", "float"),
        required(F.col("z_score"), "z_score", "float"),
        required(F.col("severity"), "severity", "string"),
        F.lit(run_id).alias("mlflow_run_id"),
    )

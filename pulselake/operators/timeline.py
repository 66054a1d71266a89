"""Per-user daily features: assembly, gap filling, scaling, windows.

Every table here holds one row per user and day, which ``feature_matrix``
guarantees by grouping. One user's timeline is therefore at most as long as
the calendar, whatever share of the raw events the user produced, and windows
partitioned by user stay bounded.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from pulselake.functions.stats import standard_score
from pulselake.sources.workspace import settle
from pulselake.specs import USER_DAY

# Model features in tensor order, and the window length in rows.
FEATURES = (
    "resting_hr",
    "stress_score",
    "spo2",
    "minutes_asleep",
    "sleep_efficiency",
    "steps",
    "calories",
)
WINDOW_ROWS = 7


def _by_day() -> WindowSpec:
    return Window.partitionBy("user_id").orderBy("event_date")


def daily_activity_totals(activity: DataFrame) -> DataFrame:
    return activity.groupBy(*USER_DAY).agg(F.sum("steps").alias("steps"), F.sum("calories").alias("calories"))


def feature_matrix(vitals_daily: DataFrame, sleep: DataFrame, activity: DataFrame) -> DataFrame:
    """Seven features per user-day that any of the three tables knows.

    Equal to full outer joins of the daily rows with the daily activity
    totals, in one shuffle of partially aggregated rows. Silver holds one
    vitals and one sleep row per user-day, so ``max`` returns that row's value.
    """
    stacked = (
        vitals_daily.select(*USER_DAY, "resting_hr", "stress_score", "spo2")
        .unionByName(sleep.select(*USER_DAY, "minutes_asleep", "sleep_efficiency"), allowMissingColumns=True)
        .unionByName(activity.select(*USER_DAY, "steps", "calories"), allowMissingColumns=True)
        .dropna(subset=list(USER_DAY))
    )
    folds = {"steps": F.sum, "calories": F.sum}
    return stacked.groupBy(*USER_DAY).agg(*[folds.get(c, F.max)(c).alias(c) for c in FEATURES])


def forward_fill(features: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Repeat each user's last known value into later gaps."""
    past = _by_day().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return features.select(*USER_DAY, *[F.last(c, ignorenulls=True).over(past).alias(c) for c in columns])


def fill_within_user(features: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Forward fill, then the user's first known value into leading gaps.

    Both frames share partitioning and order, hence one shuffle and one sort.
    Only features a user never reports stay NULL.
    """
    past = _by_day().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = _by_day().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return features.select(
        *USER_DAY,
        *[
            F.coalesce(
                F.last(c, ignorenulls=True).over(past), F.first(c, ignorenulls=True).over(whole)
            ).alias(c)
            for c in columns
        ],
    )


def next_user_values(filled: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """For users lacking a feature: the first value of the next user that has it.

    Users are compared in id order. A single ordered window would pull all
    users into one task, so users are range-partitioned into slices, each slice
    looks ahead on its own, and the slices (as many as there are shuffle
    partitions) pass on their first values.
    """
    users = filled.groupBy("user_id").agg(*[F.min_by(c, "event_date").alias(c) for c in columns])
    # Slice numbers must not change between the reads below: settle them.
    users = settle(users.repartitionByRange("user_id").withColumn("_slice", F.spark_partition_id()))

    ahead = Window.partitionBy("_slice").orderBy(F.desc("user_id")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    within = users.select(
        "user_id",
        "_slice",
        F.greatest(*[F.col(c).isNull().cast("int") for c in columns], F.lit(0)).alias("_lacks"),
        *[F.last(c, ignorenulls=True).over(ahead).alias(c) for c in columns],
    ).filter(F.col("_lacks") == 1)

    slices = users.groupBy("_slice").agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("user_id"))).alias(c) for c in columns]
    )
    later = Window.orderBy(F.desc("_slice")).rowsBetween(Window.unboundedPreceding, -1)
    onward = slices.select("_slice", *[F.last(c, ignorenulls=True).over(later).alias(f"_{c}") for c in columns])

    # One row per slice, so the broadcast is bounded by the partition count.
    return within.join(F.broadcast(onward), on="_slice", how="left").select(
        "user_id", *[F.coalesce(F.col(c), F.col(f"_{c}")).alias(c) for c in columns]
    )


def fill_gaps(features: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Fill within users, then from the next user in id order.

    A feature that no later user knows stays NULL and is left to the mean.
    """
    filled = settle(fill_within_user(features, columns))
    ahead = next_user_values(filled, columns)
    renamed = ahead.select("user_id", *[F.col(c).alias(f"_{c}") for c in columns])
    return filled.join(renamed, on="user_id", how="left").select(
        *USER_DAY, *[F.coalesce(F.col(c), F.col(f"_{c}")).alias(c) for c in columns]
    )


@dataclass(frozen=True)
class FeatureScaler:
    """Column means and scales; NULL cells take the mean before scaling."""

    columns: tuple[str, ...]
    means: tuple[float | None, ...]
    scales: tuple[float | None, ...]

    def impute(self, rows: DataFrame) -> DataFrame:
        return rows.select(
            *USER_DAY,
            *[
                F.coalesce(F.col(c).cast("double"), F.lit(mean)).alias(c)
                for c, mean in zip(self.columns, self.means)
            ],
        )

    def transform(self, rows: DataFrame) -> DataFrame:
        """Impute and standardise. A column without any value stays NULL."""
        cells = []
        for c, mean, scale in zip(self.columns, self.means, self.scales):
            if mean is None:
                cells.append(F.lit(None).cast("double").alias(c))
            else:
                cells.append(standard_score(F.coalesce(F.col(c).cast("double"), F.lit(mean)), mean, scale).alias(c))
        return rows.select(*USER_DAY, *cells)


def fit_scaler(rows: DataFrame, columns: Sequence[str] = FEATURES) -> FeatureScaler:
    """Means and population deviations of the mean-imputed columns.

    One aggregate row reaches the driver. Imputed cells sit on the mean, so
    they widen the count but not the sum of squares. A zero deviation scales
    by 1.
    """
    measures = [F.count(F.lit(1)).alias("rows")]
    for c in columns:
        value = F.col(c).cast("double")
        measures += [
            F.avg(value).alias(f"mean_{c}"),
            F.var_pop(value).alias(f"var_{c}"),
            F.count(value).alias(f"known_{c}"),
        ]
    row = rows.agg(*measures).first()
    means, scales = [], []
    for c in columns:
        mean, variance = row[f"mean_{c}"], row[f"var_{c}"]
        means.append(mean)
        if mean is None:
            scales.append(None)
        else:
            scale = math.sqrt(variance * row[f"known_{c}"] / row["rows"])
            scales.append(scale if scale > 0 else 1.0)
    return FeatureScaler(tuple(columns), tuple(means), tuple(scales))


def sliding_windows(rows: DataFrame, columns: Sequence[str] = FEATURES, length: int = WINDOW_ROWS) -> DataFrame:
    """Every run of ``length`` consecutive rows of a user, stride one.

    Rows, not calendar days: a gap in the dates does not break a window. A
    window carries the date of its last row.
    """
    frame = _by_day().rowsBetween(1 - length, Window.currentRow)
    cells = F.array(*[F.col(c).cast("float") for c in columns])
    return rows.select(*USER_DAY, F.collect_list(cells).over(frame).alias("window")).filter(
        F.size("window") == length
    )

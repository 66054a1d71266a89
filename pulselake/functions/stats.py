"""Standardising, scoring and labelling expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower z-score limits of the severity classes.
SEVERITY_LIMITS = (("red", 1.65), ("yellow", 1.29), ("green", 1.04))
NORMAL = "normal"

# Fixed value: keeps the z-score finite when all errors are equal.
Z_EPSILON = 1e-8


def standard_score(value: Column, mean: float, scale: float) -> Column:
    return (value - F.lit(mean)) / F.lit(scale)


def z_score(error: Column, mean: float, deviation: float) -> Column:
    return (error - F.lit(mean)) / F.lit(deviation + Z_EPSILON)


def severity(z: Column) -> Column:
    """Severity class of a z-score; NaN and NULL are normal."""
    known = F.when(~F.isnan(z), z)
    picks = [F.when(known >= F.lit(limit), F.lit(name)) for name, limit in SEVERITY_LIMITS]
    return F.coalesce(*picks, F.lit(NORMAL))


def mean_squared_error(actual: Column, rebuilt: Column) -> Column:
    """Mean of squared differences of two flat arrays of equal length."""
    squares = F.zip_with(actual, rebuilt, lambda a, b: (a.cast("double") - b) * (a.cast("double") - b))
    return F.aggregate(squares, F.lit(0.0), lambda total, s: total + s) / F.size(actual)

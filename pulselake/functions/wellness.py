"""Domain expressions: ranges, dominant labels, goals."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def accepts(value: Column, low: float | None, high: float | None) -> Column:
    """NULL-tolerant inclusive range test; a missing bound is open."""
    tests = []
    if low is not None:
        tests.append(value >= F.lit(low))
    if high is not None:
        tests.append(value <= F.lit(high))
    inside = reduce(lambda a, b: a & b, tests, F.lit(True))
    return value.isNull() | inside


def dominant_label(counters: Sequence[tuple[str, Column]]) -> Column:
    """Label of the largest counter; the earliest wins ties.

    NULL counters count as zero, and when the largest is zero there is no
    dominant label.
    """
    top = F.greatest(*[F.coalesce(counter, F.lit(0)) for _, counter in counters])
    winner = F.coalesce(*[F.when(counter == top, F.lit(label)) for label, counter in counters])
    return F.when(top != 0, winner)


def null_as_zero_sum(values: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(v, F.lit(0)) for v in values])


def goal_reached(total: Column, goal: Column) -> Column:
    """Three-valued: NULL without a goal or without a total."""
    return F.when(goal.isNotNull(), total >= goal)

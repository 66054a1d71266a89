"""Count, mean and co-moments of cell vectors, which can be put together from parts.

Parts are those of partitions, of dates or of earlier runs. Two parts make a
whole by the difference of their means, so nothing is squared that could be
cancelled, and the order in which parts are put together does not matter beyond
rounding.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PARTS = 64
_SCHEMA = pa.schema([("part", pa.int32()), ("n", pa.int64()), ("mean", pa.list_(pa.float64())), ("comoment", pa.list_(pa.float64()))])


@dataclass(frozen=True)
class Moments:
    """Of ``n`` vectors: their mean and the summed products of deviations from it."""

    n: int
    mean: np.ndarray
    comoment: np.ndarray

    @classmethod
    def of(cls, rows: np.ndarray) -> Moments:
        mean = rows.mean(axis=0) if len(rows) else np.zeros(rows.shape[1])
        away = rows - mean
        return cls(len(rows), mean, away.T @ away)

    def __add__(self, other: Moments) -> Moments:
        if not self.n or not other.n:
            return self if self.n else other
        n = self.n + other.n
        gap = other.mean - self.mean
        comoment = self.comoment + other.comoment + np.outer(gap, gap) * (self.n * other.n / n)
        return Moments(n, self.mean + gap * (other.n / n), comoment)

    @property
    def covariance(self) -> np.ndarray:
        """Of the population."""
        return self.comoment / self.n


def together(parts: Iterable[Moments]) -> Moments:
    """All parts as one; at least one must be given."""
    return reduce(Moments.__add__, parts)


def _batch(keys: list, parts: list[Moments], schema: pa.Schema) -> pa.RecordBatch:
    columns = [keys, [p.n for p in parts], [p.mean.tolist() for p in parts], [p.comoment.ravel().tolist() for p in parts]]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _read(table) -> list[Moments]:
    numbers = zip(*(table[c].to_pylist() for c in ("n", "mean", "comoment")), strict=True)
    return [Moments(n, np.array(mean), np.array(comoment).reshape(len(mean), -1)) for n, mean, comoment in numbers]


def _partial(batches):
    found, part = None, 0
    for batch in batches:
        if len(batch):
            part = batch["part"][0].as_py()
            cells = batch["cells"].flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(batch), -1)
            own = Moments.of(cells)
            found = own if found is None else found + own
    if found is not None:
        yield _batch([part % _PARTS], [found], _SCHEMA)


def _merged(key, table):
    return pa.Table.from_batches([_batch([key[0].as_py()], [together(_read(table))], _SCHEMA)])


def moments(vectors: DataFrame, column: str) -> Moments | None:
    """Moments of an array column of one length without NULLs, in one pass; None without rows.

    Each partition hands on one part, these are merged in ``_PARTS`` groups,
    and as many matrices reach the driver, whatever the number of rows.
    """
    parts = vectors.select(F.spark_partition_id().alias("part"), F.col(column).alias("cells")).mapInArrow(
        _partial, "part int, n long, mean array<double>, comoment array<double>"
    )
    merged = parts.groupBy("part").applyInArrow(_merged, "part int, n long, mean array<double>, comoment array<double>")
    found = _read(merged.toArrow())
    return together(found) if found else None

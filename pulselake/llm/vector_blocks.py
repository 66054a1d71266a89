"""Embedding near-duplicates by a subspace pigeonhole join.

Unit vectors with cosine >= c are within squared distance 2 - 2c. The vectors
are rotated (principal axes of a bounded sample) and cut into low-dimensional
blocks; the squared budget is divided in proportion to the blocks' variance, so
a linked pair keeps within the budget of at least one block. Each block is
range-joined: its space is cut into cells by medians of the sample; a vector
lives in one cell and visits every later cell whose box is within the block's
distance. Pairs that meet within the block's budget are candidates, and are
verified by the cosine of the given vectors in double precision. A pair that
several blocks find counts in the first of them.

Tasks hand on numbers of links and a spanning forest per cell, never pairs.
Equal vectors are one vector with a multiplicity. Crowded cells are cut into
slices of bounded size: a task holds one slice and streams the vectors that
live in or visit the cell past it.

The fit uses at most ``sample`` vectors, chosen by a hash of the vector; every
vector is joined. The fit decides speed only: any rotation and any cells are
exact.

Defined results: vectors that are null, zero, or hold null or non-finite
components link with nothing, and vectors of different length do not link; all
keep their row. Rows without an id link like others and count as links, but a
component is named by the smallest id in it, which is null if there is none.
Repeated rows are equal vectors. Other columns are never looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulselake.llm.components import components
from pulselake.llm.simhash_trees import spanning
from pulselake.sources.workspace import settle

_SLACK = 1e-9
_CELL_ROWS = 2000
_STREAM = 4096


@dataclass
class BlockPlan:
    """Rotation, blocks and cells for vectors of one length."""

    rotation: np.ndarray
    edges: list[int]
    budgets: np.ndarray
    cells: list[list[tuple[np.ndarray, np.ndarray]]]
    slices: list[list[int]]

    def blocks(self, units: np.ndarray) -> list[np.ndarray]:
        turned = units @ self.rotation
        return [turned[:, a:b] for a, b in zip(self.edges[:-1], self.edges[1:], strict=True)]


def _cells(points: np.ndarray, splits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Boxes that cover the space, cut at medians of the points along the widest axis."""
    whole = (np.full(points.shape[1], -np.inf), np.full(points.shape[1], np.inf), points)
    boxes = [whole]
    for _ in range(splits):
        halves = []
        for low, high, own in boxes:
            if len(own) < 2 or not np.ptp(own, axis=0).max() > 0:
                halves.append((low, high, own))
                continue
            axis = int(np.argmax(own.std(axis=0)))
            cut = float(np.median(own[:, axis]))
            below, above = own[own[:, axis] < cut], own[own[:, axis] >= cut]
            left_high, right_low = high.copy(), low.copy()
            left_high[axis] = right_low[axis] = cut
            halves += [(low, left_high, below), (right_low, high, above)]
        boxes = halves
    return [(low, high) for low, high, _ in boxes]


def _homes(points: np.ndarray, cells: list) -> np.ndarray:
    home = np.zeros(len(points), np.int64)
    for i, (low, high) in enumerate(cells):
        home[((points >= low) & (points < high)).all(axis=1)] = i
    return home


def plan_blocks(units: np.ndarray, count: int, cosine: float, width: int) -> BlockPlan:
    """Fit rotation and cells on a sample of unit vectors that stands for ``count``."""
    size = units.shape[1]
    values, axes = np.linalg.eigh(np.cov(units.T).reshape(size, size) if len(units) > 1 else np.eye(size))
    blocks = max(1, size // width)
    # Deal the axes like cards, so that the blocks get about equal variance.
    dealt = [np.argsort(-values, kind="stable")[i::blocks] for i in range(blocks)]
    edges = np.concatenate(([0], np.cumsum([len(d) for d in dealt]))).tolist()
    rotation = axes[:, np.concatenate(dealt)]
    variance = np.array([max(values[d].sum(), 1e-12) for d in dealt])
    budgets = (2 - 2 * cosine + _SLACK) * variance / variance.sum()
    turned = units @ rotation
    splits = int(max(0, np.ceil(np.log2(max(count, 1) / _CELL_ROWS))))
    cells, slices = [], []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        own = _cells(turned[:, a:b], splits)
        shares = np.bincount(_homes(turned[:, a:b], own), minlength=len(own)) / max(len(units), 1)
        cells.append(own)
        slices.append([max(1, int(np.ceil(s * count / (2 * _CELL_ROWS)))) for s in shares])
    return BlockPlan(rotation, edges, budgets, cells, slices)


def _units(column) -> np.ndarray:
    """Rows of a list column as unit vectors in double precision."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = values.reshape(len(column), -1)
    return rows / np.sqrt((rows * rows).sum(axis=1))[:, None]


def _dealer(plan: BlockPlan):
    """Each vector in its home cell, and as a visitor in the later cells it can reach."""
    schema = pa.schema([("cell", pa.int64()), ("visitor", pa.bool_()), ("node", pa.int64()), ("rows", pa.int64()), ("vector", pa.list_(pa.float32()))])
    first_cell = np.concatenate(([0], np.cumsum([sum(s) for s in plan.slices])))

    def deal(batches):
        for batch in batches:
            if not len(batch):
                continue
            for block, points in enumerate(plan.blocks(_units(batch["vector"]))):
                cells, slices = plan.cells[block], np.array(plan.slices[block])
                begins = first_cell[block] + np.concatenate(([0], np.cumsum(slices)[:-1]))
                home = _homes(points, cells)
                own = batch["node"].to_numpy() % slices[home]
                reach = plan.budgets[block] * (1 + 1e-6) + _SLACK
                rows, places, roles = [np.arange(len(points))], [begins[home] + own], [np.zeros(len(points), bool)]
                for i, (low, high) in enumerate(cells):
                    gap = np.maximum(low - points, 0) + np.maximum(points - high, 0)
                    come = np.flatnonzero((home < i) & ((gap * gap).sum(axis=1) <= reach))
                    for s in range(slices[i]):
                        # A vector of the cell itself visits its later slices only.
                        at = np.concatenate([come, np.flatnonzero((home == i) & (own < s))])
                        rows.append(at)
                        places.append(np.full(len(at), begins[i] + s))
                        roles.append(np.ones(len(at), bool))
                at = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(places)), pa.array(np.concatenate(roles)), batch["node"].take(at), batch["rows"].take(at), batch["vector"].take(at).cast(pa.list_(pa.float32()))],
                    schema=schema,
                )

    return deal, first_cell


def _joiner(plan: BlockPlan, first_cell: np.ndarray, cosine: float):
    """Per cell: numbers of links and a spanning forest of them."""
    schema = pa.schema([("node", pa.int64()), ("other", pa.int64()), ("n", pa.int64())])

    def verified(block: int, left: np.ndarray, right: np.ndarray, left_points: np.ndarray, right_points: np.ndarray):
        budget = plan.budgets[block]
        near = (left_points**2).sum(1)[:, None] + (right_points**2).sum(1)[None, :] - 2 * left_points @ right_points.T <= budget + 1e-7
        a, b = np.nonzero(near)
        if len(a):
            keep = np.einsum("ij,ij->i", left[a], right[b]) >= cosine
            a, b = a[keep], b[keep]
        if len(a):
            found = np.zeros(len(a), bool)
            for earlier, (x, y) in enumerate(zip(plan.blocks(left), plan.blocks(right), strict=True)):
                within = ((x[a] - y[b]) ** 2).sum(axis=1) <= plan.budgets[earlier] + _SLACK
                if earlier == block:
                    keep = within & ~found
                    break
                found |= within
            a, b = a[keep], b[keep]
        return a, b

    class Cell:
        def __init__(self, cell: int):
            self.cell, self.block = cell, int(np.searchsorted(first_cell, cell, side="right")) - 1
            self.nodes, self.rows, self.units = [], [], []
            self.ready = False
            self.counts: dict[int, int] = {}
            self.out: list[tuple] = []

        def close(self) -> None:
            """All that live here have come: link them with each other."""
            self.nodes, self.rows, self.units = np.concatenate(self.nodes or [np.zeros(0, np.int64)]), np.concatenate(self.rows or [np.zeros(0, np.int64)]), np.concatenate(self.units) if self.units else np.zeros((0, 0))
            self.ready = True
            self.degree = np.zeros(len(self.nodes), np.int64)
            self.label = np.arange(len(self.nodes))
            if not len(self.nodes):
                return
            self.points = plan.blocks(self.units)[self.block]
            for i in range(0, len(self.nodes), _STREAM):
                for j in range(i, len(self.nodes), _STREAM):
                    a, b = verified(self.block, self.units[i : i + _STREAM], self.units[j : j + _STREAM], self.points[i : i + _STREAM], self.points[j : j + _STREAM])
                    a, b = a + i, b + j
                    keep = a < b
                    a, b = a[keep], b[keep]
                    np.add.at(self.degree, a, self.rows[b])
                    np.add.at(self.degree, b, self.rows[a])
                    if len(a):
                        self.label = spanning(a, b, self.label)

        def visit(self, nodes, rows, units) -> None:
            if not len(self.nodes):
                return
            a, b = verified(self.block, self.units, units, self.points, plan.blocks(units)[self.block])
            if not len(a):
                return
            np.add.at(self.degree, a, rows[b])
            degree = np.zeros(len(nodes), np.int64)
            np.add.at(degree, b, self.rows[a])
            # One link per visitor connects it; the others connect those that live here.
            by, first = np.unique(b, return_index=True)
            hub = np.zeros(len(nodes), np.int64)
            hub[by] = a[first]
            if len(a) > len(by):
                self.label = spanning(a, hub[b], self.label)
            self.out.append((nodes[by], self.nodes[a[first]], degree[by]))

        def results(self):
            if not self.ready:
                self.close()
            linked = np.flatnonzero((self.degree > 0) | (self.label != np.arange(len(self.label))))
            self.out.append((self.nodes[linked], self.nodes[self.label[linked]], self.degree[linked]))
            for columns in self.out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    def join(batches):
        cell = None
        for batch in batches:
            numbers = batch["cell"].to_numpy()
            visitor = batch["visitor"].to_numpy(zero_copy_only=False)
            nodes, rows = batch["node"].to_numpy(), batch["rows"].to_numpy()
            units = _units(batch["vector"]) if len(batch) else np.zeros((0, 0))
            cuts = np.flatnonzero(np.diff(numbers) | np.diff(visitor.astype(np.int8))) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(numbers)], strict=True):
                if a == b:
                    continue
                if cell is None or cell.cell != numbers[a]:
                    if cell is not None:
                        yield from cell.results()
                    cell = Cell(int(numbers[a]))
                if visitor[a]:
                    if not cell.ready:
                        cell.close()
                    cell.visit(nodes[a:b], rows[a:b], units[a:b])
                else:
                    cell.nodes.append(nodes[a:b])
                    cell.rows.append(rows[a:b])
                    cell.units.append(units[a:b])
        if cell is not None:
            yield from cell.results()

    return join


def near_duplicates(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", cosine: float = 0.95, width: int = 8, sample: int = 8192
) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept."""
    ident = F.col(id_column).cast("bigint")
    whole = vectors.select(ident.alias("vec_id"), F.col(vector_column).cast("array<float>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    norm = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    usable = F.col("vector").isNotNull() & finite & (norm > 0)
    # Zero of either sign is one value.
    plain = F.when(usable, F.transform("vector", lambda x: x + F.lit(0.0).cast("float")))
    rows = settle(whole.select("vec_id", plain.alias("vector")))
    classes = rows.where("vector IS NOT NULL").groupBy("vector").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("rows"))
    # Numbered as they are written, so every later read sees the same numbers.
    classes = settle(classes.withColumn("node", F.monotonically_increasing_id()).withColumn("size", F.size("vector")))
    lengths = sorted(r["size"] for r in classes.select("size").distinct().collect())
    links = None
    for length in lengths:
        own = classes.where(F.col("size") == length)
        count = own.count()
        chosen = own.orderBy(F.xxhash64("vector")).limit(sample).select("vector").toArrow()["vector"].combine_chunks()
        plan = plan_blocks(_units(chosen), count, cosine, width)
        deal, first_cell = _dealer(plan)
        dealt = own.select("node", "rows", "vector").mapInArrow(deal, "cell long, visitor boolean, node long, rows long, vector array<float>")
        sorted_ = dealt.repartition("cell").sortWithinPartitions("cell", "visitor")
        found = sorted_.mapInArrow(_joiner(plan, first_cell, cosine), "node long, other long, n long")
        links = found if links is None else links.union(found)
    if links is None:
        alone = rows.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
        return alone.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    links = settle(links)
    degrees = links.groupBy("node").agg(F.sum("n").alias("n"))
    found = components(links.select("node", "other"))
    known = classes.select("vector", "node", "least", "rows").join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = known.join(least, "root").join(degrees, "node", "left").select(
        "vector", (F.coalesce("n", F.lit(0)) + F.col("rows") - 1).alias("n_links"), "component_id"
    )
    valid = rows.where("vector IS NOT NULL").join(known, "vector").select("vec_id", "n_links", "component_id")
    alone = rows.where("vector IS NULL").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    every = valid.union(alone)
    return every.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))

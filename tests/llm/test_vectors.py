import numpy as np
import pytest

from pulselake.llm import vector_blocks
from pulselake.llm.vector_blocks import near_duplicates, plan_blocks
from tests.llm.compare import SF_DIR
from tests.llm.test_simhash import plain_components

SCHEMA = "vec_id long, embedding array<float>, label int, node long, rows string"


def expected(rows, cosine=0.95):
    usable = [(i, np.array(v, np.float64)) for i, v in rows if v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    linked, count = [], {k: 0 for k in range(len(usable))}
    for a in range(len(usable)):
        for b in range(a + 1, len(usable)):
            x, y = usable[a][1], usable[b][1]
            if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                linked.append((a, b))
                count[a] += 1
                count[b] += 1
    root = plain_components(range(len(usable)), linked)
    least = {}
    for k, (i, _) in enumerate(usable):
        if i is not None:
            least[root[k]] = min(i, least.get(root[k], i))
    out = [(i, count[k], least.get(root[k])) for k, (i, _) in enumerate(usable)]
    left = [i for i, v in rows if v is None or None in v or not np.isfinite(v).all() or not np.any(v)]
    out += [(i, 0, i) for i in left]
    return sorted(((i, n, c, i is not None and i == c) for i, n, c in out), key=str)


def clustered(count, size, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(max(1, count // 6), size))
    rows = centres[rng.integers(0, len(centres), count)] + rng.normal(size=(count, size)) * rng.choice([0.0, 0.15, 0.3, 0.35], count)[:, None]
    return [(i, [float(x) for x in r]) for i, r in enumerate(rows.astype(np.float32))]


def found(spark, rows, **options):
    frame = spark.createDataFrame([(i, v, 0, 1, "x") for i, v in rows], SCHEMA)
    return sorted((tuple(r) for r in near_duplicates(frame, **options).collect()), key=str)


@pytest.mark.parametrize("size,width", [(64, 8), (10, 3), (1, 8)])
def test_against_brute_force(spark, size, width):
    rows = clustered(300, size)
    assert found(spark, rows, width=width) == expected(rows)


def test_small_cells_and_slices(spark, monkeypatch):
    # Plans are made on the driver, so the bound takes effect there.
    monkeypatch.setattr(vector_blocks, "_CELL_ROWS", 12)
    rows = clustered(400, 16, seed=3) + [(1000 + i, [1.0] + [1e-3 * (i % 7)] * 15) for i in range(60)]
    assert found(spark, rows, sample=64) == expected(rows)


def test_awkward_vectors(spark):
    one = [1.0, 2.0, 3.0]
    rows = [
        (1, None), (2, [0.0, 0.0, 0.0]), (3, [1.0, None, 2.0]), (4, [float("nan"), 1.0, 1.0]), (5, [float("inf"), 1.0, 1.0]), (6, []),
        (9, one), (8, one), (7, [2.0, 4.0, 6.0]), (7, one), (10, [1.0, 2.0]), (11, [-1.0, -2.0, -3.0]), (None, one), (None, [5.0, -1.0, 0.0]), (12, [0.0, -0.0, 1.0]), (13, [-0.0, 0.0, 1.0]),
    ]
    assert found(spark, rows) == expected(rows)


def test_only_unusable_and_none(spark):
    assert found(spark, [(1, None), (2, [0.0])]) == expected([(1, None), (2, [0.0])])
    assert found(spark, []) == []


def test_budgets_add_up_to_the_whole():
    units = np.random.default_rng(1).normal(size=(50, 20))
    plan = plan_blocks(units, 1000, 0.95, 8)
    assert plan.budgets.sum() >= 2 - 2 * 0.95
    assert np.allclose(plan.rotation @ plan.rotation.T, np.eye(20))


def test_given_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    assert found(spark, rows) == expected(rows)

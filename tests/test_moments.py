import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulselake.operators.anomaly import WindowModel
from pulselake.operators.moments import Moments, moments, together
from pulselake.operators.refine import not_stored
from pulselake.operators.timeline import FeatureScaler
from pulselake.sources.workspace import fresh_folder, scratch, settle

CELLS = st.lists(st.lists(st.floats(-1e6, 1e6), min_size=3, max_size=3), min_size=1, max_size=40)


@given(CELLS, st.lists(st.integers(0, 40), max_size=6), st.randoms())
@settings(max_examples=200, deadline=None)
def test_parts_in_any_order_are_the_whole(rows, cuts, random):
    rows = np.array(rows)
    cuts = sorted(min(c, len(rows)) for c in cuts)
    parts = [Moments.of(rows[a:b]) for a, b in zip([0, *cuts], [*cuts, len(rows)])]
    random.shuffle(parts)
    whole, found = Moments.of(rows), together(parts)
    assert found.n == len(rows)
    scale = np.abs(rows).max() + 1
    assert np.abs(found.mean - whole.mean).max() <= 1e-9 * scale
    assert np.abs(found.comoment - whole.comoment).max() <= 1e-9 * scale**2 * len(rows)


def test_moments_of_a_table(spark):
    rng = np.random.default_rng(2)
    rows = rng.normal(50, 3, (500, 4)) @ rng.normal(0, 1, (4, 4))
    frame = spark.createDataFrame([(r.tolist(),) for r in rows], "v array<double>").repartition(9)
    found, whole = moments(frame, "v"), Moments.of(rows)
    assert found.n == 500 and np.allclose(found.mean, whole.mean, rtol=1e-9) and np.allclose(found.covariance, np.cov(rows.T, bias=True), rtol=1e-9)
    assert moments(frame.filter("false"), "v") is None


def test_components_from_parts(spark):
    rng = np.random.default_rng(3)
    rows = rng.normal(0, 1, (300, 4)) @ np.diag([5.0, 3.0, 1.0, 0.1])
    scaler = FeatureScaler(("a", "b"), (0.0, 0.0), (1.0, 1.0))
    model = WindowModel.from_moments(together([Moments.of(rows[200:]), Moments.of(rows[:200])]), scaler, rank=2, length=2)
    values, axes = np.linalg.eigh(np.cov(rows.T, bias=True))
    assert np.allclose(np.abs(model.components.T @ axes[:, [3, 2]]), np.eye(2), atol=1e-9)
    assert model.explained == pytest.approx(values[[3, 2]].sum() / values.sum())


def test_a_small_batch_leaves_stored_keys_where_they_are(spark, folder):
    stored = spark.range(100_000).select(F.col("id").cast("string").alias("user_id"), F.lit(1).alias("x"))
    stored.write.parquet(f"{folder}/stored")
    batch = settle(spark.createDataFrame([("5", 2), ("new", 3), (None, 4)], "user_id string, x int"))
    new = not_stored(batch, spark.read.parquet(f"{folder}/stored"), ("user_id",))
    assert sorted((r["user_id"] or "", r["x"]) for r in new.collect()) == [("", 4), ("new", 3)]
    assert "Exchange hashpartitioning" not in new._jdf.queryExecution().executedPlan().toString()


def test_scratch_is_deleted_at_the_end(spark):
    from pulselake.sources.files import exists

    with scratch(spark) as own:
        inside = settle(spark.range(3))
        assert inside.count() == 3 and exists(spark, own) and fresh_folder(spark, "x").startswith(own)
        with scratch(spark) as nested:
            settle(spark.range(1))
        assert not exists(spark, nested) and fresh_folder(spark, "x").startswith(own)
    assert not exists(spark, own) and not fresh_folder(spark, "x").startswith(own)
    with pytest.raises(RuntimeError):
        with scratch(spark) as lost:
            settle(spark.range(2))
            raise RuntimeError
    assert not exists(spark, lost)

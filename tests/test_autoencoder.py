"""The autoencoder: slopes, training, and what it gains over a linear bottleneck."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import autoencoder as ae
from millrace.operators import learn


@pytest.mark.parametrize("activation", ["tanh", "relu"])
@pytest.mark.parametrize("dropped", [False, True])
def test_slopes_against_differences(activation, dropped):
    rng = np.random.default_rng(2)
    units = [3, 5, 2, 5, 3]
    flat, x = ae._start(units, 1) + 0.1 * rng.normal(size=len(ae._start(units, 1))), rng.normal(size=(20, 3))
    keep = [(rng.random((20, u)) >= 0.3) / 0.7 for u in units[1:-1]] if dropped else None

    def loss(w):
        return np.mean((ae._forward(ae._layers(w, units), x, activation, keep)[-1] - x) ** 2)

    slope = ae._gradient(flat, units, x, activation, keep)
    for k in range(0, len(flat), 5):
        moved = np.zeros_like(flat)
        moved[k] = 1e-6
        assert np.isclose((loss(flat + moved) - loss(flat - moved)) / 2e-6, slope[k], atol=1e-6)


@pytest.fixture(scope="module")
def curve(spark):
    """Rows along an arc, which no straight line follows."""
    t = F.col("id") / 2000 * 2 - 1
    return spark.range(4000).repartition(4).select(
        "id", F.sin(t * 1.5).alias("a"), F.cos(t * 3).alias("b"), (t * t).alias("c"), F.lit(1.0).alias("flat")).cache()


def test_better_than_a_line(spark, curve):
    cols = ["a", "b", "c"]
    model = ae.train_autoencoder(curve, cols, hidden=(12, 1, 12), rounds=30, epochs=3, batch=64, rate=0.02)
    line = learn.reconstruction_error(curve, cols, k=1).agg(F.avg("reconstruction_error")).first()[0]
    bent = ae.reconstruct(model, curve).agg(F.avg("reconstruction_error")).first()[0]
    assert bent < 0.4 * line
    assert min(model.history) == pytest.approx(bent, rel=0.5) and model.history[0] > 5 * min(model.history)


def test_repeats_and_stops(spark, curve):
    """The same rows in another order give the same weights; training stops early when nothing is gained."""
    cols = ["a", "c"]
    kwargs = dict(hidden=(4, 1, 4), rounds=4, batch=128)
    one = ae.train_autoencoder(curve, cols, **kwargs)
    two = ae.train_autoencoder(curve.orderBy(F.rand(3)), cols, **kwargs)
    assert np.allclose(one.weights, two.weights)
    stuck = ae.train_autoencoder(curve, cols, hidden=(4, 1, 4), rounds=20, rate=0.0, patience=2)
    assert len(stuck.history) == 3


def test_tasks_grow_in_number_not_in_rows(spark, curve, monkeypatch):
    kept = []
    monkeypatch.setattr(ae, "TASK_ROWS", 300)
    monkeypatch.setattr(ae, "materialize", lambda df: kept.append(df) or df)
    ae.train_autoencoder(curve, ["a", "c"], hidden=(2,), rounds=1)
    sizes = [r["count"] for r in kept[0].groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 4000 and max(sizes) < 600


def test_odd_rows(spark):
    rows = [(1.0, None, 5), (2.0, 3.0, 5), (None, None, 5), (float(10**9), -1.0, 5)] * 30
    df = spark.createDataFrame(rows, "x double, y double, z int")
    model = ae.train_autoencoder(df, ["x", "y", "z"], hidden=(3,), rounds=2, dropout=0.2, activation="relu")
    out = ae.reconstruct(model, df)
    assert out.columns == ["x", "y", "z", "reconstruction_error"]
    assert out.where("reconstruction_error IS NULL OR isnan(reconstruction_error)").isEmpty() and out.count() == 120
    with pytest.raises(ValueError, match="no rows"):
        ae.train_autoencoder(df.limit(0), ["x"])

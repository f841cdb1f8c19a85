"""The convolutional model: exact gradients, the reference losses, and what it learns."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rastra.operators import convolution, evaluate, inference

KIND = "raster_id long, row_off int, col_off int, row int, col int, nir double, red double, label double"
EDGE = 12


def ring_tiles(n, seed=1):
    """A pixel is a target if its surroundings are bright, not itself; noise hides it from a model of single pixels."""
    rng, out = np.random.default_rng(seed), []
    for k in range(n):
        hot = np.zeros((EDGE, EDGE))
        for _ in range(3):
            r, c = rng.integers(0, EDGE - 4, 2)
            hot[r : r + 4, c : c + 4] = 1
        seen = hot * 0.6 + rng.normal(0, 0.5, hot.shape)
        out += [(k, 0, 0, r, c, float(seen[r, c]), 0.5, float(hot[r, c])) for r in range(EDGE) for c in range(EDGE)]
    return out


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(3)
    net, x, y = convolution.Network(3, 4, seed=2), rng.normal(size=(3, 6, 6)), (rng.random((6, 6)) > 0.6).astype(float)
    y[0, 0] = np.nan
    kept = []
    _, slope = convolution.tile_loss(net.logits(x, kept), y)
    got, flat = net.gradient(kept, slope), net.flat
    for k in rng.choice(len(flat), 60, replace=False):
        ends = []
        for d in (1e-5, -1e-5):
            net.flat = flat + d * (np.arange(len(flat)) == k)
            ends.append(convolution.tile_loss(net.logits(x), y)[0])
        assert abs((ends[0] - ends[1]) / 2e-5 - got[k]) < 1e-6


def test_loss_is_that_of_the_columns(spark):
    z, y = np.array([[0.3, -2.0], [1.5, 4.0]]), np.array([[1.0, 0.0], [0.0, 1.0]])
    rows = spark.createDataFrame([(float(a), float(b)) for a, b in zip(z.ravel(), y.ravel())], "logit double, target double")
    assert abs(evaluate.losses(rows).first()["combined"] - convolution.tile_loss(z, y)[0]) < 1e-9


def test_it_learns_what_single_pixels_do_not_tell(spark, tmp_path):
    tiles = spark.createDataFrame(ring_tiles(40), KIND)
    model, history = convolution.fit_convolutional(tiles, EDGE, channels=("nir", "red"), hidden=6, epochs=14, batches=2, rate=0.03, alpha=0.5)
    epochs = history.collect()
    assert epochs[-1]["val_loss"] < epochs[0]["val_loss"]
    fresh = spark.createDataFrame(ring_tiles(15, seed=2), KIND)
    f1 = lambda rows: evaluate.precision_recall(rows.withColumn("target", F.col("label"))).first()["f1"]
    linear = inference.fit_linear(tiles, channels=("nir", "red"), steps=40)
    assert f1(model.logits(fresh)) > f1(linear.logits(fresh)) + 0.05
    model.save(spark, str(tmp_path / "model"))
    again = inference.choose_model(spark, str(tmp_path / "model"))
    assert isinstance(again, convolution.ConvolutionalModel) and (again.network.flat == model.network.flat).all()
    linear.save(spark, str(tmp_path / "linear"))
    assert isinstance(inference.choose_model(spark, str(tmp_path / "linear")), inference.LinearModel)


def test_awkward_tiles(spark):
    none = spark.createDataFrame([], KIND)
    model, history = convolution.fit_convolutional(none, EDGE, channels=("nir", "red"), epochs=3)
    assert history.count() == 1 and model.logits(none).count() == 0
    rows = [(1, 0, 0, 0, 0, None, float("nan"), None), (1, 0, 0, 3, 3, 1.0, 1.0, 1.0), (1, 0, 0, 3, 4, 1.0, 1.0, float("nan"))]
    model, history = convolution.fit_convolutional(spark.createDataFrame(rows, KIND), EDGE, channels=("nir", "red"), epochs=2)
    assert all(np.isfinite(r["val_loss"]) for r in history.collect())
    assert all(np.isfinite(r["logit"]) for r in model.logits(spark.createDataFrame(rows, KIND)).collect())
    with pytest.raises(ValueError):
        convolution.fit_convolutional(none, EDGE, epochs=0)


def test_rate_falls_and_training_stops(spark):
    tiles = spark.createDataFrame(ring_tiles(10), KIND)
    _, history = convolution.fit_convolutional(tiles, EDGE, channels=("nir", "red"), hidden=2, epochs=9, batches=1, rate=0.0, patience=4, lr_patience=1, factor=0.5)
    assert history.count() == 5

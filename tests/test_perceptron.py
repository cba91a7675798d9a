"""Networks: gradients, the same weights for any layout, early stopping, three losses."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise import plans
from foldwise.plans import perceptron
from foldwise.plans.perceptron import BCE, CE, MSE, Net, NetSettings, fit_perceptrons, net_settings
from tests.conftest import values


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    data = []
    for i in range(300):
        a, b = rng.uniform(-2, 2), rng.uniform(10, 30)
        data.append((i, a, b, 50 + 20 * abs(a) + b + rng.gauss(0, 0.5), int(abs(a) > 1), int(abs(a) // 0.7), i % 3))
    return spark.createDataFrame(data, "id bigint, a double, b double, y double, flag int, kind int, fold int").repartition(3).cache()


@pytest.mark.parametrize("loss, outputs", [(MSE, 1), (BCE, 1), (CE, 3)])
def test_gradients(loss, outputs):
    """Against differences of the loss."""
    rng = np.random.default_rng(1)
    net = Net([4, 5, 3, outputs])
    w, x = net.start(2) + rng.normal(0, 0.1, net.size), rng.normal(size=(7, 4))
    y = rng.integers(0, max(2, outputs), 7).astype(float)
    keep = [(rng.random((7, b)) < 0.8) / 0.8 for _, b in net.shapes[:-1]]
    got = net.gradient(w, x, y, loss, keep)
    for i in rng.choice(net.size, 25, replace=False):
        step = np.zeros(net.size)
        step[i] = 1e-6
        up, down = (perceptron.row_losses(loss, net.forward(w + s * step, x, keep)[-1], y).mean() for s in (1, -1))
        assert got[i] == pytest.approx((up - down) / 2e-6, abs=1e-5)


def roles(k=2):
    return F.array(*[F.when(F.col("fold") == i, 2).otherwise(1) for i in range(k)])


def test_any_layout_gives_the_same_weights(rows, monkeypatch):
    monkeypatch.setattr(perceptron, "SHARD_ROWS", 64)
    settings = NetSettings(hidden_sizes=(6,), epochs=3, batch_size=16, learning_rate=0.01, seed=4)
    want = fit_perceptrons(rows, "id", "y", ["a", "b"], roles(), 2, settings)
    again = fit_perceptrons(rows.repartition(7).sortWithinPartitions("a"), "id", "y", ["a", "b"], roles(), 2, settings)
    alone = fit_perceptrons(rows, "id", "y", ["a", "b"], F.array(roles()[0]), 1, settings)
    for a, b in zip(want, again):
        assert a.weights == pytest.approx(b.weights, abs=1e-9) and a.curve == pytest.approx(b.curve)
    # the second model's fold scales the inputs of both, so only the shape is the same
    assert alone[0].weights.shape == want[0].weights.shape
    assert want[0].curve[-1] < want[0].curve[0]


def test_training_stops_when_patience_ends(rows):
    nets = fit_perceptrons(rows, "id", "flag", ["a", "b"], roles(), 2, NetSettings(
        hidden_sizes=(8,), epochs=40, batch_size=8, learning_rate=0.2, loss=BCE, dropout_rate=0.0), patience=2)
    for k, net in enumerate(nets):
        assert net.best_epoch == int(np.argmin(net.curve)) and (len(net.curve) == net.best_epoch + 3 or len(net.curve) == 41)
        held = rows.filter(F.col("fold") == k).select("flag", net.prediction(rows).alias("p")).collect()
        assert np.mean([-math.log(max(1e-15, r.p if r.flag else 1 - r.p)) for r in held]) == pytest.approx(min(net.curve), rel=1e-4)


@pytest.mark.parametrize("target, loss, metric, bound", [("y", "mse", "r2", 0.6), ("flag", "bce", "roc_auc", 0.9), ("kind", "ce", "roc_auc", 0.8)])
def test_three_losses(rows, target, loss, metric, bound):
    result = plans.train_and_cv(rows, target, ["a", "b"], "nn", "id", model_params={"hidden_sizes": [16], "dropout_rate": 0.0}, fit_params={
        "epochs": 12, "batch_size": 16, "lr": 0.03, "loss_fn": loss, "early_stopping_rounds": 5}, test=rows.limit(4))
    assert result.pooled_score(metric) > bound and result.test.count() == 4
    if loss == "ce":
        assert all(abs(sum(p) - 1) < 1e-9 for p in values(result.oof, "id", "prediction"))


def test_settings_and_wrong_rows(spark, rows):
    s = net_settings({"hidden_sizes": [3], "dropout_rate": 0.1, "output_size": 1}, {"lr": 0.5, "loss_fn": "binary_crossentropy", "optimizer": "sgd", "device": "auto"})
    assert (s.hidden_sizes, s.learning_rate, s.loss, s.optimizer) == ((3,), 0.5, BCE, "sgd")
    for bad in ({"loss_fn": "hinge"}, {"optimizer": "lion"}, {"layers": 3}):
        with pytest.raises(ValueError):
            net_settings(bad)
    with pytest.raises(ValueError, match="no training rows"):
        plans.train_single_fold(rows.limit(0), rows, None, "y", ["a"], "nn", "id")
    with pytest.raises(Exception, match="must be numbers"):
        plans.train_single_fold(rows.withColumn("a", F.when(F.col("id") != 5, F.col("a"))), rows, None, "y", ["a"], "nn", "id")

"""Histogram boosting against a plain boosting of the same bins, and its settings."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise import plans
from foldwise.plans import boosting
from foldwise.plans.boosting import TRAIN, VALID, Settings, fit_boosting, settings_of
from tests.conftest import values

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    out = []
    for i in range(240):
        a, b, c = rng.choice([None, *range(12)]), round(rng.uniform(-2, 2), 1), rng.randint(0, 3)
        y = (a if a is not None else 7) + 2 * abs(b) + (c == 2) * 3 + rng.gauss(0, 0.4)
        out.append((i, None if a is None else float(a), b if i % 17 else float("nan"), float(c), y, int(y > 8), int(y // 5) % 3, i % 4))
    return out


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, "id bigint, a double, b double, c double, y double, flag int, kind int, fold int").repartition(3).cache()


def roles(models=2):
    """Model k is measured on fold k and trained on the others."""
    return F.array(*[F.when(F.col("fold") == k, VALID).otherwise(TRAIN) for k in range(models)])


def plain_tree(bins, g, h, s, nodes=None, depth=0):
    """(feature, bin, missing goes left, left, right) or a value: the best cut over all features and bins."""
    def strength(own):
        rest = max(abs(g[own].sum()) - s.reg_alpha, 0)
        return rest ** 2 / (h[own].sum() + s.reg_lambda) if h[own].sum() + s.reg_lambda else 0.0

    own = np.arange(len(bins)) if nodes is None else nodes
    total = g[own].sum()
    value = -s.learning_rate * math.copysign(max(abs(total) - s.reg_alpha, 0), total) / (h[own].sum() + s.reg_lambda)
    best = (1e-12, None)
    if depth < s.max_depth:
        for f in range(bins.shape[1]):
            for cut in sorted(set(bins[own, f]) - {0}):
                ways = []
                for missing in (False, True):
                    goes = (bins[own, f] <= cut) & ((bins[own, f] > 0) | missing)
                    left, right = own[goes], own[~goes]
                    if min(len(left), len(right)) >= max(1, s.min_child_samples) and min(h[left].sum(), h[right].sum()) >= s.min_child_weight:
                        ways.append(((strength(left) + strength(right) - strength(own)) / 2 - s.gamma, missing, left, right))
                if ways:
                    way = ways[-1] if ways[-1][0] > ways[0][0] + 1e-12 else ways[0]
                    if np.float32(way[0]) > np.float32(best[0]):
                        best = (way[0], (f, cut, way[1], way[2], way[3]))
    if best[1] is None:
        return value
    f, cut, missing, left, right = best[1]
    return (f, cut, missing, plain_tree(bins, g, h, s, left, depth + 1), plain_tree(bins, g, h, s, right, depth + 1))


def plain_score(tree, row):
    while not isinstance(tree, float):
        f, cut, missing, left, right = tree
        tree = left if (row[f] <= cut if row[f] else missing) else right
    return tree


def plain_boosting(bins, y, train, s, base):
    scores = np.tile(np.array(base, float), (len(bins), 1))
    for _ in range(s.rounds):
        g, h = boosting.gradients(s.loss, y, scores)
        trees = [plain_tree(bins[train], g[train, c], h[train, c], s) for c in range(scores.shape[1])]
        for c, tree in enumerate(trees):
            scores[:, c] += [plain_score(tree, row) for row in bins]
    return scores


@pytest.mark.parametrize("label, settings", [
    ("y", Settings(rounds=4, max_depth=3, learning_rate=0.5, reg_lambda=1.5, reg_alpha=2.0)),
    ("y", Settings(rounds=3, max_depth=2, learning_rate=0.3, min_child_samples=20, gamma=5.0)),
    ("y", Settings(rounds=3, max_depth=2, learning_rate=0.7, loss="absolute", max_bin=5)),
    ("flag", Settings(rounds=3, max_depth=3, learning_rate=0.4, min_child_weight=2.0, loss="binary")),
    ("kind", Settings(rounds=3, max_depth=2, learning_rate=0.4, reg_lambda=1.0, loss="classes")),
])
def test_equal_to_plain_boosting(table, rows, label, settings, monkeypatch):
    monkeypatch.setattr(boosting, "KEEP_ROUNDS", 2)
    models = fit_boosting(table, "id", label, FEATURES, roles(), 2, settings)
    x = np.array([[math.nan if v is None else v for v in r[1:4]] for r in rows])
    y = np.array([r[{"y": 4, "flag": 5, "kind": 6}[label]] for r in rows], float)
    for k, model in enumerate(models):
        bins = model.binning.bins(x)
        train = np.array([r[7] != k for r in rows])
        if settings.loss == "squared":
            assert model.base[0] == pytest.approx(y[train].mean())
        want = plain_boosting(bins, y, train, settings, model.base)
        got = np.array(values(table.select("id", model.prediction(table).alias("p")), "id", "p"))
        if settings.loss == "binary":
            want = boosting.probabilities("binary", want)[:, 0]
        elif settings.loss == "classes":
            want = boosting.probabilities("classes", want)
        else:
            want = want[:, 0]
        assert got == pytest.approx(want, abs=1e-9)
        assert model.best_round == settings.rounds == model.rounds_trained


def predictions(table, model):
    return values(table.select("id", model.prediction(table).alias("p")), "id", "p")


def test_layout_changes_nothing(table, monkeypatch):
    """Partitions, cells sent batch by batch and how often scores are written are no part of the result."""
    settings = Settings(rounds=3, max_depth=3, learning_rate=0.3, subsample=0.6, subsample_freq=2, colsample_bytree=0.7,
                        colsample_bynode=0.5, seed=3)
    want = [predictions(table, m) for m in fit_boosting(table, "id", "y", FEATURES, roles(), 2, settings)]
    monkeypatch.setattr(boosting, "DENSE_CELLS", 0)
    monkeypatch.setattr(boosting, "KEEP_ROUNDS", 1)
    again = fit_boosting(table.repartition(7), "id", "y", FEATURES, roles(), 2, settings)
    for own, model in zip(want, again):
        assert predictions(table, model) == pytest.approx(own, abs=1e-9)
    alone = fit_boosting(table, "id", "y", FEATURES, roles(1), 1, settings)
    assert predictions(table, alone[0]) == pytest.approx(want[0], abs=1e-9)
    other = fit_boosting(table, "id", "y", FEATURES, roles(), 2, Settings(**{**settings.__dict__, "seed": 4}))
    assert predictions(table, other[0]) != pytest.approx(want[0], abs=1e-3)


@pytest.mark.parametrize("label, settings", [
    ("y", Settings(rounds=9, max_depth=4, learning_rate=0.8, reg_alpha=1.0, subsample=0.7, subsample_freq=2, colsample_bytree=0.7,
                   colsample_bynode=0.5, min_child_weight=3.0, seed=5)),
    ("y", Settings(rounds=5, max_depth=-1, num_leaves=40, learning_rate=0.5, min_child_samples=1)),
    ("kind", Settings(rounds=4, max_depth=3, learning_rate=0.5, subsample=0.8, colsample_bytree=0.7, loss="classes")),
])
def test_routes_agree(table, label, settings, monkeypatch):
    """Sums of many rounds from a pass, of a round from a pass, and of a level from a pass give the same trees and losses."""
    # overlapping and gapped roles of four models, more kinds of rows than models
    place = F.array(*[F.when(F.col("id") % (k + 3) == 0, VALID).when((F.col("id") + k) % 11 == 0, 0).otherwise(TRAIN) for k in range(4)])
    found = []
    for ahead, joint, own in ((boosting.AHEAD_CELLS, 0, roles()), (0, boosting.JOINT_CELLS, roles()), (0, 0, roles()),
                              (boosting.AHEAD_CELLS, 0, place), (0, boosting.JOINT_CELLS, place)):
        monkeypatch.setattr(boosting, "AHEAD_CELLS", ahead)
        monkeypatch.setattr(boosting, "JOINT_CELLS", joint)
        monkeypatch.setattr(boosting, "AHEAD_ROUNDS", 2)
        monkeypatch.setattr(boosting, "AHEAD_ROWS", 10)
        monkeypatch.setattr(boosting, "PART_CELLS", 100)
        monkeypatch.setattr(boosting, "NODE_CELLS", 2000 if ahead else 2)
        models = 4 if own is place else 2
        fitted = fit_boosting(table, "id", label, FEATURES, own, models, settings, patience=3, categorical=["c"])
        wide = settings.loss == "classes"
        score = [values(table.select("id", (F.col("p")[0] if wide else F.col("p")).alias("p")), "id", "p") for table in (
            table.select("id", m.prediction(table).alias("p")) for m in fitted)]
        found.append((score, [m.curve for m in fitted], [[[(t.feature, t.cut, t.left) for t in r] for r in m.trees] for m in fitted]))
    for first, others in ((0, (1, 2)), (3, (4,))):
        for other in others:
            assert found[other][2] == found[first][2]
            for i in (0, 1):
                for a, b in zip(found[first][i], found[other][i]):
                    assert a == pytest.approx(b, rel=1e-9)


def test_no_pass_for_a_level(table, monkeypatch):
    """Features of few combinations of bins: no level and, for squared loss, no round has a pass of its own."""
    def never(*args):
        raise AssertionError("a pass for a level")

    passes, ahead = [], boosting._draws_ahead
    monkeypatch.setattr(boosting, "best_cuts", never)
    monkeypatch.setattr(boosting, "_draws_ahead", lambda *a: passes.append(len(a[1])) or ahead(*a))
    settings = Settings(rounds=20, max_depth=6, learning_rate=0.2, subsample=0.8)
    assert [m.best_round for m in fit_boosting(table, "id", "y", FEATURES, roles(), 2, settings)] == [20, 20]
    assert passes == [20]
    assert fit_boosting(table, "id", "kind", FEATURES[::2], roles(), 2, Settings(rounds=2, max_depth=6, loss="classes"))[0].best_round == 2


@pytest.mark.parametrize("label, loss", [("y", "squared"), ("kind", "classes"), ("flag", "binary")])
def test_training_stops_when_patience_ends(table, label, loss):
    models = fit_boosting(table, "id", label, FEATURES, roles(), 2, Settings(rounds=60, max_depth=4, learning_rate=0.9, loss=loss), patience=3)
    for k, model in enumerate(models):
        after = model.curve[1:]
        assert model.best_round == 1 + int(np.argmin(after)) < 60
        assert model.rounds_trained == len(after) == model.best_round + 3
        held = [r for r in table.filter(F.col("fold") == k).select(label, model.prediction(table).alias("p")).collect()]
        loss_now = np.mean([(r[0] - r.p) ** 2 if loss == "squared" else -math.log(
            max(1e-15, r.p[r[0]] if loss == "classes" else (r.p if r[0] else 1 - r.p))) for r in held])
        assert loss_now == pytest.approx(min(after))


def test_leaves_are_bounded_and_best_first(table):
    model = fit_boosting(table, "id", "y", FEATURES, roles(), 2, Settings(rounds=3, max_depth=-1, num_leaves=5))[0]
    assert all(t.leaves == 5 for own in model.trees for t in own)
    shares = dict(model.importances())
    assert sum(shares.values()) == pytest.approx(1) and shares["a"] > shares["c"]


def test_categories_split_into_sets(spark):
    """Values of one group lie apart in any order of the names; one split must gather them."""
    high = {"b", "e", "g", None}
    rows = [(i, "abcdefgh"[i % 8] if i % 10 else None) for i in range(270)]
    df = spark.createDataFrame([(i, c, float(c in high), i % 3) for i, c in rows], "id bigint, c string, y double, fold int")
    result = plans.train_and_cv(df, "y", ["c"], "lgbm", "id", cat_features=["c"], model_params={
        "n_estimators": 1, "learning_rate": 1.0, "max_depth": 1, "min_child_samples": 1})
    assert [r.prediction for r in result.oof.orderBy("id").collect()] == pytest.approx([float(c in high) for _, c in rows])
    unknown = spark.createDataFrame([(1, "new"), (2, None), (3, "a")], "id bigint, c string")
    found = values(result.models[0].predict(unknown, "id"), "id", "prediction")
    assert found[0] == found[1] and found[2] == pytest.approx(0)


def test_vector_feature_and_odd_rows(spark):
    df = spark.createDataFrame([(i, [float(i % 3), None], float(i % 3 == 1), i % 2) for i in range(60)] + [(99, None, 1.0, 0), (98, [0.0], None, 1)],
                               "id bigint, v array<double>, y double, fold int")
    result = plans.train_and_cv(df, "y", ["v"], "xgb", "id", model_params={"n_estimators": 2, "learning_rate": 1.0, "reg_lambda": 0.0, "max_depth": 2})
    found = {r.id: r.prediction for r in result.oof.collect()}
    assert len(found) == 62 and found[4] == pytest.approx(1) and found[3] == pytest.approx(0)
    assert [r.feature for r in result.importances().filter("fold = 0").collect()] == ["v[0]", "v[1]"]
    with pytest.raises(ValueError, match="no training rows"):
        plans.train_single_fold(df.limit(0), df, None, "y", ["v"], "xgb", "id")


def test_settings_of_the_libraries():
    flagship = {"objective": "reg:squarederror", "eval_metric": "rmse", "seed": 42, "max_depth": 19, "learning_rate": 0.03, "min_child_weight": 50,
                "reg_alpha": 5, "reg_lambda": 1, "subsample": 0.85, "colsample_bytree": 0.6, "colsample_bynode": 0.5, "tree_method": "hist"}
    s = settings_of("xgb", flagship, 1_000_000)
    assert (s.rounds, s.max_depth, s.min_child_weight, s.reg_alpha, s.subsample, s.colsample_bynode) == (1_000_000, 19, 50, 5, 0.85, 0.5)
    light = settings_of("lgbm", {"objective": "regression_l1", "lambda_l1": 1, "lambda_l2": 2, "feature_fraction": 0.5, "bagging_fraction": 0.5,
                                 "bagging_freq": 4, "num_leaves": 63, "verbose": -1, "metric": "mae"})
    assert (light.loss, light.reg_alpha, light.reg_lambda, light.colsample_bytree, light.subsample, light.subsample_freq, light.num_leaves) == (
        "absolute", 1, 2, 0.5, 0.5, 4, 63)
    assert settings_of("lgbm", {"subsample": 0.5}).subsample == 1 and settings_of("xgb", {"subsample": 0.5}).subsample == 0.5
    assert [settings_of(f, {}).rounds for f in ("lgbm", "xgb", "catboost")] == [100, 1000, 1000]
    assert settings_of("catboost", {"depth": 8, "l2_leaf_reg": 5, "iterations": 7, "loss_function": "RMSE"}).rounds == 7
    for bad in ({"objective": "quantile"}, {"boosting_type": "dart"}, {"gamma_ray": 1}, {"objective": "binary", "loss_function": "RMSE"}):
        with pytest.raises(ValueError):
            settings_of("lgbm", bad)


def test_flagship_flow(table):
    """A million rounds at most, a falling learning rate and patience, over all folds."""
    params = {"objective": "reg:squarederror", "eval_metric": "rmse", "seed": 42, "max_depth": 19, "min_child_weight": 25, "reg_alpha": 1,
              "reg_lambda": 1, "subsample": 0.85, "colsample_bytree": 0.7, "colsample_bynode": 0.7, "tree_method": "hist"}
    rows = table.withColumn("fold", F.col("fold") % 2)
    result = plans.train_and_cv(rows, "y", FEATURES, "xgb", "id", model_params=params, fit_params={
        "num_boost_round": 1_000_000, "early_stopping_rounds": 2, "learning_rates": lambda i: 0.9 if i < 2 else 0.7})
    assert result.oof.count() == 240 and result.pooled_score("r2") > 0.5
    for m in result.models:
        assert m.model.rounds_trained == m.model.best_round + 2


def test_leaves_by_masks(monkeypatch):
    """Leaves found by words of bits are those of walking down; more than 64 leaves are walked."""
    rng = np.random.default_rng(5)
    bins = rng.integers(0, 255, (500, 3)).astype(np.uint8)
    for splits in (0, 1, 7, 15, 40, 90):
        tree, open_ = boosting.Tree(), [0]
        for i in range(splits):
            node = open_.pop(0)
            cut = frozenset(rng.integers(1, 255, 60).tolist()) if i % 5 == 4 else int(rng.integers(1, 254))
            open_ += tree.split(node, int(rng.integers(0, 3)), cut, bool(rng.integers(0, 2)), (1.0 * i, -1.0 * i), 1.0)
            found = tree.nodes(bins)
        found, side = tree.nodes(bins), tree.goes_left()
        for row, leaf in zip(bins, found):
            node = 0
            while tree.feature[node] >= 0:
                node = (tree.left if side[node, row[tree.feature[node]]] else tree.right)[node]
            assert node == leaf
        assert ("_ways" in tree.__dict__) == (1 < tree.leaves <= 64 or splits > 63)


def test_rows_of_bytes():
    """Matrices go to binary columns and back by their buffers, also in a slice of a batch."""
    for kind in (np.uint8, np.float64):
        matrix = np.arange(30).reshape(10, 3).astype(kind)
        column = boosting._bytes(matrix)
        assert column.to_pylist() == [r.tobytes() for r in matrix]
        assert (boosting._matrix(column.slice(3, 4), kind, 4) == matrix[3:7]).all()


def test_flagship_trains_to_the_end(spark, tmp_path, monkeypatch):
    """A long run: small falling steps, deep trees, thirty rounds of patience for every fold."""
    from catalog import learners

    rng = random.Random(4)
    rows = [(k, n, float(rng.randint(1, 50)), rng.randint(0, 10) / 100, "RAN"[k % 3]) for k in range(900) for n in range(1, rng.randint(2, 7))]
    rows = [(k, n, q, d, round(q * rng.uniform(900, 2000), 2), f) for k, n, q, d, f in rows]
    spark.createDataFrame(rows, "l_orderkey bigint, l_linenumber int, l_quantity double, l_discount double, l_extendedprice double, "
                          "l_returnflag string").write.parquet(f"{tmp_path}/lineitem.parquet")
    results, train = [], learners.plans.train_and_cv

    def kept(*args, **options):
        results.append((options["fit_params"], options["model_params"], train(*args, **options)))
        return results[-1][-1]

    monkeypatch.setattr(learners.plans, "train_and_cv", kept)
    found = learners.boost_flagship(spark, str(tmp_path)).collect()
    fit, params, result = results[0]
    assert len(found) == 3 and all(r.every_row_scored and r.beats_the_mean and r.stopped_by_patience for r in found)
    assert fit["early_stopping_rounds"] == 30 and params["max_depth"] == 19 and [fit["learning_rates"](i) for i in (0, 114, 115)] == [0.05, 0.05, 0.01]
    assert all(m.model.best_round > 30 and m.model.rounds_trained == m.model.best_round + 30 for m in result.models)

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise import operators as op
from foldwise import plans
from foldwise.plans.boosting import settings_of
from foldwise.plans.profile import save_profile
from foldwise.plans.selection import fold_products
from tests.conftest import values

approx = pytest.approx


# --- profiles -------------------------------------------------------------


def check_summary(frame):
    df = frame("col_int int, col_float double, col_str string, col_null float", col_int=[1, 2, 2, None, 1],
               col_float=[1.1, 2.2, 3.3, None, 2.2], col_str=["a", "b", "a", "c", None], col_null=[None] * 5)
    rows = {r["Column"]: r for r in plans.calculate_feature_summary(df).collect()}
    assert (rows["col_int"]["NumUnique"], rows["col_int"]["NumNull"], rows["col_int"]["PctNull"]) == (3, 1, 20.0)
    assert rows["col_int"]["Median"] == 1.5 and rows["col_float"]["Median"] == approx(2.2)
    assert rows["col_float"]["StdDev"] == approx(np.std([1.1, 2.2, 3.3, 2.2], ddof=1))
    assert rows["col_null"]["PctNull"] == 100.0 and rows["col_null"]["Mean"] is None
    assert rows["col_str"]["Mean"] is None and rows["col_str"]["DataType"] == "string"
    rows = {r["Column"]: r for r in plans.calculate_feature_summary(df, count_null=False).collect()}
    assert rows["col_int"]["NumUnique"] == 2 and rows["col_null"]["NumUnique"] == 0


def test_summary(frame):
    check_summary(frame)


def test_summary_on_large_routes(frame, big_data_routes):
    check_summary(frame)


def test_correlations(frame, monkeypatch):
    df = frame("target double, feat1 double, feat2 double, feat3 double, cat string, flat double",
               target=[1., 2., 3., 4., 5.], feat1=[2., 4., 6., 8., 10.], feat2=[5., 4., 3., 2., 1.],
               feat3=[1., 1., 2., 2., None], cat=list("abcde"), flat=[1.] * 5)
    found = plans.calculate_correlations(df, "target")
    assert found.features == ["feat1", "feat2", "feat3"]
    rows = {r["feature"]: r for r in found.matrix.collect()}
    assert rows["feat1"]["feat2"] == approx(-1) and rows["feat2"]["feat2"] == 1.0
    order = [r["feature"] for r in found.target.collect()]
    assert order == ["feat1", "feat3", "feat2"]
    assert [r["feature"] for r in plans.top_correlations(found.target, "target_correlation", 2).collect()] == ["feat1", "feat2"]
    assert plans.calculate_correlations(df, "cat").target is None
    assert plans.calculate_correlations(df, "target", ["cat", "flat"]).matrix is None
    # feat3 varies, but not over the rows without nulls
    part = frame("target double, feat1 double, feat2 double, feat3 double", target=[1., 2., 3., 4.],
                 feat1=[2., 4., 6., None], feat2=[5., 4., 1., 2.], feat3=[1., 1., 1., 2.])
    for names in (["feat1", "feat2", "feat3"], ["feat1", "feat3"]):
        held = {r["feature"]: r for r in plans.calculate_correlations(part, "target", names).matrix.collect()}
        assert held["feat1"]["feat3"] is None and held["feat3"]["feat3"] is None and held["feat1"]["feat1"] == approx(1)


def test_target_by_feature(frame):
    df = frame("target double, cat string, num double, low bigint", target=[10., 15., 20., 25., 12., 18., 22., 8., 9., 19.],
               cat=list("ABABCABCCA"), num=[1., 2., 3., 4., 5., 6., 7., 8., 9., 10.], low=[1, 2, 1, 2, 1, 2, 1, 2, 1, 2])
    rows = {r["feature_value"]: r for r in plans.analyze_target_by_feature(df, "target", "cat").collect()}
    assert rows["A"]["count"] == 4 and rows["A"]["target_mean"] == approx((10 + 20 + 18 + 19) / 4)
    assert rows["A"]["target_median"] == 18.5
    assert plans.analyze_target_by_feature(df, "target", "num") is None  # nearly unique
    doubled = df.unionByName(df)
    bins = plans.analyze_target_by_feature(doubled, "target", "num", num_bins=2).collect()
    assert [r["feature_value"] for r in bins] == ["q1 (1-5.5)", "q2 (5.5-10)"] and [r["count"] for r in bins] == [10, 10]
    few = plans.analyze_target_by_feature(doubled.withColumn("num", F.when(F.col("num") > 9, 1.0).otherwise(0.0)),
                                          "target", "num", num_bins=4)
    assert {r["feature_value"] for r in few.collect()} == {"0.0", "1.0"}
    assert plans.analyze_target_by_feature(df, "target", "low").count() == 2
    top = plans.analyze_target_by_feature(df, "target", "cat", max_categories=2).collect()
    assert [r["feature_value"] for r in top] == ["A", "B"]
    holes = df.withColumn("cat", F.nullif("cat", F.lit("A")))
    filled = plans.analyze_target_by_feature(holes, "target", "cat", handle_nulls="fill").collect()
    assert {r["feature_value"] for r in filled} == {"_NULL_", "B", "C"}
    with pytest.raises(TypeError):
        plans.analyze_target_by_feature(df, "cat", "num")


def test_histogram_and_report(frame, tmp_path):
    df = frame("y double, c string", y=[0., 1., 2., 3., 4., None], c=list("aabbbb"))
    rows = plans.target_histogram(df, "y", 4).orderBy("bin").collect()
    assert [r["rows"] for r in rows] == [1, 1, 1, 2] and sum(r["density"] for r in rows) == approx(1.0)
    tables = plans.profile_tables(df, "y")
    assert set(tables) == {"summary", "target_distribution", "by_c"}
    assert len(save_profile(tables, str(tmp_path))) == 3


def test_score_tables(frame):
    scores = frame("model string, fold int, score double", model=["a", "a", "b", "b"], fold=[0, 1, 0, 1], score=[1., 3., 4., 4.])
    rows = {r["model"]: r for r in plans.fold_score_summary(scores).collect()}
    assert (rows["a"]["mean"], rows["a"]["std"], rows["a"]["is_best"], rows["b"]["is_best"]) == (2, 1, True, False)
    table = frame("y double, b double, a double", y=[1., 2.], b=[1., 4.], a=[1., 3.])
    row = plans.transform_impact(table, "y", "b", "a", "rmse").first()
    assert row["changed"] == 1 and row["changed_pct"] == 50 and row["score_delta"] == approx(math.sqrt(2) - math.sqrt(.5))
    parts = frame("feature string, importance double", feature=["x", "x", "z"], importance=[1., 3., 5.])
    assert [r["feature"] for r in plans.importance_summary(parts).collect()] == ["z", "x"]


# --- training -------------------------------------------------------------


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(120, 3))
    y = 3 * x[:, 0] - 2 * x[:, 1] + 0.1 * rng.normal(size=120) + 7
    rows = [(i, i % 3, float(a), float(b), float(c), float(t), int(t > 7), int(i % 3 + (a > 0)) % 3)
            for i, ((a, b, c), t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(
        rows, "id bigint, fold int, a double, b double, c double, y double, flag int, kind int").coalesce(1).cache()
    return df, x, y


def closed_form(x, y, alpha):
    mx, my = x.mean(0), y.mean()
    w = np.linalg.solve((x - mx).T @ (x - mx) + alpha * np.eye(x.shape[1]), (x - mx).T @ (y - my))
    return w, my - mx @ w


def oof_ridge(x, y, alpha):
    out = np.zeros(len(y))
    fold = np.arange(len(y)) % 3
    for k in range(3):
        w, b = closed_form(x[fold != k], y[fold != k], alpha)
        out[fold == k] = x[fold == k] @ w + b
    return out


def test_ridge_equals_closed_form(points):
    df, x, y = points
    result = plans.train_and_cv(df, "y", ["a", "b", "c"], "ridge", "id", model_params={"alpha": 4.0})
    assert values(result.oof, "id", "prediction") == approx(list(oof_ridge(x, y, 4.0)), abs=1e-6)
    want = math.sqrt(np.mean((oof_ridge(x, y, 4.0) - y) ** 2))
    assert result.pooled_score("rmse") == approx(want)
    products = fold_products(df, "y", ["a", "b", "c"], "fold")
    assert products.scores({"all": ["a", "b", "c"]}, 4.0, "rmse")["all"] == approx(want)
    assert result.fold_scores("rmse").count() == 3


def test_rows_without_fold_get_nan(points):
    df, _, _ = points
    part = df.withColumn("fold", F.when(F.col("id") >= 60, F.col("fold")))
    result = plans.train_and_cv(part, "y", ["a"], "ridge", "id")
    got = values(result.oof, "id", "prediction")
    assert len(got) == 120 and all(math.isnan(v) for v in got[:60]) and not any(math.isnan(v) for v in got[60:])


def test_test_rows_are_averaged(points):
    df, _, _ = points
    test = df.select("id", "a", "b").limit(10)
    result = plans.train_and_cv(df, "y", ["a", "b"], "ridge", "id", test=test)
    each = [values(m.predict(test, "id"), "id", "prediction") for m in result.models]
    assert values(result.test, "id", "prediction") == approx(list(np.mean(each, axis=0)))


def test_learners_run(points):
    df, _, _ = points
    trees = {"n_estimators": 3, "max_depth": 3, "random_state": 1}
    cases = [("lgbm", "y", trees), ("xgb", "flag", {**trees, "objective": "binary:logistic"}), ("rf_reg", "y", trees),
             ("rf", "flag", trees), ("logreg", "flag", {}), ("lasso", "y", {"alpha": .01}), ("knn", "flag", {"n_neighbors": 3}),
             ("knn_reg", "y", {}), ("mlp", "flag", {"hidden_sizes": [4], "epochs": 30})]
    for kind, target, params in cases:
        result = plans.train_and_cv(df, target, ["a", "b", "c"], kind, "id", model_params=params)
        if target == "flag":
            assert result.pooled_score("roc_auc") > 0.7, kind
        else:
            assert result.pooled_score("rmse") < 4, kind
    many = plans.train_and_cv(df, "kind", ["a", "b", "c"], "rf", "id", model_params=trees)
    assert all(len(p) == 3 and abs(sum(p) - 1) < 1e-9 for p in values(many.oof, "id", "prediction"))
    boosted = plans.train_and_cv(df, "kind", ["a", "b", "c"], "lgbm", "id", model_params={**trees, "objective": "multiclass"})
    assert all(len(p) == 3 and abs(sum(p) - 1) < 1e-9 for p in values(boosted.oof, "id", "prediction"))


def test_single_fold_and_checks(points):
    df, _, _ = points
    train, valid = df.filter("fold <> 0"), df.filter("fold = 0")
    result = plans.train_single_fold(train, valid, df, "y", ["a", "b"], "lgbm", "id", {"n_estimators": 4},
                                     {"early_stopping_rounds": 2})
    assert result.valid.count() == 40 and result.test.count() == 120
    coded = plans.train_single_fold(train, valid, None, "y", ["a", "kind"], "rf_reg", "id", {"n_estimators": 2}, cat_features=["kind"])
    assert coded.test is None and coded.valid.count() == 40
    with pytest.raises(ValueError):
        plans.train_single_fold(train, valid, None, "y", ["a"], "svm", "id")
    with pytest.raises(ValueError):
        plans.train_single_fold(train, valid, None, "y", ["absent"], "ridge", "id")
    with pytest.raises(ValueError):
        plans.train_and_cv(df.filter("fold > 9"), "y", ["a"], "ridge", "id")


def test_compare_models(points):
    df, _, _ = points
    models = {"good": ("ridge", {"alpha": .1}), "poor": ("ridge", {"alpha": 1e6})}
    results, scores, best = plans.compare_models(df, "y", ["a", "b"], models, "id")
    assert best == "good" and scores.count() == 6 and set(results) == set(models)


def test_selection(points):
    df, x, y = points
    args = dict(model_type="ridge", row_id="id", metric="rmse", model_params={"alpha": 1.0})
    assert plans.select_features_forward(df, "y", ["c", "b", "a"], min_improvement=.05, **args) == ["a", "b"]
    assert plans.select_features_backward(df, "y", ["a", "b", "c"], min_features=1, **args) == ["a"]
    assert set(plans.select_features_backward(df, "y", ["a", "b", "c"], score_threshold=.5, **args)) == {"a", "b"}
    found = plans.calculate_loo_feature_importance(df, "y", ["a", "b", "c"], **args)
    assert list(found)[:2] == ["a", "b"]
    score = lambda cols: math.sqrt(np.mean((oof_ridge(x[:, cols], y, 1.0) - y) ** 2))
    assert found["a"] == approx(score([1, 2]) - score([0, 1, 2]))
    assert plans.calculate_loo_feature_importance(df, "y", ["a"], **args) == {"a": 0.0}
    assert plans.calculate_loo_feature_importance(df, "y", ["absent"], **args) == {}
    slow = plans.evaluate_features_cv(df, "y", ["a"], "ridge", "id", "rmse", model_params={"alpha": 1.0})
    assert slow == approx(score([0]))
    by_mae = plans.select_features_forward(df, "y", ["c", "a"], "ridge", "id", "mae", min_improvement=.2)
    assert by_mae == ["a"]


@pytest.mark.parametrize("kind, target, metric, params", [
    ("lasso", "y", "rmse", {"alpha": 0.3}), ("lasso", "y", "r2", {"alpha": 0.01}), ("logreg", "flag", "logloss", {"C": 0.5}),
    ("logreg", "flag", "logloss", {"C": 100.0})])
def test_batched_scores_equal_the_learners(points, kind, target, metric, params, monkeypatch):
    """Sums per fold give what training each candidate gives, and the passes do not depend on the candidates."""
    from foldwise.plans import logistic, selection

    df, _, _ = points
    sets = {"one": ["a"], "two": ["a", "c"], "all": ["a", "b", "c"]}
    score = selection._scorer(df, target, ["a", "b", "c"], kind, "id", metric, "fold", params, {})
    passes, sums = [], logistic.LogisticRows._sums
    monkeypatch.setattr(logistic.LogisticRows, "_sums", lambda self, w, p: passes.append(len(w)) or sums(self, w, p))
    got = score(sets)
    many = len(passes)
    for name, chosen in sets.items():
        slow = plans.evaluate_features_cv(df, target, chosen, kind, "id", metric, model_params=params)
        assert got[name] == approx(slow, rel=2e-3)
        del passes[:]
        assert score({name: chosen})[name] == approx(got[name]) and len(passes) <= many
    if kind == "logreg":
        assert many < 30
    order = plans.select_features_forward(df, target, ["c", "b", "a"], kind, "id", metric, model_params=params, min_improvement=0.01)
    assert order[0] == "a"


def test_stacking(points):
    df, _, _ = points
    train, test = df.filter("id < 90"), df.filter("id >= 90")
    oof, held = {}, {}
    for f in ("a", "b"):
        result = plans.train_and_cv(train, "y", [f], "ridge", "id", test=test)
        oof[f], held[f] = result.oof, result.test
    wide = [plans.widen_predictions(op.stack_predictions(p, "id", "prediction"), "id", ["a", "b"]) for p in (oof, held)]
    predictions, _ = plans.train_stacking_meta_model(wide[0], train, wide[1], "id", "y")
    assert predictions.count() == 30
    with pytest.raises(ValueError):
        plans.train_stacking_meta_model(wide[0], train, wide[1].drop("b"), "id", "y")
    with pytest.raises(ValueError):
        plans.train_stacking_meta_model(wide[0], train.limit(5), wide[1], "id", "y")


def test_neighbours_equal_brute_force(points):
    df, x, _ = points
    for block in (8192, 17):
        found = plans.nearest_neighbours(df, df, "id", ["a", "b", "c"], 4, exclude_self=True, block_rows=block)
        got = {}
        for r in found.orderBy("query_id", "rank").collect():
            got.setdefault(r["query_id"], []).append(r["point_id"])
        d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)
        np.fill_diagonal(d, np.inf)
        assert got == {i: list(np.argsort(d[i], kind="stable")[:4]) for i in range(120)}


def test_far_cells_are_not_read(spark, monkeypatch):
    """On clustered points few pairs of cells meet, and the result is that of all pairs."""
    from foldwise.plans import knn

    monkeypatch.setattr(knn, "CELL_ROWS", 20)
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=(60, 3)) + 40 * rng.integers(0, 6, 3) for _ in range(20)]).round(2)
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "id int, a double, b double, c double").repartition(3)
    plans_made, plan = [], knn.plan_cells
    monkeypatch.setattr(knn, "plan_cells", lambda *a: plans_made.append(plan(*a)) or plans_made[-1])
    for block in (8192, 13):
        found = plans.nearest_neighbours(df, df.filter("id % 3 = 0"), "id", ["a", "b", "c"], 4, block_rows=block).collect()
        d = ((x[::3, None, :] - x[None]) ** 2).sum(-1)
        want = {3 * i: list(np.argsort(row, kind="stable")[:4]) for i, row in enumerate(d)}
        got = {}
        for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
            got.setdefault(r["query_id"], []).append(r["point_id"])
        assert got == want
        assert plans_made[-1].compared < 0.3 * len(d) * len(x)
    assert plans.nearest_neighbours(df.limit(0), df, "id", ["a"], 2).count() == 0


def test_neighbours_with_copies(frame):
    df = frame("id int, v double", id=range(30), v=[1.0] * 25 + [2., 3., 4., 5., 6.])
    found = plans.nearest_neighbours(df, df.filter("id >= 25"), "id", ["v"], 2, block_rows=7)
    rows = {(r["query_id"], r["rank"]): r["point_id"] for r in found.collect()}
    assert rows[(25, 1)] == 25 and rows[(25, 2)] == 0


# --- workflow -------------------------------------------------------------


def test_feature_plan(spark):
    base = spark.range(60).select(
        F.col("id"), F.concat(F.lit("Item "), (F.col("id") % 5).cast("string")).alias("title"),
        F.when(F.col("id") % 2 == 0, "day").otherwise("night").alias("time"),
        (F.col("id") % 7 * 20).cast("string").alias("length"), (F.col("id") % 4).cast("double").alias("y"))
    train = base.filter("id < 40").withColumn("fold", (F.col("id") % 3).cast("int"))
    test = base.filter("id >= 50").drop("y")
    plan = plans.FeaturePlan(
        row_id="id", target="y", numeric=["length"], categorical=["time"], bounds={"length": (10, 100)},
        replace={"length": (90, 0)}, maps={"time": {"day": 1, "night": 2}}, prefixes={"title": "Item "},
        median_fill=["length"], powers=["length"],
        groups=[{"groupby_cols": ["time"], "agg_col": "length", "agg_func": "mean", "new_col_name": "time_length"}],
        nway_features=["title", "time"], nway_orders=[2])
    a, b, features = plans.build_features(train, test, plan, "fold", external=base.filter("id between 40 and 49"))
    assert a.count() == 40 and b.count() == 10
    assert set(features) <= set(a.columns) and set(features) <= set(b.columns) and "y" not in b.columns
    assert "title_time_inter2_label_te" in features
    assert not any(f.startswith("y") or f == "fold" for f in features)
    result = plans.train_and_cv(a, "y", features, "rf_reg", "id", test=b, model_params={"n_estimators": 2})
    assert result.test.count() == 10


def test_transformed_target(points):
    df, _, _ = points
    rows = df.withColumn("y", F.exp(F.col("y") / 10)).withColumn("w", F.lit(2.0))
    log = op.fit_target_transform(rows, "y", "log1p")
    result = plans.train_and_cv(rows, "y", ["a", "b"], "ridge", "id", test=rows, target_transform=log, normalize_by="w")
    assert result.pooled_score("rmse") < 0.2
    other = plans.train_and_cv(rows, "y", ["a", "b"], "ridge", "id", test=rows, target_transform=log, normalize_by="w",
                               average_on="transformed")
    a, b = values(result.test, "id", "prediction"), values(other.test, "id", "prediction")
    assert a == approx(b, rel=.05) and a != b


def test_boosting_takes_its_loss_and_rounds_from_the_settings(spark):
    rows = [(i, i % 2, float(i % 2) + (1000.0 if i % 10 == 0 else 0.0)) for i in range(40)]
    df = spark.createDataFrame(rows, "id bigint, a int, y double")
    small = {"n_estimators": 3, "max_depth": 1, "boosting_type": "gbdt"}
    fitted = {o: plans.train_single_fold(df, df, None, "y", ["a"], "lgbm", "id", {**small, "objective": o}, {"early_stopping_rounds": 1})
              for o in ("regression_l1", "regression")}
    assert {o: f.model.model.settings.loss for o, f in fitted.items()} == {"regression_l1": "absolute", "regression": "squared"}
    for bad in ({"objective": "quantile"}, {"boosting_type": "dart"}):
        with pytest.raises(ValueError, match="without a counterpart"):
            plans.train_single_fold(df, df, None, "y", ["a"], "lgbm", "id", {**small, **bad})
    rounds = {name: settings_of(plans.MODELS[name].family, {}).rounds for name in ("xgb", "xgboost", "lgbm")}
    assert rounds == {"xgb": 1000, "xgboost": 1000, "lgbm": 100}
    assert settings_of("xgb", {"n_estimators": 7}).rounds == 7 and settings_of("xgb", {"n_estimators": 7}, 5).rounds == 5


def test_rows_are_sent_a_bounded_number_of_times(spark, monkeypatch):
    """Where no cell is ruled out, cells of queries are read for together: rows are sent per block, not per cell."""
    from foldwise.plans import knn

    monkeypatch.setattr(knn, "CELL_ROWS", 10)
    monkeypatch.setattr(knn, "BLOCK_ROWS", 8)
    x = np.random.default_rng(8).normal(size=(600, 24)).astype(np.float32)
    schema = "id int, v array<float>"
    plans_made, plan = [], knn.plan_cells
    monkeypatch.setattr(knn, "plan_cells", lambda *a: plans_made.append(plan(*a)) or plans_made[-1])
    for n in (300, 600):
        df = spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(x[:n])], schema).repartition(3)
        found = plans.nearest_neighbours(df, df, "id", ["v"], 3, exclude_self=True).collect()
        d = ((x[:n, None, :].astype(float) - x[None, :n].astype(float)) ** 2).sum(-1)
        np.fill_diagonal(d, np.inf)
        got = {(r["query_id"], r["rank"]): r["point_id"] for r in found}
        assert got == {(i, k + 1): int(j) for i in range(n) for k, j in enumerate(np.argsort(d[i], kind="stable")[:3])}
        made = plans_made[-1]
        assert len({number for _, number, _, _ in made.queries}) <= 2 * knn.GRID
        assert max(groups for *_, groups in made.queries) <= 2 * knn.GRID

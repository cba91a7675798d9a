import math

import pytest
from pyspark.sql import functions as F

from foldwise import functions as fn
from foldwise import operators as op
from tests.conftest import values

approx = pytest.approx


# --- missing values and scaling -------------------------------------------


@pytest.fixture
def holes(frame):
    return frame("id int, num1 double, num2 double, cat1 string, cat2 string, full bigint, flag boolean",
                 id=range(5), num1=[1., 2., None, 4., 5.], num2=[10., None, 30., None, 60.],
                 cat1=["A", "B", "A", None, "A"], cat2=["x", None, "y", "y", None], full=[1, 2, 3, 4, 5],
                 flag=[True, False, None, True, False])


def check_impute(holes):
    mean = op.handle_missing_values(holes, "mean")
    assert values(mean, "id", "num1")[2] == approx(3.0) and values(mean, "id", "num2")[1] == approx(100 / 3)
    assert values(mean, "id", "cat1")[3] is None and values(mean, "id", "flag")[2] is None
    assert mean.schema["full"].dataType.simpleString() == "bigint"
    median = op.handle_missing_values(holes, "median", ["num1", "num2"])
    assert values(median, "id", "num1")[2] == 3.0 and values(median, "id", "num2")[3] == 30.0
    mode = op.handle_missing_values(holes, "mode")
    assert values(mode, "id", "cat1")[3] == "A" and values(mode, "id", "cat2")[1] == "y"
    assert values(mode, "id", "num1")[2] is None
    assert values(mode, "id", "flag")[2] is False
    zero = op.handle_missing_values(holes, "zero")
    assert values(zero, "id", "num1")[2] == 0.0 and values(zero, "id", "flag")[2] is None
    literal = op.handle_missing_values(holes, "literal", ["cat1"], "missing")
    assert values(literal, "id", "cat1")[3] == "missing"


def test_impute(holes):
    check_impute(holes)


def test_impute_on_large_routes(holes, big_data_routes):
    check_impute(holes)


def test_impute_checks(holes):
    with pytest.raises(TypeError):
        op.handle_missing_values(holes, "mean", ["cat1"])
    with pytest.raises(TypeError):
        op.handle_missing_values(holes, "mode", ["num1"])
    with pytest.raises(ValueError):
        op.handle_missing_values(holes, "literal")
    with pytest.raises(ValueError):
        op.handle_missing_values(holes, "best")


def test_scalers(frame):
    train = frame("id int, a double, b double, c double", id=range(5), a=[1., 2., 3., 4., 5.],
                  b=[10., 20., 30., None, 50.], c=[7.] * 5)
    test = frame("id int, a double, b double, c double", id=[0], a=[6.], b=[None], c=[8.])
    a, b, model = op.scale_numerical_features(train, ["a", "b", "c"], test)
    assert values(a, "id", "a") == approx([(v - 3) / math.sqrt(2) for v in range(1, 6)])
    assert values(a, "id", "c") == [0.0] * 5 and values(b, "id", "c") == [1.0]
    assert values(a, "id", "b")[3] is None and values(b, "id", "b") == [None]
    a, _, _ = op.scale_numerical_features(train, ["a", "c"], scaler_type="minmax", feature_range=(1, 3))
    assert values(a, "id", "a") == approx([1, 1.5, 2, 2.5, 3]) and values(a, "id", "c") == [1.0] * 5
    a, _, _ = op.scale_numerical_features(train, ["a"], scaler_type="robust")
    assert values(a, "id", "a") == approx([-1, -.5, 0, .5, 1])
    with pytest.raises(ValueError):
        op.scale_numerical_features(train.limit(0), ["a"])
    with pytest.raises(ValueError):
        op.scale_numerical_features(train, ["a"], scaler_type="max")
    one, _, _ = op.scale_numerical_features(train.limit(1), ["a"])
    assert values(one, "id", "a") == [0.0]


# --- projections ----------------------------------------------------------


def test_scalar_functions(frame):
    df = frame("id int, x double, s string, n bigint", id=range(4), x=[-25., 25., None, 4.], s=["Episode 12", "7", None, "8"],
               n=[-3, 5, None, 2])
    out = fn.clip_numerical_features(df, {"n": (-1, 3), "x": (None, 10)})
    assert values(out, "id", "n") == [-1, 3, None, 2] and out.schema["n"].dataType.simpleString() == "bigint"
    assert values(out, "id", "x") == [-25., 10., None, 4.]
    assert fn.clip_numerical_features(df, {}) is df
    with pytest.raises(TypeError):
        fn.clip_numerical_features(df, {"s": (0, 1)})
    out = df.select("id", fn.strip_prefix(F.col("s"), "Episode ").alias("e"), fn.bin_floor_text(F.col("x")).alias("f"),
                             fn.bin_trunc_text(F.col("x")).alias("t"))
    assert values(out, "id", "e") == [12, 7, None, 8]
    assert values(out, "id", "f") == ["-30.0", "20.0", None, "0.0"] and values(out, "id", "t") == ["-20", "20", None, "0"]
    out = df.select("id", fn.soft_clip(F.col("x"), 10.0, low=0.0).alias("y"))
    assert values(out, "id", "y") == [0.0, approx(10 + math.log1p(15)), None, 4.0]


def test_coerce_and_compact(frame):
    df = frame("id bigint, s string, low string, big bigint, x double, huge double, hole int", id=range(4),
               s=["1.5", "no", None, "2"], low=["a", "a", "a", "a"], big=[0, 40000, 1, 2], x=[.5, 1., 2., 3.],
               huge=[1e300, 1., 2., 3.], hole=[1, None, 3, 4])
    assert values(op.coerce_schema(df, ["s", "absent"]), "id", "s") == [1.5, None, None, 2.0]
    plan = op.compact_schema(df)
    assert plan.casts == {"id": "tinyint", "big": "int", "x": "float"} and "low" in plan.low_cardinality
    assert plan.transform(df).schema["hole"].dataType.simpleString() == "int"


def test_target_checks(frame):
    df = frame("id int, y double", id=[0, 1, 2], y=[1.0, None, float("nan")])
    assert op.drop_null_target(df, "y").count() == 1
    row = op.check_values(df, ["y"]).first()
    assert (row["rows"], row["non_null"], row["nan"], row["infinite"]) == (3, 2, 1, 0)
    with pytest.raises(ValueError):
        op.require_target(df.filter("id > 0"), "y")


# --- crosses --------------------------------------------------------------


def test_products(frame):
    df = frame("A smallint, B smallint, C smallint, D string", A=[1, 2, 3], B=[4, 5, 6], C=[-1, 0, 1], D=["x", "y", "z"])
    out = op.create_interaction_features(df, [("B", "A"), ("A", "C"), ("A", "B")])
    assert out.columns == ["A_x_B", "A_x_C"]
    assert [tuple(r) for r in out.orderBy("A_x_B").collect()] == [(4, -1), (10, 0), (18, 3)]
    assert out.schema["A_x_B"].dataType.simpleString() == "int"
    with pytest.raises(TypeError):
        op.create_interaction_features(df, [("A", "D")])
    with pytest.raises(ValueError):
        op.create_interaction_features(df, [("A", "B")], target="B")
    assert op.add_feature_cross_terms(df, ["A", "B", "C"]).columns[-3:] == ["A_x_B", "A_x_C", "B_x_C"]
    out, names = op.create_n_way_multiplication_features(df, ["A", "B", "C", "gone"], [2, 3, 7])
    assert names == ["A_x_B", "A_x_C", "B_x_C", "A_x_B_x_C"]


def test_polynomial(frame):
    df = frame("A bigint, B bigint", A=[1], B=[4])
    out = op.create_polynomial_features(df, ["A", "B"])
    assert out.columns == ["poly_A", "poly_B", "poly_A^2", "poly_A B", "poly_B^2"]
    assert list(out.first()) == [1, 4, 1, 4, 16]
    out = op.create_polynomial_features(df, ["A", "B"], 2, interaction_only=True, include_bias=True)
    assert out.columns == ["poly_1", "poly_A", "poly_B", "poly_A B"]


def test_guarded_crosses(frame):
    df = frame("id int, a double, b double", id=range(5), a=[6., 6., None, 6., -8.], b=[2., 0., 2., None, .5])
    pair = lambda op_, **kw: {"features": ("a", "b"), "operation": op_, **kw}
    get = lambda spec, name: values(op.create_enhanced_interaction_features(df, [spec], keep=["id"]), "id", name)
    assert get(pair("divide"), "a_div_b") == [3, None, None, None, -16]
    assert get(pair("divide", fill_value=-1.0), "a_div_b") == [3, -1, None, -1, -16]
    assert get(pair("power"), "a_pow_b") == [36, 1, None, None, None]
    assert get(pair("power", fill_value=0.0), "a_pow_b")[4] == 0.0
    assert get(pair("multiply"), "a_mul_b") == [12, 0, None, None, -4]
    with pytest.raises(ValueError):
        get(pair("modulo"), "x")


@pytest.fixture
def nway(frame):
    return frame("id int, cat1 string, cat2 string, num1 bigint", id=range(6), cat1=["A", "B", "A", "B", None, "A"],
                 cat2=["X", "X", "Y", "Y", "X", "Y"], num1=[1, 2, 3, 4, 5, 6])


def check_nway(nway):
    build = lambda **kw: op.create_nway_interaction_features(nway, ["cat1", "cat2"], [2], keep=["id"], **kw)
    assert values(build(), "id", "cat1_cat2_inter2") == ["A_X", "B_X", "A_Y", "B_Y", "null_str_X", "A_Y"]
    assert values(build(handle_nulls="propagate"), "id", "cat1_cat2_inter2")[4] is None
    assert values(build(encode_type="count"), "id", "cat1_cat2_inter2_count") == [1, 1, 2, 1, 1, 2]
    assert values(build(encode_type="label"), "id", "cat1_cat2_inter2_label") == [0, 2, 1, 3, 4, 1]
    got = values(build(encode_type="label", add_one=True, handle_nulls="propagate"), "id", "cat1_cat2_inter2_label")
    assert got == [1, 3, 2, 4, None, 2]
    wide = op.create_nway_interaction_features(nway, ["cat1", "cat2", "num1"], [2, 3], encode_type="label", keep=["id"], row_id="id")
    assert len(wide.columns) == 5
    assert values(wide, "id", "cat1_cat2_inter2_label") == [0, 2, 1, 3, 4, 1]
    assert values(wide, "id", "cat1_num1_inter2_label") == [0, 3, 1, 4, 5, 2]


def test_nway(nway):
    check_nway(nway)


def test_nway_on_large_routes(nway, big_data_routes):
    check_nway(nway)


# --- group features -------------------------------------------------------


def check_groups(frame):
    df = frame("id int, g string, h bigint, v bigint", id=range(8), g=["A", "B", "A", "C", "B", "A", "C", None],
               h=[1, 1, 1, 2, 2, 2, 1, 1], v=[10, 20, 12, 30, 22, None, 33, 40])
    config = lambda f: {"groupby_cols": ["g"], "agg_col": "v", "agg_func": f, "new_col_name": f}
    names = ["mean", "std", "min", "max", "count", "size", "nunique", "sum", "median"]
    out = op.create_aggregation_features(df, [config(n) for n in names])
    first = {r["id"]: r for r in out.collect()}
    a = first[0]
    assert (a["mean"], a["min"], a["max"], a["count"], a["size"], a["nunique"], a["sum"], a["median"]) == (
        11, 10, 12, 2, 3, 3, 22, 11)
    assert a["std"] == approx(math.sqrt(2))
    assert all(first[7][n] is None for n in names)
    assert values(op.create_aggregation_features(df, [config("mean")]), "id", "mean") == [11, 21, 11, 31.5, 21, 11, 31.5, None]
    both = {"groupby_cols": ["g", "h"], "agg_col": "v", "agg_func": "sum", "new_col_name": "gh"}
    assert values(op.create_aggregation_features(df, [both]), "id", "gh") == [22, 20, 22, 30, 22, 0, 33, None]
    with pytest.raises(ValueError):
        op.create_aggregation_features(df, [config("mode")])
    with pytest.raises(ValueError):
        op.create_aggregation_features(df, [])
    with pytest.raises(ValueError):
        op.create_aggregation_features(df, [{"groupby_cols": ["g"]}])


def test_groups(frame):
    check_groups(frame)


def test_groups_on_large_routes(frame, big_data_routes):
    check_groups(frame)


# --- folds and samples ----------------------------------------------------


def check_folds(spark):
    df = spark.range(103).select(F.col("id"), (F.col("id") % 7 < 2).cast("int").alias("y"), (F.col("id") % 11).alias("g"))
    count = lambda d: {r["fold"]: r["count"] for r in d.groupBy("fold").count().collect()}
    assert sorted(count(op.kfold(df, "id", 4, 1, exact=True)).values()) == [25, 26, 26, 26]
    assert sum(count(op.kfold(df, "id", 4, 1)).values()) == 103
    flat = op.contiguous_kfold(df, "id", 4)
    assert count(flat) == {0: 26, 1: 26, 2: 26, 3: 25}
    assert flat.filter("fold = 0").agg(F.max("id")).first()[0] == 25
    text = op.contiguous_kfold(df.select(F.lpad(F.col("id").cast("string"), 4, "0").alias("k")), "k", 4)
    assert count(text) == {0: 26, 1: 26, 2: 26, 3: 25}
    strat = op.stratified_kfold(df, "id", "y", 4)
    by_class = strat.groupBy("y", "fold").count().groupBy("y").agg((F.max("count") - F.min("count")).alias("d"))
    assert all(r["d"] <= 1 for r in by_class.collect()) and strat.count() == 103
    grouped = op.group_kfold(df, "g", 3)
    assert grouped.groupBy("g").agg(F.count_distinct("fold").alias("n")).filter("n > 1").isEmpty()
    assert len(count(grouped)) == 3
    seen = 0
    for k, train, valid in op.fold_pairs(strat, "fold"):
        assert train.join(valid, "id").isEmpty() and train.count() + valid.count() == 103
        seen += valid.count()
    assert seen == 103
    with pytest.raises(ValueError):
        op.stratified_kfold(df, "id", None)
    with pytest.raises(ValueError):
        op.group_kfold(df, None)
    with pytest.raises(ValueError):
        op.assign_folds(df, "id", "random")


def test_folds(spark):
    check_folds(spark)


def test_folds_on_large_routes(spark, big_data_routes):
    check_folds(spark)


def test_group_folds_are_balanced(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") < 300, F.lit(0)).otherwise(F.col("id") % 40 + 1).alias("g"))
    sizes = [r["count"] for r in op.group_kfold(df, "g", 3).groupBy("fold").count().collect()]
    assert max(sizes) - min(sizes) <= 40


def check_samples(spark):
    df = spark.range(50).select("id", (F.col("id") * 2).alias("v"))
    a = op.sample_dataframe(df, "id", n=10, seed=3)
    assert a.count() == 10 == a.distinct().count()
    assert values(a, "id", "id") == values(op.sample_dataframe(df.repartition(7), "id", n=10, seed=3), "id", "id")
    assert values(a, "id", "id") != values(op.sample_dataframe(df, "id", n=10, seed=4), "id", "id")
    assert op.sample_dataframe(df, "id", frac=0.35).count() == 17
    assert op.sample_dataframe(df, "id", n=0).count() == 0 and op.sample_dataframe(df, "id", n=50).count() == 50
    assert values(op.sample_dataframe(df, "id", n=3, shuffle=False), "id", "id") == [0, 1, 2]
    text = df.select(F.lpad(F.col("id").cast("string"), 3, "0").alias("k"))
    assert values(op.head_rows(text, "k", 2), "k", "k") == ["000", "001"]
    for bad in (dict(), dict(n=1, frac=.1), dict(frac=1.5), dict(n=-1), dict(n=51)):
        with pytest.raises(ValueError):
            op.sample_dataframe(df, "id", **bad)


def test_samples(spark):
    check_samples(spark)


def test_samples_on_large_routes(spark, big_data_routes):
    check_samples(spark)


def test_union_and_dedup(frame):
    a = frame("id int, x string, y double", id=[3, 1, 2], x=["p", "p", None], y=[1., 1., 2.])
    b = frame("id int, x string", id=[4, 5], x=["p", "p"])
    both = op.union_splits({"train": a, "test": op.add_missing_target(b, "y")})
    kept = op.drop_duplicates_keep_first(both, ["x", "y"], "id", only_split="train")
    assert values(kept, "id", "id") == [1, 2, 4, 5] and kept.columns == both.columns
    assert op.take_split(both, "test").columns == ["id", "x", "y"]
    assert values(op.with_row_index(a, ["id"]), "id", "row_index") == [0, 1, 2]


# --- target transforms ----------------------------------------------------


def test_round_trips(frame):
    df = frame("id int, y double", id=range(5), y=[1., 2., 5., 10., 20.])
    for method in ("log", "log1p", "standard", "minmax"):
        model = op.fit_target_transform(df, "y", method)
        back = model.reverse(model.transform(df, "y"), "y")
        assert values(back, "id", "y") == approx([1, 2, 5, 10, 20]), method
    with pytest.raises(ValueError):
        op.fit_target_transform(df.withColumn("y", F.col("y") - 1), "y", "log")
    with pytest.raises(ValueError):
        op.reverse_target_transformation(df, "y", "standard")
    flat = frame("id int, y double", id=[0, 1], y=[3., 3.])
    for method in ("standard", "minmax"):
        model = op.fit_target_transform(flat, "y", method)
        assert values(model.transform(flat, "y"), "id", "y") == [0, 0]
        assert values(model.reverse(flat, "y"), "id", "y") == [3, 3]


def test_binned_target(frame):
    train = frame("id int, y double", id=range(4), y=[10., 20., 30., 40.])
    test = frame("id int, y double", id=range(5), y=[5., 15., 25., 35., 45.])
    model = op.fit_target_transform(train, "y", "binning", 2)
    assert model.params["edges"] == [10., 30., 40.]
    assert values(model.transform(test, "y"), "id", "y") == [None, 0, 0, 1, 2]
    back = model.reverse(frame("id int, y double", id=range(4), y=[-1., 0., 1., 7.]), "y")
    assert values(back, "id", "y") == [20, 20, 35, 35]
    a, b, params = op.apply_target_transformation(train, "y", "standard", test)
    assert values(op.reverse_target_transformation(b, "y", "standard", params), "id", "y") == approx([5, 15, 25, 35, 45])
    with pytest.raises(ValueError):
        op.fit_target_transform(train, "y", "binning")
    with pytest.raises(ValueError):
        op.fit_target_transform(train.withColumn("y", F.lit(1.0)), "y", "binning", 3)


def test_normalised_target(frame):
    df = frame("id int, target bigint, feature bigint", id=range(7), target=[10, 20, 30, 40, 50, None, 60],
               feature=[2, 4, 5, 50, 0, 3, None])
    out = op.normalize_target_by_feature(df, "target", "feature", out="t")
    assert values(out, "id", "t") == [5, 5, 6, .8, 0, None, None]
    out = op.normalize_target_by_feature(df, "target", "feature", fill_value_on_error=-1, out="t")
    assert values(out, "id", "t")[4] == -1
    out = op.normalize_target_by_feature(df, "target", "feature", "subtract", out="t")
    assert values(out, "id", "t") == [8, 16, 25, -10, 50, None, None]
    back = op.denormalize_predictions_by_feature(out, "t", "feature", "subtract", "p")
    assert values(back, "id", "p") == [10, 20, 30, 40, 50, None, None]
    with pytest.raises(ValueError):
        op.normalize_target_by_feature(df, "target", "feature", "modulo")


# --- metrics and blends ---------------------------------------------------


def test_metrics(frame):
    df = frame("y int, p int, s double", y=[0, 1, 0, 1, 0, 1, 0], p=[0, 0, 1, 1, 1, 0, 0], s=[.1, .4, .6, .8, .7, .3, .2])
    row = op.evaluate(df, "y", "p", ["Accuracy", "precision", "recall", "f1", "balanced_accuracy"]).first()
    assert row["accuracy"] == approx(3 / 7)
    assert (row["precision"], row["recall"], row["f1"]) == approx((1 / 3, 1 / 3, 1 / 3))
    assert row["balanced_accuracy"] == approx((1 / 3 + 1 / 2) / 2)
    assert op.calculate_metric(df, "y", "s", "AUC") == approx(8 / 12)
    want = -sum(math.log(s if y else 1 - s) for y, s in zip([0, 1, 0, 1, 0, 1, 0], [.1, .4, .6, .8, .7, .3, .2])) / 7
    assert op.calculate_metric(df, "y", "s", "logloss") == approx(want)
    both = op.evaluate(df, "y", "s", ["rmse", "roc_auc"]).first()
    assert both["roc_auc"] == approx(8 / 12)
    with pytest.raises(ValueError):
        op.evaluate(df, "y", "p", ["kappa"])


def test_auc_on_large_routes(frame, big_data_routes):
    df = frame("y int, s double", y=[0, 1, 0, 1, 0, 1, 0, 1], s=[.1, .4, .6, .8, .7, .3, .3, .3])
    pairs = [(a, b) for a in (.4, .8, .3, .3) for b in (.1, .6, .7, .3)]
    want = sum(1.0 if a > b else .5 if a == b else 0 for a, b in pairs) / len(pairs)
    assert op.calculate_metric(df, "y", "s", "roc_auc") == approx(want)


def test_regression_metrics(frame):
    df = frame("y double, p double", y=[1., 2., 3., 4.], p=[1., 3., 2., 5.])
    row = op.evaluate(df, "y", "p", ["mse", "rmse", "mae", "mape", "r2", "msle", "rmsle"]).first()
    assert (row["mse"], row["mae"], row["r2"]) == approx((.75, .75, 1 - 3 / 5))
    assert row["mape"] == approx((.5 + 1 / 3 + .25) / 4)
    bad = frame("y double, p double", y=[1.], p=[-2.])
    with pytest.raises(Exception):
        op.calculate_metric(bad, "y", "p", "rmsle")
    constant = frame("y double, p double", y=[2., 2.], p=[2., 2.])
    assert op.calculate_metric(constant, "y", "p", "r2") == 1.0


def test_multiclass(frame):
    df = frame("y int, p int, q array<double>", y=[0, 1, 2, 0, 1, 2], p=[0, 2, 1, 0, 0, 1],
               q=[[.8, .1, .1], [.2, .5, .3], [.1, .3, .6], [.6, .2, .2], [.3, .4, .3], [.2, .2, .6]])
    assert op.calculate_metric(df, "y", "p", "f1", average="macro") == approx((4 / 5 + 0 + 0) / 3)
    assert op.calculate_metric(df, "y", "p", "f1", average="micro") == approx(2 / 6)
    want = -sum(map(math.log, (.8, .5, .6, .6, .4, .6))) / 6
    assert op.calculate_metric(df, "y", "q", "logloss") == approx(want)


def test_blends(frame):
    one = lambda *v: frame("id int, p double", id=range(len(v)), p=list(v))
    long = op.stack_predictions({"a": one(1., 2., 3.), "b": one(5., 6., 7.)}, "id", "p")
    assert values(op.average_predictions(long, "id", ["a", "b"]), "id", "prediction") == [3, 4, 5]
    assert values(op.weighted_blend(long, "id", {"a": 3, "b": 1}), "id", "prediction") == [2, 3, 4]
    short = op.stack_predictions({"a": one(1., 2., 3.), "b": one(5., 6.)}, "id", "p")
    with pytest.raises(Exception, match="exactly one prediction"):
        op.average_predictions(short, "id", ["a", "b"]).collect()
    with pytest.raises(ValueError):
        op.weighted_blend(long, "id", {})
    assert op.usable_models({"a": one(1., 2., 3.), "b": one(5., 6.)}, one(0., 0., 0.), "id") == ["a"]
    arrays = lambda *v: frame("id int, p array<double>", id=range(len(v)), p=list(v))
    long = op.stack_predictions({"a": arrays([1., 0.]), "b": arrays([0., 1.])}, "id", "p")
    assert values(op.weighted_blend(long, "id", {"a": 3, "b": 1}), "id", "prediction") == [[.75, .25]]


def test_counting_wanted_values_sorts_no_rows(spark, monkeypatch):
    """Rows of a wanted range are counted by hash; only counted values are sorted, also where a range is split again."""
    from foldwise.operators import order_stats

    fitted, plain = [], order_stats.fit_lookup
    monkeypatch.setattr(order_stats, "fit_lookup", lambda df, *a, **k: fitted.append(df) or plain(df, *a, **k))
    monkeypatch.setattr(order_stats, "ROWS_PER_RANGE", 50)
    monkeypatch.setattr(order_stats, "CUT_POINTS", 2)
    rows = spark.range(0, 3000, numPartitions=3).select((F.col("id") * 7 % 601).alias("v"), (F.col("id") % 2).alias("k"))
    quantiles = order_stats.grouped_quantiles(rows, ["k"], "v", [0.0, 0.5, 1.0])
    found = {r["k"]: (r["quantiles"], r["size"]) for r in quantiles.collect()}
    for k in (0, 1):
        own = sorted(i * 7 % 601 for i in range(3000) if i % 2 == k)
        assert found[k] == (approx([own[0], (own[749] + own[750]) / 2, own[-1]]), 1500)
    assert len(fitted) > 1
    for df in (*fitted, quantiles):
        assert "SortAggregate" not in df._jdf.queryExecution().executedPlan().toString()

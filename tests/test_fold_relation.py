"""Folds as rows, encodings and training over them, and ordered target statistics."""

import math
import random

import pytest
from pyspark.sql import functions as F

from foldwise import operators as op
from foldwise import plans
from foldwise.functions.hashing import keyed_hash
from foldwise.operators.order_stats import sums_before


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(2)
    data = [(i, rng.choice(["hot", "hot", "hot", "a", "b", None]), rng.randint(0, 9), None if i % 23 == 0 else rng.uniform(0, 9)) for i in range(400)]
    return spark.createDataFrame(data, "id bigint, c string, d int, y double").repartition(4).cache()


def pairs_of(relation):
    out = {}
    for r in relation.collect():
        assert out.setdefault((r.fold, r.id), r.role) == r.role
    return out


def test_relations(rows):
    folded = op.kfold(rows, "id", 4, seed=1)
    own = {r.id: r.fold for r in folded.collect()}
    found = pairs_of(op.relation_of_folds(folded, "id"))
    assert found == {(k, i): "valid" if own[i] == k else "train" for i in own for k in range(4)}
    repeated = pairs_of(op.repeated_folds(rows, "id", 3, 2, seed=5))
    assert len(repeated) == 6 * 400
    for i in range(400):
        assert [k // 3 for k in range(6) if repeated[k, i] == "valid"] == [0, 1]
    expanding = pairs_of(op.expanding_folds(rows, "id", 3, gap=1, window=1))
    block = lambda i: i // 100
    want = {}
    for k in (1, 2):
        for i in range(400):
            if block(i) == k + 1:
                want[k, i] = "valid"
            elif block(i) == k - 1:
                want[k, i] = "train"
    assert expanding == want
    for bad in ({"gap": 3}, {"window": 0}, {"gap": -1}):
        with pytest.raises(ValueError):
            op.expanding_folds(rows, "id", 3, **bad)


def test_a_row_has_one_role_in_a_fold(spark, rows):
    twice = spark.createDataFrame([(1, 0, "train"), (1, 0, "valid")], "id bigint, fold int, role string")
    other = spark.createDataFrame([(1, 0, "test")], "id bigint, fold int, role string")
    for relation in (twice, other):
        with pytest.raises(ValueError, match="one role"):
            op.fit_relation_target_encoder(rows, ["c"], "y", "id", relation)


def plain_encoding(data, pairs, feature, smoothing=10.0):
    every = [r.y for r in data if r.y is not None]
    out = set()
    for fold in {f for f, _ in pairs}:
        train = [r for r in data if pairs.get((fold, r.id)) == "train"]
        known = [r.y for r in train if r.y is not None]
        prior = sum(known) / len(known) if known else sum(every) / len(every)
        for r in data:
            if pairs.get((fold, r.id)) == "valid":
                own = [t.y for t in train if t.y is not None and r[feature] is not None and t[feature] == r[feature]]
                out.add((r.id, fold, round((sum(own) + smoothing * prior) / (len(own) + smoothing) if own else prior, 8)))
    measured = {i for i, _, _ in out}
    return out | {(r.id, None, None) for r in data if r.id not in measured}


def check_encoding(rows):
    relation = op.folds_of_conditions(rows, "id", [(F.col("id") < 200, F.col("id") >= 150), (F.col("c") == "a", F.col("id") < 300), (F.lit(False), F.col("id") == 7)])
    model = op.fit_relation_target_encoder(rows, ["c", "d"], "y", "id", relation)
    got = model.transform_pairs(rows.withColumn("c_te", F.lit("old")), relation).collect()
    pairs, data = pairs_of(relation), rows.collect()
    for feature in ("c", "d"):
        found = {(r.id, r.fold, None if r[f"{feature}_te"] is None else round(r[f"{feature}_te"], 8)) for r in got}
        assert found == plain_encoding(data, pairs, feature)
    assert len(got) == len({(r.id, r.fold) for r in got})
    test = model.transform(rows.limit(20)).collect()
    known = {c: [r.y for r in data if r.c == c and r.y is not None] for c in ("hot", "a", "b")}
    every = [r.y for r in data if r.y is not None]
    prior = sum(every) / len(every)
    for r in test:
        own = known.get(r.c)
        assert r.c_te == pytest.approx((sum(own) + 10 * prior) / (len(own) + 10) if own else prior)


def test_encoding_over_any_pairs(rows):
    check_encoding(rows)


def test_encoding_over_any_pairs_on_large_routes(rows, big_data_routes):
    check_encoding(rows)


def test_a_fold_column_and_its_relation_train_the_same(rows):
    folded = op.kfold(rows.filter("y is not null"), "id", 3, seed=2)
    args = dict(model_type="ridge", row_id="id", model_params={"alpha": 1.0})
    want = plans.train_and_cv(folded, "y", ["d"], **args)
    got = plans.train_and_cv(folded.drop("fold"), "y", ["d"], relation=op.relation_of_folds(folded, "id"), **args)
    a, b = ({r.id: (r.fold, round(r.prediction, 9)) for r in x.oof.collect()} for x in (want, got))
    assert a == b and want.pairs is None and got.pairs.count() == len(a)
    assert got.pooled_score("rmse") == pytest.approx(want.pooled_score("rmse"))


@pytest.mark.parametrize("kind, params", [("ridge", {"alpha": 1.0}), ("xgb", {"n_estimators": 2, "max_depth": 2})])
def test_training_over_overlapping_folds(rows, kind, params):
    data = rows.filter("y is not null")
    relation = op.folds_of_conditions(data, "id", [(F.col("id") < 300, F.col("id") >= 300), (F.col("id") >= 100, F.col("id").between(50, 99) | (F.col("id") == 350)),
                                                   ])
    relation = relation.filter("not (fold = 1 and id = 350 and role = 'train')")
    result = plans.train_and_cv(data, "y", ["d"], kind, "id", model_params=params, relation=relation)
    oof = {r.id: r for r in result.oof.collect()}
    assert len(oof) == data.count() and oof[350].fold == 1 and oof[301].fold == 0 and oof[51].fold == 1
    assert oof[10].fold is None and math.isnan(oof[10].prediction)
    twice = result.pairs.filter("id = 350").collect()
    assert sorted(r.fold for r in twice) == [0, 1]
    last = next(r for r in twice if r.fold == 1)
    assert last.prediction == oof[350].prediction
    assert {r.fold for r in result.fold_scores("rmse").collect()} == {0, 1}
    assert len(result.models) == 2


def plain_ordered(data, feature, seed, smoothing, prior, hashes):
    out = {}
    seen = {}
    for r in sorted(data, key=lambda r: (hashes[r.id], r.id)):
        s, n = seen.get(r[feature], (0.0, 0))
        out[r.id] = prior if r[feature] is None else (s + smoothing * prior) / (n + smoothing)
        if r.y is not None:
            seen[r[feature]] = (s + r.y, n + 1)
    return out


def check_ordered(rows):
    data = rows.collect()
    hashes = {r.id: r.h for r in rows.select("id", keyed_hash("id", 4).alias("h")).collect()}
    model = op.fit_ordered_target_encoder(rows, ["c", "d"], "y", "id", seed=4, smoothing=3.0)
    got = {r.id: r for r in model.transform_train(rows.withColumn("c_ots", F.lit("old"))).collect()}
    assert len(got) == len(data)
    for feature in ("c", "d"):
        want = plain_ordered(data, feature, 4, 3.0, model.prior, hashes)
        assert {i: r[f"{feature}_ots"] for i, r in got.items()} == pytest.approx(want)
    test = model.transform(rows.limit(9)).collect()
    for r in test:
        own = [x.y for x in data if x.d == r.d and x.y is not None]
        assert r.d_ots == pytest.approx((sum(own) + 3 * model.prior) / (len(own) + 3))


def test_ordered_statistics(rows):
    check_ordered(rows)


def test_ordered_statistics_on_large_routes(rows, big_data_routes):
    check_ordered(rows)


def test_ordered_statistics_of_odd_rows(spark, rows):
    empty = rows.limit(0)
    model = op.fit_ordered_target_encoder(empty, ["c"], "y", "id")
    assert model.transform_train(empty).count() == 0 and model.transform(rows).filter("c_ots <> 0").count() == 0
    with pytest.raises(ValueError):
        op.fit_ordered_target_encoder(rows, [], "y", "id")
    plain = op.fit_ordered_target_encoder(rows, ["c"], "y", "id", smoothing=0.0, prior=1.5)
    first = plain.transform_train(rows.filter("c = 'a'")).select("c_ots").collect()
    assert min(r.c_ots for r in first if r.c_ots is not None) >= 0


def test_a_hot_category_is_spread(spark):
    """Two thirds of the rows share a key; no task gets more than a few stretches of them."""
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("k"), keyed_hash("id", 1).alias("h"), F.lit(1).alias("v"))
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        found = sums_before(rows, ["k"], ["h"], F.floor(F.col("h") / (1 << 26)).cast("int"), ["v"])
        sizes = [r["count"] for r in found.filter("k = 0").groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert max(sizes) < 0.4 * 20_000 and found.agg(F.max("v_before")).first()[0] == 20_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_area_of_several_classes(spark):
    """Pairs of rows counted one by one."""
    rng = random.Random(5)
    data = [(rng.choice([0, 0, 1, 2]), [rng.choice([0.1, 0.2, 0.5, 0.7]) for _ in range(3)]) for _ in range(60)]
    df = spark.createDataFrame(data, "y int, p array<double>")

    def area(c, rest):
        wins = [(a[c] > b[c]) + 0.5 * (a[c] == b[c]) for y, a in data if y == c for z, b in data if z in rest]
        return sum(wins) / len(wins)

    n = [sum(y == c for y, _ in data) for c in range(3)]
    ovr = [area(c, {0, 1, 2} - {c}) for c in range(3)]
    pairs = [((area(i, {j}) + area(j, {i})) / 2, n[i] + n[j]) for i in range(3) for j in range(i + 1, 3)]
    want = {("ovr", "macro"): sum(ovr) / 3, ("ovr", "weighted"): sum(a * k for a, k in zip(ovr, n)) / 60,
            ("ovo", "macro"): sum(a for a, _ in pairs) / 3, ("ovo", "weighted"): sum(a * k for a, k in pairs) / sum(k for _, k in pairs)}
    for (kind, average), value in want.items():
        assert op.calculate_metric(df, "y", "p", "roc_auc", multi_class=kind, average=average) == pytest.approx(value)
    two = spark.createDataFrame([(y, float(i)) for i, y in enumerate([0, 1, 0, 1])], "y int, p double")
    assert op.calculate_metric(two, "y", "p", "auc") == pytest.approx(0.75)
    with pytest.raises(Exception, match="more than two labels"):
        op.calculate_metric(two.withColumn("y", F.col("p").cast("int")), "y", "p", "roc_auc")
    with pytest.raises(Exception, match="rows of every class"):
        op.calculate_metric(df.filter("y <> 2"), "y", "p", "roc_auc")
    with pytest.raises(ValueError):
        op.calculate_metric(df, "y", "p", "roc_auc", multi_class="all")

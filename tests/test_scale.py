"""Shape of the plans: what is broadcast, what is shuffled, and where hot keys go."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise import operators as op
from foldwise.frame import work_folder
from foldwise.operators import order_stats
from foldwise.operators.lookup import attach, fit_lookup
from tests.conftest import values


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def skewed(spark):
    """A third of the rows has one key, a sixth has none."""
    key = F.when(F.col("id") % 3 == 0, F.lit(-1)).when(F.col("id") % 6 != 1, F.col("id") % 50)
    return spark.range(3000).select("id", key.alias("k"), (F.col("id") % 17).cast("double").alias("y"))


@pytest.fixture
def static_plans(spark):
    names = ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")
    before = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], "false")
    spark.conf.set(names[1], "-1")
    yield
    for n, v in zip(names, before):
        spark.conf.set(n, v)


def test_small_tables_do_not_move_the_rows(skewed, static_plans):
    out = op.fit_count_encoder(skewed, ["k"]).transform(skewed)
    assert "BroadcastHashJoin" in plan(out) and "Exchange hashpartitioning" not in plan(out)


def test_hot_and_missing_keys_are_spread(skewed, static_plans, big_data_routes):
    counts = skewed.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    out = attach(skewed, fit_lookup(counts, ["k"], ["n"], rows="n"))
    assert "SortMergeJoin" in plan(out)
    placed = out.withColumn("part", F.spark_partition_id())
    for group in (F.col("k") == -1, F.col("k").isNull()):
        assert placed.filter(group).select("part").distinct().count() > 1
    assert out.count() == 3000
    assert out.filter("k = -1 and n <> 1000").isEmpty() and out.filter("k is null and n is not null").isEmpty()
    assert out.filter("k >= 0 and n is null").isEmpty()


def test_null_safe_join_finds_the_missing_key(skewed, big_data_routes):
    counts = skewed.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    out = attach(skewed, fit_lookup(counts, ["k"], ["n"], rows="n"), null_safe=True)
    missing = skewed.filter("k is null").count()
    assert {r["n"] for r in out.filter("k is null").collect()} == {missing}


def test_one_aggregation_for_many_features(skewed):
    rows = skewed.withColumn("k2", F.col("id") % 5).withColumn("fold", (F.col("id") % 4).cast("int"))
    model = op.fit_target_encoder(rows, ["k", "k2"], "y", "fold")
    assert model.lookup.table.select("__feature").distinct().count() == 2
    encoded = model.transform_train(rows)
    assert encoded.columns == [*rows.columns, "k_te", "k2_te"]
    assert encoded.filter("k_te is null or k2_te is null").isEmpty()


def test_ranges_split_a_hot_group(spark, monkeypatch):
    """Ranks of a group that holds most rows come from several ranges, equal to a plain sort."""
    monkeypatch.setattr(order_stats, "ROWS_PER_RANGE", 50)
    df = spark.range(2000).select(F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("g"), (F.col("id") * 7919 % 2003).alias("v"))
    got = {r["g"]: r["q"] for r in order_stats.grouped_quantiles(df, ["g"], "v", [0, .25, .5, .9, 1], "q").collect()}
    want = {r["g"]: r["q"] for r in df.groupBy("g").agg(F.percentile("v", F.lit([0., .25, .5, .9, 1.])).alias("q")).collect()}
    assert got.keys() == want.keys()
    assert all(got[g] == pytest.approx(want[g]) for g in want)


def test_large_keys_stay_exact(frame):
    big = 2 ** 60
    df = frame("k bigint", k=[big + i for i in range(9)])
    assert order_stats.values_at_ranks(df, "k", [0, 4, 8]) == {0: big, 4: big + 4, 8: big + 8}
    folds = op.contiguous_kfold(df, "k", 3)
    assert values(folds, "k", "fold") == [0, 0, 0, 1, 1, 1, 2, 2, 2]


def test_work_folder_is_shared(spark):
    folder, configured = work_folder(spark), spark.conf.get("spark.checkpoint.dir", None)
    assert work_folder(spark) == folder
    assert folder.startswith(configured.rstrip("/") if configured else "file://")


def test_results_do_not_depend_on_partitions(skewed):
    want = None
    for n in (1, 5, 13):
        rows = skewed.repartition(n)
        folds = op.stratified_kfold(rows.withColumn("c", F.col("y").cast("int")), "id", "c", 3, seed=1)
        sample = op.sample_dataframe(rows, "id", n=100, seed=2)
        got = (values(folds, "id", "fold"), values(sample, "id", "id"))
        want = want or got
        assert got == want


def greedy(sizes, k):
    loads = [0] * k
    for size in sorted(sizes, reverse=True):
        loads[loads.index(min(loads))] += size
    return loads


@pytest.mark.parametrize("k", [2, 3, 7])
def test_group_folds_follow_the_greedy_loads(spark, k):
    sizes = [40, 31, 30, 12, 12, 12, 9, 5, 5, 5, 5, 4, 3, 3, *[2] * 25, *[1] * 61]
    rows = spark.createDataFrame([(g, i) for g, n in enumerate(sizes) for i in range(n)], "g int, i int")
    rows = rows.withColumn("g", F.when(F.col("g") != 3, F.col("g")))  # one group is null
    folded = op.group_kfold(rows, "g", k, seed=5)
    assert folded.groupBy("g").agg(F.count_distinct("fold").alias("n")).filter("n <> 1").count() == 0
    got = {r["fold"]: r["count"] for r in folded.groupBy("fold").count().collect()}
    assert [got[f] for f in range(k)] == greedy(sizes, k)


def test_places_of_equal_groups():
    from foldwise.operators.folds import _places

    for loads, size, groups in (([5, 0, 9], 4, 3), ([0, 0, 0, 0], 3, 10), ([7, 7, 1], 2, 1), ([100, 0], 1, 250), ([3, 8], 5, 0)):
        counts, have = [0] * len(loads), list(loads)
        for _ in range(groups):
            i = have.index(min(have))
            have[i] += size
            counts[i] += 1
        assert _places(loads, size, groups) == counts


def test_wide_mappings_and_categories(spark):
    from foldwise.functions import map_values

    rows = spark.range(3000).select(F.col("id").cast("int").alias("k"))
    for n in (999, 1001):
        mapping = {i: i % 7 for i in range(n)}
        want = [i % 7 if i < n else 9 for i in range(3000)]
        joined = op.map_column(rows, "k", mapping, default=9, dtype="int", out="v")
        assert values(joined, "k", "v") == want
        assert values(rows.withColumn("v", map_values(F.col("k"), mapping, 9, "int")), "k", "v") == want
    from foldwise.operators.encode import fit_onehot, fit_onehot_vector

    assert len(fit_onehot(rows.withColumn("k2", F.col("k")), ["k", "k2"]).categories["k"]) == 3000
    with pytest.raises(ValueError):
        fit_onehot(rows, ["k"], max_categories=2999)
    fit_onehot(rows, ["k"], max_categories=3000)
    sparse = fit_onehot_vector(rows.filter("k < 2000"), ["k"], "v").transform(rows).orderBy("k").collect()
    assert sparse[5]["v"].size == 2000 and list(sparse[5]["v"].indices) == [5] and list(sparse[2500]["v"].indices) == []


def test_no_limit_on_folds(spark):
    from foldwise.operators.encode_stats import observed_folds

    rows = spark.range(1500).withColumnRenamed("id", "fold")
    assert len(observed_folds(rows, "fold")) == 1500
    with pytest.raises(ValueError):
        observed_folds(rows, "fold", max_folds=1499)


def test_samples_with_null_and_repeated_keys(spark):
    rows = spark.range(200).select(F.when(F.col("id") % 2 == 0, F.col("id") % 3).alias("k"), F.col("id"))
    same = rows.select("k", F.lit(1).alias("v"))
    for n in (0, 1, 5, 66, 120, 200):
        assert op.sample_dataframe(rows, "k", n=n, seed=1).select("id").distinct().count() == n
        assert op.sample_dataframe(rows, "k", n=n, shuffle=False).select("id").distinct().count() == n
        assert op.sample_dataframe(same, "k", n=n, seed=1).count() == n


def test_selection_has_no_limit_on_width(spark):
    from foldwise import plans

    for width in (59, 62):
        rows = spark.range(400).select(
            F.col("id"), (F.col("id") % 3).cast("int").alias("fold"),
            *[F.xxhash64(F.lit(i), "id").cast("double").alias(f"h{i}") for i in range(width)])
        rows = rows.select("id", "fold", *[(F.col(f"h{i}") / 1e18).alias(f"x{i}") for i in range(width)])
        rows = rows.withColumn("y", 2 * F.col("x1") + F.col("x3"))
        names = [f"x{i}" for i in range(width)]
        found = plans.select_features_forward(rows, "y", names, "ridge", "id", "rmse", model_params={"alpha": 0.0})
        assert sorted(found) == ["x1", "x3"]
    gaps = rows.withColumn("y", F.when(F.col("id") > 0, F.col("y")))
    with pytest.raises(ValueError):
        plans.select_features_forward(gaps, "y", names, "ridge", "id", "rmse")
    from foldwise.plans.training import best_round

    assert best_round([3, 2, 2.5, 2.4, 1], 2) == 2 and best_round([3, 2, 2.5, 1], 2) == 4 and best_round([1], 1) == 1
    with pytest.raises(ValueError):
        plans.train_and_cv(rows, "y", ["x1"], "xgb", "id", model_params={"gamma_ray": 1})


def test_no_percentile_over_raw_rows(spark, skewed):
    from foldwise import plans

    plan = op.create_aggregation_features(skewed, [
        {"groupby_cols": ["id"], "agg_col": "y", "agg_func": "median", "new_col_name": "m"}])
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile(" not in text


def test_index_of_neighbours_recalls_most(spark):
    from foldwise import plans
    from foldwise.plans.knn import ProjectionIndex

    rows = spark.range(400).select("id", *[((F.xxhash64(F.lit(i), F.col("id") % 40) % 1000) / 100 + (
        F.xxhash64(F.lit(9 - i), "id") % 1000) / 4000).alias(f"x{i}") for i in range(4)])
    names = [f"x{i}" for i in range(4)]
    exact = plans.nearest_neighbours(rows, rows, "id", names, 3, exclude_self=True)
    found = plans.nearest_neighbours(rows, rows, "id", names, 3, exclude_self=True, index=ProjectionIndex(6.0, 8, 1))
    same = exact.select("query_id", "point_id").intersect(found.select("query_id", "point_id")).count()
    assert same >= 0.9 * exact.count()
    assert "CoGroup" not in found._jdf.queryExecution().executedPlan().toString()


def test_wanted_ranges_are_split_until_they_are_small(spark, monkeypatch):
    """200 columns share the first cut points, and one column has most of its rows in one value: no task orders many counted values."""
    monkeypatch.setattr(order_stats, "ROWS_PER_RANGE", 40)
    monkeypatch.setattr(order_stats, "CUT_POINTS", 16)
    n, columns = 600, 200
    rows = spark.range(n).select(*[
        (F.when(F.col("id") % 3 > 0, 5.0).otherwise(F.xxhash64("id") % 1000) if c == 0 else
         F.xxhash64("id", F.lit(c)) % 100_000 / (10.0 ** (c % 5)) + c).alias(f"c{c}") for c in range(columns)]).cache()
    sizes, fit = [], order_stats.fit_lookup

    def measured(table, keys, payload, rows):
        out = fit(table, keys, payload, rows=rows)
        if "__wanted" in payload:
            sizes.append([(r["__size"], r["__lo"], r["__hi"]) for r in out.table.collect()])
        return out

    monkeypatch.setattr(order_stats, "fit_lookup", measured)
    names = [f"c{c}" for c in range(columns)]
    got = order_stats.column_quantiles(rows, names, [0.0, 0.25, 0.5, 1.0])
    assert len(sizes) > 1 and any(size > 40 and lo < hi for size, lo, hi in sizes[0])
    assert all(size <= 40 or lo == hi for size, lo, hi in sizes[-1])
    data = rows.toPandas()
    for c in names:
        assert got[c] == pytest.approx(np.quantile(data[c].to_numpy(float), [0.0, 0.25, 0.5, 1.0]))


@pytest.mark.parametrize("null_safe", [False, True])
def test_many_features_are_looked_up_in_one_pass(spark, null_safe, monkeypatch):
    """100 features: no table is written after fitting, no join, and the values of the joins."""
    from foldwise.operators import lookup

    rows = spark.range(300).select("id", *[
        F.when(F.xxhash64("id", F.lit(c)) % 5 != 0, (F.xxhash64("id", F.lit(c)) % (3 + c % 7)).cast("string" if c % 3 else "double")).alias(f"f{c}")
        for c in range(100)])
    names = [f"f{c}" for c in range(100)]
    long = lookup.long_keys(rows, names)
    long = long if null_safe else long.filter(F.col(lookup.KEY).isNotNull())
    counts = long.groupBy(lookup.FEATURE, lookup.KEY).agg(F.count(F.lit(1)).alias("n"))
    fitted = lookup.fit_features(counts.withColumn("list", F.array(F.col("n").cast("double"))), rows, names, ["n", "list"], rows="n")
    other = spark.range(3).select("id", *[F.lit("new" if c % 3 else None).cast(rows.schema[f"f{c}"].dataType).alias(f"f{c}") for c in range(100)])
    outputs, written = {f: [f"{f}_n", f"{f}_l"] for f in names}, []
    monkeypatch.setattr(lookup, "materialise", lambda *a, **k: written.append(a))
    for df in (rows, other):
        one_pass = lookup.attach_features(df, fitted, outputs, null_safe=null_safe)
        plan = one_pass._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" in plan and "Join" not in plan and "Exchange" not in plan and not written
        got = sorted(map(str, one_pass.collect()))
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(lookup, "JOIN_BLOCK", 1000)
            joined = lookup.attach_features(df.select("id", *names[:12]), fitted, {f: outputs[f] for f in names[:12]}, null_safe=null_safe)
        some = [c for f in names[:12] for c in outputs[f]]
        assert sorted(map(str, one_pass.select("id", *some).collect())) == sorted(map(str, joined.select("id", *some).collect()))
        assert len(got) == df.count()

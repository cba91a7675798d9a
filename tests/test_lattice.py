"""Crossed encodings from one scan against encoding each crossed column on its own."""

import pytest
from pyspark.sql import functions as F

from foldwise import operators as op
from foldwise.operators import lookup
from foldwise.operators.cross import nway_names


def test_crossings_equal_single_columns(spark, monkeypatch):
    columns = ["a", "b", "c", "d"]
    rows = spark.range(400).select("id", (F.col("id") % 3).cast("int").alias("fold"), F.when(F.col("id") % 11 > 0, (F.xxhash64("id") % 7).cast("double")).alias("y"), *[
        F.when(F.xxhash64("id", F.lit(i)) % 9 != 0, (F.xxhash64("id", F.lit(i)) % (2 + i)).cast("string")).alias(c) for i, c in enumerate(columns)])
    train, test = rows.filter("id < 320"), rows.filter("id >= 320").drop("fold", "y")
    names = list(nway_names(columns, [2, 3, 4]))
    monkeypatch.setattr(lookup, "JOIN_BLOCK", 5)  # the way of many features
    for prior, smoothing in (("fold", True), ("global", False)):
        model = op.fit_crossed_encoder(train, columns, [2, 3, 4], "y", "fold", prior=prior, use_smoothing=smoothing)
        wide = op.create_nway_interaction_features(train, columns, [2, 3, 4], keep=train.columns)
        plain = op.fit_target_encoder(wide, names, "y", "fold", prior=prior, use_smoothing=smoothing)
        counts = op.fit_count_encoder(wide, names)
        for got, want in ((model.transform_train(train), counts.transform(plain.transform_train(wide))),
                          (model.transform(test), counts.transform(plain.transform(op.create_nway_interaction_features(test, columns, [2, 3, 4], keep=test.columns))))):
            a, b = ({r["id"]: r for r in df.collect()} for df in (got, want))
            assert set(a) == set(b) and not set(names) & set(got.columns)
            for i, r in a.items():
                for n in names:
                    assert r[f"{n}_te"] == pytest.approx(b[i][f"{n}_te"]) and r[f"{n}_count"] == b[i][f"{n}_count"]
    with pytest.raises(ValueError):
        op.fit_crossed_encoder(train, ["a", "y"], [2], "y", "fold")


def test_one_scan_and_no_copy_of_the_rows(spark, monkeypatch):
    """120 crossings: the rows are aggregated once, and nothing as long as them is written."""
    from foldwise.operators import lattice

    columns = [f"c{i}" for i in range(9)]
    rows = spark.range(3000).select("id", (F.col("id") % 3).cast("int").alias("fold"), (F.col("id") % 13).cast("double").alias("y"), *[
        (F.col("id") % 2 if i < 7 else F.lit(i)).cast("string").alias(c) for i, c in enumerate(columns)])
    written = []
    for module in (lattice, lookup):
        plain = module.materialise
        monkeypatch.setattr(module, "materialise", lambda df, *a, plain=plain, **k: written.append(plain(df, *a, **k)) or written[-1])
    model = op.fit_crossed_encoder(rows, columns, [2, 3], "y", "fold", folds=range(3))
    out = model.transform_train(rows)
    assert len(model.means.lookup.features) == 120 and out.count() == 3000
    assert max(w.count() for w in written) < 3000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("MapInArrow") == 2


def test_texts_are_joined_per_combination(spark, monkeypatch):
    """Rows find their places by numbers: no text of a crossing is made per row, and crossings of many values agree with it."""
    from foldwise.operators import lattice

    columns = ["a", "b", "c", "d"]
    rows = spark.range(500).select("id", (F.col("id") % 3).cast("int").alias("fold"), (F.col("id") % 17).cast("double").alias("y"), *[
        F.when(F.xxhash64("id", F.lit(i)) % 5 != 0, F.concat(F.lit("x_"), F.xxhash64("id", F.lit(i)) % (3 + i))).alias(c) for i, c in enumerate(columns)])
    monkeypatch.setattr(lookup, "JOIN_BLOCK", 5)
    model = op.fit_crossed_encoder(rows, columns, [2, 3, 4], "y", "fold")
    out = model.transform_train(rows)
    assert "null_str_" not in str(out._jdf.queryExecution().optimizedPlan()) and "concat(coalesce" not in str(out._jdf.queryExecution().optimizedPlan())
    want = sorted(map(str, out.collect()))
    monkeypatch.setattr(lattice, "CROSS_CELLS", 40)
    assert sorted(map(str, model.transform_train(rows.repartition(5)).collect())) == want
    monkeypatch.setattr(lookup, "JOIN_BLOCK", 1000)
    assert sorted(map(str, model.transform_train(rows).collect())) == want

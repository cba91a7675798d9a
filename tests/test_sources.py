import os

import pytest
from pyspark.sql import functions as F

from foldwise import sources
from tests.conftest import values


@pytest.fixture
def rows(frame):
    return frame("id bigint, x double, s string", id=[1, 2, 3], x=[.5, None, 2.], s=["a", "b,c", None])


def test_csv_round_trip(spark, rows, tmp_path):
    path = str(tmp_path / "t.csv")
    sources.save_csv(rows, path, separator=";")
    back = sources.load_csv(spark, path, sep=";")
    assert values(back, "id", "x", "s") == [[.5, None, 2.], ["a", "b,c", None]]
    typed = sources.load_csv(spark, path, schema="id bigint, x double, s string", sep=";")
    assert typed.schema["x"].dataType.simpleString() == "double" and typed.count() == 3
    with pytest.raises(Exception):
        sources.load_csv(spark, str(tmp_path / "absent.csv"))


def test_parquet_round_trip(spark, rows, tmp_path):
    path = str(tmp_path / "t.parquet")
    sources.save_parquet(rows, path, compression="snappy")
    assert sources.load_parquet(spark, path, ["s", "id"], 2).columns == ["s", "id"]
    assert sources.load_parquet(spark, path, n_rows=2).count() == 2


def test_samples(spark, rows, tmp_path):
    raw, out = tmp_path / "raw", tmp_path / "out"
    raw.mkdir()
    sources.save_csv(rows, str(raw / "a.csv"))
    sources.save_parquet(rows, str(raw / "b.parquet"))
    (raw / "notes.txt").write_text("x")
    (raw / "broken.parquet").write_text("not parquet")
    done = sources.create_data_samples(spark, str(raw), str(out), 2)
    assert done == {"sampled": 2, "skipped": 1, "failed": 1}
    assert sources.load_csv(spark, str(out / "a.csv")).count() == 2
    with pytest.raises(ValueError):
        sources.create_data_samples(spark, str(raw), str(out), 0)


def test_prediction_store(spark, frame, tmp_path):
    path = str(tmp_path / "store")
    one = frame("id int, prediction double", id=[1, 2], prediction=[.1, .2])
    two = frame("id int, prediction double", id=[1, 3], prediction=[.3, .4])
    sources.save_predictions(one, path, "a", "oof", "id")
    sources.save_predictions(two, path, "b", "oof", "id")
    sources.save_predictions(one.withColumn("prediction", F.lit(9.0)), path, "a", "oof", "id")
    found = sources.load_predictions(spark, path, "oof", row_id="id")
    assert found.count() == 4 and found.filter("model = 'a'").first()["prediction"] == 9.0
    assert sources.load_predictions(spark, path, "oof", ["a"], reference=one, row_id="id").count() == 2
    with pytest.raises(ValueError):
        sources.load_predictions(spark, path, "oof", ["b"], reference=one, row_id="id")


def test_folds_and_submissions(spark, frame, tmp_path):
    df = frame("id int, fold int, p double", id=[1, 2], fold=[0, 1], p=[.5, .7])
    sources.save_folds(df, str(tmp_path / "folds"), "id")
    assert values(sources.load_folds(spark, str(tmp_path / "folds")), "id", "fold") == [0, 1]
    path = str(tmp_path / "sub")
    sources.generate_submission_file(df, "id", "p", "Target", path)
    back = sources.load_csv(spark, path)
    assert back.columns == ["id", "Target"] and values(back, "id", "Target") == [.5, .7]
    with pytest.raises(Exception, match="no prediction"):
        sources.generate_submission_file(df.withColumn("p", F.nullif("p", F.lit(.5))), "id", "p", "Target").collect()
    results = {"m": {"oof": df.select("id", F.col("p").alias("prediction")), "test": df.select("id", F.col("p").alias("prediction"))}}
    paths = sources.save_model_artifacts(results, str(tmp_path / "run"), "id", "Target", "m")
    assert [os.path.basename(p) for p in paths] == ["submission_m", "submission_best"]
    assert len(sources.save_model_artifacts(results, str(tmp_path / "run2"), "id", "Target", "absent")) == 1


def test_run_log(frame):
    first = frame("script_file_name string, cv_score double, how string, best_model string, other string",
                  script_file_name=["e1", "e2"], cv_score=[1., 2.], how=["plain", None], best_model=["rf", "gbt"], other=["x", "y"])
    log = sources.update_run_log(None, first)
    assert log.columns == list(sources.RUN_LOG_COLUMNS)
    assert values(log, "script_file_name", "how", "status") == [["plain Best model: rf.", "Best model: gbt."], ["done", "done"]]
    second = frame("script_file_name string, cv_score double, why string", script_file_name=["e2", "e3"], cv_score=[1.5, 3.], why=[None, "new"])
    log = sources.update_run_log(log, second)
    assert values(log, "script_file_name", "cv_score", "why") == [[1., 1.5, 3.], [None, None, "new"]]
    assert values(log, "script_file_name", "how") == ["plain Best model: rf.", "Best model: gbt.", None]


def test_samples_of_many_files(spark, tmp_path):
    """The first rows of sorted parts are those of the files whose names come first, not of the largest file."""
    raw, out = tmp_path / "raw", tmp_path / "out"
    rows = spark.range(1000).select("id", F.when(F.col("id") > 900, F.repeat(F.lit("x"), 500)).otherwise("y").alias("s"))
    parts = rows.repartitionByRange(7, "id").sortWithinPartitions("id")
    sources.save_csv(parts, str(raw / "a.csv"))
    sources.save_parquet(parts, str(raw / "b.parquet"))
    sources.save_parquet(rows.filter("id < 4").withColumn("k", F.col("id") % 2).repartition("k"), str(raw / "c d.parquet"))
    assert sources.create_data_samples(spark, str(raw), str(out), 300)["sampled"] == 3
    for found in (sources.load_csv(spark, str(out / "a.csv")), sources.load_parquet(spark, str(out / "b.parquet"))):
        assert sorted(r["id"] for r in found.collect()) == list(range(300))
    assert sources.load_parquet(spark, str(out / "c d.parquet")).count() == 4

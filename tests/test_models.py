"""Models on disk and folders of versions."""

import datetime
import json
import os
import subprocess
import sys
import threading

import pytest
from pyspark.sql import functions as F

from foldwise import operators as op
from foldwise import plans, sources
from foldwise.sources import versions
from tests.conftest import values


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [(i, "abc"[i % 3] if i % 7 else None, datetime.date(2024, 1, 1 + i % 4), float(i % 11), None if i % 13 == 0 else i * 0.5, i % 2, i % 3)
         for i in range(120)], "id bigint, c string, d date, x double, z double, flag int, fold int").cache()


FITS = {
    "onehot": lambda df: op.fit_onehot(df, ["c", "d"]),
    "onehot_vector": lambda df: op.fit_onehot_vector(df, ["c"], "v"),
    "ordinal": lambda df: op.fit_ordinal(df.filter("c is not null"), ["c"], handle_unknown="use_encoded_value", unknown_value=-1.0),
    "label": lambda df: op.fit_label(df.filter("c is not null"), ["c"]),
    "bins": lambda df: op.fit_bins(df, ["x"], 4, "quantile"),
    "count": lambda df: op.fit_count_encoder(df, ["c", "d"]),
    "ratio": lambda df: op.fit_ratio_encoder(df, ["x"], "c"),
    "target": lambda df: op.fit_target_encoder(df, ["c", "d"], "x", "fold"),
    "ordered": lambda df: op.fit_ordered_target_encoder(df, ["c"], "x", "id"),
    "imputer": lambda df: op.fit_imputer(df, "median", ["z"]),
    "scaler": lambda df: op.fit_scaler(df, ["x"], "robust"),
}


def as_rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("name", FITS)
def test_encoders_come_back(spark, rows, tmp_path, name):
    model = FITS[name](rows)
    sources.save_model(model, str(tmp_path / "m"), spark)
    again = sources.load_model(spark, str(tmp_path / "m"))
    assert type(again) is type(model)
    given = rows if name != "label" else rows.filter("c is not null")
    assert as_rows(again.transform(given)) == as_rows(model.transform(given))


LEARNERS = [("ridge", "x", {"alpha": 1.0}), ("rf", "flag", {"n_estimators": 2, "max_depth": 2}), ("knn_reg", "x", {}),
            ("xgb", "flag", {"n_estimators": 2, "objective": "binary:logistic"}), ("lgbm", "x", {"n_estimators": 2}), ("logreg", "flag", {})]


@pytest.mark.parametrize("kind, target, params", LEARNERS)
def test_results_come_back(spark, rows, tmp_path, kind, target, params):
    result = plans.train_and_cv(rows, target, ["id", "fold"], kind, "id", model_params=params, test=rows.limit(5))
    sources.save_model(result, str(tmp_path / "m"), spark)
    again = sources.load_model(spark, str(tmp_path / "m"))
    assert as_rows(again.oof) == as_rows(result.oof) and as_rows(again.test) == as_rows(result.test)
    for a, b in zip(again.models, result.models):
        assert as_rows(a.predict(rows, "id")) == as_rows(b.predict(rows, "id"))


def test_another_session_reads_it(spark, rows, tmp_path):
    """Fitted here, loaded by a new process."""
    model, path = op.fit_target_encoder(rows, ["c"], "x", "fold"), str(tmp_path / "m")
    sources.save_model([model, {"seed": 3}], path, spark)
    rows.write.parquet(str(tmp_path / "rows"))
    code = f"""
import sys; sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from tools.session import session
from foldwise import sources
spark = session("other", cores="1")
model, extra = sources.load_model(spark, {path!r})
assert extra == {{"seed": 3}}
print(sorted(map(str, model.transform_train(spark.read.parquet({str(tmp_path / 'rows')!r})).select("id", "c_te").collect())))"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    assert out.stdout.strip().splitlines()[-1] == str(as_rows(model.transform_train(rows).select("id", "c_te")))


def test_wrong_files_are_refused(spark, rows, tmp_path):
    path = str(tmp_path / "m")
    with pytest.raises(FileNotFoundError):
        sources.load_model(spark, path)
    sources.save_model(op.fit_count_encoder(rows, ["c"]), path, spark)
    folder = versions.latest(spark, path).folder
    plan = json.loads(versions.read_text(spark, f"{folder}/model.json"))

    def changed(**fields):
        versions._store(spark, folder).delete(versions._path(spark, f"{folder}/model.json"), False)
        versions.write_text(spark, f"{folder}/model.json", json.dumps({**plan, **fields}))

    changed(version=99)
    with pytest.raises(ValueError, match="format"):
        sources.load_model(spark, path)
    changed(model={"is": "model", "class": "os.path.join", "value": {}})
    with pytest.raises(ValueError, match="not a model class"):
        sources.load_model(spark, path)
    changed(model={**plan["model"], "value": {**plan["model"]["value"], "more": 1}})
    with pytest.raises(ValueError, match="no fields"):
        sources.load_model(spark, path)
    table = plan["model"]["value"]["lookup"]["value"]["table"]
    table["schema"]["fields"][0]["type"] = "string"
    changed()
    with pytest.raises(ValueError, match="columns"):
        sources.load_model(spark, path)
    with pytest.raises(TypeError, match="cannot be saved"):
        sources.save_model(object(), path, spark)


def test_a_killed_writer_leaves_the_old_version(spark, rows, tmp_path):
    path = str(tmp_path / "folds")
    sources.save_folds(rows, path, "id")

    def dies(folder, before):
        rows.limit(3).select("id", "fold").write.parquet(folder)
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        versions.replace(spark, path, dies)
    assert sources.load_folds(spark, path).count() == 120
    sources.save_folds(rows.limit(4), path, "id")
    assert sources.load_folds(spark, path).count() == 4 and versions.latest(spark, path).number == 2
    assert versions.prune(spark, path, keep=1) == 1 and sources.load_folds(spark, path).count() == 4


def test_two_writers_at_once(spark, tmp_path):
    """Each update reads, merges and publishes; none is lost."""
    path, errors = str(tmp_path / "log"), []
    barrier = threading.Barrier(4)

    def update(i):
        try:
            barrier.wait()
            for j in range(2):
                sources.update_stored_run_log(spark.createDataFrame([(f"e{i}-{j}", float(i))], "script_file_name string, cv_score double"), path)
        except Exception as error:  # noqa: BLE001
            errors.append(error)

    threads = [threading.Thread(target=update, args=(i,)) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    log = sources.load_run_log(spark, path)
    assert values(log, "script_file_name", "cv_score") == [[float(i) for i in range(4) for _ in range(2)]][0]
    assert versions.latest(spark, path).number == 8

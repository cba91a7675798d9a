"""Every query with SQL gives the same rows as DuckDB on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
import catalog
from tools.check import normal

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="sample tables are not here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, db, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    want = db.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert normal(got.astype(object)).equals(normal(want.astype(object)))


def test_entry(spark):
    assert entry_points.entry(spark).limit(1).count() == 1
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) == set(QUERIES)


def test_no_row_wise_python(spark):
    """Only the neighbour search runs Python in tasks."""
    for name in ("te_mean_oof", "te_median_oof", "count_enc_train", "nway_label", "agg_all", "metric_auc", "kfold_exact"):
        plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "CartesianProduct" not in plan, name

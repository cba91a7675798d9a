"""The registered queries against their SQL, and the pipeline stage by stage."""

import glob
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from foldwise.llm import queries
from tools.check import normal

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="sample tables are not here")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows(spark, name):
    db = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        db.execute(f"create view {os.path.basename(path).removesuffix('.parquet')} as select * from '{path}'")
    got, want = queries.QUERIES[name](spark, FOLDER).toPandas(), db.execute(queries.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert normal(got.astype(object)).equals(normal(want.astype(object)))


def test_one_query_per_operator():
    numbers = [int(n[2:].split("_")[0]) for n in queries.QUERIES]
    assert sorted(numbers) == list(range(1, 14))


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    first = {r.doc_id: r.text for r in docs.collect()}
    counts = [len(first)]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialise(stage(spark, docs, FOLDER))
        counts.append(docs.count())
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert docs.columns == columns
    assert counts[0] > counts[1] > counts[2] == counts[3] == counts[4] == counts[5]
    rows = docs.collect()
    assert all(r.round_trip and r.parity and r.decoded == r.text and r.n_tokens == len(r.token_ids) for r in rows)
    assert all(r.n_chars == len(r.text) for r in rows if r.text != first[r.doc_id])
    run = corpus_pipeline.run(spark, FOLDER)
    assert run.count() == counts[-1] and run.select(F.sum("n_tokens")).first()[0] == sum(r.n_tokens for r in rows)


def test_stages_take_nulls_and_empty_tables(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (10**9, "", None, None, 0), (10**9, None, "en", "s", None)], docs.schema)
    for rows in (docs.limit(0), docs.limit(30).unionByName(odd).withColumn("score", F.lit("kept"))):
        columns = rows.columns
        for _, stage in corpus_pipeline.STAGES:
            found = corpus_pipeline.materialise(stage(spark, rows, FOLDER))
            assert found.columns[:len(columns)] == columns

"""Readers, writers and stores: what is written comes back the same."""

import uuid

from pyspark.sql import functions as F

from catalog import query, rnd, table
from foldwise import operators as op
from foldwise import sources
from foldwise.frame import work_folder


def _folder(spark):
    """A new folder that all executors can reach."""
    return f"{work_folder(spark)}/stores-{uuid.uuid4().hex}"


def _orders(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")


@query("io_csv", """
select o_orderkey, nullif(o_orderpriority, '5-LOW') as o_orderpriority, o_totalprice from orders""")
def io_csv(spark, folder):
    path = f"{_folder(spark)}/orders.csv"
    df = _orders(spark, folder).withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW")))
    sources.save_csv(df, path, separator=";")
    return sources.load_csv(spark, path, schema="o_orderkey bigint, o_orderpriority string, o_totalprice double", sep=";")


@query("io_csv_inferred", "select o_orderkey, o_orderpriority, o_totalprice from orders")
def io_csv_inferred(spark, folder):
    path = f"{_folder(spark)}/orders.csv"
    sources.save_csv(_orders(spark, folder), path)
    return sources.load_csv(spark, path).withColumn("o_orderkey", F.col("o_orderkey").cast("bigint"))


@query("io_parquet", "select o_totalprice, o_orderkey from orders")
def io_parquet(spark, folder):
    path = f"{_folder(spark)}/orders.parquet"
    sources.save_parquet(_orders(spark, folder), path)
    return sources.load_parquet(spark, path, columns=["o_totalprice", "o_orderkey"])


@query("io_samples", """
select n as name, o_orderkey, o_orderpriority, o_totalprice from (
  select o_orderkey, o_orderpriority, round(o_totalprice, 2) as o_totalprice from orders order by o_orderkey limit 10),
  (values ('orders.csv'), ('orders.parquet')) v(n)""")
def io_samples(spark, folder):
    raw, samples = f"{_folder(spark)}/raw", f"{_folder(spark)}/samples"
    # sorted over all files, so that it is known which rows come first
    ordered = _orders(spark, folder).orderBy("o_orderkey")
    sources.save_csv(ordered, f"{raw}/orders.csv")
    sources.save_parquet(ordered, f"{raw}/orders.parquet")
    sources.create_data_samples(spark, raw, samples, 10)
    found = {"orders.csv": sources.load_csv(spark, f"{samples}/orders.csv"),
             "orders.parquet": sources.load_parquet(spark, f"{samples}/orders.parquet")}
    rows = [df.select(F.lit(name).alias("name"), F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "o_orderpriority",
                      rnd("o_totalprice", 2).alias("o_totalprice")) for name, df in found.items()]
    return rows[0].unionByName(rows[1])


@query("io_predictions", """
select o_orderkey, 'a' as model, o_totalprice as prediction from orders
union all select o_orderkey, 'b', o_totalprice * 2 from orders""")
def io_predictions(spark, folder):
    path = f"{_folder(spark)}/predictions"
    orders = _orders(spark, folder)
    for model, factor in (("a", 1), ("b", 3), ("b", 2)):
        part = orders.select("o_orderkey", (F.col("o_totalprice") * factor).alias("prediction"))
        sources.save_predictions(part, path, model, "oof", "o_orderkey")
    return sources.load_predictions(spark, path, "oof", ["a", "b"], reference=orders, row_id="o_orderkey")


@query("io_folds", "select o_orderkey, cast(ntile(5) over (order by o_orderkey) - 1 as integer) as fold from orders")
def io_folds(spark, folder):
    path = f"{_folder(spark)}/folds"
    sources.save_folds(op.contiguous_kfold(_orders(spark, folder), "o_orderkey", 5), path, "o_orderkey")
    return sources.load_folds(spark, path)


@query("io_submission", 'select o_orderkey as id, o_totalprice as "Target" from orders')
def io_submission(spark, folder):
    path = _folder(spark)
    test = _orders(spark, folder).withColumnRenamed("o_totalprice", "prediction")
    sources.save_model_artifacts({"m": {"test": test}}, path, "o_orderkey", "Target", best_model="m")
    best = sources.load_csv(spark, f"{path}/submission_best", schema="id bigint, Target double")
    return best

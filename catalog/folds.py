"""Folds, samples, stacking of frames and deduplication."""

from pyspark.sql import functions as F

from catalog import query, table
from foldwise import operators as op

HASH = "cast('0x' || substr(md5('{seed}|' || {key}), 1, 8) as bigint)"
H7 = HASH.format(seed=7, key="o_orderkey")


def _orders(spark, folder, *columns):
    return table(spark, folder, "orders").select("o_orderkey", *columns)


@query("kfold_hash", f"select o_orderkey, cast({H7} % 5 as integer) as fold from orders")
def kfold_hash(spark, folder):
    return op.kfold(_orders(spark, folder), "o_orderkey", 5, seed=7)


@query("kfold_exact", f"""
select o_orderkey, cast((row_number() over (order by {H7}, o_orderkey) - 1) % 5 as integer) as fold from orders""")
def kfold_exact(spark, folder):
    return op.kfold(_orders(spark, folder), "o_orderkey", 5, seed=7, exact=True)


@query("kfold_contiguous", """
select o_orderkey, cast(ntile(7) over (order by o_orderkey) - 1 as integer) as fold from orders""")
def kfold_contiguous(spark, folder):
    return op.contiguous_kfold(_orders(spark, folder), "o_orderkey", 7)


@query("kfold_stratified", f"""
select o_orderkey, o_orderpriority,
       cast((row_number() over (partition by o_orderpriority order by {H7}, o_orderkey) - 1) % 5 as integer) as fold
from orders""")
def kfold_stratified(spark, folder):
    return op.stratified_kfold(_orders(spark, folder, "o_orderpriority"), "o_orderkey", "o_orderpriority", 5, seed=7)


@query("kfold_group", """
with recursive sizes as (
  select row_number() over (order by count(*) desc) as i, count(*) as n from orders group by o_custkey),
steps as (
  select 0::bigint as i, [0, 0, 0, 0, 0]::bigint[] as loads
  union all
  select s.i, [loads[j] + case when j = list_position(loads, list_min(loads)) then s.n else 0 end for j in range(1, 6)]
  from steps p join sizes s on s.i = p.i + 1),
last as (select unnest(loads) as rows, generate_subscripts(loads, 1) - 1 as fold from steps where i = (select max(i) from sizes))
select cast(fold as integer) as fold, cast(rows as bigint) as rows, 0::bigint as split_groups from last""")
def kfold_group(spark, folder):
    """Rows per fold as by placing the biggest group first on the lightest fold, and the number of groups that are split."""
    folded = op.group_kfold(_orders(spark, folder, "o_custkey"), "o_custkey", 5)
    split = folded.groupBy("o_custkey").agg(F.count_distinct("fold").alias("folds")).agg(
        F.count_if(F.col("folds") > 1).alias("split_groups"))
    # one row
    return folded.groupBy("fold").agg(F.count(F.lit(1)).alias("rows")).join(F.broadcast(split)).select(
        F.col("fold").cast("int").alias("fold"), "rows", "split_groups")


@query("fold_pairs", """
select f as fold, count(case when o_orderkey % 5 <> f then 1 end) as train_rows,
       count(case when o_orderkey % 5 = f then 1 end) as valid_rows
from orders, (select unnest([0, 1, 2, 3, 4]) as f) group by f""")
def fold_pairs(spark, folder):
    df = _orders(spark, folder).withColumn("fold", (F.col("o_orderkey") % 5).cast("int"))
    out = None
    for k, train, valid in op.fold_pairs(df, "fold", 5):
        sides = train.select(F.lit(1).alias("t")).unionByName(valid.select(F.lit(0).alias("t")))
        part = sides.agg(F.count_if(F.col("t") == 1).alias("train_rows"), F.count_if(F.col("t") == 0).alias("valid_rows"))
        part = part.select(F.lit(k).alias("fold"), "train_rows", "valid_rows")
        out = part if out is None else out.unionByName(part)
    return out


@query("semi_filter", """
select l_orderkey, l_linenumber, l_quantity from lineitem
where l_orderkey in (select o_orderkey from orders where o_orderkey % 5 = 2)""")
def semi_filter(spark, folder):
    valid = _orders(spark, folder).filter(F.col("o_orderkey") % 5 == 2).withColumnRenamed("o_orderkey", "l_orderkey")
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity").join(
        valid, "l_orderkey", "left_semi")


@query("sample_head", """
select o_orderkey, o_totalprice from orders where o_orderkey in
(select o_orderkey from orders order by o_orderkey limit (select cast(floor(count(*) * 0.3) as bigint) from orders))""")
def sample_head(spark, folder):
    return op.sample_dataframe(_orders(spark, folder, "o_totalprice"), "o_orderkey", frac=0.3, shuffle=False)


@query("sample_n", f"""
select o_orderkey, o_totalprice from orders order by {H7}, o_orderkey limit 1000""")
def sample_n(spark, folder):
    return op.sample_dataframe(_orders(spark, folder, "o_totalprice"), "o_orderkey", n=1000, seed=7)


@query("sample_null_keys", "select 60::bigint as rows, 60::bigint as distinct_rows")
def sample_null_keys(spark, folder):
    """Half of the keys are null and the others repeat: the sample still has the wanted number of different rows."""
    df = _orders(spark, folder, "o_totalprice", "o_custkey").withColumn(
        "k", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey") % 5))
    found = op.sample_dataframe(df, "k", n=60, seed=3)
    return found.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("o_orderkey").alias("distinct_rows"))


@query("sample_frac", f"""
with t as (select o_orderkey, o_totalprice, row_number() over (order by {H7}, o_orderkey) as r, count(*) over () as n from orders)
select o_orderkey, o_totalprice from t where r <= floor(n * 0.1)""")
def sample_frac(spark, folder):
    return op.sample_dataframe(_orders(spark, folder, "o_totalprice"), "o_orderkey", frac=0.1, seed=7)


@query("dedup_train", """
with t as (select o_orderkey, o_custkey, o_orderstatus, case when o_orderkey % 5 = 0 then 'test' else 'train' end as _split from orders),
r as (select *, row_number() over (partition by o_custkey, o_orderstatus, _split order by o_orderkey) as n from t)
select o_orderkey, o_custkey, o_orderstatus, _split from r where _split = 'test' or n = 1""")
def dedup_train(spark, folder):
    df = _orders(spark, folder, "o_custkey", "o_orderstatus").withColumn(
        "_split", F.when(F.col("o_orderkey") % 5 == 0, "test").otherwise("train"))
    return op.drop_duplicates_keep_first(df, ["o_custkey", "o_orderstatus"], "o_orderkey", only_split="train")


@query("union_split", """
select o_orderkey, o_totalprice, 'train' as _split from orders where o_orderkey % 5 <> 0
union all select o_orderkey, null, 'test' from orders where o_orderkey % 5 = 0""")
def union_split(spark, folder):
    df = _orders(spark, folder, "o_totalprice")
    test = df.filter(F.col("o_orderkey") % 5 == 0).drop("o_totalprice")
    return op.union_splits({"train": df.filter(F.col("o_orderkey") % 5 != 0),
                            "test": op.add_missing_target(test, "o_totalprice")})


@query("resplit", "select o_orderkey, o_totalprice from orders where o_orderkey % 5 = 0")
def resplit(spark, folder):
    df = _orders(spark, folder, "o_totalprice")
    both = op.union_splits({"train": df.filter(F.col("o_orderkey") % 5 != 0), "test": df.filter(F.col("o_orderkey") % 5 == 0)})
    return op.take_split(both, "test")


@query("row_index", """
select o_orderkey, o_custkey, row_number() over (order by o_custkey, o_orderkey) - 1 as row_index from orders""")
def row_index(spark, folder):
    return op.with_row_index(_orders(spark, folder, "o_custkey"), ["o_custkey", "o_orderkey"])

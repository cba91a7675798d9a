"""Target and prediction transforms."""

from pyspark.sql import functions as F

from catalog import query, rnd, rounded, table
from foldwise import operators as op

PRICE = "o_totalprice"


def _orders(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", PRICE)


def _round_trip(spark, folder, method, digits):
    df = _orders(spark, folder)
    model = op.fit_target_transform(df, PRICE, method)
    there = model.transform(df, PRICE, "forward")
    back = model.reverse(there, "forward", "back")
    return back.select("o_orderkey", rnd("forward", digits).alias("forward"), rnd("back", 3).alias("back"))


@query("tgt_log", "select o_orderkey, round(ln(o_totalprice), 6) as forward, round(o_totalprice, 3) as back from orders")
def tgt_log(spark, folder):
    return _round_trip(spark, folder, "log", 6)


@query("tgt_log1p", "select o_orderkey, round(ln(1 + o_totalprice), 6) as forward, round(o_totalprice, 3) as back from orders")
def tgt_log1p(spark, folder):
    return _round_trip(spark, folder, "log1p", 6)


@query("tgt_standard", """
select o_orderkey, round((o_totalprice - (select avg(o_totalprice) from orders)) / (select stddev_samp(o_totalprice) from orders), 6) + 0.0 as forward,
       round(o_totalprice, 3) as back from orders""")
def tgt_standard(spark, folder):
    return _round_trip(spark, folder, "standard", 6)


@query("tgt_minmax", """
with s as (select min(o_totalprice) as lo, max(o_totalprice) as hi from orders)
select o_orderkey, round((o_totalprice - lo) / (hi - lo), 6) + 0.0 as forward, round(o_totalprice, 3) as back from orders, s""")
def tgt_minmax(spark, folder):
    return _round_trip(spark, folder, "minmax", 6)


EDGES = """
n as (select count(*) as c from train),
o as (select v, row_number() over (order by v) - 1 as r from train),
e as (select distinct v from o, n where r in (0, round((c - 1) * 0.2), round((c - 1) * 0.4), round((c - 1) * 0.6),
      round((c - 1) * 0.8), c - 1))"""


@query("tgt_bin", f"""
with train as (select o_orderkey as k, o_totalprice as v from orders where o_orderkey % 5 <> 0), {EDGES},
seen as (select b, row_number() over (order by b) - 1 as i from (select distinct (select count(*) from e where e.v <= train.v) as b from train)),
t as (select o_orderkey, (select count(*) from e where e.v <= o_totalprice) as b from orders)
select o_orderkey, cast(i as integer) as bin from t left join seen using (b)""")
def tgt_bin(spark, folder):
    df = _orders(spark, folder)
    model = op.fit_target_transform(df.filter(F.col("o_orderkey") % 5 != 0), PRICE, "binning", n_bins=5)
    return model.transform(df, PRICE, "bin").select("o_orderkey", "bin")


@query("tgt_unbin", f"""
with train as (select o_orderkey as k, o_totalprice as v from orders), {EDGES},
m as (select row_number() over (order by v) - 1 as i, (v + lead(v) over (order by v)) / 2 as middle, count(*) over () as c from e)
select o_orderkey, round(middle, 4) as middle from orders join m on m.i = least(o_orderkey % 9, c - 2)""")
def tgt_unbin(spark, folder):
    df = _orders(spark, folder)
    model = op.fit_target_transform(df, PRICE, "binning", n_bins=5)
    return model.reverse(df.withColumn("middle", F.col("o_orderkey") % 9), "middle").select(
        "o_orderkey", rnd("middle", 4).alias("middle"))


LINES = "select l_orderkey, l_linenumber, nullif(l_quantity, 4) as y, l_discount * 100 as f from lineitem"


def _lines(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.nullif("l_quantity", F.lit(4.0)).alias("y"), (F.col("l_discount") * 100).alias("f"))


@query("tgt_norm", f"""
select l_orderkey, l_linenumber, round(case when y is null then null when f = 0 then -1 else y / nullif(f, 0) end, 6) + 0.0 as divided,
       round(y - f, 6) + 0.0 as subtracted from ({LINES})""")
def tgt_norm(spark, folder):
    df = op.normalize_target_by_feature(_lines(spark, folder), "y", "f", "divide", "divided", -1.0)
    df = op.normalize_target_by_feature(df, "y", "f", "subtract", "subtracted")
    return rounded(df.drop("y", "f"), {"divided": 6, "subtracted": 6})


@query("tgt_denorm", f"""
select l_orderkey, l_linenumber, round(y * f, 6) + 0.0 as multiplied, round(y + f, 6) + 0.0 as added from ({LINES})""")
def tgt_denorm(spark, folder):
    df = op.denormalize_predictions_by_feature(_lines(spark, folder), "y", "f", "divide", "multiplied")
    df = op.denormalize_predictions_by_feature(df, "y", "f", "subtract", "added")
    return rounded(df.drop("y", "f"), {"multiplied": 6, "added": 6})


@query("tgt_composed", f"""
select l_orderkey, l_linenumber, round(ln(1 + y / nullif(f, 0)), 6) + 0.0 as label,
       round((exp(ln(1 + y / nullif(f, 0))) - 1) * f, 6) + 0.0 as back from ({LINES})""")
def tgt_composed(spark, folder):
    df = _lines(spark, folder).withColumn("f", F.nullif("f", F.lit(0.0)))
    df = op.normalize_target_by_feature(df, "y", "f", "divide", "label")
    log = op.fit_target_transform(df, "label", "log1p")
    df = log.reverse(log.transform(df, "label"), "label", "back")
    df = op.denormalize_predictions_by_feature(df, "back", "f")
    return rounded(df.drop("y", "f"), {"label": 6, "back": 6})


@query("hard_clip", """
select o_orderkey, case when o_totalprice < 100000 then 100000.0 when o_totalprice > 300000 then 300000.0 else o_totalprice end as clipped,
       greatest(o_totalprice, 100000.0) as floored from orders""")
def hard_clip(spark, folder):
    df = op.clip_predictions(_orders(spark, folder), PRICE, 100000, 300000, out="clipped")
    return op.clip_predictions(df, PRICE, low=100000, out="floored").select("o_orderkey", "clipped", "floored")


@query("soft_clip", """
with t as (select o_orderkey, greatest(o_totalprice, 50000.0) as p from orders)
select o_orderkey, round(case when p > 200000 then 200000 + ln(1 + p - 200000) else p end, 6) + 0.0 as soft from t""")
def soft_clip(spark, folder):
    df = op.clip_predictions(_orders(spark, folder), PRICE, low=50000, soft_above=200000, out="soft")
    return df.select("o_orderkey", rnd("soft").alias("soft"))

"""Casts, projections, missing values and scaling."""

from pyspark.sql import functions as F

from catalog import query, rnd, rounded, table
from foldwise import functions as fn
from foldwise import operators as op

LINE = ["l_orderkey", "l_linenumber"]


def _lineitem(spark, folder, *columns):
    return table(spark, folder, "lineitem").select(*LINE, *columns)


@query("clip", """
select l_orderkey, l_linenumber,
       case when l_quantity < 10 then 10.0 when l_quantity > 40 then 40.0 else l_quantity end as l_quantity,
       case when l_extendedprice > 50000 then 50000.0 else l_extendedprice end as l_extendedprice
from lineitem""")
def clip(spark, folder):
    df = _lineitem(spark, folder, "l_quantity", "l_extendedprice")
    return fn.clip_numerical_features(df, {"l_quantity": (10, 40), "l_extendedprice": (None, 50000)})



@query("threshold_replace", """
select l_orderkey, l_linenumber,
       case when nullif(l_quantity, 7) > 40 then 0.0 else nullif(l_quantity, 7) end as l_quantity
from lineitem""")
def threshold_replace(spark, folder):
    q = F.nullif(F.col("l_quantity"), F.lit(7.0))
    return _lineitem(spark, folder, "l_quantity").withColumn("l_quantity", fn.replace_above(q, 40, 0.0))


@query("map_values", """
select o_orderkey,
       cast(case o_orderstatus when 'F' then 1 when 'O' then 2 end as tinyint) as status_code,
       cast(case o_orderstatus when 'F' then 1 when 'O' then 2 else 9 end as tinyint) as status_or_9
from orders""")
def map_values(spark, folder):
    status, codes = F.col("o_orderstatus"), {"F": 1, "O": 2}
    return table(spark, folder, "orders").select(
        "o_orderkey", fn.map_values(status, codes).alias("status_code"),
        fn.map_values(status, codes, default=9).alias("status_or_9"))


@query("strip_prefix", """
select c_custkey, cast(replace(c_name, 'Customer#', '') as integer) as c_number from customer""")
def strip_prefix(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey", fn.strip_prefix(F.col("c_name"), "Customer#").alias("c_number"))


@query("power_cols", """
select l_orderkey, l_linenumber, l_extendedprice,
       round(sqrt(l_extendedprice), 6) + 0.0 as l_extendedprice_sqrt,
       round(l_extendedprice * l_extendedprice, 2) + 0.0 as l_extendedprice_squared
from lineitem""")
def power_cols(spark, folder):
    df = fn.power_columns(_lineitem(spark, folder, "l_extendedprice"), "l_extendedprice")
    return rounded(df, {"l_extendedprice_sqrt": 6, "l_extendedprice_squared": 2})


@query("ratio_col", """
select l_orderkey, l_linenumber,
       round(l_extendedprice / nullif(power(l_quantity / 100, 2), 0), 2) + 0.0 as density,
       round(l_tax / nullif(l_discount, 0), 6) + 0.0 as tax_share
from lineitem""")
def ratio_col(spark, folder):
    density = fn.ratio_of(F.col("l_extendedprice"), F.pow(F.col("l_quantity") / 100, F.lit(2.0)))
    return _lineitem(spark, folder, "l_extendedprice", "l_quantity", "l_tax", "l_discount").select(
        *LINE, rnd(density, 2).alias("density"),
        rnd(fn.ratio_of(F.col("l_tax"), F.col("l_discount"))).alias("tax_share"))


@query("bin_floor", """
select c_custkey,
       concat(cast(cast(floor(c_acctbal / 500) * 500 as bigint) as varchar), '.0') as balance_bin
from customer""")
def bin_floor(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey", fn.bin_floor_text(F.col("c_acctbal"), 500).alias("balance_bin"))


@query("bin_trunc", """
select c_custkey, cast(cast(trunc(c_acctbal / 500) as bigint) * 500 as varchar) as balance_bin from customer""")
def bin_trunc(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey", fn.bin_trunc_text(F.col("c_acctbal"), 500).alias("balance_bin"))


@query("round_cat", """
select event_id, cast(round(value, 1) as varchar) as value_1, cast(cast(floor(value / 10) as bigint) as varchar) as value_tens
from events""")
def round_cat(spark, folder):
    v = F.col("value")
    return table(spark, folder, "events").select(
        "event_id", fn.round_text(v, 1).alias("value_1"), fn.floor_text(v, 10).alias("value_tens"))


@query("drop_null_target", """
select event_id, value from events where event_type <> 'click'""")
def drop_null_target(spark, folder):
    df = table(spark, folder, "events").select(
        "event_id", F.when(F.col("event_type") != "click", F.col("value")).alias("value"))
    return op.drop_null_target(df, "value")


@query("coerce_schema", """
select o_orderkey, try_cast(o_orderpriority as double) as o_orderpriority,
       try_cast(left(o_orderpriority, 1) as double) as rank_text, cast(o_custkey as varchar) as o_custkey
from orders""")
def coerce_schema(spark, folder):
    df = table(spark, folder, "orders").select(
        "o_orderkey", "o_orderpriority", F.substring("o_orderpriority", 1, 1).alias("rank_text"), "o_custkey")
    return op.coerce_schema(df, ["o_orderpriority", "rank_text", "absent"], ["o_custkey"])


@query("select_by_type", """
select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax from lineitem""")
def select_by_type(spark, folder):
    from foldwise.frame import numeric_columns

    df = table(spark, folder, "lineitem")
    return df.select(*numeric_columns(df))


@query("float_cast", """
select l_orderkey, round(cast(cast(l_quantity as float) as double), 6) as l_quantity,
       round(cast(cast(l_discount as float) as double), 6) as l_discount, l_extendedprice from lineitem""")
def float_cast(spark, folder):
    df = table(spark, folder, "lineitem").select("l_quantity", "l_discount", "l_extendedprice", "l_orderkey")
    cast = fn.add_float_casts(df.drop("l_orderkey"), target="l_extendedprice")
    both = fn.add_float_casts(df, target="l_extendedprice").withColumn("l_orderkey", F.col("l_orderkey").cast("bigint"))
    assert cast.columns == df.columns[:3]
    return both.select("l_orderkey", rnd("l_quantity").alias("l_quantity"), rnd("l_discount").alias("l_discount"),
                       "l_extendedprice")


@query("compact_schema", """
select p_partkey, p_brand, p_size, round(cast(cast(p_retailprice as float) as double), 4) as p_retailprice,
       case when min(p_size) over () >= -128 and max(p_size) over () <= 127 then 'tinyint' else 'wider' end as size_type
from part""")
def compact_schema(spark, folder):
    df = table(spark, folder, "part").select("p_partkey", "p_brand", "p_size", "p_retailprice")
    plan = op.compact_schema(df)
    out = plan.transform(df)
    return out.select(
        F.col("p_partkey").cast("bigint").alias("p_partkey"), "p_brand", F.col("p_size").cast("int").alias("p_size"),
        rnd("p_retailprice", 4).alias("p_retailprice"),
        F.lit("tinyint" if out.schema["p_size"].dataType.simpleString() == "tinyint" else "wider").alias("size_type"))


@query("null_nan_check", """
select 'value' as "column", count(*) as rows, count(nullif(event_type, 'click')) as non_null,
       count(case when event_type = 'error' then 1 end) as nan, count(case when event_type = 'view' then 1 end) as infinite
from events""")
def null_nan_check(spark, folder):
    kind = F.col("event_type")
    df = table(spark, folder, "events").select(
        F.when(kind == "click", F.lit(None)).when(kind == "error", F.lit(float("nan")))
        .when(kind == "view", F.lit(float("inf"))).otherwise(F.col("value")).alias("value"))
    return op.check_values(df, ["value"])


# --- missing values -------------------------------------------------------

HOLES = """
select event_id, case when event_id % 7 <> 0 then value end as value,
       nullif(event_type, 'purchase') as event_type, case when event_id % 3 <> 0 then user_id end as user_id
from events"""


def _holes(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"),
        F.nullif(F.col("event_type"), F.lit("purchase")).alias("event_type"),
        F.when(F.col("event_id") % 3 != 0, F.col("user_id")).alias("user_id"))


@query("impute_mean", f"""
with t as ({HOLES})
select event_id, round(coalesce(value, (select avg(value) from t)), 6) as value, event_type,
       round(coalesce(user_id, (select avg(user_id) from t)), 6) as user_id from t""")
def impute_mean(spark, folder):
    return rounded(op.handle_missing_values(_holes(spark, folder), "mean"), {"value": 6, "user_id": 6})


@query("impute_median", f"""
with t as ({HOLES})
select event_id, coalesce(value, (select median(value) from t)) as value, event_type,
       cast(coalesce(user_id, (select median(user_id) from t)) as double) as user_id from t""")
def impute_median(spark, folder):
    return op.handle_missing_values(_holes(spark, folder), "median")


@query("impute_mode", f"""
with t as ({HOLES}),
m1 as (select event_type from t where event_type is not null group by 1 order by count(*) desc, 1 limit 1),
m2 as (select user_id from t where user_id is not null group by 1 order by count(*) desc, 1 limit 1)
select event_id, value, coalesce(event_type, (select event_type from m1)) as event_type,
       coalesce(user_id, (select user_id from m2)) as user_id from t""")
def impute_mode(spark, folder):
    return op.handle_missing_values(_holes(spark, folder), "mode")


@query("impute_zero", f"""
with t as ({HOLES}) select event_id, coalesce(value, 0.0) as value, event_type, coalesce(user_id, 0) as user_id from t""")
def impute_zero(spark, folder):
    return op.handle_missing_values(_holes(spark, folder), "zero")


@query("impute_literal", f"""
with t as ({HOLES}) select event_id, value, coalesce(event_type, 'unknown') as event_type, user_id from t""")
def impute_literal(spark, folder):
    return op.handle_missing_values(_holes(spark, folder), "literal", ["event_type"], "unknown")


@query("impute_fit_apply", f"""
with t as ({HOLES}), train as (select * from t where event_id % 5 <> 0)
select event_id, coalesce(value, (select median(value) from train)) as value, event_type, user_id
from t where event_id % 5 = 0""")
def impute_fit_apply(spark, folder):
    df = _holes(spark, folder)
    train, test = df.filter(F.col("event_id") % 5 != 0), df.filter(F.col("event_id") % 5 == 0)
    return op.fit_imputer(train, "median", ["value"]).transform(test)


# --- scaling --------------------------------------------------------------

SCALED = ["l_quantity", "l_extendedprice"]


def _scaled(spark, folder, kind, digits=6, **options):
    df = _lineitem(spark, folder, *SCALED)
    train = df.filter(F.col("l_orderkey") % 5 != 0)
    return rounded(op.fit_scaler(train, SCALED, kind, **options).transform(df), dict.fromkeys(SCALED, digits))


@query("scale_standard", """
with s as (select avg(l_quantity) as aq, stddev_pop(l_quantity) as sq, avg(l_extendedprice) as ap, stddev_pop(l_extendedprice) as sp
           from lineitem where l_orderkey % 5 <> 0)
select l_orderkey, l_linenumber, round((l_quantity - aq) / sq, 6) + 0.0 as l_quantity,
       round((l_extendedprice - ap) / sp, 6) + 0.0 as l_extendedprice from lineitem, s""")
def scale_standard(spark, folder):
    return _scaled(spark, folder, "standard")


@query("scale_minmax", """
with s as (select min(l_quantity) as aq, max(l_quantity) - min(l_quantity) as sq, min(l_extendedprice) as ap,
                  max(l_extendedprice) - min(l_extendedprice) as sp from lineitem where l_orderkey % 5 <> 0)
select l_orderkey, l_linenumber, round((l_quantity - aq) / sq * 2 - 1, 6) + 0.0 as l_quantity,
       round((l_extendedprice - ap) / sp * 2 - 1, 6) + 0.0 as l_extendedprice from lineitem, s""")
def scale_minmax(spark, folder):
    return _scaled(spark, folder, "minmax", feature_range=(-1, 1))


@query("scale_robust", """
with s as (select median(l_quantity) as aq, quantile_cont(l_quantity, 0.75) - quantile_cont(l_quantity, 0.25) as sq,
                  median(l_extendedprice) as ap,
                  quantile_cont(l_extendedprice, 0.75) - quantile_cont(l_extendedprice, 0.25) as sp
           from lineitem where l_orderkey % 5 <> 0)
select l_orderkey, l_linenumber, round((l_quantity - aq) / sq, 6) + 0.0 as l_quantity,
       round((l_extendedprice - ap) / sp, 6) + 0.0 as l_extendedprice from lineitem, s""")
def scale_robust(spark, folder):
    return _scaled(spark, folder, "robust")

"""Categorical, count, ratio, target and binned encodings."""

import uuid

from pyspark.sql import functions as F

from catalog import query, rounded, table
from foldwise import operators as op
from foldwise.frame import work_folder
from foldwise.sources import load_model, save_model

# --- target statistics ----------------------------------------------------

SALES = """
select o_orderkey, cast(o_orderkey % 5 as integer) as fold, c_mktsegment as segment,
       nullif(o_orderpriority, '5-LOW') as priority, o_custkey as customer, o_totalprice as price
from orders join customer on o_custkey = c_custkey"""
FEATURES = ["segment", "priority", "customer"]


def sales(spark, folder):
    orders, customer = table(spark, folder, "orders"), table(spark, folder, "customer")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", (F.col("o_orderkey") % 5).cast("int").alias("fold"), F.col("c_mktsegment").alias("segment"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"), F.col("o_custkey").alias("customer"),
        F.col("o_totalprice").alias("price"))


def _oof_sql(stat, features, smoothing, prior="fold"):
    """Out-of-fold statistic of each feature, by joining each fold to the other folds' rows."""
    parts, joins, outs = [], [], []
    for f in features:
        parts.append(f"""e_{f} as (select f.fold, t.{f}, {stat} as s, count(t.price) as n
            from folds f join t on t.fold <> f.fold where t.{f} is not null group by 1, 2)""")
        joins.append(f"left join e_{f} on e_{f}.fold = t.fold and e_{f}.{f} = t.{f}")
        p = "p.s" if prior == "fold" else "g.s"
        value = f"(e_{f}.n * e_{f}.s + {smoothing} * {p}) / (e_{f}.n + {smoothing})" if smoothing else f"e_{f}.s"
        outs.append(f"round(coalesce({value}, {p}), 3) + 0.0 as {f}_te")
    return f"""with t as ({SALES}), folds as (select distinct fold from t),
        p as (select f.fold, {stat} as s from folds f join t on t.fold <> f.fold group by 1),
        g as (select {stat} as s from t), {', '.join(parts)}
        select t.o_orderkey, {', '.join(outs)} from t join p on p.fold = t.fold cross join g {' '.join(joins)}"""


def _oof(spark, folder, features, **options):
    train, _ = op.apply_target_encoding(sales(spark, folder), features, "price", "fold", folds=range(5), **options)
    names = [f"{f}_te" for f in features]
    return rounded(train.select("o_orderkey", *names), dict.fromkeys(names, 3))


@query("te_mean_oof", _oof_sql("avg(t.price)", FEATURES, 10.0))
def te_mean_oof(spark, folder):
    return _oof(spark, folder, FEATURES)


@query("te_median_oof", _oof_sql("median(t.price)", ["segment", "priority"], 10.0))
def te_median_oof(spark, folder):
    return _oof(spark, folder, ["segment", "priority"], agg_stat="median")


@query("te_percentile_oof", _oof_sql("quantile_cont(t.price, 0.9)", ["segment", "priority"], 0))
def te_percentile_oof(spark, folder):
    return _oof(spark, folder, ["segment", "priority"], agg_stat="percentile", percentile=90, use_smoothing=False)


@query("te_raw_global", _oof_sql("avg(t.price)", ["segment", "priority"], 0, "global"))
def te_raw_global(spark, folder):
    return _oof(spark, folder, ["segment", "priority"], use_smoothing=False, prior="global")


@query("te_mean_test", f"""
with t as ({SALES}), train as (select * from t where fold <> 0), g as (select avg(price) as s from train),
e1 as (select segment, avg(price) as s, count(price) as n from train where segment is not null group by 1),
e2 as (select priority, avg(price) as s, count(price) as n from train where priority is not null group by 1),
e3 as (select customer, avg(price) as s, count(price) as n from train group by 1)
select o_orderkey, round(coalesce((e1.n * e1.s + 10 * g.s) / (e1.n + 10), g.s), 3) as segment_te,
       round(coalesce((e2.n * e2.s + 10 * g.s) / (e2.n + 10), g.s), 3) as priority_te,
       round(coalesce((e3.n * e3.s + 10 * g.s) / (e3.n + 10), g.s), 3) as customer_te
from t cross join g left join e1 on e1.segment = t.segment left join e2 on e2.priority = t.priority
left join e3 on e3.customer = t.customer where fold = 0""")
def te_mean_test(spark, folder):
    rows = sales(spark, folder)
    train, test = rows.filter("fold <> 0"), rows.filter("fold = 0")
    model = op.fit_target_encoder(train, FEATURES, "price", "fold", folds=range(1, 5))
    names = [f"{f}_te" for f in FEATURES]
    return rounded(model.transform(test).select("o_orderkey", *names), dict.fromkeys(names, 3))


HASHED = "cast('0x' || substr(md5('3|' || o_orderkey), 1, 8) as bigint)"


def _before(f, what):
    return f"{what} over (partition by {f} order by {HASHED}, o_orderkey rows between unbounded preceding and 1 preceding)"


@query("te_ordered", f"""
with t as ({SALES}), g as (select avg(price) as m from t)
select o_orderkey, {', '.join(f"round(case when {f} is null then g.m else (coalesce({_before(f, 'sum(price)')}, 0) + 2 * g.m) / ({_before(f, 'count(price)')} + 2) end, 3) as {f}_ots" for f in FEATURES)}
from t, g""")
def te_ordered(spark, folder):
    """Each order is encoded from the orders before it in a hashed order."""
    rows = sales(spark, folder)
    model = op.fit_ordered_target_encoder(rows, FEATURES, "price", "o_orderkey", seed=3, smoothing=2.0)
    names = [f"{f}_ots" for f in FEATURES]
    return rounded(model.transform_train(rows).select("o_orderkey", *names), dict.fromkeys(names, 3))


def _relation_sql(relation):
    """Target means per fold of a relation r(o_orderkey, fold, role), for each row that a fold measures."""
    parts = [f"""e_{f} as (select r.fold, t.{f}, avg(price) as s, count(price) as n from r join t using (o_orderkey)
        where r.role = 'train' and t.{f} is not null group by 1, 2)""" for f in FEATURES]
    outs = [f"round(coalesce((e_{f}.n * e_{f}.s + 10 * p.s) / (e_{f}.n + 10), p.s), 3) as {f}_te" for f in FEATURES]
    joins = [f"left join e_{f} on e_{f}.fold = v.fold and e_{f}.{f} = t.{f}" for f in FEATURES]
    return f"""with t as ({SALES}), r as ({relation}), v as (select o_orderkey, fold from r where role = 'valid'),
        p as (select r.fold, avg(price) as s from r join t using (o_orderkey) where r.role = 'train' group by 1), {', '.join(parts)}
        select t.o_orderkey, v.fold, {', '.join(outs)} from t left join v using (o_orderkey) left join p on p.fold = v.fold {' '.join(joins)}"""


def _relation_encoded(rows, relation):
    model = op.fit_relation_target_encoder(rows, FEATURES, "price", "o_orderkey", relation)
    names = [f"{f}_te" for f in FEATURES]
    return rounded(model.transform_pairs(rows, relation).select("o_orderkey", "fold", *names), dict.fromkeys(names, 3))


@query("te_relation_overlap", _relation_sql("""
select o_orderkey, f.fold, case when o_orderkey % 7 in (f.fold, f.fold + 1) then 'valid' else 'train' end as role
from t, (select unnest([0, 1, 2, 3])::int as fold) f where o_orderkey % 7 <> 6 or f.fold = 0"""))
def te_relation_overlap(spark, folder):
    """Overlapping folds: most rows measure two of them, some none."""
    rows = sales(spark, folder)
    place = F.col("o_orderkey") % 7
    relation = op.folds_of_conditions(rows, "o_orderkey", [
        ((place != 6) | F.lit(i == 0), place.isin(i, i + 1)) for i in range(4)])
    return _relation_encoded(rows, relation)


@query("te_relation_expanding", _relation_sql("""
select o_orderkey, f.fold, case when block = f.fold + 1 then 'valid' else 'train' end as role
from (select o_orderkey, ntile(6) over (order by o_orderkey) - 1 as block from t), (select unnest([1, 2, 3, 4])::int as fold) f
where block = f.fold + 1 or block <= f.fold - 1"""))
def te_relation_expanding(spark, folder):
    """Each block is encoded from the blocks before it but for one left out between them."""
    rows = sales(spark, folder)
    return _relation_encoded(rows, op.expanding_folds(rows, "o_orderkey", 5, gap=1))


BASE = {"flag": "l_returnflag", "status": "l_linestatus", "mode": "month(l_shipdate)::varchar", "line": "l_linenumber::varchar", "disc": "round(l_discount * 100)::int::varchar",
        "tax": "round(l_tax * 100)::int::varchar", "bulk": "(l_quantity >= 25)::int::varchar"}


@query("te_crossed", f"""
with t as (select l_orderkey, l_linenumber, l_partkey, l_extendedprice as price, cast(l_orderkey % 3 as integer) as fold,
                  {', '.join(f"{e} as {n}" for n, e in BASE.items())} from lineitem),
p as (select f.fold, avg(price) as s from (select distinct fold from t) f join t on t.fold <> f.fold group by 1),
c as (select *, flag || '_' || mode as c2, status || '_' || line || '_' || bulk as c3, flag || '_' || status || '_' || mode || '_' || disc as c4 from t),
{', '.join(f"e{i} as (select f.fold, c.c{i}, avg(price) as s, count(*) as n from p f join c on c.fold <> f.fold group by 1, 2), k{i} as (select c{i}, count(*) as n from c group by 1)" for i in (2, 3, 4))}
select l_orderkey, l_linenumber, l_partkey, {', '.join(f"round(coalesce((e{i}.n * e{i}.s + 10 * p.s) / (e{i}.n + 10), p.s), 3) as te{i}, k{i}.n as n{i}" for i in (2, 3, 4))}
from c join p on p.fold = c.fold {' '.join(f"left join e{i} on e{i}.fold = c.fold and e{i}.c{i} = c.c{i} join k{i} on k{i}.c{i} = c.c{i}" for i in (2, 3, 4))}""")
def te_crossed(spark, folder):
    """91 crossings of seven columns from one scan; three of them are compared."""
    line = table(spark, folder, "lineitem")
    rows = line.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_extendedprice").alias("price"), (F.col("l_orderkey") % 3).cast("int").alias("fold"),
        F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"), F.month("l_shipdate").cast("string").alias("mode"),
        F.col("l_linenumber").cast("string").alias("line"), F.round(F.col("l_discount") * 100).cast("int").cast("string").alias("disc"),
        F.round(F.col("l_tax") * 100).cast("int").cast("string").alias("tax"), (F.col("l_quantity") >= 25).cast("int").cast("string").alias("bulk"))
    model = op.fit_crossed_encoder(rows, list(BASE), [2, 3, 4], "price", "fold", folds=range(3))
    found = model.transform_train(rows)
    crossed = {2: "flag_mode_inter2", 3: "status_line_bulk_inter3", 4: "flag_status_mode_disc_inter4"}
    return rounded(found.select("l_orderkey", "l_linenumber", "l_partkey", *[F.col(f"{c}_te").alias(f"te{i}") for i, c in crossed.items()],
                                *[F.col(f"{c}_count").alias(f"n{i}") for i, c in crossed.items()]), {f"te{i}": 3 for i in crossed})


@query("te_saved", _oof_sql("avg(t.price)", FEATURES, 10.0))
def te_saved(spark, folder):
    """Encoded by a model that was written and read again."""
    rows, path = sales(spark, folder), f"{work_folder(spark)}/model-{uuid.uuid4().hex}"
    save_model(op.fit_target_encoder(rows, FEATURES, "price", "fold", folds=range(5)), path, spark)
    names = [f"{f}_te" for f in FEATURES]
    return rounded(load_model(spark, path).transform_train(rows).select("o_orderkey", *names), dict.fromkeys(names, 3))


# --- counts ---------------------------------------------------------------

LINES = """
select l_orderkey, l_linenumber, nullif(l_returnflag, 'N') as flag, l_partkey as part, l_suppkey as supplier
from lineitem"""
COUNTED = ["flag", "part", "supplier"]


def _lines(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.nullif("l_returnflag", F.lit("N")).alias("flag"),
        F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier"))


def _count_sql(source, rows, value="n", other="0"):
    parts, outs, joins = [], [], []
    for f in COUNTED:
        parts.append(f"c_{f} as (select {f}, count(*) as n, sum(count(*)) over () as total from src where {f} is not null group by 1)")
        outs.append(f"coalesce({value.replace('n', f'c_{f}.n') if value == 'n' else f'round(c_{f}.n / c_{f}.total, 9)'}, {other}) as {f}_count")
        joins.append(f"left join c_{f} on c_{f}.{f} = t.{f}")
    return f"""with t as ({LINES}), src as (select * from t where {source}), {', '.join(parts)}
        select t.l_orderkey, t.l_linenumber, {', '.join(outs)} from t {' '.join(joins)} where {rows}"""


def _counts(spark, folder, which, **options):
    df = _lines(spark, folder)
    train, test = df.filter(F.col("l_orderkey") % 5 != 0), df.filter(F.col("l_orderkey") % 5 == 0)
    out = op.apply_count_encoding(train, COUNTED, test, **options)[0 if which == "train" else 1]
    return out.select("l_orderkey", "l_linenumber", *[f"{f}_count" for f in COUNTED])


@query("count_enc_train", _count_sql("l_orderkey % 5 <> 0", "t.l_orderkey % 5 <> 0"))
def count_enc_train(spark, folder):
    return _counts(spark, folder, "train", count_on="train")


@query("count_enc_unseen", _count_sql("l_orderkey % 5 <> 0", "t.l_orderkey % 5 = 0"))
def count_enc_unseen(spark, folder):
    return _counts(spark, folder, "test", count_on="train")


@query("count_enc_test", _count_sql("l_orderkey % 5 = 0", "t.l_orderkey % 5 <> 0"))
def count_enc_test(spark, folder):
    return _counts(spark, folder, "train", count_on="test")


@query("count_enc_combined", _count_sql("true", "t.l_orderkey % 5 = 0"))
def count_enc_combined(spark, folder):
    return _counts(spark, folder, "test", count_on="combined")


@query("freq_enc", _count_sql("l_orderkey % 5 <> 0", "t.l_orderkey % 5 = 0", "share", "0.0"))
def freq_enc(spark, folder):
    out = _counts(spark, folder, "test", count_on="train", normalize=True)
    return rounded(out, {f"{f}_count": 9 for f in COUNTED})


# --- ratio to category mean -----------------------------------------------


@query("ratio_enc", """
with t as (select l_orderkey, l_linenumber, nullif(l_returnflag, 'N') as flag, l_extendedprice as price,
                  nullif(l_quantity, 5) as quantity from lineitem),
m as (select flag, avg(price) as mp, avg(quantity) as mq from t group by 1)
select l_orderkey, l_linenumber,
       round(case when price is not null and mp <> 0 then price / mp else 1 end, 6) + 0.0 as price_ratio_to_flag_mean,
       round(case when quantity is not null and mq <> 0 then quantity / mq else 1 end, 6) + 0.0 as quantity_ratio_to_flag_mean
from t left join m on t.flag is not distinct from m.flag""")
def ratio_enc(spark, folder):
    df = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.nullif("l_returnflag", F.lit("N")).alias("flag"),
        F.col("l_extendedprice").alias("price"), F.nullif("l_quantity", F.lit(5.0)).alias("quantity"))
    out, _ = op.apply_ratio_to_category_mean_encoding(df, ["price", "quantity"], "flag")
    names = ["price_ratio_to_flag_mean", "quantity_ratio_to_flag_mean"]
    return rounded(out.select("l_orderkey", "l_linenumber", *names), dict.fromkeys(names, 6))


# --- one-hot, ordinal, label ----------------------------------------------


@query("onehot", """
select o_orderkey, case when o_orderstatus = 'F' then 1.0::double else 0.0 end as "o_orderstatus_F",
       case when o_orderstatus = 'O' then 1.0::double else 0.0 end as "o_orderstatus_O",
       case when o_orderstatus = 'P' then 1.0::double else 0.0 end as "o_orderstatus_P"
from orders""")
def onehot(spark, folder):
    df = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return op.fit_onehot(df, ["o_orderstatus"]).transform(df)


@query("ordinal", """
with t as (select p_partkey, p_brand, p_type from part),
b as (select p_brand, row_number() over (order by p_brand) - 1 as c from (select distinct p_brand from t where p_partkey % 2 = 0)),
y as (select p_type, row_number() over (order by p_type) - 1 as c from (select distinct p_type from t where p_partkey % 2 = 0))
select p_partkey, coalesce(b.c + 1, -1) as p_brand, coalesce(y.c + 1, -1) as p_type
from t left join b using (p_brand) left join y using (p_type)""")
def ordinal(spark, folder):
    df = table(spark, folder, "part").select("p_partkey", "p_brand", "p_type")
    model = op.fit_ordinal(df.filter("p_partkey % 2 = 0"), ["p_brand", "p_type"], "use_encoded_value", -1, add_one=True)
    return model.transform(df)


@query("label", """
select o_orderkey, dense_rank() over (order by o_orderpriority) - 1 as o_orderpriority,
       dense_rank() over (order by o_custkey) - 1 as o_custkey from orders""")
def label(spark, folder):
    df = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_custkey")
    return op.fit_label(df, ["o_orderpriority", "o_custkey"]).transform(df)


# --- bins -----------------------------------------------------------------


def _bin_columns(n, name="l_quantity"):
    return ", ".join(f"""case when b = {i} then 1.0::double else 0.0 end as "{name}_bin_{i}" """ for i in n)


@query("bin_onehot_quantile", f"""
with n as (select count(*) as c from lineitem),
o as (select l_quantity as v, row_number() over (order by l_quantity) - 1 as r from lineitem),
e as (select distinct v from o, n where r in (0, round((c - 1) * 0.25), round((c - 1) * 0.5), round((c - 1) * 0.75), c - 1)),
t as (select l_orderkey, l_linenumber, (select count(*) from e where e.v <= l.l_quantity) as b from lineitem l)
select l_orderkey, l_linenumber, {_bin_columns(range(1, 6))} from t""")
def bin_onehot_quantile(spark, folder):
    df = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return op.fit_bins(df, ["l_quantity"], 4).transform(df)


@query("bin_onehot_uniform", f"""
with s as (select min(l_quantity) as lo, max(l_quantity) as hi from lineitem),
t as (select l_orderkey, l_linenumber,
             (l_quantity >= lo)::int + (l_quantity >= lo + (hi - lo) / 4)::int + (l_quantity >= lo + 2 * ((hi - lo) / 4))::int
             + (l_quantity >= lo + 3 * ((hi - lo) / 4))::int + (l_quantity >= hi)::int as b from lineitem, s)
select l_orderkey, l_linenumber, {_bin_columns(range(1, 6))} from t""")
def bin_onehot_uniform(spark, folder):
    df = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return op.fit_bins(df, ["l_quantity"], 4, "uniform").transform(df)

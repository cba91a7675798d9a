"""Metrics, blends and the run log."""

import uuid

from pyspark.sql import functions as F

from catalog import query, rounded, table
from catalog.profiles import SCORED, scored
from foldwise import operators as op
from foldwise.frame import work_folder
from foldwise.sources import update_run_log, update_stored_run_log


@query("metric_regression", f"""
with t as ({SCORED})
select round(avg(power(y - p1, 2)), 2) as mse, round(sqrt(avg(power(y - p1, 2))), 4) as rmse, round(avg(abs(y - p1)), 4) as mae,
       round(avg(abs(y - p1) / abs(y)), 6) as mape, round(1 - sum(power(y - p1, 2)) / (var_pop(y) * count(*)), 6) as r2,
       round(avg(power(ln(1 + y) - ln(1 + p1), 2)), 6) as msle, round(sqrt(avg(power(ln(1 + y) - ln(1 + p1), 2))), 6) as rmsle from t""")
def metric_regression(spark, folder):
    names = ["mse", "rmse", "mae", "mape", "r2", "msle", "rmsle"]
    return rounded(op.evaluate(scored(spark, folder), "y", "p1", names),
                   {"mse": 2, "rmse": 4, "mae": 4, "mape": 6, "r2": 6, "msle": 6, "rmsle": 6})


CLASSES = """
select cast(o_orderpriority[1] as integer) - 1 as y, cast(floor(least(o_totalprice / 100000, 4)) as integer) as p,
       (o_orderstatus = 'F')::int as yb, round(o_totalprice / 600000, 2) as score from orders"""


def _classes(spark, folder):
    return table(spark, folder, "orders").select(
        (F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("y"),
        F.floor(F.least(F.col("o_totalprice") / 100000, F.lit(4.0))).cast("int").alias("p"),
        (F.col("o_orderstatus") == "F").cast("int").alias("yb"), F.round(F.col("o_totalprice") / 600000, 2).alias("score"))


def _class_sql(average):
    pick = {"macro": "avg({})", "weighted": "sum({} * t) / sum(t)", "micro": None}[average]
    scores = {"precision": "case when q = 0 then 0 else tp / q end", "recall": "case when t = 0 then 0 else tp / t end",
              "f1": "2 * tp / (t + q)"}
    micro = {"precision": "sum(tp) / sum(q)", "recall": "sum(tp) / sum(t)", "f1": "2 * sum(tp) / (sum(t) + sum(q))"}
    outs = ", ".join(f"round({micro[n] if pick is None else pick.format(e)}, 6) as {n}" for n, e in scores.items())
    return f"""with d as ({CLASSES}), c as (select y as k from d union select p from d),
        s as (select k, (select count(*) from d where y = k and p = k)::double as tp, (select count(*) from d where y = k)::double as t,
              (select count(*) from d where p = k)::double as q from c)
        select (select round(avg((y = p)::int), 6) from d) as accuracy, {outs},
               round(avg(case when t > 0 then tp / t end), 6) as balanced_accuracy from s"""


def _class_scores(spark, folder, average):
    names = ["accuracy", "precision", "recall", "f1", "balanced_accuracy"]
    return rounded(op.evaluate(_classes(spark, folder), "y", "p", names, average=average), dict.fromkeys(names, 6))


@query("metric_classification", _class_sql("macro"))
def metric_classification(spark, folder):
    return _class_scores(spark, folder, "macro")


@query("metric_weighted", _class_sql("weighted"))
def metric_weighted(spark, folder):
    return _class_scores(spark, folder, "weighted")


@query("metric_micro", _class_sql("micro"))
def metric_micro(spark, folder):
    return _class_scores(spark, folder, "micro")


@query("metric_binary", """
with d as (select quality as y, 1 - toxic as p from labels)
select round(avg((y = p)::int), 6) as accuracy, round(sum(y * p) / greatest(sum(p), 1), 6) as precision,
       round(sum(y * p) / greatest(sum(y), 1), 6) as recall, round(2 * sum(y * p) / greatest(sum(y) + sum(p), 1), 6) as f1 from d""")
def metric_binary(spark, folder):
    df = table(spark, folder, "labels").select(F.col("quality").alias("y"), (1 - F.col("toxic")).alias("p"))
    names = ["accuracy", "precision", "recall", "f1"]
    return rounded(op.evaluate(df, "y", "p", names), dict.fromkeys(names, 6))


@query("metric_auc", f"""
with d as ({CLASSES}), s as (select score, sum(yb)::double as pos, sum(1 - yb)::double as neg from d group by score),
r as (select pos, neg, coalesce(sum(neg) over (order by score rows between unbounded preceding and 1 preceding), 0) as below from s)
select round(sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)), 9) as roc_auc from r""")
def metric_auc(spark, folder):
    return rounded(op.evaluate(_classes(spark, folder), "yb", "score", ["roc_auc"]), {"roc_auc": 9})


CHANCES = """
select case l_returnflag when 'A' then 0 when 'N' then 1 else 2 end as label, l_quantity + 10 * (l_returnflag = 'A')::int as s0,
       l_discount * 100 + 4 * (l_returnflag = 'N')::int as s1, l_linenumber::double as s2 from lineitem"""


@query("metric_auc_classes", f"""
with d as ({CHANCES}), l as (
  select 0 as class, label, s0 as score from d union all select 1, label, s1 from d union all select 2, label, s2 from d),
n as (select label, count(*)::double as n from d group by label),
c as (select class, label, score, count(*)::double as k from l group by all),
e as (
  select p.class, q.label, sum(p.k * q.k * case when q.score < p.score then 1 when q.score = p.score then 0.5 else 0 end) as wins
  from c p join c q on q.class = p.class and p.label = p.class and q.label <> p.class group by all),
ovr as (select e.class, sum(wins) / (any_value(n.n) * ((select sum(n) from n) - any_value(n.n))) as area, any_value(n.n) as weight
        from e join n on n.label = e.class group by e.class),
ovo as (select least(e.class, e.label) as a, greatest(e.class, e.label) as b, avg(wins / (x.n * y.n)) as area, any_value(x.n + y.n) as weight
        from e join n x on x.label = e.class join n y on y.label = e.label group by 1, 2)
select round((select avg(area) from ovr), 9) as ovr_macro, round((select sum(area * weight) / sum(weight) from ovr), 9) as ovr_weighted,
       round((select avg(area) from ovo), 9) as ovo_macro, round((select sum(area * weight) / sum(weight) from ovo), 9) as ovo_weighted""")
def metric_auc_classes(spark, folder):
    """Area under the curve of three classes: each against the rest and in pairs, plain and weighted means."""
    flag = F.col("l_returnflag")
    rows = table(spark, folder, "lineitem").select(
        F.when(flag == "A", 0).when(flag == "N", 1).otherwise(2).alias("label"),
        F.array(F.col("l_quantity") + 10 * (flag == "A").cast("int"), F.col("l_discount") * 100 + 4 * (flag == "N").cast("int"),
                F.col("l_linenumber").cast("double")).alias("chances"))
    parts = {f"{m}_{a}": op.evaluate(rows, "label", "chances", ["roc_auc"], average=a, multi_class=m).withColumnRenamed("roc_auc", f"{m}_{a}")
             for m in ("ovr", "ovo") for a in ("macro", "weighted")}
    out = None
    for part in parts.values():
        part = part.withColumn("one", F.lit(1))
        out = part if out is None else out.join(part, "one")  # one row each
    return rounded(out.drop("one"), dict.fromkeys(parts, 9))


@query("metric_logloss", f"""
with d as (select yb, least(greatest(score, 2.220446049250313e-16), 1 - 2.220446049250313e-16) as p from ({CLASSES}))
select round(-avg(case when yb = 1 then ln(p) else ln(1 - p) end), 6) as logloss from d""")
def metric_logloss(spark, folder):
    return rounded(op.evaluate(_classes(spark, folder), "yb", "score", ["logloss"]), {"logloss": 6})


@query("metric_present_only", f"""
select round(sqrt(avg(power(y - p1, 2))), 4) as rmse from ({SCORED}) where fold <> 0""")
def metric_present_only(spark, folder):
    rows = scored(spark, folder).withColumn("p1", F.when(F.col("fold") != 0, F.col("p1")).otherwise(float("nan")))
    return rounded(op.evaluate(rows, "y", "p1", ["rmse"], skip_missing=True), {"rmse": 4})


def _predictions(spark, folder):
    orders = table(spark, folder, "orders")
    price = F.col("o_totalprice")
    return op.stack_predictions({
        "a": orders.select("o_orderkey", price.alias("prediction")),
        "b": orders.select("o_orderkey", (price * 0.5 + F.col("o_custkey")).alias("prediction")),
        "c": orders.select("o_orderkey", (price - F.col("o_orderkey") % 100).alias("prediction")),
    }, "o_orderkey", "prediction")


@query("blend_average", """
select o_orderkey, round((o_totalprice + (o_totalprice * 0.5 + o_custkey) + (o_totalprice - o_orderkey % 100)) / 3, 4) as prediction from orders""")
def blend_average(spark, folder):
    return rounded(op.average_predictions(_predictions(spark, folder), "o_orderkey", ["a", "b", "c"]), {"prediction": 4})


@query("blend_weighted", """
select o_orderkey, round((0.4 * o_totalprice + 0.2 * (o_totalprice * 0.5 + o_custkey) + 0.1 * (o_totalprice - o_orderkey % 100)) / 0.7, 4) as prediction
from orders""")
def blend_weighted(spark, folder):
    out = op.weighted_blend(_predictions(spark, folder), "o_orderkey", {"a": 0.4, "b": 0.2, "c": 0.1})
    return rounded(out, {"prediction": 4})


@query("blend_classes", """
select o_orderkey, round((0.25 + 3 * (o_orderkey % 10) / 10.0) / 4, 6) as p0, round((0.75 + 3 * (1 - (o_orderkey % 10) / 10.0)) / 4, 6) as p1 from orders""")
def blend_classes(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey")
    share = (F.col("o_orderkey") % 10) / F.lit(10.0)
    long = op.stack_predictions({
        "a": orders.select("o_orderkey", F.array(F.lit(0.25), F.lit(0.75)).alias("prediction")),
        "b": orders.select("o_orderkey", F.array(share, 1 - share).alias("prediction")),
    }, "o_orderkey", "prediction")
    out = op.weighted_blend(long, "o_orderkey", {"a": 1.0, "b": 3.0})
    return rounded(out.select("o_orderkey", F.col("prediction")[0].alias("p0"), F.col("prediction")[1].alias("p1")),
                   {"p0": 6, "p1": 6})


@query("runlog_upsert", """
select 's' || s_suppkey as script_file_name, null::varchar as why,
       case when s_suppkey % 3 = 0 then 'tuned Best model: ridge.' when s_suppkey % 2 = 0 then 'first' end as how,
       case when s_suppkey % 3 = 0 then s_acctbal else s_nationkey::double end as cv_score,
       case when s_suppkey % 3 = 0 then 'done' else 'open' end as status
from supplier where s_suppkey % 3 = 0 or s_suppkey % 2 = 0""")
def runlog_upsert(spark, folder):
    supplier = table(spark, folder, "supplier")
    name = F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("script_file_name")
    base = supplier.filter("s_suppkey % 2 = 0").select(
        name, F.lit(None).cast("string").alias("why"), F.lit("first").alias("how"),
        F.col("s_nationkey").cast("double").alias("cv_score"), F.lit("open").alias("status"))
    updates = supplier.filter("s_suppkey % 3 = 0").select(
        name, F.col("s_acctbal").alias("cv_score"), F.lit("tuned").alias("how"), F.lit("ridge").alias("best_model"),
        F.lit("x").alias("unknown_column"))
    return update_run_log(base, updates)


@query("runlog_stored", """
select 's' || s_suppkey as script_file_name, case when s_suppkey % 3 = 0 then s_acctbal else s_nationkey::double end as cv_score,
       case when s_suppkey % 3 = 0 then 'Best model: ridge.' end as how, 'done' as status
from supplier where s_suppkey % 3 = 0 or s_suppkey % 2 = 0""")
def runlog_stored(spark, folder):
    """Two updates of a stored log, each published as a version."""
    supplier, path = table(spark, folder, "supplier"), f"{work_folder(spark)}/log-{uuid.uuid4().hex}"
    name = F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("script_file_name")
    update_stored_run_log(supplier.filter("s_suppkey % 2 = 0").select(name, F.col("s_nationkey").cast("double").alias("cv_score")), path)
    log = update_stored_run_log(supplier.filter("s_suppkey % 3 = 0").select(
        name, F.col("s_acctbal").alias("cv_score"), F.lit("ridge").alias("best_model")), path)
    return log.select("script_file_name", "cv_score", "how", "status")

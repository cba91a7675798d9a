"""Summaries, correlations and target-by-feature tables."""

from pyspark.sql import functions as F

from catalog import query, rnd, rounded, table
from foldwise import plans

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
MOMENTS = {"Mean": 4, "StdDev": 4, "Median": 4, "Min": 4, "Max": 4, "PctNull": 2}


def _numbers(spark, folder):
    """Measures of the order lines, with missing quantities."""
    return table(spark, folder, "lineitem").select(
        F.nullif("l_quantity", F.lit(6.0)).alias("l_quantity"), *NUMBERS[1:], F.lit(1.0).alias("constant"))


ROWS = "select nullif(l_quantity, 6) as l_quantity, l_extendedprice, l_discount, l_tax, 1.0::double as constant from lineitem"


def _summary_sql():
    columns = [("o_orderkey", "bigint", "o_orderkey"), ("o_orderstatus", "string", None),
               ("o_totalprice", "double", "o_totalprice"), ("o_orderpriority", "string", None)]
    parts = []
    for name, dtype, number in columns:
        moments = ", ".join(
            f"round({f}, 4) + 0.0 as \"{n}\"" if number else f'null::double as "{n}"' for n, f in (
                ("Mean", f"avg({number})"), ("StdDev", f"stddev_samp({number})"), ("Median", f"median({number})::double"),
                ("Min", f"min({number})::double"), ("Max", f"max({number})::double")))
        parts.append(f"""select '{name}' as "Column", '{dtype}' as "DataType",
            count(distinct {name}) + max(case when {name} is null then 1 else 0 end) as "NumUnique",
            count(*) - count({name}) as "NumNull", round((count(*) - count({name})) * 100.0 / count(*), 2)::double as "PctNull", {moments} from t""")
    return f"""with t as (select o_orderkey, o_orderstatus, o_totalprice, nullif(o_orderpriority, '5-LOW') as o_orderpriority from orders)
        {' union all '.join(parts)}"""


@query("feature_summary", _summary_sql())
def feature_summary(spark, folder):
    df = table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"))
    return rounded(plans.calculate_feature_summary(df), MOMENTS)


@query("corr_matrix", "with t as (select * from (" + ROWS + ") where l_quantity is not null) " + " union all ".join(
    f"select '{a}' as feature, " + ", ".join(
        "1.0::double as " + b if a == b else f"round(corr({a}, {b}), 6) + 0.0 as {b}" for b in NUMBERS) + " from t"
    for a in NUMBERS))
def corr_matrix(spark, folder):
    found = plans.calculate_correlations(_numbers(spark, folder), "constant", NUMBERS)
    return rounded(found.matrix, dict.fromkeys(NUMBERS, 6))


@query("target_corr", "with t as (select * from (" + ROWS + ") where l_quantity is not null) " + " union all ".join(
    f"select '{a}' as feature, round(corr({a}, l_extendedprice), 6) + 0.0 as l_extendedprice_correlation from t"
    for a in ("l_quantity", "l_discount", "l_tax")))
def target_corr(spark, folder):
    found = plans.calculate_correlations(_numbers(spark, folder), "l_extendedprice")
    return rounded(found.target, {"l_extendedprice_correlation": 6})


@query("topk_abs_corr", "with t as (select * from (" + ROWS + ") where l_quantity is not null), c as (" + " union all ".join(
    f"select '{a}' as feature, round(corr({a}, l_extendedprice), 6) + 0.0 as r from t"
    for a in ("l_quantity", "l_discount", "l_tax")) + ") select feature, r from c order by abs(r) desc limit 2")
def topk_abs_corr(spark, folder):
    found = plans.calculate_correlations(_numbers(spark, folder), "l_extendedprice")
    top = plans.top_correlations(found.target, "l_extendedprice_correlation", 2)
    return top.select("feature", rnd("l_extendedprice_correlation").alias("r"))


@query("target_by_category", """
with t as (select coalesce(nullif(p_brand, 'Brand#3'), '_NULL_') as b, p_retailprice as y from part),
top as (select b from t group by b order by count(*) desc, b limit 20)
select b as feature_value, count(*) as "count", round(avg(y), 4) as target_mean, round(median(y), 4) as target_median
from t where b in (select b from top) group by b""")
def target_by_category(spark, folder):
    df = table(spark, folder, "part").select(F.nullif("p_brand", F.lit("Brand#3")).alias("p_brand"), "p_retailprice")
    out = plans.analyze_target_by_feature(df, "p_retailprice", "p_brand", max_categories=20, handle_nulls="fill")
    return rounded(out, {"target_mean": 4, "target_median": 4})


@query("target_by_bin", """
with e as (select quantile_cont(l_quantity, [0, 0.2, 0.4, 0.6, 0.8, 1]) as q from lineitem),
t as (select l_extendedprice as y, q, (l_quantity > q[2])::int + (l_quantity > q[3])::int + (l_quantity > q[4])::int
      + (l_quantity > q[5])::int as b from lineitem, e)
select 'q' || (b + 1) || ' (' || format('{:.3g}', q[b + 1]) || '-' || format('{:.3g}', q[b + 2]) || ')' as feature_value,
       count(*) as "count", round(avg(y), 3) as target_mean, round(median(y), 3) as target_median from t group by b, q""")
def target_by_bin(spark, folder):
    df = table(spark, folder, "lineitem").select("l_quantity", "l_extendedprice")
    out = plans.analyze_target_by_feature(df, "l_extendedprice", "l_quantity", num_bins=5)
    return rounded(out, {"target_mean": 3, "target_median": 3})


@query("target_hist", """
with s as (select min(o_totalprice) as lo, max(o_totalprice) as hi, count(*) as n from orders),
t as (select least(floor((o_totalprice - lo) / ((hi - lo) / 30)), 29)::int as bin from orders, s),
c as (select bin, count(*) as rows from t group by bin)
select i::int as bin, round(lo + i * ((hi - lo) / 30), 4) as low, round(lo + (i + 1) * ((hi - lo) / 30), 4) as high,
       coalesce(rows, 0) as rows, round(coalesce(rows, 0) / (n * ((hi - lo) / 30)), 12) as density
from range(30) r(i) cross join s left join c on c.bin = i""")
def target_hist(spark, folder):
    out = plans.target_histogram(table(spark, folder, "orders"), "o_totalprice", 30)
    return rounded(out, {"low": 4, "high": 4, "density": 12})


@query("auto_type", """
select unnest(['l_linenumber', 'l_suppkey', 'l_quantity', 'l_returnflag']) as feature,
       unnest(['categorical', case when (select count(distinct l_suppkey) from lineitem) > 20 then 'numerical' else 'categorical' end,
               'numerical', 'categorical']) as kind""")
def auto_type(spark, folder):
    from foldwise.plans.profile import detect_feature_type

    df = table(spark, folder, "lineitem")
    names = ["l_linenumber", "l_suppkey", "l_quantity", "l_returnflag"]
    found = [detect_feature_type(df, n) for n in names]
    return df.agg(F.count(F.lit(1)).alias("n")).select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("feature"), F.lit(k).alias("kind")) for n, k in zip(names, found)]))
        .alias("e")).select("e.*")


@query("profile_report", """
select 'by_o_orderpriority' as section, o_orderpriority as name, count(*)::double as a, round(avg(o_totalprice), 4) as b,
       round(median(o_totalprice), 4) as c from orders group by o_orderpriority
union all select 'by_o_orderstatus', o_orderstatus, count(*), round(avg(o_totalprice), 4), round(median(o_totalprice), 4) from orders group by o_orderstatus
union all select 'summary', 'o_totalprice', count(distinct o_totalprice), round(avg(o_totalprice), 4), round(median(o_totalprice), 4) from orders
union all select 'summary', 'o_orderstatus', count(distinct o_orderstatus), null, null from orders
union all select 'summary', 'o_orderpriority', count(distinct o_orderpriority), null, null from orders
union all select 'target_distribution', 'all', count(*), round(min(o_totalprice), 4), round(max(o_totalprice), 4) from orders""")
def profile_report(spark, folder):
    df = table(spark, folder, "orders").select("o_totalprice", "o_orderstatus", "o_orderpriority")
    out = None
    for section, found in plans.profile_tables(df, "o_totalprice").items():
        if section.startswith("by_"):
            columns = ["feature_value", "count", "target_mean", "target_median"]
        elif section == "summary":
            columns = ["Column", "NumUnique", "Mean", "Median"]
        else:
            found = found.agg(F.sum("rows").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).withColumn("all", F.lit("all"))
            columns = ["all", "n", "low", "high"]
        name, a, b, c = columns
        part = found.select(F.lit(section).alias("section"), F.col(name).alias("name"), F.col(a).cast("double").alias("a"),
                            rnd(b, 4).alias("b"), rnd(c, 4).alias("c"))
        out = part if out is None else out.unionByName(part)
    return out


SCORED = """
select l_orderkey, l_orderkey % 5 as fold, l_extendedprice as y,
       l_quantity * 1000 as p1, l_quantity * 990 + l_tax * 1000 as p2 from lineitem"""


def scored(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey", (F.col("l_orderkey") % 5).alias("fold"), F.col("l_extendedprice").alias("y"),
        (F.col("l_quantity") * 1000).alias("p1"), (F.col("l_quantity") * 990 + F.col("l_tax") * 1000).alias("p2"))


@query("fold_scores", f"""
with t as ({SCORED}),
s as (select 'm1' as model, fold, sqrt(avg(power(y - p1, 2))) as score from t group by fold
      union all select 'm2', fold, sqrt(avg(power(y - p2, 2))) from t group by fold),
m as (select model, avg(score) as mean, stddev_pop(score) as std from s group by model)
select model, round(mean, 4) as mean, round(std, 4) as std, mean = (select min(mean) from m) as is_best from m""")
def fold_scores(spark, folder):
    from foldwise.operators.metrics import regression_metric

    rows, out = scored(spark, folder), None
    for m, p in (("m1", "p1"), ("m2", "p2")):
        part = rows.groupBy("fold").agg(regression_metric("rmse", F.col("y"), F.col(p)).alias("score"))
        part = part.select(F.lit(m).alias("model"), "fold", "score")
        out = part if out is None else out.unionByName(part)
    return rounded(plans.fold_score_summary(out), {"mean": 4, "std": 4})


@query("impact_report", f"""
with t as (select y, p1 as b, case when p1 > 30000 then 30000 + ln(1 + p1 - 30000) else p1 end as a from ({SCORED})),
s as (select sqrt(avg(power(ln(1 + y) - ln(1 + b), 2))) as sb, sqrt(avg(power(ln(1 + y) - ln(1 + a), 2))) as sa from t)
select count(*) as rows, count(case when a <> b then 1 end) as changed,
       round(count(case when a <> b then 1 end) * 100.0 / count(*), 6)::double as changed_pct, min(b) as min_before, max(b) as max_before,
       round(min(a), 6) as min_after, round(max(a), 6) as max_after, round(min(sb), 6) as score_before, round(min(sa), 6) as score_after,
       round(min(sb) - min(sa), 6) + 0.0 as score_delta from t, s""")
def impact_report(spark, folder):
    from foldwise.functions import soft_clip

    rows = scored(spark, folder).withColumn("after", soft_clip(F.col("p1"), 30000))
    out = plans.transform_impact(rows, "y", "p1", "after")
    return rounded(out, {c: 6 for c in ("changed_pct", "min_after", "max_after", "score_before", "score_after", "score_delta")})

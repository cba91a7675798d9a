"""Feature crosses."""

from pyspark.sql import functions as F

from catalog import query, rounded, table
from foldwise import operators as op

LINE = ["l_orderkey", "l_linenumber"]


def _lineitem(spark, folder, *columns):
    return table(spark, folder, "lineitem").select(*LINE, *columns)


@query("pair_product_int", """
select l_orderkey, l_linenumber, cast(trunc(l_extendedprice * l_quantity) as integer) as l_extendedprice_x_l_quantity,
       cast(trunc(l_quantity * l_tax) as integer) as l_quantity_x_l_tax from lineitem""")
def pair_product_int(spark, folder):
    df = _lineitem(spark, folder, "l_quantity", "l_extendedprice", "l_tax")
    return op.create_interaction_features(
        df, [("l_quantity", "l_extendedprice"), ("l_tax", "l_quantity"), ("l_quantity", "l_tax")], keep=LINE)


@query("cross_terms", """
select l_orderkey, l_linenumber, l_quantity, l_discount, l_tax,
       round(l_quantity * l_discount, 6) + 0.0 as l_quantity_x_l_discount,
       round(l_quantity * l_tax, 6) + 0.0 as l_quantity_x_l_tax,
       round(l_discount * l_tax, 6) + 0.0 as l_discount_x_l_tax from lineitem""")
def cross_terms(spark, folder):
    df = op.add_feature_cross_terms(_lineitem(spark, folder, "l_quantity", "l_discount", "l_tax"),
                                    ["l_quantity", "l_discount", "l_tax"])
    return rounded(df, {c: 6 for c in df.columns if "_x_" in c})


@query("nway_product", """
select l_orderkey, l_linenumber, l_quantity, l_discount, l_tax,
       round(l_quantity * l_discount, 6) + 0.0 as l_quantity_x_l_discount,
       round(l_quantity * l_tax, 6) + 0.0 as l_quantity_x_l_tax,
       round(l_discount * l_tax, 6) + 0.0 as l_discount_x_l_tax,
       round(l_quantity * l_discount * l_tax, 6) + 0.0 as l_quantity_x_l_discount_x_l_tax from lineitem""")
def nway_product(spark, folder):
    df, names = op.create_n_way_multiplication_features(
        _lineitem(spark, folder, "l_quantity", "l_discount", "l_tax"), ["l_quantity", "l_discount", "l_tax"], [2, 3, 9])
    return rounded(df, dict.fromkeys(names, 6))


@query("enh_multiply", """
select l_orderkey, l_linenumber, round(l_discount * l_quantity, 6) + 0.0 as l_discount_mul_l_quantity from lineitem""")
def enh_multiply(spark, folder):
    df = op.create_enhanced_interaction_features(
        _lineitem(spark, folder, "l_quantity", "l_discount"),
        [{"features": ("l_quantity", "l_discount"), "operation": "multiply"}], keep=LINE)
    return rounded(df, {"l_discount_mul_l_quantity": 6})


@query("enh_divide", """
with t as (select l_orderkey, l_linenumber, nullif(l_quantity, 3) as q, l_discount as d, nullif(l_tax, 0.05) as x from lineitem)
select l_orderkey, l_linenumber, round(q / nullif(d, 0), 6) + 0.0 as q_div_d,
       round(case when q is null then null when x is null or x = 0 then -1 else q / nullif(x, 0) end, 6) + 0.0 as q_div_x from t""")
def enh_divide(spark, folder):
    df = table(spark, folder, "lineitem").select(
        *LINE, F.nullif("l_quantity", F.lit(3.0)).alias("q"), F.col("l_discount").alias("d"),
        F.nullif("l_tax", F.lit(0.05)).alias("x"))
    out = op.create_enhanced_interaction_features(df, [
        {"features": ("q", "d"), "operation": "divide"},
        {"features": ("q", "x"), "operation": "divide", "fill_value": -1.0}], keep=LINE)
    return rounded(out, {"q_div_d": 6, "q_div_x": 6})


@query("enh_power", """
with t as (select c_custkey, c_acctbal / 1000 as b, c_nationkey / 2.0::double - 3 as e from customer),
u as (select c_custkey, b, least(greatest(e, -10), 10) as e from t)
select c_custkey, round(case when b >= 0 or floor(e) = e then power(b, e) end, 4) + 0.0 as b_pow_e from u
where b is not null""")
def enh_power(spark, folder):
    df = table(spark, folder, "customer").select(
        "c_custkey", (F.col("c_acctbal") / 1000).alias("b"), (F.col("c_nationkey") / 2.0 - 3).alias("e"))
    out = op.create_enhanced_interaction_features(
        df, [{"features": ("b", "e"), "operation": "power"}], keep=["c_custkey"])
    return rounded(out, {"b_pow_e": 4})


@query("poly", """
select l_orderkey, l_linenumber, l_quantity as "poly_l_quantity", l_tax as "poly_l_tax",
       round(l_quantity * l_quantity, 6) + 0.0 as "poly_l_quantity^2", round(l_quantity * l_tax, 6) + 0.0 as "poly_l_quantity l_tax",
       round(l_tax * l_tax, 6) + 0.0 as "poly_l_tax^2" from lineitem""")
def poly(spark, folder):
    df = op.create_polynomial_features(
        _lineitem(spark, folder, "l_quantity", "l_tax"), ["l_quantity", "l_tax"], keep=LINE)
    return rounded(df, {c: 6 for c in df.columns if "^2" in c or " " in c})


PARTS = "select p_partkey, nullif(p_brand, 'Brand#3') as brand, p_type as type, p_size as size from part"


def _parts(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey", F.nullif("p_brand", F.lit("Brand#3")).alias("brand"), F.col("p_type").alias("type"),
        F.col("p_size").alias("size"))


INTER = {"brand_type_inter2": "coalesce(brand, 'null_str') || '_' || type",
         "brand_size_inter2": "coalesce(brand, 'null_str') || '_' || size",
         "type_size_inter2": "type || '_' || size",
         "brand_type_size_inter3": "coalesce(brand, 'null_str') || '_' || type || '_' || size"}
STRINGS = f"select p_partkey, {', '.join(f'{e} as {n}' for n, e in INTER.items())} from ({PARTS})"


@query("nway_concat", STRINGS)
def nway_concat(spark, folder):
    return op.create_nway_interaction_features(
        _parts(spark, folder), ["brand", "type", "size"], [2, 3], keep=["p_partkey"])


@query("nway_propagate", f"select p_partkey, brand || '_' || type as brand_type_inter2 from ({PARTS})")
def nway_propagate(spark, folder):
    return op.create_nway_interaction_features(
        _parts(spark, folder), ["brand", "type"], [2], handle_nulls="propagate", keep=["p_partkey"])


@query("nway_count", f"""
with s as ({STRINGS}) select p_partkey, {', '.join(f'count(*) over (partition by {n}) as {n}_count' for n in INTER)} from s""")
def nway_count(spark, folder):
    return op.create_nway_interaction_features(
        _parts(spark, folder), ["brand", "type", "size"], [2, 3], encode_type="count", keep=["p_partkey"])


@query("nway_label", f"""
with s as ({STRINGS}) select p_partkey, {', '.join(f'dense_rank() over (order by {n}) as {n}_label' for n in INTER)} from s""")
def nway_label(spark, folder):
    return op.create_nway_interaction_features(
        _parts(spark, folder), ["brand", "type", "size"], [2, 3], encode_type="label", add_one=True,
        keep=["p_partkey"], row_id="p_partkey")


@query("nway_label_wide", """
with s as (select l_orderkey, l_linenumber, l_partkey || '_' || l_returnflag as a, l_suppkey || '_' || l_linestatus as b from lineitem)
select l_orderkey, l_linenumber, dense_rank() over (order by a) - 1 as l_partkey_l_returnflag_inter2_label,
       dense_rank() over (order by b) - 1 as l_suppkey_l_linestatus_inter2_label from s""")
def nway_label_wide(spark, folder):
    df = _lineitem(spark, folder, "l_partkey", "l_returnflag", "l_suppkey", "l_linestatus")
    one = op.create_nway_interaction_features(
        df, ["l_partkey", "l_returnflag"], [2], encode_type="label", keep=df.columns)
    return op.create_nway_interaction_features(
        one, ["l_suppkey", "l_linestatus"], [2], encode_type="label",
        keep=[*LINE, "l_partkey_l_returnflag_inter2_label"])

"""Group statistics joined back to the rows."""

from pyspark.sql import functions as F

from catalog import query, rounded, table
from foldwise import operators as op

LINE = ["l_orderkey", "l_linenumber"]
ROWS = """
select l_orderkey, l_linenumber, nullif(l_returnflag, 'N') as flag, l_linestatus as status, l_suppkey as supplier,
       nullif(l_quantity, 5) as quantity, l_extendedprice as price from lineitem"""


def _rows(spark, folder):
    return table(spark, folder, "lineitem").select(
        *LINE, F.nullif("l_returnflag", F.lit("N")).alias("flag"), F.col("l_linestatus").alias("status"),
        F.col("l_suppkey").alias("supplier"), F.nullif("l_quantity", F.lit(5.0)).alias("quantity"),
        F.col("l_extendedprice").alias("price"))


GROUPS = {"fs": ["flag", "status"], "s": ["supplier"]}
# function -> SQL expression and digits to compare
FUNCTIONS = {
    "mean": ("avg(price)", 3), "std": ("stddev_samp(price)", 3), "min": ("min(price)", 3), "max": ("max(price)", 3),
    "count": ("count(quantity)", None), "size": ("count(*)", None),
    "nunique": ("count(distinct quantity) + max(case when quantity is null then 1 else 0 end)", None),
    "sum": ("sum(quantity)", 3), "median": ("median(price)", 3),
}
ON_QUANTITY = ("count", "nunique", "sum")


def _sql(names):
    parts, joins, outs = [], [], []
    for g, keys in GROUPS.items():
        values = ", ".join(f"{FUNCTIONS[n][0]} as {n}_{g}" for n in names)
        parts.append(f"g_{g} as (select {', '.join(keys)}, {values} from t group by {', '.join(keys)})")
        joins.append(f"left join g_{g} on " + " and ".join(f"g_{g}.{k} = t.{k}" for k in keys))
        outs += [f"round({n}_{g}, {FUNCTIONS[n][1]}) + 0.0 as {n}_{g}" if FUNCTIONS[n][1] else f"cast({n}_{g} as bigint) as {n}_{g}"
                 for n in names]
    return f"with t as ({ROWS}), {', '.join(parts)} select t.l_orderkey, t.l_linenumber, {', '.join(outs)} from t {' '.join(joins)}"


def _build(names):
    def run(spark, folder):
        configs = [{"groupby_cols": keys, "agg_col": "quantity" if n in ON_QUANTITY else "price", "agg_func": n,
                    "new_col_name": f"{n}_{g}"} for g, keys in GROUPS.items() for n in names]
        out = op.create_aggregation_features(_rows(spark, folder), configs)
        columns = [c["new_col_name"] for c in configs]
        digits = {c: FUNCTIONS[c.split("_")[0]][1] for c in columns if FUNCTIONS[c.split("_")[0]][1]}
        return rounded(out.select(*LINE, *columns), digits)
    return run


for _name in FUNCTIONS:
    query(f"agg_{_name}", _sql([_name]))(_build([_name]))
query("agg_all", _sql(list(FUNCTIONS)))(_build(list(FUNCTIONS)))

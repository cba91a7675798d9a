"""Group statistics joined back to the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.frame import refuse_target, require_columns
from foldwise.operators.lookup import attach_all, fit_lookup
from foldwise.operators.order_stats import grouped_quantiles

FUNCTIONS = ("mean", "std", "min", "max", "count", "size", "nunique", "sum", "median")
CONFIG_KEYS = ("groupby_cols", "agg_col", "agg_func", "new_col_name")


def _simple(function: str, column: Column) -> Column:
    if function == "mean":
        return F.avg(column)
    if function == "std":
        return F.stddev_samp(column)
    if function == "min":
        return F.min(column)
    if function == "max":
        return F.max(column)
    if function == "count":
        return F.count(column)
    if function == "size":
        return F.count(F.lit(1))
    # a group without values sums to zero
    return F.coalesce(F.sum(column), F.lit(0))


def _check(df: DataFrame, configs: Sequence[Mapping], target: str | None) -> None:
    if not configs:
        raise ValueError("agg_configs must not be empty")
    for i, config in enumerate(configs):
        missing = [k for k in CONFIG_KEYS if k not in config]
        if missing:
            raise ValueError(f"config {i} lacks {missing}")
        if config["agg_func"].lower() not in FUNCTIONS:
            raise ValueError(f"config {i}: unknown agg_func '{config['agg_func']}', expected one of {FUNCTIONS}")
        require_columns(df, [*config["groupby_cols"], config["agg_col"]], f"config {i}")
        refuse_target([*config["groupby_cols"], config["agg_col"]], target)


def create_aggregation_features(
    df: DataFrame, agg_configs: Sequence[Mapping], target: str | None = None, count_null: bool = True
) -> DataFrame:
    """Add one column per config; rows with a null group key get null.

    Configs with the same group columns share one aggregation and one join.
    Distinct counts and medians, which need the values themselves, run on
    counted (group, value) rows. ``count_null`` counts null as one more value
    for ``nunique``.
    """
    _check(df, agg_configs, target)
    by_keys: dict[tuple[str, ...], list[Mapping]] = {}
    for config in agg_configs:
        by_keys.setdefault(tuple(config["groupby_cols"]), []).append(config)
    out = attach_all(df, [_fit_group(df, list(keys), configs, count_null) for keys, configs in by_keys.items()])
    names = [c["new_col_name"] for c in agg_configs]
    return out.select(*df.columns, *names)


def _fit_group(df: DataFrame, keys: list[str], configs: Sequence[Mapping], count_null: bool):
    present = df
    for k in keys:
        present = present.filter(F.col(k).isNotNull())
    plain, extra = [F.count(F.lit(1)).alias("__rows")], []
    for config in configs:
        function, column = config["agg_func"].lower(), config["agg_col"]
        if function in ("nunique", "median"):
            extra.append((function, column, config["new_col_name"]))
        else:
            plain.append(_simple(function, F.col(column)).alias(config["new_col_name"]))
    table = present.groupBy(*keys).agg(*plain)
    for function, column, name in extra:
        if function == "median":
            part = grouped_quantiles(
                present, keys, column, [0.5], out="__q").select(
                *keys, F.col("__q")[0].alias(name))
        else:
            pairs = present.select(*keys, F.col(column).alias("__value")).distinct()
            counted = F.count(F.lit(1)) if count_null else F.count("__value")
            part = pairs.groupBy(*keys).agg(counted.alias(name))
        table = table.join(part, keys, "left")
    return fit_lookup(table, keys, [c["new_col_name"] for c in configs], rows="__rows")

"""Filling missing values with fitted or given constants."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.frame import is_float, is_integer, is_numeric, require_columns
from foldwise.operators.encode import native_value
from foldwise.operators.lookup import FEATURE, KEY, long_keys
from foldwise.operators.order_stats import column_quantiles

STRATEGIES = ("mean", "median", "mode", "zero", "literal")


@dataclass(frozen=True)
class ImputeModel:
    """Fill value per column; mean and median turn an integer column into double."""

    values: dict[str, object]
    as_double: frozenset[str]

    def transform(self, df: DataFrame) -> DataFrame:
        filled = {}
        for c, value in self.values.items():
            if c not in df.columns or value is None:
                continue
            if c in self.as_double:
                filled[c] = F.coalesce(F.col(c).cast("double"), F.lit(float(value)))
            else:
                filled[c] = F.coalesce(F.col(c), F.lit(value).cast(df.schema[c].dataType))
        return df.withColumns(filled) if filled else df


def _applies(df: DataFrame, column: str, strategy: str) -> bool:
    if strategy == "mode":
        return not is_float(df, column)
    if strategy == "literal":
        return True
    return is_numeric(df, column)


def most_frequent(df: DataFrame, columns: Sequence[str]) -> dict[str, object]:
    """Most frequent value of each column, the smallest among equally frequent ones.

    Values of all columns are counted in one pass.
    """
    if not columns:
        return {}
    counts = long_keys(df, columns).filter(F.col(KEY).isNotNull()).groupBy(FEATURE, KEY).agg(
        F.count(F.lit(1)).alias("n"))
    numbers = [i for i, c in enumerate(columns) if is_numeric(df, c)]
    number = F.when(F.col(FEATURE).isin(numbers), F.col(KEY).try_cast("decimal(38,0)"))
    rows = counts.groupBy(FEATURE).agg(
        F.min_by(KEY, F.struct(-F.col("n"), number.alias("number"), F.col(KEY))).alias("value")).collect()
    found = {columns[r[FEATURE]]: r["value"] for r in rows}
    return {c: native_value(found.get(c), df.schema[c].dataType) for c in columns}


def fit_imputer(
    df: DataFrame, strategy: str, features: Sequence[str] | None = None, fill_value=None
) -> ImputeModel:
    """Fit fill values on the columns that hold nulls.

    Without ``features`` every column the strategy applies to is taken and the
    others are left alone; a listed column it does not apply to is an error.
    """
    strategy = strategy.lower()
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy '{strategy}', expected one of {STRATEGIES}")
    if strategy == "literal" and fill_value is None:
        raise ValueError("strategy 'literal' needs a fill_value")
    if features is None:
        columns = [c for c in df.columns if _applies(df, c, strategy)]
    else:
        require_columns(df, features)
        wrong = [c for c in features if not _applies(df, c, strategy)]
        if wrong:
            raise TypeError(f"strategy '{strategy}' does not apply to columns: {wrong}")
        columns = list(dict.fromkeys(features))
    if strategy == "literal" and features is None:
        columns = [c for c in columns if _literal_matches(df, c, fill_value)]
    if not columns:
        return ImputeModel({}, frozenset())

    mean = strategy == "mean"
    row = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count(c).alias(f"n_{c}") for c in columns],
        *[F.avg(c).alias(f"m_{c}") for c in columns if mean],
    ).first()
    holes = [c for c in columns if row[f"n_{c}"] < row["__rows"]]
    if mean:
        values = {c: row[f"m_{c}"] for c in holes}
    elif strategy == "median":
        values = {c: q[0] if q else None for c, q in column_quantiles(df, holes, [0.5]).items()}
    elif strategy == "mode":
        values = most_frequent(df, holes)
    elif strategy == "zero":
        values = {c: 0 for c in holes}
    else:
        values = {c: fill_value for c in holes}
    as_double = frozenset(c for c in holes if strategy in ("mean", "median") and is_integer(df, c))
    return ImputeModel(values, as_double | frozenset(c for c in holes if mean or strategy == "median"))


def _literal_matches(df: DataFrame, column: str, value) -> bool:
    dtype = df.schema[column].dataType
    if isinstance(value, bool):
        return isinstance(dtype, T.BooleanType)
    if isinstance(value, (int, float)):
        return isinstance(dtype, T.NumericType)
    return isinstance(dtype, T.StringType) if isinstance(value, str) else True


def handle_missing_values(
    df: DataFrame, strategy: str, features: Sequence[str] | None = None, fill_value=None
) -> DataFrame:
    return fit_imputer(df, strategy, features, fill_value).transform(df)

"""Schema coercion, narrowing and row checks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.frame import INTEGER_TYPES, is_float, require_columns

# fixed values: ranges of the integer types and of single-precision floats
INTEGER_RANGES = (
    ("tinyint", -128, 127),
    ("smallint", -32768, 32767),
    ("int", -2147483648, 2147483647),
    ("bigint", -9223372036854775808, 9223372036854775807),
)
FLOAT_MAX = 3.4028234663852886e38

INTEGER_ORDER = [name for name, _, _ in INTEGER_RANGES]


def coerce_schema(
    df: DataFrame, numeric: Sequence[str] = (), categorical: Sequence[str] = ()
) -> DataFrame:
    """Cast listed columns to double or string; text that is no number becomes null.

    Listed columns that are absent are ignored.
    """
    casts = {c: F.col(c).try_cast("double") for c in numeric if c in df.columns}
    casts.update({c: F.col(c).cast("string") for c in categorical if c in df.columns})
    return df.withColumns(casts) if casts else df


def add_missing_target(df: DataFrame, target: str, dtype: str = "double") -> DataFrame:
    """Give unlabelled rows a typed null target so that they can be unioned with labelled ones."""
    if target in df.columns:
        return df
    return df.withColumn(target, F.lit(None).cast(dtype))


def drop_null_target(df: DataFrame, target: str) -> DataFrame:
    require_columns(df, [target])
    keep = F.col(target).isNotNull()
    if is_float(df, target):
        keep = keep & ~F.isnan(target)
    return df.filter(keep)


def check_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: rows, non-null, NaN and infinite values, in one pass."""
    require_columns(df, columns)
    parts = []
    for c in columns:
        if is_float(df, c):
            nan, inf = F.count_if(F.isnan(c)), F.count_if(F.abs(F.col(c)) == F.lit(float("inf")))
        else:
            nan = inf = F.lit(0).cast("bigint")
        parts.append(F.struct(
            F.lit(c).alias("column"), F.count(F.lit(1)).alias("rows"), F.count(c).alias("non_null"),
            nan.alias("nan"), inf.alias("infinite")))
    return df.agg(F.array(*parts).alias("parts")).select(F.inline("parts"))


def require_target(df: DataFrame, target: str) -> None:
    """Raise when there is nothing to train on."""
    require_columns(df, [target])
    if drop_null_target(df, target).isEmpty():
        raise ValueError(f"target column '{target}' holds no values")


@dataclass(frozen=True)
class SchemaPlan:
    """Casts found by ``compact_schema`` and the strings with few distinct values."""

    casts: dict[str, str]
    low_cardinality: list[str]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select(*[
            F.col(c).cast(self.casts[c]).alias(c) if c in self.casts else F.col(c) for c in df.columns
        ])


def compact_schema(df: DataFrame, cat_threshold: float = 0.5) -> SchemaPlan:
    """Find the narrowest type of every column from one aggregate.

    Integers without nulls go to the smallest type that holds their range,
    doubles without nulls to float if they fit. Strings keep their type, since
    Parquet encodes repeated strings anyway; those whose distinct share is below
    the threshold are listed. That share is an estimate (2 %).
    """
    aggregates = [F.count(F.lit(1)).alias("rows")]
    fields = {}
    for i, field in enumerate(df.schema.fields):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (*INTEGER_TYPES, T.DoubleType)):
            fields[i] = field
            aggregates += [F.count(c).alias(f"n{i}"), F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}")]
        elif isinstance(field.dataType, T.StringType):
            fields[i] = field
            aggregates.append(F.approx_count_distinct(c, 0.02).alias(f"d{i}"))
    row = df.agg(*aggregates).first()
    rows, casts, low = row["rows"], {}, []
    for i, field in fields.items():
        if isinstance(field.dataType, T.StringType):
            if rows > 0 and row[f"d{i}"] / rows < cat_threshold:
                low.append(field.name)
            continue
        if rows == 0 or row[f"n{i}"] < rows:
            continue
        lo, hi = row[f"lo{i}"], row[f"hi{i}"]
        if isinstance(field.dataType, T.DoubleType):
            if lo >= -FLOAT_MAX and hi <= FLOAT_MAX:
                casts[field.name] = "float"
            continue
        name = next(n for n, least, most in INTEGER_RANGES if least <= lo and hi <= most)
        if name != field.dataType.simpleString():
            casts[field.name] = name
    return SchemaPlan(casts, low)

"""Stateless column expressions.

Each function returns a ``Column`` (or a frame with one extra projection), so
several of them fuse into a single code-generated stage.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.frame import is_numeric, require_columns, require_numeric


def clip(column: Column, low: float | None = None, high: float | None = None) -> Column:
    """Bound a value on one or both sides; null stays null."""
    out = column
    if high is not None:
        out = F.when(column > high, F.lit(high)).otherwise(out)
    if low is not None:
        out = F.when(column < low, F.lit(low)).otherwise(out)
    return out


def clip_numerical_features(
    df: DataFrame, bounds: Mapping[str, tuple[float | None, float | None]]
) -> DataFrame:
    """Clip columns to their bounds and keep each column's type."""
    if not bounds:
        return df
    require_numeric(df, bounds)
    return df.withColumns({
        c: clip(F.col(c), low, high).cast(df.schema[c].dataType)
        for c, (low, high) in bounds.items()
    })


def replace_above(column: Column, threshold: float, value: float) -> Column:
    """Values above the threshold become a constant; null stays null."""
    return F.when(column > threshold, F.lit(value)).otherwise(column)


def map_values(column: Column, mapping: Mapping, default=None, dtype: str = "tinyint") -> Column:
    """Replace values through a dictionary; an unmapped value takes the default.

    The dictionary becomes part of the expression. ``operators.map_column``
    gives the same result by a join, which suits large dictionaries.
    """
    if not mapping:
        return F.lit(default).cast(dtype)
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    found = F.try_element_at(F.create_map(*pairs), column)
    out = found if default is None else F.coalesce(found, F.lit(default))
    return out.cast(dtype)


def strip_prefix(column: Column, prefix: str, dtype: str = "int") -> Column:
    """Remove the first occurrence of a literal text, then cast strictly."""
    at = F.instr(column, prefix)
    rest = F.concat(
        F.substring(column, F.lit(1), at - 1),
        F.substring(column, at + F.lit(len(prefix)), F.length(column)),
    )
    return F.when(at > 0, rest).otherwise(column).cast(dtype)


def power_columns(df: DataFrame, column: str, sqrt: bool = True, squared: bool = True) -> DataFrame:
    """Add the root and the square of a column."""
    require_numeric(df, [column])
    c, added = F.col(column).cast("double"), {}
    if sqrt:
        added[f"{column}_sqrt"] = F.sqrt(c)
    if squared:
        added[f"{column}_squared"] = c * c
    return df.withColumns(added)


def ratio_of(numerator: Column, denominator: Column) -> Column:
    """A quotient that is null where the divisor is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def bin_floor_text(column: Column, width: float = 10.0) -> Column:
    """Lower edge of a fixed-width bin as text, rounding down."""
    return (F.floor(column / F.lit(float(width))) * F.lit(float(width))).cast("string")


def bin_trunc_text(column: Column, width: int = 10) -> Column:
    """Lower edge of a fixed-width bin as text, rounding toward zero."""
    return ((column / F.lit(width)).cast("bigint") * F.lit(width)).cast("string")


def round_text(column: Column, digits: int = 1) -> Column:
    return F.round(column, digits).cast("string")


def floor_text(column: Column, width: float = 10.0) -> Column:
    return F.floor(column / F.lit(float(width))).cast("string")


def soft_clip(column: Column, threshold: float, low: float | None = None) -> Column:
    """Compress values above the threshold with log1p, after an optional floor."""
    floored = clip(column, low=low)
    return F.when(floored > threshold, F.lit(float(threshold)) + F.log1p(floored - threshold)).otherwise(floored)


def count_edges(column: Column, edges: Sequence[float]) -> Column:
    """Number of edges at or below the value, that is the index of its left-closed bin."""
    if not edges:
        return F.when(column.isNotNull(), F.lit(0))
    out = F.lit(0)
    for edge in edges:
        out = out + F.when(column >= F.lit(float(edge)), 1).otherwise(0)
    return F.when(column.isNotNull(), out)


def add_float_casts(df: DataFrame, target: str | None = None, dtype: str = "float") -> DataFrame:
    """Cast every numeric column except the target in one projection."""
    if target is not None:
        require_columns(df, [target])
    return df.select(*[
        F.col(c).cast(dtype).alias(c) if c != target and is_numeric(df, c) else F.col(c)
        for c in df.columns
    ])

"""Standard, min-max and robust scaling with statistics from the training rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.frame import require_columns, require_numeric
from foldwise.operators.order_stats import column_quantiles

SCALERS = ("standard", "minmax", "robust")


@dataclass(frozen=True)
class ScaleModel:
    """``(x - shift) / divisor * factor + base`` per column."""

    kind: str
    shift: dict[str, float]
    divisor: dict[str, float]
    factor: float = 1.0
    base: float = 0.0

    def transform(self, df: DataFrame) -> DataFrame:
        require_columns(df, self.shift)
        scaled = {}
        for c in self.shift:
            out = (F.col(c).cast("double") - F.lit(self.shift[c])) / F.lit(self.divisor[c])
            if self.factor != 1.0 or self.base != 0.0:
                out = out * F.lit(self.factor) + F.lit(self.base)
            scaled[c] = out
        return df.withColumns(scaled)


def fit_scaler(
    df: DataFrame,
    features: Sequence[str],
    scaler_type: str = "standard",
    with_mean: bool = True,
    with_std: bool = True,
    feature_range: tuple[float, float] = (0.0, 1.0),
) -> ScaleModel:
    """Fit on ``df``; nulls are ignored. A column without spread gets divisor 1."""
    scaler_type = scaler_type.lower()
    if scaler_type not in SCALERS:
        raise ValueError(f"unknown scaler_type '{scaler_type}', expected one of {SCALERS}")
    require_numeric(df, features)
    double = {c: F.col(c).cast("double") for c in features}
    if scaler_type == "robust":
        rows = df.agg(F.count(F.lit(1)).alias("rows")).first()
        found = column_quantiles(df, features, [0.25, 0.5, 0.75])
        stats = {c: (q[1], q[2] - q[0]) if q else (None, None) for c, q in found.items()}
    else:
        aggregates = [F.count(F.lit(1)).alias("rows")]
        for i, c in enumerate(features):
            low, high = (F.avg, F.stddev_pop) if scaler_type == "standard" else (F.min, F.max)
            aggregates += [low(double[c]).alias(f"a{i}"), high(double[c]).alias(f"b{i}")]
        rows = df.agg(*aggregates).first()
        stats = {}
        for i, c in enumerate(features):
            a, b = rows[f"a{i}"], rows[f"b{i}"]
            stats[c] = (a, b) if scaler_type == "standard" or a is None else (a, b - a)
    if rows["rows"] == 0:
        raise ValueError("cannot fit a scaler on an empty DataFrame")
    shift = {c: s[0] if s[0] is not None else 0.0 for c, s in stats.items()}
    divisor = {c: s[1] if s[1] else 1.0 for c, s in stats.items()}
    if scaler_type == "standard":
        if not with_mean:
            shift = dict.fromkeys(shift, 0.0)
        if not with_std:
            divisor = dict.fromkeys(divisor, 1.0)
    if scaler_type == "minmax":
        low, high = map(float, feature_range)
        return ScaleModel(scaler_type, shift, divisor, high - low, low)
    return ScaleModel(scaler_type, shift, divisor)


def scale_numerical_features(
    train: DataFrame, features: Sequence[str], test: DataFrame | None = None,
    scaler_type: str = "standard", **options,
) -> tuple[DataFrame, DataFrame | None, ScaleModel]:
    if test is not None:
        require_numeric(test, features)
    model = fit_scaler(train, features, scaler_type, **options)
    return model.transform(train), None if test is None else model.transform(test), model

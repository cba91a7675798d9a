"""Target transforms with their inverses, and target normalisation by a feature."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.frame import require_columns, require_numeric
from foldwise.functions.scalar import clip, count_edges, soft_clip
from foldwise.operators.encode import quantile_edges

METHODS = ("log", "log1p", "standard", "minmax", "binning")


@dataclass(frozen=True)
class TargetTransform:
    """A fitted transform; ``forward`` and ``inverse`` are column expressions."""

    method: str
    params: Mapping = field(default_factory=dict)

    def forward(self, y: Column) -> Column:
        y, p = y.cast("double"), self.params
        if self.method == "log":
            return F.ln(y)
        if self.method == "log1p":
            return F.log1p(y)
        if self.method == "standard":
            return F.lit(0.0) if p["std"] == 0 else (y - F.lit(p["mean"])) / F.lit(p["std"])
        if self.method == "minmax":
            span = p["max"] - p["min"]
            return F.lit(0.0) if span == 0 else (y - F.lit(p["min"])) / F.lit(span)
        place = count_edges(y, p["edges"])
        label = F.lit(None).cast("int")
        for i, b in enumerate(p["bins"]):
            label = F.when(place == b, i).otherwise(label)
        return label

    def inverse(self, y: Column) -> Column:
        p = self.params
        if self.method == "log":
            return F.exp(y)
        if self.method == "log1p":
            return F.expm1(y)
        if self.method == "standard":
            return F.lit(p["mean"]) if p["std"] == 0 else y * F.lit(p["std"]) + F.lit(p["mean"])
        if self.method == "minmax":
            span = p["max"] - p["min"]
            return F.lit(p["min"]) if span == 0 else y * F.lit(span) + F.lit(p["min"])
        edges = p["edges"]
        middles = F.lit([(a + b) / 2 for a, b in zip(edges, edges[1:])])
        index = clip(y.cast("int"), 0, len(edges) - 2)
        return F.element_at(middles, index + 1)

    def transform(self, df: DataFrame, target: str, out: str | None = None) -> DataFrame:
        require_numeric(df, [target])
        return df.withColumn(out or target, self.forward(F.col(target)))

    def reverse(self, df: DataFrame, column: str, out: str | None = None) -> DataFrame:
        require_numeric(df, [column])
        return df.withColumn(out or column, self.inverse(F.col(column)))


def fit_target_transform(df: DataFrame, target: str, method: str, n_bins: int | None = None) -> TargetTransform:
    if method not in METHODS:
        raise ValueError(f"unknown method '{method}', expected one of {METHODS}")
    require_numeric(df, [target])
    y = F.col(target).cast("double")
    if method == "log":
        if df.agg(F.count_if(y <= 0)).first()[0]:
            raise ValueError("'log' needs positive target values")
        return TargetTransform(method)
    if method == "log1p":
        return TargetTransform(method)
    if method == "standard":
        mean, std = df.agg(F.avg(y), F.stddev_samp(y)).first()
        if std is None or std != std:
            mean = std = 0.0
        return TargetTransform(method, {"mean": mean, "std": std})
    if method == "minmax":
        low, high = df.agg(F.min(y), F.max(y)).first()
        return TargetTransform(method, {"min": 0.0, "max": 1.0} if low is None else {"min": low, "max": high})
    if not isinstance(n_bins, int) or n_bins <= 0:
        raise ValueError("'binning' needs a positive integer n_bins")
    edges = quantile_edges(df, [target], n_bins)[target]
    if len(edges) < 2:
        raise ValueError("'binning' needs at least two distinct edges")
    place = count_edges(y, edges)
    row = df.agg(*[F.max(place == b).alias(str(b)) for b in range(len(edges) + 1)]).first()
    seen = [b for b in range(len(edges) + 1) if row[str(b)]]
    return TargetTransform(method, {"edges": edges, "n_bins": len(edges) - 1, "bins": seen})


def apply_target_transformation(
    train: DataFrame, target: str, method: str, test: DataFrame | None = None, n_bins: int | None = None
) -> tuple[DataFrame, DataFrame | None, Mapping]:
    """Fit on ``train`` and transform both frames; the parameters reverse it later."""
    model = fit_target_transform(train, target, method, n_bins)
    return model.transform(train, target), None if test is None else model.transform(test, target), model.params


def reverse_target_transformation(
    df: DataFrame, column: str, method: str, params: Mapping | None = None, out: str | None = None
) -> DataFrame:
    if method not in METHODS:
        raise ValueError(f"unknown method '{method}', expected one of {METHODS}")
    needed = {"standard": ("mean", "std"), "minmax": ("min", "max"), "binning": ("edges",)}.get(method, ())
    params = params or {}
    if any(k not in params for k in needed):
        raise ValueError(f"params {needed} are required to reverse '{method}'")
    return TargetTransform(method, params).reverse(df, column, out)


def normalize_target_by_feature(
    df: DataFrame, target: str, feature: str, method: str = "divide",
    out: str | None = None, fill_value_on_error: float = 0.0,
) -> DataFrame:
    """``target / feature`` (a zero feature gives the fill value) or ``target - feature``."""
    require_columns(df, [target, feature])
    require_numeric(df, [target, feature])
    y, f = F.col(target).cast("double"), F.col(feature).cast("double")
    if method == "divide":
        value = (F.when(y.isNull() | f.isNull(), F.lit(None))
                 .when(f == 0, F.lit(float(fill_value_on_error)))
                 .otherwise(F.try_divide(y, f)))
    elif method == "subtract":
        value = y - f
    else:
        raise ValueError("method must be 'divide' or 'subtract'")
    return df.withColumn(out or target, value)


def denormalize_predictions_by_feature(
    df: DataFrame, prediction: str, feature: str, method: str = "divide", out: str | None = None
) -> DataFrame:
    """Undo ``normalize_target_by_feature`` on predictions."""
    require_numeric(df, [prediction, feature])
    p, f = F.col(prediction).cast("double"), F.col(feature).cast("double")
    if method not in ("divide", "subtract"):
        raise ValueError("method must be 'divide' or 'subtract'")
    return df.withColumn(out or prediction, p * f if method == "divide" else p + f)


def clip_predictions(
    df: DataFrame, prediction: str, low: float | None = None, high: float | None = None,
    soft_above: float | None = None, out: str | None = None,
) -> DataFrame:
    """Hard bounds, or a floor with log compression above ``soft_above``."""
    require_numeric(df, [prediction])
    p = F.col(prediction).cast("double")
    value = clip(p, low, high) if soft_above is None else soft_clip(p, soft_above, low)
    return df.withColumn(out or prediction, value)

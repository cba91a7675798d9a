"""Averaging the predictions of several models, keyed by row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.frame import require_columns


def stack_predictions(frames: Mapping[str, DataFrame], row_id: str, prediction: str) -> DataFrame:
    """Long form (row, model, prediction) of one frame per model."""
    if not frames:
        raise ValueError("no predictions given")
    out = None
    for model, frame in frames.items():
        require_columns(frame, [row_id, prediction], model)
        part = frame.select(row_id, F.lit(model).alias("model"), F.col(prediction).alias("prediction"))
        out = part if out is None else out.unionByName(part)
    return out


def _is_array(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.ArrayType)


def average_predictions(
    long: DataFrame, row_id: str, models: Sequence[str], prediction: str = "prediction", out: str = "prediction"
) -> DataFrame:
    """Plain mean per row. A row that lacks a model, or has one twice, is an error."""
    return weighted_blend(long, row_id, dict.fromkeys(models, 1.0), prediction, out)


def weighted_blend(
    long: DataFrame, row_id: str, weights: Mapping[str, float], prediction: str = "prediction",
    out: str = "prediction",
) -> DataFrame:
    """``sum(w * p) / sum(w)`` per row over the weighted models; arrays blend element by element."""
    if not weights:
        raise ValueError("no models given")
    total = float(sum(weights.values()))
    if total == 0:
        raise ValueError("weights must not sum to zero")
    require_columns(long, [row_id, "model", prediction])
    weight = F.lit(None).cast("double")
    for model, w in weights.items():
        weight = F.when(F.col("model") == model, F.lit(float(w))).otherwise(weight)
    rows = long.filter(F.col("model").isin(list(weights))).withColumn("__w", weight)
    complete = F.count(prediction) == len(weights)
    problem = F.raise_error(F.lit("each row needs exactly one prediction of every model"))
    if not _is_array(long, prediction):
        blended = F.sum(F.col("__w") * F.col(prediction)) / F.lit(total)
        return rows.groupBy(row_id).agg(
            F.when(complete & (F.count(F.lit(1)) == len(weights)), blended).otherwise(problem.cast("double")).alias(out))
    scaled = rows.withColumn("__p", F.transform(prediction, lambda x: x.cast("double") * F.col("__w")))
    # one entry per model in each list
    grouped = scaled.groupBy(row_id).agg(F.collect_list("__p").alias("__all"), F.count(F.lit(1)).alias("__n"))
    first = F.element_at("__all", 1)
    fits = (F.col("__n") == len(weights)) & (F.size("__all") == len(weights)) & F.forall(
        "__all", lambda a: F.size(a) == F.size(first))
    zero = F.transform(first, lambda x: F.lit(0.0))
    summed = F.aggregate("__all", zero, lambda acc, a: F.zip_with(acc, a, lambda x, y: x + y))
    return grouped.select(row_id, F.when(fits, F.transform(summed, lambda x: x / F.lit(total))).otherwise(
        problem.cast("array<double>")).alias(out))


def same_rows(reference: DataFrame, other: DataFrame, row_id: str) -> bool:
    """Whether two frames hold the same row ids."""
    a, b = reference.select(row_id), other.select(row_id)
    return a.join(b, row_id, "left_anti").isEmpty() and b.join(a, row_id, "left_anti").isEmpty()


def usable_models(frames: Mapping[str, DataFrame], reference: DataFrame, row_id: str) -> list[str]:
    """Models whose predictions cover exactly the reference rows."""
    return [m for m, frame in frames.items() if same_rows(reference, frame, row_id)]

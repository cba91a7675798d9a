"""A model trained on the out-of-fold predictions of other models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.frame import require_columns
from foldwise.operators.blend import same_rows
from foldwise.plans.training import FittedFold, fit_model

META_MODELS = {"linear": "ridge", "ridge": "ridge", "logreg": "logreg", "lgbm": "lgbm", "xgb": "xgb"}


def widen_predictions(long: DataFrame, row_id: str, models: Sequence[str], prediction: str = "prediction") -> DataFrame:
    """One column per model; a row that lacks a model is an error."""
    require_columns(long, [row_id, "model", prediction])
    wide = long.groupBy(row_id).pivot("model", list(models)).agg(F.first(prediction))
    problem = F.raise_error(F.lit("a row lacks the prediction of a model"))
    return wide.select(row_id, *[
        F.when(F.col(m).isNull(), problem.cast(wide.schema[m].dataType)).otherwise(F.col(m)).alias(m) for m in models])


def train_stacking_meta_model(
    oof: DataFrame, labels: DataFrame, test: DataFrame, row_id: str, target: str,
    meta_model_type: str = "linear", model_params: Mapping | None = None, check_rows: bool = True,
) -> tuple[DataFrame, FittedFold]:
    """Fit on all out-of-fold rows and predict the test rows; both have one column per model."""
    kind = META_MODELS.get(meta_model_type.lower())
    if kind is None:
        raise ValueError(f"unknown meta_model_type '{meta_model_type}', expected one of {sorted(META_MODELS)}")
    models = [c for c in oof.columns if c != row_id]
    if models != [c for c in test.columns if c != row_id]:
        raise ValueError("out-of-fold and test predictions must have the same columns")
    require_columns(labels, [row_id, target], "labels")
    if check_rows and not same_rows(oof, labels, row_id):
        raise ValueError("out-of-fold predictions and labels must have the same rows")
    rows = oof.join(labels.select(row_id, target), row_id)
    model = fit_model(rows, target, models, kind, row_id, model_params)
    return model.predict(test, row_id), model

"""Tables kept between runs: predictions, folds and submissions."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.frame import require_columns
from foldwise.sources.files import save_csv
from foldwise.sources.versions import latest, list_folder, replace

log = logging.getLogger(__name__)


def _part(path: str, model: str, split: str) -> str:
    return f"{path.rstrip('/')}/{quote(model, safe='')}/{quote(split, safe='')}"


def save_predictions(
    df: DataFrame, path: str, model: str, split: str, row_id: str, prediction: str = "prediction"
) -> None:
    """Write one model's predictions for one split; a re-run replaces that part only, as a whole."""
    require_columns(df, [row_id, prediction])
    rows = df.select(F.col(row_id).alias("row_id"), F.col(prediction).alias("prediction"))
    replace(df.sparkSession, _part(path, model, split), lambda folder, before: rows.write.parquet(folder))


def load_predictions(
    spark: SparkSession, path: str, split: str, models: list[str] | None = None,
    reference: DataFrame | None = None, row_id: str = "row_id",
) -> DataFrame:
    """Rows of (row id, model, prediction). With ``reference`` every model must cover its rows."""
    rows = None
    for name in models if models is not None else map(unquote, list_folder(spark, path)):
        version = latest(spark, _part(path, name, split))
        if version is None:
            continue
        part = spark.read.parquet(version.folder).withColumn("model", F.lit(name))
        rows = part if rows is None else rows.unionByName(part)
    if rows is None:
        raise FileNotFoundError(f"no predictions of split '{split}' in {path}")
    rows = rows.select(F.col("row_id").alias(row_id), F.col("model").cast("string"), "prediction")
    if reference is not None:
        names = models or [r["model"] for r in rows.select("model").distinct().collect()]
        ids = rows.groupBy(row_id).agg(*[F.count_if(F.col("model") == name).alias(f"n{i}") for i, name in enumerate(names)])
        wanted = reference.groupBy(F.col(row_id).alias("__id")).agg(F.count(F.lit(1)).alias("__n"))
        joined = wanted.join(ids, F.col("__id") == F.col(row_id), "full_outer")
        # a row of the reference has each model once for each of its rows, a row beyond it has none
        wrong = joined.agg(*[F.count_if(F.coalesce(F.col(f"n{i}"), F.lit(0)) != F.coalesce(F.col("__n"), F.lit(0))).alias(f"n{i}")
                             for i in range(len(names))]).first()
        missing = [name for i, name in enumerate(names) if wrong[f"n{i}"]]
        if missing:
            raise ValueError(f"predictions of models {missing} do not cover the reference rows")
    return rows


def save_folds(df: DataFrame, path: str, row_id: str, fold: str = "fold") -> None:
    """Write the folds; a later save replaces them as a whole."""
    require_columns(df, [row_id, fold])
    rows = df.select(row_id, fold)
    replace(df.sparkSession, path, lambda folder, before: rows.write.parquet(folder))


def load_folds(spark: SparkSession, path: str) -> DataFrame:
    version = latest(spark, path)
    if version is None:
        raise FileNotFoundError(f"no folds in {path}")
    return spark.read.parquet(version.folder)


def generate_submission_file(
    df: DataFrame, id_col: str, prediction: str, target: str, path: str | None = None, id_name: str | None = None
) -> DataFrame:
    """Two columns, id and prediction; a row without a prediction is an error."""
    require_columns(df, [id_col, prediction])
    checked = F.when(F.col(prediction).isNull(), F.raise_error(F.lit("a row has no prediction")).cast(
        df.schema[prediction].dataType)).otherwise(F.col(prediction))
    out = df.select(F.col(id_col).alias(id_name or id_col), checked.alias(target))
    if path is not None:
        save_csv(out, path)
    return out


def save_model_artifacts(
    results: Mapping[str, Mapping[str, DataFrame]], path: str, row_id: str, target: str,
    best_model: str | None = None, prediction: str = "prediction",
) -> list[str]:
    """Store each model's ``oof`` and ``test`` predictions and submissions; return the paths."""
    written = []
    store, base = f"{path.rstrip('/')}/predictions", path.rstrip("/")
    for model, parts in results.items():
        for split in ("oof", "test"):
            if parts.get(split) is not None:
                save_predictions(parts[split], store, model, split, row_id, prediction)
        if parts.get("test") is not None:
            generate_submission_file(parts["test"], row_id, prediction, target, f"{base}/submission_{model}")
            written.append(f"{base}/submission_{model}")
    if best_model is not None:
        best = results.get(best_model, {}).get("test")
        if best is None:
            log.warning("no test predictions of best model '%s'", best_model)
        else:
            generate_submission_file(best, row_id, prediction, target, f"{base}/submission_best")
            written.append(f"{base}/submission_best")
    return written

"""Keyed upsert into the table that records experiments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.frame import require_columns
from foldwise.sources.versions import Version, latest, replace

# fixed values: columns of the experiment table
RUN_LOG_COLUMNS = (
    "script_file_name", "why", "what", "how", "cv_score", "lb_score", "status", "experiment_type",
    "base_experiment", "new_feature",
)
KEY = "script_file_name"
SCORES = ("cv_score", "lb_score")


def _with_best_model(how, model):
    """The note of this run, with the best model named once."""
    note = F.concat(F.lit("Best model: "), model, F.lit("."))
    return (F.when(model.isNull(), how)
            .when(how.isNull(), note)
            .when(F.contains(how, model), how)
            .otherwise(F.concat(how, F.lit(" "), note)))


def update_run_log(base: DataFrame | None, updates: DataFrame) -> DataFrame:
    """Merge updates (key, ``cv_score``, optional ``best_model`` and other columns) into the log.

    A known key gets the new score, status 'done' (unless given) and the other
    non-null values, for columns the log has. An unknown key is appended, with
    null where nothing is given. With ``best_model`` the run's ``how`` names it.
    """
    require_columns(updates, [KEY, "cv_score"], "updates")
    session = updates.sparkSession
    if base is None:
        fields = ", ".join(f"{c} {'double' if c in SCORES else 'string'}" for c in RUN_LOG_COLUMNS)
        base = session.createDataFrame([], fields)
    require_columns(base, [KEY, "cv_score"], "log")
    columns = base.columns
    new = updates.select(F.col(KEY).alias("__key"), *[
        F.col(c).alias(f"__new_{c}") for c in updates.columns if c != KEY])
    joined = base.withColumn("__old", F.lit(True)).join(new, F.col(KEY) == F.col("__key"), "full_outer")
    touched = F.col("__key").isNotNull()
    given = {c: F.col(f"__new_{c}") for c in updates.columns if c != KEY}
    if "best_model" in given:
        given["how"] = _with_best_model(given.get("how", F.lit(None).cast("string")), given.pop("best_model"))
    given["status"] = F.coalesce(given.get("status", F.lit(None)), F.when(touched, F.lit("done")))
    out = [F.coalesce(F.col(KEY), F.col("__key")).alias(KEY) if c == KEY
           else F.coalesce(given[c], F.col(c)).cast(base.schema[c].dataType).alias(c) if c in given
           else F.col(c)
           for c in columns]
    return joined.select(*out)


def load_run_log(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored log, or None if there is none yet."""
    version = latest(spark, path)
    return None if version is None else spark.read.parquet(version.folder)


def update_stored_run_log(updates: DataFrame, path: str) -> DataFrame:
    """Merge updates into the log stored at a path and return the new log.

    Two updates at the same time both count: the one that publishes second merges again into what the first one wrote. An
    update that dies leaves the log as it was.
    """
    spark = updates.sparkSession

    def write(folder: str, before: Version | None) -> None:
        base = None if before is None else spark.read.parquet(before.folder)
        update_run_log(base, updates).write.parquet(folder)

    return spark.read.parquet(replace(spark, path, write).folder)

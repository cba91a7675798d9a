"""Schema checks and materialisation shared by every operator.

The checks read ``df.schema`` only, so a wrong call fails on the driver before
a job is started.
"""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGER_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOAT_TYPES = (T.FloatType, T.DoubleType)


def require_columns(df: DataFrame, columns: Iterable[str], where: str = "DataFrame") -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found in {where}: {missing}")


def is_numeric(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.NumericType)


def is_integer(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, INTEGER_TYPES)


def is_float(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, FLOAT_TYPES)


def is_string(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.StringType)


def require_numeric(df: DataFrame, columns: Iterable[str]) -> None:
    columns = list(columns)
    require_columns(df, columns)
    wrong = [c for c in columns if not is_numeric(df, c)]
    if wrong:
        raise TypeError(f"columns must be numeric: {wrong}")


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [c for c in df.columns if c not in exclude and is_numeric(df, c)]


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [c for c in df.columns if c not in exclude and is_string(df, c)]


def refuse_target(inputs: Iterable[str], target: str | None) -> None:
    """Features computed from the target leak it into the model."""
    if target is not None and target in set(inputs):
        raise ValueError(f"target column '{target}' must not be an input of a feature operator")


def free_name(taken: Iterable[str], base: str) -> str:
    """A column name that is not in use yet."""
    used, name, n = set(taken), base, 0
    while name in used:
        n += 1
        name = f"{base}_{n}"
    return name


def key_text(df: DataFrame, column: str) -> Column:
    """Text form of a category key; distinct values keep distinct texts.

    Adding 0.0 turns -0.0 into 0.0, which compare as equal.
    """
    if is_float(df, column):
        return (F.col(column) + F.lit(0.0)).cast("string")
    return F.col(column).cast("string")


def number_or_none(value) -> float | None:
    if value is None:
        return None
    value = float(value)
    return None if value != value else value


def work_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables that driver and executors share.

    It is ``spark.checkpoint.dir``. Only where that is unset and the master is
    local, where all run on one machine, a private folder is made; it goes with
    the process. On a cluster an unset folder is an error.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = _private_folder()
    return f"{base.rstrip('/')}/foldwise-{context.applicationId}"


@functools.cache
def _private_folder() -> str:
    folder = tempfile.mkdtemp(prefix="foldwise-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return f"file://{folder}"


def materialise(df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once as Parquet to the work folder and return a frame that reads it.

    Each later use reads the columns and rows it needs instead of repeating the
    plan, also after an executor is lost.
    """
    spark = df.sparkSession
    path = f"{work_folder(spark)}/{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove a frame that ``materialise`` wrote and that no later plan reads."""
    spark = df.sparkSession
    folder = work_folder(spark).removeprefix("file:").lstrip("/")
    for path in {file.rpartition("/")[0] for file in df.inputFiles()}:
        if folder not in path:
            raise ValueError("only tables of the work folder can be discarded")
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)

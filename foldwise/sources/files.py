"""CSV and Parquet readers and writers, and row samples of a directory."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)


def load_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, **options
) -> DataFrame:
    """Read CSV with a header. Give a schema where it is known: inferring one costs a pass."""
    reader = spark.read.options(header=True, **options)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", True).csv(path)


def load_parquet(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, n_rows: int | None = None
) -> DataFrame:
    df = spark.read.parquet(path)
    if columns is not None:
        df = df.select(*columns)
    return df if n_rows is None else df.limit(n_rows)


def save_csv(
    df: DataFrame, path: str, separator: str = ",", include_header: bool = True,
    mode: str = "overwrite", **options
) -> None:
    df.write.mode(mode).options(sep=separator, header=include_header, **options).csv(path)


def save_parquet(df: DataFrame, path: str, compression: str = "zstd", mode: str = "overwrite") -> None:
    df.write.mode(mode).option("compression", compression).parquet(path)


def _list_paths(spark: SparkSession, directory: str) -> list[tuple[str, str]]:
    """(name, path) of the entries of a directory on any Hadoop file system."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(directory)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted((s.getPath().getName(), s.getPath().toString()) for s in fs.listStatus(root))


def _first_rows(spark: SparkSession, df: DataFrame, kind: str, options: dict, path: str, n_rows: int) -> DataFrame:
    """The first rows of a data set in the order of its files' names; a later file is read only if rows are missing."""
    rows = []
    for file in sorted(unquote(f) for f in df.inputFiles()):
        single = file.rpartition("/")[2] == path.rstrip("/").rpartition("/")[2]
        root = {} if single else {"basePath": path}
        # a limit that is collected takes the parts of a file one after the other
        rows += spark.read.format(kind).schema(df.schema).options(**options, **root).load(file).limit(n_rows - len(rows)).collect()
        if len(rows) >= n_rows:
            break
    return spark.createDataFrame(rows, df.schema).coalesce(1)


def first_csv_rows(spark: SparkSession, path: str, n_rows: int) -> DataFrame:
    """The first rows of a CSV with a header; their types are inferred from these rows only."""
    names = spark.read.options(header=True).csv(path)
    head = _first_rows(spark, names, "csv", {"header": True}, path, n_rows)
    if head.isEmpty():
        return head
    # what the whole sample can be read as, from narrow to wide
    casts = {}
    for c in names.columns:
        column = F.col(f"`{c}`")
        for kind in ("int", "bigint", "double", "boolean", "timestamp"):
            bad = head.filter(column.isNotNull() & column.try_cast(kind).isNull())
            if bad.isEmpty() and not head.filter(column.isNotNull()).isEmpty():
                casts[c] = kind
                break
    return head.select(*[F.col(f"`{c}`").cast(casts.get(c, "string")).alias(c) for c in names.columns])


def create_data_samples(
    spark: SparkSession, raw_dir: str, samples_dir: str, n_rows: int = 10,
    include_extensions: Sequence[str] = (".csv", ".parquet"),
) -> dict[str, int]:
    """Write the first rows of every data set of a directory under the same name.

    Of a data set of several files those whose names come first are read first, as Spark names the parts of sorted rows. Entries with other extensions are skipped; one that cannot be read is
    counted as failed and the rest goes on.
    """
    if n_rows <= 0:
        raise ValueError("n_rows must be positive")
    done = {"sampled": 0, "skipped": 0, "failed": 0}
    for name, path in _list_paths(spark, raw_dir):
        extension = next((e for e in include_extensions if name.endswith(e)), None)
        if extension not in (".csv", ".parquet"):
            done["skipped"] += 1
            continue
        try:
            target = f"{samples_dir.rstrip('/')}/{name}"
            if extension == ".csv":
                save_csv(first_csv_rows(spark, path, n_rows), target)
            else:
                save_parquet(_first_rows(spark, load_parquet(spark, path), "parquet", {}, path, n_rows), target)
            done["sampled"] += 1
        except Exception as error:  # a broken file must not stop the others
            log.warning("could not sample %s: %s", path, error)
            done["failed"] += 1
    return done

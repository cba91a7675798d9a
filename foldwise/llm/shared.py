"""Helpers of the text operators: Arrow batches in tasks and row identity."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.frame import materialise, require_columns, work_folder

__all__ = ["append_columns", "materialise", "no_rows", "require_columns", "require_text", "row_key", "table",
           "texts_of", "with_fields", "work_folder"]

LEAST = -(1 << 63)
PART_BYTES = 4 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def require_text(df: DataFrame, *columns: str) -> None:
    require_columns(df, columns)
    wrong = [c for c in columns if not isinstance(df.schema[c].dataType, T.StringType)]
    if wrong:
        raise TypeError(f"columns must be strings: {wrong}")


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def with_fields(schema: T.StructType, fields: Sequence[T.StructField]) -> T.StructType:
    """The schema with the fields at its end; fields of the same names are replaced."""
    names = {f.name.lower() for f in fields}
    return T.StructType([f for f in schema.fields if f.name.lower() not in names] + list(fields))


def append_columns(
    df: DataFrame, fields: Sequence[T.StructField], compute: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]],
    inputs: Sequence[str],
) -> DataFrame:
    """Add columns computed from Arrow batches.

    ``compute()`` is called once per task and returns a function from a batch
    with the ``inputs`` to one array per field; the function may have an attribute
    ``done`` to be called at the task's end. A column of ``df`` that has the
    name of a new field is replaced.
    """
    require_columns(df, inputs)
    schema = with_fields(df.schema, fields)
    names = {f.name.lower() for f in fields}
    kept = [c for c in df.columns if c.lower() not in names]
    # inputs that are replaced must still reach the task
    sent = df.select(*[F.col(f"`{c}`") for c in kept], *[F.col(f"`{c}`").alias(f"__in_{c}") for c in inputs])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = compute()
        try:
            for whole in batches:
                # what is computed at once is bounded by bytes, not by rows
                step = max(1, whole.num_rows * PART_BYTES // max(1, whole.nbytes))
                for at in range(0, max(1, whole.num_rows), step):
                    batch = whole.slice(at, step)
                    given = pa.RecordBatch.from_arrays([batch.column(f"__in_{c}") for c in inputs], list(inputs))
                    arrays = [batch.column(i) for i in range(len(kept))] + function(given)
                    yield pa.RecordBatch.from_arrays(arrays, schema.names)
        finally:
            # workers outlive their tasks; what a task has gathered does not
            getattr(function, "done", lambda: None)()

    return sent.mapInArrow(run, schema)


def row_key(df: DataFrame, key: str, text: str) -> tuple[Column, Column]:
    """What tells rows apart: the id (null as the smallest number) and 64 bits of a hash of the text.

    Many rows can share an id. A million texts of one id collide with a chance of
    3e-8; whoever applies places in a text to rows compares its length too.
    """
    return F.coalesce(F.col(key).cast("bigint"), F.lit(LEAST)), F.xxhash64(F.col(text))


def no_rows(df: DataFrame) -> bool:
    return df.limit(1).count() == 0

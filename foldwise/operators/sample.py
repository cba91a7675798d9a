"""Sampling of an exact size, row order, union and deduplication."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.frame import is_integer, require_columns
from foldwise.functions.hashing import HASH_SPACE, keyed_hash
from foldwise.operators.order_stats import dense_index, values_at_ranks

HASH_BUCKETS = 1 << 14
SPLIT = "_split"


def _wanted(rows: int, n: int | None, frac: float | None) -> int:
    size = n if n is not None else int(rows * frac)
    if size > rows:
        raise ValueError(f"n ({n}) is larger than the number of rows ({rows})")
    return size


def sample_dataframe(
    df: DataFrame, key: str, n: int | None = None, frac: float | None = None,
    shuffle: bool = True, seed: int = 0, approx: bool = False,
) -> DataFrame:
    """Exactly ``n`` rows, or ``int(rows * frac)``, without replacement.

    The rows with the smallest keyed hash are taken (``shuffle=False``: those
    with the smallest key). The cut value is found from bucket counts, so the
    sample itself is a filter: no row is moved and no row order is needed. A null
    key is hashed like a value; of rows that share the last key the wanted
    number is taken by a hash of the row.
    ``approx`` takes a Bernoulli sample of a fraction instead.
    """
    if (n is None) == (frac is None):
        raise ValueError("give exactly one of n and frac")
    if frac is not None and not 0.0 <= frac <= 1.0:
        raise ValueError("frac must be between 0 and 1")
    if n is not None and n < 0:
        raise ValueError("n must not be negative")
    require_columns(df, [key])
    if approx:
        if frac is None:
            raise ValueError("approx needs frac")
        return df.sample(fraction=frac, seed=seed)
    return _smallest_hash(df, key, n, frac, seed) if shuffle else head_rows(df, key, n, frac)


def _smallest_hash(df: DataFrame, key: str, n: int | None, frac: float | None, seed: int) -> DataFrame:
    # a missing key is hashed like a value
    h = keyed_hash(F.coalesce(F.col(key).cast("string"), F.lit("null")), seed)
    width = HASH_SPACE // HASH_BUCKETS
    bucket = F.floor(h / F.lit(width)).cast("int")
    # at most HASH_BUCKETS rows
    counts = {r["b"]: r["count"] for r in df.groupBy(bucket.alias("b")).count().collect()}
    size = _wanted(sum(counts.values()), n, frac)
    if size == 0:
        return df.limit(0)
    before, cut = _cut(counts, 0, size)
    # then the hash values of that bucket (at most HASH_SPACE / HASH_BUCKETS of them)
    inside = {r["h"]: r["count"] for r in df.filter(bucket == cut).groupBy(h.alias("h")).count().collect()}
    before, last = _cut(inside, before, size)
    # then the few keys that share the last hash value, nulls first
    tied = df.filter(h == last).groupBy(F.col(key).alias("k")).count().collect()
    smaller = h < F.lit(last)
    for row in sorted(tied, key=lambda r: (r["k"] is not None, r["k"] if r["k"] is not None else 0)):
        same = (h == F.lit(last)) & F.col(key).eqNullSafe(F.lit(row["k"]))
        if before + row["count"] >= size:
            return _with_ties(df, smaller, same, size - before, row["count"])
        smaller, before = smaller | same, before + row["count"]
    raise ValueError("fewer rows than wanted")


def _with_ties(df: DataFrame, sure: Column, tied: Column, wanted: int, there: int) -> DataFrame:
    """All ``sure`` rows and ``wanted`` of the ``there`` tied ones, chosen by a hash of the row."""
    if wanted == there:
        return df.filter(sure | tied)
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    bucket = F.shiftright(row_hash, 50)
    # at most 2 ** 14 rows each
    counts = {r["b"]: r["count"] for r in df.filter(tied).groupBy(bucket.alias("b")).count().collect()}
    before, cut = _cut(counts, 0, wanted)
    part = df.filter(tied & (bucket == cut))
    values = {r["v"]: r["count"] for r in part.groupBy(row_hash.alias("v")).count().orderBy("v").limit(wanted - before).collect()}
    before, last = _cut(values, before, wanted)
    chosen = df.filter(sure | (tied & ((bucket < cut) | ((bucket == cut) & (row_hash < last)))))
    # rows that repeat every column are alike
    return chosen.unionByName(df.filter(tied & (row_hash == last)).limit(wanted - before))


def _cut(counts: Mapping[int, int], before: int, size: int) -> tuple[int, int]:
    """The running count reached before ``size``, and the value at which it is reached."""
    for value in sorted(counts):
        if before + counts[value] >= size:
            return before, value
        before += counts[value]
    raise ValueError("fewer rows than wanted")


def head_rows(df: DataFrame, key: str, n: int | None = None, frac: float | None = None) -> DataFrame:
    """The first rows in key order, null keys last; of rows that share the last key as many as are wanted."""
    require_columns(df, [key])
    size = _wanted(df.count(), n, frac)
    if size == 0:
        return df.limit(0)
    if is_integer(df, key):
        present = df.filter(F.col(key).isNotNull()).count()
        if size <= present:
            last = values_at_ranks(df, key, [size - 1])[size - 1]
            sure, tied = F.coalesce(F.col(key) < F.lit(last), F.lit(False)), F.col(key).eqNullSafe(F.lit(last))
        else:
            sure, tied = F.col(key).isNotNull(), F.col(key).isNull()
        counted = df.agg(F.count_if(sure), F.count_if(tied)).first()
        return _with_ties(df, sure, tied, size - counted[0], counted[1])
    return dense_index(df, [key], "__place").filter(F.col("__place") < size).drop("__place")


def with_row_index(df: DataFrame, order: list[str], out: str = "row_index") -> DataFrame:
    """Zero-based position of each row in the given order."""
    require_columns(df, order)
    return dense_index(df, order, out)


def union_splits(frames: Mapping[str, DataFrame], split: str = SPLIT) -> DataFrame:
    """Stack named frames and remember each row's origin; absent columns become null."""
    if not frames:
        raise ValueError("nothing to stack")
    out = None
    for name, frame in frames.items():
        marked = frame.withColumn(split, F.lit(name))
        out = marked if out is None else out.unionByName(marked, allowMissingColumns=True)
    return out


def take_split(df: DataFrame, name: str, split: str = SPLIT) -> DataFrame:
    require_columns(df, [split])
    return df.filter(F.col(split) == name).drop(split)


def drop_duplicates_keep_first(
    df: DataFrame, columns: list[str], key: str, only_split: str | None = None, split: str = SPLIT
) -> DataFrame:
    """Keep the row with the smallest key among equal rows, null equal to null.

    With ``only_split`` the rows of other splits are all kept. Equal rows are
    reduced before the shuffle, so a large group of copies costs no more than a
    small one.
    """
    require_columns(df, [*columns, key])
    rows = df if only_split is None else df.filter(F.col(split) == only_split)
    rest = [c for c in df.columns if c not in columns]
    first = rows.groupBy(*columns).agg(F.min(F.struct(key, *[c for c in rest if c != key])).alias("__first"))
    kept = first.select(*[F.col(c) if c in columns else F.col(f"__first.{c}").alias(c) for c in df.columns])
    if only_split is None:
        return kept
    return kept.unionByName(df.filter(~F.col(split).eqNullSafe(F.lit(only_split))))

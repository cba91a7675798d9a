"""Fold assignment as a column."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.frame import is_integer, require_columns
from foldwise.functions.hashing import HASH_SPACE, keyed_hash
from foldwise.operators.lookup import attach, fit_lookup
from foldwise.operators.order_stats import dense_index, row_numbers_in_groups, values_at_ranks

ROWS_PER_BUCKET = 200_000
MAX_BUCKETS = 1 << 16


def _hash_buckets(rows: int) -> int:
    return min(MAX_BUCKETS, max(8, math.ceil(rows / ROWS_PER_BUCKET)))


def _check_k(n_splits: int) -> None:
    if n_splits < 2:
        raise ValueError("n_splits must be at least 2")


def kfold(
    df: DataFrame, key: str, n_splits: int = 5, seed: int = 0, exact: bool = False, out: str = "fold"
) -> DataFrame:
    """Shuffled folds from a hash of the key.

    By default a pure projection, with sizes equal in expectation. ``exact``
    makes the sizes differ by one row at most.
    """
    _check_k(n_splits)
    require_columns(df, [key])
    if not exact:
        return df.withColumn(out, F.pmod(keyed_hash(key, seed), F.lit(n_splits)).cast("int"))
    return _dealt(df, [], key, n_splits, seed, out)


def _dealt(df, groups, key, n_splits, seed, out) -> DataFrame:
    """Deal the rows of each group to the folds in hash order."""
    buckets = _hash_buckets(df.count())
    hashed = df.withColumn("__h", keyed_hash(key, seed))
    numbered = row_numbers_in_groups(
        hashed, groups, ["__h", key], F.floor(F.col("__h") * F.lit(buckets) / F.lit(HASH_SPACE)).cast("int"), "__rn")
    return numbered.select(*df.columns, F.pmod(F.col("__rn") - 1, F.lit(n_splits)).cast("int").alias(out))


def contiguous_kfold(df: DataFrame, key: str, n_splits: int = 5, out: str = "fold") -> DataFrame:
    """Unshuffled folds: consecutive key ranges, the first ``rows mod k`` one row longer.

    For an integer key only the k-1 boundary keys are looked up. Another key
    type is numbered in a range-partitioned pass.
    """
    _check_k(n_splits)
    require_columns(df, [key])
    rows = df.count()
    base, longer = divmod(rows, n_splits)
    starts = [i * base + min(i, longer) for i in range(1, n_splits)]
    if is_integer(df, key):
        inside = [s for s in starts if s < rows]
        found = values_at_ranks(df, key, inside)
        fold = F.lit(0)
        for s in inside:
            fold = fold + F.when(F.col(key) >= F.lit(found[s]), 1).otherwise(0)
        return df.withColumn(out, fold.cast("int"))
    fold = F.lit(0)
    for s in starts:
        fold = fold + F.when(F.col("__place") >= F.lit(s), 1).otherwise(0)
    return dense_index(df, [key], "__place").select(*df.columns, fold.cast("int").alias(out))


def stratified_kfold(
    df: DataFrame, key: str, target: str | None, n_splits: int = 5, seed: int = 0, out: str = "fold"
) -> DataFrame:
    """Folds that keep the share of each class, whatever the size of a class."""
    _check_k(n_splits)
    if target is None:
        raise ValueError("stratified folds need a target column")
    require_columns(df, [key, target])
    return _dealt(df, [target], key, n_splits, seed, out)


def _places(loads: list[int], size: int, groups: int) -> list[int]:
    """How many of ``groups`` groups of one size each fold gets.

    The same numbers as placing one group after the other on the lightest fold
    (the first of equally light ones), without walking through the groups.
    """
    def below(level: int) -> list[int]:
        return [max(0, -((load - level) // size)) for load in loads]

    low, high = min(loads), max(loads) + size * groups + 1
    while high - low > 1:  # the highest level that needs no more groups than there are
        middle = (low + high) // 2
        if sum(below(middle)) <= groups:
            low = middle
        else:
            high = middle
    counts = below(low)
    left = groups - sum(counts)
    for fold, load in enumerate(loads):
        if left and load + counts[fold] * size == low:
            counts[fold] += 1
            left -= 1
    return counts


def group_kfold(
    df: DataFrame, group: str | None, n_splits: int = 5, out: str = "fold", seed: int = 0
) -> DataFrame:
    """Folds that never split a group, balanced by group size.

    Biggest groups first, each to the lightest fold. Only how many groups there
    are of each size reaches the driver (fewer sizes than twice the root of the
    rows); groups of one size are dealt in the order of a hash, the first of
    them to fold 0 and so on. A null group is a group of its own.
    """
    _check_k(n_splits)
    if group is None:
        raise ValueError("group folds need a group column")
    require_columns(df, [group])
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("__rows"))
    lookup = fit_lookup(sizes, [group], [], rows="__rows")
    if lookup.n_keys < n_splits:
        raise ValueError(f"{lookup.n_keys} groups cannot fill {n_splits} folds")
    classes = lookup.table.groupBy("__rows").count().collect()
    loads, cuts = [0] * n_splits, []
    for size, groups in sorted(((r["__rows"], r["count"]) for r in classes), reverse=True):
        counts = _places(loads, size, groups)
        loads = [load + n * size for load, n in zip(loads, counts)]
        ends = list(itertools.accumulate(counts))
        cuts.append((size, ends[:-1], groups))
    table = df.sparkSession.createDataFrame(cuts, "__size bigint, __ends array<bigint>, __groups bigint")
    hashed = lookup.table.withColumn("__h", F.coalesce(keyed_hash(group, seed), F.lit(0).cast("bigint")))
    buckets = _hash_buckets(lookup.n_keys)
    numbered = row_numbers_in_groups(
        hashed.withColumnRenamed("__rows", "__size"), ["__size"], ["__h", group], F.floor(F.col("__h") * F.lit(buckets) / F.lit(HASH_SPACE)).cast("int"), "__rn")
    placed = attach(numbered, fit_lookup(table, ["__size"], ["__ends"], rows="__groups")).select(
        group, F.size(F.filter("__ends", lambda end: end < F.col("__rn"))).alias("__fold"), F.col("__size").alias("__rows"))
    found = attach(df, fit_lookup(placed, [group], ["__fold"], rows="__rows"), null_safe=True)
    return found.select(*df.columns, F.col("__fold").alias(out))


def fold_pairs(df: DataFrame, fold: str = "fold", n_splits: int | None = None) -> Iterator[tuple[int, DataFrame, DataFrame]]:
    """Yield (fold, training rows, validation rows)."""
    from foldwise.operators.encode_stats import observed_folds

    require_columns(df, [fold])
    for k in range(n_splits) if n_splits else observed_folds(df, fold):
        yield k, df.filter(F.col(fold) != k), df.filter(F.col(fold) == k)


def assign_folds(
    df: DataFrame, key: str, kind: str = "kfold", n_splits: int = 5, seed: int = 0, shuffle: bool = True,
    target: str | None = None, group: str | None = None, out: str = "fold",
) -> DataFrame:
    """One entry point for the four kinds of folds."""
    kind = kind.lower()
    if kind == "kfold":
        return kfold(df, key, n_splits, seed, True, out) if shuffle else contiguous_kfold(df, key, n_splits, out)
    if kind == "stratified":
        return stratified_kfold(df, key, target, n_splits, seed, out)
    if kind == "group":
        return group_kfold(df, group, n_splits, out, seed)
    raise ValueError("kind must be 'kfold', 'stratified' or 'group'")

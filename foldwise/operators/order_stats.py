"""Exact order statistics, ranks and running totals without a global sort.

Spark's exact ``percentile`` gathers the values of a group in a single task.
Here the values are split into ranges by approximate cut points, the ranges are
counted, and only the ranges that hold a wanted rank are ordered, after equal
values have been counted. The cut points influence balance only: every result
is exact.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldwise.frame import materialise, require_columns
from foldwise.operators import lookup
from foldwise.operators.lookup import attach, fit_lookup

CUT_POINTS = 4096
FEW_CUT_POINTS = 64
CUT_ACCURACY = 20_000
ROWS_PER_RANGE = 100_000
#: a wanted range that is too large is split by this many cut points, as often as this
SPLIT_POINTS = 64
SPLITS = 6

RANGE, _WEIGHT, _VALUE, _NUMBER = "__bucket", "__weight", "__value", "__real"
_BUCKET = RANGE


def split_ranges(df: DataFrame, column: str) -> DataFrame:
    """Add ``__bucket``: an increasing function of the column with balanced sizes.

    The number of ranges follows from the number of rows, so that a range has
    about ``ROWS_PER_RANGE`` rows until ``CUT_POINTS`` ranges are reached.
    """
    ranged = df.withColumn("__number", F.col(column).cast("double"))

    def cuts(points: int):
        grid = ", ".join(f"{i / points}D" for i in range(1, points))
        return ranged.agg(
            F.count(F.lit(1)), F.expr(f"percentile_approx(__number, array({grid}), {CUT_ACCURACY})")).first()

    points = FEW_CUT_POINTS
    rows, found = cuts(points)
    parts = min(CUT_POINTS, math.ceil(rows / ROWS_PER_RANGE) or 1)
    if parts > points:
        points = CUT_POINTS
        _, found = cuts(points)
    picked = [found[i * points // parts - 1] for i in range(1, parts)] if found else []
    edges = sorted({c for c in picked if not math.isnan(c) and not math.isinf(c)})
    if not edges:
        return df.withColumn(_BUCKET, F.lit(0.0))
    splits = [-math.inf, *edges, math.inf]
    bucketizer = Bucketizer(splits=splits, inputCol="__number", outputCol=_BUCKET, handleInvalid="keep")
    return bucketizer.transform(ranged).drop("__number")


def _positions(total: Column, probs: Sequence[float]) -> tuple[Column, Column]:
    """Wanted ranks (below and above) of each probability, as arrays."""
    exact = [F.lit(float(p)) * (total - 1) for p in probs]
    below = F.array(*[F.floor(e).cast("bigint") for e in exact])
    above = F.array(*[F.ceil(e).cast("bigint") for e in exact])
    return below, above


def ranked_values(
    df: DataFrame, keys: Sequence[str], value: str, ranks: Column, weight: str | None = None
) -> DataFrame:
    """One row per group with ``__total`` and a map from wanted rank to value.

    ``ranks`` is an array expression over ``__total``; ranks count from zero in
    ascending order. After a pass for cut points and one for the rows per range, a range
    that holds a wanted rank and more than ``ROWS_PER_RANGE`` rows is split again by cut points of its own,
    until it is small or holds one value. Only the rows of wanted ranges are read for that, and only
    they are ever ordered.
    """
    keys = list(keys)
    times = F.lit(1).cast("bigint") if weight is None else F.col(weight).cast("bigint")
    columns = [_VALUE, _WEIGHT, _NUMBER]
    parts = split_ranges(df.select(*keys, F.col(value).alias(_VALUE), times.alias(_WEIGHT)), _VALUE)
    parts = parts.withColumns({_NUMBER: F.col(_VALUE).cast("double"), _BUCKET: F.col(_BUCKET).cast("bigint")})
    measures = [F.sum(_WEIGHT).alias("__size"), F.min(_NUMBER).alias("__lo"), F.max(_NUMBER).alias("__hi")]
    # at most CUT_POINTS + 1 rows per group reach one task here
    group = Window.partitionBy(*[F.col(k) for k in keys] or [F.lit(0)])
    sizes = parts.groupBy(*keys, _BUCKET).agg(*measures).withColumn("__total", F.sum("__size").over(group))
    running = group.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = sizes.withColumn("__start", F.sum("__size").over(running) - F.col("__size")).withColumn("__wanted", F.array_distinct(ranks))
    facts, large = ["__total", "__start", "__wanted", "__lo", "__hi"], (F.col("__size") > ROWS_PER_RANGE) & (F.col("__lo") < F.col("__hi"))
    for level in range(SPLITS + 1):
        mine = F.filter("__wanted", lambda r: (r >= F.col("__start")) & (r < F.col("__start") + F.col("__size")))
        found = found.withColumn("__wanted", mine).filter(F.size("__wanted") > 0)
        located = fit_lookup(found, [*keys, _BUCKET], facts, rows="__size")
        n_large = located.table.filter(large).count() if level < SPLITS else 0
        if not n_large:
            break
        parts, found = _split_again(parts, located, keys, columns, facts, large, n_large, measures)

    located_rows = located.table
    count = F.sum(_WEIGHT).alias(_WEIGHT)
    # ranks are joined to counted values: carried through the count, these arrays would make it sort all rows
    if located.n_bytes <= lookup.BROADCAST_BYTES:
        # the other ranges are dropped before anything is shuffled
        near = _join_ranges(parts, F.broadcast(located_rows), keys, [_VALUE, _WEIGHT], [])
        counted, located_rows = near.groupBy(*keys, _BUCKET, _VALUE).agg(count), F.broadcast(located_rows)
    else:
        counted, located_rows = parts.groupBy(*keys, _BUCKET, _VALUE).agg(count), located_rows.hint("shuffle_hash")
    inside = _join_ranges(counted, located_rows, keys, [_VALUE, _WEIGHT], facts)
    ordered = (
        Window.partitionBy(*[F.col(k) for k in keys], F.col(_BUCKET)).orderBy(_VALUE)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    hits = (
        inside
        .withColumn("__last", F.col("__start") + F.sum(_WEIGHT).over(ordered))
        .withColumn("__rank", F.explode(F.filter(
            "__wanted", lambda r: (r < F.col("__last")) & (r >= F.col("__last") - F.col(_WEIGHT)))))
    )
    return hits.groupBy(*keys).agg(
        F.first("__total").alias("__total"),
        F.map_from_entries(F.collect_list(F.struct("__rank", _VALUE))).alias("__ranked"),
    )


def _split_again(parts, located, keys, columns, facts, large, n_large: int, measures) -> tuple[DataFrame, DataFrame]:
    """The rows of the located ranges in finer ranges, and the finer ranges with what they inherit.

    A cut point ends a range and is one of its own, so a value of many rows is told apart from its neighbours; the smallest value is
    a cut point too, so every split of two values divides them.
    """
    small = located.n_bytes <= lookup.BROADCAST_BYTES
    near = _join_ranges(parts, F.broadcast(located.table) if small else located.table, keys, columns, [*facts, "__size"])
    grid = ", ".join(f"{i / SPLIT_POINTS}D" for i in range(1, SPLIT_POINTS))
    cuts = materialise(near.filter(large).groupBy(*keys, _BUCKET).agg(F.array_sort(F.array_distinct(F.array_append(
        F.expr(f"percentile_approx({_NUMBER}, array({grid}), 1000)"), F.min(_NUMBER)))).alias("__cuts")))
    cuts = F.broadcast(cuts) if n_large * SPLIT_POINTS * 8 <= lookup.BROADCAST_BYTES else cuts
    left, right = near.alias("v"), cuts.alias("c")
    on = F.col(f"v.{_BUCKET}") == F.col(f"c.{_BUCKET}")
    for k in keys:
        on = on & F.col(f"v.{k}").eqNullSafe(F.col(f"c.{k}"))
    rows = left.join(right, on, "left").select("v.*", "c.__cuts")
    number = F.col(_NUMBER)
    place = F.size(F.filter("__cuts", lambda c: c < number)) + F.size(F.filter("__cuts", lambda c: c <= number))
    finer = F.col(_BUCKET) * (2 * SPLIT_POINTS + 2) + F.when(F.col("__cuts").isNotNull(), place).otherwise(0)
    rows = rows.withColumn("__parent", F.col(_BUCKET)).withColumn(_BUCKET, finer)
    counted, parents = rows.groupBy(*keys, "__parent", _BUCKET).agg(*measures).alias("v"), located.table.alias("b")
    on = F.col("v.__parent") == F.col(f"b.{_BUCKET}")
    for k in keys:
        on = on & F.col(f"v.{k}").eqNullSafe(F.col(f"b.{k}"))
    sizes = counted.join(F.broadcast(parents) if small else parents, on).select("v.*", *[F.col(f"b.{c}").alias(c) for c in facts[:3]])
    running = Window.partitionBy(*[F.col(k) for k in keys], F.col("__parent")).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = sizes.withColumn("__start", F.col("__start") + F.sum("__size").over(running) - F.col("__size")).drop("__parent")
    return rows.select(*keys, _BUCKET, *columns), found


def _join_ranges(rows: DataFrame, located: DataFrame, keys, kept, facts) -> DataFrame:
    left, right = rows.alias("v"), located.alias("b")
    on = F.col(f"v.{_BUCKET}") == F.col(f"b.{_BUCKET}")
    for k in keys:
        on = on & F.col(f"v.{k}").eqNullSafe(F.col(f"b.{k}"))
    return left.join(right, on, "inner").select(
        *[F.col(f"v.{c}").alias(c) for c in [*keys, _BUCKET, *kept]], *[F.col(f"b.{c}").alias(c) for c in facts])


def grouped_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Sequence[float],
    out: str = "quantiles",
    weight: str | None = None,
) -> DataFrame:
    """Exact linear quantiles per group, as an array of doubles, and the group's ``size``.

    Nulls are skipped. Pass ``weight`` when ``df`` already holds counted values.
    """
    keys, probs = list(keys), [float(p) for p in probs]
    require_columns(df, [*keys, value])
    rows = df.filter(F.col(value).isNotNull())
    below, above = _positions(F.col("__total"), probs)
    found = ranked_values(rows, keys, value, F.concat(below, above), weight)
    at = []
    for p in probs:
        position = F.lit(p) * (F.col("__total") - 1)
        low, high = F.floor(position).cast("bigint"), F.ceil(position).cast("bigint")
        low_value = F.element_at("__ranked", low).cast("double")
        high_value = F.element_at("__ranked", high).cast("double")
        at.append(F.when(low == high, low_value).otherwise(
            low_value * (high - position) + high_value * (position - low)))
    return found.select(*keys, F.array(*at).alias(out), F.col("__total").alias("size"))


def column_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float]
) -> dict[str, list[float] | None]:
    """Exact linear quantiles of several columns; None for a column without values."""
    columns, probs = list(columns), [float(p) for p in probs]
    if not columns:
        return {}
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns
    ])).alias("e")).select("e.*")
    out: dict[str, list[float] | None] = {c: None for c in columns}
    out.update({r["column"]: r["quantiles"] for r in grouped_quantiles(long, ["column"], "value", probs).collect()})
    return out


def values_at_ranks(df: DataFrame, column: str, ranks: Sequence[int]) -> dict[int, object]:
    """Exact values at zero-based ranks of a column, in the column's own type."""
    if not ranks:
        return {}
    rows = df.filter(F.col(column).isNotNull())
    wanted = F.lit([int(r) for r in ranks]).cast("array<bigint>")
    row = ranked_values(rows, [], column, wanted).first()
    return dict(row["__ranked"]) if row is not None else {}


def nearest_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[str, list[float]]:
    """Quantiles that are elements of the column: the element at the rounded rank.

    All columns are handled in the same passes; a column without values gives an
    empty list.
    """
    columns, probs = list(columns), [float(p) for p in probs]
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("column"), F.col(c).cast("double").alias("value")) for i, c in enumerate(columns)
    ])).alias("e")).select("e.*").filter(F.col("value").isNotNull())
    ranks = F.transform(F.lit(probs).cast("array<double>"), lambda p: F.floor((F.col("__total") - 1) * p + F.lit(0.5)).cast("bigint"))
    out: dict[str, list[float]] = {c: [] for c in columns}
    for row in ranked_values(long, ["column"], "value", ranks).collect():
        found, last = row["__ranked"], row["__total"] - 1
        out[columns[row["column"]]] = [found[math.floor(last * p + 0.5)] for p in probs]
    return out


def dense_index(distinct_rows: DataFrame, order: Sequence[str], out: str = "index") -> DataFrame:
    """Number distinct rows 0, 1, 2, ... in the given order, ties by a hash of the row.

    The rows are range-partitioned, sorted inside each partition and written
    once. A row's number is its place in its partition plus the sizes of the
    partitions before it; only those sizes (one per partition) are collected.
    """
    columns = distinct_rows.columns
    # the hash lets one hot order value span several ranges
    full = set(order) >= set(columns)
    by = [*order] if full else [*order, "__tie"]
    rows = distinct_rows if full else distinct_rows.withColumn("__tie", F.xxhash64(*columns))
    # the place is written with the row: files may be read back in other partitions
    place = materialise(rows.repartitionByRange(*by).sortWithinPartitions(*by).select(
        *columns, F.monotonically_increasing_id().alias("__place")))
    part, offset = F.shiftright(F.col("__place"), 33), F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = place.groupBy(part.alias("part")).count().collect()
    starts, total = {}, 0
    for row in sorted(sizes, key=lambda r: r["part"]):
        starts[row["part"]] = total
        total += row["count"]
    if not starts:
        return place.select(*columns, F.lit(0).cast("bigint").alias(out))
    first = F.lit([starts.get(p, 0) for p in range(max(starts) + 1)]).cast("array<bigint>")
    number = F.element_at(first, (part + 1).cast("int")) + offset
    return place.select(*columns, number.alias(out))


def row_numbers_in_groups(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column, out: str = "row_number"
) -> DataFrame:
    """1-based row numbers per group where no task sees a whole group.

    ``bucket`` must not decrease along ``order``; rows are numbered inside
    (group, bucket) and shifted by the rows in the buckets before.
    """
    keys, columns = list(keys), df.columns
    parts = df.withColumn(_BUCKET, bucket)
    sizes = parts.groupBy(*keys, _BUCKET).agg(F.count(F.lit(1)).alias("__rows"))
    ahead = Window.partitionBy(*[F.col(k) for k in keys] or [F.lit(0)]).orderBy(_BUCKET).rowsBetween(
        Window.unboundedPreceding, -1)
    starts = sizes.withColumn("__start", F.coalesce(F.sum("__rows").over(ahead), F.lit(0)).cast("bigint"))
    fitted = fit_lookup(starts, [*keys, _BUCKET], ["__start"], rows="__rows")
    inside = Window.partitionBy(*[F.col(k) for k in keys], F.col(_BUCKET)).orderBy(*order)
    numbered = parts.withColumn("__inside", F.row_number().over(inside))
    shifted = attach(numbered, fitted, null_safe=True)
    return shifted.select(*columns, (F.col("__start") + F.col("__inside")).alias(out))


def running_totals(df: DataFrame, order: str, values: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Add ``<value>_before``: the total of all rows of the same keys with a smaller order value.

    ``df`` must have one row per keys and order value. Rows are split into ranges, the
    range totals are accumulated (one row per keys and range), then rows inside a range.
    """
    columns, keys = df.columns, list(keys)
    parts = split_ranges(df, order)
    sizes = parts.groupBy(*keys, _BUCKET).agg(*[F.sum(v).alias(f"__sum_{v}") for v in values])
    ahead = Window.partitionBy(*keys or [F.lit(0)]).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*keys, _BUCKET, *[
        F.coalesce(F.sum(f"__sum_{v}").over(ahead), F.lit(0)).alias(f"__start_{v}") for v in values])
    inside = Window.partitionBy(*keys, _BUCKET).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    # the joined side has at most CUT_POINTS + 1 rows for each group of keys
    starts = starts if keys else F.broadcast(starts)
    return parts.join(starts, [*keys, _BUCKET]).select(*columns, *[
        (F.col(f"__start_{v}") + F.coalesce(F.sum(v).over(inside), F.lit(0))).alias(f"{v}_before")
        for v in values
    ])


def sums_before(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column, values: Sequence[str]) -> DataFrame:
    """Add ``<value>_before``: the sum over the rows of the same keys that come before in the order.

    ``bucket`` must not decrease along ``order``. Rows are added up inside (keys, bucket) and
    shifted by the buckets before, so keys that hold many rows are not gathered in a task.
    """
    keys, columns = list(keys), df.columns
    parts = df.withColumn(_BUCKET, bucket)
    sizes = parts.groupBy(*keys, _BUCKET).agg(
        F.count(F.lit(1)).alias("__rows"), *[F.sum(v).alias(f"__sum_{v}") for v in values])
    ahead = Window.partitionBy(*keys).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    starts = [f"__start_{v}" for v in values]
    fitted = fit_lookup(sizes.select(*keys, _BUCKET, "__rows", *[
        F.coalesce(F.sum(f"__sum_{v}").over(ahead), F.lit(0)).alias(s) for v, s in zip(values, starts)]), [*keys, _BUCKET], starts, rows="__rows")
    inside = Window.partitionBy(*keys, _BUCKET).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = parts.withColumns({f"__in_{v}": F.coalesce(F.sum(v).over(inside), F.lit(0)) for v in values})
    shifted = attach(summed, fitted, null_safe=True)
    return shifted.select(*columns, *[(F.col(s) + F.col(f"__in_{v}")).alias(f"{v}_before") for v, s in zip(values, starts)])

"""Joining fitted tables back to the rows they came from.

Most encoders end in a left join of a per-category table. How that join runs
depends on the table's measured size:

* small (``BROADCAST_BYTES``): broadcast, the rows are not shuffled;
* large: shuffled join. Categories that hold more than 1/``HOT_PARTS`` of the
  rows (so at most ``HOT_PARTS`` of them) are broadcast on their own, and their
  rows, like rows with a null key, are spread over all tasks by a salt.

Every row is kept and gets the same values on either route.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.frame import key_text, materialise, require_columns

BROADCAST_BYTES = 48 << 20
HOT_PARTS = 1000
SALTS = 4096
JOIN_BLOCK = 32

FEATURE, KEY = "__feature", "__key"
# types whose text casts back to the same value, so the join can use the native type
TEXT_ROUND_TRIP = (T.StringType, T.IntegralType, T.FractionalType, T.BooleanType, T.DateType)


@dataclass(frozen=True)
class Lookup:
    """A fitted table: key columns, payload columns and the rows each key covers."""

    table: DataFrame
    keys: list[str]
    payload: list[str]
    rows: str
    n_keys: int
    n_rows: int
    n_bytes: int


@dataclass(frozen=True)
class FeatureLookup:
    """One table for many features, in rows of (feature number, key text, payload)."""

    table: DataFrame
    features: list[str]
    types: dict[str, T.DataType]
    payload: list[str]
    sizes: dict[int, tuple[int, int, int]]  # feature number -> keys, rows, bytes


def _row_bytes(table: DataFrame, keys: Sequence[str], payload: Sequence[str], rows: str) -> Column:
    def width(c: str) -> Column:
        dtype = table.schema[c].dataType
        if isinstance(dtype, T.StringType):
            return F.coalesce(F.octet_length(c), F.lit(0)) + 16
        if isinstance(dtype, T.ArrayType):
            return F.greatest(F.size(c), F.lit(0)) * 8 + 32
        return F.lit(16)

    total = F.lit(64)
    for c in [*keys, *payload, rows]:
        total = total + width(c)
    return total


def fit_lookup(table: DataFrame, keys: Sequence[str], payload: Sequence[str], rows: str) -> Lookup:
    """Write the table once and measure it. ``rows`` counts the rows behind each key."""
    keys, payload = list(keys), list(payload)
    table = materialise(table.select(*dict.fromkeys([*keys, *payload, rows])))
    size = table.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(rows), F.lit(0)).alias("r"),
        F.coalesce(F.sum(_row_bytes(table, keys, payload, rows)), F.lit(0)).alias("b"),
    ).first()
    return Lookup(table, keys, payload, rows, size["n"], size["r"], size["b"])


def _match(left: Sequence[Column], right: Sequence[Column], null_safe: bool) -> Column:
    out = None
    for a, b in zip(left, right):
        test = a.eqNullSafe(b) if null_safe else a == b
        out = test if out is None else out & test
    return out


def _row_hash(df: DataFrame) -> Column:
    usable = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))
              and not isinstance(f.dataType, T.UserDefinedType)]
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in usable]), F.lit(SALTS))


def attach(
    df: DataFrame, lookup: Lookup, on: Sequence[str] | None = None, null_safe: bool = False,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Left join: all columns of ``df`` plus the payload, null where the key is unknown.

    A table of up to ``broadcast_bytes`` (by default ``BROADCAST_BYTES``) is
    broadcast; callers that attach several tables share one budget. ``on`` names the columns of ``df`` in the order of the lookup's keys. With
    ``null_safe`` a null key matches a null key.
    """
    on = list(on or lookup.keys)
    columns = df.columns
    names = {k: f"__lk{i}" for i, k in enumerate(lookup.keys)}
    renamed = lookup.table.select(
        *[F.col(k).alias(n) for k, n in names.items()],
        *[F.col(p).alias(f"__pl{i}") for i, p in enumerate(lookup.payload)],
        F.col(lookup.rows).alias("__covered"))
    payload = [f"__pl{i}" for i in range(len(lookup.payload))]
    left, right = [F.col(f"`{c}`") for c in on], [F.col(n) for n in names.values()]
    condition = _match(left, right, null_safe)

    if lookup.n_bytes <= (BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes):
        joined = df.join(F.broadcast(renamed.drop("__covered")), condition, "left")
        return joined.select(*[F.col(f"`{c}`") for c in columns],
                             *[F.col(p).alias(name) for p, name in zip(payload, lookup.payload)])

    hot_from = max(1, lookup.n_rows // HOT_PARTS)
    hot = renamed.filter(F.col("__covered") > hot_from).select(
        *[F.col(n).alias(f"__h{n}") for n in names.values()], F.struct(*payload).alias("__hot"))
    cold = renamed.filter(F.col("__covered") <= hot_from).withColumn(
        # always zero, but the optimizer must keep it as a join key
        "__salt_r", F.when(F.col("__covered") < 0, 1).otherwise(0).cast("bigint"))
    hot_match = _match(left, [F.col(f"__h{n}") for n in names.values()], null_safe)
    # at most HOT_PARTS rows can each cover more than 1/HOT_PARTS of all rows
    marked = df.join(F.broadcast(hot), hot_match, "left")
    settled = F.col("__hot").isNotNull()
    if not null_safe:
        for c in left:
            settled = settled | c.isNull()
    marked = marked.withColumn("__salt_l", F.when(settled, _row_hash(df) + 1).otherwise(F.lit(0)).cast("bigint"))
    joined = marked.join(cold, condition & (F.col("__salt_l") == F.col("__salt_r")), "left")
    return joined.select(*[F.col(f"`{c}`") for c in columns], *[
        F.when(F.col("__hot").isNotNull(), F.col(f"__hot.{p}")).otherwise(F.col(p)).alias(name)
        for p, name in zip(payload, lookup.payload)
    ])


def map_column(
    df: DataFrame, column: str, mapping: Mapping, default=None, dtype: str = "tinyint", out: str | None = None
) -> DataFrame:
    """Replace a column's values (or add ``out``) through a dictionary of any size, by a join.

    The result of ``functions.map_values``: unmapped values and nulls take the default.
    """
    require_columns(df, [column])
    out = out or column
    kind = df.schema[column].dataType.simpleString()
    pairs = [(k, v) for k, v in mapping.items() if k is not None]
    rows = df.sparkSession.createDataFrame(
        [(str(k).lower() if isinstance(k, bool) else str(k), None if v is None else str(v)) for k, v in pairs],
        "k string, v string")
    table = rows.select(F.col("k").try_cast(kind).alias("__from"), F.col("v").cast(dtype).alias("__to"), F.lit(1).alias("__n"))
    found = attach(df, fit_lookup(table.filter(F.col("__from").isNotNull()), ["__from"], ["__to"], rows="__n"), on=[column])
    value = F.col("__to") if default is None else F.coalesce(F.col("__to"), F.lit(default).cast(dtype))
    kept = [F.col(f"`{c}`") if c != out else value.alias(out) for c in df.columns]
    return found.select(*kept, *([] if out in df.columns else [value.alias(out)]))


def attach_all(df: DataFrame, lookups: Sequence[Lookup], null_safe: bool = False) -> DataFrame:
    """Attach several tables; the smallest are broadcast while one common budget lasts."""
    budget, small = BROADCAST_BYTES, set()
    for i in sorted(range(len(lookups)), key=lambda i: lookups[i].n_bytes):
        if lookups[i].n_bytes <= budget:
            budget -= lookups[i].n_bytes
            small.add(i)
    out = df
    for i, lookup in enumerate(lookups):
        out = attach(out, lookup, null_safe=null_safe, broadcast_bytes=lookup.n_bytes if i in small else -1)
    return out


def long_keys(df: DataFrame, features: Sequence[str], keep: Sequence[Column] = ()) -> DataFrame:
    """Rows of (feature number, key text, kept columns), one per feature and row.

    One scan feeds the statistics of all features; the aggregation that follows
    combines equal keys before anything is shuffled.
    """
    features = list(features)
    require_columns(df, features)
    kept = [c for c in keep]
    if len(features) == 1:
        return df.select(F.lit(0).alias(FEATURE), key_text(df, features[0]).alias(KEY), *kept)
    pairs = F.array(*[
        F.struct(F.lit(i).alias(FEATURE), key_text(df, f).alias(KEY)) for i, f in enumerate(features)])
    return df.select(F.explode(pairs).alias("__pair"), *kept).select(f"__pair.{FEATURE}", f"__pair.{KEY}", *[
        c for c in df.select(*kept).columns])


def fit_features(
    table: DataFrame, source: DataFrame, features: Sequence[str], payload: Sequence[str], rows: str
) -> FeatureLookup:
    """Write a (feature, key) table once, one folder per feature, and measure each feature's part.

    A join of one feature reads its folder only.
    """
    table = table.select(FEATURE, KEY, *payload, F.col(rows).alias("__covered"))
    if len(features) > 1:
        # few files per folder; a large feature still has several
        table = materialise(table.hint("rebalance", FEATURE), partition_by=[FEATURE])
    else:
        table = materialise(table)
    measured = table.groupBy(FEATURE).agg(
        F.count(F.lit(1)).alias("n"), F.sum("__covered").alias("r"),
        F.sum(_row_bytes(table, [KEY], payload, "__covered")).alias("b")).collect()
    sizes = {i: (0, 0, 0) for i in range(len(features))}
    sizes.update({r[FEATURE]: (r["n"], r["r"], r["b"]) for r in measured})
    types = {f: source.schema[f].dataType for f in features}
    return FeatureLookup(table, list(features), types, list(payload), sizes)


def _attach_one(df, lookup: FeatureLookup, feature: str, number: int, outputs, null_safe) -> DataFrame:
    part = lookup.table.filter(F.col(FEATURE) == number)
    dtype = lookup.types[feature]
    if isinstance(dtype, TEXT_ROUND_TRIP):
        return attach(df, _part(lookup, part, F.col(KEY).cast(dtype), number, outputs), [feature], null_safe)
    with_text = df.withColumn(KEY, key_text(df, feature))
    return attach(with_text, _part(lookup, part, F.col(KEY), number, outputs), [KEY], null_safe).drop(KEY)


def _part(lookup: FeatureLookup, part: DataFrame, key: Column, number: int, outputs: Sequence[str]) -> Lookup:
    table = part.select(key.alias(KEY),
                        *[F.col(p).alias(o) for p, o in zip(lookup.payload, outputs)], "__covered")
    keys, rows, size = lookup.sizes[number]
    return Lookup(table, [KEY], list(outputs), "__covered", keys, rows, size)


def attach_features(
    df: DataFrame,
    lookup: FeatureLookup,
    outputs: Mapping[str, Sequence[str]],
    row_id: str | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Attach the payload of several features; ``outputs`` names it per feature.

    Features with small tables are broadcast, within one shared size budget: as joins, or if there are
    more than ``JOIN_BLOCK`` of them all in one pass over Arrow batches. Of
    the others, each costs a shuffled join, unless ``row_id`` is given: then
    they are joined together in long form and folded back per row.
    """
    number = {f: i for i, f in enumerate(lookup.features)}
    wanted = [f for f in outputs]
    require_columns(df, wanted)
    budget, small, large = BROADCAST_BYTES, [], []
    for f in sorted(wanted, key=lambda f: lookup.sizes[number[f]][2]):
        size = lookup.sizes[number[f]][2]
        if size <= budget:
            budget -= size
            small.append(f)
        else:
            large.append(f)
    out, together = df, [f for f in wanted if f in small]
    if len(together) > JOIN_BLOCK:
        # more joins than a plan should hold; their tables share one budget, so together they fit a worker
        out = _attach_batches(out, lookup, {f: outputs[f] for f in together}, number, null_safe)
    else:
        for f in together:
            out = _attach_one(out, lookup, f, number[f], outputs[f], null_safe)
    large = [f for f in wanted if f in large]
    if row_id is None or len(large) < 2:
        for f in large:
            out = _attach_one(out, lookup, f, number[f], outputs[f], null_safe)
    else:
        out = _attach_long(out, lookup, {f: outputs[f] for f in large}, number, row_id, null_safe)
    order = [c for c in df.columns] + [o for f in wanted for o in outputs[f]]
    return out.select(*[F.col(f"`{c}`") for c in order])


def _attach_batches(df: DataFrame, lookup: FeatureLookup, outputs, number, null_safe: bool) -> DataFrame:
    """Look up many small features in one pass over the rows, without a shuffle or a write.

    The tables, of a measured size, are broadcast to the workers; each batch finds the places of its keys
    and takes the payloads from there.
    """
    features = list(outputs)
    wanted = lookup.table.filter(F.col(FEATURE).isin([number[f] for f in features])).select(FEATURE, KEY, *lookup.payload)
    found = wanted.toArrow()
    tables = {}
    for f in features:
        own = found.filter(pc.equal(found.column(FEATURE), number[f])).combine_chunks()
        tables[f] = (own.column(KEY).combine_chunks(), [own.column(p).combine_chunks() for p in lookup.payload])
    sent = df.sparkSession.sparkContext.broadcast(tables)
    kinds = [wanted.schema[p].dataType for p in lookup.payload]
    schema = T.StructType([*df.schema.fields, *[T.StructField(o, kind) for f in features for o, kind in zip(outputs[f], kinds)]])
    typed = df.withColumns({f"__key{i}": F.col(f"`{f}`").cast(lookup.types[f]) for i, f in enumerate(features)})
    keyed = typed.select(*[F.col(f"`{c}`") for c in df.columns], *[key_text(typed, f"__key{i}").alias(f"__key{i}") for i in range(len(features))])
    width = len(df.columns)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            arrays = list(batch.columns[:width])
            for i, f in enumerate(features):
                keys, payload = known[f]
                at = pc.index_in(batch.column(width + i).cast(keys.type), value_set=keys, skip_nulls=not null_safe)
                arrays += [p.take(at) for p in payload]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return keyed.mapInArrow(run, schema)


def _attach_long(df, lookup, outputs, number, row_id, null_safe) -> DataFrame:
    features = list(outputs)
    pairs = F.array(*[F.struct(F.lit(number[f]).alias(FEATURE), key_text(df, f).alias(KEY)) for f in features])
    long = df.select(F.col(row_id).alias("__row"), F.explode(pairs).alias("__pair")).select(
        "__row", f"__pair.{FEATURE}", f"__pair.{KEY}")
    part = lookup.table.filter(F.col(FEATURE).isin([number[f] for f in features]))
    sizes = [lookup.sizes[number[f]] for f in features]
    whole = Lookup(part, [FEATURE, KEY], lookup.payload, "__covered",
                   sum(s[0] for s in sizes), sum(s[1] for s in sizes), sum(s[2] for s in sizes))
    found = attach(long, whole, null_safe=null_safe)
    names = [(f, p, o) for f in features for p, o in zip(lookup.payload, outputs[f])]
    back = found.groupBy("__row").agg(*[
        F.max(F.when(F.col(FEATURE) == number[f], F.col(p))).alias(o) for f, p, o in names])
    return df.join(back, df[row_id] == back["__row"], "left").drop("__row")

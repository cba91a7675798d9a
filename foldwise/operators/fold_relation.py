"""Folds as a relation: rows (key, fold, role), so that pairs of training and validation rows may be any.

A row can train some folds, measure others, measure several (overlapping or
repeated folds) or take no part in a fold (gaps, expanding windows). Fold numbers are
rows, not columns, so their number does not widen any plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.frame import key_text, materialise, number_or_none, require_columns, require_numeric
from foldwise.operators.encode_stats import observed_folds
from foldwise.operators.folds import contiguous_kfold, kfold
from foldwise.operators.lookup import FEATURE, KEY, Lookup, attach, fit_lookup, long_keys

TRAIN, VALID = "train", "valid"


def _rows(df: DataFrame, key: str, pairs: Column) -> DataFrame:
    """(key, fold, role) from an array of (fold, role) per row."""
    return df.select(F.col(key), F.inline(pairs))


def relation_of_folds(df: DataFrame, key: str, fold: str = "fold") -> DataFrame:
    """The relation of a fold column: a row measures its own fold and trains the others; a null fold takes no part."""
    require_columns(df, [key, fold])
    known = F.lit([int(k) for k in observed_folds(df, fold)]).cast("array<int>")
    pairs = F.transform(known, lambda k: F.struct(k.alias("fold"), F.when(k == F.col(fold), VALID).otherwise(TRAIN).alias("role")))
    return _rows(df.filter(F.col(fold).isNotNull()), key, pairs)


def repeated_folds(df: DataFrame, key: str, n_splits: int = 5, repeats: int = 2, seed: int = 0) -> DataFrame:
    """``repeats`` shuffles into ``n_splits`` folds each, numbered one after the other; a row measures one fold of each shuffle."""
    if repeats < 1:
        raise ValueError("repeats must be at least 1")
    out, names = df.select(key), [f"__fold{r}" for r in range(repeats)]
    for r, name in enumerate(names):
        out = kfold(out, key, n_splits, seed + r, out=name)
    own = F.array(*[F.col(n) + r * n_splits for r, n in enumerate(names)])
    pairs = F.transform(F.sequence(F.lit(0), F.lit(n_splits * repeats - 1)), lambda k: F.struct(
        k.alias("fold"), F.when(F.array_contains(own, k), VALID).otherwise(TRAIN).alias("role")))
    return _rows(out, key, pairs)


def expanding_folds(df: DataFrame, key: str, n_splits: int = 5, gap: int = 0, window: int | None = None) -> DataFrame:
    """Consecutive blocks in the order of the key: fold ``i`` measures block ``i + 1`` and trains on the blocks before.

    There are ``n_splits + 1`` blocks. ``gap`` blocks before the measured one are left out, ``window``
    bounds how many blocks train. Folds without training blocks are left out.
    """
    if gap < 0 or (window is not None and window < 1):
        raise ValueError("gap must be at least 0 and window at least 1")
    if gap > n_splits - 1:
        raise ValueError("the gap leaves no training blocks")
    blocks = contiguous_kfold(df.select(key), key, n_splits + 1, out="__block")
    block, longest = F.col("__block"), window or n_splits
    ahead = F.sequence(F.lit(gap), F.lit(n_splits - 1))  # fold i has training blocks from i = gap on
    pairs = F.transform(ahead, lambda i: F.struct(i.alias("fold"), F.when(block == i + 1, VALID).when(
        (block <= i - gap) & (block > i - gap - longest), TRAIN).alias("role")))
    return _rows(blocks, key, F.filter(pairs, lambda p: p.role.isNotNull()))


def folds_of_conditions(df: DataFrame, key: str, pairs: Sequence[tuple[Column, Column]]) -> DataFrame:
    """Fold ``i`` trains on the rows of the first and measures those of the second condition of the i-th pair.

    A row of both only measures. Conditions that are null do not hold.
    """
    require_columns(df, [key])
    given = F.array(*[F.struct(F.lit(i).alias("fold"), F.when(valid, VALID).when(train, TRAIN).alias("role"))
                      for i, (train, valid) in enumerate(pairs)])
    return _rows(df, key, F.filter(given, lambda p: p.role.isNotNull()))


def check_relation(relation: DataFrame, key: str) -> list[int]:
    """Fold numbers; an error if a row both trains and measures a fold, or has another role."""
    require_columns(relation, [key, "fold", "role"], "relation")
    roles = relation.groupBy(key, "fold").agg(F.min("role").alias("a"), F.max("role").alias("b"))
    if roles.filter((F.col("a") != F.col("b")) | ~F.col("a").isin(TRAIN, VALID) | F.col("fold").isNull()).limit(1).count():
        raise ValueError("a row must have one role, 'train' or 'valid', in a fold")
    return sorted(r["fold"] for r in relation.select("fold").distinct().collect())


# -- target encoding


@dataclass(frozen=True)
class RelationTargetModel:
    """Encoded values by (fold, feature, category), a prior per fold, and values of all training rows."""

    lookup: Lookup
    priors: DataFrame
    whole: Lookup
    features: list[str]
    key: str
    prior: float
    suffix: str

    def transform_pairs(self, df: DataFrame, relation: DataFrame) -> DataFrame:
        """All columns of ``df`` with ``fold`` and the encodings, one row for each fold that a row measures.

        A row that measures no fold appears once, with a null fold and null encodings.
        """
        require_columns(df, [self.key, *self.features])
        asked = relation.filter(F.col("role") == VALID).select(F.col(self.key).alias("__id"), F.col("fold").alias("__fold")).distinct()
        names = [f"{f}{self.suffix}" for f in self.features]
        kept = [c for c in df.columns if c not in (*names, "fold")]
        rows = df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*kept, self.key, *self.features])])
        pairs = rows.select(self.key, *[f for f in self.features if f != self.key]).join(asked, F.col(self.key) == F.col("__id"))
        long = long_keys(pairs, self.features, [F.col("__id"), F.col("__fold")])
        found = attach(long, self.lookup, ["__fold", FEATURE, KEY])
        wide = found.groupBy("__id", "__fold").agg(*[
            F.max(F.when(F.col(FEATURE) == i, F.col("value"))).alias(f"__v{i}") for i in range(len(self.features))])
        wide = wide.join(F.broadcast(self.priors), "__fold")  # a row per fold
        joined = rows.join(wide, F.col(self.key) == F.col("__id"), "left")
        return joined.select(*[F.col(f"`{c}`") for c in kept], F.col("__fold").alias("fold"), *[
            F.coalesce(F.col(f"__v{i}"), F.col("__prior")).alias(n) for i, n in enumerate(names)])

    def transform(self, df: DataFrame) -> DataFrame:
        """Rows outside the training data get the values of all of it."""
        out, names = df, [f"{f}{self.suffix}" for f in self.features]
        out = out.select(*[F.col(f"`{c}`") for c in out.columns if c not in names])
        for i, (f, name) in enumerate(zip(self.features, names)):
            long = out.withColumns({"__f": F.lit(i), "__k": key_text(out, f)})
            out = attach(long, self.whole, ["__f", "__k"]).withColumn(
                name, F.coalesce("value", F.lit(self.prior))).drop("__f", "__k", "value")
        return out


def _encoded(rows: DataFrame, by: Sequence[str], prior: Column, smoothing: float | None) -> DataFrame:
    stats = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.sum("__y").alias("s"), F.count("__y").alias("n"))
    mean = F.try_divide("s", F.col("n").cast("double"))
    value = mean if smoothing is None else F.when(F.col("n") > 0, F.try_divide(
        F.col("s") + F.lit(smoothing) * prior, F.col("n") + F.lit(smoothing)))
    return stats.withColumn("value", value)


def fit_relation_target_encoder(
    train: DataFrame, features: Sequence[str], target: str, key: str, relation: DataFrame, smoothing: float = 10.0,
    use_smoothing: bool = True, suffix: str = "_te",
) -> RelationTargetModel:
    """Mean target of each category from the training rows of each fold of a relation.

    Statistics are rows by (fold, feature, category), added up in one pass over the pairs of the relation; unseen and null
    categories get the mean target of the fold's training rows. Keys must be unique.
    """
    features, amount = list(features), float(smoothing) if use_smoothing else None
    if not features:
        raise ValueError("feature list must not be empty")
    require_columns(train, [*features, key])
    require_numeric(train, [target])
    check_relation(relation, key)
    trains = relation.filter(F.col("role") == TRAIN).select(F.col(key).alias("__id"), F.col("fold").alias("__fold")).distinct()
    y = F.col(target).cast("double").alias("__y")
    columns = list(dict.fromkeys([key, *features]))
    pairs = train.select(*columns, y).join(trains, F.col(key) == F.col("__id"))
    overall = number_or_none(train.agg(F.avg(y)).first()[0])
    overall = 0.0 if overall is None else overall
    folds = relation.select(F.col("fold").alias("__fold")).distinct()
    priors = pairs.groupBy("__fold").agg(F.avg("__y").alias("__prior"))
    priors = materialise(folds.join(priors, "__fold", "left").select("__fold", F.coalesce("__prior", F.lit(overall)).alias("__prior")))
    long = long_keys(pairs, features, [F.col("__fold"), F.col("__y")]).filter(F.col(KEY).isNotNull())
    long = long.join(F.broadcast(priors), "__fold")  # a row per fold
    by_fold = _encoded(long, ["__fold", "__prior", FEATURE, KEY], F.col("__prior"), amount)
    lookup = fit_lookup(by_fold, ["__fold", FEATURE, KEY], ["value"], rows="rows")
    every = long_keys(train, features, [y]).filter(F.col(KEY).isNotNull())
    whole = fit_lookup(_encoded(every, [FEATURE, KEY], F.lit(overall), amount), [FEATURE, KEY], ["value"], rows="rows")
    return RelationTargetModel(lookup, priors, whole, features, key, overall, suffix)

"""Encodings by count, by ratio to the category mean and by target statistic."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldwise.frame import number_or_none, require_columns, require_numeric
from foldwise.operators.lookup import (
    FEATURE, KEY, FeatureLookup, Lookup, attach, attach_features, fit_features, fit_lookup, long_keys,
)
from foldwise.operators.order_stats import RANGE, split_ranges


def _pick_source(train: DataFrame, test: DataFrame | None, which: str, columns: Sequence[str]) -> DataFrame:
    if which not in ("train", "test", "combined"):
        raise ValueError("the source must be 'train', 'test' or 'combined'")
    if which != "train" and test is None:
        raise ValueError(f"a test frame is required for source '{which}'")
    if which == "train":
        return train.select(*columns)
    if which == "test":
        return test.select(*columns)
    return train.select(*columns).unionByName(test.select(*columns))


# --- counts ---------------------------------------------------------------


@dataclass(frozen=True)
class CountModel:
    lookup: FeatureLookup
    normalize: bool
    handle_unknown: str
    suffix: str
    row_id: str | None = None

    def transform(self, df: DataFrame) -> DataFrame:
        outputs = {f: [f"{f}{self.suffix}"] for f in self.lookup.features}
        found = attach_features(df, self.lookup, outputs, self.row_id)
        dtype = "double" if self.normalize or self.handle_unknown == "nan" else "bigint"
        fill = F.lit(float("nan") if self.handle_unknown == "nan" else 0).cast(dtype)
        return found.withColumns({o: F.coalesce(F.col(o).cast(dtype), fill) for (o,) in outputs.values()})


def fit_count_encoder(
    source: DataFrame, features: Sequence[str], normalize: bool = False,
    handle_unknown: str = "zero", suffix: str = "_count", row_id: str | None = None,
) -> CountModel:
    """Rows per category, or the share of the non-null rows. Null counts as unknown."""
    if handle_unknown not in ("zero", "nan"):
        raise ValueError("handle_unknown must be 'zero' or 'nan'")
    long = long_keys(source, features).filter(F.col(KEY).isNotNull())
    counts = long.groupBy(FEATURE, KEY).agg(F.count(F.lit(1)).alias("rows"))
    value = F.col("rows")
    lookup = fit_features(counts.withColumn("value", value), source, features, ["value"], rows="rows")
    if normalize:
        totals = F.lit([max(lookup.sizes[i][1], 1) for i in range(len(lookup.features))])
        share = F.col("value") / F.element_at(totals, F.col(FEATURE) + 1)
        table = lookup.table.withColumn("value", share)
        lookup = FeatureLookup(table, lookup.features, lookup.types, ["value"], lookup.sizes)
    return CountModel(lookup, normalize, handle_unknown, suffix, row_id)


def apply_count_encoding(
    train: DataFrame, features: Sequence[str], test: DataFrame | None = None, count_on: str = "train",
    normalize: bool = False, handle_unknown: str = "zero", new_col_suffix: str = "_count",
    row_id: str | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    require_columns(train, features, "train")
    if test is not None:
        require_columns(test, features, "test")
    source = _pick_source(train, test, count_on, features)
    model = fit_count_encoder(source, features, normalize, handle_unknown, new_col_suffix, row_id)
    return model.transform(train), None if test is None else model.transform(test)


# --- ratio to category mean -----------------------------------------------


@dataclass(frozen=True)
class RatioModel:
    lookup: Lookup
    numeric: list[str]
    category: str
    suffix: str
    fill_value: float

    def transform(self, df: DataFrame) -> DataFrame:
        require_numeric(df, self.numeric)
        found = attach(df, self.lookup, on=[self.category], null_safe=True)
        ratios = []
        for c, mean in zip(self.numeric, self.lookup.payload):
            usable = F.col(c).isNotNull() & F.col(mean).isNotNull() & (F.col(mean) != 0)
            ratio = F.col(c).cast("double") / F.when(F.col(mean) != 0, F.col(mean))
            ratios.append(F.when(usable, ratio).otherwise(F.lit(float(self.fill_value))).alias(f"{c}{self.suffix}"))
        return found.select(*[F.col(c) for c in df.columns], *ratios)


def fit_ratio_encoder(
    source: DataFrame, numeric: Sequence[str], category: str, fill_value: float = 1.0,
    suffix_format: str = "_ratio_to_{cat}_mean",
) -> RatioModel:
    """Category means; a missing category is a group of its own."""
    require_numeric(source, numeric)
    require_columns(source, [category])
    means = source.groupBy(category).agg(
        F.count(F.lit(1)).alias("__rows"), *[F.avg(c).alias(f"__mean_{c}") for c in numeric])
    lookup = fit_lookup(means, [category], [f"__mean_{c}" for c in numeric], rows="__rows")
    return RatioModel(lookup, list(numeric), category, suffix_format.format(cat=category), fill_value)


def apply_ratio_to_category_mean_encoding(
    train: DataFrame, numerical_features: Sequence[str], category_col: str, test: DataFrame | None = None,
    calculate_mean_on: str = "train", fill_value: float = 1.0,
    new_col_suffix_format: str = "_ratio_to_{cat}_mean",
) -> tuple[DataFrame, DataFrame | None]:
    require_numeric(train, numerical_features)
    require_columns(train, [category_col], "train")
    if test is not None:
        require_numeric(test, numerical_features)
        require_columns(test, [category_col], "test")
    source = _pick_source(train, test, calculate_mean_on, [*numerical_features, category_col])
    model = fit_ratio_encoder(source, numerical_features, category_col, fill_value, new_col_suffix_format)
    return model.transform(train), None if test is None else model.transform(test)


# --- target statistics ----------------------------------------------------


@dataclass(frozen=True)
class TargetModel:
    """Encoded values per category: one for each fold (from the other folds), one from all rows."""

    lookup: FeatureLookup
    folds: list[int]
    fold_priors: list[float]
    global_prior: float
    fold_col: str
    suffix: str
    row_id: str | None = None

    def _attach(self, df: DataFrame) -> DataFrame:
        outputs = {f: [f"__oof_{f}", f"__all_{f}"] for f in self.lookup.features}
        return attach_features(df, self.lookup, outputs, self.row_id)

    def transform_train(self, df: DataFrame) -> DataFrame:
        """Each row gets the value computed without its own fold."""
        place = F.lit(None).cast("int")
        for i, fold in enumerate(self.folds, start=1):
            place = F.when(F.col(self.fold_col) == fold, i).otherwise(place)
        prior = F.element_at(F.lit(self.fold_priors), place)
        encoded = [
            F.when(place.isNotNull(), F.coalesce(F.element_at(F.col(f"__oof_{f}"), place), prior))
            .alias(f"{f}{self.suffix}")
            for f in self.lookup.features]
        return self._attach(df).select(*[F.col(c) for c in df.columns], *encoded)

    def transform(self, df: DataFrame) -> DataFrame:
        """Rows outside the training data get the value computed from all of it."""
        encoded = [F.coalesce(F.col(f"__all_{f}"), F.lit(self.global_prior)).alias(f"{f}{self.suffix}")
                   for f in self.lookup.features]
        return self._attach(df).select(*[F.col(c) for c in df.columns], *encoded)


def observed_folds(df: DataFrame, fold_col: str, max_folds: int | None = None) -> list[int]:
    """Fold numbers in the column; with ``max_folds``, an error if there are more."""
    found = df.filter(F.col(fold_col).isNotNull()).select(fold_col).distinct()
    rows = (found if max_folds is None else found.limit(max_folds + 1)).collect()
    if max_folds is not None and len(rows) > max_folds:
        raise ValueError(f"column '{fold_col}' has more than {max_folds} values and is no fold column")
    return sorted(r[0] for r in rows)


def _others(values: list[Column], skip: int) -> Column:
    rest = [v for i, v in enumerate(values) if i != skip]
    total = F.coalesce(rest[0], F.lit(0.0)) if rest else F.lit(0.0)
    for v in rest[1:]:
        total = total + F.coalesce(v, F.lit(0.0))
    return total


def _smoothed(stat: Column, n: Column, prior: float, smoothing: float | None) -> Column:
    if smoothing is None:
        return stat
    weighted = (n * stat + F.lit(smoothing * prior)) / F.nullif(n + F.lit(float(smoothing)), F.lit(0.0))
    return F.when(stat.isNotNull(), weighted)


def _mean_statistics(train, features, target, fold_col, folds):
    """(feature, key) rows with a target sum and count per fold; one shuffle of combined rows."""
    y = F.col(target).cast("double")
    long = long_keys(train, features, [y.alias("__y"), F.col(fold_col).alias("__fold")])
    parts = [F.count(F.lit(1)).alias("rows")]
    for i, fold in enumerate(folds):
        mine = F.when(F.col("__fold") == fold, F.col("__y"))
        parts += [F.sum(mine).alias(f"s{i}"), F.count(mine).alias(f"n{i}")]
    parts += [F.sum("__y").alias("s"), F.count("__y").alias("n")]
    return long.groupBy(FEATURE, KEY).agg(*parts)


def _order_statistics(train, features, target, fold_col, folds, prob):
    """(feature, key) rows with the quantile and count of the rows outside each fold.

    Equal (category, target) rows are counted once, with their number per fold;
    the rows outside a fold are the difference. The values are split into
    ranges, and only ranges that hold a wanted rank of some fold are ordered.
    What is shuffled does not grow with the number of folds.
    """
    y = F.col(target).cast("double")
    long = long_keys(train, features, [y.alias("__y"), F.col(fold_col).alias("__fold")])
    counted = long.filter(F.col("__y").isNotNull()).groupBy(FEATURE, KEY, "__y").agg(
        F.count(F.lit(1)).alias("__n"), *[F.count_if(F.col("__fold").eqNullSafe(F.lit(f))).alias(f"__f{i}") for i, f in enumerate(folds)])
    every = range(len(folds) + 1)  # the last stands for all rows
    parts = split_ranges(counted, "__y").select(FEATURE, KEY, RANGE, "__y", *[
        (F.col("__n") - F.col(f"__f{i}") if i < len(folds) else F.col("__n")).alias(f"__w{i}") for i in every])
    group = Window.partitionBy(FEATURE, KEY)
    before = group.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = parts.groupBy(FEATURE, KEY, RANGE).agg(*[F.sum(f"__w{i}").alias(f"__s{i}") for i in every])
    sizes = sizes.select(
        F.col(FEATURE).alias("__lf"), F.col(KEY).alias("__lk"), F.col(RANGE).alias("__lr"), *[f"__s{i}" for i in every],
        *[F.sum(f"__s{i}").over(group).alias(f"__t{i}") for i in every],
        *[(F.sum(f"__s{i}").over(before) - F.col(f"__s{i}")).alias(f"__b{i}") for i in every])

    def position(i):
        return F.lit(float(prob)) * (F.col(f"__t{i}") - 1)

    def ranks(i):
        return F.floor(position(i)).cast("bigint"), F.ceil(position(i)).cast("bigint")

    wanted = F.lit(False)
    for i in every:
        for rank in ranks(i):
            wanted = wanted | ((F.col(f"__t{i}") > 0) & (rank >= F.col(f"__b{i}")) & (rank < F.col(f"__b{i}") + F.col(f"__s{i}")))
    located = sizes.filter(wanted)
    near = parts.join(located, (F.col(FEATURE) == F.col("__lf")) & F.col(KEY).eqNullSafe(F.col("__lk")) & (F.col(RANGE) == F.col("__lr")))
    inside = Window.partitionBy(FEATURE, KEY, RANGE).orderBy("__y").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ended = near.withColumns({f"__e{i}": F.col(f"__b{i}") + F.sum(f"__w{i}").over(inside) for i in every})
    picked = []
    for i in every:
        for name, rank in zip(("low", "high"), ranks(i)):
            here = (rank < F.col(f"__e{i}")) & (rank >= F.col(f"__e{i}") - F.col(f"__w{i}"))
            picked.append(F.max(F.when(here, F.col("__y"))).alias(f"__{name}{i}"))
        picked.append(F.coalesce(F.max(f"__t{i}"), F.lit(0)).alias(f"__t{i}"))
    found, out = ended.groupBy(FEATURE, KEY).agg(*picked), []
    for i in every:
        name = str(i) if i < len(folds) else ""
        (low, high), low_value, high_value = ranks(i), F.col(f"__low{i}"), F.col(f"__high{i}")
        value = F.when(low == high, low_value).otherwise(low_value * (high - position(i)) + high_value * (position(i) - low))
        out += [value.alias(f"q{name}"), F.col(f"__t{i}").alias(f"n{name}")]
    return found.select(FEATURE, KEY, *out).withColumn("rows", F.col("n"))


def _mean_parts(fitted: FeatureLookup, k: int):
    """Overall mean, mean outside each fold, and the same per category as (mean, rows), from sums and counts per fold."""
    # every row has one key of the first feature, so its rows sum to the whole
    row = fitted.table.filter(F.col(FEATURE) == 0).agg(
        *[F.sum(c).alias(c) for i in range(k) for c in (f"s{i}", f"n{i}")],
        F.sum("s").alias("s"), F.sum("n").alias("n")).first()
    overall = row["s"] / row["n"] if row["n"] else None
    fold_stats = []
    for i in range(k):
        n = sum(row[f"n{j}"] or 0 for j in range(k) if j != i)
        s = sum(row[f"s{j}"] or 0.0 for j in range(k) if j != i)
        fold_stats.append(s / n if n else None)
    sums, counts = [F.col(f"s{i}") for i in range(k)], [F.col(f"n{i}").cast("double") for i in range(k)]
    outside = [(F.try_divide(_others(sums, i), F.nullif(_others(counts, i), F.lit(0.0))), _others(counts, i))
               for i in range(k)]
    whole = (F.try_divide(F.col("s"), F.nullif(F.col("n").cast("double"), F.lit(0.0))), F.col("n").cast("double"))
    return overall, fold_stats, outside, whole


def _target_model(fitted, features, folds, overall, fold_stats, outside, whole, amount, prior, fold_col, suffix, row_id) -> TargetModel:
    global_prior = number_or_none(overall)
    global_prior = 0.0 if global_prior is None else global_prior
    fold_priors = [number_or_none(s) for s in fold_stats]
    fold_priors = [global_prior if p is None or prior == "global" else p for p in fold_priors]
    encoded = fitted.table.filter(F.col(KEY).isNotNull()).select(
        FEATURE, KEY, "__covered",
        F.array(*[_smoothed(stat, n, p, amount) for (stat, n), p in zip(outside, fold_priors)]).alias("oof"),
        _smoothed(*whole, global_prior, amount).alias("whole"))
    # the encoded rows are narrower than the measured statistics, so their sizes still bound them
    lookup = FeatureLookup(encoded, features, fitted.types, ["oof", "whole"], fitted.sizes)
    return TargetModel(lookup, folds, fold_priors, global_prior, fold_col, suffix, row_id)


def fit_target_encoder(
    train: DataFrame,
    features: Sequence[str],
    target: str,
    fold_col: str,
    agg_stat: str = "mean",
    percentile: float | None = None,
    smoothing: float = 10.0,
    use_smoothing: bool = True,
    prior: str = "fold",
    folds: Sequence[int] | None = None,
    suffix: str = "_te",
    row_id: str | None = None,
) -> TargetModel:
    """Fit leakage-safe target encoding for all features together.

    ``prior='fold'`` falls back to the statistic of the other folds' rows for an
    unseen category, ``prior='global'`` to that of all rows.
    """
    if agg_stat not in ("mean", "median", "percentile"):
        raise ValueError("agg_stat must be 'mean', 'median' or 'percentile'")
    if agg_stat == "percentile" and percentile is None:
        raise ValueError("percentile is required for agg_stat 'percentile'")
    if prior not in ("fold", "global"):
        raise ValueError("prior must be 'fold' or 'global'")
    if not features:
        raise ValueError("feature list must not be empty")
    require_columns(train, [*features, fold_col])
    require_numeric(train, [target])
    features = list(features)
    folds = list(folds) if folds is not None else observed_folds(train, fold_col)
    k = len(folds)
    amount = float(smoothing) if use_smoothing else None

    if agg_stat == "mean":
        fitted = fit_features(
            _mean_statistics(train, features, target, fold_col, folds), train, features,
            [x for i in range(k) for x in (f"s{i}", f"n{i}")] + ["s", "n"], rows="rows")
        overall, fold_stats, outside, whole = _mean_parts(fitted, k)
    else:
        prob = 0.5 if agg_stat == "median" else float(percentile) / 100.0
        # a constant as one more feature gives the priors in the same pass
        rows = train.withColumn("__one", F.lit(0))
        names = [x for i in range(k) for x in (f"q{i}", f"n{i}")] + ["q", "n"]
        fitted = fit_features(
            _order_statistics(rows, [*features, "__one"], target, fold_col, folds, prob), rows,
            [*features, "__one"], names, rows="rows")
        priors = fitted.table.filter(F.col(FEATURE) == len(features)).first()
        overall = priors["q"] if priors else None
        fold_stats = [priors[f"q{i}"] if priors else None for i in range(k)]
        outside = [(F.col(f"q{i}"), F.col(f"n{i}").cast("double")) for i in range(k)]
        whole = (F.col("q"), F.col("n").cast("double"))

    return _target_model(fitted, features, folds, overall, fold_stats, outside, whole, amount, prior, fold_col, suffix, row_id)


def apply_target_encoding(
    train: DataFrame, features: Sequence[str], target: str, fold_col: str,
    test: DataFrame | None = None, new_col_suffix: str = "_te", **options,
) -> tuple[DataFrame, DataFrame | None]:
    if test is not None:
        require_columns(test, features, "test")
    model = fit_target_encoder(train, features, target, fold_col, suffix=new_col_suffix, **options)
    return model.transform_train(train), None if test is None else model.transform(test)


__all__ = [
    "CountModel", "RatioModel", "TargetModel", "apply_count_encoding",
    "apply_ratio_to_category_mean_encoding", "apply_target_encoding", "fit_count_encoder",
    "fit_ratio_encoder", "fit_target_encoder", "observed_folds",
]

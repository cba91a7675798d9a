"""One-hot, ordinal and binned encodings."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.frame import is_float, require_columns, require_numeric
from foldwise.functions.scalar import count_edges
from foldwise.operators.lookup import FEATURE, KEY, FeatureLookup, attach_features, fit_features, long_keys
from foldwise.operators.order_stats import dense_index, nearest_quantiles


def native_value(text: str | None, dtype: T.DataType):
    """A category from its text form."""
    if text is None:
        return None
    if isinstance(dtype, T.IntegralType):
        return int(text)
    if isinstance(dtype, T.FractionalType):
        return float(text)
    if isinstance(dtype, T.BooleanType):
        return text == "true"
    return text


#: columns that one feature may become; a plan holds no more
ONE_HOT_COLUMNS = 10_000


def observed_categories(df: DataFrame, features: Sequence[str], max_categories: int | None = None) -> dict[str, list]:
    """Sorted distinct values per feature, null last; each becomes a column.

    With ``max_categories``, a feature with more values is an error.
    """
    require_columns(df, features)
    distinct = long_keys(df, features).distinct()
    if max_categories is not None:
        sizes = distinct.groupBy(FEATURE).count().filter(F.col("count") > max_categories).collect()
        if sizes:
            wide = sorted(features[r[FEATURE]] for r in sizes)
            raise ValueError(f"more than {max_categories} categories in columns: {wide}")
    found = distinct.collect()
    out = {}
    for i, f in enumerate(features):
        values = [native_value(r[KEY], df.schema[f].dataType) for r in found if r[FEATURE] == i]
        out[f] = sorted(v for v in values if v is not None) + ([None] if None in values else [])
    return out


@dataclass(frozen=True)
class OneHotModel:
    categories: dict[str, list]
    handle_unknown: str = "ignore"
    prefix: str = ""
    drop_original: bool = True

    def names(self, feature: str) -> list[str]:
        return [f"{self.prefix}{feature}_{v}" for v in self.categories[feature]]

    def transform(self, df: DataFrame) -> DataFrame:
        require_columns(df, self.categories)
        added = []
        for f, values in self.categories.items():
            column = F.col(f)
            known = [v for v in values if v is not None]
            fallback: Column = F.lit(0.0)
            if self.handle_unknown == "error":
                allowed = column.isin(known) if known else F.lit(False)
                allowed = F.coalesce(allowed, F.lit(None in values))
                fallback = F.when(allowed, 0.0).otherwise(
                    F.raise_error(F.lit(f"unknown category in column '{f}'")).cast("double"))
            for value, name in zip(values, self.names(f)):
                hit = column.isNull() if value is None else column.eqNullSafe(F.lit(value))
                added.append(F.when(hit, 1.0).otherwise(fallback).alias(name))
        kept = [F.col(c) for c in df.columns if not (self.drop_original and c in self.categories)]
        return df.select(*kept, *added)


def fit_onehot(
    df: DataFrame, features: Sequence[str], handle_unknown: str = "ignore",
    prefix: str = "", drop_original: bool = True, max_categories: int | None = ONE_HOT_COLUMNS,
) -> OneHotModel:
    """One column per category. More than ``max_categories`` of a feature are an error: ``fit_onehot_vector`` has no bound."""
    if handle_unknown not in ("ignore", "error"):
        raise ValueError("handle_unknown must be 'ignore' or 'error'")
    return OneHotModel(observed_categories(df, features, max_categories), handle_unknown, prefix, drop_original)


@dataclass(frozen=True)
class OrdinalModel:
    """Sorted position of each category; the table may be of any size."""

    lookup: FeatureLookup
    handle_unknown: str = "error"
    unknown_value: float | None = None
    add_one: bool = False
    prefix: str = ""
    drop_original: bool = False

    def transform(self, df: DataFrame) -> DataFrame:
        require_columns(df, self.lookup.features)
        codes = {}
        out = attach_features(df, self.lookup, {f: [f"__code{i}"] for i, f in enumerate(self.lookup.features)})
        for i, f in enumerate(self.lookup.features):
            code = F.col(f"__code{i}") + (1 if self.add_one else 0)
            missing = F.col(f).isNull()
            if self.handle_unknown == "error":
                codes[f] = F.when(missing, F.lit(None).cast("bigint")).when(code.isNotNull(), code).otherwise(
                    F.raise_error(F.lit(f"unknown category in column '{f}'")).cast("bigint"))
            elif self.unknown_value is None:
                codes[f] = F.when(missing, F.lit(None).cast("double")).otherwise(
                    F.coalesce(code.cast("double"), F.lit(float("nan"))))
            else:
                codes[f] = F.when(missing, F.lit(None).cast("bigint")).otherwise(
                    F.coalesce(code, F.lit(self.unknown_value).cast("bigint")))
        if not self.prefix:
            return out.select(*[codes[c].alias(c) if c in codes else F.col(c) for c in df.columns])
        kept = [F.col(c) for c in df.columns if not (self.drop_original and c in codes)]
        return out.select(*kept, *[codes[f].alias(f"{self.prefix}{f}") for f in codes])


def fit_ordinal(
    df: DataFrame, features: Sequence[str], handle_unknown: str = "error",
    unknown_value: float | None = None, add_one: bool = False, prefix: str = "",
    drop_original: bool = False,
) -> OrdinalModel:
    """Without a prefix the codes replace the columns; with one they are added."""
    if handle_unknown not in ("error", "use_encoded_value"):
        raise ValueError("handle_unknown must be 'error' or 'use_encoded_value'")
    require_columns(df, features)
    features = list(dict.fromkeys(features))
    values = long_keys(df, features).filter(F.col(KEY).isNotNull()).groupBy(FEATURE, KEY).agg(F.count(F.lit(1)).alias("rows"))
    # numbers are ordered as numbers (whole ones exactly), all else as text
    whole = [i for i, f in enumerate(features) if isinstance(df.schema[f].dataType, (T.IntegralType, T.DecimalType))]
    floats = [i for i, f in enumerate(features) if is_float(df, f)]
    values = values.select(
        FEATURE, F.when(F.col(FEATURE).isin(whole), F.col(KEY).try_cast("decimal(38,10)")).alias("__exact"),
        F.when(F.col(FEATURE).isin(floats), F.col(KEY).try_cast("double")).alias("__float"), KEY, "rows")
    # one range-partitioned pass over the distinct values of all features
    ranked = dense_index(values, [FEATURE, "__exact", "__float", KEY], out="place")
    starts = {r[FEATURE]: r["start"] for r in ranked.groupBy(FEATURE).agg(F.min("place").alias("start")).collect()}
    start = F.lit([starts.get(i, 0) for i in range(len(features))]).cast("array<bigint>")
    coded = ranked.withColumn("code", F.col("place") - F.element_at(start, F.col(FEATURE) + 1))
    return OrdinalModel(fit_features(coded, df, features, ["code"], rows="rows"), handle_unknown, unknown_value, add_one, prefix, drop_original)


@dataclass(frozen=True)
class OneHotVectorModel:
    """One sparse vector with a slot per category of every feature, in sorted order."""

    ordinal: OrdinalModel
    slots: dict[str, int]
    out: str

    def transform(self, df: DataFrame) -> DataFrame:
        names = [f"{self.ordinal.prefix}{f}" for f in self.slots]
        coded = self.ordinal.transform(df)
        # missing and unknown categories take one more code, the last, which has no slot
        coded = coded.withColumns({
            n: F.coalesce(F.nanvl(F.col(n).cast("double"), F.lit(float(size))), F.lit(float(size)))
            for n, size in zip(names, self.slots.values())})
        last = df.sparkSession.createDataFrame([tuple(float(size) for size in self.slots.values())], names)
        vectors = [f"{n}_slots" for n in names]
        encoded = OneHotEncoder(inputCols=names, outputCols=vectors, dropLast=True).fit(last).transform(coded)
        return VectorAssembler(inputCols=vectors, outputCol=self.out).transform(encoded).select(*df.columns, self.out)


def fit_onehot_vector(df: DataFrame, features: Sequence[str], out: str = "onehot") -> OneHotVectorModel:
    """One-hot codes as one sparse vector, for features with many categories.

    No category is brought to the driver; missing and unknown ones have no slot.
    """
    ordinal = fit_ordinal(df, features, "use_encoded_value", prefix="__code_")
    sizes = ordinal.lookup.sizes
    return OneHotVectorModel(ordinal, {f: sizes[i][0] for i, f in enumerate(ordinal.lookup.features)}, out)


def fit_label(df: DataFrame, features: Sequence[str], prefix: str = "") -> OrdinalModel:
    """Strict label encoding: a category not seen at fit time is an error."""
    return fit_ordinal(df, features, handle_unknown="error", prefix=prefix)


def encode_categorical_features(
    train: DataFrame, features: Sequence[str], test: DataFrame | None = None,
    encoder_type: str = "onehot", handle_unknown: str | None = None, drop_original: bool = True,
    new_col_prefix: str = "", add_one: bool = False, unknown_value: float | None = None,
):
    """Fit one-hot or ordinal codes on ``train`` and apply them to both frames."""
    kind = encoder_type.lower()
    if test is not None:
        require_columns(test, features, "test")
    if kind == "onehot":
        model = fit_onehot(train, features, handle_unknown or "ignore", new_col_prefix, drop_original)
    elif kind == "ordinal":
        rule = handle_unknown if handle_unknown == "use_encoded_value" else "error"
        model = fit_ordinal(train, features, rule, unknown_value, add_one, new_col_prefix, drop_original)
    else:
        raise ValueError(f"unknown encoder_type '{encoder_type}', expected 'onehot' or 'ordinal'")
    return model.transform(train), None if test is None else model.transform(test), model


@dataclass(frozen=True)
class BinModel:
    """Bin edges per feature and the bins seen at fit time (None: missing values)."""

    edges: dict[str, list[float]]
    seen: dict[str, list[int | None]]
    handle_unknown: str = "ignore"
    drop_original: bool = True
    names: dict[str, list[str]] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        require_columns(df, self.edges)
        added = []
        for f, bins in self.seen.items():
            index = count_edges(F.col(f), self.edges[f])
            fallback: Column = F.lit(0.0)
            if self.handle_unknown == "error":
                known = [b for b in bins if b is not None]
                allowed = F.coalesce(index.isin(known), F.lit(None in bins))
                fallback = F.when(allowed, 0.0).otherwise(
                    F.raise_error(F.lit(f"unknown bin in column '{f}'")).cast("double"))
            for b, name in zip(bins, self.names[f]):
                hit = index.isNull() if b is None else index.eqNullSafe(F.lit(b))
                added.append(F.when(hit, 1.0).otherwise(fallback).alias(name))
        kept = [F.col(c) for c in df.columns if not (self.drop_original and c in self.edges)]
        return df.select(*kept, *added)


def quantile_edges(df: DataFrame, features: Sequence[str], n_bins: int) -> dict[str, list[float]]:
    """Distinct nearest-rank quantiles at 0, 1/n, ..., 1 of each feature."""
    found = nearest_quantiles(df, features, [i / n_bins for i in range(n_bins + 1)])
    return {f: sorted(set(values)) for f, values in found.items()}


def uniform_edges(low: float | None, high: float | None, n_bins: int) -> list[float]:
    if low is None or high is None:
        return []
    if low == high:
        return [float(low)]
    step = (high - low) / n_bins
    return sorted({*(low + i * step for i in range(n_bins)), float(high)})


def fit_bins(
    df: DataFrame, features: Sequence[str], n_bins: int, strategy: str = "quantile",
    handle_unknown: str = "ignore",
) -> BinModel:
    """Left-closed bins ``[e_i, e_i+1)`` with open ends, one column per bin seen in ``df``."""
    if not features:
        raise ValueError("feature list must not be empty")
    if strategy not in ("quantile", "uniform"):
        raise ValueError("strategy must be 'quantile' or 'uniform'")
    require_numeric(df, features)
    bounds = df.agg(*[x for i, f in enumerate(features)
                      for x in (F.min(f).alias(f"lo{i}"), F.max(f).alias(f"hi{i}"))]).first()
    edges, quantiles = {}, quantile_edges(df, features, n_bins) if strategy == "quantile" else {}
    for i, f in enumerate(features):
        low, high = bounds[f"lo{i}"], bounds[f"hi{i}"]
        if low is None:
            raise ValueError(f"column '{f}' holds no values to bin")
        found = quantiles[f] if quantiles else uniform_edges(low, high, n_bins)
        if len(found) < 2:
            if low != high:
                raise ValueError(f"fewer than two distinct edges for column '{f}'")
            delta = abs(low * 1e-6) if low != 0 else 1e-6
            found = [low - delta, low + delta]
        edges[f] = found
    flags = []
    for i, f in enumerate(features):
        index = count_edges(F.col(f), edges[f])
        flags += [F.max(index == b).alias(f"s{i}_{b}") for b in range(len(edges[f]) + 1)]
        flags.append(F.max(index.isNull()).alias(f"s{i}_null"))
    row = df.agg(*flags).first()
    seen, names = {}, {}
    for i, f in enumerate(features):
        seen[f] = [b for b in range(len(edges[f]) + 1) if row[f"s{i}_{b}"]]
        if row[f"s{i}_null"]:
            seen[f].append(None)
        names[f] = [f"{f}_bin_{'null' if b is None else b}" for b in seen[f]]
    return BinModel(edges, seen, handle_unknown, True, names)


def bin_and_encode_numerical_features(
    train: DataFrame, features: Sequence[str], n_bins: int, test: DataFrame | None = None,
    strategy: str = "quantile", handle_unknown: str = "ignore",
):
    if test is not None:
        require_numeric(test, features)
    model = fit_bins(train, features, n_bins, strategy, handle_unknown)
    return model.transform(train), None if test is None else model.transform(test), model

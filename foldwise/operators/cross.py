"""Feature crosses: products, quotients, powers, polynomials and joined categories."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import chain, combinations, combinations_with_replacement
from operator import mul

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.frame import is_numeric, refuse_target, require_columns, require_numeric
from foldwise.functions.scalar import clip
from foldwise.operators.lookup import FEATURE, KEY, FeatureLookup, attach_features, fit_features, long_keys
from foldwise.operators.order_stats import dense_index

EXPONENT_BOUND = 10  # fixed value: exponents are limited to [-10, 10]


def create_interaction_features(
    df: DataFrame, pairs: Sequence[tuple[str, str]], dtype: str | None = "int",
    keep: Sequence[str] = (), target: str | None = None,
) -> DataFrame:
    """Products named by the sorted pair; ``dtype=None`` keeps the product's type.

    Only ``keep`` and the new columns are returned.
    """
    if not pairs:
        raise ValueError("pairs must not be empty")
    used = [c for pair in pairs for c in pair]
    refuse_target(used, target)
    require_numeric(df, used)
    products: dict[str, Column] = {}
    for pair in pairs:
        a, b = sorted(pair)
        product = F.col(a) * F.col(b)
        products.setdefault(f"{a}_x_{b}", product.cast(dtype) if dtype else product)
    return df.select(*keep, *[c.alias(n) for n, c in products.items()])


def add_feature_cross_terms(df: DataFrame, numeric: Sequence[str], target: str | None = None) -> DataFrame:
    """Append the product of every pair, in list order."""
    refuse_target(numeric, target)
    require_numeric(df, numeric)
    return df.select("*", *[(F.col(a) * F.col(b)).alias(f"{a}_x_{b}") for a, b in combinations(numeric, 2)])


def create_n_way_multiplication_features(
    df: DataFrame, features: Sequence[str], n_way_list: Sequence[int] | None = None,
    max_n_way: int = 2, name_sep: str = "_x_", target: str | None = None,
) -> tuple[DataFrame, list[str]]:
    """Append the product of every n-combination; unknown features and orders are left out."""
    refuse_target(features, target)
    orders = list(n_way_list) if n_way_list is not None else list(range(2, max_n_way + 1))
    known = [f for f in features if f in df.columns]
    combos = [c for n in orders if 2 <= n <= len(features) for c in combinations(known, n)]
    names = [name_sep.join(c) for c in combos]
    return df.select("*", *[
        reduce(mul, [F.col(f) for f in c]).alias(n) for c, n in zip(combos, names)]), names


def _divide(a: Column, b: Column, fill: float | None) -> Column:
    quotient = a / F.when(b != 0, b)
    if fill is None:
        return quotient
    return (F.when(a.isNull(), F.lit(None))
            .when(b.isNull() | (b == 0), F.lit(float(fill)))
            .when(F.isnan(quotient), F.lit(float(fill)))
            .otherwise(quotient))


def _power(base: Column, exponent: Column, fill: float | None) -> Column:
    limited = clip(exponent, -EXPONENT_BOUND, EXPONENT_BOUND)
    defined = (base >= 0) | (F.floor(limited).cast("double") == limited)
    other = F.lit(None).cast("double") if fill is None else F.lit(float(fill))
    return F.when(defined, F.pow(base, limited)).otherwise(other)


def create_enhanced_interaction_features(
    df: DataFrame, feature_pairs: Sequence[Mapping], keep: Sequence[str] = (), target: str | None = None
) -> DataFrame:
    """Guarded products, quotients and powers.

    Each entry has ``features`` (a pair), ``operation`` (multiply, divide or
    power) and an optional ``fill_value`` for undefined results, which are null
    without it. Only ``keep`` and the new columns are returned.
    """
    if not feature_pairs:
        raise ValueError("feature_pairs must not be empty")
    for entry in feature_pairs:
        if len(entry.get("features", ())) != 2:
            raise ValueError(f"'features' must be a pair: {entry}")
        if entry.get("operation") not in ("multiply", "divide", "power"):
            raise ValueError(f"'operation' must be multiply, divide or power: {entry}")
    used = [c for entry in feature_pairs for c in entry["features"]]
    refuse_target(used, target)
    require_numeric(df, used)
    out: dict[str, Column] = {}
    for entry in feature_pairs:
        (left, right), operation, fill = entry["features"], entry["operation"], entry.get("fill_value")
        a, b = F.col(left).cast("double"), F.col(right).cast("double")
        if operation == "multiply":
            name, value = "_mul_".join(sorted((left, right))), F.col(left) * F.col(right)
        elif operation == "divide":
            name, value = f"{left}_div_{right}", _divide(a, b, fill)
        else:
            name, value = f"{left}_pow_{right}", _power(a, b, fill)
        out.setdefault(name, value)
    return df.select(*keep, *[c.alias(n) for n, c in out.items()])


def create_polynomial_features(
    df: DataFrame, features: Sequence[str], degree: int = 2, interaction_only: bool = False,
    include_bias: bool = False, prefix: str = "poly_", keep: Sequence[str] = (), target: str | None = None,
) -> DataFrame:
    """All monomials of degree 1 to ``degree`` as doubles, e.g. ``poly_A^2`` and ``poly_A B``."""
    if degree < 1:
        raise ValueError("degree must be at least 1")
    refuse_target(features, target)
    require_numeric(df, features)
    choose = combinations if interaction_only else combinations_with_replacement
    columns = [F.lit(1.0).alias(f"{prefix}1")] if include_bias else []
    for term in chain.from_iterable(choose(features, d) for d in range(1, degree + 1)):
        powers = {f: term.count(f) for f in dict.fromkeys(term)}
        name = " ".join(f if p == 1 else f"{f}^{p}" for f, p in powers.items())
        columns.append(reduce(mul, [F.col(f).cast("double") for f in term]).alias(f"{prefix}{name}"))
    return df.select(*keep, *columns)


def nway_names(features: Sequence[str], n_ways: Sequence[int], sep: str = "_") -> dict[str, tuple[str, ...]]:
    return {f"{sep.join(c)}_inter{n}": c for n in n_ways for c in combinations(features, n)}


def create_nway_interaction_features(
    df: DataFrame,
    features: Sequence[str],
    n_ways: Sequence[int],
    sep: str = "_",
    encode_type: str = "none",
    add_one: bool = False,
    handle_nulls: str = "ignore",
    keep: Sequence[str] = (),
    row_id: str | None = None,
    target: str | None = None,
) -> DataFrame:
    """Join category values of every n-combination into one category.

    ``encode_type='none'`` gives the text, ``'count'`` the rows that share it,
    ``'label'`` its place in sorted order. Only ``keep`` and the new columns are
    returned. ``row_id`` lets many wide encodings share one join.
    """
    if not features:
        raise ValueError("feature list must not be empty")
    if not n_ways or not all(isinstance(n, int) and n >= 2 for n in n_ways):
        raise ValueError("n_ways must hold integers of at least 2")
    if encode_type not in ("none", "count", "label"):
        raise ValueError("encode_type must be 'none', 'count' or 'label'")
    if handle_nulls not in ("ignore", "propagate"):
        raise ValueError("handle_nulls must be 'ignore' or 'propagate'")
    refuse_target(features, target)
    require_columns(df, features)
    combos = nway_names(features, n_ways, sep)
    parts = {f: F.col(f).cast("string") for f in features}
    if handle_nulls == "ignore":
        parts = {f: F.coalesce(c, F.lit("null_str")) for f, c in parts.items()}
    texts = []
    for name, combo in combos.items():
        pieces = [parts[combo[0]]]
        for f in combo[1:]:
            pieces += [F.lit(sep), parts[f]]
        texts.append(F.concat(*pieces).alias(name))
    kept = list(dict.fromkeys([*keep, *([row_id] if row_id else [])]))
    joined = df.select(*kept, *texts)
    names = list(combos)
    if encode_type == "none" or not names:
        return joined.select(*keep, *names)
    fit = fit_shared_counts if encode_type == "count" else fit_shared_labels
    lookup = fit(joined, names)
    out = {n: f"{n}_{encode_type}" for n in names}
    found = attach_features(joined, lookup, {n: [out[n]] for n in names}, row_id, null_safe=encode_type == "count")
    shift = 1 if encode_type == "label" and add_one else 0
    return found.select(*keep, *[(F.col(o) + shift).alias(o) if shift else F.col(o) for o in out.values()])


def fit_shared_counts(df: DataFrame, columns: Sequence[str]) -> FeatureLookup:
    """Rows per value of each column, null included."""
    counts = long_keys(df, columns).groupBy(FEATURE, KEY).agg(F.count(F.lit(1)).alias("rows"))
    return fit_features(counts.withColumn("value", F.col("rows")), df, columns, ["value"], rows="rows")


def fit_shared_labels(df: DataFrame, columns: Sequence[str]) -> FeatureLookup:
    """Dense rank in byte order of each text column's values, starting at 0; null has none.

    All columns are ranked together in one range-partitioned pass over their
    distinct values.
    """
    if any(is_numeric(df, c) for c in columns):
        raise TypeError("labels by text order need text columns")
    values = long_keys(df, columns).filter(F.col(KEY).isNotNull()).groupBy(FEATURE, KEY).agg(
        F.count(F.lit(1)).alias("rows"))
    ranked = dense_index(values, [FEATURE, KEY], out="place")
    # one row per column
    starts = {r[FEATURE]: r["start"] for r in ranked.groupBy(FEATURE).agg(F.min("place").alias("start")).collect()}
    start = F.lit([starts.get(i, 0) for i in range(len(columns))]).cast("array<bigint>")
    labelled = ranked.withColumn("value", F.col("place") - F.element_at(start, F.col(FEATURE) + 1))
    return fit_features(labelled, df, columns, ["value"], rows="rows")

"""Column summaries, correlations and target-by-feature tables."""

from __future__ import annotations

import functools
import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.frame import is_float, is_numeric, key_text, numeric_columns, require_columns
from foldwise.operators.lookup import FEATURE, KEY, long_keys
from foldwise.operators.metrics import regression_metric
from foldwise.operators.order_stats import column_quantiles, grouped_quantiles

log = logging.getLogger(__name__)

# fixed values: default limits of the target-by-feature tables
MAX_NUMERIC_DISTINCT = 1000
MAX_DISTINCT_SHARE = 0.9
MIN_SPREAD = 1e-9
DEFAULT_CATEGORIES = 20


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact number of distinct non-null values per column, from one scan."""
    pairs = long_keys(df, columns).distinct()
    return pairs.groupBy(FEATURE).agg(F.count(KEY).alias("distinct"))


def calculate_feature_summary(
    df: DataFrame, count_null: bool = True, approx_distinct: bool = False, with_median: bool = True
) -> DataFrame:
    """One row per column: type, distinct and missing values, and moments of numeric columns.

    ``count_null`` counts null as one more distinct value.
    """
    columns = df.columns
    numeric = numeric_columns(df)
    medians = column_quantiles(df, numeric, [0.5]) if with_median else {}
    parts = []
    for i, c in enumerate(columns):
        number = F.col(c).cast("double") if c in numeric else None
        empty = F.lit(None).cast("double")
        median = medians.get(c)
        missing = F.count(F.lit(1)) - F.count(c)
        parts.append(F.struct(
            F.lit(i).alias(FEATURE), F.lit(c).alias("Column"),
            F.lit(df.schema[c].dataType.simpleString()).alias("DataType"),
            (F.approx_count_distinct(c) if approx_distinct else F.lit(0).cast("bigint")).alias("__distinct"),
            missing.alias("NumNull"),
            F.round(F.coalesce(F.try_divide(missing * F.lit(100.0), F.count(F.lit(1))), F.lit(0.0)), 2).alias("PctNull"),
            (F.avg(number) if number is not None else empty).alias("Mean"),
            (F.stddev_samp(number) if number is not None else empty).alias("StdDev"),
            F.lit(median[0] if median else None).cast("double").alias("Median"),
            (F.min(number) if number is not None else empty).alias("Min"),
            (F.max(number) if number is not None else empty).alias("Max")))
    rows = df.agg(F.array(*parts).alias("parts")).select(F.inline("parts"))
    if approx_distinct:
        found = rows.withColumn("NumUnique", F.col("__distinct"))
    else:
        # one row per column on either side
        found = rows.join(F.broadcast(distinct_counts(df, columns)), FEATURE, "left").withColumn(
            "NumUnique", F.coalesce(F.col("distinct"), F.lit(0)))
    if count_null:
        found = found.withColumn("NumUnique", F.col("NumUnique") + F.when(F.col("NumNull") > 0, 1).otherwise(0))
    return found.select("Column", "DataType", "NumUnique", "NumNull", "PctNull",
                        "Mean", "StdDev", "Median", "Min", "Max")


@dataclass(frozen=True)
class Correlations:
    """Correlation tables, each computed when it is first read; None where the data do not allow one."""

    features: list[str]
    rows: DataFrame | None
    target_name: str

    @functools.cached_property
    def long(self) -> DataFrame | None:
        """f1, f2, r for every ordered pair."""
        return correlation_pairs(self.rows, self.features) if len(self.features) >= 2 else None

    @functools.cached_property
    def matrix(self) -> DataFrame | None:
        """``feature`` and one column per feature."""
        if self.long is None:
            return None
        wide = self.long.groupBy("f1").pivot("f2", self.features).agg(F.first("r"))
        return wide.withColumnRenamed("f1", "feature").select("feature", *self.features)

    @functools.cached_property
    def target(self) -> DataFrame | None:
        """``feature`` and its correlation with the target, strongest first."""
        if not self.features or not is_numeric(self.rows, self.target_name):
            return None
        return target_correlations(self.rows, self.target_name, self.features)


def _varying(df: DataFrame, columns: Sequence[str]) -> list[str]:
    if not columns:
        return []
    row = df.agg(*[F.stddev_samp(F.col(c).cast("double")).alias(c) for c in columns]).first()
    return [c for c in columns if row[c] is not None and row[c] > MIN_SPREAD]


def _complete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    for c in columns:
        rows = rows.filter(F.col(c).isNotNull())
    return rows


def correlation_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every ordered pair over rows without nulls, in one pass.

    Null where a column does not vary over those rows.
    """
    rows = _complete(df, columns)
    spread = rows.agg(*[F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(columns)]).first()
    varies = [spread[f"s{i}"] is not None and spread[f"s{i}"] > MIN_SPREAD for i in range(len(columns))]
    matrix = None
    if any(varies):
        vectors = VectorAssembler(inputCols=list(columns), outputCol="v").transform(rows)
        matrix = Correlation.corr(vectors, "v").first()[0].toArray()
    return df.sparkSession.createDataFrame(
        [(a, b, float(matrix[i, j]) if varies[i] and varies[j] else None)
         for i, a in enumerate(columns) for j, b in enumerate(columns)],
        "f1 string, f2 string, r double")


def target_correlations(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    rows = _complete(df, [*columns, target])
    name = f"{target}_correlation"
    spread = F.stddev_samp(target) > MIN_SPREAD
    parts = []
    for c in columns:
        # a column can become constant once rows with nulls are gone
        usable = spread & (F.stddev_samp(c) > MIN_SPREAD)
        product = F.covar_samp(c, target) / F.nullif(F.stddev_samp(c) * F.stddev_samp(target), F.lit(0.0))
        parts.append(F.struct(F.lit(c).alias("feature"), F.when(usable, product).alias(name)))
    return rows.agg(F.array(*parts).alias("parts")).select(F.inline("parts")).orderBy(F.desc_nulls_last(name))


def calculate_correlations(
    df: DataFrame, target: str, feature_cols: Sequence[str] | None = None
) -> Correlations:
    """Feature-feature and feature-target correlations of the numeric columns that vary."""
    require_columns(df, [target])
    if feature_cols:
        require_columns(df, feature_cols)
        columns = [c for c in feature_cols if is_numeric(df, c)]
    else:
        columns = numeric_columns(df, [target])
    return Correlations(_varying(df, columns), df, target)


def top_correlations(table: DataFrame, value: str, k: int = 50) -> DataFrame:
    """The k largest by absolute value, then in order of value."""
    strongest = table.orderBy(F.desc_nulls_last(F.abs(F.col(value))), F.col(table.columns[0])).limit(k)
    return strongest.orderBy(F.desc_nulls_last(value))


def detect_feature_type(df: DataFrame, feature: str, max_categories: int | None = DEFAULT_CATEGORIES) -> str:
    """'numerical' for floats and for integers with many values, else 'categorical'."""
    if not is_numeric(df, feature):
        return "categorical"
    if is_float(df, feature):
        return "numerical"
    limit = max_categories or DEFAULT_CATEGORIES
    seen = df.select(feature).distinct().limit(limit + 1).count()
    return "numerical" if seen > limit else "categorical"


def _summarise(rows: DataFrame, group: str, target: str, order: str | None) -> DataFrame:
    stats = rows.groupBy(group).agg(F.count(F.lit(1)).alias("count"), F.avg(target).alias("target_mean"))
    medians = grouped_quantiles(rows.select(group, target), [group], target, [0.5], out="__m")
    medians = medians.select(F.col(group).alias("__g"), F.col("__m")[0].alias("target_median"))
    joined = stats.join(medians, F.col(group).eqNullSafe(F.col("__g")), "left")
    columns = [F.col(group).alias("feature_value"), "count", "target_mean", "target_median"]
    if order is None:
        return joined.select(*columns).orderBy(F.desc("count"), F.asc("feature_value"))
    return joined.orderBy(order).select(*columns)


def analyze_target_by_feature(
    df: DataFrame, target: str, feature: str, feature_type: str = "auto", num_bins: int = 10,
    max_categories: int | None = DEFAULT_CATEGORIES, handle_nulls: str = "drop",
    max_distinct: int | None = MAX_NUMERIC_DISTINCT, max_distinct_share: float | None = MAX_DISTINCT_SHARE,
) -> DataFrame | None:
    """Count, mean and median of the target per category or per quantile bin of a feature.

    Categories beyond ``max_categories`` are left out of the report, smallest
    first. A numeric feature with more than ``max_distinct`` distinct values, or a
    larger share of them than ``max_distinct_share``, gives None; where both are
    None it is always binned.
    """
    require_columns(df, [target, feature])
    if not is_numeric(df, target):
        raise TypeError(f"target column '{target}' must be numeric")
    if handle_nulls not in ("drop", "fill"):
        raise ValueError("handle_nulls must be 'drop' or 'fill'")
    if feature_type not in ("auto", "categorical", "numerical"):
        raise ValueError("feature_type must be 'auto', 'categorical' or 'numerical'")
    rows = df.select(feature, target)
    if handle_nulls == "drop":
        rows = rows.filter(F.col(feature).isNotNull())
    else:
        rows = rows.withColumn(feature, F.coalesce(key_text(rows, feature), F.lit("_NULL_")))
    if rows.isEmpty():
        return None
    kind = detect_feature_type(rows, feature, max_categories) if feature_type == "auto" else feature_type
    if kind == "categorical":
        if max_categories is not None:
            largest = rows.groupBy(feature).agg(F.count(F.lit(1)).alias("n")).orderBy(
                F.desc("n"), F.asc(feature)).limit(max_categories)
            # max_categories rows
            rows = rows.join(F.broadcast(largest.select(feature)), feature, "left_semi")
        return _summarise(rows, feature, target, None)
    if not is_numeric(rows, feature):
        raise TypeError(f"column '{feature}' is not numeric")

    distinct = rows.select(feature).distinct()
    if max_distinct_share is not None:
        n_distinct, n_rows = distinct.count(), rows.count()
    else:
        n_distinct, n_rows = distinct.limit(2 if max_distinct is None else max_distinct + 1).count(), None
    if max_distinct is not None and n_distinct > max_distinct:
        return None
    if max_distinct_share is not None and n_distinct / n_rows > max_distinct_share:
        return None
    edges = column_quantiles(rows, [feature], [i / num_bins for i in range(num_bins + 1)])[feature]
    if n_distinct <= 1 or len(set(edges)) < len(edges):
        return _summarise(rows.withColumn(feature, key_text(rows, feature)), feature, target, None)
    # bins are closed on the right: (e_i, e_i+1]
    place = F.lit(0)
    for edge in edges[1:-1]:
        place = place + F.when(F.col(feature) > F.lit(edge), 1).otherwise(0)
    labels = F.lit([f"q{i + 1} ({edges[i]:.3g}-{edges[i + 1]:.3g})" for i in range(num_bins)])
    binned = rows.withColumn("__bin", place)
    table = _summarise(binned, "__bin", target, "__bin")
    return table.select(F.element_at(labels, F.col("feature_value") + 1).alias("feature_value"),
                        "count", "target_mean", "target_median")


def target_histogram(df: DataFrame, target: str, bins: int = 30) -> DataFrame:
    """Equal-width histogram on a density scale; nulls are dropped, empty bins are kept."""
    require_columns(df, [target])
    if not is_numeric(df, target):
        raise TypeError(f"target column '{target}' must be numeric")
    y = F.col(target).cast("double")
    low, high, n = df.agg(F.min(y), F.max(y), F.count(y)).first()
    if not n:
        return df.sparkSession.createDataFrame([], "bin int, low double, high double, rows bigint, density double")
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    place = F.least(F.floor((y - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = df.filter(y.isNotNull()).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("rows"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    rows = F.coalesce(F.col("rows"), F.lit(0))
    # one row per bin
    return every.join(F.broadcast(counts), "bin", "left").select(
        "bin", (F.lit(low) + F.col("bin") * F.lit(width)).alias("low"),
        (F.lit(low) + (F.col("bin") + 1) * F.lit(width)).alias("high"),
        rows.alias("rows"), (rows / F.lit(float(n) * width)).alias("density"))


def profile_tables(
    df: DataFrame, target: str, features: Sequence[str] | None = None, max_categories: int = DEFAULT_CATEGORIES,
    num_bins: int = 10, top_k: int = 50, max_distinct: int | None = MAX_NUMERIC_DISTINCT,
    max_distinct_share: float | None = MAX_DISTINCT_SHARE,
) -> dict[str, DataFrame]:
    """All profile tables by name; a section that fails is named in ``failed_sections`` and logged."""
    require_columns(df, [target])
    tables: dict[str, DataFrame] = {}
    failed: list[tuple[str, str]] = []

    def section(name, build):
        try:
            table = build()
            if table is not None:
                tables[name] = table
        except Exception as error:  # one bad column must not stop the report
            log.warning("section %s left out: %s", name, error)
            failed.append((name, str(error)[:500]))

    section("summary", lambda: calculate_feature_summary(df))
    section("target_distribution", lambda: target_histogram(df, target))
    found = Correlations([], None, "")
    try:
        found = calculate_correlations(df, target)
    except Exception as error:
        log.warning("correlations left out: %s", error)
        failed.append(("correlations", str(error)[:500]))
    section("feature_correlations", lambda: found.matrix)
    section("target_correlations", lambda: found.target)
    if "target_correlations" in tables:
        section("top_target_correlations", lambda: top_correlations(found.target, f"{target}_correlation", top_k))
    if is_numeric(df, target):
        wanted = [c for c in (features or df.columns) if c in df.columns and c != target]
        for c in wanted:
            section(f"by_{c}", lambda c=c: analyze_target_by_feature(
                df, target, c, num_bins=num_bins, max_categories=max_categories, max_distinct=max_distinct,
                max_distinct_share=max_distinct_share))
    if failed:
        tables["failed_sections"] = df.sparkSession.createDataFrame(failed, "section string, reason string")
    return tables


def save_profile(tables: dict[str, DataFrame], path: str) -> list[str]:
    written = []
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")
        written.append(f"{path.rstrip('/')}/{name}")
    return written


def importance_summary(importances: DataFrame, k: int = 30) -> DataFrame:
    """Mean and spread of each feature's importance over folds, largest first."""
    require_columns(importances, ["feature", "importance"])
    return (importances.groupBy("feature")
            .agg(F.avg("importance").alias("mean"), F.stddev_samp("importance").alias("std"))
            .orderBy(F.desc("mean"), F.asc("feature")).limit(k))


def fold_score_summary(scores: DataFrame, lower_is_better: bool = True) -> DataFrame:
    """Mean and population spread of fold scores per model, with the best model marked."""
    require_columns(scores, ["model", "fold", "score"])
    table = scores.groupBy("model").agg(F.avg("score").alias("mean"), F.stddev_pop("score").alias("std"))
    choose = F.min_by if lower_is_better else F.max_by
    # one row per model, one row in total
    best = table.agg(choose("model", "mean").alias("__best"))
    return table.join(F.broadcast(best), F.col("model") == F.col("__best"), "left").select(
        "model", "mean", "std", F.col("__best").isNotNull().alias("is_best"))


def transform_impact(df: DataFrame, y: str, before: str, after: str, metric: str = "rmsle") -> DataFrame:
    """What a change of predictions did: rows changed, range before and after, scores."""
    require_columns(df, [y, before, after])
    yc, b, a = (F.col(c).cast("double") for c in (y, before, after))
    changed = F.count_if(~b.eqNullSafe(a))
    table = df.agg(
        F.count(F.lit(1)).alias("rows"), changed.alias("changed"),
        (changed * F.lit(100.0) / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("changed_pct"),
        F.min(b).alias("min_before"), F.max(b).alias("max_before"),
        F.min(a).alias("min_after"), F.max(a).alias("max_after"),
        regression_metric(metric, yc, b).alias("score_before"),
        regression_metric(metric, yc, a).alias("score_after"))
    return table.withColumn("score_delta", F.col("score_before") - F.col("score_after"))



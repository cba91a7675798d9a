"""Scores of predictions, as few passes as possible.

``evaluate`` returns one row with one column per metric. All regression metrics
share one aggregate, all metrics built on class counts share one confusion
table, and the exact area under the curve uses running totals per score.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.frame import require_columns
from foldwise.operators.order_stats import running_totals

# fixed value: distance between 1.0 and the next double
EPSILON = 2.220446049250313e-16

REGRESSION = ("mse", "rmse", "mae", "mape", "r2", "msle", "rmsle")
CLASSES = ("accuracy", "precision", "recall", "f1", "balanced_accuracy")
CURVE = ("roc_auc", "auc")
PROBABILITY = ("logloss",)
METRICS = REGRESSION + CLASSES + CURVE + PROBABILITY
LOWER_IS_BETTER = ("mse", "rmse", "mae", "mape", "msle", "rmsle", "logloss")
AVERAGES = ("binary", "micro", "macro", "weighted")


def regression_metric(name: str, y: Column, p: Column) -> Column:
    error = y - p
    if name == "mse":
        return F.avg(error * error)
    if name == "rmse":
        return F.sqrt(F.avg(error * error))
    if name == "mae":
        return F.avg(F.abs(error))
    if name == "mape":
        return F.avg(F.abs(error) / F.greatest(F.abs(y), F.lit(EPSILON)))
    if name == "r2":
        residual = F.sum(error * error)
        spread = F.var_pop(y) * F.count(y)
        return (F.when(spread > 0, F.lit(1.0) - residual / F.nullif(spread, F.lit(0.0)))
                .when(residual == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    logs = F.log1p(y) - F.log1p(p)
    score = F.avg(logs * logs)
    score = F.sqrt(score) if name == "rmsle" else score
    return F.when(F.min(F.least(y, p)) < 0, F.raise_error(F.lit(f"{name} needs values of at least 0"))
                  .cast("double")).otherwise(score)


def class_counts(df: DataFrame, y: str, p: str) -> DataFrame:
    """One row per class: true positives, true rows, predicted rows."""
    pairs = df.groupBy(F.col(y).cast("string").alias("y"), F.col(p).cast("string").alias("p")).agg(
        F.count(F.lit(1)).alias("n"))
    roles = pairs.select("n", F.explode(F.array(
        F.struct(F.col("y").alias("class"), F.lit(True).alias("is_true"), (F.col("y") == F.col("p")).alias("hit")),
        F.struct(F.col("p").alias("class"), F.lit(False).alias("is_true"), F.lit(False).alias("hit")),
    )).alias("r")).select("n", "r.*")
    return roles.groupBy("class").agg(
        F.sum(F.when(F.col("hit"), F.col("n")).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("is_true"), F.col("n")).otherwise(0)).alias("true_rows"),
        F.sum(F.when(~F.col("is_true"), F.col("n")).otherwise(0)).alias("predicted_rows"))


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / F.nullif(whole, F.lit(0).cast("double")))


def _class_scores() -> dict[str, Column]:
    tp, true, predicted = (F.col(c).cast("double") for c in ("tp", "true_rows", "predicted_rows"))
    return {"precision": _share(tp, predicted), "recall": _share(tp, true), "f1": _share(2 * tp, true + predicted)}


def class_metrics(df: DataFrame, y: str, p: str, names: Sequence[str], average: str, pos_label) -> DataFrame:
    if average not in AVERAGES:
        raise ValueError(f"unknown average '{average}', expected one of {AVERAGES}")
    counts, scores = class_counts(df, y, p), _class_scores()
    tp, true, predicted = (F.sum(c).cast("double") for c in ("tp", "true_rows", "predicted_rows"))
    micro = {"precision": _share(tp, predicted), "recall": _share(tp, true), "f1": _share(2 * tp, true + predicted)}
    out = []
    for name in names:
        if name == "accuracy":
            value = _share(tp, true)
        elif name == "balanced_accuracy":
            value = F.avg(F.when(F.col("true_rows") > 0, scores["recall"]))
        elif average == "binary":
            value = F.coalesce(F.max(F.when(F.col("class") == str(pos_label), scores[name])), F.lit(0.0))
        elif average == "micro":
            value = micro[name]
        elif average == "macro":
            value = F.avg(scores[name])
        else:
            value = F.sum(scores[name] * F.col("true_rows")) / F.sum("true_rows")
        out.append(value.alias(name))
    return counts.agg(*out)


def _two_labels(label: Column) -> Column:
    """True where an aggregate sees at most two labels: then each is the smallest or the greatest one."""
    low, high, n = F.min(label), F.max(label), F.count(label)
    # the sum of (label - low) * (high - label), whose terms are not negative
    between = (low + high) * F.sum(label) - F.sum(label * label) - n * low * high
    return (n == 0) | (F.abs(between) <= 1e-9 * n * F.greatest(F.lit(1.0), low * low, high * high))


def auc_table(df: DataFrame, y: str, p: str, out: str = "auc", pos_label=1) -> DataFrame:
    """Exact area under the ROC curve of two labels; tied scores count half.

    Rows are counted per distinct score first. The number of negatives below a
    score is a running total over score ranges. Rows of more than two labels raise an error.
    """
    label = F.col(y).cast("double")
    positive = label == float(pos_label)
    scores = df.groupBy(F.col(p).cast("double").alias("score")).agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg"))
    ranked = running_totals(scores, "score", ["neg"])
    pos, neg = F.sum("pos").cast("double"), F.sum("neg").cast("double")
    wins = F.sum(F.col("pos").cast("double") * (F.col("neg_before").cast("double") + F.col("neg") / 2))
    two = df.agg(_two_labels(label).alias("__two")).withColumn("__one", F.lit(1))
    value = F.when(F.col("__two"), F.col(out)).otherwise(
        F.raise_error(F.lit("roc_auc of more than two labels needs an array of chances")).cast("double"))
    area = ranked.agg((wins / F.nullif(pos * neg, F.lit(0.0))).alias(out)).withColumn("__one", F.lit(1))
    return area.join(two, "__one").select(value.alias(out))  # one row on either side


def class_auc_table(
    df: DataFrame, y: str, p: str, multi_class: str = "ovr", average: str = "macro", out: str = "auc",
) -> DataFrame:
    """Exact area under the ROC curve for an array of chances, one per class 0, 1, 2, ...

    ``multi_class`` is 'ovr' (each class against the others) or 'ovo' (each pair of classes, both ways);
    ``average`` is 'macro' or 'weighted' (by the rows of a class, or of a pair). Classes
    without rows are an error. For every class the rows are counted per score and label once; running totals give how
    often a class beats each other one.
    """
    if multi_class not in ("ovr", "ovo"):
        raise ValueError("multi_class must be 'ovr' or 'ovo'")
    if average not in ("macro", "weighted"):
        raise ValueError("average must be 'macro' or 'weighted'")
    k = df.agg(F.max(F.size(p))).first()[0] or 0
    if k < 2:
        raise ValueError("roc_auc of an array needs the chances of at least two classes")
    every = range(k)
    long = df.select(F.col(y).cast("int").alias("label"), F.posexplode(F.col(p).cast("array<double>")).alias("class", "score"))
    counted = long.groupBy("class", "score").agg(*[F.count_if(F.col("label") == j).alias(f"n{j}") for j in every])
    ranked = running_totals(counted, "score", [f"n{j}" for j in every], ["class"])
    own = F.element_at(F.array(*[F.col(f"n{j}") for j in every]), F.col("class") + 1).cast("double")
    # beats[j]: pairs of a row of the class and one of j in which the first has the higher score
    table = ranked.groupBy("class").agg(F.sum(own).alias("rows"), F.array(*[
        F.sum(own * (F.col(f"n{j}_before").cast("double") + F.col(f"n{j}") / 2)) for j in every]).alias("beats"))
    # one row per class from here on
    all_classes = table.agg(F.array_sort(F.collect_list(F.struct("class", "rows", "beats"))).alias("c"))
    index = F.sequence(F.lit(0), F.lit(k - 1))

    def rows(i: Column) -> Column:
        return F.get(F.col("c"), i).getField("rows")

    def area(i: Column, j: Column) -> Column:
        return F.get(F.get(F.col("c"), i).getField("beats"), j) / (rows(i) * rows(j))

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda a, b: a + b)

    if multi_class == "ovr":
        def one(i: Column) -> Column:
            rest = F.filter(index, lambda j: j != i)
            wins = total(F.transform(rest, lambda j: F.get(F.get(F.col("c"), i).getField("beats"), j)))
            return F.struct((wins / (rows(i) * total(F.transform(rest, rows)))).alias("area"), rows(i).alias("weight"))
        parts = F.transform(index, one)
    else:
        parts = F.flatten(F.transform(index, lambda i: F.transform(F.filter(index, lambda j: j > i), lambda j: F.struct(
            ((area(i, j) + area(j, i)) / 2).alias("area"), (rows(i) + rows(j)).alias("weight")))))
    weight = (lambda x: x.weight) if average == "weighted" else (lambda x: F.lit(1.0))
    score = total(F.transform(parts, lambda x: x.area * weight(x))) / total(F.transform(parts, weight))
    whole = F.exists(index, lambda i: F.coalesce(rows(i), F.lit(0.0)) == 0)
    return all_classes.select(F.when(whole, F.raise_error(F.lit("roc_auc needs rows of every class")).cast("double")).otherwise(score).alias(out))


def logloss_value(df: DataFrame, y: str, p: str) -> Column:
    label, low, high = F.col(y).cast("int"), F.lit(EPSILON), F.lit(1.0 - EPSILON)
    if isinstance(df.schema[p].dataType, T.ArrayType):
        whole = F.aggregate(p, F.lit(0.0), lambda a, b: a + b)
        chance = F.element_at(p, label + 1) / whole
        return -F.avg(F.ln(F.least(F.greatest(chance, low), high)))
    chance = F.least(F.greatest(F.col(p).cast("double"), low), high)
    return -F.avg(F.when(label == 1, F.ln(chance)).otherwise(F.ln(F.lit(1.0) - chance)))


def evaluate(
    df: DataFrame, y: str, p: str, metrics: Sequence[str], average: str = "binary", pos_label=1,
    skip_missing: bool = False, multi_class: str = "ovr",
) -> DataFrame:
    """One row with the requested metrics; names are case-insensitive.

    ``skip_missing`` scores only rows that have a prediction. ``multi_class`` is the form of roc_auc where the
    prediction is an array; ``average`` then is 'macro' unless it is 'weighted'.
    """
    require_columns(df, [y, p])
    names = [m.lower() for m in metrics]
    unknown = [m for m in names if m not in METRICS]
    if unknown:
        raise ValueError(f"unknown metrics {unknown}, expected some of {METRICS}")
    if not names:
        raise ValueError("no metric given")
    rows = df.select(y, p)
    if skip_missing:
        rows = rows.filter(F.col(p).isNotNull())
        if isinstance(df.schema[p].dataType, (T.FloatType, T.DoubleType)):
            rows = rows.filter(~F.isnan(p))
    tables = []
    plain = [m for m in names if m in REGRESSION or m in PROBABILITY]
    if plain:
        yc, pc = F.col(y).cast("double"), None
        aggregates = []
        for m in plain:
            if m in PROBABILITY:
                aggregates.append(logloss_value(rows, y, p).alias(m))
            else:
                pc = F.col(p).cast("double")
                aggregates.append(regression_metric(m, yc, pc).alias(m))
        tables.append(rows.agg(*aggregates))
    by_class = [m for m in names if m in CLASSES]
    if by_class:
        tables.append(class_metrics(rows, y, p, by_class, average, pos_label))
    curve = [m for m in names if m in CURVE]
    if curve:
        if isinstance(df.schema[p].dataType, T.ArrayType):
            area = class_auc_table(rows, y, p, multi_class, "weighted" if average == "weighted" else "macro", "__auc")
        else:
            area = auc_table(rows, y, p, "__auc", pos_label)
        tables.append(area.select(*[F.col("__auc").alias(m) for m in curve]))
    if len(tables) == 1:
        return tables[0].select(*names)
    # every table has exactly one row
    numbered = [t.withColumn("__one", F.lit(1)) for t in tables]
    return reduce(lambda a, b: a.join(b, "__one"), numbered).select(*names)


def calculate_metric(df: DataFrame, y: str, p: str, metric: str, **options) -> float:
    value = evaluate(df, y, p, [metric], **options).first()[0]
    if value is None:
        raise ValueError(f"metric '{metric}' is undefined for these rows")
    return float(value)


def higher_is_better(metric: str) -> bool:
    return metric.lower() not in LOWER_IS_BETTER

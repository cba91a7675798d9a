"""Greedy feature selection and leave-one-out importance.

Every candidate needs a cross-validated score. For ridge and lasso with a squared-error
metric the coefficients of all candidates follow from sums of products per fold,
which one pass collects for all features; one more pass per round computes the
real residuals of all candidates of that round. Logistic regression of two classes scored by log loss takes
a pass per Newton step for all candidates and folds of a round. Other learners are trained per candidate.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.errors import IllegalArgumentException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.frame import is_numeric, materialise, require_columns
from foldwise.operators.metrics import higher_is_better
from foldwise.plans.logistic import STEPS, logistic_rows
from foldwise.plans.training import train_and_cv

log = logging.getLogger(__name__)

CANDIDATES_AT_ONCE = 3
CLOSED_METRICS = ("mse", "rmse", "r2")
#: what a learner raises for data or settings it cannot be trained with
TRAINING_ERRORS = (ValueError, TypeError, ArithmeticError, IllegalArgumentException, np.linalg.LinAlgError)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(fold, values) of each batch; values are (1, features around their means, target around its mean)."""
    for batch in batches:
        if batch.num_rows:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            yield batch.column(0).to_numpy(), flat.reshape(batch.num_rows, -1)


def _lasso_weights(sums: np.ndarray, alpha: float, rounds: int = 10_000) -> np.ndarray:
    """Constant and coefficients of least mean squares / 2 with an absolute penalty, by coordinate descent on sums of
    products of (1, features, target)."""
    n, means = sums[0, 0], sums[0, 1:] / sums[0, 0]
    centred = sums[1:, 1:] / n - np.outer(means, means)
    g, c = centred[:-1, :-1], centred[:-1, -1]
    w = np.zeros(len(c))
    for _ in range(rounds):
        moved = 0.0
        for j in range(len(w)):
            if g[j, j] <= 0:
                continue
            pull = c[j] - g[j] @ w + g[j, j] * w[j]
            new = np.sign(pull) * max(abs(pull) - alpha, 0.0) / g[j, j]
            moved, w[j] = max(moved, abs(new - w[j]) * np.sqrt(g[j, j])), new
        if moved <= 1e-10 * np.sqrt(max(centred[-1, -1], 1e-300)):
            break
    return np.concatenate([[means[-1] - means[:-1] @ w], w])


@dataclass(frozen=True)
class FoldProducts:
    """Rows around the column means and, per fold, the sums of products of (1, features, target)."""

    features: list[str]
    rows: DataFrame                    # fold, values
    matrices: dict[int, np.ndarray]

    def weights(self, chosen: Sequence[str], alpha: float, lasso: bool = False) -> dict[int, np.ndarray]:
        """Per fold the residual's weight of each value, fitted without that fold."""
        pick = [0, *[1 + self.features.index(f) for f in chosen]]
        size = len(self.features) + 2
        whole, out = sum(self.matrices.values()), {}
        for fold, own in self.matrices.items():
            rest = whole - own
            if lasso:
                vector = np.zeros(size)
                vector[pick], vector[-1] = -_lasso_weights(rest[np.ix_([*pick, size - 1], [*pick, size - 1])], alpha), 1.0
                out[fold] = vector
                continue
            a = rest[np.ix_(pick, pick)].copy()
            a[np.arange(1, len(pick)), np.arange(1, len(pick))] += alpha
            vector = np.zeros(size)
            vector[pick], vector[-1] = -np.linalg.solve(a, rest[pick, size - 1]), 1.0
            out[fold] = vector
        return out

    def scores(
        self, sets: Mapping[str, Sequence[str]], alpha: float, metric: str, lasso: bool = False,
    ) -> dict[str, float | Exception]:
        """Pooled score of each feature set, from the residuals of one pass over the rows."""
        out: dict[str, float | Exception] = {}
        fitted: dict[str, dict[int, np.ndarray]] = {}
        for name, chosen in sets.items():
            try:
                fitted[name] = self.weights(chosen, alpha, lasso)
            except np.linalg.LinAlgError as error:
                out[name] = error
        if not fitted:
            return out
        stacked = {fold: np.stack([w[fold] for w in fitted.values()], axis=1) for fold in self.matrices}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(fitted))
            for folds, values in _blocks(batches):
                for fold in np.unique(folds):
                    total += np.square(values[folds == fold] @ stacked[int(fold)]).sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["place", "error"])

        found = self.rows.mapInArrow(run, "place int, error double").groupBy("place").agg(F.sum("error").alias("e")).collect()
        errors = {r["place"]: r["e"] for r in found}
        whole = sum(self.matrices.values())
        n, spread = whole[0, 0], whole[-1, -1] - whole[0, -1] ** 2 / whole[0, 0]
        for place, name in enumerate(fitted):
            error = errors[place]
            if metric == "r2":
                out[name] = 1.0 - error / spread if spread else float("nan")
            else:
                out[name] = error / n if metric == "mse" else math.sqrt(error / n)
        return out


def fold_products(df: DataFrame, target: str, features: Sequence[str], fold: str) -> FoldProducts:
    """One pass for the means and one for the sums; any number of features. Nulls are an error."""
    names = [*features, target]
    rows = df.filter(F.col(fold).isNotNull())
    row = rows.agg(*[x for i, c in enumerate(names) for x in (
        F.avg(F.col(c).cast("double")).alias(f"m{i}"), F.count_if(F.col(c).isNull()).alias(f"n{i}"))]).first()
    holes = [c for i, c in enumerate(names) if row[f"n{i}"]]
    if holes:
        raise ValueError(f"columns with missing values cannot be scored: {holes}")
    values = F.array(F.lit(1.0), *[F.col(c).cast("double") - F.lit(row[f"m{i}"] or 0.0) for i, c in enumerate(names)])
    table = materialise(rows.select(F.col(fold).cast("int").alias("fold"), values.alias("values")))
    size = len(names) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for folds, block in _blocks(batches):
            for k in np.unique(folds):
                own = block[folds == k]
                sums[int(k)] = sums.get(int(k), 0.0) + own.T @ own
        for k, matrix in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(size * size, k, np.int32)), pa.array(np.arange(size * size, dtype=np.int32)),
                 pa.array(matrix.ravel())], ["fold", "place", "value"])

    found = table.mapInArrow(run, "fold int, place int, value double").groupBy("fold", "place").agg(F.sum("value").alias("v")).collect()
    matrices: dict[int, np.ndarray] = {}
    for r in found:
        matrices.setdefault(r["fold"], np.zeros((size, size))).flat[r["place"]] = r["v"]
    return FoldProducts(list(features), table, dict(sorted(matrices.items())))


def evaluate_features_cv(
    df: DataFrame, target: str, features: Sequence[str], model_type: str, row_id: str, metric: str,
    fold: str = "fold", model_params: Mapping | None = None, metric_params: Mapping | None = None, **options,
) -> float:
    """Score of the pooled out-of-fold predictions of a feature set."""
    if not features:
        raise ValueError("feature list must not be empty")
    result = train_and_cv(df, target, features, model_type, row_id, fold, model_params=model_params, **options)
    return result.pooled_score(metric, **(metric_params or {}))


def _scorer(
    df, target, features, model_type, row_id, metric, fold, model_params, options,
) -> Callable[[Mapping[str, Sequence[str]]], dict[str, float | Exception]]:
    """A function from named feature sets to their scores; a set that cannot be trained gives its error."""
    require_columns(df, [row_id, fold, target, *features])
    params, metric = dict(model_params or {}), metric.lower()
    kind, plain = model_type.lower(), not options and all(is_numeric(df, f) for f in features)
    if (kind in ("ridge", "lasso") and metric in CLOSED_METRICS and plain
            and params.get("fit_intercept", True) and not set(params) - {"alpha", "fit_intercept", "max_iter"}):
        products = fold_products(df, target, features, fold)
        alpha = float(params.get("alpha", 1.0))
        return lambda sets: products.scores(sets, alpha, metric, kind == "lasso")
    if kind in ("logreg", "logisticregression") and metric == "logloss" and plain and not set(params) - {"C", "max_iter"}:
        rows = logistic_rows(df, target, features, fold)
        if rows is not None:
            return lambda sets: rows.scores(sets, float(params.get("C", 1.0)), int(params.get("max_iter", STEPS)))

    def one(chosen: Sequence[str]) -> float | Exception:
        try:
            return evaluate_features_cv(df, target, list(chosen), model_type, row_id, metric, fold, model_params=params, **options)
        except TRAINING_ERRORS as error:
            return error

    def many(sets: Mapping[str, Sequence[str]]) -> dict[str, float | Exception]:
        # side by side: small jobs of one leave cores idle for another
        run = inheritable_thread_target(df.sparkSession)(one)
        with ThreadPool(min(CANDIDATES_AT_ONCE, len(sets))) as pool:
            return dict(zip(sets, pool.map(run, sets.values())))

    return many


def _score_all(score: Callable, sets: Mapping[str, Sequence[str]], worst: float) -> dict[str, float]:
    """Scores of all sets; one that cannot be trained gets the worst. If none can be, that is an error."""
    found = score(sets)
    failed = {name: error for name, error in found.items() if isinstance(error, Exception)}
    if len(failed) == len(sets):
        raise RuntimeError("no feature set could be scored") from next(iter(failed.values()))
    for name, error in failed.items():
        log.warning("features %s could not be scored: %s", sets[name], error)
    return {name: worst if name in failed else found[name] for name in sets}


def select_features_forward(
    df: DataFrame, target: str, candidates: Sequence[str], model_type: str, row_id: str, metric: str,
    fold: str = "fold", initial: Sequence[str] = (), min_improvement: float = 1e-5,
    model_params: Mapping | None = None, **options,
) -> list[str]:
    """Add the best candidate of each round while the gain exceeds ``min_improvement``."""
    chosen, left = list(initial), [c for c in candidates if c not in initial]
    if not left:
        return chosen
    up = higher_is_better(metric)
    worst = -math.inf if up else math.inf
    score = _scorer(df, target, [*chosen, *left], model_type, row_id, metric, fold, model_params, options)
    best = _score_all(score, {"": chosen}, worst)[""] if chosen else worst
    while left:
        scores = _score_all(score, {c: [*chosen, c] for c in left}, worst)
        pick = (max if up else min)(scores, key=scores.get)
        gain = scores[pick] - best if up else best - scores[pick]
        if not gain > min_improvement:
            break
        chosen.append(pick)
        left.remove(pick)
        best = scores[pick]
    return chosen


def select_features_backward(
    df: DataFrame, target: str, features: Sequence[str], model_type: str, row_id: str, metric: str,
    fold: str = "fold", min_features: int = 1, score_threshold: float | None = None,
    model_params: Mapping | None = None, **options,
) -> list[str]:
    """Remove the feature whose removal scores best, until ``min_features`` or the threshold.

    Without a threshold features are removed even if the score gets worse.
    """
    if not features:
        raise ValueError("feature list must not be empty")
    if min_features < 1:
        raise ValueError("min_features must be at least 1")
    chosen = list(features)
    up = higher_is_better(metric)
    worst = -math.inf if up else math.inf
    score = _scorer(df, target, chosen, model_type, row_id, metric, fold, model_params, options)
    while len(chosen) > min_features:
        scores = _score_all(score, {c: [f for f in chosen if f != c] for c in chosen}, worst)
        pick = (max if up else min)(scores, key=scores.get)
        if score_threshold is not None and (
                scores[pick] < score_threshold if up else scores[pick] > score_threshold):
            break
        chosen.remove(pick)
    return chosen


def calculate_loo_feature_importance(
    df: DataFrame, target: str, features: Sequence[str], model_type: str, row_id: str, metric: str,
    fold: str = "fold", model_params: Mapping | None = None, **options,
) -> dict[str, float]:
    """Loss of score without each feature, largest first; empty if the baseline cannot be trained.

    A feature without which the rest cannot be trained, and a single one, get 0.
    """
    if not features:
        return {}
    up = higher_is_better(metric)
    sets = {f: [c for c in features if c != f] for f in features}
    try:
        score = _scorer(df, target, features, model_type, row_id, metric, fold, model_params, options)
        found = score({"": list(features), **{f: rest for f, rest in sets.items() if rest}})
    except TRAINING_ERRORS as error:
        log.warning("baseline could not be scored: %s", error)
        return {}
    baseline = found[""]
    if isinstance(baseline, Exception):
        log.warning("baseline could not be scored: %s", baseline)
        return {}
    out = {}
    for f in features:
        without = found.get(f, math.nan)
        if isinstance(without, Exception):
            log.warning("features %s could not be scored: %s", sets[f], without)
            without = math.nan
        change = baseline - without if up else without - baseline
        out[f] = 0.0 if math.isnan(change) else change
    return dict(sorted(out.items(), key=lambda item: item[1], reverse=True))

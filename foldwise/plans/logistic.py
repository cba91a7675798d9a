"""Cross-validated logistic regression of many feature sets at once.

Every set and fold is fitted by Newton's method. A step needs the loss, the gradient and the matrix of second derivatives, which are
sums over rows, so one pass over the rows serves all sets and folds; the number of passes
does not depend on how many sets are compared.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.frame import materialise
from foldwise.operators.metrics import EPSILON

STEPS = 50
TOLERANCE = 1e-9


@dataclass(frozen=True)
class LogisticRows:
    """Rows of (fold, label, 1 and the scaled features), their spreads, and the folds."""

    features: list[str]
    rows: DataFrame
    spread: np.ndarray
    folds: list[int]

    def scores(self, sets: Mapping[str, Sequence[str]], inverse_penalty: float, max_iter: int = STEPS) -> dict[str, float]:
        """Pooled log loss of each set; every row is scored by the fit without its fold."""
        picks = {name: np.array([0, *[1 + self.features.index(f) for f in chosen]]) for name, chosen in sets.items()}
        # the penalty holds for coefficients of unscaled features, and not for the constant
        penalty = {name: np.array([0.0, *(1 / (inverse_penalty * self.spread[p[1:] - 1] ** 2))]) for name, p in picks.items()}
        weights = {(name, k): np.zeros(len(p)) for name, p in picks.items() for k in range(len(self.folds))}
        step = {key: np.zeros_like(w) for key, w in weights.items()}
        before = dict.fromkeys(weights, np.inf)
        open_fits = set(weights)
        for _ in range(max_iter):
            found = self._sums({key: weights[key] for key in open_fits}, picks)
            for key in list(open_fits):
                w, own = weights[key], penalty[key[0]]
                loss, g, h = found[key]
                loss += 0.5 * float(own @ (w * w))
                if loss > before[key] * (1 + 1e-12) + 1e-12 and np.abs(step[key]).max() > TOLERANCE:
                    step[key] = step[key] / 2  # too far: half the way back
                    weights[key] = w - step[key]
                    continue
                before[key] = loss
                step[key] = -np.linalg.lstsq(h + np.diag(own), g + own * w, rcond=None)[0]
                weights[key] = w + step[key]
                if np.abs(step[key]).max() <= TOLERANCE * (1 + np.abs(w).max()):
                    open_fits.discard(key)
            if not open_fits:
                break
        lost, n = self._held_out(weights, picks)
        return {name: lost[name] / n for name in sets}

    def _sums(self, weights: Mapping[tuple[str, int], np.ndarray], picks: Mapping[str, np.ndarray]) -> dict:
        """Loss, gradient and second derivatives of each fit over the rows outside its fold."""
        keys, folds = sorted(weights), self.folds
        sizes = [1 + len(picks[name]) + len(picks[name]) ** 2 for name, _ in keys]
        starts = np.concatenate([[0], np.cumsum(sizes)])

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(int(starts[-1]))
            for fold, y, x in _blocks(batches):
                for i, (name, k) in enumerate(keys):
                    rows = fold != folds[k]
                    own, label = x[rows][:, picks[name]], y[rows]
                    z = own @ weights[name, k]
                    p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
                    loss = np.logaddexp(0, z).sum() - label @ z
                    curve = own.T @ (own * (p * (1 - p))[:, None])
                    total[starts[i]: starts[i + 1]] += np.concatenate([[loss], own.T @ (p - label), curve.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int64)), pa.array(total)], ["place", "value"])

        # a few numbers per set and fold
        got = self.rows.mapInArrow(run, "place bigint, value double").groupBy("place").agg(F.sum("value").alias("v")).collect()
        flat = np.zeros(int(starts[-1]))
        for r in got:
            flat[r["place"]] = r["v"]
        out = {}
        for i, key in enumerate(keys):
            own, n = flat[starts[i]: starts[i + 1]], len(picks[key[0]])
            out[key] = float(own[0]), own[1: 1 + n], own[1 + n:].reshape(n, n)
        return out

    def _held_out(self, weights: Mapping[tuple[str, int], np.ndarray], picks: Mapping[str, np.ndarray]) -> tuple[dict[str, float], int]:
        names, folds = list(picks), self.folds

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(names) + 1)
            for fold, y, x in _blocks(batches):
                total[-1] += len(y)
                for i, name in enumerate(names):
                    for k, number in enumerate(folds):
                        rows = fold == number
                        p = 1 / (1 + np.exp(-np.clip(x[rows][:, picks[name]] @ weights[name, k], -500, 500)))
                        p = np.clip(p, EPSILON, 1 - EPSILON)
                        total[i] -= np.where(y[rows] > 0.5, np.log(p), np.log(1 - p)).sum()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int64)), pa.array(total)], ["place", "value"])

        got = {r["place"]: r["v"] for r in self.rows.mapInArrow(run, "place bigint, value double").groupBy("place").agg(
            F.sum("value").alias("v")).collect()}
        return {name: got[i] for i, name in enumerate(names)}, int(got[len(names)])


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        if batch.num_rows:
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            yield batch.column(0).to_numpy(), batch.column(1).to_numpy(), x


def logistic_rows(df: DataFrame, target: str, features: Sequence[str], fold: str) -> LogisticRows | None:
    """The rows for all sets of these features, written once; None unless the labels are 0 and 1. Nulls are an error."""
    rows, y = df.filter(F.col(fold).isNotNull()), F.col(target).cast("double")
    facts = rows.agg(
        F.count_if(y.isNull() | ~y.isin(0.0, 1.0)).alias("other"), F.collect_set(F.col(fold).cast("int")).alias("folds"),
        *[x for i, c in enumerate(features) for x in (F.avg(F.col(c).cast("double")).alias(f"m{i}"), F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}"),
                                                       F.count_if(F.col(c).isNull()).alias(f"n{i}"))]).first()
    if facts["other"]:
        return None
    holes = [c for i, c in enumerate(features) if facts[f"n{i}"]]
    if holes:
        raise ValueError(f"columns with missing values cannot be scored: {holes}")
    spread = np.array([facts[f"s{i}"] or 1.0 for i in range(len(features))])
    scaled = [(F.col(c).cast("double") - F.lit(facts[f"m{i}"] or 0.0)) / F.lit(float(spread[i])) for i, c in enumerate(features)]
    table = materialise(rows.select(F.col(fold).cast("int").alias("fold"), y.alias("y"), F.array(F.lit(1.0), *scaled).alias("x")))
    return LogisticRows(list(features), table, spread, sorted(facts["folds"]))

"""Multilayer perceptrons trained by local steps and averaging, all folds in the same passes.

Rows are dealt into shards by a hash of their key, about ``SHARD_ROWS`` each, and a shard is packed into
one row of a table that is written once. In an epoch every shard takes mini-batch steps of its own from the common
weights, and the weights and moments of the shards are averaged by their numbers of rows. Averages are sums of whole
numbers, and shards, batches and dropped units depend on the key and the seed only, so any partitioning
gives the same weights. The same pass measures the loss of each model's validation rows before
its steps, and a model stops when patience ends, with its best weights.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.frame import discard, materialise, require_columns

SHARD_ROWS = 4096
TRAIN, VALID = 1, 2
#: averages are sums of whole numbers of this fraction
UNIT = 2.0 ** 32

MSE, BCE, CE = "mse", "bce", "ce"
# fixed values: accepted names of the losses, and settings that say where or how to report, not what to compute
LOSSES = {"mse": MSE, "rmse": MSE, "regression": MSE, "bce": BCE, "binary_crossentropy": BCE, "binary": BCE, "ce": CE, "crossentropy": CE,
          "multiclass": CE}
WITHOUT_EFFECT = ("device", "verbose", "metric", "eval_metric", "output_size", "input_size")
ALIASES = {"lr": "learning_rate", "hidden_layers": "hidden_sizes", "max_iter": "epochs", "random_state": "seed", "dropout": "dropout_rate"}


@dataclass(frozen=True)
class NetSettings:
    hidden_sizes: tuple[int, ...] = (64, 32)
    epochs: int = 100
    batch_size: int = 64
    learning_rate: float = 1e-3
    optimizer: str = "adam"
    dropout_rate: float = 0.2
    seed: int = 0
    loss: str = MSE
    standardize: bool = True


def net_settings(params: Mapping, fit_params: Mapping = {}) -> NetSettings:
    """The settings of model and fit parameters; one without a counterpart is an error."""
    given = {ALIASES.get(k, k): v for k, v in {**params, **fit_params}.items() if k not in WITHOUT_EFFECT and k != "early_stopping_rounds"}
    loss = given.pop("loss_fn", given.pop("objective", "mse"))
    if str(loss).lower() not in LOSSES:
        raise ValueError(f"loss without a counterpart: '{loss}'")
    unknown = sorted(set(given) - set(NetSettings.__dataclass_fields__))
    if unknown:
        raise ValueError(f"network parameters without a counterpart: {unknown}")
    if "hidden_sizes" in given:
        given["hidden_sizes"] = tuple(int(n) for n in given["hidden_sizes"])
    settings = NetSettings(**given, loss=LOSSES[str(loss).lower()])
    if settings.optimizer not in ("adam", "sgd"):
        raise ValueError("optimizer must be 'adam' or 'sgd'")
    return settings


class Net:
    """Layers in one vector of weights."""

    def __init__(self, sizes: Sequence[int]):
        self.shapes = [(a, b) for a, b in zip(sizes, sizes[1:])]
        self.size = sum(a * b + b for a, b in self.shapes)

    def start(self, seed: int) -> np.ndarray:
        rng = np.random.default_rng(seed)
        return np.concatenate([x for a, b in self.shapes for x in (rng.normal(0, math.sqrt(2 / a), a * b), np.zeros(b))])

    def layers(self, w: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        at = 0
        for a, b in self.shapes:
            yield w[at: at + a * b].reshape(a, b), w[at + a * b: at + a * b + b]
            at += a * b + b

    def forward(self, w: np.ndarray, x: np.ndarray, keep: Sequence[np.ndarray] | None = None) -> list[np.ndarray]:
        """Values of each layer, the last one without an activation."""
        out = [x]
        layers = list(self.layers(w))
        for i, (m, b) in enumerate(layers):
            x = x @ m + b
            if i + 1 < len(layers):
                x = np.maximum(x, 0)
                if keep is not None:
                    x = x * keep[i]
            out.append(x)
        return out

    def gradient(self, w: np.ndarray, x: np.ndarray, y: np.ndarray, loss: str, keep: Sequence[np.ndarray] | None) -> np.ndarray:
        values, layers = self.forward(w, x, keep), list(self.layers(w))
        back = _slope(loss, values[-1], y) / len(x)
        parts: list[np.ndarray] = []
        for i in range(len(layers) - 1, -1, -1):
            parts = [(values[i].T @ back).ravel(), back.sum(axis=0), *parts]
            if i:
                back = (back @ layers[i][0].T) * (values[i] > 0)
                if keep is not None:
                    back = back * keep[i - 1]
        return np.concatenate(parts)


def chances(loss: str, out: np.ndarray) -> np.ndarray:
    if loss == BCE:
        return 1 / (1 + np.exp(-np.clip(out, -500, 500)))
    if loss == CE:
        grown = np.exp(out - out.max(axis=1, keepdims=True))
        return grown / grown.sum(axis=1, keepdims=True)
    return out


def _slope(loss: str, out: np.ndarray, y: np.ndarray) -> np.ndarray:
    if loss == MSE:
        return 2 * (out - y[:, None])
    if loss == BCE:
        return chances(BCE, out) - y[:, None]
    return chances(CE, out) - (y[:, None] == np.arange(out.shape[1]))


def row_losses(loss: str, out: np.ndarray, y: np.ndarray) -> np.ndarray:
    if loss == MSE:
        return (out[:, 0] - y) ** 2
    p = chances(loss, out)
    hit = np.where(y > 0.5, p[:, 0], 1 - p[:, 0]) if loss == BCE else p[np.arange(len(y)), y.astype(int)]
    return -np.log(np.maximum(hit, 1e-15))


@dataclass(frozen=True)
class Perceptron:
    """Fitted weights and the scales of inputs and target."""

    features: list[str]
    sizes: list[int]
    weights: np.ndarray
    shift: np.ndarray
    scale: np.ndarray
    target_shift: float
    target_scale: float
    settings: NetSettings
    curve: tuple[float, ...] = ()
    best_epoch: int = 0

    @property
    def classification(self) -> bool:
        return self.settings.loss != MSE

    @property
    def classes(self) -> int:
        return max(2, self.sizes[-1]) if self.classification else 0

    def predict_values(self, x: np.ndarray) -> np.ndarray:
        out = chances(self.settings.loss, Net(self.sizes).forward(self.weights, (x - self.shift) / self.scale)[-1])
        if self.settings.loss == CE:
            return out
        return out[:, 0] if self.settings.loss == BCE else out[:, 0] * self.target_scale + self.target_shift

    def prediction(self, df: DataFrame) -> Column:
        several = self.settings.loss == CE

        @F.pandas_udf("array<double>" if several else "double")
        def predict(rows: pd.Series) -> pd.Series:
            if not len(rows):
                return pd.Series([], dtype=object if several else float)
            found = self.predict_values(np.stack(rows.to_numpy()).astype(float))
            return pd.Series(list(found) if several else found)

        return predict(_inputs(df, self.features))


def _inputs(df: DataFrame, features: Sequence[str]) -> Column:
    if len(features) == 1 and isinstance(df.schema[features[0]].dataType, T.ArrayType):
        return F.col(f"`{features[0]}`").cast("array<double>")
    return F.array(*[F.col(f"`{f}`").cast("double") for f in features])


PACKED = "shard int, n int, x binary, y binary, roles binary"


def _packed(rows: DataFrame, shards: int, width: int, shift: np.ndarray, scale: np.ndarray, ts: float, td: float) -> DataFrame:
    """One row per shard: its standardised inputs, targets and roles, in the order of the key's hash."""
    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["h", "y"], kind="stable")
        x = np.stack(part["x"].to_numpy()).astype(float)
        if x.shape[1] != width or not np.isfinite(x).all():
            raise ValueError("features must be numbers, and as many in every row")
        x = ((x - shift) / scale).astype(np.float32)
        y = ((part["y"].to_numpy(float) - ts) / td).astype(np.float64)
        roles = np.stack(part["roles"].to_numpy()).astype(np.uint8)
        return pd.DataFrame({"shard": [int(part["shard"].iloc[0])], "n": [len(part)], "x": [x.tobytes()], "y": [y.tobytes()], "roles": [roles.tobytes()]})

    dealt = rows.withColumn("shard", F.pmod("h", F.lit(shards)).cast("int"))
    return materialise(dealt.groupBy("shard").applyInPandas(pack, PACKED))


def _epoch(
    shards: DataFrame, states: Mapping[int, np.ndarray], net: Net, settings: NetSettings, width: int, epoch: int, steps: int, train: bool,
) -> list:
    """Sums over the shards: per model its loss and rows of validation and, by position, the averaged state."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {m: np.zeros(3 * net.size, np.int64) for m in states}
        facts = {m: np.zeros(3, np.int64) for m in states}  # loss, rows measured, rows trained
        for batch in batches:
            for shard, n, xb, yb, rb in zip(*(c.to_pylist() for c in batch.columns)):
                x = np.frombuffer(xb, np.float32).reshape(n, width).astype(float)
                y, roles = np.frombuffer(yb), np.frombuffer(rb, np.uint8).reshape(n, -1)
                for m, state in states.items():
                    held = roles[:, m] == VALID
                    if held.any():
                        lost = row_losses(settings.loss, net.forward(state[:net.size], x[held])[-1], y[held])
                        facts[m][:2] += int(round(float(lost.sum()) * UNIT)), int(held.sum())
                    own = np.flatnonzero(roles[:, m] == TRAIN)
                    if train and len(own):
                        after = _local(net, state, x[own], y[own], settings, (settings.seed, epoch, shard, m), steps)
                        total[m] += np.round(after * (len(own) / SHARD_ROWS) * UNIT).astype(np.int64)
                        facts[m][2] += len(own)
        for m in states:
            yield pa.RecordBatch.from_arrays([pa.array([m], pa.int32()), pa.array([facts[m].tolist() + (total[m].tolist() if train else [])],
                                                                               pa.list_(pa.int64()))], ["model", "sums"])

    # as many rows as there are models and weights
    added = shards.mapInArrow(run, "model int, sums array<bigint>").select("model", F.posexplode("sums").alias("at", "v"))
    return added.groupBy("model", "at").agg(F.sum("v").alias("v")).groupBy("model").agg(
        F.array_sort(F.collect_list(F.struct("at", "v"))).alias("sums")).collect()


def _local(net: Net, state: np.ndarray, x: np.ndarray, y: np.ndarray, settings: NetSettings, seed: tuple, steps: int) -> np.ndarray:
    """A pass of mini-batch steps over a shard; the state is weights and two moments."""
    rng = np.random.default_rng(seed)
    w, m, v = (part.copy() for part in np.split(state, 3))
    order = rng.permutation(len(x))
    for i in range(0, len(x), settings.batch_size):
        rows = order[i: i + settings.batch_size]
        keep = None
        if settings.dropout_rate > 0:
            stays = 1 - settings.dropout_rate
            keep = [(rng.random((len(rows), b)) < stays) / stays for _, b in net.shapes[:-1]]
        g = net.gradient(w, x[rows], y[rows], settings.loss, keep)
        steps += 1
        if settings.optimizer == "sgd":
            w -= settings.learning_rate * g
            continue
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= settings.learning_rate * (m / (1 - 0.9 ** steps)) / (np.sqrt(v / (1 - 0.999 ** steps)) + 1e-8)
    return np.concatenate([w, m, v])


def fit_perceptrons(
    df: DataFrame, key: str, label: str, features: Sequence[str], roles: Column, models: int, settings: NetSettings, patience: int = 0,
) -> list[Perceptron]:
    """Train ``models`` networks in lockstep; ``roles`` is an array with 1 where a row trains and 2 where it measures a model.

    Rows without a label take no part; missing features are an error. Inputs (and a continuous target) are scaled by the mean
    and spread of all rows that train a model.
    """
    features = list(features)
    require_columns(df, [key, label, *features])
    rows = df.select(F.xxhash64(F.lit(settings.seed), F.col(key)).alias("h"), F.col(label).cast("double").alias("y"), _inputs(df, features).alias("x"),
                     roles.alias("roles")).filter(F.col("y").isNotNull() & F.exists("roles", lambda r: r > 0))
    used = rows.filter(F.exists("roles", lambda r: r == TRAIN))
    # one row per input
    spread = used.select(F.posexplode("x").alias("at", "v")).groupBy("at").agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).orderBy("at").collect()
    facts = used.agg(F.avg("y"), F.stddev_pop("y"), F.max("y")).first()
    n = rows.count()
    if not spread:
        raise ValueError("no training rows")
    width = len(spread)
    shift, scale = np.array([r["m"] for r in spread]), np.array([r["s"] or 1.0 for r in spread])
    if not settings.standardize:
        shift, scale = np.zeros(width), np.ones(width)
    regression = settings.loss == MSE and settings.standardize
    ts, td = (facts[0], facts[1] or 1.0) if regression else (0.0, 1.0)
    sizes = [width, *settings.hidden_sizes, int(facts[2]) + 1 if settings.loss == CE else 1]
    net = Net(sizes)
    shards = _packed(rows, max(1, math.ceil(n / SHARD_ROWS)), width, shift, scale, ts, td)
    states = {m: np.concatenate([net.start(settings.seed), np.zeros(2 * net.size)]) for m in range(models)}
    best = {m: (math.inf, 0, states[m][:net.size]) for m in states}
    curves: dict[int, list[float]] = {m: [] for m in states}
    active, steps = set(states), 0
    per_epoch = math.ceil(SHARD_ROWS / settings.batch_size)
    for epoch in range(settings.epochs + 1):
        last = epoch == settings.epochs
        found = _epoch(shards, {m: states[m] for m in active}, net, settings, width, epoch, steps, not last)
        steps += per_epoch
        for r in found:
            m, sums = r["model"], np.array([s["v"] for s in r["sums"]], dtype=object)
            lost, measured, trained = sums[:3]
            if not last and not trained:
                raise ValueError("no training rows")
            if measured:
                curves[m].append(float(lost) / UNIT / measured * (td * td if settings.loss == MSE else 1.0))
            if not measured or curves[m][-1] < best[m][0]:
                best[m] = (curves[m][-1] if measured else math.inf, epoch, states[m][:net.size])
            if patience and measured and epoch - best[m][1] >= patience:
                active.discard(m)
            elif not last:
                states[m] = sums[3:].astype(float) / UNIT * (SHARD_ROWS / trained)
        if not active:
            break
    discard(shards)
    out = []
    for m in range(models):
        # without patience the weights at the end count
        weights, epoch = (best[m][2], best[m][1]) if patience and curves[m] else (states[m][:net.size], settings.epochs)
        out.append(Perceptron(features, sizes, weights, shift, scale, float(ts), float(td), settings, tuple(curves[m]), epoch))
    return out


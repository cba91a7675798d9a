"""Gradient boosting by histograms, all folds and classes of a round in the same passes.

Features are cut into at most ``max_bin`` bins once and the rows are written with one
byte per feature. A level of all trees of a round (one tree per model and
class) is one aggregate: tasks add up gradients, second derivatives and rows by
(tree, node, feature, bin), Spark adds these sums up, running sums over the bins of a
feature give the gain of every cut, and one row per node, its best cut, reaches
the driver. Where the features of a tree have few combinations of bins (``JOINT_CELLS`` for all trees of a round),
the sums by combination are taken in one pass instead, and a task grows the whole tree from them. Where all features
have few combinations and the loss is squared, a score belongs to a combination and its gradient follows from rows and sums of
labels; which rows a round draws depends on no tree, so one pass adds up those of many rounds and a task per model grows their trees.
The first pass of a round also gives the validation loss of the trees so far, so a
model that runs out of patience stops there: ``best + patience`` rounds are trained.

Scores are carried with the rows. Tasks add the trees that are not in them yet: from a table of the
sums of all trees over the same features, or one by one where such a table would be much larger than the trees. When there are
``KEEP_ROUNDS`` tables and single trees, the rows are written anew with all of them.
Rows and columns are drawn by hashes, so any partitioning gives the same draws.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.frame import discard, key_text, materialise, require_columns
from foldwise.operators.order_stats import nearest_quantiles

KEEP_ROUNDS = 10
DENSE_CELLS = 1 << 22
JOINT_CELLS = 1 << 20
AHEAD_CELLS = 1 << 22
AHEAD_ROWS = 1 << 18
AHEAD_ROUNDS = 64
NODE_CELLS = 32  # of a table of scores, for each node of its trees
PART_CELLS = 1 << 18
MOST_BINS = 254
TRAIN, VALID = 1, 2

SQUARED_LOSS, ABSOLUTE_LOSS, BINARY_LOSS, CLASSES_LOSS = "squared", "absolute", "binary", "classes"

# fixed values: what the three libraries take for settings that are not given
DEFAULTS = {
    "lgbm": {"rounds": 100, "learning_rate": 0.1, "max_depth": -1, "num_leaves": 31, "min_child_samples": 20,
             "min_child_weight": 1e-3, "reg_lambda": 0.0},
    "xgb": {"rounds": 1000, "learning_rate": 0.3, "max_depth": 6, "num_leaves": 0, "min_child_samples": 1,
            "min_child_weight": 1.0, "reg_lambda": 1.0},
    "catboost": {"rounds": 1000, "learning_rate": 0.03, "max_depth": 6, "num_leaves": 0, "min_child_samples": 1,
                 "min_child_weight": 0.0, "reg_lambda": 3.0},
}
# fixed values: other names of the settings
ALIASES = {
    "rounds": ("n_estimators", "num_boost_round", "iterations", "num_iterations", "maxIter"),
    "learning_rate": ("eta", "stepSize"),
    "max_depth": ("depth", "maxDepth"),
    "num_leaves": ("max_leaves",),
    "min_child_samples": ("min_data_in_leaf", "minInstancesPerNode"),
    "min_child_weight": ("min_sum_hessian_in_leaf",),
    "reg_alpha": ("lambda_l1", "alpha"),
    "reg_lambda": ("lambda_l2", "l2_leaf_reg", "lambda"),
    "gamma": ("min_split_gain", "min_gain_to_split", "min_split_loss"),
    "subsample": ("bagging_fraction", "subsamplingRate"),
    "subsample_freq": ("bagging_freq",),
    "colsample_bytree": ("feature_fraction", "rsm"),
    "colsample_bynode": ("feature_fraction_bynode",),
    "max_bin": ("border_count", "maxBins"),
    "seed": ("random_state", "random_seed"),
}
OBJECTIVES = {
    SQUARED_LOSS: ("regression", "regression_l2", "l2", "mse", "mean_squared_error", "rmse", "root_mean_squared_error",
                   "reg:squarederror", "reg:linear", "RMSE", "squared"),
    ABSOLUTE_LOSS: ("regression_l1", "l1", "mae", "mean_absolute_error", "reg:absoluteerror", "MAE", "absolute"),
    BINARY_LOSS: ("binary", "binary:logistic", "logloss", "Logloss", "cross_entropy"),
    CLASSES_LOSS: ("multiclass", "multi:softprob", "multi:softmax", "softmax", "MultiClass"),
}
PLAIN_BOOSTING = ("gbdt", "gbrt", "gbtree", "Plain")
# settings that say where or how to compute, not what; several classes are counted from the labels
WITHOUT_EFFECT = (
    "metric", "eval_metric", "verbose", "verbosity", "silent", "n_jobs", "nthread", "num_threads", "thread_count",
    "importance_type", "tree_method", "device", "device_type", "task_type", "force_col_wise", "force_row_wise",
    "enable_categorical", "num_class", "allow_writing_files", "logging_level", "deterministic", "predictor")


@dataclass(frozen=True)
class Settings:
    """What is trained."""

    rounds: int = 100
    learning_rate: float = 0.1
    max_depth: int = 6
    num_leaves: int = 0
    min_child_samples: int = 1
    min_child_weight: float = 0.0
    reg_alpha: float = 0.0
    reg_lambda: float = 0.0
    gamma: float = 0.0
    subsample: float = 1.0
    subsample_freq: int = 1
    colsample_bytree: float = 1.0
    colsample_bylevel: float = 1.0
    colsample_bynode: float = 1.0
    max_bin: int = 254
    seed: int = 0
    loss: str = SQUARED_LOSS

    @property
    def deepest(self) -> int:
        return self.max_depth if self.max_depth > 0 else 1 << 20

    @property
    def classification(self) -> bool:
        return self.loss in (BINARY_LOSS, CLASSES_LOSS)


def loss_of(objective: str | None) -> str:
    if objective is None:
        return SQUARED_LOSS
    for loss, names in OBJECTIVES.items():
        if objective in names:
            return loss
    raise ValueError(f"objective without a counterpart: '{objective}'")


def settings_of(family: str, params: Mapping, rounds: int | None = None) -> Settings:
    """The settings of a library's parameters; a parameter without a counterpart is an error."""
    own = {alias: name for name, aliases in ALIASES.items() for alias in aliases}
    given, kind = dict(params), params.get("boosting_type", params.get("booster"))
    if kind is not None and kind not in PLAIN_BOOSTING:
        raise ValueError(f"boosting type without a counterpart: '{kind}'")
    objectives = {loss_of(given.pop(name)) for name in ("objective", "loss_function", "lossType") if name in given}
    if len(objectives) > 1:
        raise ValueError(f"objectives contradict each other: {sorted(objectives)}")
    for name in ("boosting_type", "booster", *WITHOUT_EFFECT):
        given.pop(name, None)
    values = dict(DEFAULTS[family])
    known = set(Settings.__dataclass_fields__) - {"loss"}
    unknown = sorted(k for k in given if own.get(k, k) not in known)
    if unknown:
        raise ValueError(f"boosting parameters without a counterpart: {unknown}")
    for name, value in given.items():
        if value is not None:
            values[own.get(name, name)] = value
    if rounds:
        values["rounds"] = rounds
    if family == "lgbm" and not given.get("subsample_freq", given.get("bagging_freq", 0)) > 0:
        # that library draws rows only where it is told how often
        values["subsample"] = 1.0
    whole = ("rounds", "max_depth", "num_leaves", "min_child_samples", "subsample_freq", "max_bin", "seed")
    values = {k: int(v) if k in whole else float(v) for k, v in values.items()}
    values["max_bin"] = max(2, min(values.get("max_bin", MOST_BINS), MOST_BINS))
    values["subsample_freq"] = max(1, values.get("subsample_freq", 1))
    return Settings(**values, loss=objectives.pop() if objectives else SQUARED_LOSS)


# -- trees

@dataclass
class Tree:
    """Nodes as lists; ``cut`` is the last bin that goes left, or for categories the set of bins that do."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[object] = field(default_factory=lambda: [0])
    missing_left: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut, missing_left: bool, values: tuple[float, float], gain: float) -> tuple[int, int]:
        children = len(self.feature), len(self.feature) + 1
        self.feature[node], self.cut[node], self.missing_left[node], self.gain[node] = feature, cut, missing_left, gain
        self.left[node], self.right[node] = children
        for value in values:
            for name, empty in (("feature", -1), ("cut", 0), ("missing_left", False), ("left", 0), ("right", 0), ("value", value), ("gain", 0.0)):
                getattr(self, name).append(empty)
        return children

    @property
    def leaves(self) -> int:
        return sum(f < 0 for f in self.feature)

    def goes_left(self) -> np.ndarray:
        """Node x bin: which bins go left."""
        sets = {node: list(cut) for node, cut in enumerate(self.cut) if isinstance(cut, (frozenset, set, list, tuple))}
        table = np.arange(MOST_BINS + 2) <= np.array([0 if node in sets else cut for node, cut in enumerate(self.cut)])[:, None]
        for node, taken in sets.items():
            table[node, taken] = True
        table[:, 0] = self.missing_left
        return table

    def leaf_masks(self) -> tuple[list[int], dict[int, np.ndarray]]:
        """The leaves, and for each feature used a word per bin with the bits of the leaves that this bin may reach."""
        side, leaves, way = self.goes_left(), [], []
        walk = [(0, {})]
        while walk:
            node, allowed = walk.pop()
            f = self.feature[node]
            if f < 0:
                leaves.append(node)
                way.append(allowed)
                continue
            for child, goes in ((self.left[node], side[node]), (self.right[node], ~side[node])):
                walk.append((child, {**allowed, f: allowed[f] & goes if f in allowed else goes}))
        word = np.uint16 if len(leaves) <= 16 else np.uint64
        masks = {f: np.zeros(MOST_BINS + 2, word) for f in set(self.feature) if f >= 0}
        for i, allowed in enumerate(way):
            for f, mask in masks.items():
                mask[allowed.get(f, slice(None))] |= word(1 << i)
        return leaves, masks

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row of bins."""
        if 1 < self.leaves <= 64:
            # what all features allow is one leaf
            known = self.__dict__.get("_ways")
            if known is None or known[0] != len(self.feature):
                known = self.__dict__["_ways"] = len(self.feature), *self.leaf_masks()
            _, leaves, masks = known
            reached = None
            for f, mask in masks.items():
                here = mask[bins[:, f]]
                reached = here if reached is None else reached & here
            return np.array(leaves)[np.frexp(reached.astype(np.float64))[1] - 1]
        node = np.zeros(len(bins), np.int64)
        feature, left, right, side = np.array(self.feature), np.array(self.left), np.array(self.right), self.goes_left()
        inner = np.flatnonzero(feature[node] >= 0)
        while len(inner):
            at = node[inner]
            goes = side[at, bins[inner, feature[at]]]
            node[inner] = np.where(goes, left[at], right[at])
            inner = inner[feature[node[inner]] >= 0]
        return node

    def scores(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.nodes(bins)]


def _joint(bins: np.ndarray, features: Sequence[int], sizes: Sequence[int]) -> np.ndarray:
    """Number of the combination of bins that a row has in some features."""
    code = np.zeros(len(bins), np.intp)
    for f in features:
        code *= sizes[f]
        code += bins[:, f]
    return code


def _combinations(features: Sequence[int], sizes: Sequence[int], codes: np.ndarray, width: int) -> np.ndarray:
    """The bins of combinations; those of other features are 0 and take no memory."""
    bins, rest = np.zeros((len(codes), width), np.uint8, order="F"), codes
    for f in reversed(features):
        rest, bins[:, f] = np.divmod(rest, sizes[f])
    return bins


class Added:
    """Trees that are to be added to scores, those over the same features as a table over the combinations of their bins."""

    def __init__(self, sizes: Sequence[int]):
        self.sizes = tuple(sizes)
        self.tables: dict[tuple[int, tuple[int, ...]], np.ndarray] = {}
        self.single: dict[tuple[int, tuple[int, ...]], list[Tree]] = {}

    def add(self, slot: int, tree: Tree) -> None:
        key = slot, tuple(sorted({f for f in tree.feature if f >= 0}))
        own = self.single.setdefault(key, [])
        own.append(tree)
        cells = math.prod(self.sizes[f] for f in key[1])
        if key in self.tables or cells <= NODE_CELLS * sum(len(t.feature) for t in own):
            bins = _combinations(key[1], self.sizes, np.arange(cells), len(self.sizes))
            self.tables[key] = sum((t.scores(bins) for t in self.single.pop(key)), self.tables.get(key, 0.0))

    def most(self) -> int:
        """Tables and single trees of a slot."""
        counts: dict[int, int] = {}
        for (slot, _), n in [*((k, 1) for k in self.tables), *((k, len(own)) for k, own in self.single.items())]:
            counts[slot] = counts.get(slot, 0) + n
        return max(counts.values(), default=0)

    def to(self, scores: np.ndarray, bins: np.ndarray) -> np.ndarray:
        scores, codes = scores.copy(), {}
        for (slot, features), table in self.tables.items():
            if features not in codes:
                codes[features] = _joint(bins, features, self.sizes)
            scores[:, slot] += table[codes[features]]
        for (slot, _), own in self.single.items():
            for tree in own:
                scores[:, slot] += tree.scores(bins)
        return scores


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _drawn(keys: np.ndarray, seed: int, share: float) -> np.ndarray:
    """Which rows belong to a share drawn by hash."""
    if share >= 1:
        return np.ones(len(keys), bool)
    return _mix(keys.view(np.uint64) ^ _mix(np.array([seed], np.uint64))) < np.uint64(int(share * 2.0 ** 64))


def _columns(given: np.ndarray, share: float, *seed: int) -> np.ndarray:
    """A share of the columns, at least one, drawn by hash."""
    if share >= 1:
        return given
    mark = np.array([0], np.uint64)
    for s in seed:
        mark = _mix((mark + np.uint64(s + 1)) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(_mix(given.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) ^ mark), kind="stable")
    return np.sort(given[order[:max(1, int(share * len(given)))]])


def _node_columns(given: np.ndarray, share: float, nodes: Sequence[int], width: int, *seed: int) -> np.ndarray:
    """Node x feature: ``_columns`` of each node, whose number ends the seed."""
    mask = np.zeros((len(nodes), width), bool)
    if share >= 1:
        mask[:, given] = True
        return mask
    mark = np.array([0], np.uint64)
    for s in (*seed, np.array(nodes, np.uint64)):
        mark = _mix((mark + np.uint64(1) + np.asarray(s, np.uint64)) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(_mix((given.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))[None, :] ^ mark[:, None]), axis=1, kind="stable")
    np.put_along_axis(mask, given[order[:, :max(1, int(share * len(given)))]], True, axis=1)
    return mask


def best_round(losses: Sequence[float], patience: int) -> int:
    """Number of rounds up to the smallest loss before ``patience`` rounds without a smaller one."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


# -- losses

def gradients(loss: str, y: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives, rows x classes (one column unless there are several classes)."""
    if loss == SQUARED_LOSS:
        return scores - y[:, None], np.ones_like(scores)
    if loss == ABSOLUTE_LOSS:
        return np.sign(scores - y[:, None]), np.ones_like(scores)
    chances = probabilities(loss, scores)
    if loss == BINARY_LOSS:
        return chances - y[:, None], np.maximum(chances * (1 - chances), 1e-16)
    hit = y[:, None] == np.arange(scores.shape[1])
    return chances - hit, np.maximum(2 * chances * (1 - chances), 1e-16)


def probabilities(loss: str, scores: np.ndarray) -> np.ndarray:
    if loss == BINARY_LOSS:
        return 1 / (1 + np.exp(-np.clip(scores, -700, 700)))
    grown = np.exp(scores - scores.max(axis=1, keepdims=True))
    return grown / grown.sum(axis=1, keepdims=True)


def losses(loss: str, y: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """Loss of each row."""
    if loss == SQUARED_LOSS:
        return (scores[:, 0] - y) ** 2
    if loss == ABSOLUTE_LOSS:
        return np.abs(scores[:, 0] - y)
    chances = probabilities(loss, scores)
    if loss == BINARY_LOSS:
        hit = np.where(y > 0.5, chances[:, 0], 1 - chances[:, 0])
    else:
        hit = chances[np.arange(len(y)), y.astype(np.int64)]
    return -np.log(np.maximum(hit, 1e-15))


# -- models

@dataclass(frozen=True)
class Binning:
    """How features become bins: upper bounds of the bins, and the values of categories."""

    features: tuple[str, ...]
    cuts: tuple[tuple[float, ...], ...]
    categories: Mapping[str, tuple[str, ...]]
    vector: str | None = None  # one array column holds all features

    @property
    def categorical(self) -> list[int]:
        return [i for i, f in enumerate(self.features) if f in self.categories]

    def inputs(self, df: DataFrame) -> Column:
        """The features as one array of doubles; a category is its number, null where it is rare or unknown."""
        if self.vector is not None:
            return F.transform(F.sequence(F.lit(0), F.lit(len(self.features) - 1)),
                               lambda i: F.get(F.col(f"`{self.vector}`"), i).cast("double"))

        def number(name: str) -> Column:
            known = self.categories.get(name)
            if known is None:
                return F.col(f"`{name}`").cast("double")
            if not known:
                return F.lit(None).cast("double")
            table = F.create_map(*[x for i, c in enumerate(known) for x in (F.lit(c), F.lit(float(i)))])
            return F.element_at(table, key_text(df, name))
        return F.array(*[number(f) for f in self.features])

    @property
    def sizes(self) -> list[int]:
        """Number of bins of each feature, with that of missing values."""
        return [len(cuts) + 2 for cuts in self.cuts]

    def bins(self, values: np.ndarray) -> np.ndarray:
        """Bins of a matrix of features: 0 where a value is missing, else 1 + the number of bounds below it."""
        out = np.zeros(values.shape, np.uint8)
        for i, cuts in enumerate(self.cuts):
            there = ~np.isnan(values[:, i])
            out[there, i] = 1 + np.searchsorted(np.array(cuts, np.float64), values[there, i], side="left")
        return out


@dataclass(frozen=True)
class BoostedTrees:
    """A fitted model: base scores and one tree per round and class."""

    binning: Binning
    settings: Settings
    base: tuple[float, ...]
    trees: tuple[tuple[Tree, ...], ...]
    curve: tuple[float, ...] = ()

    @property
    def classes(self) -> int:
        return max(2, len(self.base)) if self.settings.classification else 0

    @property
    def best_round(self) -> int:
        return len(self.trees)

    @property
    def rounds_trained(self) -> int:
        return max(len(self.trees), len(self.curve) - 1)

    def importances(self) -> list[tuple[str, float]]:
        """Share of each feature in the gains of all splits."""
        total = np.zeros(len(self.binning.features))
        for tree in (t for own in self.trees for t in own):
            for feature, gain in zip(tree.feature, tree.gain):
                if feature >= 0:
                    total[feature] += gain
        whole = total.sum()
        return list(zip(self.binning.features, (total / whole if whole else total).tolist()))

    def predictor(self) -> Callable[[np.ndarray], np.ndarray]:
        """Predictions of a matrix of features: values, chances of class 1, or rows x classes of chances."""
        binning, base, loss, added = self.binning, np.array(self.base), self.settings.loss, Added(self.binning.sizes)
        for own in self.trees:
            for c, tree in enumerate(own):
                added.add(c, tree)

        def predict(values: np.ndarray) -> np.ndarray:
            bins = binning.bins(values)
            scores = added.to(np.tile(base, (len(bins), 1)), bins)
            if loss == CLASSES_LOSS:
                return probabilities(CLASSES_LOSS, scores)
            return probabilities(BINARY_LOSS, scores)[:, 0] if loss == BINARY_LOSS else scores[:, 0]

        return predict

    def prediction(self, df: DataFrame) -> Column:
        several, of_values = self.settings.loss == CLASSES_LOSS, self.predictor()

        @F.pandas_udf("array<double>" if several else "double")
        def predict(values: pd.Series) -> pd.Series:
            if not len(values):
                return pd.Series([], dtype=object if several else float)
            matrix = np.array([[math.nan if x is None else x for x in row] for row in values], np.float64)
            found = of_values(matrix)
            return pd.Series(list(found) if several else found)

        return predict(self.binning.inputs(df))


def fit_binning(df: DataFrame, features: Sequence[str], max_bin: int, categorical: Sequence[str] = ()) -> Binning:
    """Bounds of about equally full bins: quantiles of a feature, its smallest and its greatest value.

    Of a categorical feature the ``max_bin`` most frequent values get bins; the others count as missing.
    """
    features, vector = list(features), None
    require_columns(df, features)
    if len(features) == 1 and isinstance(df.schema[features[0]].dataType, T.ArrayType):
        vector = features[0]
        size = df.agg(F.max(F.size(f"`{vector}`"))).first()[0] or 0
        features = [f"{vector}[{i}]" for i in range(max(1, size))]
        df = df.select(*[F.get(F.col(f"`{vector}`"), F.lit(i)).alias(f) for i, f in enumerate(features)])
    numeric = [f for f in features if f not in categorical]
    finite = df.select(*[F.when(~F.isnan(F.col(f"`{f}`").cast("double")), F.col(f"`{f}`").cast("double")).alias(f"f{i}")
                         for i, f in enumerate(numeric)])
    grid = [i / max_bin for i in range(max_bin + 1)]
    found = nearest_quantiles(finite, [f"f{i}" for i in range(len(numeric))], grid) if numeric else {}
    cuts = {f: tuple(sorted(set(found[f"f{i}"])))[:max_bin] for i, f in enumerate(numeric)}
    categories = {}
    for f in categorical:
        # at most max_bin rows, the most frequent values
        counted = df.select(key_text(df, f).alias("c")).filter(F.col("c").isNotNull()).groupBy("c").count()
        categories[f] = tuple(r["c"] for r in counted.orderBy(F.desc("count"), "c").limit(max_bin).collect())
        cuts[f] = tuple(float(i) for i in range(len(categories[f])))
    return Binning(tuple(features), tuple(cuts[f] for f in features), categories, vector)


# -- training

PREPARED = "key bigint, y double, roles binary, bins binary, scores binary"


def _prepare(df: DataFrame, key: str, label: str, roles: Column, binning: Binning, bases: np.ndarray) -> DataFrame:
    """Rows of (key hash, label, a role per model, a bin per feature, a score per model and class)."""
    rows = df.select(F.xxhash64(key).alias("key"), F.col(label).cast("double").alias("y"), roles.alias("roles"),
                     binning.inputs(df).alias("x"))
    rows = rows.filter(F.col("y").isNotNull() & F.exists("roles", lambda r: r > 0))
    width, start = len(binning.features), bases.astype(np.float64).ravel()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            values = batch.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, width)
            given = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.uint8).reshape(n, -1)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), _bytes(given), _bytes(binning.bins(values)), _bytes(np.tile(start, (n, 1)))],
                ["key", "y", "roles", "bins", "scores"])

    return materialise(rows.mapInArrow(run, PREPARED))


def _matrix(column: pa.Array, kind, n: int) -> np.ndarray:
    """Rows of equally long bytes as a matrix, from the column's buffers."""
    places = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, ends, data = column.buffers()
    first, last = np.frombuffer(ends, places)[[column.offset, column.offset + n]].tolist()
    return np.frombuffer(data, kind, (last - first) // np.dtype(kind).itemsize, first).reshape(n, -1)


def _bytes(matrix: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    n, size = len(matrix), matrix.itemsize * matrix.shape[1]
    ends = np.arange(n + 1, dtype=np.int32) * np.int32(size)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(matrix))])


def _rewritten(rows: DataFrame, pending: Added) -> DataFrame:
    """The rows with the trees in their scores."""
    def run(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            scores = pending.to(_matrix(batch.column(4), np.float64, n), _matrix(batch.column(3), np.uint8, n))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], _bytes(scores)], batch.schema.names)
    return materialise(rows.mapInArrow(run, PREPARED))


@dataclass
class Open:
    """Nodes of one tree that may be split, and the features allowed at each."""

    tree: Tree
    nodes: list[int]
    features: np.ndarray  # node x feature


CELLS = "tree int, node int, feature int, bin int, g double, h double, n bigint"


def _cells(
    rows: DataFrame, growing: Mapping[int, Open], pending: Added, settings: Settings, classes: int,
    width: int, draw: int, watched: Sequence[int],
) -> DataFrame:
    """Sums of gradients by (tree, node, feature, bin); node -1 holds the loss of a model's validation rows.

    Sums of a task stay in one dense table while that has up to ``DENSE_CELLS`` cells, otherwise those of each batch are sent on.
    """
    bins_per = MOST_BINS + 2
    by_model: dict[int, dict[int, Open]] = {}
    for slot, tree in growing.items():
        by_model.setdefault(slot // classes, {})[slot % classes] = tree
    cells = sum(len(o.nodes) for o in growing.values()) * width * bins_per
    dense = cells <= DENSE_CELLS

    def emit(slot: int, nodes: list[int], code: np.ndarray, sums: Sequence[np.ndarray]) -> pa.RecordBatch:
        node, rest = np.divmod(code, width * bins_per)
        feature, bin_ = np.divmod(rest, bins_per)
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(len(code), slot), pa.int32()), pa.array(np.array(nodes)[node], pa.int32()), pa.array(feature, pa.int32()),
            pa.array(bin_, pa.int32()), pa.array(sums[0]), pa.array(sums[1]), pa.array(sums[2].astype(np.int64))],
            ["tree", "node", "feature", "bin", "g", "h", "n"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {slot: np.zeros((3, len(o.nodes) * width * bins_per)) for slot, o in growing.items()} if dense else {}
        lost = {m: [0.0, 0.0] for m in watched}
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys, y = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
            roles, bins = _matrix(batch.column(2), np.uint8, n), _matrix(batch.column(3), np.uint8, n)
            scores = pending.to(_matrix(batch.column(4), np.float64, n), bins)
            drawn = _drawn(keys, draw, settings.subsample)
            for m in watched:
                held_out = roles[:, m] == VALID
                if held_out.any():
                    lost[m][0] += float(losses(settings.loss, y[held_out], scores[held_out, m * classes:(m + 1) * classes]).sum())
                    lost[m][1] += float(held_out.sum())
            for m, trees in by_model.items():
                own = np.flatnonzero((roles[:, m] == TRAIN) & drawn)
                if not len(own):
                    continue
                g, h = gradients(settings.loss, y[own], scores[own, m * classes:(m + 1) * classes])
                for c, tree in trees.items():
                    place = np.full(len(tree.tree.feature), -1)
                    place[tree.nodes] = np.arange(len(tree.nodes))
                    at = place[tree.tree.nodes(bins[own])]
                    open_rows = np.flatnonzero(at >= 0)
                    if not len(open_rows):
                        continue
                    rows_at = at[open_rows]
                    slot, mine = m * classes + c, bins[own[open_rows]]
                    if dense:
                        sums, size = held[slot].reshape(3, -1, width, bins_per), len(tree.nodes) * bins_per
                        weights = [v[open_rows, c] for v in (g, h)]
                        for f in np.flatnonzero(tree.features.any(axis=0)).tolist():
                            code, used = rows_at * bins_per + mine[:, f], slice(None)
                            if not tree.features[:, f].all():
                                used = tree.features[rows_at, f]
                                code = code[used]
                            for i, added in enumerate((weights[0][used], weights[1][used], None)):
                                sums[i, :, f] += np.bincount(code, added, size).reshape(-1, bins_per)
                    else:
                        code = (rows_at[:, None] * width + np.arange(width)) * bins_per + mine
                        allowed = tree.features[rows_at].ravel()
                        code = code.ravel()[allowed]
                        weights = [np.repeat(v[open_rows, c], width)[allowed] for v in (g, h)]
                        found, back = np.unique(code, return_inverse=True)
                        yield emit(slot, tree.nodes, found, [
                            np.bincount(back, weights[0]), np.bincount(back, weights[1]), np.bincount(back)])
        for slot, sums in held.items():
            found = np.flatnonzero(sums[2])
            yield emit(slot, growing[slot].nodes, found, sums[:, found])
        for m, (total, n) in lost.items():
            if n:
                yield pa.RecordBatch.from_arrays([
                    pa.array([m * classes], pa.int32()), pa.array([-1], pa.int32()), pa.array([-1], pa.int32()), pa.array([0], pa.int32()),
                    pa.array([total]), pa.array([0.0]), pa.array([int(n)], pa.int64())], ["tree", "node", "feature", "bin", "g", "h", "n"])

    found = rows.mapInArrow(run, CELLS)
    if dense:
        # tasks have added up; sums and windows then share one shuffle
        found = found.repartition("tree", "node", "feature")
    return found.groupBy("tree", "node", "feature", "bin").agg(
        F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n"))


def _step(g: float, h: float, settings: Settings, rate: float) -> float:
    rest = math.copysign(max(abs(g) - settings.reg_alpha, 0.0), g)
    return -rate * rest / (h + settings.reg_lambda) if h + settings.reg_lambda > 0 else 0.0


def best_cuts(cells: DataFrame, settings: Settings, categorical: Sequence[int]) -> DataFrame:
    """One row per (tree, node): its sums and its best cut.

    Cuts run along the bins of a feature (categories in the order of their mean gradient); rows without a value go to the side where they
    do better. Of equal gains the smaller feature and the earlier cut win; gains are compared in single precision, so that
    the noise of sums in another order decides nothing. A window holds the at most 255 bins of a feature at a node.
    """
    category = f"feature in ({', '.join(map(str, categorical))})" if categorical else "false"
    taken = f"collect_list(case when {category} and bin > 0 then bin end) over upto" if categorical else "cast(null as array<int>)"

    def strength(g: str, h: str) -> str:
        """Twice the loss that the best constant takes off sums of gradients."""
        return f"coalesce(try_divide(pow(greatest(abs({g}) - {settings.reg_alpha!r}D, 0D), 2), {h} + {settings.reg_lambda!r}D), 0D)"

    def side(g: str, h: str, n: str) -> str:
        """Gain of a cut whose left side has these sums; null where a side is too small."""
        return (f"case when least({n}, nt - ({n})) >= {max(1, settings.min_child_samples)} and least({h}, ht - ({h})) >= {settings.min_child_weight!r}D "
                f"and bin > 0 then ({strength(g, h)} + {strength(f'(gt - {g})', f'ht - {h}')} - {strength('gt', 'ht')}) / 2 - {settings.gamma!r}D end")

    return cells.sparkSession.sql(f"""
        with ordered as (
          select *, case when bin = 0 then double('-infinity') when {category} then try_divide(g, h + 10) else double(bin) end as ord from {{cells}}),
        sums as (
          select tree, node, feature, bin, sum(g) over upto as gl, sum(h) over upto as hl, sum(n) over upto as nl,
                 sum(g) over whole as gt, sum(h) over whole as ht, sum(n) over whole as nt,
                 coalesce(max(case when bin = 0 then g end) over whole, 0D) as gm, coalesce(max(case when bin = 0 then h end) over whole, 0D) as hm,
                 coalesce(max(case when bin = 0 then n end) over whole, 0L) as nm, {taken} as taken, row_number() over ranked as place
          from ordered
          window whole as (partition by tree, node, feature), ranked as (partition by tree, node, feature order by ord, bin),
                 upto as (partition by tree, node, feature order by ord, bin rows between unbounded preceding and current row)),
        sides as (select *, {side("gl", "hl", "nl")} as with_missing, {side("(gl - gm)", "(hl - hm)", "(nl - nm)")} as without from sums),
        chosen as (select *, coalesce(with_missing, -1D) > coalesce(without, -1D) + 1e-12D as missing_left from sides),
        cuts as (
          select *, if(missing_left, with_missing, without) as gain, if(missing_left, 0D, gm) as g0, if(missing_left, 0D, hm) as h0 from chosen)
        select tree, node, max_by(
          struct(gain, feature, bin, taken, missing_left as left, gl - g0 as gl, hl - h0 as hl, gt as g, ht as h, nt as n),
          struct(float(coalesce(gain, -1D)), -feature, -place)) as best
        from cuts group by tree, node""", cells=cells)


SUMS, GROWN = "tree int, cell int, g double, h double, n bigint", "tree int, lost double, held bigint, grown binary"


def _joint_sums(
    rows: DataFrame, growing: Mapping[int, Sequence[int]], pending: Added, settings: Settings, classes: int, draw: int, watched: Sequence[int],
) -> DataFrame:
    """Sums of gradients by (tree, combination of the bins of its features); combination -1 holds the loss of a model's validation rows.

    Rows are gathered until they are as many as there are combinations, so the work of a task does not grow with the tables.
    """
    sizes, ones = pending.sizes, settings.loss in (SQUARED_LOSS, ABSOLUTE_LOSS)
    cells = {slot: math.prod(sizes[f] for f in features) for slot, features in growing.items()}
    by_model: dict[int, list[int]] = {}
    for slot in growing:
        by_model.setdefault(slot // classes, []).append(slot)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        waiting: dict[int, list] = {slot: [] for slot in growing}
        lost = {m: [0.0, 0] for m in watched}

        def put(slot: int) -> None:
            if not waiting[slot]:
                return
            code, g, h = (np.concatenate(x) if x[0] is not None else None for x in zip(*waiting[slot]))
            n = np.bincount(code, minlength=cells[slot])
            sums = np.stack([np.bincount(code, g, cells[slot]), n if h is None else np.bincount(code, h, cells[slot]), n])
            held[slot], waiting[slot] = held[slot] + sums if slot in held else sums, []

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys, y = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
            roles, bins = _matrix(batch.column(2), np.uint8, n), _matrix(batch.column(3), np.uint8, n)
            scores = pending.to(_matrix(batch.column(4), np.float64, n), bins)
            drawn, codes = _drawn(keys, draw, settings.subsample), {}
            for m in watched:
                held_out = roles[:, m] == VALID
                if held_out.any():
                    lost[m][0] += float(losses(settings.loss, y[held_out], scores[held_out, m * classes:(m + 1) * classes]).sum())
                    lost[m][1] += int(held_out.sum())
            for m, slots in by_model.items():
                own = np.flatnonzero((roles[:, m] == TRAIN) & drawn)
                if not len(own):
                    continue
                g, h = gradients(settings.loss, y[own], scores[own, m * classes:(m + 1) * classes])
                for slot in slots:
                    features = tuple(growing[slot])
                    if features not in codes:
                        codes[features] = _joint(bins, features, sizes)
                    waiting[slot].append((codes[features][own], g[:, slot % classes], None if ones else h[:, slot % classes]))
                    if sum(len(x[0]) for x in waiting[slot]) >= cells[slot]:
                        put(slot)
        for slot in growing:
            put(slot)
        for slot, sums in held.items():
            found = np.flatnonzero(sums[2])
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(found), slot), pa.int32()), pa.array(found, pa.int32()), pa.array(sums[0, found]), pa.array(sums[1, found]),
                pa.array(sums[2, found].astype(np.int64))], ["tree", "cell", "g", "h", "n"])
        for m, (total, n) in lost.items():
            if n:
                yield pa.RecordBatch.from_arrays([
                    pa.array([m * classes], pa.int32()), pa.array([-1], pa.int32()), pa.array([total]), pa.array([0.0]), pa.array([n], pa.int64())],
                    ["tree", "cell", "g", "h", "n"])

    return rows.mapInArrow(run, SUMS).groupBy("tree", "cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n"))


def _joint_trees(
    sums: DataFrame, growing: Mapping[int, Sequence[int]], sizes: Sequence[int], settings: Settings, categorical: Sequence[int], number: int, rate: float,
) -> DataFrame:
    """A row per tree: the loss of its model's validation rows, and the tree grown from its sums by combination.

    A task holds the sums of its trees, at most ``JOINT_CELLS`` rows.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if (batches := [b for b in batches if b.num_rows]) else None
        if table is None:
            return
        tree, cell, g, h, n = (table.column(c).to_numpy() for c in ("tree", "cell", "g", "h", "n"))
        for slot in np.unique(tree).tolist():
            loss, own = np.flatnonzero((tree == slot) & (cell < 0)), np.flatnonzero((tree == slot) & (cell >= 0))
            # in the order of combinations: any layout of the shuffle adds up alike
            own = own[np.argsort(cell[own])]
            grown = None
            if slot in growing and len(own):
                bins = _combinations(growing[slot], sizes, cell[own], len(sizes))
                grown = pickle.dumps(_grow_alone(slot, growing[slot], bins, (g[own], h[own], n[own]), sizes, settings, categorical, number, rate))
            yield pa.RecordBatch.from_arrays([
                pa.array([slot], pa.int32()), pa.array(g[loss] if len(loss) else [None], pa.float64()),
                pa.array(n[loss] if len(loss) else [None], pa.int64()), pa.array([grown], pa.binary())], ["tree", "lost", "held", "grown"])

    return sums.repartition(max(1, len(growing)), "tree").mapInArrow(run, GROWN)


def _grow_alone(
    slot: int, allowed: np.ndarray, bins: np.ndarray, sums: Sequence[np.ndarray], sizes: Sequence[int], settings: Settings,
    categorical: Sequence[int], number: int, rate: float,
) -> Tree:
    """A tree from sums of gradients, second derivatives and rows by combination of bins."""
    tree, growing, at = Tree(), {slot: (allowed, [0])}, np.zeros(len(bins), np.intp)
    for depth in range(settings.deepest):
        asked = _asked({slot: tree}, growing, settings, number, depth, len(sizes))[slot]
        found = [{"tree": slot, "node": node, "best": best} for node, best in _cuts_alone(asked, at, bins, sums, sizes, settings, categorical)]
        growing = _grown({slot: tree}, growing, found, settings, rate)
        if not growing:
            break
        at = _below(tree, at, bins)
    return tree


def _below(tree: Tree, at: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """The nodes after one more step down."""
    feature, at = np.array(tree.feature), at.copy()
    inner = np.flatnonzero(feature[at] >= 0)
    node = at[inner]
    own, sets = bins[inner, feature[node]], {i: c for i, c in enumerate(tree.cut) if isinstance(c, frozenset)}
    cut = np.array([0 if i in sets else c for i, c in enumerate(tree.cut)])
    goes = own <= cut[node]
    if sets:
        place, taken = np.full(len(feature), -1), np.zeros((len(sets), MOST_BINS + 2), bool)
        for i, (split, cut_set) in enumerate(sets.items()):
            place[split], taken[i, list(cut_set)] = i, True
        goes = np.where(place[node] >= 0, taken[place[node], own], goes)
    goes = np.where(own > 0, goes, np.array(tree.missing_left)[node])
    at[inner] = np.where(goes, np.array(tree.left)[node], np.array(tree.right)[node])
    return at


def _cuts_alone(
    asked: Open, at: np.ndarray, bins: np.ndarray, sums: Sequence[np.ndarray], sizes: Sequence[int], settings: Settings, categorical: Sequence[int],
) -> Iterator[tuple[int, dict]]:
    """What ``best_cuts`` finds, for the nodes of one tree of which a task has all sums; nodes without a gain are left out, but for the root."""
    place = np.full(len(asked.tree.feature), -1)
    place[asked.nodes] = np.arange(len(asked.nodes))
    place = place[at]
    inside = np.flatnonzero(place >= 0)
    order = inside[np.argsort(place[inside], kind="stable")]
    starts = np.searchsorted(place[order], np.arange(len(asked.nodes) + 1))
    step = max(1, PART_CELLS // max(sizes))
    for first in range(0, len(asked.nodes), step):
        last = min(first + step, len(asked.nodes))
        own = order[starts[first]:starts[last]]
        yield from _cuts_of_part(asked.nodes[first:last], asked.features[first:last], place[own] - first, own, bins, sums, sizes, settings, categorical)


def _cuts_of_part(
    nodes: Sequence[int], features: np.ndarray, at: np.ndarray, own: np.ndarray, bins: np.ndarray, sums: Sequence[np.ndarray], sizes: Sequence[int],
    settings: Settings, categorical: Sequence[int],
) -> Iterator[tuple[int, dict]]:
    """The cuts of some nodes, which hold the combinations ``own``."""
    def strength(g, h):
        rest = h + settings.reg_lambda
        return np.divide(np.maximum(np.abs(g) - settings.reg_alpha, 0.0) ** 2, rest, out=np.zeros_like(rest), where=rest != 0)

    best = np.full(len(nodes), -np.inf, np.float32)
    facts: list[dict | None] = [None] * len(nodes)
    for f in np.flatnonzero(features.any(axis=0)).tolist():
        size, having = sizes[f], np.flatnonzero(features[:, f])
        row = np.full(len(nodes), -1)
        row[having] = np.arange(len(having))
        row = row[at]
        there = np.flatnonzero(row >= 0)
        cells = own[there]
        code = row[there] * size + bins[cells, f]
        g, h, n = (np.bincount(code, s[cells], len(having) * size).reshape(-1, size) for s in sums)
        numbers = np.broadcast_to(np.arange(size), g.shape)
        if f in categorical:
            # empty bins last
            by = np.where(n > 0, np.divide(g, h + 10, out=np.zeros_like(g), where=h + 10 != 0), np.inf)
            by[:, 0] = -np.inf
            numbers = np.argsort(by, axis=1, kind="stable")
            g, h, n = (np.take_along_axis(x, numbers, axis=1) for x in (g, h, n))
        gl, hl, nl = (np.cumsum(x, axis=1) for x in (g, h, n))
        gt, ht, nt = (x[:, -1:] for x in (gl, hl, nl))
        gm, hm, nm = (x[:, :1] for x in (g, h, n))

        def gains(gl, hl, nl):
            gr, hr = gt - gl, ht - hl
            fits = (np.minimum(nl, nt - nl) >= max(1, settings.min_child_samples)) & (np.minimum(hl, hr) >= settings.min_child_weight) & (n > 0)
            fits[:, 0] = False
            return np.where(fits, (strength(gl, hl) + strength(gr, hr) - strength(gt, ht)) / 2 - settings.gamma, np.nan)

        with_missing, without = gains(gl, hl, nl), gains(gl - gm, hl - hm, nl - nm)
        left = np.nan_to_num(with_missing, nan=-1.0) > np.nan_to_num(without, nan=-1.0) + 1e-12
        gain = np.where(left, with_missing, without)
        ranked = np.nan_to_num(gain, nan=-1.0).astype(np.float32)
        # cuts are made at bins that hold rows
        ranked[n <= 0] = -np.inf
        ranked[:, 0] = np.where(n[:, 0] > 0, np.float32(-1), -np.inf)
        cut = np.argmax(ranked, axis=1)
        rows = np.arange(len(having))
        found = ranked[rows, cut]
        for i in np.flatnonzero(found > best[having]).tolist():
            k, node = int(cut[i]), int(having[i])
            best[node] = found[i]
            if not gain[i, k] > 0 and nodes[node]:
                facts[node] = None
                continue
            goes = bool(left[i, k])
            facts[node] = {
                "gain": None if math.isnan(gain[i, k]) else float(gain[i, k]), "feature": f, "bin": int(numbers[i, k]), "left": goes,
                "taken": [b for b in numbers[i, :k + 1].tolist() if b] if f in categorical and numbers[i, k] else None,
                "gl": float(gl[i, k] - (0 if goes else gm[i, 0])), "hl": float(hl[i, k] - (0 if goes else hm[i, 0])),
                "g": float(gt[i, 0]), "h": float(ht[i, 0]), "n": int(nt[i, 0])}
    for node, fact in zip(nodes, facts):
        if fact is not None:
            yield node, fact


DRAWS = "model int, draw int, cell int, y double, yy double, n bigint"
STRETCH = "model int, losses array<double>, trees binary, scores binary"


def _draws_ahead(
    rows: DataFrame, draws: Mapping[int, int], sizes: Sequence[int], models: Sequence[int], share: float, centre: float, measured: bool,
) -> DataFrame:
    """Rows and sums of labels less ``centre`` by (model, draw, combination of all bins), of the training rows that a draw takes.

    ``draws`` maps numbers to seeds. Draw -1 holds the validation rows, with the sums of squares.
    """
    cells, features = math.prod(sizes), range(len(sizes))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, lost = np.zeros((2, len(draws), len(models), cells)), np.zeros((3, len(models), cells))
        waiting: list[tuple[np.ndarray, ...]] = []

        def put() -> None:
            keys, y, roles, code = (np.concatenate(x) for x in zip(*waiting))
            waiting.clear()
            if measured:
                for i in range(len(models)):
                    own = np.flatnonzero(roles[:, i] == VALID)
                    lost[:, i] += [np.bincount(code[own], w, cells) for w in (y[own], y[own] ** 2, None)]
            kind = None
            if len(models) <= 40:
                # rows that are the same to all models are added up once
                _, first, kind = np.unique(roles @ np.uint64(3) ** np.arange(len(models), dtype=np.uint64), return_index=True, return_inverse=True)
                kinds = roles[first] == TRAIN
                kind = kind if len(kinds) <= len(models) + 1 else None
            for d, seed in draws.items():
                drawn = _drawn(keys, seed, share)
                if kind is not None:
                    own = np.flatnonzero(drawn)
                    place = kind[own] * cells + code[own]
                    for k, weights in ((0, y[own]), (1, None)):
                        sums = np.bincount(place, weights, len(kinds) * cells).reshape(-1, cells)
                        for i in range(len(models)):
                            held[k, d, i] += sums[kinds[:, i]].sum(axis=0)
                    continue
                for i in range(len(models)):
                    own = np.flatnonzero(drawn & (roles[:, i] == TRAIN))
                    held[0, d, i] += np.bincount(code[own], y[own], cells)
                    held[1, d, i] += np.bincount(code[own], None, cells)

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            waiting.append((batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False) - centre,
                            _matrix(batch.column(2), np.uint8, n)[:, models], _joint(_matrix(batch.column(3), np.uint8, n), features, sizes)))
            if sum(len(x[0]) for x in waiting) >= max(AHEAD_ROWS, len(models) * cells):
                put()
        if waiting:
            put()
        for i, m in enumerate(models):
            for d, y, yy, n in [*((-1, *lost[:, i]) for _ in range(measured)), *((d, held[0, d, i], None, held[1, d, i]) for d in draws)]:
                found = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(found), m), pa.int32()), pa.array(np.full(len(found), d), pa.int32()), pa.array(found, pa.int32()),
                    pa.array(y[found]), pa.array(np.zeros(len(found)) if yy is None else yy[found]), pa.array(n[found].astype(np.int64))],
                    ["model", "draw", "cell", "y", "yy", "n"])

    return rows.mapInArrow(run, DRAWS).groupBy("model", "draw", "cell").agg(
        F.sum("y").alias("y"), F.sum("yy").alias("yy"), F.sum("n").alias("n"))


def _stretch(
    sums: DataFrame, scores: Mapping[int, np.ndarray], curves: Mapping[int, Sequence[float]], plan: Sequence[tuple[int, int, float]], sizes: Sequence[int],
    settings: Settings, categorical: Sequence[int], patience: int, last: bool,
) -> DataFrame:
    """A row per model: the losses and trees of some rounds, until patience ends, and the scores of all combinations after them.

    ``plan`` has the round, its draw and its learning rate. After the ``last`` stretch the loss of all trees follows.
    """
    everything = np.arange(len(sizes))

    def grow(m: int, table: pa.Table) -> tuple[list[float], list[Tree], np.ndarray]:
        draw, cell, y, yy, n = (table.column(c).to_numpy() for c in ("draw", "cell", "y", "yy", "n"))
        order = np.lexsort((cell, draw))
        draw, cell, y, yy, n = (x[order] for x in (draw, cell, y, yy, n))
        by_draw = {d: slice(*np.searchsorted(draw, [d, d + 1])) for d in np.unique(draw).tolist()}
        held, score, curve, trees = by_draw.get(-1), scores[m].copy(), list(curves[m]), []
        start, combinations = len(curve), _combinations(everything, sizes, np.arange(len(scores[m])), len(sizes))
        if held is not None:
            mean = y[held] / n[held]
            # what no score can take off: squares around the mean of a combination
            rest, total = np.maximum(yy[held] - y[held] * mean, 0.0).sum(), n[held].sum()

        def measure() -> bool:
            if held is not None:
                curve.append(float(((n[held] * (score[cell[held]] - mean) ** 2).sum() + rest) / total))
            return held is not None and _stopped(curve, patience)

        for number, d, rate in plan:
            if measure():
                return curve[start:], trees, score
            allowed = _columns(everything, settings.colsample_bytree, settings.seed, number, m)
            tree = Tree()
            if d in by_draw:
                own = by_draw[d]
                code, size = _joint(combinations[cell[own]], allowed, sizes), math.prod(sizes[f] for f in allowed)
                rows = np.bincount(code, n[own], size)
                g = np.bincount(code, n[own] * score[cell[own]] - y[own], size)
                found = np.flatnonzero(rows)
                tree = _grow_alone(m, allowed, _combinations(allowed, sizes, found, len(sizes)), (g[found], rows[found], rows[found]), sizes, settings,
                                   categorical, number, rate)
            trees.append(tree)
            added = tree.scores(_combinations(allowed, sizes, np.arange(math.prod(sizes[f] for f in allowed)), len(sizes)))
            score += added[_joint(combinations, allowed, sizes)]
        if last:
            measure()
        return curve[start:], trees, score

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = [b for b in batches if b.num_rows]
        table = pa.Table.from_batches(given) if given else None
        for m in np.unique(table.column("model").to_numpy()).tolist() if given else []:
            curve, trees, score = grow(m, table.filter(pc.equal(table.column("model"), m)))
            yield pa.RecordBatch.from_arrays([
                pa.array([m], pa.int32()), pa.array([curve], pa.list_(pa.float64())), pa.array([pickle.dumps(trees)], pa.binary()),
                pa.array([score.tobytes()], pa.binary())], ["model", "losses", "trees", "scores"])

    return sums.repartition(2 * len(scores), "model").mapInArrow(run, STRETCH)


def _boosted_ahead(
    rows: DataFrame, binning: Binning, bases: np.ndarray, settings: Settings, patience: int, rate_of: Callable[[int], float] | None,
) -> tuple[list[list[list[Tree]]], list[list[float]]]:
    """Trees and losses of all models, the sums of many rounds from each pass over the rows."""
    sizes, models = binning.sizes, len(bases)
    centre = next((b for b in bases[:, 0].tolist() if math.isfinite(b)), 0.0)
    cells = math.prod(sizes)
    forests, curves = [[] for _ in range(models)], [[] for _ in range(models)]
    scores, active, number = {m: np.full(cells, bases[m, 0] - centre) for m in range(models)}, list(range(models)), 0
    while active and number < settings.rounds:
        seeds, plan = [], []
        for r in range(number, settings.rounds):
            seed = settings.seed * 1_000_003 + r // settings.subsample_freq if settings.subsample < 1 else 0
            if not seeds or seeds[-1] != seed:
                if seeds and (len(seeds) + 1) * len(active) * cells > AHEAD_CELLS:
                    break
                seeds.append(seed)
            plan.append((r, len(seeds) - 1, rate_of(r) if rate_of else settings.learning_rate))
            if len(plan) >= AHEAD_ROUNDS:
                break
        number += len(plan)
        sums = _draws_ahead(rows, dict(enumerate(seeds)), sizes, active, settings.subsample, centre, bool(patience))
        found = _stretch(sums, {m: scores[m] for m in active}, {m: curves[m] for m in active}, plan, sizes, settings, binning.categorical, patience,
                         number >= settings.rounds).collect()
        ended = []
        for m in set(active) - {r["model"] for r in found}:
            # no rows drawn, none to measure
            forests[m] += [[Tree()] for _ in plan]
        for r in found:
            m, trees = r["model"], pickle.loads(r["trees"])
            forests[m] += [[t] for t in trees]
            curves[m] += r["losses"]
            scores[m] = np.frombuffer(r["scores"], np.float64)
            ended += [m] if len(trees) < len(plan) else []
        active = [m for m in active if m not in ended]
    return forests, curves


def _stopped(curve: Sequence[float], patience: int) -> bool:
    after = curve[1:]  # the first loss is that of the start score
    return bool(after) and len(after) - best_round(after, patience) >= patience


def _bases(df: DataFrame, label: str, roles: Column, models: int, loss: str) -> tuple[np.ndarray, int]:
    """Start scores, model x class, from the training rows, and the number of score columns."""
    y = F.col(label).cast("double")
    facts = []
    top = 1
    if loss == CLASSES_LOSS:
        top = df.filter(y.isNotNull()).agg(F.max(y)).first()[0]
        top = int(top or 0) + 1
    rows = df.select(y.alias("y"), roles.alias("r")).filter(F.col("y").isNotNull())
    for m in range(models):
        own = F.when(F.get("r", F.lit(m)) == TRAIN, F.col("y"))
        if loss == CLASSES_LOSS:
            facts.append(F.array(F.count(own), *[F.count(F.when(own == c, 1)) for c in range(top)]).cast("array<double>").alias(f"m{m}"))
        elif loss == ABSOLUTE_LOSS:
            facts.append(F.array(F.count(own).cast("double"), F.percentile_approx(own, 0.5, 100_000)).alias(f"m{m}"))
        else:
            facts.append(F.array(F.count(own).cast("double"), F.avg(own)).alias(f"m{m}"))
    found = rows.agg(*facts).first()
    out = np.zeros((models, top))
    for m in range(models):
        n, *values = found[f"m{m}"]
        if not n:
            raise ValueError("no training rows")
        if loss == CLASSES_LOSS:
            out[m] = np.log(np.maximum(np.array(values) / n, 1e-15))
        elif loss == BINARY_LOSS:
            p = min(max(values[0], 1e-15), 1 - 1e-15)
            out[m] = math.log(p / (1 - p))
        else:
            out[m] = values[0]
    return out, top


def fit_boosting(
    df: DataFrame, key: str, label: str, features: Sequence[str], roles: Column, models: int, settings: Settings,
    patience: int = 0, categorical: Sequence[str] = (), rate_of: Callable[[int], float] | None = None,
) -> list[BoostedTrees]:
    """Train ``models`` models in lockstep.

    ``roles`` is an array with a number per model: 1 where the row trains it, 2 where the row
    measures it, 0 where neither. With ``patience`` a model stops after that many rounds without a smaller loss on its
    measuring rows and keeps the trees up to its best round. ``rate_of`` gives the learning rate of a round.
    Labels of classes are 0, 1, 2, ...; rows without a label take no part; missing features go to the better side of a split.
    """
    loss = settings.loss
    bases, classes = _bases(df, label, roles, models, loss)
    binning = fit_binning(df.filter(F.exists(roles, lambda r: r == TRAIN)), features, settings.max_bin, categorical)
    rows = _prepare(df, key, label, roles, binning, bases)
    width, everything, sizes = len(binning.features), np.arange(len(binning.features)), binning.sizes
    forests: list[list[list[Tree]]] = [[] for _ in range(models)]
    curves: list[list[float]] = [[] for _ in range(models)]
    active, pending = list(range(models)), Added(sizes)
    if loss == SQUARED_LOSS and 4 * math.prod(sizes) * models <= AHEAD_CELLS:
        forests, curves = _boosted_ahead(rows, binning, bases, settings, patience, rate_of)
        active = []

    def search(growing, draw, watched):
        cells = _cells(rows, growing, pending, settings, classes, width, draw, watched)
        return best_cuts(cells, settings, binning.categorical).collect()

    def ended(losses):
        """Take down the losses (tree, sum, rows) of the trees so far and let go of the models that stop here."""
        nonlocal active
        for slot, total, n in losses:
            if n:
                curves[slot // classes].append(total / n)
        gone = [m for m in active if _stopped(curves[m], patience)]
        active = [m for m in active if m not in gone]
        for slot in [s for s in trees if s // classes in gone]:
            del trees[slot], growing[slot]

    for number in range(settings.rounds if active else 0):
        draw = settings.seed * 1_000_003 + number // settings.subsample_freq
        rate = rate_of(number) if rate_of else settings.learning_rate
        trees, growing = {}, {}
        for m in active:
            for c in range(classes):
                slot = m * classes + c
                trees[slot] = Tree()
                allowed = _columns(everything, settings.colsample_bytree, settings.seed, number, slot)
                growing[slot] = (allowed, [0])
        watched = active if patience else []
        if sum(math.prod(sizes[f] for f in allowed) for allowed, _ in growing.values()) <= JOINT_CELLS:
            features = {slot: allowed.tolist() for slot, (allowed, _) in growing.items()}
            sums = _joint_sums(rows, features, pending, settings, classes, draw, watched)
            found = _joint_trees(sums, {slot: allowed for slot, (allowed, _) in growing.items()}, sizes, settings, binning.categorical, number, rate).collect()
            if watched:
                ended([(r["tree"], r["lost"], r["held"]) for r in found])
            trees.update({r["tree"]: pickle.loads(r["grown"]) for r in found if r["tree"] in trees and r["grown"] is not None})
        else:
            for depth in range(settings.deepest):
                found = search(_asked(trees, growing, settings, number, depth, width), draw, watched if depth == 0 else [])
                if watched and depth == 0:
                    ended([(r["tree"], r["best"]["g"], r["best"]["n"]) for r in found if r["node"] == -1])
                growing = _grown(trees, growing, found, settings, rate)
                if not growing:
                    break
        if not active:
            break
        for m in active:
            forests[m].append([trees[m * classes + c] for c in range(classes)])
        for slot, tree in trees.items():
            pending.add(slot, tree)
        if pending.most() >= KEEP_ROUNDS and number + 1 < settings.rounds:
            before, rows, pending = rows, _rewritten(rows, pending), Added(sizes)
            discard(before)
    if active and patience:
        trees = growing = {}
        ended([(r["tree"], r["best"]["g"], r["best"]["n"]) for r in search({}, 0, active) if r["node"] == -1])
    discard(rows)
    out = []
    for m in range(models):
        best = len(forests[m])
        if patience and len(curves[m]) > 1:
            best = best_round(curves[m][1:], patience)
        out.append(BoostedTrees(binning, settings, tuple(bases[m].tolist()), tuple(map(tuple, forests[m][:best])), tuple(curves[m])))
    return out


def _asked(trees: Mapping[int, Tree], growing: Mapping, settings: Settings, number: int, depth: int, width: int) -> dict[int, Open]:
    """The nodes open at a level, each with the features drawn for it."""
    out = {}
    for slot, (allowed, nodes) in growing.items():
        level = _columns(allowed, settings.colsample_bylevel, settings.seed, number, slot, depth)
        out[slot] = Open(trees[slot], nodes, _node_columns(level, settings.colsample_bynode, nodes, width, settings.seed, number, slot, depth))
    return out


def _grown(trees: dict[int, Tree], growing: dict, found, settings: Settings, rate: float) -> dict:
    """Split the nodes that gain, the greatest gains first while leaves are left; returns the nodes open next."""
    by_tree: dict[int, list] = {}
    for r in found:
        if r["node"] >= 0 and r["tree"] in trees:
            by_tree.setdefault(r["tree"], []).append((r["node"], r["best"]))
    left = {}
    for slot, (allowed, nodes) in growing.items():
        tree, opened = trees[slot], []
        for node, b in by_tree.get(slot, []):
            if node == 0:
                tree.value[0] = _step(b["g"], b["h"], settings, rate)
        gains = sorted(((b["gain"], node, b) for node, b in by_tree.get(slot, []) if b["gain"] is not None and b["gain"] > 1e-12),
                       key=lambda x: (-np.float32(x[0]), x[1]))
        for gain, node, b in gains:
            if settings.num_leaves and tree.leaves >= settings.num_leaves:
                break
            cut = frozenset(b["taken"]) if b["taken"] else b["bin"]
            values = (_step(b["gl"], b["hl"], settings, rate), _step(b["g"] - b["gl"], b["h"] - b["hl"], settings, rate))
            opened += tree.split(node, b["feature"], cut, b["left"], values, gain)
        if opened and not (settings.num_leaves and tree.leaves >= settings.num_leaves):
            left[slot] = (allowed, sorted(opened))
    return left

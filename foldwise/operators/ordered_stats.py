"""Ordered target statistics: each row is encoded from the rows before it in a random order.

The order is a hash of the row's key, so it depends on the key and the seed only. A row gets
the smoothed mean target of the rows of its category that come before it, never its own. Sums run
inside stretches of the order and are shifted by the stretches before, so a
category with a third of all rows is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.frame import number_or_none, require_columns, require_numeric
from foldwise.functions.hashing import HASH_SPACE, keyed_hash
from foldwise.operators import folds
from foldwise.operators.lookup import FEATURE, KEY, FeatureLookup, attach_features, fit_features, long_keys
from foldwise.operators.order_stats import sums_before


@dataclass(frozen=True)
class OrderedTargetModel:
    """Sums per category of all training rows, and how training rows are ordered."""

    lookup: FeatureLookup
    target: str
    key: str
    seed: int
    smoothing: float
    prior: float
    suffix: str

    def transform_train(self, df: DataFrame) -> DataFrame:
        """Each row gets the statistic of the rows before it. Keys must be unique; null categories get the prior.

        Rows without a target are encoded but add nothing.
        """
        features = self.lookup.features
        require_columns(df, [*features, self.key, self.target])
        buckets = folds._hash_buckets(df.count())
        y = F.col(self.target).cast("double")
        long = long_keys(df, features, [F.col(self.key).alias("__id"), keyed_hash(self.key, self.seed).alias("__h"),
                                        F.coalesce(y, F.lit(0.0)).alias("__y"), F.when(y.isNotNull(), 1).otherwise(0).alias("__n")])
        bucket = F.floor(F.col("__h") * F.lit(buckets) / F.lit(HASH_SPACE)).cast("int")
        summed = sums_before(long.filter(F.col(KEY).isNotNull()), [FEATURE, KEY], ["__h", "__id"], bucket, ["__y", "__n"])
        value = self._smoothed("__y_before", "__n_before")
        names = [f"{f}{self.suffix}" for f in features]
        found = summed.groupBy("__id").agg(*[
            F.max(F.when(F.col(FEATURE) == i, value)).alias(f"__v{i}") for i in range(len(features))])
        joined = df.join(found, F.col(self.key) == F.col("__id"), "left")
        return joined.select(*[F.col(f"`{c}`") for c in df.columns if c not in names], *[
            F.coalesce(F.col(f"__v{i}"), F.lit(self.prior)).alias(n) for i, n in enumerate(names)])

    def transform(self, df: DataFrame) -> DataFrame:
        """Rows outside the training data get the statistic of all of it."""
        outputs = {f: [f"__s_{f}", f"__n_{f}"] for f in self.lookup.features}
        names = [f"{f}{self.suffix}" for f in self.lookup.features]
        found = attach_features(df, self.lookup, outputs)
        return found.select(*[F.col(f"`{c}`") for c in df.columns if c not in names], *[
            F.coalesce(self._smoothed(*outputs[f]), F.lit(self.prior)).alias(n) for f, n in zip(self.lookup.features, names)])

    def _smoothed(self, total: str, rows: str):
        return F.try_divide(F.col(total) + F.lit(self.smoothing * self.prior), F.col(rows) + F.lit(self.smoothing))


def fit_ordered_target_encoder(
    train: DataFrame, features: Sequence[str], target: str, key: str, seed: int = 0, smoothing: float = 1.0,
    prior: float | None = None, suffix: str = "_ots",
) -> OrderedTargetModel:
    """Ordered mean target of all features together; ``prior`` is the mean target unless it is given."""
    features = list(features)
    if not features:
        raise ValueError("feature list must not be empty")
    if smoothing < 0:
        raise ValueError("smoothing must not be negative")
    require_columns(train, [*features, key])
    require_numeric(train, [target])
    y = F.col(target).cast("double")
    if prior is None:
        prior = number_or_none(train.agg(F.avg(y)).first()[0])
    long = long_keys(train, features, [y.alias("__y")]).filter(F.col(KEY).isNotNull())
    sums = long.groupBy(FEATURE, KEY).agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("__y"), F.lit(0.0)).alias("s"), F.count("__y").alias("n"))
    lookup = fit_features(sums, train, features, ["s", "n"], rows="rows")
    return OrderedTargetModel(lookup, target, key, seed, float(smoothing), 0.0 if prior is None else float(prior), suffix)

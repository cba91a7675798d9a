"""The feature workflow: clean, build features over all rows, encode by target."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.frame import is_numeric, materialise, require_columns
from foldwise.functions.scalar import clip_numerical_features, map_values, replace_above, strip_prefix
from foldwise.operators.aggregate import create_aggregation_features
from foldwise.operators.cross import create_nway_interaction_features
from foldwise.operators.encode import fit_ordinal
from foldwise.operators.encode_stats import apply_target_encoding
from foldwise.operators.impute import fit_imputer
from foldwise.operators.sample import SPLIT, take_split, union_splits
from foldwise.operators.schema_ops import add_missing_target, coerce_schema, drop_null_target, require_target


@dataclass(frozen=True)
class FeaturePlan:
    """What to do with which columns; every step is optional."""

    row_id: str
    target: str
    numeric: Sequence[str] = ()
    categorical: Sequence[str] = ()
    bounds: Mapping[str, tuple[float | None, float | None]] = field(default_factory=dict)
    replace: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    maps: Mapping[str, Mapping] = field(default_factory=dict)
    prefixes: Mapping[str, str] = field(default_factory=dict)
    ordinal: Sequence[str] = ()
    median_fill: Sequence[str] = ()
    powers: Sequence[str] = ()
    groups: Sequence[Mapping] = ()
    nway_features: Sequence[str] = ()
    nway_orders: Sequence[int] = ()
    fit_on: str = "combined"   # statistics from all rows, or from the training rows
    smoothing: float = 10.0
    encode_targets: bool = True


def clean(df: DataFrame, plan: FeaturePlan) -> DataFrame:
    """The projections that need no statistics."""
    df = clip_numerical_features(df, plan.bounds)
    changed = {c: replace_above(F.col(c), t, v) for c, (t, v) in plan.replace.items()}
    changed.update({c: map_values(F.col(c), m) for c, m in plan.maps.items()})
    changed.update({c: strip_prefix(F.col(c), p) for c, p in plan.prefixes.items()})
    return df.withColumns(changed) if changed else df


def _fit_rows(df: DataFrame, plan: FeaturePlan) -> DataFrame:
    return df if plan.fit_on == "combined" else df.filter(F.col(SPLIT) == "train")


def engineer(df: DataFrame, plan: FeaturePlan) -> DataFrame:
    """Codes, fills, powers, group means and joined categories over the stacked rows."""
    if plan.ordinal:
        df = fit_ordinal(_fit_rows(df, plan), plan.ordinal, "use_encoded_value", -1, add_one=True).transform(df)
    if plan.median_fill:
        df = fit_imputer(_fit_rows(df, plan), "median", plan.median_fill).transform(df)
    powers = {}
    for c in plan.powers:
        x = F.col(c).cast("double")
        powers.update({f"{c}_sqrt": F.sqrt(x), f"{c}_squared": x * x})
    if powers:
        df = df.withColumns(powers)
    if plan.groups:
        df = create_aggregation_features(df, plan.groups, target=plan.target)
    if plan.nway_features:
        df = create_nway_interaction_features(
            df, plan.nway_features, plan.nway_orders, encode_type="label", add_one=True,
            keep=df.columns, row_id=plan.row_id, target=plan.target)
    ids = [plan.row_id, plan.target]
    numeric = [c for c in df.columns if c not in ids and is_numeric(df, c)]
    return df.select(*[F.col(c).cast("float").alias(c) if c in numeric else F.col(c) for c in df.columns])


def build_features(
    train: DataFrame, test: DataFrame, plan: FeaturePlan, fold: str, external: DataFrame | None = None
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Training and test frames ready for a learner, and the names of the features.

    The fold column is carried from start to end, so encoding and training use
    the same folds. Rows are told apart by a split column, never by position.
    """
    if plan.fit_on not in ("combined", "train"):
        raise ValueError("fit_on must be 'combined' or 'train'")
    require_columns(train, [plan.row_id, plan.target, fold], "train")
    frames = {"train": train, "test": add_missing_target(test, plan.target)}
    if external is not None:
        frames["external"] = external
    frames = {n: coerce_schema(f, [*plan.numeric, plan.target], plan.categorical) for n, f in frames.items()}
    stacked = union_splits(frames)
    require_target(stacked.filter(F.col(SPLIT) == "train"), plan.target)
    # written once: encoding and training read these rows many times
    ready = materialise(engineer(clean(stacked, plan), plan))
    fixed = [plan.row_id, plan.target, fold, SPLIT]
    features = [c for c in ready.columns if c not in fixed]
    train_rows = take_split(ready, "train").withColumn(fold, F.col(fold).cast("int"))
    test_rows = take_split(ready, "test").drop(plan.target, fold)
    if plan.encode_targets:
        train_rows, test_rows = apply_target_encoding(
            train_rows, features, plan.target, fold, test_rows, smoothing=plan.smoothing, row_id=plan.row_id)
        features = features + [f"{f}_te" for f in features]
    return drop_null_target(train_rows, plan.target), test_rows, features


__all__ = ["FeaturePlan", "build_features", "clean", "engineer"]

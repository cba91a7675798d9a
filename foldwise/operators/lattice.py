"""Target means and counts of hundreds of crossed columns from one scan.

The rows are added up once by all base columns and the fold. Every crossing is a function of the
base columns, so its sums follow from that table, however many crossings there are; the rows
themselves are read once to fit and passed over once to attach.

Where the fitted tables are small, a row's place in the table of a crossing follows from the numbers of its
base values, by a table over all their combinations; texts are joined once per combination, not per row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.frame import materialise, refuse_target, require_columns, require_numeric
from foldwise.operators import lookup as lookups
from foldwise.operators.cross import create_nway_interaction_features, nway_names
from foldwise.operators.encode_stats import TargetModel, _mean_parts, _target_model, observed_folds
from foldwise.operators.lookup import FEATURE, KEY, FeatureLookup, attach_features, fit_features, long_keys


#: combinations of base values that the table of one crossing, and of all, may have; other crossings join texts per row
CROSS_CELLS, ALL_CELLS = 1 << 16, 1 << 22


class _Places:
    """Places of rows in the tables of all crossings; what is known of base values grows with the batches of a task."""

    def __init__(self, crossings: Sequence[tuple[int, ...]], keys: Sequence[pa.Array], sep: str):
        self.crossings, self.keys, self.sep = crossings, keys, sep
        self.known = [pa.array([], pa.string())] * (1 + max(i for own in crossings for i in own))
        self.tables: dict[int, np.ndarray] = {}

    def _at(self, i: int, columns: Sequence[pa.Array]) -> np.ndarray:
        text = pc.binary_join_element_wise(*columns, self.sep)
        return pc.fill_null(pc.index_in(text, value_set=self.keys[i]), -1).to_numpy(zero_copy_only=False)

    def of(self, base: Sequence[pa.Array]) -> Iterator[np.ndarray]:
        """For each crossing the place of each row, -1 where the combination is unknown."""
        grown = [pc.unique(b).filter(pc.invert(pc.is_in(pc.unique(b), value_set=k))) for b, k in zip(base, self.known)]
        if any(map(len, grown)):
            self.known, self.tables, total = [pa.concat_arrays([k, g]) for k, g in zip(self.known, grown)], {}, 0
            for i, own in enumerate(self.crossings):
                sizes = [len(self.known[b]) for b in own]
                cells = int(np.prod(sizes, dtype=float))
                if cells <= CROSS_CELLS and total + cells <= ALL_CELLS:
                    total += cells
                    self.tables[i] = self._at(i, [self.known[b].take(pa.array(n)) for b, n in zip(own, np.unravel_index(np.arange(cells), sizes))])
        numbers = [pc.index_in(b, value_set=k).to_numpy(zero_copy_only=False).astype(np.int32) for b, k in zip(base, self.known)]
        for i, own in enumerate(self.crossings):
            if i not in self.tables:
                yield self._at(i, [base[b] for b in own])
                continue
            cell = numbers[own[0]]
            for b in own[1:]:
                cell = cell * np.int32(len(self.known[b])) + numbers[b]
            yield self.tables[i][cell]


@dataclass(frozen=True)
class CrossedModel:
    """Out-of-fold means and counts of the combinations of columns."""

    means: TargetModel
    counts: FeatureLookup
    columns: list[str]
    n_ways: list[int]
    sep: str
    keep_text: bool
    row_id: str | None = None

    def _crossed(self, df: DataFrame) -> DataFrame:
        taken = set(nway_names(self.columns, self.n_ways, self.sep))
        return create_nway_interaction_features(df, self.columns, self.n_ways, self.sep, keep=[c for c in df.columns if c not in taken])

    def _counted(self, encoded: DataFrame, kept: list[str]) -> DataFrame:
        names = self.means.lookup.features
        found = attach_features(encoded, self.counts, {n: [f"{n}_count"] for n in names}, self.row_id)
        texts = names if self.keep_text else []
        return found.select(*[F.col(f"`{c}`") for c in [*kept, *texts]], *[F.col(f"`{n}{self.means.suffix}`") for n in names],
                            *[F.coalesce(F.col(f"`{n}_count`"), F.lit(0)).cast("bigint").alias(f"{n}_count") for n in names])

    def _small(self) -> bool:
        """Whether the tables of means and counts are to be looked up in passes over batches."""
        return all(len(found.features) > lookups.JOIN_BLOCK and sum(b for _, _, b in found.sizes.values()) <= lookups.BROADCAST_BYTES
                   for found in (self.means.lookup, self.counts))

    def _passed(self, df: DataFrame, found: FeatureLookup, payload: str, suffix: str, kind: str, value: Callable, fold: Column | None = None):
        """The rows with a column per crossing; ``value`` turns a table and the places of rows (and of their folds) into its values."""
        crossings = nway_names(self.columns, self.n_ways, self.sep)
        names, width = list(crossings), len(df.columns)
        numbered = {f: i for i, f in enumerate(found.features)}
        rows = found.table.filter(F.col(KEY).isNotNull()).select(FEATURE, KEY, payload).toArrow()
        own = [rows.filter(pc.equal(rows.column(FEATURE), numbered[n])).combine_chunks() for n in names]
        keys = [t.column(KEY).combine_chunks().cast(pa.string()) for t in own]
        sent = df.sparkSession.sparkContext.broadcast((keys, [t.column(payload).combine_chunks() for t in own]))
        combos, sep = [tuple(self.columns.index(c) for c in crossings[n]) for n in names], self.sep
        texts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("null_str")).alias(f"__base{i}") for i, c in enumerate(self.columns)]
        given = df.select(*[F.col(f"`{c}`") for c in df.columns], *texts, (F.lit(0) if fold is None else fold).cast("int").alias("__place"))
        schema = T.StructType([*df.schema.fields, *[T.StructField(f"{n}{suffix}", T.DoubleType() if kind == "double" else T.LongType()) for n in names]])

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys, payloads = sent.value
            places, tables = _Places(combos, keys, sep), [value(p) for p in payloads]
            for batch in batches:
                if not batch.num_rows:
                    continue
                at_fold = pc.fill_null(batch.column(batch.num_columns - 1), -1).to_numpy(zero_copy_only=False)
                base = [c.cast(pa.string()) for c in batch.columns[width:-1]]
                out = [pa.array(table[at, at_fold], mask=at_fold < 0) for table, at in zip(tables, places.of(base))]
                yield pa.RecordBatch.from_arrays([*batch.columns[:width], *out], schema.names)

        return given.mapInArrow(run, schema)

    def _encoded(self, df: DataFrame, payload: str, priors: Sequence[float], fold: Column | None) -> DataFrame:
        """Means and counts by two passes over batches. The last row of a table stands for unknown combinations, the last column for no fold."""
        taken, width = set(nway_names(self.columns, self.n_ways, self.sep)), len(priors)
        kept = [c for c in df.columns if c not in taken]

        def means(found: pa.Array) -> np.ndarray:
            flat = found.flatten() if pa.types.is_list(found.type) else found
            table = np.full((len(found) + 1, width + 1), np.nan)
            table[:-1, :-1] = flat.to_numpy(zero_copy_only=False).astype(float).reshape(len(found), width)
            # a null mean is the prior; the means themselves are no NaN unless the target is
            missing = np.ones((len(found) + 1, width), bool)
            missing[:-1] = flat.is_null().to_numpy(zero_copy_only=False).reshape(len(found), width)
            table[:, :-1] = np.where(missing, np.array(priors, float), table[:, :-1])
            return table

        def counts(found: pa.Array) -> np.ndarray:
            return np.append(found.to_numpy(zero_copy_only=False), 0).astype(np.int64)[:, None]

        out = self._passed(df.select(*[F.col(f"`{c}`") for c in kept]), self.means.lookup, payload, self.means.suffix, "double", means, fold)
        out = self._passed(out, self.counts, "count", "_count", "bigint", counts)
        if not self.keep_text:
            return out
        texts = create_nway_interaction_features(out, self.columns, self.n_ways, self.sep, keep=out.columns)
        names = self.means.lookup.features
        return texts.select(*[F.col(f"`{c}`") for c in [*kept, *names, *[f"{n}{self.means.suffix}" for n in names], *[f"{n}_count" for n in names]]])

    def transform_train(self, df: DataFrame) -> DataFrame:
        """Each row gets the means computed without its own fold, and the counts of all training rows."""
        if self._small():
            place = F.lit(None).cast("int")
            for i, fold in enumerate(self.means.folds):
                place = F.when(F.col(self.means.fold_col) == fold, i).otherwise(place)
            return self._encoded(df, "oof", self.means.fold_priors, place)
        wide = self._crossed(df)
        return self._counted(self.means.transform_train(wide), [c for c in wide.columns if c not in self.means.lookup.features])

    def transform(self, df: DataFrame) -> DataFrame:
        """Rows outside the training data get the means of all of it; unknown combinations the prior and a count of 0."""
        if self._small():
            return self._encoded(df, "whole", [self.means.global_prior], F.lit(0))
        wide = self._crossed(df)
        return self._counted(self.means.transform(wide), [c for c in wide.columns if c not in self.means.lookup.features])


def fit_crossed_encoder(
    train: DataFrame, columns: Sequence[str], n_ways: Sequence[int], target: str, fold_col: str, smoothing: float = 10.0,
    use_smoothing: bool = True, prior: str = "fold", folds: Sequence[int] | None = None, sep: str = "_", suffix: str = "_te",
    keep_text: bool = False, row_id: str | None = None,
) -> CrossedModel:
    """Fit target means and counts of every ``n``-combination of the columns together.

    A combination is the text that ``create_nway_interaction_features`` makes, where null is 'null_str'. The
    values are those of encoding each crossed column on its own.
    """
    columns, n_ways = list(columns), list(n_ways)
    refuse_target(columns, target)
    require_columns(train, [*columns, fold_col])
    require_numeric(train, [target])
    folds = list(folds) if folds is not None else observed_folds(train, fold_col)
    y = F.col(target).cast("double")
    base = materialise(train.select(*columns, F.col(fold_col).alias("__fold"), y.alias("__y")).groupBy(*columns, "__fold").agg(
        F.sum("__y").alias("__s"), F.count("__y").alias("__n"), F.count(F.lit(1)).alias("__rows")))
    wide = create_nway_interaction_features(base, columns, n_ways, sep, keep=["__fold", "__s", "__n", "__rows"])
    names = list(nway_names(columns, n_ways, sep))
    long = long_keys(wide, names, [F.col(c) for c in ("__fold", "__s", "__n", "__rows")])
    sums = [F.sum("__rows").alias("rows")]
    for i, fold in enumerate(folds):
        mine = F.col("__fold") == fold
        sums += [F.sum(F.when(mine, F.col("__s"))).alias(f"s{i}"), F.coalesce(F.sum(F.when(mine, F.col("__n"))), F.lit(0)).alias(f"n{i}")]
    sums += [F.sum("__s").alias("s"), F.sum("__n").alias("n")]
    statistics = long.groupBy(FEATURE, KEY).agg(*sums).withColumn("count", F.col("rows"))
    parts = [x for i in range(len(folds)) for x in (f"s{i}", f"n{i}")]
    fitted = fit_features(statistics, wide, names, [*parts, "s", "n", "count"], rows="rows")
    amount = float(smoothing) if use_smoothing else None
    means = _target_model(fitted, names, folds, *_mean_parts(fitted, len(folds)), amount, prior, fold_col, suffix, row_id)
    counts = FeatureLookup(fitted.table.select(FEATURE, KEY, "count", "__covered"), names, fitted.types, ["count"], fitted.sizes)
    return CrossedModel(means, counts, columns, n_ways, sep, keep_text, row_id)

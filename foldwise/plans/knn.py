"""Exact nearest neighbours over cells around pivots.

Points and queries are filed under the nearest of at most ``MAX_CELLS`` pivots, drawn
from the points. A cell's radius is the greatest distance to its pivot, so the
distance of two pivots, less and plus both radii, bounds every distance between two cells.
Taking cells by their upper bounds until they hold k points gives a distance within which every
query of a cell finds its neighbours; cells that lie farther away are not read. The
result does not depend on the pivots. In many dimensions little can be ruled out, and the work
then grows with queries x points.

Cells of queries that read about the same cells are read for together, up to a block of queries. A task sees one
block of queries and a group of point cells of about a block, which is a ``GRID``-th of the rows (at least ``BLOCK_ROWS``, at most
``MAX_BLOCK_ROWS``), and keeps the k best points per query; pairs of rows are never materialised. So every row is
sent about ``GRID`` times, whatever their number, until blocks have their greatest size.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.frame import materialise, require_columns

BLOCK_ROWS = 2048
MAX_BLOCK_ROWS = 131_072
#: blocks that the rows are cut into, so the square of it tasks, while blocks are within their bounds
GRID = 12
#: reading for cells of queries together may compare this much more than reading for each
EXTRA_WORK = 1.25
QUERY_ROWS = 512
#: distances held at once
DISTANCES = 1 << 22
#: pivots, so at most the square of it pairs of cells on the driver
MAX_CELLS = 1024
#: points per cell that are aimed at
CELL_ROWS = 1024
#: more than the rounding error of a distance
SLACK = 1e-9


def _vector(df: DataFrame, features: Sequence[str]) -> Column:
    if len(features) == 1 and isinstance(df.schema[features[0]].dataType, T.ArrayType):
        if df.schema[features[0]].dataType.elementType == T.FloatType():
            return F.col(features[0])  # half the bytes, the same numbers
        return F.col(features[0]).cast("array<double>")
    return F.array(*[F.col(f).cast("double") for f in features])


def _best_in_block(k: int):
    def best(queries: pd.DataFrame, points: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or points.empty:
            return pd.DataFrame({"query_id": [], "point_id": [], "label": [], "distance": []})
        points = points.sort_values("point_id")
        x = np.stack(points["vector"].to_numpy()).astype(float)
        ids, labels = points["point_id"].to_numpy(), points["label"].to_numpy(dtype=float)
        norms = (x * x).sum(axis=1)
        names, out = queries["query_id"].to_numpy(), []
        step = max(1, min(QUERY_ROWS, DISTANCES // len(ids)))
        for at in range(0, len(queries), step):
            v = np.stack(queries["vector"].iloc[at: at + step].to_numpy()).astype(float)
            rough = norms[None, :] - 2.0 * (v @ x.T)
            limit = np.full(len(v), np.inf)
            if k < len(ids):
                limit = np.partition(rough, k - 1, axis=1)[:, k - 1]
                limit = limit + 1e-9 * (np.abs(limit) + (v * v).sum(axis=1) + norms.max() + 1.0)
            # the few candidates, in the order of query, exact distance and point
            q, p = np.nonzero(rough <= limit[:, None])
            exact = np.sqrt(((x[p] - v[q]) ** 2).sum(axis=1))
            order = np.lexsort((p, exact, q))
            q, p, exact = q[order], p[order], exact[order]
            first = np.searchsorted(q, np.arange(len(v)))
            kept = np.arange(len(q)) - first[q] < k
            out.append(pd.DataFrame({
                "query_id": names[at: at + step][q[kept]], "point_id": ids[p[kept]], "label": labels[p[kept]],
                "distance": exact[kept]}))
        return pd.concat(out)
    return best


def _filed(df: DataFrame, centres: np.ndarray) -> DataFrame:
    """The rows with the nearest pivot (``cell``) and the distance to it (``gap``)."""
    schema = T.StructType([*df.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("gap", T.DoubleType())])
    at, norms = df.columns.index("vector"), (centres * centres).sum(axis=1)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(at).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, centres.shape[1])
            cell = np.concatenate([(norms - 2.0 * (x[i:i + QUERY_ROWS] @ centres.T)).argmin(axis=1) for i in range(0, len(x), QUERY_ROWS)]
                                  ) if len(x) else np.zeros(0, np.int64)
            gap = np.sqrt(((x - centres[cell]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32()), pa.array(gap)], schema.names)

    return df.mapInArrow(run, schema)


def _cell_facts(filed: DataFrame) -> dict[int, tuple[int, float]]:
    """Rows and radius of each cell; one row per pivot."""
    return {r["cell"]: (r["n"], r["r"]) for r in filed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("gap").alias("r")).collect()}


@dataclass(frozen=True)
class CellPlan:
    """Which cells of points each cell of queries reads, in groups of about a block."""

    queries: list[tuple[int, int, int, int]]     # query cell, the set it is in, blocks of the set, groups of points
    pairs: list[tuple[int, int, int, int, int]]  # point cell, set of query cells, its first group, its groups, blocks of the set
    compared: int                                # pairs of a query and a point that meet


def _together(
    centres: np.ndarray, queries: dict[int, tuple[int, float]], near: dict[int, np.ndarray], rows: np.ndarray, block_rows: int,
) -> list[tuple[list[int], int, np.ndarray]]:
    """Sets of query cells, their queries and the cells they read: from cell to nearest cell, while that adds little work."""
    left, out, cell = np.array(sorted(queries)), [], None
    while len(left):
        at = 0 if cell is None else int(((centres[left] - centres[cell]) ** 2).sum(axis=1).argmin())
        cell, left = int(left[at]), np.delete(left, at)
        n, read = queries[cell][0], near[cell]
        own = n * int(rows[read].sum())
        if out:
            both, total, alone = out[-1][2] | read, out[-1][1] + n, out[-1][3] + own
            if total <= block_rows and total * int(rows[both].sum()) <= EXTRA_WORK * alone:
                out[-1] = (out[-1][0] + [cell], total, both, alone)
                continue
        out.append(([cell], n, read, own))
    return [(together, n, read) for together, n, read, _ in out]


def plan_cells(
    centres: np.ndarray, points: dict[int, tuple[int, float]], queries: dict[int, tuple[int, float]], k: int, block_rows: int,
) -> CellPlan:
    """Cells that may hold one of the ``k`` nearest points of some query of a cell; ties at the bound are read."""
    cells = np.array(sorted(points))
    rows = np.array([points[c][0] for c in cells])
    radius = np.array([points[c][1] for c in cells])
    near = {}
    for qc, (n, r) in sorted(queries.items()):
        between = np.sqrt(((centres[cells] - centres[qc]) ** 2).sum(axis=1))
        scale = SLACK * (1.0 + between.max() + radius.max() + r)
        high, low = between + radius + r + scale, between - radius - r - scale
        order = np.argsort(high, kind="stable")
        enough = min(int(np.searchsorted(np.cumsum(rows[order]), k)), len(order) - 1)
        near[qc] = low <= high[order[enough]]
    asked, pairs, compared = [], [], 0
    for number, (together, n, read) in enumerate(_together(centres, queries, near, rows, block_rows)):
        blocks, group, held = max(1, math.ceil(n / block_rows)), 0, 0
        for i in np.flatnonzero(read).tolist():
            size, parts = int(rows[i]), max(1, math.ceil(int(rows[i]) / block_rows))
            if held and held + size > block_rows:
                group, held = group + 1, 0
            pairs.append((int(cells[i]), number, group, parts, blocks))
            compared += n * size
            held += size
            if parts > 1:
                group, held = group + parts, 0
        asked += [(qc, number, blocks, group + 1) for qc in together]
    return CellPlan(asked, pairs, compared)


@dataclass(frozen=True)
class ProjectionIndex:
    """Random projections for large point sets: wider buckets and more tables find more, at more work."""

    bucket_length: float
    tables: int = 8
    seed: int = 0


def _from_index(points, queries, row_id, features, k, label, exclude_self, index: ProjectionIndex) -> DataFrame:
    """Neighbours among the points that share a bucket of a random projection with the query."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector

    require_columns(points, [row_id, *features, *([label] if label else [])])
    require_columns(queries, [row_id, *features])
    p = points.select(F.col(row_id).alias("point_id"), array_to_vector(_vector(points, features).cast("array<double>")).alias("v"))
    q = queries.select(F.col(row_id).alias("query_id"), array_to_vector(_vector(queries, features).cast("array<double>")).alias("v"))
    model = BucketedRandomProjectionLSH(
        inputCol="v", outputCol="buckets", bucketLength=index.bucket_length, numHashTables=index.tables, seed=index.seed).fit(p)
    met = model.approxSimilarityJoin(q, p, float("inf"), "distance").select(
        F.col("datasetA.query_id"), F.col("datasetB.point_id"), "distance")
    if exclude_self:
        met = met.filter(F.col("query_id") != F.col("point_id"))
    best = Window.partitionBy("query_id").orderBy("distance", "point_id")
    near = met.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    value = F.col(label).cast("double") if label else F.lit(None).cast("double")
    labels = points.select(F.col(row_id).alias("point_id"), value.alias("label"))
    return near.join(labels, "point_id").select("query_id", "rank", "point_id", "distance", "label")


def nearest_neighbours(
    points: DataFrame, queries: DataFrame, row_id: str, features: Sequence[str], k: int = 5,
    label: str | None = None, exclude_self: bool = False, block_rows: int | None = None, index: ProjectionIndex | None = None,
) -> DataFrame:
    """Rows of (query_id, rank, point_id, distance, label), nearest first, ties by point id.

    Exact; cells of points that are too far away from a cell of queries are not compared. With an ``index`` only
    points that share a bucket with a query are compared, which is approximate.
    """
    if index is not None:
        return _from_index(points, queries, row_id, features, k, label, exclude_self, index)
    if k < 1:
        raise ValueError("k must be at least 1")
    require_columns(points, [row_id, *features, *([label] if label else [])])
    require_columns(queries, [row_id, *features])
    keep = k + 1 if exclude_self else k
    value = F.col(label).cast("double") if label else F.lit(None).cast("double")
    p = points.select(F.col(row_id).alias("point_id"), value.alias("label"), _vector(points, features).alias("vector"))
    q = queries.select(F.col(row_id).alias("query_id"), _vector(queries, features).alias("vector"))
    id_type = points.schema[row_id].dataType.simpleString()
    total = p.count()
    block_rows = block_rows or max(BLOCK_ROWS, min(MAX_BLOCK_ROWS, math.ceil(total / GRID)))
    cells = max(1, min(MAX_CELLS, math.ceil(total / min(CELL_ROWS, block_rows))))
    # a bounded sample; it decides about the work, not about the result
    pivots = p.orderBy(F.xxhash64("point_id"), "point_id").limit(cells).select("vector").collect()
    schema = f"query_id {id_type}, point_id {id_type}, label double, distance double"
    if not pivots:
        return p.sparkSession.createDataFrame([], schema).selectExpr("query_id", "0 as rank", "point_id", "distance", "label")
    centres = np.array([r["vector"] for r in pivots], float)
    p, q = materialise(_filed(p, centres)), materialise(_filed(q, centres))
    plan = plan_cells(centres, _cell_facts(p), _cell_facts(q), keep, block_rows)
    spark = p.sparkSession
    # at most MAX_CELLS rows, and as many for each of them
    asked = F.broadcast(spark.createDataFrame(plan.queries, "cell int, qc int, qsubs int, groups int"))
    read = F.broadcast(spark.createDataFrame(plan.pairs, "cell int, qc int, first int, parts int, qsubs int"))

    def part(c: str, n: str) -> Column:
        return F.pmod(F.xxhash64(c), F.col(n)).cast("int")

    q = q.join(asked, "cell").select(
        "query_id", "vector", "qc", part("query_id", "qsubs").alias("qs"),
        F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("pg"))
    p = p.join(read, "cell").select(
        "point_id", "label", "vector", "qc", F.explode(F.sequence(F.lit(0), F.col("qsubs") - 1)).alias("qs"),
        (F.col("first") + part("point_id", "parts")).alias("pg"))
    found = q.groupBy("qc", "qs", "pg").cogroup(p.groupBy("qc", "qs", "pg")).applyInPandas(_best_in_block(keep), schema)
    if exclude_self:
        found = found.filter(F.col("query_id") != F.col("point_id"))
    # at most k candidates per query and group of cells
    best = Window.partitionBy("query_id").orderBy("distance", "point_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "point_id", "distance", "label")


def knn_predict(
    points: DataFrame, queries: DataFrame, row_id: str, features: Sequence[str], label: str, k: int = 5,
    n_classes: int | None = None,
) -> DataFrame:
    """Mean label of the neighbours, or the share of each class (of class 1 for two classes)."""
    near = nearest_neighbours(points, queries, row_id, features, k, label)
    if n_classes is None:
        value = F.avg("label")
    else:
        shares = [F.avg((F.col("label") == c).cast("double")) for c in range(n_classes)]
        value = shares[1] if n_classes == 2 else F.array(*shares)
    return near.groupBy(F.col("query_id").alias(row_id)).agg(value.alias("prediction"))

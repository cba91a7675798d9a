"""Exact nearest neighbours by inner product over vector-approximation files.

Every vector is approximated by the cell it falls in along each dimension, one
byte per dimension. Cells of a query block and a vector block give an upper and
a lower bound of every score by four matrix products; a vector whose upper bound
is below the k-th best lower bound of its query cannot be a result. What is left is
ordered by upper bound, and exact vectors are read in that order: first the
``k`` most promising candidates of each query, whose k-th exact score then
decides which of the others must still be read. The result is certain after
the second read, because every vector that was not read has a smaller bound.

Vectors are never paired as rows. A task holds one block of queries and lets the
cells of one group pass by; the k best lower bounds seen so far are the floor below which
cells are dropped at once, and the floor at the end thins out what was kept. There are at most
``GROUPS`` groups however many vectors there are, so the candidates of a query do not grow with the table. Only ids,
bounds and cells move, and exact vectors are joined to candidates by id.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldwise.llm.shared import materialise, require_columns

CELLS = 64
QUERY_BLOCK = 2048
VECTOR_BLOCK = 16384
GROUPS = 16
#: candidates kept by a task before the floor thins them out
HELD = 1 << 20


def integer_vectors(df: DataFrame, key: str, vector: str, scale: int = 64) -> DataFrame:
    """Rows (id, v, dims) with v = floor(scale * x); vectors with null or non-finite components are left out."""
    require_columns(df, [key, vector])
    x = F.col("x")
    whole = df.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("x")).filter(
        x.isNotNull() & F.col("id").isNotNull()
        & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))))
    return whole.select("id", F.transform(x, lambda c: F.floor(c * F.lit(scale)).cast("bigint")).alias("v"),
                        F.size("x").alias("dims"))


def _edges(vectors: DataFrame, cells: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Smallest value and cell width per dimension, by number of dimensions: two numbers per dimension."""
    rows = vectors.select("dims", F.posexplode("v").alias("d", "c")).groupBy("dims", "d").agg(
        F.min("c").alias("lo"), F.max("c").alias("hi")).orderBy("dims", "d").collect()
    out: dict[int, list] = {}
    for r in rows:
        out.setdefault(r["dims"], []).append((r["lo"], max(1, -(-(r["hi"] - r["lo"] + 1) // cells))))
    return {n: (np.array([e[0] for e in own]), np.array([e[1] for e in own])) for n, own in out.items()}


class _Group:
    """One block of queries while the cells of a group pass by."""

    def __init__(self, edges: tuple[np.ndarray, np.ndarray], dims: int, k: int):
        self.least, self.width = edges
        self.dims, self.k = dims, k
        self.ids, self.vectors = np.zeros(0, np.int64), np.zeros((0, dims))
        self.best = np.zeros((0, k))  # the k best lower bounds of each query
        self.held: list[tuple[np.ndarray, ...]] = []
        self.n_held = 0

    def ask(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids = np.concatenate([self.ids, ids])
        self.vectors = np.concatenate([self.vectors, vectors.astype(np.float64)])
        self.best = np.full((len(self.ids), self.k), -np.inf)

    def see(self, ids: np.ndarray, cells: np.ndarray) -> None:
        """Bounds of a batch of cells; those that may be results are kept."""
        low = (self.least + cells.astype(np.int64) * self.width).astype(np.float64)
        high = low + (self.width - 1)
        # float sums beyond 2^53 are off by less than this share of the sum of their terms' sizes
        size = np.maximum(np.abs(low), np.abs(high)).max(axis=0)
        for at in range(0, len(self.ids), 256):
            rows = slice(at, at + 256)
            q = self.vectors[rows]
            up, down = np.maximum(q, 0), np.minimum(q, 0)
            most = up @ high.T + down @ low.T
            least = up @ low.T + down @ high.T
            slack = (np.abs(q) @ size) * 2.0 ** -40
            slack[slack < 1] = 0  # small whole numbers are exact
            most += slack[:, None]
            least -= slack[:, None]
            own = self.ids[rows, None] == ids[None, :]
            most[own], least[own] = -np.inf, -np.inf
            seen = np.concatenate([self.best[rows], least], axis=1)
            self.best[rows] = np.partition(seen, seen.shape[1] - self.k, axis=1)[:, seen.shape[1] - self.k:]
            floor = self.best[rows].min(axis=1)
            qi, vi = np.nonzero((most >= floor[:, None]) & ~own)
            self.held.append((qi + at, ids[vi], most[qi, vi], least[qi, vi]))
            self.n_held += len(qi)
        if self.n_held > HELD:
            self.thin()

    def thin(self) -> None:
        """Drop what the floors of now rule out."""
        if self.held:
            query, vector, most, least = (np.concatenate(x) for x in zip(*self.held))
            stays = most >= self.best.min(axis=1)[query]
            self.held = [(query[stays], vector[stays], most[stays], least[stays])]
            self.n_held = int(stays.sum())

    def candidates(self) -> pa.RecordBatch:
        self.thin()
        query, vector, most, least = self.held[0] if self.held else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0))
        return pa.RecordBatch.from_arrays([
            pa.array(self.ids[query]), pa.array(vector), pa.array(most), pa.array(least)], ["query_id", "vec_id", "high", "low"])


def _stream(batches: Iterable[pa.RecordBatch], edges, k: int) -> Iterator[pa.RecordBatch]:
    """Candidates of groups of rows (dims, qb, g, kind, id, v, cell) in order of the first four: queries, then cells."""
    group, key = None, None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        marks = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)], axis=1)
        cuts = [0, *(np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1).tolist(), n]
        for a, b in zip(cuts, cuts[1:]):
            dims, kind = int(marks[a, 0]), marks[a, 3]
            if key != tuple(marks[a, :3]):
                if group is not None:
                    yield group.candidates()
                key, group = tuple(marks[a, :3]), _Group(edges[dims], dims, k)
            ids = batch.column(4).slice(a, b - a).to_numpy(zero_copy_only=False)
            if kind == 0:
                group.ask(ids, batch.column(5).slice(a, b - a).flatten().to_numpy().reshape(b - a, dims))
            else:
                cells = b"".join(batch.column(6).slice(a, b - a).to_pylist())
                group.see(ids, np.frombuffer(cells, np.uint8).reshape(b - a, dims))
    if group is not None:
        yield group.candidates()


def _top(df: DataFrame, by: list[Column], k: int) -> DataFrame:
    window = Window.partitionBy("query_id").orderBy(*by)
    return df.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)


def _exact(candidates: DataFrame, vectors: DataFrame) -> DataFrame:
    """Read the exact vectors of the candidates and of their queries: (query_id, vec_id, score)."""
    q = vectors.select(F.col("id").alias("query_id"), F.col("v").alias("q"))
    v = vectors.select(F.col("id").alias("vec_id"), "v")
    # aggregate folds over the pair's components; the scores are 64-bit sums
    score = F.aggregate(F.zip_with("q", "v", lambda a, b: a * b), F.lit(0).cast("bigint"), lambda s, x: s + x)
    return candidates.join(v, "vec_id").join(q, "query_id").select("query_id", "vec_id", score.alias("score"))


def top_k_inner_product(
    df: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding", scale: int = 64,
    cells: int = CELLS, query_block: int = QUERY_BLOCK, vector_block: int = VECTOR_BLOCK,
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the ``k`` highest inner products of each query row.

    Components become floor(scale * x). Candidates of a query are all other
    rows with as many dimensions; fewer than ``k`` give all of them. Ties go to
    the smaller id. Vectors that are null or hold a null or a non-finite
    component, and rows with a null id, take no part; rows that repeat an id
    count once (the smallest vector of that id).
    """
    if not 1 <= cells <= 256:
        raise ValueError("cells must fit one byte")
    numbers = integer_vectors(df, key, vector, scale).groupBy("id").agg(F.min("v").alias("v")).select(
        "id", "v", F.size("v").alias("dims")).filter(F.col("dims") > 0)
    vectors = materialise(numbers)
    edges = _edges(vectors, cells)
    n = vectors.count()
    asked = vectors.join(df.filter(is_query).select(F.col(key).cast("bigint").alias("id")).distinct(), "id")
    asked = materialise(asked)
    n_queries = asked.count()
    query_blocks = max(1, -(-n_queries // query_block))
    vector_blocks = max(1, -(-n // vector_block))

    least = F.create_map(*[x for d, (lo, _) in edges.items() for x in (F.lit(d), F.lit(lo.tolist()).cast("array<bigint>"))]) if edges else None
    if least is None:
        return vectors.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"),
                              F.lit(0).cast("bigint").alias("score"))
    width = F.create_map(*[x for d, (_, w) in edges.items() for x in (F.lit(d), F.lit(w.tolist()).cast("array<bigint>"))])
    place = F.zip_with(F.zip_with("v", least[F.col("dims")], lambda x, lo: x - lo), width[F.col("dims")],
                       lambda x, w: F.floor(x / w))
    cell = F.unhex(F.array_join(F.transform(place, lambda c: F.lpad(F.hex(c.cast("bigint")), 2, "0")), ""))

    def block(count: int) -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(count)).cast("int")

    groups = min(GROUPS, vector_blocks)
    every_group = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    every_block = F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))
    left = asked.select("dims", block(query_blocks).alias("qb"), every_group.alias("g"), F.lit(0).alias("kind"), "id", "v",
                        F.lit(None).cast("binary").alias("cell"))
    right = vectors.select("dims", every_block.alias("qb"), block(groups).alias("g"), F.lit(1).alias("kind"), "id",
                           F.lit(None).cast("array<bigint>").alias("v"), cell.alias("cell"))
    ordered = left.unionByName(right).repartition("dims", "qb", "g").sortWithinPartitions("dims", "qb", "g", "kind")
    bounded = ordered.mapInArrow(lambda batches: _stream(batches, edges, k), "query_id bigint, vec_id bigint, high double, low double")
    candidates = materialise(bounded)
    floors = _top(candidates.select("query_id", "vec_id", "low"), [F.desc("low"), F.asc("vec_id")], k).groupBy(
        "query_id").agg(F.min("low").alias("floor"), F.count(F.lit(1)).alias("n"))
    left_over = materialise(candidates.join(floors, "query_id").filter(
        (F.col("n") < k) | (F.col("high") >= F.col("floor"))).select("query_id", "vec_id", "high"))
    promising = _top(left_over, [F.desc("high"), F.asc("vec_id")], k).select("query_id", "vec_id")
    read = materialise(_exact(promising, vectors))
    certain = read.groupBy("query_id").agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("n"))
    rest = left_over.join(promising, ["query_id", "vec_id"], "left_anti").join(certain, "query_id").filter(
        F.col("high") >= F.col("floor")).select("query_id", "vec_id")
    scored = read.unionByName(_exact(rest, vectors))
    return _top(scored, [F.desc("score"), F.asc("vec_id")], k).select("query_id", "rank", "vec_id", "score")


"""Vector codes: each part of a vector is replaced by the number of its nearest codebook entry.

The entries of a part are kept in a geometric near-neighbour access tree. A node
holds a few split points and files every other entry under the nearest one; for each pair
of split point and child it stores the range of distances from the one to the
entries of the other. The distances from a query to the split points then rule
out whole children: by the triangle inequality every entry of a child is farther
away than the best one so far when the query's distance to a split point lies
outside the child's range by more than that. Distances are rounded outward and the test is strict, so an
entry as near as the best one is never lost; what is left is compared by whole
squared distances, ties going to the smaller number.

Tasks search a batch at once: a node is visited with the queries that it was not ruled
out for. Training rounds send one sum per entry and task, and only codebooks
(entries x dimensions whole numbers) reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.llm.shared import append_columns, require_columns
from foldwise.operators.lookup import attach, fit_lookup

LEAF = 6
SPLITS = 6
#: components beyond this size could overflow squared distances of 64 bits
LARGEST = 1 << 28
#: more than the rounding error of a square root, a sum and a difference of distances
SLACK = 2.0 ** -45


def _squared(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact squared distances, queries x points."""
    out = np.zeros((len(queries), len(points)), np.int64)
    for d in range(queries.shape[1]):
        gap = queries[:, d, None] - points[None, :, d]
        out += gap * gap
    return out


@dataclass
class Node:
    """Split points with the children filed under them, or a leaf of entries."""

    entries: np.ndarray
    points: np.ndarray
    children: list["Node | None"] = field(default_factory=list)
    low: np.ndarray | None = None   # split point x child: no entry of the child is nearer to the split point
    high: np.ndarray | None = None  # ... or farther


def build_tree(points: np.ndarray, entries: np.ndarray | None = None) -> Node:
    """The tree over a codebook; entries that equal a split point lie at distance zero under it."""
    entries = np.arange(len(points)) if entries is None else entries
    own = points[entries]
    if len(entries) <= LEAF:
        return Node(entries, own)
    # split points far from each other: each is the entry farthest from those chosen
    chosen, nearest = [0], _squared(own, own[:1])[:, 0]
    while len(chosen) < SPLITS and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, _squared(own, own[chosen[-1:]])[:, 0])
    if len(chosen) == 1:
        return Node(entries, own)  # all entries are equal
    gaps = _squared(own, own[chosen])
    home = gaps.argmin(axis=1)
    filed = np.ones(len(entries), bool)
    filed[chosen] = False
    node = Node(entries[chosen], own[chosen])
    node.low = np.full((len(chosen), len(chosen)), np.inf)
    node.high = np.full((len(chosen), len(chosen)), -np.inf)
    far = np.sqrt(gaps.astype(np.float64))
    for child in range(len(chosen)):
        members = np.flatnonzero(filed & (home == child))
        node.children.append(build_tree(points, entries[members]) if len(members) else None)
        if len(members):
            node.low[:, child] = far[members].min(axis=0) * (1 - SLACK)
            node.high[:, child] = far[members].max(axis=0) * (1 + SLACK)
    return node


@dataclass
class Search:
    """Nearest entries of many queries; ``compared`` counts exact distances."""

    queries: np.ndarray
    best: np.ndarray = None
    entry: np.ndarray = None
    compared: int = 0

    def __post_init__(self):
        self.best = np.full(len(self.queries), np.iinfo(np.int64).max)
        self.entry = np.full(len(self.queries), np.iinfo(np.int64).max)

    def visit(self, node: Node, rows: np.ndarray) -> None:
        gaps = _squared(self.queries[rows], node.points)
        self.compared += gaps.size
        # of equal distances the smallest entry number
        near = gaps.min(axis=1)
        number = np.where(gaps == near[:, None], node.entries[None, :], np.iinfo(np.int64).max).min(axis=1)
        better = (near < self.best[rows]) | ((near == self.best[rows]) & (number < self.entry[rows]))
        self.best[rows[better]], self.entry[rows[better]] = near[better], number[better]
        if not node.children:
            return
        far = np.sqrt(gaps.astype(np.float64))
        least, most = far * (1 - SLACK), far * (1 + SLACK)
        # the nearest child first: a small best distance rules out more of the others
        for child in np.argsort(-np.bincount(gaps.argmin(axis=1), minlength=len(node.children)), kind="stable"):
            if node.children[child] is None:
                continue
            reach = np.sqrt(self.best[rows].astype(np.float64))[:, None] * (1 + SLACK)
            out = (node.low[:, child] * (1 - SLACK) > (most + reach) * (1 + SLACK)) | (
                least * (1 - SLACK) > (node.high[:, child] + reach) * (1 + SLACK))
            left = rows[~out.any(axis=1)]
            if len(left):
                self.visit(node.children[child], left)


def nearest_entries(tree: Node, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry number, squared distance) of each query; ties go to the smaller number."""
    search = Search(queries)
    if len(queries):
        search.visit(tree, np.arange(len(queries)))
    return search.entry, search.best


@dataclass(frozen=True)
class Codebooks:
    """Entries as whole numbers: part x entry x position within the part."""

    entries: np.ndarray
    scale: int

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def trees(self) -> list[Node]:
        return [build_tree(part) for part in self.entries]


def usable_vectors(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is there and has finite components only."""
    x = F.col(f"`{vector}`").cast("array<double>")
    return df.filter(x.isNotNull() & F.coalesce(F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))), F.lit(False)))


def _whole(column: pa.Array, dims: int, scale: int) -> np.ndarray:
    """Components as floor(scale * x), rows x dims."""
    sizes = set(np.diff(column.offsets.to_numpy()).tolist()) if len(column) else set()
    if sizes - {dims}:
        raise ValueError(f"vectors of {sorted(sizes)} dimensions, but the codebooks are for {dims}")
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    values = np.floor(values * scale)
    if len(values) and np.abs(values).max() > LARGEST:
        raise ValueError(f"scaled components beyond {LARGEST} do not fit exact 64-bit distances")
    return values.astype(np.int64).reshape(len(column), dims)


def _first_entries(df: DataFrame, key: str, vector: str, entries: int, parts: int, scale: int) -> np.ndarray:
    """The parts of the vectors with the smallest ids (null ids last, rows of one id by their vectors)."""
    rows = df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{vector}`").cast("array<double>").alias("v")).orderBy(
        F.asc_nulls_last("k"), "v").limit(entries).collect()
    dims = {len(r["v"]) for r in rows}
    if len(dims) > 1 or any(d % parts for d in dims):
        raise ValueError(f"vectors must have one dimension that {parts} divides, not {sorted(dims)}")
    if not rows:
        return np.zeros((parts, 0, 0), np.int64)
    width = dims.pop() // parts
    whole = _whole(pa.array([r["v"] for r in rows], pa.list_(pa.float64())), width * parts, scale)
    return whole.reshape(len(rows), parts, width).transpose(1, 0, 2).copy()


def _sums(df: DataFrame, vector: str, books: Codebooks) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """(part, entry) -> number of vectors and sum of their parts; each task adds up its own first."""
    n_parts, n_entries, width = books.entries.shape

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = books.trees()
        counts = np.zeros((n_parts, n_entries), np.int64)
        sums = np.zeros((n_parts, n_entries, width), np.int64)
        for batch in batches:
            whole = _whole(batch.column(0), n_parts * width, books.scale).reshape(batch.num_rows, n_parts, width)
            for p, tree in enumerate(trees):
                own = np.ascontiguousarray(whole[:, p])
                entry, _ = nearest_entries(tree, own)
                counts[p] += np.bincount(entry, minlength=n_entries)
                np.add.at(sums[p], entry, own)
        p, e = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([
            pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(counts[p, e], pa.int64()),
            pa.array(sums[p, e].tolist(), pa.list_(pa.int64()))], ["part", "entry", "n", "total"])

    partial = df.select(F.col(f"`{vector}`").cast("array<double>")).mapInArrow(run, "part int, entry int, n bigint, total array<bigint>")
    totals = [F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"t{i}") for i in range(width)]
    # parts x entries rows, whatever the table's size
    rows = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *totals).collect()
    return {(r["part"], r["entry"]): (r["n"], [int(r[f"t{i}"]) for i in range(width)]) for r in rows}


def fit_codebooks(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256,
) -> Codebooks:
    """Codebooks from all vectors: components become floor(scale * x), vectors are cut into equal parts.

    The entries start as the parts of the vectors with the smallest ids; each round gives every
    part to its nearest entry and replaces an entry by the floor of its parts' mean. Entries that got none
    stay. Fewer vectors than ``entries`` give fewer entries. Vectors that are null or hold a null
    or non-finite component are left out; vectors of several dimensions are an error.
    """
    require_columns(df, [key, vector])
    if not 1 <= entries <= 256:
        raise ValueError("a code must fit one byte")
    usable = usable_vectors(df, vector)
    books = Codebooks(_first_entries(usable, key, vector, entries, parts, scale), scale)
    for _ in range(rounds if books.entries.size else 0):
        moved = books.entries.copy()
        for (p, e), (n, total) in _sums(usable, vector, books).items():
            moved[p, e] = [t // n for t in total]
        books = Codebooks(moved, scale)
    return books


CODED = [T.StructField("code", T.BinaryType()), T.StructField("error", T.LongType())]


def encode_vectors(df: DataFrame, books: Codebooks, vector: str = "embedding") -> DataFrame:
    """The usable rows with ``code`` (a byte per part: the entry's number) and ``error`` (squared distances added up).

    Columns of these names are replaced.
    """
    n_parts, n_entries, width = books.entries.shape

    def compute() -> Callable[[pa.RecordBatch], list[pa.Array]]:
        trees = books.trees()

        def function(batch: pa.RecordBatch) -> list[pa.Array]:
            n = batch.num_rows
            column = batch.column(0).cast(pa.list_(pa.float64()))
            if n and not n_entries:
                raise ValueError("the codebooks hold no entries")
            whole = _whole(column, n_parts * width, books.scale).reshape(n, n_parts, width)
            codes, error = np.zeros((n, n_parts), np.uint8), np.zeros(n, np.int64)
            for p, tree in enumerate(trees):
                entry, gap = nearest_entries(tree, np.ascontiguousarray(whole[:, p]))
                codes[:, p] = entry
                error += gap
            return [pa.array([row.tobytes() for row in codes], pa.binary()), pa.array(error, pa.int64())]
        return function

    return append_columns(usable_vectors(df, vector), CODED, compute, [vector])


def decode_vectors(df: DataFrame, books: Codebooks, code: str = "code", out: str = "restored") -> DataFrame:
    """Add the vector that a code stands for, in the scale of the vectors encoded; a null code gives null."""
    n_parts = books.entries.shape[0]

    def compute():
        def function(batch: pa.RecordBatch) -> list[pa.Array]:
            found = [None if c is None else (books.entries[np.arange(n_parts), list(c)].ravel() / books.scale).tolist()
                     for c in batch.column(0).to_pylist()]
            return [pa.array(found, pa.list_(pa.float64()))]
        return function

    return append_columns(df, [T.StructField(out, T.ArrayType(T.DoubleType()))], compute, [code])


def label_errors(df: DataFrame, label: str, error: str = "error", out: str = "label_error") -> DataFrame:
    """Add the sum of the errors of all rows of the same label, nulls together."""
    sums = df.groupBy(F.col(label).alias("__label")).agg(F.sum(error).alias(out), F.count(F.lit(1)).alias("__n"))
    return attach(df.drop(out), fit_lookup(sums, ["__label"], [out], rows="__n"), [label], null_safe=True)

"""Connected components of a graph given as pairs of numbers.

Alternating star contractions: every node is linked to the smallest node it
can see, first over its larger and then over its smaller neighbours. The
number of rounds grows with the logarithm of the longest path. Each round is
written to the work folder, so the plan stays short and a lost executor costs
a re-read. Only counts and checksums reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.shared import materialise
from foldwise.operators.lookup import attach, fit_lookup


def _with_least(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The edges with the smallest b of their a, and these (a, m) alone.

    The centre of a large group is one key. Its smallest neighbour is found with partial minima and attached without gathering the
    key's edges: by a broadcast, or where the table is large by a join that spreads hot keys.
    """
    least = fit_lookup(edges.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")), ["a"], ["m"], rows="n")
    return attach(edges, least), least.table.select("a", "m")


def _large_star(edges: DataFrame) -> DataFrame:
    both, _ = _with_least(edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    return both.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.least("a", "m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges point from the larger node a to the smaller node b."""
    found, least = _with_least(edges)
    moved = found.filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"]


def connected_components(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, root) for every node in a pair; the root is the component's smallest node.

    Pairs with a null, repeated pairs and pairs of a node with itself are
    allowed and add nothing.
    """
    low, high = F.least(F.col(a), F.col(b)), F.greatest(F.col(a), F.col(b))
    edges = pairs.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(
        high.cast("bigint").alias("a"), low.cast("bigint").alias("b")).distinct()
    edges = materialise(edges)
    before = _state(edges)
    while before[0]:
        edges = materialise(_small_star(materialise(_large_star(edges).distinct())).distinct())
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())

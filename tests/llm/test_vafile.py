import math

import pytest
from pyspark.sql import functions as F

from foldwise.llm import vafile


def brute(rows, k, scale=64):
    good = {}
    for key, v in rows:
        if key is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = [math.floor(scale * x) for x in v]
        good[key] = min(good.get(key, whole), whole)
    out = []
    for q, a in good.items():
        if q % 20 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), v) for v, b in good.items() if v != q and len(a) == len(b))
            out += [(q, i, v, -s) for i, (s, v) in enumerate(scores[:k], start=1)]
    return sorted(out)


@pytest.fixture(scope="module")
def vectors(spark):
    rows = spark.range(700).select(F.col("id").alias("vec_id"), F.array(*[
        ((F.xxhash64(F.lit(i), "id") % 1000) / 900).cast("float") for i in range(12)]).alias("embedding"))
    odd = [(1000, None), (1001, [None] * 12), (1002, [float("nan")] * 12), (1003, [float("inf")] + [0.0] * 11), (1020, [1.0, 2.0]),
           (1040, [0.5, -0.5]), (1021, [3.0, 1.0]), (1060, []), (None, [1.0] * 12), (1080, [0.0] * 12), (1081, [1e6] * 12), (20, [2.0] * 12)]
    copies = rows.filter("vec_id < 40").select((F.col("vec_id") + 2000).alias("vec_id"), "embedding")
    extra = spark.createDataFrame(odd, "vec_id bigint, embedding array<float>")
    return rows.unionByName(copies).unionByName(extra).withColumns({c: F.lit("clash") for c in ("id", "v", "dims", "rank", "score")})


@pytest.mark.parametrize("k, cells, block", [(20, 64, 16384), (3, 4, 100), (900, 2, 64), (1, 256, 7)])
def test_against_all_pairs(vectors, k, cells, block):
    rows = [(r.vec_id, r.embedding) for r in vectors.select("vec_id", "embedding").collect()]
    got = vafile.top_k_inner_product(vectors, F.col("vec_id") % 20 == 0, k, cells=cells, query_block=max(20, block // 8), vector_block=block)
    assert sorted(map(tuple, got.collect())) == brute(rows, k)


def test_empty_tables(vectors):
    assert vafile.top_k_inner_product(vectors.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert vafile.top_k_inner_product(vectors, F.lit(False)).count() == 0
    with pytest.raises(ValueError):
        vafile.top_k_inner_product(vectors, F.lit(True), cells=300)


def test_candidates_do_not_grow_with_the_blocks(spark, monkeypatch):
    """What is kept per query is bounded by a constant times k, whether there is 1 block of vectors or 100."""
    rows = spark.range(4_000).select(F.col("id").alias("vec_id"), F.array(*[
        (F.xxhash64(F.lit(i), "id") % 1000 / 900).cast("float") for i in range(16)]).alias("embedding"))
    kept, materialise = [], vafile.materialise

    def counted(df):
        out = materialise(df)
        if df.columns == ["query_id", "vec_id", "high", "low"]:
            kept.append(out.count())
        return out

    monkeypatch.setattr(vafile, "materialise", counted)
    monkeypatch.setattr(vafile, "HELD", 1 << 12)
    results = [sorted(map(tuple, vafile.top_k_inner_product(rows, F.col("vec_id") % 20 == 0, 5, query_block=64, vector_block=b).collect()))
               for b in (4_000, 250, 40)]
    assert results[0] == results[1] == results[2] and len(results[0]) == 200 * 5
    # one group, 16 groups of 16 blocks, 16 groups of 100 blocks
    assert max(kept) <= 200 * 5 * 2 * vafile.GROUPS and kept[2] <= 1.05 * kept[1]

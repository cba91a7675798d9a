import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.llm import codes
from foldwise.operators import lookup


def nearest(books, part):
    gaps = [sum((a - b) ** 2 for a, b in zip(part, entry)) for entry in books]
    return gaps.index(min(gaps)), min(gaps)


def brute(rows, parts, entries, rounds, scale):
    good = [(k, label, [math.floor(scale * x) for x in v]) for k, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    width = len(good[0][2]) // parts
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for _, _, v in good]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]
    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for c in cut:
                own.setdefault(nearest(books[p], c[p])[0], []).append(c[p])
            books[p] = [[sum(x) // len(own[e]) for x in zip(*own[e])] if e in own else b for e, b in enumerate(books[p])]
    found = [[nearest(books[p], c[p]) for p in range(parts)] for c in cut]
    totals = {}
    for (_, label, _), f in zip(good, found):
        totals[label] = totals.get(label, 0) + sum(g for _, g in f)
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return digest, sorted((str(k), bytes(e for e, _ in f).hex(), sum(g for _, g in f), totals[label])
                          for (k, label, _), f in zip(good, found))


@pytest.fixture(scope="module")
def vectors(spark):
    rows = spark.range(300).select(F.col("id").alias("vec_id"), F.array(*[
        ((F.xxhash64(F.lit(i), F.col("id") % 250) % 40) / 17).cast("float") for i in range(12)]).alias("embedding"),
        F.when(F.col("id") % 3 > 0, F.lit(7)).cast("int").alias("label"))
    odd = [(900, None, 1), (901, [None] * 12, 1), (902, [float("nan")] * 12, 2), (903, [float("inf")] + [0.0] * 11, 2), (None, [0.25] * 12, None),
           (5, [1.0] * 12, 7), (5, [1.0] * 12, 7), (-4, [-1.0] * 12, 3), (904, [100.0] * 12, 3)]
    extra = spark.createDataFrame(odd, "vec_id bigint, embedding array<float>, label int")
    return rows.unionByName(extra).repartition(4).withColumns({c: F.lit("clash") for c in ("code", "error", "label_error", "k", "v", "part", "n")})


@pytest.mark.parametrize("parts, entries, rounds, scale", [(3, 64, 2, 256), (6, 20, 1, 4), (1, 256, 2, 1), (12, 9, 3, 16), (2, 1, 1, 8)])
def test_against_every_entry(vectors, parts, entries, rounds, scale):
    rows = [(r.vec_id, r.embedding, r.label) for r in vectors.select("vec_id", "embedding", "label").collect()]
    books = codes.fit_codebooks(vectors, "vec_id", "embedding", parts, entries, rounds, scale)
    got = codes.label_errors(codes.encode_vectors(vectors, books, "embedding"), "label")
    assert got.columns[:3] == ["vec_id", "embedding", "label"] and "k" in got.columns
    found = sorted((str(r.vec_id), r.code.hex(), r.error, r.label_error) for r in got.collect())
    assert (books.sha256, found) == brute(rows, parts, entries, rounds, scale)


def test_large_label_tables_give_the_same(vectors, monkeypatch):
    books = codes.fit_codebooks(vectors, parts=3, entries=16)
    coded = codes.encode_vectors(vectors, books)
    want = sorted(map(str, codes.label_errors(coded, "label").select("vec_id", "label_error").collect()))
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(lookup, "HOT_PARTS", 3)
    assert sorted(map(str, codes.label_errors(coded, "label").select("vec_id", "label_error").collect())) == want


def test_the_tree_rules_out_entries_and_keeps_ties():
    rng = np.random.default_rng(5)
    for width, spread in ((1, 3), (2, 4), (4, 60), (4, 1 << 27)):
        points = rng.integers(-spread, spread, (200, width))
        points[50:70] = points[:20]  # equal entries: the smaller number wins
        queries = np.concatenate([rng.integers(-spread, spread, (500, width)), points])
        search = codes.Search(queries)
        search.visit(codes.build_tree(points), np.arange(len(queries)))
        gaps = ((queries[:, None] - points[None]) ** 2).sum(axis=2)
        assert (search.entry == gaps.argmin(axis=1)).all() and (search.best == gaps.min(axis=1)).all()
    clusters = np.concatenate([rng.integers(0, 50, (16, 4)) + 10_000 * i for i in range(12)])
    search = codes.Search(clusters + 1)
    search.visit(codes.build_tree(clusters), np.arange(len(clusters)))
    assert search.compared < 0.35 * len(clusters) ** 2


def test_back_to_vectors(vectors):
    books = codes.fit_codebooks(vectors, parts=4, entries=256, scale=256)
    coded = codes.decode_vectors(codes.encode_vectors(vectors, books), books)
    for r in coded.filter("vec_id < 900").collect():
        whole = [math.floor(256 * x) for x in r.embedding]
        assert sum((a - 256 * b) ** 2 for a, b in zip(whole, r.restored)) == r.error


def test_empty_tables_and_wrong_vectors(spark, vectors):
    none = vectors.limit(0)
    books = codes.fit_codebooks(none)
    assert books.entries.shape == (16, 0, 0) and codes.label_errors(codes.encode_vectors(none, books), "label").count() == 0
    only_null = vectors.filter("vec_id = 900")
    assert codes.encode_vectors(only_null, codes.fit_codebooks(only_null)).count() == 0
    blank = spark.createDataFrame([(1, [], 0), (2, [], None)], "vec_id bigint, embedding array<float>, label int")
    found = codes.encode_vectors(blank, codes.fit_codebooks(blank)).collect()
    assert [(r.code, r.error) for r in found] == [(bytes(16), 0)] * 2
    mixed = spark.createDataFrame([(1, [1.0] * 16), (2, [1.0] * 32)], "vec_id bigint, embedding array<float>")
    with pytest.raises(ValueError, match="one dimension"):
        codes.fit_codebooks(mixed)
    with pytest.raises(Exception, match="do not fit"):
        codes.fit_codebooks(spark.createDataFrame([(1, [3e30] * 16)], "vec_id bigint, embedding array<float>"))

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from foldwise.llm import components, simhash
from foldwise.llm.components import connected_components
from foldwise.operators import lookup


def fingerprint(text, size=4):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)] or ([b" ".join(words)] if words else [])
    values = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if values and sum(v >> b & 1 for v in values) * 2 > len(values))


def groups(links, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near(values, distance):
    v = np.array(values, np.uint64)
    return [(values[i], values[j]) for i in range(len(v)) for j in np.flatnonzero(np.bitwise_count(v[i] ^ v[i + 1:]) <= distance) + i + 1]


def test_fingerprints_and_groups(documents):
    got = simhash.near_duplicate_groups(documents).withColumn("hex", simhash.hex_text(F.col("fingerprint"))).collect()
    rows = documents.select("doc_id", "text").collect()
    want = sorted((str(r.doc_id), f"{fingerprint(r.text):016x}") for r in rows)
    assert sorted((str(r.doc_id), r.hex) for r in got) == want
    prints = {fingerprint(r.text) for r in rows}
    root = groups(near(sorted(prints), 4), prints)
    least = {}
    for r in rows:
        if r.doc_id is not None:
            k = root[fingerprint(r.text)]
            least[k] = min(least.get(k, r.doc_id), r.doc_id)
    for r in got:
        assert r.component_id == least.get(root[r.fingerprint % (1 << 64)])


def test_pieces_of_long_texts_do_not_matter(texts, monkeypatch):
    whole = simhash.fingerprint_values([t and t.encode() for t in texts], 4)
    monkeypatch.setattr(simhash, "PIECE", 23)
    assert (simhash.fingerprint_values([t and t.encode() for t in texts], 4) == whole).all()


@pytest.mark.parametrize("distance, crowd", [(1, 4096), (3, 4096), (4, 4096), (4, 3), (5, 3)])
def test_links_against_all_pairs(spark, distance, crowd):
    rng = random.Random(distance)
    values = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(15):
            values.add(base ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 6))) & ((1 << 64) - 1))
    values = sorted(values)
    frame = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values] * 2, "fingerprint bigint")
    roots = connected_components(simhash.near_pairs(frame, distance=distance, crowd=crowd)).collect()
    got = {r.node % (1 << 64): r.root for r in roots}
    want = groups(near(values, distance), values)
    same = {}
    for v in values:
        same.setdefault(want[v], set()).add(got.get(v, v if v < 1 << 63 else v - (1 << 64)))
    assert all(len(s) == 1 for s in same.values()) and len({next(iter(s)) for s in same.values()}) == len(same)


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (5, 5), (None, 3)], "a bigint, b bigint")
    found = {r.node: r.root for r in connected_components(edges).collect()}
    assert found == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000}
    assert connected_components(edges.limit(0)).count() == 0


def test_a_star_does_not_gather_in_one_task(spark, monkeypatch):
    """The centre of a large group is one key; its edges stay spread on either route."""
    edges = spark.range(5_000).select((F.col("id") + 1).alias("a"), F.lit(0).cast("bigint").alias("b")).union(
        spark.createDataFrame([(9_001, 9_000)], "a bigint, b bigint"))
    for limit in (lookup.BROADCAST_BYTES, -1):
        monkeypatch.setattr(lookup, "BROADCAST_BYTES", limit)
        roots = {r.node: r.root for r in connected_components(edges).collect()}
        assert roots == {**dict.fromkeys(range(5_001), 0), 9_000: 9_000, 9_001: 9_000}
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).repartition(6)
        found, _ = components._with_least(both)
        sizes = found.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert max(r["count"] for r in sizes) < 0.5 * both.count()


def test_one_document_of_each_group_stays(documents, nothing):
    kept = simhash.drop_near_duplicates(documents)
    assert kept.columns == documents.columns
    groups = simhash.near_duplicate_groups(documents)
    assert kept.count() == groups.select("group").distinct().count()
    # the fixture has two texts of one id that are not linked: the id names two groups
    assert groups.filter("component_id = 4").select("group").distinct().count() == 2
    named = groups.filter("doc_id <> 4 and component_id <> 4").groupBy("component_id").agg(F.countDistinct("group").alias("n"))
    assert named.filter("n <> 1").count() == 0
    assert simhash.near_duplicate_groups(nothing).count() == 0 and simhash.drop_near_duplicates(nothing).count() == 0

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.llm import substrings, words
from foldwise.operators import lookup


def brute(rows, n):
    """Rows of (id, text); rows that share an id are of one age."""
    oldest, first = {}, []
    for did, text in rows:
        w, seen = (text or "").encode().split(), {}
        for s in range(len(w) - n + 1):
            key = tuple(w[s:s + n])
            seen.setdefault(key, s)
            oldest[key] = min(oldest.get(key, did), did)
        first.append((did, w, seen))
    out = []
    for did, w, seen in first:
        gone = [False] * len(w)
        for s in range(len(w) - n + 1):
            key = tuple(w[s:s + n])
            if oldest[key] < did or seen[key] < s:
                gone[s:s + n] = [True] * n
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((did, len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("n, k", [(6, None), (20, None), (3, 1), (4, 4), (1, 1)])
def test_against_brute_force(documents, n, k):
    rows = [(substrings_id(r.doc_id), r.text) for r in documents.select("doc_id", "text").collect()]
    out = ["n_words", "n_removed", "kept_sha256"]
    got = substrings.drop_repeats(documents, min_words=n, anchor_words=k, outputs=out).select("doc_id", *out).collect()
    assert sorted((substrings_id(r.doc_id), *r[1:]) for r in got) == brute(rows, n)


def test_large_tables_of_keys_give_the_same(documents, monkeypatch):
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(lookup, "HOT_PARTS", 5)
    test_against_brute_force(documents, 6, 2)


def substrings_id(x):
    return -(1 << 63) if x is None else x


def test_repeats_and_text(spark, nothing):
    passage = " ".join(f"w{i}" for i in range(8))
    rows = spark.createDataFrame([(1, f"a {passage}  b"), (2, f"{passage}\nc {passage}"), (3, None)], "doc_id bigint, text string")
    got = {r.doc_id: r for r in substrings.drop_repeats(rows, min_words=5).collect()}
    assert got[1].kept_text == f"a {passage}  b" and got[1].repeats == []
    assert got[2].repeats == [[0, 8], [9, 17]] and got[2].kept_text == "c"
    assert got[3].kept_text is None and got[3].n_words == 0
    assert substrings.drop_repeats(nothing).count() == 0
    with pytest.raises(ValueError):
        substrings.drop_repeats(rows, min_words=2, anchor_words=3)


def test_word_hashes_do_not_depend_on_blocks(texts, monkeypatch):
    data = [t and t.encode() for t in texts]

    def every():
        return [v[b[i]:b[i + 1]].tolist() for _, b, v in words.hashed(data) for i in range(len(b) - 1)]

    whole = every()
    assert [len(x) for x in whole] == [len((t or b"").split()) for t in data]
    monkeypatch.setattr(words, "BLOCK", 17)
    assert every() == whole
    one = {}
    for t, hashes in zip(data, whole):
        for w, h in zip((t or b"").split(), hashes):
            assert one.setdefault(w, h) == h
    assert len(set(one.values())) == len(one)


def test_runs_do_not_depend_on_chunks(monkeypatch):
    rng = np.random.default_rng(1)
    values = rng.integers(0, 5, 3000).astype(np.uint64)
    windows = substrings.Windows(7, 3)

    def hashes():
        _, start, size, _, _ = windows.runs(np.array([0, 3000]), values)
        at = np.concatenate([np.arange(s, s + n) for s, n in zip(start, size)])
        return at.tolist(), windows.window_hashes(values, at).tolist()

    whole = hashes()
    assert whole[0] == list(range(2994))
    monkeypatch.setattr(substrings, "CHUNK", 50)
    assert hashes() == whole


def test_repeated_row_is_the_first_holder(spark):
    whole = [f"w{i}" for i in range(30)]
    rows = [(3, " ".join(whole))] * 2 + [(10 + i, " ".join([f"p{i}", *whole[i:i + 9], f"q{i}"])) for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = ["n_words", "n_removed", "kept_sha256"]
    got = sorted(tuple(r) for r in substrings.drop_repeats(frame, min_words=6, outputs=out).select("doc_id", *out).collect())
    assert got == brute(rows, 6) and got[0][2] == got[1][2] == 0


def test_texts_of_one_id_whose_short_hashes_collide(spark):
    passage = " ".join(f"w{i}" for i in range(8))
    made = spark.range(150_000).select(F.col("id").cast("string").alias("i"))
    long = made.select(F.concat("i", F.lit(f" a b c d e f {passage} z {passage}")).alias("x"))
    short = made.select(F.concat(F.lit("k l m n o p "), "i").alias("y"))
    pair = long.join(short, F.hash("x") == F.hash("y")).orderBy("x").first()
    frame = spark.createDataFrame([(None, pair.y), (None, pair.x)], "doc_id bigint, text string")
    assert frame.select(F.hash("text")).distinct().count() == 1
    # the places cut out of the long text lie beyond the end of the short one
    got = {r.text: r for r in substrings.drop_repeats(frame, min_words=5).collect()}
    assert got[pair.x].repeats == [[16, 24]] and got[pair.y].n_removed == 0 and got[pair.y].kept_text == pair.y

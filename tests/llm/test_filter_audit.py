import itertools
import re

import pytest
from pyspark.sql import functions as F

from foldwise.llm import filter_audit
from foldwise.operators import lookup


def brute(rows, labels):
    """(part, order, step) -> the eight counts, document by document."""
    def words(t):
        return re.findall(r"[^\x20\x09-\x0D]+", t)

    fails = {
        "A": lambda i, t: len(words(t)) < 100,
        "B": lambda i, t: 100 * len(set(words(t))) < 80 * len(words(t)),
        "C": lambda i, t: 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
        "D": lambda i, t: bool(re.search(r"[#$%&*|]", t)),
        "E": lambda i, t: i is not None and any(j is not None and j < i and u == t for j, u, _ in rows),
    }
    rows = [(i, t or "", lang or "") for i, t, lang in rows]
    found = [(i, part, {f for f in fails if fails[f](i, t)}) for i, t, part in rows]
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, x in labels if i is not None and x == 1}
    out = {}
    for part in {p for _, p, _ in found}:
        own = [(i, f) for i, p, f in found if p == part]
        removed_by = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            for s, f in enumerate(order):
                before = set(order[:s])
                here = [i for i, x in own if f in x and not x & before]
                removed_by[f] += len(here)
                out[part, "".join(order), s + 1] = [
                    sum(not x & (before | {f}) for _, x in own), len(here), sum(f in x and bool(x & before) for _, x in own),
                    sum(x == {f} for _, x in own), sum(i in good for i in here), sum(i in toxic for i in here)]
        for key in out:
            if key[0] == part:
                out[key].append(removed_by[key[1][key[2] - 1]])
    return out


@pytest.fixture(scope="module")
def rows(texts):
    langs = ["en", "de", None, "", "x|y"]
    out = [(i, t, langs[i % 5]) for i, t in enumerate(texts)]
    out += [(None, texts[0], "en"), (None, None, None), (3, texts[3], "de"), (3, texts[3], "de"), (4, "ANOTHER TEXT of one id #", "en")]
    return out + [(500 + i, "hot Copy %" * 30, "en") for i in range(60)] + [(700, " ".join(map(str, range(150))), "fr")]


def audited(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(5)
    docs = docs.withColumns({c: F.lit("clash") for c in ("id", "part", "mask", "words", "body", "block", "cells", "digest", "n", "kept")})
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").withColumn("id", F.lit(1))
    return filter_audit.audit_filters(
        docs, filter_audit.default_filters("text"), "E", "doc_id", "text", part="lang", labels=marks,
        lost={"good_lost": F.col("quality") == 1, "toxic_lost": F.col("toxic") == 1})


LABELS = [(i, i % 2, int(i % 7 == 0)) for i in range(0, 60, 3)] + [(3, None, None), (6, 1, 1), (None, 1, 1), (505, 1, None), (510, 0, 1), (9999, 1, 1)]


def test_against_each_document(spark, rows):
    got = audited(spark, rows, LABELS)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert {(r.part, r.filter_order, r.step): list(r)[3:] for r in got.collect()} == brute(rows, LABELS)


def test_shuffled_lookups_give_the_same(spark, rows, monkeypatch):
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(lookup, "HOT_PARTS", 4)
    got = audited(spark, rows, LABELS)
    assert {(r.part, r.filter_order, r.step): list(r)[3:] for r in got.collect()} == brute(rows, LABELS)


@pytest.mark.parametrize("cells", [1, 8, 4096])
def test_a_crowded_sketch_changes_nothing(spark, rows, cells, monkeypatch):
    """Few cells give false alarms, which the full texts settle."""
    monkeypatch.setattr(filter_audit, "BLOCK_CELLS", cells)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    first = {r.digest: r.first for r in filter_audit.first_holders(docs, "doc_id", "text").table.collect()}
    by_text = {}
    for i, t, _ in rows:
        by_text.setdefault(t or "", []).append(i)
    repeated = [min((i for i in ids if i is not None), default=None) for ids in by_text.values() if len(ids) > 1]
    assert sorted(map(str, first.values())) == sorted(map(str, repeated))


def test_unique_texts_are_cleared_before_the_shuffle(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 19_900).alias("text"))
    sketch = filter_audit.crowded_cells(docs, "text", 40)
    assert sketch.table.agg(F.max("covered")).first()[0] >= 2
    blocks = 20_000 * filter_audit.CELLS_PER_TEXT // filter_audit.BLOCK_CELLS + 1
    block, cells = filter_audit._sketch_address(F.col("text"), blocks)
    marked = lookup.attach(docs.select("text", block.alias("block"), cells.alias("cells")), filter_audit.crowded_cells(docs, "text", blocks), ["block"])
    possible = marked.filter(F.forall("cells", lambda c: F.array_contains("crowded", c))).count()
    assert 200 <= possible < 200 + 20_000 * 0.01


def test_empty_tables_and_wrong_calls(spark, rows):
    assert audited(spark, [], LABELS).count() == 0
    assert audited(spark, rows[:3], []).filter("good_lost <> 0").count() == 0
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    alone = filter_audit.audit_filters(docs, {"long": F.size("words") > 50}).collect()
    assert len(alone) == 1 and alone[0].filter_order == "long" and alone[0].kept + alone[0].removed == len(rows)
    with pytest.raises(ValueError, match="distinct names"):
        filter_audit.audit_filters(docs, {"E": F.lit(True)}, "E")

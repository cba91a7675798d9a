import re

import pytest
from pyspark.sql import functions as F

from foldwise.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, n):
    windows = {}
    for item, text in items:
        w = split(text)
        size = min(n, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + size]), set()).add("null" if item is None else str(item))
    out = []
    for key, text in docs:
        w, hit, found = split(text), set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                if tuple(w[i:i + size]) in windows:
                    hit |= set(range(i, i + size))
                    found |= windows[tuple(w[i:i + size])]
        out.append((str(key), len(w), len(hit), tuple(sorted(found)), bool(hit)))
    return sorted(out)


@pytest.fixture(scope="module")
def items(spark, texts):
    rows = [(1, " ".join(texts[0].split()[:14])), (2, texts[5].upper()), (2, "ere"), (None, "The OF"), (4, None), (5, " ,;"), (6, "absent words")]
    return spark.createDataFrame(rows, "item_id int, text string").withColumn("doc_id", F.lit(1))


@pytest.mark.parametrize("n, limit", [(10, 500_000), (3, 0)])
def test_against_brute_force(documents, items, n, limit, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", limit)
    monkeypatch.setattr(decontaminate, "BROADCAST_HITS", limit)
    got = decontaminate.find_contamination(documents, items, n).collect()
    docs = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    want = brute(docs, [(r.item_id, r.text) for r in items.select("item_id", "text").collect()], n)
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in got) == want
    assert any(w[4] for w in want)


def test_removal(spark, nothing, documents, items):
    rows = spark.createDataFrame([(1, "Keep, (one) TWO three! rest.  "), (2, "fine"), (3, None), (None, "one two three")],
                                 "doc_id bigint, text string").withColumn("n_hit", F.lit(5))
    bench = spark.createDataFrame([("q", "one two three")], "item_id string, text string")
    clean = {r.doc_id: r for r in decontaminate.remove_contamination(rows, bench, 3).collect()}
    assert clean[1].text == "Keep! rest.  " and clean[2].text == "fine" and clean[3].text is None and clean[None].text == ""
    assert clean[1].n_hit == 5
    whole = decontaminate.remove_contamination(rows, bench, 3, whole_documents=True)
    assert sorted(str(r.doc_id) for r in whole.collect()) == ["2", "3"] and whole.columns == rows.columns
    assert decontaminate.find_contamination(nothing, bench).count() == 0
    assert decontaminate.find_contamination(rows, bench.limit(0)).filter("contaminated").count() == 0
    assert decontaminate.remove_contamination(documents, items).count() == documents.count()


def test_no_python_in_the_plan(documents, items):
    plan = decontaminate.find_contamination(documents, items)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.llm import langid, quality

FOLDER = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="sample tables are not here")


def test_subwords_do_not_depend_on_pieces(texts, monkeypatch):
    whole = [langid.text_counts(t, 4096) for t in texts]
    monkeypatch.setattr(langid, "BLOCK", 11)
    for t, (at, n) in zip(texts, whole):
        again = langid.text_counts(t, 4096)
        assert (again[0] == at).all() and (again[1] == n).all()


@needs_tables
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    model = langid.fit_language_model(docs, usable=~held)
    assert model.languages == ["de", "en", "es", "fr"] and 0 < model.threshold <= 1
    rows = langid.identify(docs.filter(held), model).collect()
    right = [r.lang == r.lang_pred for r in rows]
    assert np.mean(right) > 0.97
    assert np.mean([x for x, r in zip(right, rows) if r.accepted]) >= np.mean(right)
    assert abs(np.mean([r.score for r in rows]) - np.mean(right)) < 0.05  # calibrated
    again = langid.fit_language_model(docs.repartition(7), usable=~held)
    assert np.allclose(again.weights, model.weights) and again.temperature == model.temperature


def test_languages_of_odd_texts(spark, documents, nothing):
    rows = spark.createDataFrame([(i, t, g) for i in range(40) for t, g in (
        (f"the cat and the dog {i} with that", "en"), (f"der hund und die katze {i} mit", "de"), (None, "xx"), ("42", None))],
        "doc_id bigint, text string, lang string")
    model = langid.fit_language_model(rows, per_language=30)
    assert model.languages == ["de", "en"]
    got = langid.identify(documents, model).select("text", "lang_pred", "score", "accepted").collect()
    assert len(got) == documents.count()
    for r in got:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and 0 <= r.score <= 1 and (letters or (r.score == 0 and not r.accepted))
    found = {r.text: r.lang_pred for r in langid.identify(rows, model).collect() if r.text}
    assert found["the cat and the dog 1 with that"] == "en" and found["der hund und die katze 1 mit"] == "de"
    unknown = langid.fit_language_model(nothing.withColumn("lang", F.lit("en")))
    assert {r.lang_pred for r in langid.identify(documents, unknown).collect()} == {"und"}
    assert langid.identify(nothing, model).count() == 0
    with pytest.raises(ValueError):
        langid.fit_language_model(rows, max_languages=1)


def test_temperature_and_threshold():
    logits = np.array([[4.0, 0.0]] * 90 + [[4.0, 0.0]] * 10)
    y = np.array([0] * 90 + [1] * 10)
    t = langid._temperature(logits, y)
    assert abs(langid._softmax(logits / t)[0, 0] - 0.9) < 0.02
    score, right = np.array([0.9, 0.8, 0.7, 0.6]), np.array([True, True, False, True])
    assert langid._threshold(score, right, 0.99) == 0.8 and langid._threshold(score, right, 0.7) == 0.6
    assert langid._threshold(score, ~right, 0.99) == 1.0


@needs_tables
def test_the_sample_of_languages_is_bounded_by_its_entries(spark, monkeypatch):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    taken, train = [], langid.train
    monkeypatch.setattr(langid, "train", lambda bags, *a, **k: taken.append(sum(len(b[0]) for b in bags)) or train(bags, *a, **k))
    whole = langid.fit_language_model(docs)
    fewer = langid.fit_language_model(docs, max_entries=taken[0] // 4)
    assert 0.1 * taken[0] < taken[1] < 0.4 * taken[0] and fewer.languages == whole.languages


def test_label_model_finds_the_accuracies():
    rng = np.random.default_rng(5)
    m, n = len(quality.LABELLERS), 40_000
    good = rng.random(n) < 0.85
    on_good, on_bad = np.full(m, 0.995), np.linspace(0.3, 0.8, m)
    right = np.where(good[:, None], rng.random((n, m)) < on_good, rng.random((n, m)) < on_bad)
    votes = np.where(right == good[:, None], quality.GOOD, quality.BAD)
    votes[rng.random((n, m)) < 0.1] = quality.NO_VOTE
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.fit_label_model(patterns.tolist(), counts.tolist())
    assert abs(model.prior - 0.85) < 0.02 and np.abs(np.array(model.right_on_bad) - on_bad).max() < 0.05
    assert np.abs(np.array(model.right_on_good) - on_good).max() < 0.01
    posterior = np.array([model.posterior(v) for v in votes[:3000]]) > 0.5
    assert (posterior == good[:3000]).mean() > 0.98
    assert quality.fit_label_model([], []).prior > 0.5


def test_measures():
    names = quality.MEASURES
    junk = dict(zip(names, quality.measures(b"### $$$ %%% BUY!! NOW!! " * 20)))
    assert junk["symbols"] > 0.4 and junk["shouts"] > 0.3 and junk["odd_words"] > 0.5 and junk["run_copies"] > 0.9
    fine = quality.measures("Ein Satz mit Wörtern, der nicht laut ist und sich kaum wiederholt.".encode())
    assert quality.BAD not in quality.votes(fine)
    assert set(quality.votes(quality.measures(None))) == {quality.NO_VOTE} == set(quality.votes(quality.measures(b" ")))


@pytest.mark.parametrize("length", [300, 1_999, 2_000, 2_001, 15_000])
def test_pasted_blocks_get_one_vote_at_any_length(length):
    """A block pasted again and again on one line is bad, prose of the same length is not."""
    rng = np.random.default_rng(length)
    prose = [f"w{i}" for i in rng.zipf(1.3, length) % 4_000]
    place = quality.MEASURES.index("run_copies")
    block = prose[: length // 10]
    for words, vote in ((prose, quality.GOOD), (block * 10, quality.BAD)):
        assert quality.votes(quality.measures(" ".join(words).encode()))[place] == vote


@needs_tables
def test_labellers_are_right_where_they_vote_bad(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").join(spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id").collect()
    votes = np.array([quality.votes(quality.measures(r.text.encode() if r.text else None)) for r in rows])
    bad = np.array([r.quality == 0 for r in rows])
    for name, own in zip(quality.MEASURES, votes.T):
        called = own == quality.BAD
        assert not called.any() or bad[called].mean() > 0.95, name
    assert (votes == quality.BAD).any(axis=1)[bad].mean() > 0.8  # recall of all labellers together


def test_features_do_not_depend_on_blocks(texts, monkeypatch):
    data = [(t or "").encode() for t in texts]
    whole = [quality.features(t, quality.measures(t), 512) for t in data]
    monkeypatch.setattr(quality, "BLOCK", 13)
    for t, (at, x) in zip(data, whole):
        again = quality.features(t, quality.measures(t), 512)
        assert (again[0] == at).all() and np.allclose(again[1], x)


@needs_tables
def test_junk_goes_and_clean_texts_stay(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    model = quality.fit_quality_model(docs)
    rows = quality.classify(docs, model).join(labels, "doc_id").collect()
    junk = [r.keep for r in rows if r.quality == 0]
    clean = [r.keep for r in rows if r.quality == 1]
    assert np.mean(junk) < 0.1 and np.mean(clean) > 0.995
    again = quality.fit_quality_model(docs.repartition(7))
    assert np.allclose(again.weights, model.weights) and again.labels == model.labels


def test_quality_of_odd_texts(documents, nothing):
    model = quality.fit_quality_model(documents)
    got = quality.classify(documents, model).select("text", "posterior", "score", "keep").collect()
    assert len(got) == documents.count()
    for r in got:
        assert 0 <= r.score <= 1 and 0 <= r.posterior <= 1
        if not (r.text or "").encode().split():
            assert r.score == 0 and not r.keep
    empty = quality.fit_quality_model(nothing)
    assert quality.classify(nothing, empty).count() == 0 and quality.classify(documents, empty).count() == len(got)

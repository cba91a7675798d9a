import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer
from tokenizers.decoders import ByteLevel as ByteDecoder
from tokenizers.models import BPE
from tokenizers.pre_tokenizers import ByteLevel

from foldwise.llm import bpe


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.DEFAULT_TOKENIZER)


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.DEFAULT_TOKENIZER)


def split(ids, sizes):
    out, at = [], 0
    for n in sizes.tolist():
        out.append(ids[at: at + n].tolist())
        at += n
    return out


def same(codec, library, texts):
    got = split(*codec.encode(texts))
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert got == want
    assert [codec.decode(i) for i in got] == [library.decode(i, skip_special_tokens=False) for i in want]


def test_documents(documents, nothing, library):
    coded = bpe.encode(documents, "text", decoded="back")
    rows = coded.collect()
    assert len(rows) == documents.count()
    for r in rows:
        if r.text is None:
            assert r.token_ids is None and r.n_tokens == 0 and r.back is None
        else:
            assert r.token_ids == library.encode(r.text, add_special_tokens=False).ids
            assert r.n_tokens == len(r.token_ids) and r.back == r.text
    again = bpe.decode(coded, "token_ids", "back").collect()
    assert all(r.back == r.text for r in again)
    assert bpe.encode(nothing, "text").count() == 0 and bpe.decode(bpe.encode(nothing, "text")).count() == 0


ALPHABET = "abc theing '’sStTrelvmd\t\n\r  \x0b\x0c\x1c\x1f\x85\xa0éß中文ا१२½Ⅷ²́​　\U0001F600‍﻿\x00\x7f0123.,-=*/#<|endoftext|>"


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(alphabet=ALPHABET, max_size=80), st.text(max_size=40),
                 st.lists(st.sampled_from(["<|endoftext|>", "<|endof", "text|>", " ", "a", "\n", " 's"]), max_size=12).map("".join)))
def test_any_text(codec, library, text):
    same(codec, library, [text])


def test_long_runs(codec, library):
    same(codec, library, ["a" * 5000, "ab" * 3000, "-" * 1500, " " * 900 + "x", "\n" * 301, "é" * 800, "aA" * 500, "=" * 64 + "-" * 129, "", " "])


def test_forgetting_units_changes_nothing(library, monkeypatch):
    codec = bpe.Codec(bpe.DEFAULT_TOKENIZER)
    texts = ["first words of a text", "", "more words <|endoftext|> of a text", "first again"]
    monkeypatch.setattr(bpe, "KNOWN_UNITS", 1)
    same(codec, library, texts)
    same(codec, library, texts[::-1])
    same(codec, library, ["<|endoftext|>"])


def test_ids_that_are_no_text(codec, library, spark):
    rng = random.Random(2)
    lists = [[rng.randint(0, 50_300) for _ in range(15)] for _ in range(300)]
    assert [codec.decode(i) for i in lists] == [library.decode(i, skip_special_tokens=False) for i in lists]
    rows = spark.createDataFrame([([None, -5, 64, 10**6, 65],), (None,), ([],)], "token_ids array<int>")
    assert [r.text for r in bpe.decode(rows).collect()] == ["ab", None, ""]


def merged(unit, ranks):
    """Merges applied one by one, the lowest rank first, from the left."""
    parts = list(unit)
    while True:
        found = [(ranks[a, b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if (a, b) in ranks]
        if not found:
            return parts
        _, i = min(found)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


def test_any_vocabulary(tmp_path):
    """Random merges, among them tokens that are never reached and several merges that make one token."""
    rng = random.Random(4)
    names = sorted(bpe.byte_alphabet())
    for trial in range(25):
        tokens, merges = ["a", "b", "c"], []
        while len(merges) < 25:
            a, b = rng.choice(tokens), rng.choice(tokens)
            if (a, b) not in merges and len(a + b) < 12:
                merges.append((a, b))
                if a + b not in tokens:
                    tokens.append(a + b)
        vocabulary = {t: i for i, t in enumerate(names + [t for t in tokens if len(t) > 1])}
        tokenizer = Tokenizer(BPE(vocabulary, merges))
        tokenizer.pre_tokenizer, tokenizer.decoder = ByteLevel(add_prefix_space=False), ByteDecoder()
        path = tmp_path / f"{trial}.json"
        tokenizer.save(str(path))
        codec, ranks = bpe.Codec(str(path)), {m: i for i, m in enumerate(merges)}
        texts = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 30))) for _ in range(200)]
        for text in texts:
            assert codec.encode_unit(text.encode()) == [vocabulary[t] for t in merged(text, ranks)]
        assert split(*codec.encode(texts)) == [e.ids for e in tokenizer.encode_batch(texts)]


def test_other_models_are_an_error(tmp_path):
    with open(bpe.DEFAULT_TOKENIZER, encoding="utf-8") as file:
        plan = json.load(file)
    for part, value in (("normalizer", {"type": "Lowercase"}), ("pre_tokenizer", {"type": "Whitespace"}), ("model", {**plan["model"], "byte_fallback": True})):
        path = tmp_path / f"{part}.json"
        path.write_text(json.dumps({**plan, part: value}))
        with pytest.raises(ValueError):
            bpe.Codec(str(path))

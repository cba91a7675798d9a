"""Byte-level BPE encoding by dynamic programming over prefixes, and decoding.

Every prefix of a pre-token has one encoding, so it has one last token. That token
is found without merging: an automaton over the vocabulary gives, for each
prefix, all tokens that are suffixes of it, and a token ``t`` is the last one if and only if it
may follow the last token of the prefix that it leaves. Whether two tokens may stand side by side
is decided by undoing their merges from the latest to the earliest and looking for a
merge across the border that would have come first. Back-pointers from the
whole pre-token then give the ids. Each distinct pre-token is encoded once per task.

Texts are cut as the byte-level pre-tokenizer cuts them. Its classes of
letters, numbers and white space are asked of the tokenizer itself for each
character beyond ASCII that occurs.
"""

from __future__ import annotations

import functools
import json
import os
import re
from array import array
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.llm.shared import append_columns, require_columns, require_text

DEFAULT_TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
KNOWN_UNITS = 300_000
CHARS = 1 << 19
NEVER = 1 << 60

# fixed values of the byte-level alphabet: bytes shown as themselves; the others follow from U+0100 on
SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


@functools.cache
def byte_alphabet() -> dict[str, int]:
    """Character -> byte."""
    hidden = [b for b in range(256) if b not in set(SHOWN)]
    return {**{chr(b): b for b in SHOWN}, **{chr(0x100 + i): b for i, b in enumerate(hidden)}}


def _check(plan: dict) -> None:
    """Only plain byte-level BPE is encoded here; anything else in the file is an error."""
    model, cut = plan["model"], plan.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or any(model.get(k) for k in (
            "dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
        raise ValueError("only plain BPE models are supported")
    if cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
        raise ValueError("only the byte-level pre-tokenizer without a prefix space is supported")
    if plan.get("normalizer") is not None or plan.get("post_processor") is not None:
        raise ValueError("normalisers and post-processors are not supported")
    if any(t.get("single_word") or t.get("lstrip") or t.get("rstrip") for t in plan.get("added_tokens", [])):
        raise ValueError("added tokens that depend on what is around them are not supported")


class Vocabulary:
    """Tokens as bytes, the merge that makes each, and the test whether two may be neighbours."""

    def __init__(self, plan: dict):
        _check(plan)
        alphabet, names = byte_alphabet(), plan["model"]["vocab"]
        self.added = {t["content"]: t["id"] for t in plan.get("added_tokens", [])}
        own = {i: name for name, i in names.items() if name not in self.added}
        size = 1 + max([*own, *self.added.values()])
        self.shown: list[bytes | None] = [None] * size
        for i, name in own.items():
            self.shown[i] = bytes(alphabet[c] for c in name)
        for content, i in self.added.items():
            self.shown[i] = content.encode()
        self.size = size
        self.rank, self.left, self.right = [-1] * size, [0] * size, [0] * size
        self.pairs: dict[int, int] = {}
        self.valid: dict[int, bool] = {}
        merges = [m if isinstance(m, list) else m.split(" ") for m in plan["model"]["merges"]]
        made = [(names[a], names[b], names[a + b]) for a, b in merges]
        for rank, (a, b, _) in enumerate(made):
            self.pairs[a * size + b] = rank
        # a token is reached if the tokens it is made of are, and stay apart until its merge
        reached = {i for i in own if len(self.shown[i]) == 1}
        if len(reached) < 256:
            raise ValueError("the vocabulary must hold every byte")
        for rank, (a, b, token) in enumerate(made):
            if token not in reached and a in reached and b in reached and self._apart(a, b, rank):
                reached.add(token)
                self.rank[token], self.left[token], self.right[token] = rank, a, b
        self.reached = sorted(reached)

    def _apart(self, a: int, b: int, before: int = NEVER) -> bool:
        """Whether no merge of a rank below ``before`` joins the end of ``a`` to the start of ``b``.

        The pieces at the border are followed back in time. Of equal ranks the left merge comes first: it is
        undone last, and a merge across the border comes before one in ``b``.
        """
        pairs, rank, size = self.pairs, self.rank, self.size
        while True:
            if pairs.get(a * size + b, NEVER) < before:
                return False
            if rank[a] > rank[b]:
                before, a = rank[a], self.right[a]
            elif rank[b] >= 0:
                before, b = rank[b] + 1, self.left[b]
            else:
                return True

    def may_follow(self, a: int, b: int) -> bool:
        pair = a * self.size + b
        known = self.valid.get(pair)
        if known is None:
            if len(self.valid) > 4_000_000:
                self.valid.clear()
            known = self.valid[pair] = self._apart(a, b)
        return known


def suffix_automaton(vocabulary: Vocabulary):
    """Automaton that gives, place by place, the tokens that end there, the longest first."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for i in vocabulary.reached:
        shown = vocabulary.shown[i]
        automaton.add_word(shown.decode("latin-1"), (i, len(shown)))
    automaton.make_automaton()
    return automaton


class Cutter:
    """Pre-tokens of texts, as the tokenizer cuts them."""

    def __init__(self, pre_tokenizer):
        self.cut = pre_tokenizer
        self.letters, self.numbers, self.spaces, self.known = [], [], [], set()
        self.plain = self._pattern()
        self.pattern = self.plain

    def _pattern(self) -> re.Pattern:
        letters = "A-Za-z" + "".join(map(re.escape, self.letters))
        numbers = "0-9" + "".join(map(re.escape, self.numbers))
        spaces = "\\t-\\r " + "".join(map(re.escape, self.spaces))
        return re.compile(f"'(?:[stmd]|re|ve|ll)| ?[{letters}]+| ?[{numbers}]+| ?[^{spaces}{letters}{numbers}]+"
                          f"|[{spaces}]+(?![^{spaces}])|[{spaces}]+")

    def _ask(self, characters: set[str]) -> None:
        """Learn the classes of characters from how the tokenizer cuts them behind a letter, a digit and a mark."""
        for c in sorted(characters):
            self.known.add(c)
            for own, before in ((self.letters, "a"), (self.numbers, "1"), (None, "!")):
                if len(self.cut.pre_tokenize_str(before + c)) == 1:
                    if own is not None:
                        own.append(c)
                    break
            else:
                self.spaces.append(c)
        self.pattern = self._pattern()

    def units(self, text: str) -> list[str]:
        if text.isascii():
            return self.plain.findall(text)
        new = {c for c in set(text) - self.known if c > "\x7f"}
        if new:
            self._ask(new)
        return self.pattern.findall(text)


class Codec:
    """Encodes and decodes with one tokenizer file; distinct pre-tokens are kept between calls."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            self.vocabulary = Vocabulary(json.load(file))
        self.automaton = suffix_automaton(self.vocabulary)
        self.cutter = Cutter(Tokenizer.from_file(path).pre_tokenizer)
        added = sorted(self.vocabulary.added, key=len, reverse=True)
        self.added = re.compile(f"({'|'.join(map(re.escape, added))})") if added else None
        self.forget()

    def forget(self) -> None:
        """Drop the pre-tokens encoded so far."""
        self.known: dict[str, int] = {}
        self.ids, self.bounds = array("i"), array("q", [0])

    def encode_unit(self, unit: bytes) -> list[int]:
        """Ids of one pre-token by the last token of each of its prefixes."""
        last, back = [-1] * (len(unit) + 1), [0] * (len(unit) + 1)
        valid, size, may_follow = self.vocabulary.valid, self.vocabulary.size, self.vocabulary.may_follow
        for at, (token, length) in self.automaton.iter(unit.decode("latin-1")):
            at += 1
            if last[at] >= 0:
                continue  # the last token of this prefix is known, and it is the only one
            start = at - length
            if start:
                before = last[start]
                follows = valid.get(before * size + token)
                if follows is None:
                    follows = may_follow(before, token)
                if not follows:
                    continue
            last[at], back[at] = token, start
        out, at = [], len(unit)
        while at:
            out.append(last[at])
            at = back[at]
        out.reverse()
        return out

    def _learn(self, unit: str) -> int:
        number = len(self.known)
        self.ids.extend(self.encode_unit(unit.encode()))
        self.bounds.append(len(self.ids))
        self.known[unit] = number
        return number

    def _numbers(self, text: str) -> list[int]:
        """Numbers of a text's pre-tokens; added tokens, which are found before the text is cut, are below zero."""
        if self.added is None or not self.added.search(text):
            known, units = self.known, self.cutter.units(text)
            return [known[u] if u in known else self._learn(u) for u in units]
        out = []
        for part in self.added.split(text):
            if part in self.vocabulary.added:
                out.append(-1 - self.vocabulary.added[part])
            elif part:
                out += [self.known[u] if u in self.known else self._learn(u) for u in self.cutter.units(part)]
        return out

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each)."""
        if len(self.known) > KNOWN_UNITS:
            self.forget()
        numbers = [self._numbers(t) for t in texts]
        counts = np.array([len(n) for n in numbers], np.int64)
        at = np.fromiter(chain.from_iterable(numbers), np.int64, counts.sum())
        ids, bounds = np.array(self.ids, np.int32), np.array(self.bounds, np.int64)
        special = at < 0
        at[special], marks = 0, -1 - at[special]
        begin = bounds[at] if len(bounds) > 1 else np.zeros(len(at), np.int64)
        size = bounds[at + 1] - begin if len(bounds) > 1 else np.ones(len(at), np.int64)
        size[special] = 1
        ends = np.cumsum(size)
        place = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size - begin, size)
        found = ids[place] if len(ids) else np.zeros(len(place), np.int32)
        found[(ends - size)[special]] = marks
        total = np.concatenate([[0], ends])
        edges = np.concatenate([[0], np.cumsum(counts)])
        return found, total[edges[1:]] - total[edges[:-1]]

    def decode(self, ids: Sequence[int | None]) -> str:
        """The text of an id list; ids that are null or not in the vocabulary are skipped, broken UTF-8 is replaced."""
        shown, size = self.vocabulary.shown, self.vocabulary.size
        try:
            return b"".join([shown[i] for i in ids]).decode("utf-8", "replace")
        except (TypeError, IndexError):
            usable = [i for i in ids if i is not None and 0 <= i < size and shown[i] is not None]
            return b"".join([shown[i] for i in usable]).decode("utf-8", "replace")


@functools.cache
def _codec(path: str) -> Codec:
    return Codec(path)


def _slices(texts: Sequence[str | None]) -> Iterator[slice]:
    """Slices of a batch of at most about CHARS characters."""
    first, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text or "")
        if held >= CHARS:
            yield slice(first, i + 1)
            first, held = i + 1, 0
    if first < len(texts):
        yield slice(first, len(texts))


def encode(df: DataFrame, text: str = "text", tokenizer: str = DEFAULT_TOKENIZER, decoded: str | None = None) -> DataFrame:
    """Add ``token_ids`` and ``n_tokens`` of each whole text, as the tokenizers library gives them without special tokens added.

    The string of an added token in a text becomes its id. A null text has null
    ids and 0 tokens, an empty one has no ids. With ``decoded`` a column of that name gets the text that the ids
    decode to. Columns of these names are replaced. The tokenizer's file must be readable in the tasks.
    """
    require_text(df, text)

    def compute() -> Callable[[pa.RecordBatch], list[pa.Array]]:
        codec = _codec(tokenizer)

        def function(batch: pa.RecordBatch) -> list[pa.Array]:
            texts = batch.column(0).to_pylist()
            ids, sizes, back = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], []
            for rows in _slices(texts):
                found, counts = codec.encode([t or "" for t in texts[rows]])
                ids.append(found)
                sizes.append(counts)
                if decoded is not None:
                    flat, at = found.tolist(), 0
                    for n in counts.tolist():
                        back.append(codec.decode(flat[at: at + n]))
                        at += n
            sizes = np.concatenate(sizes)
            none = np.array([t is None for t in texts], bool)
            bounds = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            out = [pa.ListArray.from_arrays(bounds, pa.array(np.concatenate(ids), pa.int32()), mask=pa.array(none)),
                   pa.array(sizes, pa.int64())]
            if decoded is not None:
                out.append(pa.array([None if t is None else b for t, b in zip(texts, back)], pa.string()))
            return out
        function.done = codec.forget
        return function

    fields = [T.StructField("token_ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType())]
    return append_columns(df, fields + ([] if decoded is None else [T.StructField(decoded, T.StringType())]), compute, [text])


def decode(df: DataFrame, ids: str = "token_ids", out: str = "text", tokenizer: str = DEFAULT_TOKENIZER) -> DataFrame:
    """Add the text of each id list, special tokens included. A null list has a null text; a column named ``out`` is replaced.

    Ids that are null or not in the vocabulary are skipped; bytes that do not form UTF-8 become replacement characters.
    """
    require_columns(df, [ids])

    def compute():
        codec = _codec(tokenizer)
        return lambda batch: [pa.array([None if i is None else codec.decode(i) for i in batch.column(0).to_pylist()], pa.string())]

    return append_columns(df.withColumn(ids, F.col(ids).cast("array<int>")), [T.StructField(out, T.StringType())], compute, [ids])

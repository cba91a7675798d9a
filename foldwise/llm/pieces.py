"""SentencePiece encoding and decoding on the tokenizers library.

The model's protobuf is parsed field by field; from it come the normaliser, the
space marker, the piece scores and byte fallback, and a tokenizer that gives the
ids which SentencePiece gives. Unigram models keep their scores; for BPE models
the merges follow from the ranks of the pieces. Where no piece goes on behind a
space, texts are cut into units before spaces, and each distinct unit is
encoded once per task, in rows and multithreaded batches; other models encode
whole texts.
Parity with SentencePiece and the way back are verified for every distinct unit,
so for every text, and on fixed probe texts when a tokenizer is built.
"""

from __future__ import annotations

import functools
import os
import re
import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.llm.shared import append_columns, require_columns, require_text

# fixed values of the model format
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
MARK = "▁"

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CHARS = 1 << 19
TOKENS = 1 << 18
KNOWN_UNITS = 300_000
ROW_OF_UNITS = 256
#: marks and what follows up to the next mark
UNIT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
PROBES = (
    "", " ", "  ", "   a", "a ", "a  b", "a   b    c", "Hello, world!", "\n", "a\nb\n\nc", "\t\ttabs\t", "▁", "a▁b",
    "éèêë Ünï çödé ñ ß", "你好 世界", "\U0001F600 x\U0001F601\U0001F602", "\x00\x01\x7f", "1234567890 3.14",
    "é ﬁ", "مرحبا", "x" * 100, "ab" * 60 + " " * 9 + "end", "<s> </s> <unk> <0x41>",
)


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protobuf message's fields."""
    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[at] & 127) << shift
            at, shift = at + 1, shift + 7
            if data[at - 1] < 128:
                return value, at

    at = 0
    while at < len(data):
        tag, at = varint(at)
        number, wire = tag >> 3, tag & 7
        if wire == 0:
            value, at = varint(at)
        elif wire == 2:
            size, at = varint(at)
            value, at = data[at: at + size], at + size
        elif wire in (1, 5):
            size = 8 if wire == 1 else 4
            value, at = data[at: at + size], at + size
        else:
            raise ValueError(f"unknown wire type {wire}")
        yield number, value


@dataclass
class PieceModel:
    """What encoding needs of a SentencePiece model."""

    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    kinds: list[int] = field(default_factory=list)
    model_type: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    add_dummy_prefix: bool = True
    remove_extra_whitespaces: bool = True
    escape_whitespaces: bool = True

    def ids_of(self, *kinds: int) -> list[int]:
        return [i for i, k in enumerate(self.kinds) if k in kinds]

    @property
    def unknown(self) -> int:
        return self.ids_of(UNKNOWN)[0]

    @property
    def splits_at_marks(self) -> bool:
        """Whether no usable piece goes on after a mark that follows something else."""
        return not any(MARK in p.lstrip(MARK) for p, k in zip(self.pieces, self.kinds) if k in (NORMAL, USER_DEFINED))


def parse_model(data: bytes) -> PieceModel:
    """Read a model's protobuf; fields that encoding does not need are skipped."""
    model = PieceModel()
    for number, value in _fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in _fields(value):
                if n == 1:
                    piece = v.decode()
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            model.pieces.append(piece)
            model.scores.append(score)
            model.kinds.append(kind)
        elif number == 2:
            for n, v in _fields(value):
                if n == 3:
                    model.model_type = v
                elif n == 35:
                    model.byte_fallback = bool(v)
        elif number == 3:
            for n, v in _fields(value):
                if n == 2:
                    model.charsmap = v
                elif n == 3:
                    model.add_dummy_prefix = bool(v)
                elif n == 4:
                    model.remove_extra_whitespaces = bool(v)
                elif n == 5:
                    model.escape_whitespaces = bool(v)
    if model.model_type not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models can be rebuilt")
    if not model.escape_whitespaces:
        raise ValueError("models that keep plain spaces cannot be rebuilt")
    if model.ids_of(USER_DEFINED):
        raise ValueError("models with user-defined pieces cannot be rebuilt")
    return model


@functools.cache
def load_model(path: str) -> PieceModel:
    with open(path, "rb") as file:
        return parse_model(file.read())


def _merges(model: PieceModel) -> list[tuple[str, str]]:
    """Pairs of pieces in the order in which they are merged: by the rank of what they make."""
    usable = {model.pieces[i]: model.scores[i] for i in model.ids_of(NORMAL)}
    number = {p: i for i, p in enumerate(model.pieces)}
    out = []
    for piece, score in usable.items():
        for cut in range(1, len(piece)):
            left, right = piece[:cut], piece[cut:]
            if left in usable and right in usable:
                out.append((-score, number[piece], number[left], number[right], left, right))
    out.sort(key=lambda m: m[:4])
    return [m[4:] for m in out]


def build_tokenizer(model: PieceModel):
    """A tokenizer of the tokenizers library with the model's normaliser, marker, scores and byte fallback."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    unknown = model.unknown
    if model.model_type == UNIGRAM:
        blocked = min(model.scores) - 1e6  # pieces that text must not reach
        scores = [s if k in (NORMAL,) else blocked for s, k in zip(model.scores, model.kinds)]
        core = models.Unigram(list(zip(model.pieces, scores)), unk_id=unknown, byte_fallback=model.byte_fallback)
    else:
        vocabulary = {p: i for i, p in enumerate(model.pieces)}
        core = models.BPE(vocabulary, _merges(model), unk_token=model.pieces[unknown], fuse_unk=True,
                          byte_fallback=model.byte_fallback, ignore_merges=False, cache_capacity=0)
    tokenizer = Tokenizer(core)
    steps = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.remove_extra_whitespaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.add_dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    steps.append(normalizers.Replace(" ", MARK))
    tokenizer.normalizer = normalizers.Sequence(steps)
    if model.splits_at_marks:
        tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(UNIT.pattern), "isolated")
    tokenizer.decoder = decoders.Sequence([
        decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(),
        *([decoders.Strip(" ", 1, 0)] if model.add_dummy_prefix else [])])
    return tokenizer


def _threads(n: int) -> None:
    """Threads of the library in this worker; they are counted when it first runs."""
    os.environ["TOKENIZERS_PARALLELISM"] = "true" if n > 1 else "false"
    os.environ.setdefault("RAYON_NUM_THREADS", str(n))


class Codec:
    """Encodes batches with the rebuilt tokenizer; ids are checked against SentencePiece and decoded again."""

    def __init__(self, path: str, threads: int = 2):
        _threads(threads)
        import sentencepiece
        from tokenizers import Tokenizer, pre_tokenizers

        self.model = load_model(path)
        self.tokenizer = _decoder(path)
        self.check = sentencepiece.SentencePieceProcessor(model_file=path)
        self.lone = [self.check.piece_to_id(MARK)]
        self.by_unit = self.model.splits_at_marks and self.model.add_dummy_prefix
        self.plain = not (self.model.charsmap or self.model.remove_extra_whitespaces)
        self.bare = build_tokenizer(self.model)
        self.bare.normalizer = self.bare.pre_tokenizer = None
        self.in_rows = Tokenizer(self.bare.model)
        self.in_rows.pre_tokenizer = pre_tokenizers.Split(MARK, "merged_with_next")
        self.opens = np.array([p.startswith(MARK) for p in self.model.pieces], bool)
        self.forget()
        wrong = [t for t in PROBES if self.tokenizer.encode(t, add_special_tokens=False).ids != self.check.encode(t)]
        if wrong:
            raise ValueError(f"the rebuilt tokenizer differs on probe texts: {wrong[:3]!r}")

    def forget(self) -> None:
        """Drop the units encoded so far."""
        self.known: dict[bytes, int] = {}
        self.unit_ids = np.zeros(0, np.int32)
        self.unit_bounds = np.zeros(1, np.int64)
        self.unit_parity = self.unit_trip = np.zeros(0, bool)

    def normal(self, text: str) -> str:
        """The text as it is encoded."""
        if not text:
            return ""
        return MARK + text.replace(" ", MARK) if self.plain else self.tokenizer.normalizer.normalize_str(text)

    def _units(self, texts: Sequence[str]) -> tuple[pa.Array, np.ndarray]:
        """Units of all texts in a row, in UTF-8 with spaces for marks, and the number of units of each text."""
        if self.plain:
            parts = [(" " + t.replace(MARK, " ")).encode() if t else b"" for t in texts]
        else:
            parts = [self.normal(t).replace(MARK, " ").encode() for t in texts]
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
        data = np.frombuffer(b"".join(parts), np.uint8)
        blank = data == 32
        opens = blank.copy()
        opens[1:] &= ~blank[:-1]
        opens[ends[:-1][ends[:-1] < len(data)]] = True  # the text before may end in a space
        begins = np.flatnonzero(opens)
        counts = np.diff(np.searchsorted(begins, ends), prepend=0)
        bounds = pa.py_buffer(np.append(begins, len(data)).astype(np.int64))
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins), [None, bounds, pa.py_buffer(data)]), counts

    def _checked(self, normal: list[str], ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids are those of SentencePiece, and where the backend decodes them to what was encoded."""
        cut = self.model.add_dummy_prefix
        shown = [n.replace(MARK, " ") for n in normal]
        shown = [n[1:] if cut and n.startswith(" ") else n for n in shown]
        wanted = self.check.encode(shown)
        # a lone mark ends a text that ends in a space; no text of its own gives it
        parity = np.array([own == (self.lone if n == MARK else w) for n, own, w in zip(normal, ids, wanted)], bool)
        back = self.tokenizer.decode_batch(ids, skip_special_tokens=False)
        return parity, np.array([b == n for b, n in zip(back, shown)], bool)

    def _checked_units(self, units: list[str], ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """As ``_checked``, many units at once: in a row they are a text, whose ids and way back are theirs.

        Only where a row of units differs are they looked at one by one. Units of marks alone would join the next one.
        """
        parity, trip = np.ones(len(units), bool), np.ones(len(units), bool)
        alone = [i for i, u in enumerate(units) if u.endswith(MARK)]
        words = [i for i, u in enumerate(units) if not u.endswith(MARK)]
        for at in range(0, len(words), ROW_OF_UNITS):
            row = words[at: at + ROW_OF_UNITS]
            text = "".join([units[i] for i in row]).replace(MARK, " ")[1:]
            own = list(chain.from_iterable([ids[i] for i in row]))
            if self.check.encode(text) != own or self.tokenizer.decode(own, skip_special_tokens=False) != text:
                alone += row
        if alone:
            parity[alone], trip[alone] = self._checked([units[i] for i in alone], [ids[i] for i in alone])
        return parity, trip

    def _encoded_rows(self, units: list[bytes]) -> tuple[list[bytes], list[np.ndarray], list[np.ndarray], list[bytes]]:
        """(units, their ids in rows, their numbers of ids, other units) of units with one mark, at the front.

        A unit's ids begin where a piece has the mark. Rows that do not show each unit so, or where SentencePiece or
        the way back differ, are left to be looked at one by one.
        """
        rows = [units[at: at + ROW_OF_UNITS] for at in range(0, len(units), ROW_OF_UNITS)]
        texts = [b"".join(row).decode() for row in rows]
        found = self.in_rows.encode_batch_fast([t.replace(" ", MARK) for t in texts], add_special_tokens=False)
        done, ids, sizes, other = [], [], [], []
        for row, text, encoded in zip(rows, texts, found):
            own, shown = encoded.ids, text[1:]
            flat = np.array(own, np.int32)
            begins = np.flatnonzero(self.opens[flat])
            if (len(begins) == len(row) and self.check.encode(shown) == own
                    and self.tokenizer.decode(own, skip_special_tokens=False) == shown):
                done += row
                ids.append(flat)
                sizes.append(np.diff(begins, append=len(flat)))
            else:
                other += row
        return done, ids, sizes, other

    def _learn(self, units: list[bytes]) -> None:
        done, row_ids, row_sizes, other = self._encoded_rows([u for u in units if u[1:2] not in (b"", b" ")])
        other += [u for u in units if u[1:2] in (b"", b" ")]
        normal = [u.decode().replace(" ", MARK) for u in other]
        ids = [e.ids for e in self.bare.encode_batch_fast(normal, add_special_tokens=False)]
        parity, trip = self._checked_units(normal, ids)
        first = len(self.known)
        self.known.update(zip(chain(done, other), range(first, first + len(units))))
        sizes = np.concatenate([*row_sizes, np.fromiter(map(len, ids), np.int64, len(ids))])
        self.unit_ids = np.concatenate([self.unit_ids, *row_ids, np.fromiter(chain.from_iterable(ids), np.int32)])
        self.unit_bounds = np.concatenate([self.unit_bounds, self.unit_bounds[-1] + np.cumsum(sizes)])
        self.unit_parity = np.concatenate([self.unit_parity, np.ones(len(done), bool), parity])
        self.unit_trip = np.concatenate([self.unit_trip, np.ones(len(done), bool), trip])

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids, parity, round trip) of each text."""
        if not self.by_unit:
            normal = [self.normal(t) for t in texts]
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)]
            parity, trip = self._checked(normal, ids)
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            return np.fromiter(chain.from_iterable(ids), np.int32, sizes.sum()), sizes, parity, trip
        units, counts = self._units(texts)
        numbered = units.dictionary_encode()
        distinct = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = [u for u in distinct if u not in self.known]
        if new:
            if len(self.known) > KNOWN_UNITS:
                self.forget()
                new = distinct
            self._learn(new)
        at = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))[numbered.indices.to_numpy()]
        begin = self.unit_bounds[at]
        size = self.unit_bounds[at + 1] - begin
        ends = np.cumsum(size)
        place = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size - begin, size)
        bounds = np.concatenate([[0], np.cumsum(counts)])

        def per_text(values: np.ndarray) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(values.astype(np.int64))])
            return total[bounds[1:]] - total[bounds[:-1]]

        return (self.unit_ids[place], per_text(size), per_text(~self.unit_parity[at]) == 0,
                per_text(~self.unit_trip[at]) == 0)


@functools.cache
def _decoder(path: str):
    return build_tokenizer(load_model(path))


@functools.cache
def _codec(path: str, threads: int) -> Codec:
    return Codec(path, threads)


def _pieces_of(texts: Sequence[str | None]) -> Iterator[slice]:
    """Slices of a batch with at most about CHARS characters each."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= CHARS:
            yield slice(first, i + 1)
            first, size = i + 1, 0
    if first < len(texts):
        yield slice(first, len(texts))


ENCODED = [T.StructField("token_ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType()),
           T.StructField("round_trip", T.BooleanType()), T.StructField("parity", T.BooleanType())]


def encode(
    df: DataFrame, text: str = "text", model: str = DEFAULT_MODEL, threads: int = 2, decoded: str | None = None,
) -> DataFrame:
    """Add ``token_ids``, ``n_tokens``, ``round_trip`` and ``parity`` of each whole text.

    The ids are those of the rebuilt tokenizer. ``round_trip`` tells whether it
    decodes them to the normalised text, ``parity`` whether SentencePiece gives the same ids. A null text has null ids, 0 tokens and null checks;
    an empty one has no ids. The model file must be readable in the tasks.
    With ``decoded`` a column of that name gets the text that the ids decode to.
    Columns of these names are replaced.
    """
    require_text(df, text)

    def compute():
        codec = _codec(model, threads)

        def function(batch: pa.RecordBatch) -> list[pa.Array]:
            texts = batch.column(0).to_pylist()
            parts = [codec.encode([t or "" for t in texts[rows]]) for rows in _pieces_of(texts)]
            ids, sizes, parity, trip = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int32),) * 4
            none = pa.array([t is None for t in texts], pa.bool_())
            bounds = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            lists = pa.ListArray.from_arrays(bounds, pa.array(ids, pa.int32()), mask=none)
            missing = np.array([t is None for t in texts], bool)
            back = [] if decoded is None else [_texts(lists, model)]
            return [lists, pa.array(sizes, pa.int64()), pa.array(trip.astype(bool), mask=missing),
                    pa.array(parity.astype(bool), mask=missing), *back]
        function.done = codec.forget
        return function

    more = [] if decoded is None else [T.StructField(decoded, T.StringType())]
    return append_columns(df, [*ENCODED, *more], compute, [text])


def _texts(column: pa.Array, model: str) -> pa.Array:
    """Decoded texts; id lists become Python numbers, so only about TOKENS of them at a time."""
    size = len(load_model(model).pieces)

    def texts(lists: pa.Array) -> pa.Array:
        flat = lists.flatten()
        if len(flat) and (pc.min(flat).as_py() < 0 or pc.max(flat).as_py() >= size):
            raise ValueError("a token id is not in the vocabulary")
        found = [None if x is None else [i for i in x if i is not None] for x in lists.to_pylist()]
        back = _decoder(model).decode_batch([x or [] for x in found], skip_special_tokens=False)
        return pa.array([None if x is None else t for x, t in zip(found, back)], pa.string())

    parts, first, held = [], 0, 0
    for i, n in enumerate(pc.fill_null(pc.list_value_length(column), 0).to_pylist()):
        held += n
        if held >= TOKENS:
            parts.append(texts(column[first: i + 1]))
            first, held = i + 1, 0
    return pa.concat_arrays([*parts, texts(column[first:])])


def decode(df: DataFrame, ids: str = "token_ids", out: str = "text", model: str = DEFAULT_MODEL, threads: int = 2) -> DataFrame:
    """Add the text of each id list. A null list has a null text; a column named ``out`` is replaced.

    Null ids are skipped; ids outside the vocabulary raise an error; bytes that do
    not form UTF-8 become replacement characters.
    """
    require_columns(df, [ids])

    def compute():
        _threads(threads)
        return lambda batch: [_texts(batch.column(0), model)]

    return append_columns(df.withColumn(ids, F.col(ids).cast("array<int>")), [T.StructField(out, T.StringType())], compute, [ids])

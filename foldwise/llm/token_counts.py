"""Token counts under a unigram model, by dynamic programming shared over a trie.

A text is cut into pre-tokens before its spaces. The distinct pre-tokens that a
task has not met yet are sorted, which lists the paths of their trie depth
first; going from one to the next, the best scores of the shared prefix stay and
only the new letters are scored. The number of pieces at the end of each
pre-token is stored, and a text's count is the sum over its pre-tokens. Nothing
is shuffled: the work per task is its texts' words plus its own trie.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from foldwise.llm.pieces import DEFAULT_MODEL, MARK, NORMAL, UNIT, PieceModel, load_model
from foldwise.llm.shared import append_columns, require_text

KNOWN_CHARS = 20_000_000
#: fixed value of the model format: how far an unknown character is below the worst piece
UNKNOWN_PENALTY = 10.0


class TrieCounter:
    """Number of pieces of the best segmentation of each pre-token, kept for later texts."""

    def __init__(self, model: PieceModel):
        self.scores = {model.pieces[i]: model.scores[i] for i in model.ids_of(NORMAL)}
        self.longest = max(map(len, self.scores), default=0)
        self.by_end: dict[str, tuple[int, ...]] = {}
        ends: dict[str, set[int]] = {}
        for piece in self.scores:
            ends.setdefault(piece[-1], set()).add(len(piece))
        self.by_end = {c: tuple(sorted(sizes)) for c, sizes in ends.items()}
        self.unknown = min(self.scores.values(), default=0.0) - UNKNOWN_PENALTY
        self.byte_fallback = model.byte_fallback
        self.by_unit = model.splits_at_marks
        self.counts: dict[str, int] = {}
        self.size = 0

    def _unknown_pieces(self, c: str, before_unknown: bool) -> int:
        """Pieces of an unknown character; without byte fallback neighbours share one."""
        if self.byte_fallback:
            return len(c.encode("utf-8", "surrogatepass"))
        return 0 if before_unknown else 1

    def learn(self, units: Iterable[str]) -> None:
        """Count sorted distinct pre-tokens."""
        scores, by_end, counts = self.scores, self.by_end, self.counts
        # best score, number of pieces and whether the last one is unknown, per prefix of the current path
        best, pieces, last_unknown = [0.0], [0], [False]
        path = ""
        for unit in units:
            shared, most = 0, min(len(path), len(unit))
            while shared < most and path[shared] == unit[shared]:
                shared += 1
            del best[shared + 1:], pieces[shared + 1:], last_unknown[shared + 1:]
            for end in range(shared + 1, len(unit) + 1):
                c = unit[end - 1]
                top, n, unknown, single = None, 0, False, False
                for size in by_end.get(c, ()):
                    if size > end:
                        break
                    score = scores.get(unit[end - size: end])
                    if score is not None:
                        single = single or size == 1
                        score += best[end - size]
                        # the longer of equal segmentations' last pieces starts earlier and wins
                        if top is None or score >= top:
                            top, n = score, pieces[end - size] + 1
                if not single:
                    score = best[end - 1] + self.unknown
                    if top is None or score > top:
                        top, unknown = score, True
                        n = pieces[end - 1] + self._unknown_pieces(c, last_unknown[end - 1])
                best.append(top)
                pieces.append(n)
                last_unknown.append(unknown)
            counts[unit] = pieces[-1]
            self.size += len(unit)
            path = unit

    def count(self, texts: list[str]) -> list[int]:
        """Pieces of each text, which is already normalised."""
        split = [UNIT.findall(t) if self.by_unit else [t] for t in texts]
        new = {u for own in split for u in own if u not in self.counts}
        if new:
            if self.size > KNOWN_CHARS:
                self.counts, self.size = {}, 0
                new = {u for own in split for u in own}
            self.learn(sorted(new))
        lookup = self.counts.__getitem__
        return [sum(map(lookup, own)) for own in split]


@functools.cache
def _counter(path: str) -> TrieCounter:
    return TrieCounter(load_model(path))


def count_tokens(df: DataFrame, text: str = "text", model: str = DEFAULT_MODEL, out: str = "n_tokens") -> DataFrame:
    """Add the number of pieces of each whole text in its best segmentation by the stored piece scores.

    The scores are taken as unigram scores, as they stand in the model's file.
    Characters without a piece count as their UTF-8 bytes if the model has byte
    fallback, else runs of them as one. A null text has a null count, an empty
    one 0. A column named ``out`` is replaced.
    """
    require_text(df, text)
    parsed = load_model(model)
    if parsed.charsmap or parsed.remove_extra_whitespaces:
        raise ValueError("only models without a normalisation of their own can be counted")

    def compute():
        def function(batch: pa.RecordBatch) -> list[pa.Array]:
            counter = _counter(model)
            mark = MARK if parsed.add_dummy_prefix else ""
            texts = batch.column(0).to_pylist()
            out: list[int | None] = []
            for at in range(0, len(texts), 256):
                part = texts[at: at + 256]
                found = counter.count([mark + t.replace(" ", MARK) if t else "" for t in part])
                out += [None if t is None else n for t, n in zip(part, found)]
            return [pa.array(out, pa.int64())]
        return function

    return append_columns(df, [T.StructField(out, T.LongType())], compute, [text])

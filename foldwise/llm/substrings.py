"""Removal of repeated passages by seed and extend.

Seeds are winnowed anchors: of the ``anchor_words``-grams inside each window of
``min_words`` words the one with the smallest hash. Equal windows pick the same
anchor, so every repeat shares one. Windows in a row with one anchor form a run:
the anchor extended as far to the left and the right as its windows reach.

Runs are joined on the anchor. Where all runs of an anchor have equal words,
each one but the earliest repeats it entirely. Otherwise runs with equal words
are first reduced to the earliest of them, and only these representatives are
extended to the left and right one word at a time: each extension of
``min_words`` words is a key, and it is a repeat if the key occurs in an earlier
document or further up. Neighbouring repeats together are the maximal ones.

No pairs are formed: every step compares a row with one aggregated row of its
key, so a passage in a third of all documents costs its occurrences. The
aggregated rows are written and measured first; hot keys among them are
broadcast, so the rows of one key never gather in a task. Windows count as equal if
128 bits agree (the hashes of anchor and words); words are not compared again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.llm.shared import append_columns, materialise, require_columns, require_text, row_key, texts_of
from foldwise.llm.words import Rolling, hashed, mix
from foldwise.operators.lookup import attach, fit_lookup

CHUNK = 1 << 17
_RUNS = "did bigint, th bigint, tl int, start int, size int, anchor bigint, content bigint, again boolean"

#: no table is broadcast whole
SHUFFLED = -1


class Windows:
    """Runs and windows of sequences of word hashes."""

    def __init__(self, min_words: int, anchor_words: int):
        if not 1 <= anchor_words <= min_words < 1 << 15:
            raise ValueError("needs 1 <= anchor_words <= min_words < 32768")
        self.n, self.k = min_words, anchor_words
        self.grams, self.spans = Rolling(0xC2B2AE3D27D4EB4F), Rolling(0xA0761D6478BD642F)

    def _anchors(self, words: np.ndarray) -> np.ndarray:
        """Position of the anchor of each window; words must fit one chunk."""
        at = np.arange(len(words) - self.k + 1)
        # the low bits hold the position, so the leftmost of equal values is taken
        low = np.uint64((1 << 20) - 1)
        best = (self.grams.load(words).slices(at, at + self.k) & ~low) | at.astype(np.uint64)
        span, width = 1, self.n - self.k + 1
        while span * 2 <= width:
            best = np.minimum(best[:-span], best[span:])
            span *= 2
        if span < width:
            rest = width - span
            best = np.minimum(best[: len(best) - rest], best[rest:])
        return (best & low).astype(np.int64)

    def runs(self, bounds: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, ...]:
        """(sequence, start, size, anchor hash, content hash) of all runs; starts count from the sequence's begin."""
        out = []
        step = CHUNK
        for begin in range(0, max(1, len(words) - self.n + 1), step):
            part = words[begin: begin + step + self.n - 1]
            if len(part) < self.n:
                continue
            anchor = self._anchors(part)
            start = np.arange(len(anchor))
            owner = np.searchsorted(bounds, start + begin, side="right") - 1
            inside = start + begin + self.n <= bounds[owner + 1]
            start, anchor, owner = start[inside], anchor[inside], owner[inside]
            if not len(start):
                continue
            new = np.r_[True, (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])]
            first = np.flatnonzero(new)
            size = np.diff(np.r_[first, len(start)])
            seed = self.grams.slices(anchor[first], anchor[first] + self.k)
            content = self.spans.load(part).slices(start[first], start[first] + size + self.n - 1)
            out.append((owner[first], start[first] + begin - bounds[owner[first]], size, seed, content))
        if not out:
            return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
        return tuple(np.concatenate(x) for x in zip(*out))

    def window_hashes(self, words: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Hashes of the windows that start at the given places, in pieces of the sequence."""
        out = np.zeros(len(start), np.uint64)
        piece = start // CHUNK
        for p in np.unique(piece):
            own = piece == p
            at = start[own] - p * CHUNK
            self.spans.load(words[p * CHUNK: (p + 1) * CHUNK + self.n])
            out[own] = self.spans.slices(at, at + self.n)
        return out


def _seen_before(owner: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Whether an earlier entry of the same owner has the same keys; entries are in order."""
    if not len(owner):
        return np.zeros(0, bool)
    key = mix(owner.astype(np.uint64) + np.uint64(1))
    for k in keys:
        key = mix(key ^ k)
    order = np.argsort(key, kind="stable")
    same = np.zeros(len(key), bool)
    a, b = order[:-1], order[1:]
    equal = owner[a] == owner[b]
    for k in keys:
        equal &= k[a] == k[b]
    same[b] = equal
    return same


def _runs(df: DataFrame, key: str, text: str, windows: Windows) -> DataFrame:
    did, th = row_key(df, key, text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            lengths = batch.column(2).fill_null(0).to_numpy()
            for first, bounds, words in hashed(texts_of(batch.column(3))):
                owner, start, size, seed, content = windows.runs(bounds, words)
                again = _seen_before(owner, seed, content)
                # a repeat inside its document is settled; a key of its own keeps it from gathering anywhere
                seed = np.where(again, mix(content ^ (start.astype(np.uint64) << np.uint64(20)) ^ owner.astype(np.uint64)), seed)
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[first + owner]), pa.array(marks[first + owner]), pa.array(lengths[first + owner]),
                    pa.array(start.astype(np.int32)),
                    pa.array(size.astype(np.int32)), pa.array(seed.view(np.int64)), pa.array(content.view(np.int64)),
                    pa.array(again)], ["did", "th", "tl", "start", "size", "anchor", "content", "again"])

    return df.select(did.alias("did"), th.alias("th"), F.octet_length(text).alias("tl"), F.col(text).alias("text")).mapInArrow(run, _RUNS)


def _extensions(df: DataFrame, key: str, text: str, seeds: DataFrame, windows: Windows) -> DataFrame:
    """One row per window of the given runs: (did, th, tl, start, anchor, words, again)."""
    did, th = row_key(df, key, text)
    # rows that repeat id and text give the same seeds, each of which counts once
    lists = seeds.groupBy("did", "th", "tl").agg(F.collect_set(F.struct("start", "size", "anchor")).alias("seeds"))
    docs = df.select(did.alias("did"), th.alias("th"), F.octet_length(text).alias("tl"), F.col(text).alias("text"))
    # rows that repeat id and text are the same document here
    joined = docs.join(lists, ["did", "th", "tl"]).select("did", "th", "tl", "text", "seeds")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            lengths = batch.column(2).fill_null(0).to_numpy()
            lists = batch.column(4)
            offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            flat = lists.flatten()
            starts, sizes = flat.field("start").to_numpy(), flat.field("size").to_numpy()
            anchors = flat.field("anchor").to_numpy()
            for first, bounds, words in hashed(texts_of(batch.column(3))):
                for i in range(len(bounds) - 1):
                    own = slice(offsets[first + i], offsets[first + i + 1])
                    order = np.argsort(starts[own], kind="stable")
                    size = sizes[own][order].astype(np.int64)
                    begin = np.repeat(starts[own][order].astype(np.int64), size)
                    at = begin + np.arange(len(begin)) - np.repeat(np.cumsum(size) - size, size)
                    seed = np.repeat(anchors[own][order], size)
                    values = windows.window_hashes(words[bounds[i]: bounds[i + 1]], at)
                    again = _seen_before(np.zeros(len(at), np.int64), seed.view(np.uint64), values)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(at), ids[first + i])), pa.array(np.full(len(at), marks[first + i])),
                        pa.array(np.full(len(at), lengths[first + i])),
                        pa.array(at.astype(np.int32)), pa.array(seed), pa.array(values.view(np.int64)), pa.array(again),
                    ], ["did", "th", "tl", "start", "anchor", "words", "again"])

    return joined.mapInArrow(run, "did bigint, th bigint, tl int, start int, anchor bigint, words bigint, again boolean")


def repeated_windows(
    df: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = 20, anchor_words: int | None = None,
) -> DataFrame:
    """Rows (did, th, tl, start, size): ``size`` windows from word ``start`` on that repeat an earlier one."""
    require_text(df, text)
    require_columns(df, [key])
    windows = Windows(min_words, anchor_words or max(1, min_words * 2 // 5))
    runs = _runs(df, key, text, windows)
    # the tables below grow with the input, so rows meet them in one way at every size: shuffled, but for the hot keys
    shared = fit_lookup(
        runs.filter(~F.col("again")).groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("n"), F.min("content").alias("lo"), F.max("content").alias("hi"),
             F.min("did").alias("oldest"))
        .filter(F.col("n") > 1)
        .select("anchor", (F.col("lo") == F.col("hi")).alias("single"), "oldest", "n"), ["anchor"], ["single", "oldest"], rows="n")
    found = materialise(
        attach(runs, shared, ["anchor"], broadcast_bytes=SHUFFLED)
        .filter(F.col("again") | F.col("single").isNotNull())
        .withColumn("again", F.col("again") | (F.col("single") & (F.col("did") > F.col("oldest"))))
        .filter(F.col("again") | ~F.col("single"))
        .select("did", "th", "tl", "start", "size", "anchor", "content", "again"))
    spans = found.filter("again").select("did", "th", "tl", "start", "size")
    open_runs = found.filter(~F.col("again"))
    oldest = fit_lookup(open_runs.groupBy("anchor", "content").agg(F.min("did").alias("oldest"), F.count(F.lit(1)).alias("n")),
                        ["anchor", "content"], ["oldest"], rows="n")
    judged = materialise(attach(open_runs, oldest, broadcast_bytes=SHUFFLED).select(
        "did", "th", "tl", "start", "size", "anchor", (F.col("did") > F.col("oldest")).alias("again")))
    copies = judged.filter("again").select("did", "th", "tl", "start", "size")
    extended = materialise(_extensions(df, key, text, judged.filter(~F.col("again")), windows))
    first = fit_lookup(extended.filter(~F.col("again")).groupBy("anchor", "words").agg(
        F.count(F.lit(1)).alias("n"), F.min("did").alias("oldest")).filter(F.col("n") > 1), ["anchor", "words"], ["oldest"], rows="n")
    later = attach(extended, first, broadcast_bytes=SHUFFLED).filter(
        F.col("again") | (F.col("did") > F.col("oldest"))).select("did", "th", "tl", "start", F.lit(1).alias("size"))
    return spans.unionByName(copies).unionByName(later)


def _cover(starts: np.ndarray, sizes: np.ndarray, min_words: int, n: int) -> np.ndarray:
    """Which of n words are in a repeated window."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + sizes + min_words - 1, n), -1)
    return np.cumsum(change[:-1]) > 0


_FACTS = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
          T.StructField("repeats", T.ArrayType(T.ArrayType(T.LongType()))),
          T.StructField("kept_text", T.StringType()), T.StructField("kept_sha256", T.StringType())]


def drop_repeats(
    df: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = 20, anchor_words: int | None = None,
    outputs: Iterable[str] = ("n_words", "n_removed", "repeats", "kept_text"),
) -> DataFrame:
    """Add what is left of each text without passages that occur earlier.

    A window of ``min_words`` words is removed if the same words also start in a
    document with a smaller key or earlier in the same document; windows are
    judged on the input. Outputs: ``n_words``, ``n_removed``, ``repeats`` (maximal
    removed word ranges, [first, end)), ``kept_text`` (the text itself if nothing
    was removed, else the kept words joined by a space) and ``kept_sha256`` (of
    the kept words joined by a space).

    A null text has no words and stays null. A null key counts as the smallest.
    Documents with equal keys are of one age: none repeats another. Columns named
    like an output are replaced; other columns and the number of rows stay.
    """
    outputs = list(outputs)
    fields = [f for f in _FACTS if f.name in outputs]
    unknown = set(outputs) - {f.name for f in _FACTS}
    if unknown:
        raise ValueError(f"unknown outputs: {sorted(unknown)}")
    did, th = row_key(df, key, text)
    found = repeated_windows(df, key, text, min_words, anchor_words)
    lists = found.groupBy("did", "th", "tl").agg(F.collect_list(F.struct("start", "size")).alias("__spans"))
    lists = lists.select(F.col("did").alias("__did"), F.col("th").alias("__th"), F.col("tl").alias("__tl"), "__spans")
    rows = df.withColumns({"__l": did, "__h": th, "__n": F.octet_length(text)})
    same = (F.col("__l") == F.col("__did")) & (F.col("__h") == F.col("__th")) & (F.col("__n") == F.col("__tl"))
    rows = rows.join(lists, same, "left").drop("__did", "__th", "__tl", "__l", "__h", "__n")

    def compute():
        return lambda batch: _facts(batch, min_words, [f.name for f in fields])

    return append_columns(rows, fields, compute, [text, "__spans"]).drop("__spans")


def _facts(batch: pa.RecordBatch, min_words: int, outputs: list[str]) -> list[pa.Array]:
    columns: dict[str, list] = {name: [] for name in outputs}
    lists = batch.column(1)
    base = lists.offsets[0].as_py() if len(lists) else 0
    offsets, flat = lists.offsets.to_numpy() - base, lists.flatten()
    starts = flat.field("start").to_numpy().astype(np.int64)
    sizes = flat.field("size").to_numpy().astype(np.int64)
    for i, text in enumerate(texts_of(batch.column(0))):
        words = (text or b"").split()
        own = slice(offsets[i], offsets[i + 1])
        edges, kept = [], words
        if own.stop > own.start:
            gone = _cover(starts[own], sizes[own], min_words, len(words))
            edges = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8))).tolist()
            kept, at = [], 0
            for a, b in zip(edges[0::2], edges[1::2]):
                kept += words[at:a]
                at = b
            kept += words[at:]
        line = b" ".join(kept) if edges or "kept_sha256" in columns else b""
        for name, column in columns.items():
            if name == "n_words":
                column.append(len(words))
            elif name == "n_removed":
                column.append(len(words) - len(kept))
            elif name == "repeats":
                column.append([list(p) for p in zip(edges[0::2], edges[1::2])])
            elif name == "kept_text":
                column.append(line if edges else text)
            else:
                column.append(hashlib.sha256(line).hexdigest())
    kinds = {"n_words": pa.int64(), "n_removed": pa.int64(), "repeats": pa.list_(pa.list_(pa.int64())),
             "kept_sha256": pa.string()}
    return [pa.array(c, pa.binary()).cast(pa.string()) if name == "kept_text" else pa.array(c, kinds[name])
            for name, c in columns.items()]

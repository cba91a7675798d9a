"""SimHash near-duplicates, found by pigeonring filtering.

A fingerprint is cut into a ring of 4 x distance segments. If two fingerprints
differ in at most ``distance`` bits, some segment of the ring starts a chain
whose every prefix of l segments differs in at most l / 4 bits, rounded down:
nothing in the first three segments, at most one bit in the first seven, two in
the first eleven and so on. The first two budgets become join keys (the first
three segments and three of the next four), so only fingerprints that keep them
meet; the further budgets prune the pairs that met, and what is left is checked
for its full Hamming distance.

Equal fingerprints are one node from the start, so copies never form pairs. A
task handles one key at a time and emits at most one link per member. A key
with more than ``crowd`` distinct fingerprints is not paired: its members are
linked through the values halfway between them, which is exact too and linear
in the members.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.llm.components import connected_components
from foldwise.llm.shared import append_columns, materialise, no_rows, require_columns, require_text, texts_of
from foldwise.operators.lookup import attach, fit_lookup

SEED = 42
#: largest number of fingerprints of one key that are compared with each other
CROWD = 4096
ROWS = 1 << 16
PAIRS = 1 << 20
PIECE = 1 << 20
_LANES = np.uint64(0x0101010101010101)
_ALL = (1 << 64) - 1


def _shingle_hashes(text: bytes, size: int) -> Iterator[np.ndarray]:
    """Hashes of the word shingles of a lower-cased text, in pieces."""
    xxh, carry, at, any_yet = xxhash.xxh64_intdigest, [], 0, False
    while True:
        end = len(text)
        if end - at > PIECE:
            # a piece ends where no word is cut
            end = at + PIECE
            while end < len(text) and text[end] not in b" \t\n\r\x0b\x0c":
                end += 1
        words = carry + text[at:end].split()
        at = end
        last = at >= len(text)
        if len(words) >= size:
            line = b" ".join(words)
            ends = list(itertools.accumulate((len(w) + 1 for w in words)))
            starts = [0, *ends[:-1]]
            yield np.fromiter((xxh(line[a:b - 1], SEED) for a, b in zip(starts, ends[size - 1:])), np.uint64,
                              len(words) - size + 1)
            any_yet = True
            carry = words[len(words) - size + 1:]
        else:
            carry = words
        if last:
            if not any_yet and words:
                yield np.array([xxh(b" ".join(words), SEED)], np.uint64)
            return


def _bit_counts(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set, per slice of the hashes; slices are not empty.

    Bits 0, 8, 16, ... are counted together in the bytes of one word, at most 255
    hashes at a time.
    """
    bounds = np.append(starts, len(hashes))
    parts = [np.arange(a, b, 255) for a, b in zip(bounds[:-1], bounds[1:])]
    cuts = np.concatenate(parts)
    owner = np.cumsum([0, *map(len, parts)])[:-1]
    counts = np.empty((len(starts), 64), np.int64)
    for j in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(j)) & _LANES, cuts)
        each = lanes.view(np.uint8).reshape(-1, 8).astype(np.int64)
        counts[:, j::8] = np.add.reduceat(each, owner, axis=0)
    return counts


def fingerprint_values(texts: Iterable[bytes | None], shingle: int) -> np.ndarray:
    """64-bit fingerprints; a text without words has fingerprint zero."""
    texts = list(texts)
    out = np.zeros(len(texts), np.uint64)
    held, rows, total = [], [], 0

    def settle(counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        bits = counts * 2 > sizes[:, None]
        return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)[:, 0]

    def flush() -> None:
        sizes = np.array([len(h) for h in held])
        starts = np.cumsum(sizes) - sizes
        out[rows] = settle(_bit_counts(np.concatenate(held), starts), sizes)

    for i, text in enumerate(texts):
        if not text:
            continue
        pieces = _shingle_hashes(text.lower(), shingle)
        first = next(pieces, None)
        if first is None:
            continue
        more = next(pieces, None)
        if more is not None:
            counts, n = np.zeros((1, 64), np.int64), 0
            for piece in itertools.chain([first, more], pieces):
                counts += _bit_counts(piece, np.zeros(1, np.int64))
                n += len(piece)
            out[i] = settle(counts, np.array([n]))[0]
            continue
        held.append(first)
        rows.append(i)
        total += len(first)
        if total >= 1 << 18:
            flush()
            held, rows, total = [], [], 0
    if held:
        flush()
    return out


def fingerprints(df: DataFrame, text: str = "text", shingle: int = 4, out: str = "fingerprint") -> DataFrame:
    """Add the fingerprint of each whole text as a signed 64-bit number.

    A-Z is lower-cased, words are runs of bytes other than white space, and a
    shingle is ``shingle`` words joined by a space; a shorter text is one
    shingle. Bit i is set if it is set in more than half of the shingles' XXH64
    hashes. Null, empty and blank texts have fingerprint zero. A column named
    ``out`` is replaced.
    """
    require_text(df, text)
    if shingle < 1:
        raise ValueError("shingle must be at least 1")

    def compute():
        return lambda batch: [pa.array(
            fingerprint_values(texts_of(batch.column(0)), shingle).view(np.int64), pa.int64())]

    return append_columns(df, [T.StructField(out, T.LongType())], compute, [text])


def hex_text(fingerprint: Column) -> Column:
    """16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


class Ring:
    """Segments and budgets for a number of bits that may differ."""

    def __init__(self, distance: int):
        if not 1 <= distance <= 16:
            raise ValueError("the bit distance must be from 1 to 16")
        self.distance, self.n = distance, 4 * distance
        self.bounds = [64 * i // self.n for i in range(self.n + 1)]

    def _span(self, start: int, first: int, last: int) -> int:
        """Bits of segments first..last-1 of the chain from ``start``, after rotating it to the top."""
        mask, at = 0, 64
        for j in range(self.n):
            i = (start + j) % self.n
            width = self.bounds[i + 1] - self.bounds[i]
            at -= width
            if first <= j < last:
                mask |= ((1 << width) - 1) << at
        return mask

    def turn(self, start: int) -> int:
        """Left rotation that brings segment ``start`` to the top; segment 0 is the topmost."""
        return self.bounds[start]

    def key_masks(self) -> list[tuple[int, int, int]]:
        """(start, number left out, mask): three segments and three of the next four."""
        out = []
        for start in range(self.n):
            whole = self._span(start, 0, min(7, self.n))
            for skipped in range(3, min(7, self.n)):
                out.append((start, skipped - 3, whole & ~self._span(start, skipped, skipped + 1)))
        return out

    def budgets(self, start: int) -> list[tuple[int, int]]:
        """(mask, most bits) of the chain's prefixes that end just before a budget grows."""
        ends = [min(4 * (b + 1) - 1, self.n) for b in range(1, self.distance)]
        return [(self._span(start, 0, e), b) for b, e in enumerate(ends, start=1)]

    def masks_within(self, radius: int) -> list[tuple[int, int]]:
        """(mask, bits) of all changes of at most ``radius`` bits."""
        return [(sum(1 << b for b in bits), r) for r in range(radius + 1)
                for bits in itertools.combinations(range(64), r)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _keys(ring: Ring, value: str) -> Column:
    """All join keys of a fingerprint as an array of (chain start, key)."""
    v = F.col(value)
    out = []
    for start, skipped, mask in ring.key_masks():
        turn = ring.turn(start)
        turned = v if not turn else F.shiftleft(v, turn).bitwiseOR(F.shiftrightunsigned(v, 64 - turn))
        out.append(F.struct(F.lit(start * 4 + skipped).cast("smallint").alias("chain"),
                            turned.bitwiseAND(F.lit(_signed(mask))).alias("key")))
    return F.array(*out)


def _rotate(values: np.ndarray, turn: np.ndarray) -> np.ndarray:
    return (values << turn) | (values >> ((np.uint64(64) - turn) & np.uint64(63)))


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union of linked positions; every label is the smallest position of its set."""
    while True:
        one, two = label[a], label[b]
        apart = one != two
        if not apart.any():
            return label
        a, b, one, two = a[apart], b[apart], one[apart], two[apart]
        np.minimum.at(label, np.maximum(one, two), np.minimum(one, two))
        while not (label == label[label]).all():
            label = label[label]


def _links(chain: np.ndarray, key: np.ndarray, value: np.ndarray, ring: Ring) -> tuple[np.ndarray, np.ndarray]:
    """Links inside groups of equal (chain, key); each member is linked to at most one other.

    Rows are compared with those 1, 2, 3, ... places further on. At most about
    ``PAIRS`` links are held before they are merged into the labels.
    """
    n = len(key)
    start = chain // 4
    turn = np.array([ring.turn(i) for i in range(ring.n)], np.uint64)[start]
    steps = [ring.budgets(i) for i in range(ring.n)]
    budgets = [(np.array([own[j][0] for own in steps], np.uint64), steps[0][j][1]) for j in range(ring.distance - 1)]
    label, left, right, held = np.arange(n), [], [], 0
    here, step = np.arange(n), 0
    while len(here):
        step += 1
        here = here[here + step < n]
        here = here[(key[here] == key[here + step]) & (chain[here] == chain[here + step])]
        at = here
        change = value[at] ^ value[at + step]
        turned = _rotate(change, turn[at])
        for masks, most in budgets:
            keeps = np.bitwise_count(turned & masks[start[at]]) <= most
            at, change, turned = at[keeps], change[keeps], turned[keeps]
        at = at[np.bitwise_count(change) <= ring.distance]
        left.append(at)
        right.append(at + step)
        held += len(at)
        if held > PAIRS or not len(here):
            label = _merge(label, np.concatenate(left), np.concatenate(right))
            left, right, held = [], [], 0
    moved = np.flatnonzero(label != np.arange(n))
    return value[label[moved]], value[moved]


def _pair_groups(batches: Iterable[pa.RecordBatch], ring: Ring, crowd: int) -> Iterator[pa.RecordBatch]:
    """Links of rows sorted by (chain, key); a crowded key's members come out alone, with no partner."""
    names = ["a", "b"]

    def send(a: np.ndarray, b: np.ndarray | None) -> pa.RecordBatch:
        right = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b.view(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), right], names)

    def settle(rows) -> Iterator[pa.RecordBatch]:
        chain, key, value = rows
        if not len(key):
            return
        new = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (chain[1:] != chain[:-1])])
        size = np.repeat(np.diff(np.r_[new, len(key)]), np.diff(np.r_[new, len(key)]))
        crowded = size > crowd
        if crowded.any():
            yield send(value[crowded], None)
        few = (size > 1) & ~crowded
        a, b = _links(chain[few], key[few], value[few], ring)
        if len(a):
            yield send(a, b)

    empty = (np.zeros(0, np.int16), np.zeros(0, np.int64), np.zeros(0, np.uint64))
    held, open_crowd = empty, None
    for batch in batches:
        rows = (batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy().view(np.uint64))
        for at in range(0, len(rows[1]), ROWS):
            part = tuple(x[at: at + ROWS] for x in rows)
            if open_crowd is not None:
                # the rest of a crowded key passes without being kept
                own = (part[0] == open_crowd[0]) & (part[1] == open_crowd[1])
                if own.any():
                    yield send(part[2][own], None)
                part = tuple(x[~own] for x in part)
                if own.all():
                    continue
                open_crowd = None
            held = tuple(np.concatenate(x) for x in zip(held, part))
            last = (held[1] == held[1][-1]) & (held[0] == held[0][-1])
            yield from settle(tuple(x[~last] for x in held))
            held = tuple(x[last] for x in held)
            if len(held[1]) > crowd:
                yield send(held[2], None)
                open_crowd, held = (held[0][0], held[1][0]), empty
    yield from settle(held)


def near_pairs(values: DataFrame, value: str = "fingerprint", distance: int = 4, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) that connect all distinct values which differ in at most ``distance`` bits.

    Two values have a path of links exactly if they have a path of such pairs;
    links themselves are such pairs or, for crowded keys, paths of two of them.
    """
    require_columns(values, [value])
    ring = Ring(distance)
    distinct = values.filter(F.col(value).isNotNull()).select(F.col(value).cast("bigint").alias("v")).distinct()
    # few bytes now, but each value becomes many rows: keep them spread over the tasks
    tasks = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = distinct.repartition(tasks, "v").select(F.explode(_keys(ring, "v")).alias("k"), "v").select("k.chain", "k.key", "v")
    grouped = keyed.repartition("chain", "key").sortWithinPartitions("chain", "key", "v")
    found = materialise(grouped.mapInArrow(lambda batches: _pair_groups(batches, ring, crowd), "a bigint, b bigint").distinct())
    pairs = found.filter(F.col("b").isNotNull())
    crowded = found.filter(F.col("b").isNull()).select("a").distinct()
    if no_rows(crowded):
        return pairs
    changes = ring.masks_within((distance + 1) // 2)
    # a fixed number of changes (2,081 for four bits), independent of the data
    masks = F.broadcast(values.sparkSession.createDataFrame(
        [(_signed(m), r) for m, r in changes], "mask bigint, r int"))
    halfway = crowded.join(masks).select(F.col("a"), F.col("a").bitwiseXOR(F.col("mask")).alias("mid"), "r")
    centre = halfway.groupBy("mid").agg(F.min(F.struct("r", "a")).alias("c"))
    through = halfway.join(centre, "mid").filter(
        (F.col("a") != F.col("c.a")) & (F.col("r") + F.col("c.r") <= distance))
    return pairs.union(through.select(F.col("c.a").alias("a"), F.col("a").alias("b"))).distinct()


def _grouped(df: DataFrame, key: str, text: str, shingle: int, distance: int) -> tuple[DataFrame, DataFrame]:
    """Rows (key, text hash, fingerprint) and, per fingerprint, the root of its group and its smallest key."""
    rows = df.select(F.col(key).alias("key"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"))
    marked = materialise(fingerprints(rows, "text", shingle, "fingerprint").select("key", "hash", "fingerprint"))
    # null keys come last
    first = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "hash")).alias("first")
    least = materialise(marked.groupBy("fingerprint").agg(first))
    roots = materialise(connected_components(near_pairs(least, "fingerprint", distance)))
    member = roots.select(F.col("node").alias("fingerprint"), "root")
    known = least.join(member, "fingerprint", "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root"))
    return marked, known


def near_duplicate_groups(
    df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4, distance: int = 4,
) -> DataFrame:
    """Rows (key, fingerprint, component_id, group) of all documents.

    ``component_id`` is the smallest key that can be reached over fingerprints
    with at most ``distance`` differing bits, the document's own included. It names one
    group where keys are unique; if texts that are not linked share a key, only ``group`` (the
    smallest fingerprint of the group, as a signed number) tells their groups apart.
    Documents with equal fingerprints are always linked, also those without
    words. Null keys are kept; they are the component's id only where it has no
    other. Repeated rows give repeated rows; an empty table gives none.
    """
    require_columns(df, [key])
    marked, known = _grouped(df, key, text, shingle, distance)
    smallest = known.groupBy("root").agg(F.min("first").alias("least"))
    sizes = marked.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n"))
    named = known.join(smallest, "root").join(sizes, "fingerprint").select(
        "fingerprint", F.col("least.key").alias("component_id"), F.col("root").alias("group"), "n")
    # a row per fingerprint: it grows with the documents, so only hot fingerprints are broadcast
    found = attach(marked, fit_lookup(named, ["fingerprint"], ["component_id", "group"], rows="n"), broadcast_bytes=-1)
    return found.select(F.col("key").alias(key), "fingerprint", "component_id", "group")


def drop_near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4, distance: int = 4,
) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest key.

    All columns are kept. Null keys come last; of documents with equal keys the
    one with the smallest text hash stays, and of rows that repeat key and text
    one stays.
    """
    require_columns(df, [key])
    _, known = _grouped(df, key, text, shingle, distance)
    chosen = known.groupBy("root").agg(F.min("first").alias("least")).select(
        F.col("least.key").alias("__key"), F.col("least.hash").alias("__hash"))
    rows = df.withColumn("__text_hash", F.xxhash64(text))
    kept = rows.join(chosen, F.col(key).eqNullSafe(F.col("__key")) & (F.col("__text_hash") == F.col("__hash")), "left_semi")
    return kept.dropDuplicates([key, "__text_hash"]).drop("__text_hash")

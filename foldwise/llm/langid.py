"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text's subwords are its runs of two to four letters, the ends of words
included; each has a row in a table of ``buckets`` embeddings by its hash. The
mean of a text's rows goes through a linear layer and a softmax. Both are
trained by stochastic gradient descent in numpy on a bounded sample of labelled
rows. A part of the sample is held back to fit the temperature of the softmax,
so that scores are probabilities, and the score below which an answer is
rejected. For prediction the table and the layer are multiplied once, which
leaves one row of class weights per bucket.

Features of the sample are counted in tasks; the driver gets at most
``per_language`` x ``max_languages`` sparse rows of at most ``buckets`` entries.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.llm.shared import append_columns, materialise, require_columns, require_text

SIZES = (2, 3, 4)
BLOCK = 1 << 17
UNDETERMINED = "und"


@functools.cache
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def _codes(text: str) -> Iterator[np.ndarray]:
    """Lower-cased letters as code points, anything else as zero, with a zero at both ends.

    Each piece has ``BLOCK`` places of its own and those that its last subwords reach.
    """
    lowered, reach = text.lower(), max(SIZES) - 1
    for at in range(0, len(lowered) + 2, BLOCK):
        piece = lowered[max(0, at - 1): at - 1 + BLOCK + reach]
        codes = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        codes[~_letters()[codes]] = 0
        if at - 1 + BLOCK + reach > len(lowered):
            codes = np.append(codes, np.uint64(0))
        yield codes if at else np.insert(codes, 0, 0)


def gram_buckets(codes: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of the subwords that start in the first ``BLOCK`` places of a piece."""
    out = []
    for size in SIZES:
        n = min(BLOCK, len(codes) - size + 1)
        if n <= 0:
            continue
        value = np.full(n, size, np.uint64)
        inside = (codes[:n] > 0) | (codes[1: n + 1] > 0)
        for j in range(size):
            letter = codes[j: j + n]
            value = (value ^ letter) * np.uint64(0x9E3779B97F4A7C15)
            value ^= value >> np.uint64(29)
            if 0 < j < size - 1:
                inside &= letter > 0
        out.append((value[inside] % np.uint64(buckets)).astype(np.int64))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _pieces(text: str, buckets: int) -> Iterator[np.ndarray]:
    """Buckets of all subwords of a text, piece by piece."""
    return (gram_buckets(codes, buckets) for codes in _codes(text))


def text_counts(text: str | None, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a whole text and how often each occurs."""
    total: np.ndarray | None = None
    for found in _pieces(text or "", buckets):
        counts = np.bincount(found, minlength=buckets)
        total = counts if total is None else total + counts
    at = np.flatnonzero(total)
    return at, total[at]


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


@dataclass
class LanguageModel:
    """Class weights per bucket; scores are softmax(mean + bias) at the fitted temperature."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float

    @property
    def buckets(self) -> int:
        return len(self.weights)

    def logits(self, text: str) -> np.ndarray:
        total, n = np.zeros(len(self.languages)), 0
        for found in _pieces(text, self.buckets):
            total += self.weights[found].sum(axis=0, dtype=np.float64)
            n += len(found)
        return total / max(1, n) + self.bias

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score and whether the score is above the threshold of rejection."""
        if not self.languages or not has_letter(text):
            return UNDETERMINED, 0.0, False
        p = _softmax(self.logits(text)[None, :] / self.temperature)[0]
        best = int(np.argmax(p))
        return self.languages[best], float(p[best]), bool(p[best] >= self.threshold)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class _Bags:
    """Sparse rows of bucket shares."""

    def __init__(self, rows: Sequence[tuple[np.ndarray, np.ndarray]]):
        self.at = [r[0] for r in rows]
        self.share = [(r[1] / r[1].sum()).astype(np.float32) if len(r[1]) else r[1].astype(np.float32) for r in rows]

    def take(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = np.array([len(self.at[i]) for i in chosen])
        return (np.concatenate([self.at[i] for i in chosen]), np.concatenate([self.share[i] for i in chosen]),
                np.repeat(np.arange(len(chosen)), sizes))

    def means(self, table: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        out = np.zeros((len(chosen), table.shape[1]), np.float32)
        for row, i in enumerate(chosen):
            out[row] = self.share[i] @ table[self.at[i]]
        return out


def train(
    rows: Sequence[tuple[np.ndarray, np.ndarray]], labels: Sequence[str], held: Sequence[bool], buckets: int,
    dims: int = 16, epochs: int = 6, batch: int = 32, rate: float = 2.0, precision: float = 0.99, seed: int = 7,
) -> LanguageModel:
    """Fit embeddings, layer, temperature and threshold to sparse rows.

    ``held`` marks the rows that calibrate; without any the training rows do.
    """
    languages = sorted(set(labels))
    if not languages:
        return LanguageModel([], np.zeros((buckets, 0), np.float32), np.zeros(0), 1.0, 1.0)
    y = np.array([languages.index(label) for label in labels])
    held = np.asarray(held, bool)
    fit, test = np.flatnonzero(~held), np.flatnonzero(held)
    if not len(fit) or set(y[fit]) != set(y):
        fit = np.arange(len(y))
    if not len(test):
        test = fit
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 1 / dims, (buckets, dims)).astype(np.float32)
    layer, bias = rng.normal(0, 1 / dims, (dims, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32)
    bags = _Bags(rows)
    steps, done = epochs * -(-len(fit) // batch), 0
    for _ in range(epochs):
        order = rng.permutation(fit)
        for start in range(0, len(order), batch):
            chosen = order[start: start + batch]
            pace = rate * (1 - done / steps)
            done += 1
            mean = bags.means(table, chosen)
            gap = _softmax(mean @ layer + bias)
            gap[np.arange(len(chosen)), y[chosen]] -= 1
            gap /= len(chosen)
            back = gap @ layer.T
            layer -= pace * (mean.T @ gap)
            bias -= pace * gap.sum(axis=0)
            # the mean's gradient is thin over so many rows; buckets learn at a rate of their own
            for row, i in enumerate(chosen):
                table[bags.at[i]] -= (pace * len(chosen) * 8) * bags.share[i][:, None] * back[row]
    logits = np.concatenate([bags.means(table, part) @ layer + bias for part in np.array_split(test, -(-len(test) // 256))])
    temperature = _temperature(logits, y[test])
    p = _softmax(logits / temperature)
    return LanguageModel(languages, (table @ layer).astype(np.float32), bias.astype(np.float64), temperature,
                         _threshold(p.max(axis=1), p.argmax(axis=1) == y[test], precision))


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the smallest loss on the held-back rows."""
    grid = np.geomspace(0.05, 20, 121)
    loss = [-np.log(np.maximum(_softmax(logits / t)[np.arange(len(y)), y], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def _threshold(score: np.ndarray, right: np.ndarray, precision: float) -> float:
    """The smallest score from which on the answers reach the precision."""
    order = np.argsort(-score, kind="stable")
    share = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(share >= precision)
    return float(score[order[good[-1]]]) if len(good) else 1.0


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds and numbers of a column of lists."""
    whole = column.combine_chunks()
    return whole.offsets.to_numpy(), whole.values.to_numpy()


def fit_language_model(
    df: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id", usable: Column | None = None,
    per_language: int = 800, max_languages: int = 500, buckets: int = 1 << 15, hold_back: float = 0.2,
    precision: float = 0.99, seed: int = 7, max_entries: int = 20_000_000,
) -> LanguageModel:
    """Train on a sample of about ``per_language`` rows of each language.

    The sample is thinned out evenly, again by hash, where it has more than about ``max_entries`` counted subwords (8 bytes
    each on the driver).

    Rows are chosen by a hash of the key, so any partitioning gives the same
    sample. Rows with a null text, label or key, without letters, or outside
    ``usable`` are not used. Whole texts are counted. More than
    ``max_languages`` labels raise an error. Without rows the model knows no
    language and answers 'und'.
    """
    require_text(df, text, label)
    require_columns(df, [key])
    rows = df.filter(F.col(text).isNotNull() & F.col(label).isNotNull() & F.col(key).isNotNull())
    if usable is not None:
        rows = rows.filter(usable)
    # one short row per label
    sizes = {r[0]: r[1] for r in rows.groupBy(label).count().limit(max_languages + 1).collect()}
    if len(sizes) > max_languages:
        raise ValueError(f"more than {max_languages} labels")
    if not sizes:
        return train([], [], [], buckets)
    share = F.create_map(*[x for name, n in sorted(sizes.items()) for x in (F.lit(name), F.lit(min(1.0, per_language / n)))])
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 30)) / F.lit(1 << 30)
    chosen = rows.withColumn("__draw", draw).filter(F.col("__draw") < share[F.col(label)])
    sample = chosen.select(F.col(key).cast("string").alias("key"), F.col(label).alias("label"), F.col(text).alias("text"),
                           (F.pmod(F.xxhash64(F.lit(seed + 1), F.col(key)), F.lit(1 << 20)) < int(hold_back * (1 << 20))).alias("held"))

    def compute():
        def function(batch: pa.RecordBatch) -> list[pa.Array]:
            found = [text_counts(t, buckets) for t in batch.column(0).to_pylist()]
            return [pa.array([f[0].astype(np.int32) for f in found], pa.list_(pa.int32())),
                    pa.array([f[1].astype(np.int32) for f in found], pa.list_(pa.int32()))]
        return function

    fields = [T.StructField("at", T.ArrayType(T.IntegerType())), T.StructField("n", T.ArrayType(T.IntegerType()))]
    counted = append_columns(sample, fields, compute, ["text"]).select("key", "label", "held", "at", "n")
    drawn = materialise(counted.filter(F.size("at") > 0))
    entries = drawn.agg(F.sum(F.size("at"))).first()[0] or 0
    if entries > max_entries:
        again = F.pmod(F.xxhash64(F.lit(seed + 2), F.col("key")), F.lit(1 << 30))
        drawn = drawn.filter(again < int(max_entries / entries * (1 << 30)))
    found = drawn.toArrow().sort_by([("key", "ascending"), ("label", "ascending")])
    (bounds, at), (_, n) = (_flat(found[c]) for c in ("at", "n"))
    bags = [(at[a:b], n[a:b]) for a, b in zip(bounds, bounds[1:])]
    return train(bags, found["label"].to_pylist(), found["held"].to_pylist(), buckets, precision=precision, seed=seed)


PREDICTED = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
             T.StructField("accepted", T.BooleanType())]


def identify(df: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``accepted`` for each whole text.

    ``lang_pred`` is the likeliest language, 'und' with score 0 if the text is
    null or has no letter; ``accepted`` is false where the score is too low to
    be right as often as the model's precision asks. Ties go to the first
    language by name. Columns of these names are replaced.
    """
    require_text(df, text)
    # buckets x languages numbers, bounded by the parameters of the fit
    sent = df.sparkSession.sparkContext.broadcast(model)

    def compute():
        def function(batch: pa.RecordBatch) -> list[pa.Array]:
            found = [sent.value.predict(t) for t in batch.column(0).to_pylist()]
            names, scores, accepted = zip(*found) if found else ((), (), ())
            return [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(accepted, pa.bool_())]
        return function

    return append_columns(df, PREDICTED, compute, [text])

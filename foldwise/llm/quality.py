"""Quality classification from weak labels.

Heuristic labellers vote good, bad or nothing on each text. The votes of all
documents are counted by pattern (at most 3 to the number of labellers), and
expectation-maximisation over these counts estimates how often each labeller is
right on good and on bad texts, without any true label. The posterior of a
pattern is a soft label; on a bounded sample of documents these labels train a
linear scorer over hashed features, which then scores every whole text.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.llm.shared import append_columns, materialise, require_columns, require_text, texts_of

GOOD, BAD, NO_VOTE = 1, 0, -1
#: (measure, good up to, bad from): between the two, and where a text is too short for the measure, no vote
LABELLERS = (
    ("symbols", 0.03, 0.10),      # signs of markup and money among the bytes that are not white space
    ("capitals", 0.20, 0.50),     # capitals among the ASCII letters
    ("echoes", 0.03, 0.15),       # words equal to the word before
    ("top_word", 0.15, 0.30),     # share of the most frequent word
    ("bars", 0.01, 0.08),         # words with a table bar
    ("shouts", 0.03, 0.20),       # words that end in an exclamation mark
    ("long_words", 0.02, 0.20),   # words of more than 40 bytes
    ("line_copies", 0.20, 0.50),  # lines that repeat an earlier line
    ("odd_words", 0.15, 0.40),    # words that are not letters or digits with at most one closing mark
    ("run_copies", 0.30, 0.50),   # runs of five words that occurred before in the text
)
MEASURES = tuple(name for name, _, _ in LABELLERS)
LEAST_WORDS = 8
RUN = 5
#: share of the votes cast that is added as expected right votes on good texts
TRUST = 0.05
BINS = 12
BLOCK = 1 << 18

_SYMBOLS = b"#$%&*<>{}[]=_^~\\|@+`"
_PLAIN = re.compile(rb"(?<![^ \t\n\r\x0b\x0c])[A-Za-z0-9\x80-\xff][A-Za-z0-9\x80-\xff'-]*[.,;:?!]?(?![^ \t\n\r\x0b\x0c])")
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_WHITE = b" \t\n\r\x0b\x0c"
#: byte -> class of its shape; letters beyond ASCII count as small letters
_SHAPE = bytes(
    97 if 97 <= c <= 122 or c >= 128 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else 32 if c in _WHITE else c
    for c in range(256))


def _share(part: float, whole: float, least: float) -> float:
    return part / whole if whole >= least else float("nan")


def measures(text: bytes | None) -> list[float]:
    """The measures of a whole text, NaN where it is too short for one."""
    text = text or b""
    words = text.split()
    n = len(words)
    runs = max(0, n - RUN + 1)
    solid = len(text.translate(None, _WHITE))
    signs = solid - len(text.translate(None, _WHITE + _SYMBOLS))
    upper = len(text) - len(text.translate(None, _UPPER))
    letters = upper + len(text) - len(text.translate(None, _LOWER))
    top = max(Counter(words).values(), default=0)
    lines = [x for x in text.split(b"\n") if x.strip()]
    return [
        _share(signs, solid, LEAST_WORDS * 4), _share(upper, letters, LEAST_WORDS * 4),
        _share(sum(map(eq, words, words[1:])), n - 1, LEAST_WORDS), _share(top, n, 4 * LEAST_WORDS),
        _share(sum(b"|" in w for w in words) if b"|" in text else 0, n, LEAST_WORDS),
        _share(sum(w.endswith(b"!") for w in words) if b"!" in text else 0, n, LEAST_WORDS),
        _share(sum(len(w) > 40 for w in words), n, LEAST_WORDS),
        _share(len(lines) - len(set(lines)), len(lines), 4),
        _share(n - len(_PLAIN.findall(text)), n, LEAST_WORDS),
        # prose of any length hardly repeats five words in a row, so one rule holds for all lengths
        _share(runs - len(set(zip(*[words[i:] for i in range(RUN)]))), runs, LEAST_WORDS),
    ]


def votes(values: Sequence[float]) -> list[int]:
    return [NO_VOTE if v != v else GOOD if v <= good else BAD if v >= bad else NO_VOTE
            for v, (_, good, bad) in zip(values, LABELLERS)]


@dataclass
class LabelModel:
    """Prior share of good texts and, per labeller, how often a vote is right on good and on bad texts."""

    prior: float
    right_on_good: list[float]
    right_on_bad: list[float]

    def posterior(self, given: Sequence[int]) -> float:
        """Probability that a text with these votes is good."""
        good, bad = np.log(self.prior), np.log1p(-self.prior)
        for vote, g, b in zip(given, self.right_on_good, self.right_on_bad):
            if vote == GOOD:
                good, bad = good + np.log(g), bad + np.log1p(-b)
            elif vote == BAD:
                good, bad = good + np.log1p(-g), bad + np.log(b)
        return float(1 / (1 + np.exp(np.clip(bad - good, -700, 700))))


def fit_label_model(patterns: Sequence[Sequence[int]], counts: Sequence[int], rounds: int = 200, trust: float = TRUST) -> LabelModel:
    """Expectation-maximisation over counted vote patterns, begun at the majority of votes.

    A missing vote says nothing. Labellers are expected not to call a good text
    bad: ``trust`` times the votes cast, and 20 more, are added to that side, 99.5 % of them
    right. Without patterns they keep that expectation.
    """
    m = len(LABELLERS)
    v = np.asarray(patterns, np.int64).reshape(-1, m)
    n = np.asarray(counts, np.float64)
    good, bad = v == GOOD, v == BAD
    cast = good.sum(axis=1) + bad.sum(axis=1)
    # one bad vote outweighs its absence: a text is junk by any one of the kinds of junk
    q = np.where(cast == 0, 0.9, np.where(bad.any(axis=1), 0.1, 0.95))
    prior, on_good, on_bad = 0.9, np.full(m, 0.95), np.full(m, 0.3)
    added = 20 + trust * (n @ (good | bad))
    for _ in range(rounds):
        g, b = n * q, n * (1 - q)
        prior = float(np.clip((g.sum() + 9) / (n.sum() + 10), 0.01, 0.99))
        on_good = np.clip((g @ good + 0.995 * added) / (g @ (good | bad) + added), 0.5, 0.999)
        on_bad = np.clip((b @ bad + 1) / (b @ (good | bad) + 2), 0.01, 0.99)
        model = LabelModel(prior, on_good.tolist(), on_bad.tolist())
        new = np.array([model.posterior(row) for row in v]) if len(v) else q
        if len(v) == 0 or np.abs(new - q).max() < 1e-9:
            break
        q = new
    return LabelModel(prior, on_good.tolist(), on_bad.tolist())


def features(text: bytes | None, values: Sequence[float], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features: the bin of each measure, and the share of each run of three shape classes."""
    text = text or b""
    at, weight = [], []
    for j, v in enumerate(values):
        bin_ = BINS if v != v else min(BINS - 1, int(np.sqrt(v) * BINS))
        at.append((j * 131 + bin_ * 7919 + 17) % buckets)
        weight.append(0.5)
    counts = np.zeros(buckets, np.int64)
    for begin in range(0, len(text), BLOCK):
        shape = np.frombuffer(text[begin: begin + BLOCK + 2].translate(_SHAPE), np.uint8).astype(np.uint32)
        if len(shape) > 2:
            code = (shape[:-2] << 16) | (shape[1:-1] << 8) | shape[2:]
            counts += np.bincount((code * np.uint32(2654435761) >> np.uint32(8)) % np.uint32(buckets), minlength=buckets)
    used = np.flatnonzero(counts)
    share = np.sqrt(counts[used] / max(1, counts.sum()))
    return np.concatenate([np.array(at, np.int64), used]), np.concatenate([weight, share])


@dataclass
class QualityModel:
    labels: LabelModel
    weights: np.ndarray
    bias: float
    threshold: float = 0.5

    def score(self, text: bytes | None, values: Sequence[float]) -> float:
        at, weight = features(text, values, len(self.weights))
        z = float(self.weights[at] @ weight) + self.bias
        return float(1 / (1 + np.exp(np.clip(-z, -700, 700))))


def train_scorer(
    rows: Sequence[tuple[np.ndarray, np.ndarray]], targets: Sequence[float], buckets: int, epochs: int = 12,
    rate: float = 0.5, decay: float = 1e-6, seed: int = 11,
) -> tuple[np.ndarray, float]:
    """Logistic regression on soft targets by stochastic gradient descent with per-weight rates."""
    w, bias = np.zeros(buckets), 0.0
    size, bias_size = np.full(buckets, 1e-6), 1e-6
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at, x = rows[i]
            z = np.clip(w[at] @ x + bias, -30, 30)
            gap = 1 / (1 + np.exp(-z)) - targets[i]
            step = gap * x + decay * w[at]
            np.add.at(size, at, step * step)
            np.add.at(w, at, -rate * step / np.sqrt(size[at]))
            bias_size += gap * gap
            bias -= rate * gap / np.sqrt(bias_size)
    return w, float(bias)


def fit_quality_model(
    df: DataFrame, text: str = "text", key: str = "doc_id", max_rows: int = 6000, buckets: int = 1 << 13,
    threshold: float = 0.5, seed: int = 11, trust: float = TRUST,
) -> QualityModel:
    """Fit the label model to the votes on all texts and the scorer to about ``max_rows`` of them.

    ``trust`` is the weight of the expectation that labellers rarely call a good text bad (see ``fit_label_model``).

    The sample is drawn by a hash of key and text. Only counts of vote patterns
    and the sparse features of the sample reach the driver. An empty table
    gives a model that scores by its prior.
    """
    require_text(df, text)
    require_columns(df, [key])
    vote = [T.StructField("votes", T.ArrayType(T.IntegerType()))]

    def compute_votes():
        return lambda batch: [pa.array([votes(measures(t)) for t in texts_of(batch.column(0))], pa.list_(pa.int32()))]

    voted = append_columns(df.select(text), vote, compute_votes, [text]).select("votes")
    found = voted.groupBy("votes").count().collect()  # at most 3 ** 10 rows
    found.sort(key=lambda r: r["votes"])
    labels = fit_label_model([r["votes"] for r in found], [r["count"] for r in found], trust=trust)
    total = sum(r["count"] for r in found)
    if not total:
        return QualityModel(labels, np.zeros(buckets), float(np.log(labels.prior / (1 - labels.prior))), threshold)
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col(key), F.col(text)), F.lit(1 << 30))
    sample = df.filter(draw < int(min(1.0, max_rows / total) * (1 << 30))).select(
        F.xxhash64(F.col(key), F.col(text)).alias("order"), F.col(text).alias("text"))
    fields = [T.StructField("at", T.ArrayType(T.IntegerType())), T.StructField("x", T.ArrayType(T.DoubleType())), *vote]

    def compute():
        def function(batch: pa.RecordBatch) -> list[pa.Array]:
            texts = texts_of(batch.column(0))
            own = [measures(t) for t in texts]
            rows = [features(t, m, buckets) for t, m in zip(texts, own)]
            return [pa.array([r[0].astype(np.int32) for r in rows], pa.list_(pa.int32())),
                    pa.array([r[1] for r in rows], pa.list_(pa.float64())),
                    pa.array([votes(m) for m in own], pa.list_(pa.int32()))]
        return function

    drawn = materialise(append_columns(sample, fields, compute, ["text"]).select("order", "at", "x", "votes"))
    rows = drawn.toArrow().sort_by("order")
    sparse = [(np.asarray(a, np.int64), np.asarray(x)) for a, x in zip(rows["at"].to_pylist(), rows["x"].to_pylist())]
    posterior = functools.cache(lambda pattern: labels.posterior(pattern))
    targets = [posterior(tuple(p)) for p in rows["votes"].to_pylist()]
    weights, bias = train_scorer(sparse, targets, buckets, seed=seed)
    return QualityModel(labels, weights, bias, threshold)


SCORED = [T.StructField("posterior", T.DoubleType()), T.StructField("score", T.DoubleType()),
          T.StructField("keep", T.BooleanType())]


def classify(df: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """Add the ``posterior`` of the votes, the scorer's ``score`` and whether to ``keep`` each whole text.

    A text without words, also null, has score 0 and is not kept. Columns of
    these names are replaced.
    """
    require_text(df, text)
    sent = df.sparkSession.sparkContext.broadcast(model)  # one number per bucket

    def compute():
        fitted = sent.value
        posterior = functools.cache(fitted.labels.posterior)

        def function(batch: pa.RecordBatch) -> list[pa.Array]:
            chance, scores = [], []
            for t in texts_of(batch.column(0)):
                values = measures(t)
                chance.append(posterior(tuple(votes(values))))
                scores.append(fitted.score(t, values) if t and not t.isspace() else 0.0)
            return [pa.array(chance, pa.float64()), pa.array(scores, pa.float64()),
                    pa.array([s >= fitted.threshold for s in scores], pa.bool_())]
        return function

    return append_columns(df, SCORED, compute, [text])

"""Operator 8: document quality by a linear-chain conditional random field.

Every line is labelled good or bad.  Its score uses its own features and those
of the lines before and after it; a 2x2 table scores neighbouring labels.  The
forward-backward algorithm gives each line's probability of being good, and
their mean weighted by line length is the document's score.

The field is trained by maximum likelihood on documents whose label all their
lines take.  The training set is a bounded sample: of each label the
TRAIN_DOCS rows with the smallest hash, whole.  Everything else covers all rows.

Defined cases: a null or empty text is one empty line; a document labelled
twice is used twice; rows without a label or id don't train; with no label, or
only one, every score is that label's share, or 0.5; repeated rows get equal
scores; an empty table gives an empty result; a very long text is scored
whole, in memory linear in its lines; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.llm.common import require

TRAIN_DOCS = 1_500
STEPS = 250
RATE = 0.05
RIDGE = 1e-3
GOOD = 0.7

# Characters counted as symbols and as closing marks.
SYMBOLS = b"#*$%&|<>!{}[]\\^~_=+@"
CLOSING = (".", "!", "?", "\"", "”", "»", ":", ";")
FEATURES = ("chars", "words", "word_length", "symbols", "pipes", "bangs", "digits", "capitals",
            "different_words", "repeats", "closed", "blank", "seen", "long_words")
N = len(FEATURES)


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(lines x FEATURES, line lengths of at least one) of a text."""
    lines = (text or "").split("\n")
    out = np.zeros((len(lines), N), np.float32)
    seen = set()
    for i, line in enumerate(lines):
        raw = line.encode("utf-8", "surrogatepass")
        words = raw.split()
        if not words:
            out[i, 11] = 1.0
            continue
        n, w = len(raw), len(words)
        capitals = sum(map(str.isupper, line))
        out[i] = (np.log1p(n), np.log1p(w), min(n / w, 30.0),
                  (n - len(raw.translate(None, SYMBOLS))) / n, raw.count(b"|") / w, raw.count(b"!") / w,
                  (n - len(raw.translate(None, b"0123456789"))) / n, capitals / n,
                  len(set(words)) / w, sum(a == b for a, b in zip(words, words[1:])) / w,
                  line.rstrip().endswith(CLOSING), 0.0, line in seen,
                  sum(len(x) > 20 for x in words) / w)
        seen.add(line)
    return out, np.maximum(np.fromiter(map(len, lines), np.int64, len(lines)), 1)


def with_neighbours(x: np.ndarray) -> np.ndarray:
    """Own features, those of the line before and after (zeros at the ends,
    which two more columns mark), and a constant."""
    none = np.zeros((1, x.shape[1]), x.dtype)
    before, after = np.vstack([none, x[:-1]]), np.vstack([x[1:], none])
    ends = np.zeros((len(x), 3), x.dtype)
    ends[0, 0] = ends[-1, 1] = 1
    ends[:, 2] = 1
    return np.hstack([x, before, after, ends])


WIDTH = 3 * N + 3


def _by_step(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Documents in order of falling size, their first rows, and per step how
    many documents still have a line."""
    order = np.argsort(-sizes, kind="stable")
    starts = (np.cumsum(sizes) - sizes)[order]
    falling = sizes[order]
    counts = np.searchsorted(-falling, -np.arange(1, falling[0] + 1), side="right") if len(sizes) else []
    return order, starts, list(counts)


def chain(score: np.ndarray, sizes: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward log odds (good against bad) of every line.
    ``score``: the lines' own log odds, documents one after another;
    ``trans[i, j]``: of label j after label i."""
    _, starts, counts = _by_step(sizes)
    ahead, back = score.astype(np.float64), np.zeros(len(score))
    for t in range(1, len(counts)):
        at = starts[:counts[t]] + t
        a = ahead[at - 1]
        ahead[at] += (np.logaddexp(trans[1, 1] + a, trans[0, 1])
                      - np.logaddexp(trans[1, 0] + a, trans[0, 0]))
    for t in range(len(counts) - 2, -1, -1):
        at = starts[:counts[t + 1]] + t
        b = score[at + 1] + back[at + 1]
        back[at] = (np.logaddexp(trans[1, 1] + b, trans[1, 0])
                    - np.logaddexp(trans[0, 1] + b, trans[0, 0]))
    return ahead, back


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def gradient(x: np.ndarray, sizes: np.ndarray, good: np.ndarray, weights: np.ndarray,
             trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the mean log likelihood per document and line: by the weights and by
    ``trans``.  ``good``: the documents' labels, which all their lines take."""
    score = x @ weights
    ahead, back = chain(score, sizes, trans)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    share = 1.0 / (sizes[doc] * len(sizes))
    by_weight = x.T @ (share * (good[doc] - _sigmoid(ahead + back)))
    first = np.nonzero(doc[1:] == doc[:-1])[0]  # lines that have one after them
    joint = np.empty((2, 2, len(first)))
    for i in range(2):
        for j in range(2):
            joint[i, j] = i * ahead[first] + trans[i, j] + j * (score + back)[first + 1]
    joint = np.exp(joint - joint.max(axis=(0, 1)))
    joint /= joint.sum(axis=(0, 1))
    by_trans = np.zeros((2, 2))
    for i in range(2):
        for j in range(2):
            actual = (good[doc[first]] == i) & (i == j)
            by_trans[i, j] = np.sum(share[first] * (actual - joint[i, j]))
    return by_weight, by_trans


class Field:
    """A trained field; ``constant`` overrides it where there was nothing to
    learn from."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, trans: np.ndarray,
                 constant: float | None = None):
        self.mean, self.scale, self.weights, self.trans, self.constant = mean, scale, weights, trans, constant

    def inputs(self, features: np.ndarray) -> np.ndarray:
        return with_neighbours(((features - self.mean) / self.scale).astype(np.float32))

    def lines(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per text its lines' probabilities of being good, and their lengths."""
        got = [line_features(t) for t in texts]
        if not got:
            return []
        if self.constant is not None:
            return [(np.full(len(n), self.constant), n) for _, n in got]
        sizes = np.array([len(n) for _, n in got])
        score = np.concatenate([self.inputs(f) @ self.weights for f, _ in got]).astype(np.float64)
        p = _sigmoid(np.add(*chain(score, sizes, self.trans)))
        return [(part, n) for part, (_, n) in zip(np.split(p, np.cumsum(sizes)[:-1]), got)]

    def scores(self, texts: list[str | None]) -> list[float]:
        return [float(np.clip(p @ n / n.sum(), 0, 1)) for p, n in self.lines(texts)]


def fit(features: list[np.ndarray], good: list[int], steps: int = STEPS) -> Field:
    """Train on documents' line features and labels (Adam on the mean log
    likelihood; a label's documents weigh half together)."""
    trans = np.zeros((2, 2))
    nothing = np.zeros(N), np.ones(N), np.zeros(WIDTH), trans
    if len(set(good)) < 2:
        return Field(*nothing, constant=float(good[0]) if good else 0.5)
    # Equal numbers of both labels: the smaller side is repeated, not the larger cut.
    sides = [[f for f, g in zip(features, good) if g == k] for k in (0, 1)]
    most = max(map(len, sides))
    rows = [side[i % len(side)] for side in sides for i in range(most)]
    labels = np.repeat([0, 1], most)
    every = np.vstack(rows)
    mean, scale = every.mean(axis=0), every.std(axis=0)
    field = Field(mean, np.where(scale > 1e-6, scale, 1.0), np.zeros(WIDTH), trans)
    x = np.vstack([field.inputs(f) for f in rows]).astype(np.float64)
    sizes = np.array([len(f) for f in rows])
    theta = np.zeros(WIDTH + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        by_weight, by_trans = gradient(x, sizes, labels, theta[:WIDTH], theta[WIDTH:].reshape(2, 2))
        g = np.concatenate([by_weight, by_trans.ravel()]) - RIDGE * theta
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta += RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    field.weights, field.trans = theta[:WIDTH], theta[WIDTH:].reshape(2, 2)
    return field


def is_held_out(doc_id: Column) -> Column:
    """Rows that never train."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> Field:
    """The field learnt from the labelled rows that aren't held out."""
    rows = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("good"))
    rows = rows.where(F.col("doc_id").isNotNull() & F.col("good").isin(0, 1) & ~is_held_out(F.col("doc_id")))
    order = F.xxhash64("doc_id", F.lit(8)), F.col("doc_id")
    chosen = None
    for k in (0, 1):  # at most train_docs rows each, so the broadcast is bounded
        side = rows.where(F.col("good") == k).orderBy(*order).limit(train_docs)
        chosen = side if chosen is None else chosen.union(side)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")

    @F.pandas_udf("binary")
    def flat(column: pd.Series) -> pd.Series:
        return pd.Series([line_features(t)[0].tobytes() for t in column])

    # The features as bytes, in Arrow: no object per number reaches the driver.
    got = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "good", flat("text").alias("x")).toArrow()
    rows = zip(*(got.column(c).to_pylist() for c in ("doc_id", "good", "x")))
    # In a fixed order, so that training repeats exactly.
    rows = sorted(rows)
    return fit([np.frombuffer(x, np.float32).reshape(-1, N) for _, _, x in rows], [g for _, g, _ in rows])


def quality(docs: DataFrame, labels: DataFrame, threshold: float = GOOD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    require(docs, ["doc_id", "text"])
    require(labels, ["doc_id", "quality"])
    field = train(docs, labels)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        out = []
        for i in range(0, len(texts), 500):
            out += field.scores(list(texts.iloc[i:i + 500]))
        return pd.Series(out, dtype="float64")

    return docs.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"),
                       score("text").alias("score")).withColumn(
                           "predicted", (F.col("score") >= threshold).cast("int"))

"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A text's byte trigrams are hashed into :data:`BUCKETS` buckets, with one more
for words that repeat the word before them; one weight per bucket is shared by
all grades.  With ``f`` the mean weight of a text's trigrams (with
:data:`PRIOR` more trigrams of the commonest grade's mean weight, so that a
short text is judged as usual until it shows otherwise) plus that of its
repeated words, ``P(grade <= k) = 1 / (1 + exp(f - threshold_k))`` with ordered
thresholds, which gives the expected grade and the probability of the tail,
``P(grade >= chosen)``, that selects documents.

The model is fitted on at most ``sample`` rated rows (a documented bound: the
first in a seeded order of the document ids), by gradient steps on the
driver; the features of a rated row are a few hundred counts.  Every document
is then scored in one pass without a shuffle; the weights sent to the
executors are :data:`BUCKETS` numbers, whatever the data.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytesops import column_bytes, slices, word_bytes, words
from .common import sampled, with_columns

BUCKETS = 4096
SAMPLE = 6000
PRIOR = 100
COLUMNS = 256          #: columns of the sample whose deviation is taken at a time


def trigram_buckets(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the trigram at each place, and which places lie in one row."""
    n = len(data)
    if n < 3:
        return np.zeros(0, np.uint32), np.zeros(0, bool)
    d = data.astype(np.uint32)
    code = (d[:-2] << np.uint32(16)) | (d[1:-1] << np.uint32(8)) | d[2:]
    code *= np.uint32(2_654_435_761)
    whole = np.ones(n - 2, bool)
    for back in (1, 2):
        at = off[1:-1] - back
        whole[at[(at >= 0) & (at < n - 2)]] = False
    return code >> np.uint32(20), whole


def repeated_words(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Share of each row's words that equal the word before (5 words of prior)."""
    word, edge = words(data, off, word_bytes("text"))
    same = np.zeros(len(word), bool)
    same[1:] = word[1:] == word[:-1]
    same[edge[:-1][edge[:-1] < len(word)]] = False
    total = np.concatenate([[0], np.cumsum(same)])
    return (total[edge[1:]] - total[edge[:-1]]) / (np.diff(edge) + 5)


def mean_weights(data: np.ndarray, off: np.ndarray, weights: np.ndarray, usual: float) -> np.ndarray:
    """Each row's mean weight; that of PRIOR trigrams is ``usual``."""
    bucket, whole = trigram_buckets(data, off)
    value = np.where(whole, weights[bucket], 0.0)
    total = np.concatenate([[0.0], np.cumsum(value)])
    low, high = (np.minimum(off[:-1], len(value)), np.minimum(off[1:], len(value)))
    many = np.maximum(np.diff(off) - 2, 0)
    return (total[high] - total[low] + PRIOR * usual) / (many + PRIOR) + weights[BUCKETS] * repeated_words(data, off)


def counts(text: bytes) -> np.ndarray:
    """Trigrams of each bucket in a text, and its share of repeated words."""
    data = np.frombuffer(text, np.uint8)
    off = np.array([0, len(data)])
    bucket, _ = trigram_buckets(data, off)
    return np.concatenate([np.bincount(bucket, minlength=BUCKETS),
                           repeated_words(data, off)]).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


@dataclass(frozen=True)
class Ordinal:
    """Grades in order, thresholds between them, and the shared weights."""

    grades: np.ndarray
    thresholds: np.ndarray
    weights: np.ndarray
    usual: float = 0.0

    def probabilities(self, f: np.ndarray) -> np.ndarray:
        """``P(grade = k)``, a row for each value of ``f``."""
        below = _sigmoid(self.thresholds[None, :] - f[:, None])
        edges = np.concatenate([np.zeros((len(f), 1)), below, np.ones((len(f), 1))], axis=1)
        return np.diff(edges, axis=1)


def fit(x: np.ndarray, grade: np.ndarray, steps: int = 300, rate: float = 0.05, penalty: float = 1e-2) -> Ordinal:
    """Fit to rows of :func:`counts` (``x`` is changed in place).  Maximum likelihood with an L2 penalty on the scaled trigram weights (none
    on the last, of repeated words), by Adam from zero (no randomness).  No rows: one grade 0; a single grade: no
    threshold."""
    grades = np.unique(grade) if len(grade) else np.zeros(1)
    k = len(grades)
    if k == 1:
        return Ordinal(grades.astype(float), np.zeros(0), np.zeros(BUCKETS + 1))
    y = np.searchsorted(grades, grade)
    many = x[:, :BUCKETS].sum(axis=1, keepdims=True)
    usual = x[:, :BUCKETS].sum(axis=0, where=(y == np.bincount(y).argmax())[:, None])
    usual /= max(1.0, usual.sum())
    x[:, :BUCKETS] += PRIOR * usual
    x[:, :BUCKETS] /= many + PRIOR
    spread = np.concatenate([x[:, at:at + COLUMNS].std(axis=0) for at in range(0, x.shape[1], COLUMNS)])
    scale = (1.0 / (spread + 1e-4)).astype(np.float32)
    middle = x.mean(axis=0) * scale
    z = x              # in place: the sample is the driver's largest array, and no copy of it is made
    z *= scale
    z -= middle
    held = np.full(x.shape[1], penalty)
    held[-1] = 0.0
    share = np.cumsum(np.bincount(y, minlength=k))[:-1] / len(y)
    start = np.log(share / (1 - share))
    w = np.zeros(x.shape[1])
    t = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 1e-3))])
    m, v = np.zeros(len(w) + len(t)), np.zeros(len(w) + len(t))
    for step in range(1, steps + 1):
        f = (z @ w.astype(np.float32)).astype(np.float64)
        theta = t[0] + np.concatenate([[0.0], np.cumsum(np.exp(t[1:]))])
        edge = np.concatenate([[-np.inf], theta, [np.inf]])
        high, low = _sigmoid(edge[y + 1] - f), _sigmoid(edge[y] - f)
        p = np.maximum(high - low, 1e-12)
        slope_high, slope_low = high * (1 - high) / p, low * (1 - low) / p
        g_f = (slope_high - slope_low) / len(y)
        g_w = (z.T @ g_f.astype(np.float32)).astype(np.float64) + held * w
        g_theta = (np.bincount(y, slope_low, k)[1:] - np.bincount(y, slope_high, k)[:-1]) / len(y)
        after = np.cumsum(g_theta[::-1])[::-1]
        g = np.concatenate([g_w, after[:1], after[1:] * np.exp(t[1:])])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
        w, t = w - move[:len(w)], t - move[len(w):]
    theta = t[0] + np.concatenate([[0.0], np.cumsum(np.exp(t[1:]))])
    return Ordinal(grades.astype(float), theta + float(middle @ w), scale * w, float(usual @ (scale * w)[:BUCKETS]))


def train(docs: DataFrame, ratings: DataFrame, sample: int = SAMPLE, seed: int = 5) -> Ordinal:
    """Fit on ``ratings(doc_id, grade)`` joined to ``docs(doc_id, text)``;
    rows with a null grade or id are left out, a document rated twice counts
    twice, one that ``docs`` repeats once a rating."""
    chosen = (ratings.where("grade is not null and doc_id is not null")
              .orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id", "grade").limit(sample)
              .select("doc_id", F.col("grade").cast("double").alias("grade")))
    rated = sampled(docs, chosen, "grade")  # at most ``sample`` rows

    def features(batches):
        for batch in batches:
            text = batch.column("text").cast(pa.large_binary())
            rows = [counts(x.as_py() or b"") for x in text]
            at = [np.flatnonzero(r) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("grade"), pa.array([i.astype(np.uint16).tobytes() for i in at], pa.binary()),
                 pa.array([r[i].tobytes() for r, i in zip(rows, at, strict=True)], pa.binary())], names=["doc_id", "grade", "at", "share"])

    got = rated.mapInArrow(features, "doc_id long, grade double, at binary, share binary").collect()
    got.sort(key=lambda r: (r.doc_id, r.grade, r.at, r.share))
    x = np.zeros((len(got), BUCKETS + 1), np.float32)
    for i, r in enumerate(got):
        x[i, np.frombuffer(r.at, np.uint16)] = np.frombuffer(r.share, np.float32)
    grade = np.array([r.grade for r in got], float)
    del got
    return fit(x, grade)


def score(docs: DataFrame, model: Ordinal, tail: float | None = None, text: str = "text",
          names: tuple[str, str] = ("expected_grade", "tail_probability")) -> DataFrame:
    """``docs`` with ``expected_grade`` and ``tail_probability`` =
    ``P(grade >= tail)`` (the highest grade, if not given).

    Null and empty texts get the values of the thresholds alone; texts of any
    length are read whole; repeated rows get equal values; an empty table
    stays empty.  Columns that bear one of the two ``names`` are replaced."""
    docs = docs.select(*[c for c in docs.columns if c not in names])
    least = model.grades[-1] if tail is None else tail

    def scored(batches):
        for batch in batches:
            data, off = column_bytes(batch.column(text))
            f = np.zeros(batch.num_rows)
            for low, high, part, at in slices(data, off):
                f[low:high] = mean_weights(part, at, model.weights, model.usual)
            p = model.probabilities(f)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(p @ model.grades), pa.array(p[:, model.grades >= least].sum(axis=1))], names=every)

    every = [*docs.columns, *names]
    return docs.mapInArrow(scored, with_columns(docs.schema, **dict.fromkeys(names, "double")))

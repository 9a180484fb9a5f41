"""Quality classifier by Bradley-Terry pairwise ranking.

Documents' scores are linear in features of their texts and learnt from preference pairs, a good against a bad
document, by logistic loss on the difference of their features. The cut is a quantile of the scores: the share of bad
documents among the labelled ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arkspark.llm.common import only, texts
from arkspark.llm.labelled import fold, labelled_sample

FIT_ROWS = 8000
PAIRS = 40_000
FEATURES = (
    "symbols", "exclamations", "bars", "capitals", "digits", "adjacent_repeats", "repeated_pairs", "distinct_words", "word_length", "long_words", "lines", "words", "stops", "repeated_lines", "markup", "bare_words",
)


def _class_of_byte() -> np.ndarray:
    of = np.zeros(256, np.int64)
    for c, chars in enumerate((b"#*$%&^~=+@", b"!", b"|", bytes(range(65, 91)), b"0123456789", bytes(range(97, 123)), b".,;:?", b"<>{}[]\\/_"), 1):
        of[list(chars)] = c
    return of


_OF_BYTE = _class_of_byte()


def features(text: bytes | None) -> np.ndarray:
    """The features of one text, all 0 for a text without words; shares are given by their square roots."""
    text = text or b""
    words = text.split()
    n = len(words)
    if not n:
        return np.zeros(len(FEATURES))
    counts = np.bincount(_OF_BYTE[np.frombuffer(text, np.uint8)], minlength=9)
    letters = max(1, counts[4] + counts[6])
    lengths = np.fromiter(map(len, words), np.int64, n)
    lines = [x for x in text.split(b"\n") if x.strip()]
    pairs = list(zip(words, words[1:], strict=False))
    share = lambda x, of: np.sqrt(min(1.0, x / max(1, of)))
    return np.array([
        share(counts[1], n), share(counts[2], n), share(counts[3], n), share(counts[4], letters), share(counts[5], n),
        share(sum(map(eq, words, words[1:])), n), share(len(pairs) - len(set(pairs)), n), len(set(words)) / n ** 0.8, min(20.0, lengths.mean()) / 5, share((lengths > 25).sum(), n),
        np.log1p(len(lines) / n), np.log1p(n) / 5, share(counts[7], n), share(len(lines) - len(set(lines)), len(lines)), share(counts[8], n), share((lengths <= 1).sum(), n),
    ])


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    at_cut: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """In (0, 1); ``at_cut`` at the quantile that the model cuts at."""
        raw = np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights
        return 1 / (1 + np.exp(-np.clip(raw - self.cut + np.log(self.at_cut / (1 - self.at_cut)), -700, 700)))


def fit_bradley_terry(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, l2: float = 1e-4, steps: int = 400, at_cut: float = 0.3, seed: int = 7) -> QualityModel:
    """From feature rows and labels. Without both labels every score is ``at_cut`` or above."""
    mean, scale = x.mean(axis=0) if len(x) else np.zeros(len(FEATURES)), x.std(axis=0) + 1e-3 if len(x) else np.ones(len(FEATURES))
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    w = np.zeros(len(FEATURES))
    if not len(good) or not len(bad):
        return QualityModel(mean, scale, w, 0.0, at_cut)
    z = np.clip((x - mean) / scale, -8, 8)
    rng = np.random.default_rng(seed)
    diff = z[good[rng.integers(0, len(good), pairs)]] - z[bad[rng.integers(0, len(bad), pairs)]]
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(np.clip(diff @ w, -40, 40)))
        g = -(p @ diff) / pairs + l2 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - 0.1 * (1 - step / (steps + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-10)
    raw = np.sort(z @ w)
    q = len(bad) / len(y)
    at = q * (len(raw) - 1)
    low, high = raw[max(0, int(at) - 1)], raw[min(len(raw) - 1, int(at) + 1)]
    return QualityModel(mean, scale, w, float((low + high) / 2), at_cut)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, rows in texts(batches, "text"):
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), pa.array([features(t).tolist() for t in rows], pa.list_(pa.float64()))], ["doc_id", "label", "x"])


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, held_out: int = 0, fit_rows: int = FIT_ROWS) -> QualityModel:
    """Fit on at most ``fit_rows`` labelled documents outside the fold ``held_out``; only their features reach the driver."""
    sample = labelled_sample(docs, labels, label, folds, held_out, fit_rows)
    rows = sorted((r.doc_id, r.label, r.x) for r in sample.mapInArrow(_measure, "doc_id long, label int, x array<double>").collect())
    return fit_bradley_terry(np.array([r[2] for r in rows]).reshape(-1, len(FEATURES)), np.array([r[1] for r in rows], int))


def _scorer(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in texts(batches, "text"):
            score = model.value.scores(np.array([features(t) for t in rows]).reshape(-1, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score, pa.float64())], ["doc_id", "score"])

    return run


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, score) for every row of ``docs`` (doc_id, text; others are ignored), over its whole text.

    Null and empty texts get the score of a text without words; null ids keep their rows; repeated rows get equal
    scores; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return only(docs, doc_id="long", text="string").mapInArrow(_scorer(shared), "doc_id long, score double")


def quality_report(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every document; held_out is crc32(doc_id) mod 5 = 0, false for a null id."""
    scores = score_quality(docs, fit_quality(docs, labels))
    return scores.select("doc_id", F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))

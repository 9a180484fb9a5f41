"""Counterfactual-regularised toxicity classifier.

Logistic regression over the words of a text and their first 4, 5 and 6 letters. Identity terms of labelled sentences are swapped for other terms of
their group, and mentions are added to sentences without any; the change that this makes to the score is penalised, so
that a mention alone doesn't move it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arkspark.llm.common import only, texts
from arkspark.llm.labelled import fold, labelled_sample

#: Groups of identity terms that are swapped for each other, in English, German, French and Spanish.
IDENTITY_GROUPS = (
    ("women", "men", "girls", "boys", "transgender", "nonbinary"),
    ("woman", "man", "girl", "boy", "female", "male"),
    ("gay", "lesbian", "bisexual", "straight", "queer", "homosexual", "heterosexual"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "sikh", "catholic", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "catholics", "atheists"),
    ("black", "white", "asian", "latino", "african", "european", "arab", "indian"),
    ("immigrant", "refugee", "foreigner", "native"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("deaf", "blind", "disabled", "autistic", "elderly", "young"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("schwule", "lesben", "homosexuelle", "heterosexuelle", "bisexuelle"),
    ("muslime", "christen", "juden", "hinduisten", "buddhisten", "katholiken", "atheisten"),
    ("schwarze", "weiße", "asiaten", "afrikaner", "araber", "europäer"),
    ("einwanderer", "flüchtlinge", "ausländer", "einheimische"),
    ("femmes", "hommes", "filles", "garçons"),
    ("homosexuels", "lesbiennes", "hétérosexuels", "bisexuels"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "catholiques", "athées"),
    ("noirs", "blancs", "asiatiques", "africains", "arabes", "européens"),
    ("immigrés", "réfugiés", "étrangers", "autochtones"),
    ("mujeres", "hombres", "niñas", "niños"),
    ("homosexuales", "lesbianas", "heterosexuales", "bisexuales"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "católicos", "ateos"),
    ("negros", "blancos", "asiáticos", "africanos", "árabes", "europeos"),
    ("inmigrantes", "refugiados", "extranjeros", "nativos"),
)
IDENTITY_TERMS = frozenset(w for g in IDENTITY_GROUPS for w in g)
FIT_ROWS = 8000
MAX_WORDS = 4096
MIN_CHI_SQUARE = 15.0
SWAP_PENALTY = 4.0
#: The score from which a text counts as toxic, and the parts of the sample that are scored by a model of the others to fit it.
THRESHOLD = 0.7
SHIFT_PARTS = 4
PREFIXES = (4, 5, 6)
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: bytes | None) -> set[str]:
    return set(_WORD.findall((text or b"").decode("utf-8", "replace").lower()))


def features_of(word: str) -> list[str]:
    """The word, and its first letters, marked; an identity term stands for itself alone."""
    return [word] if word in IDENTITY_TERMS else [word, *("^" + word[:k] for k in PREFIXES if len(word) > k)]


class KnownFeatures(dict):
    """Of each word the features that a model knows, remembered per task."""

    limit = 1 << 19

    def __init__(self, known):
        self.known = known

    def __missing__(self, word: str) -> tuple[str, ...]:
        if len(self) > self.limit:
            self.clear()
        value = self[word] = tuple(f for f in features_of(word) if f in self.known)
        return value

    def of(self, words: set[str]) -> list[str]:
        return sorted({f for w in words if (found := self[w]) for f in found})


@dataclass(frozen=True)
class ToxicityModel:
    weights: dict[str, float]
    bias: float

    def logit(self, words: set[str]) -> float:
        return self.bias + sum(self.weights[f] for f in KnownFeatures(self.weights).of(words))


def _sample_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, rows in texts(batches, "text"):
        # a sorted order, so that sums over a document's words come out the same in every run
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), pa.array([sorted({f for w in words_of(t) for f in features_of(w)}) for t in rows], pa.list_(pa.string()))], ["doc_id", "label", "words"])


def fit_weights(rows: list[tuple[int, list[str]]], vocabulary: list[str], swap_penalty: float = SWAP_PENALTY, l2: float = 0.05, steps: int = 400) -> ToxicityModel:
    """Weights by Adam on logistic loss + l2 + the mean squared score change over counterfactuals.

    ``rows`` are (label, words). For each text with an identity term, its counterfactuals replace the term by each
    other one of its group or leave it out; for each text without, they add one term of each group.
    """
    index = {w: i for i, w in enumerate(vocabulary)}
    n, d = max(1, len(rows)), len(vocabulary)
    row_of = np.concatenate([np.full(len(ws), r) for r, (_, ws) in enumerate(rows)] or [np.empty(0, int)]).astype(np.int64)
    col_of = np.array([index[w] for _, ws in rows for w in ws], np.int64)
    y = np.array([label for label, _ in rows], float)
    swaps: dict[tuple[int, int], float] = {}
    groups = [[index[w] for w in g if w in index] for g in IDENTITY_GROUPS]
    of_term = {i: g for g in groups for i in g}
    for _, ws in rows:
        terms = [index[w] for w in ws if index[w] in of_term]
        for t in terms:
            swaps[t, -1] = swaps.get((t, -1), 0) + 1
            for other in of_term[t]:
                if other != t:
                    swaps[t, other] = swaps.get((t, other), 0) + 1 / max(1, len(of_term[t]) - 1)
        if not terms:
            for g in groups:
                for t in g:
                    swaps[t, -1] = swaps.get((t, -1), 0) + 1 / max(1, len(g))
    out = np.array([a for a, _ in swaps], np.int64)
    into = np.array([b if b >= 0 else d for _, b in swaps], np.int64)
    often = np.array(list(swaps.values()), float) / n
    w, bias = np.zeros(d + 1), 0.0
    if 0 < y.sum() < len(y):
        bias = float(np.log(y.mean() / (1 - y.mean())))
    m, v = np.zeros(d + 2), np.zeros(d + 2)
    for step in range(1, steps + 1):
        score = np.bincount(row_of, w[col_of], minlength=len(y))[: len(y)] + bias if len(y) else np.zeros(0)
        error = (1 / (1 + np.exp(-np.clip(score, -40, 40))) - y) / n
        g = np.zeros(d + 2)
        g[: d + 1] = np.bincount(col_of, error[row_of], minlength=d + 1) + l2 * w / n
        change = 2 * swap_penalty * often * (w[out] - w[into])
        g[: d + 1] += np.bincount(out, change, minlength=d + 1) - np.bincount(into, change, minlength=d + 1)
        g[d] = 0
        g[d + 1] = error.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.15 * (1 - step / (steps + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-10)
        w -= move[: d + 1]
        bias -= float(move[d + 1])
    return ToxicityModel({t: float(w[i]) for t, i in index.items()}, bias)


def best_shift(rows: list[tuple[int, list[str]]], vocabulary: list[str], threshold: float, swap_penalty: float = SWAP_PENALTY, parts: int = SHIFT_PARTS) -> float:
    """What to add to logits so that those at ``threshold`` or above are told best (by F1) as toxic.

    Each of ``parts`` parts of the rows is scored by the model of the others. Logistic loss makes rare labels score low, and
    words that are known from few texts too, so that a fixed threshold misses them. 0 if a part has no text of each label.
    """
    logits, truth = [], []
    for part in range(parts):
        rest = [r for i, r in enumerate(rows) if i % parts != part]
        mine = [r for i, r in enumerate(rows) if i % parts == part]
        if not all(0 < sum(label for label, _ in some) < len(some) for some in (rest, mine)):
            return 0.0
        model = fit_weights(rest, vocabulary, swap_penalty)
        logits += [model.bias + sum(model.weights[w] for w in ws) for _, ws in mine]
        truth += [label for label, _ in mine]
    order = np.argsort(-np.array(logits), kind="stable")
    score, y = np.array(logits)[order], np.array(truth)[order]
    hits = np.cumsum(y)
    f1 = np.where(np.append(score[1:] < score[:-1], True), 2 * hits / (np.arange(1, len(y) + 1) + y.sum()), -1)
    at = int(np.argmax(f1))
    cut = score[at] if at + 1 == len(score) else (score[at] + score[at + 1]) / 2
    return float(np.log(threshold / (1 - threshold)) - cut)


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 3, held_out: int = 1, fit_rows: int = FIT_ROWS, max_words: int = MAX_WORDS, swap_penalty: float = SWAP_PENALTY, threshold: float | None = THRESHOLD) -> ToxicityModel:
    """Fit on at most ``fit_rows`` labelled documents outside the fold ``held_out``, with scores shifted to fit ``threshold`` (None: as they are).

    Words and first letters are chosen by Spark over the sample: the ``max_words`` with the largest chi-square against the label, at
    least ``MIN_CHI_SQUARE``, and all identity terms. Without labels the score is 0.5 everywhere.
    """
    sample = labelled_sample(docs, labels, label, folds, held_out, fit_rows).mapInArrow(_sample_words, "doc_id long, label int, words array<string>").cache()
    try:
        n, positive = (sample.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first())
        if not n:
            return ToxicityModel({}, 0.0)
        p = positive / n
        found = sample.select("label", F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("df"), F.sum("label").alias("tp"))
        expected = F.col("df") * p
        chi = (F.col("tp") - expected) * (F.col("tp") - expected) / (expected * (1 - p) * (1 - F.col("df") / (n + 1)) + 1e-9)
        chosen = [r.word for r in found.where(chi >= MIN_CHI_SQUARE).orderBy(chi.desc(), "word").limit(max_words).collect()]
        vocabulary = sorted({*chosen, *IDENTITY_TERMS})
        kept = F.array_intersect("words", F.lit(vocabulary))
        rows = [(r.label, sorted(r.words)) for r in sample.select("doc_id", "label", kept.alias("words")).orderBy("doc_id", "label", "words").collect()]
    finally:
        sample.unpersist()
    model = fit_weights(rows, vocabulary, swap_penalty)
    return model if threshold is None else ToxicityModel(model.weights, model.bias + best_shift(rows, vocabulary, threshold, swap_penalty))


def _scorer(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = model.value.weights, model.value.bias
        known = KnownFeatures(weights)
        for part, rows in texts(batches, "text"):
            logits = np.array([bias + sum(weights[f] for f in known.of(words_of(t))) for t in rows])
            score = pa.array(1 / (1 + np.exp(-np.clip(logits, -700, 700))), pa.float64())
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in part.schema.names if c != "text"), score], [*(c for c in part.schema.names if c != "text"), "score"])

    return run


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, text_hash, score) for every row of ``docs`` (doc_id, text; others are ignored), over its whole text.

    Null and empty texts get the score of a text without words; null ids keep their rows; repeated rows get equal
    scores; an empty table gives no rows. text_hash is xxhash64 of the text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    df = only(docs, doc_id="long", text="string").withColumn("text_hash", F.xxhash64("text"))
    return df.select("doc_id", "text_hash", "text").mapInArrow(_scorer(shared), "doc_id long, text_hash long, score double")


def toxicity_report(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, swap_penalty: float = SWAP_PENALTY) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every document; held_out is crc32(doc_id) mod 3 = 1, false for a null id."""
    scores = score_toxicity(docs, fit_toxicity(docs, labels, swap_penalty=swap_penalty, threshold=threshold))
    return scores.select("doc_id", F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))

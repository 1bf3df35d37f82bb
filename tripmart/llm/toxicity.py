"""Toxicity: a logistic classifier that does not change its mind when identity terms are swapped.

Features are the presence of words and word beginnings; those that tell the
labels apart are selected from counts over the labelled sample.  Every
labelled text that names a group is paired with its counterfactual, the same
text with each identity term replaced by another of its kind.  The loss adds
the squared change of the score between the two, so weight that a group's mere
mention has drawn from the labels is removed, and neutral mentions are not
taken for toxic ones.

The sample is bounded, chosen by a hash among all labelled rows, and its rows
reach the driver as lists of selected features only.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import text_slices
from tripmart.llm.labelled import sample

#: Labelled rows that are used at most.
MOST_ROWS = 20_000
MOST_FEATURES = 4096
LEAST_TEXTS = 4
BEGINNINGS = (5, 6, 7, 8)
CHANGE_PENALTY = 4.0
RIDGE = 0.05
MEMORY = 300_000

# Identity terms by kind; a term is swapped for the next of its kind.
IDENTITY_TERMS = [
    ["women", "men"], ["woman", "man"], ["girls", "boys"], ["she", "he"], ["her", "his"],
    ["muslims", "christians", "jews", "hindus", "buddhists", "atheists"],
    ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist"],
    ["black", "white", "asian", "latino", "african", "european"], ["gay", "straight", "lesbian", "bisexual", "transgender"],
    ["immigrants", "refugees", "natives", "foreigners"], ["disabled", "deaf", "blind", "autistic"], ["old", "young"],
]
SWAPS = {t.encode(): kind[(i + 1) % len(kind)].encode() for kind in IDENTITY_TERMS for i, t in enumerate(kind)}

#: Lower case for A-Z, blanks for ASCII punctuation.
PLAIN = bytes(c + 32 if 65 <= c <= 90 else 32 if c < 128 and not chr(c).isalnum() else c for c in range(256))


def tokens(text: str | None) -> set[bytes]:
    return set((text or "").encode().translate(PLAIN).split())


def counterfactual(words: set[bytes]) -> set[bytes]:
    """The words with each identity term swapped for the next of its kind."""
    return {SWAPS.get(w, w) for w in words}


def features_of(word: bytes) -> list[bytes]:
    """The word and its beginnings (of its UTF-8 bytes; marked by a leading ^)."""
    return [word, *[b"^" + word[:n] for n in BEGINNINGS if len(word) > n]]


def features(words: set[bytes]) -> set[bytes]:
    return {f for w in words for f in features_of(w)}


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, toxic, clean) counted within the task, flushed at a bounded size."""
    def table(counts: tuple[Counter, Counter]) -> pa.RecordBatch:
        names = list(counts[0] | counts[1])
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.binary()), *[pa.array([c[f] for f in names], pa.int64()) for c in counts]],
            ["feature", "toxic", "clean"])
    counts = Counter(), Counter()
    for batch in text_slices(batches, "text"):
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
            counts[0 if label else 1].update(features(tokens(text)))
        if len(counts[0]) + len(counts[1]) > MEMORY:
            yield table(counts)
            counts = Counter(), Counter()
    yield table(counts)


@dataclass(frozen=True)
class ToxicityModel:
    intercept: float
    weights: dict[bytes, float]

    def score_words(self, words: set[bytes]) -> float:
        total = self.intercept + sum(self.weights.get(f, 0.0) for f in features(words))
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, total))))


def _lists(batches: Iterator[pa.RecordBatch], index: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """Selected features of each text and of its counterfactual."""
    for batch in text_slices(batches, "text"):
        words = [tokens(t) for t in batch.column("text").to_pylist()]
        chosen = lambda w: sorted(index[f] for f in features(w) if f in index)
        yield pa.RecordBatch.from_arrays(
            [batch.column("label"), pa.array(map(chosen, words), pa.list_(pa.int32())),
             pa.array([chosen(counterfactual(w)) if not w.isdisjoint(SWAPS) else None for w in words], pa.list_(pa.int32()))],
            ["label", "own", "swapped"])


def _flat(lists: list) -> tuple[np.ndarray, np.ndarray]:
    rows = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    return rows, np.array([i for x in lists for i in x], dtype=np.int64)


def descend(labels: np.ndarray, own: list, swapped: list, n_features: int, change_penalty: float = CHANGE_PENALTY,
            ridge: float = RIDGE, steps: int = 400) -> np.ndarray:
    """Weights (the last is the intercept) of the regularised logistic loss, by momentum descent with a per-feature rate."""
    n = len(labels)
    rows, cols = _flat(own)
    # The features in which a text and its counterfactual differ; the others' weights don't change the score.
    pairs = [(set(own[i]), set(s)) for i, s in enumerate(swapped) if s is not None and s != own[i]]
    swap_rows, swap_cols = _flat([sorted(s - o) for o, s in pairs])
    own_rows, own_cols = _flat([sorted(o - s) for o, s in pairs])
    w, speed = np.zeros(n_features + 1), np.zeros(n_features + 1)
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    w[-1] = math.log(share / (1 - share))
    rate = 1 / (0.25 * np.bincount(cols, minlength=n_features + 1) + ridge + 2 * change_penalty * (
        np.bincount(swap_cols, minlength=n_features + 1) + np.bincount(own_cols, minlength=n_features + 1)))
    rate[-1] = 1 / (0.25 * n + ridge)
    per_row = max(1.0, float(np.mean(np.bincount(rows, minlength=n))) + 1)
    for _ in range(steps):
        logit = np.bincount(rows, w[cols], n) + w[-1]
        error = 1 / (1 + np.exp(-np.clip(logit, -60, 60))) - labels
        grad = np.bincount(cols, error[rows], n_features + 1) + ridge * w
        grad[-1] = error.sum()
        if pairs:
            change = np.bincount(own_rows, w[own_cols], len(pairs)) - np.bincount(swap_rows, w[swap_cols], len(pairs))
            grad += 2 * change_penalty * (np.bincount(own_cols, change[own_rows], n_features + 1)
                                          - np.bincount(swap_cols, change[swap_rows], n_features + 1))
        speed = 0.9 * speed - rate / per_row * grad
        w = w + speed
    return w


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_rows: int = MOST_ROWS,
        most_features: int = MOST_FEATURES, change_penalty: float = CHANGE_PENALTY) -> ToxicityModel:
    """Model from documents and (label_id, label) rows; at most ``most_rows`` labels are used.

    With no labelled text the score is 0.5 for all, with one label its share.
    """
    ids = sample(labels, most_rows)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")) \
        .join(F.broadcast(ids), F.col("id") == F.col("label_id")).select("text", "label")
    found = rows.mapInArrow(_count_batches, "feature binary, toxic long, clean long").groupBy("feature") \
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    odds = F.log((F.col("toxic") + 0.5) / (F.col("clean") + 0.5))
    even = F.sqrt((F.col("toxic") + F.col("clean")).cast("double"))
    ranked = found.where(F.col("toxic") >= LEAST_TEXTS).orderBy(F.desc(odds * even), "feature").limit(most_features)
    chosen = [bytes(r["feature"]) for r in ranked.select("feature").collect()]
    index = {f: i for i, f in enumerate(dict.fromkeys([*chosen, *SWAPS]))}
    got = rows.mapInArrow(lambda it: _lists(it, index), "label int, own array<int>, swapped array<int>").collect()
    if not got:
        return ToxicityModel(0.0, {})
    got.sort(key=lambda r: (r["label"], r["own"], r["swapped"] or []))
    w = descend(np.array([r["label"] for r in got], float), [r["own"] for r in got], [r["swapped"] for r in got], len(index),
                change_penalty)
    return ToxicityModel(float(w[-1]), {f: float(w[i]) for f, i in index.items() if w[i]})


def _score_column(batch: pa.RecordBatch, model: ToxicityModel, known: dict[bytes, tuple], text_col: str) -> list[float]:
    weights, scores = model.weights, []
    if len(known) > MEMORY:
        known.clear()
    for text in batch.column(text_col).to_pylist():
        hits: set[bytes] = set()
        for w in tokens(text):
            f = known.get(w)
            if f is None:
                f = known[w] = tuple(x for x in features_of(w) if x in weights)
            if f:
                hits.update(f)
        total = model.intercept + sum(weights[f] for f in sorted(hits))
        scores.append(1 / (1 + math.exp(-max(-60.0, min(60.0, total)))))
    return scores


def _score_batches(batches: Iterator[pa.RecordBatch], model: ToxicityModel) -> Iterator[pa.RecordBatch]:
    known: dict[bytes, tuple] = {}
    for batch in text_slices(batches, "text"):
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(_score_column(batch, model, known, "text"), pa.float64())],
                                         ["id", "score"])


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``score`` of every row (NULL text: empty); other columns are not read."""
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = named.schema["id"].dataType.simpleString()
    return named.mapInArrow(lambda it: _score_batches(it, model), f"id {kind}, score double")


def keep_below(docs: DataFrame, model: ToxicityModel, threshold: float, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, that score below the threshold."""
    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, tuple] = {}
        for batch in text_slices(batches, text_col):
            yield batch.filter(pa.array([s < threshold for s in _score_column(batch, model, known, text_col)], pa.bool_()))
    return docs.mapInArrow(kept, docs.schema)

"""Quality by a naive Bayes support vector machine.

A document is the set of its n-grams: words and pairs of words, and one to three
shapes of words (``Aa,`` or ``A!`` or ``=`` for a word again). Each is hashed to a
feature; a feature weighs as much as the classes differ in it (the log ratio of its
smoothed counts), and a linear model with hinge loss is fitted on top by dual
coordinate descent.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punchcard.llm.common import batch_of, in_batches, written
from punchcard.llm.labelled import Platt, fit_platt, held_out, sample

FEATURES = 1 << 18
# The sample to fit on: documents of each label, and features of all of them together.
PER_CLASS = 4000
SAMPLE_FEATURES = 20_000_000
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 10
FOLDS = 3

# Words that a worker remembers, none of more than LONG letters, so at most some 100 MB;
# when there are more, it forgets them all.
REMEMBERED, LONG = 400_000, 64
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _letters(word: str) -> str | None:
    """Shape of a word of letters in one of the usual cases."""
    if word.islower():
        return "a"
    if word.isupper():
        return "A"
    return "Aa" if word[0].isupper() and word[1:].islower() else None


def shape(word: str) -> str:
    """Runs of letters and digits as one sign each, marks as they are, runs of them once."""
    if word.isalpha():  # nearly all words are letters, or letters and one mark
        found = _letters(word)
        if found:
            return found
    elif word[:-1].isalpha() and not word[-1].isalnum():
        found = _letters(word[:-1])
        if found:
            return found + word[-1]
    signs = []
    for char in word:
        if char.isalpha():
            signs.append("A" if char.isupper() else "a")
        elif char.isdigit():
            signs.append("0")
        else:
            signs.append(char)
    return "".join(sign for sign, _ in groupby(signs))[:12]


_SAME = np.uint64(xxhash.xxh32_intdigest("="))
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def _code(word: str) -> int:
    """Hash of the lower-case word, and below it the hash of its shape."""
    return xxhash.xxh32_intdigest(word.lower()) << 32 | _shape_code(shape(word))


@lru_cache(maxsize=10_000)
def _shape_code(signs: str) -> int:
    return xxhash.xxh32_intdigest(signs)


class Codes(dict):
    def __missing__(self, word: str) -> int:
        code = _code(word)
        if len(word) <= LONG:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = code
        return code


_CODES = Codes()


def _slots(values: np.ndarray, kind: int) -> np.ndarray:
    """Features of a run of hashes; ``kind`` keeps kinds of n-grams apart."""
    mixed = (values ^ np.uint64(kind)) * _ODD[0]
    return (mixed >> np.uint64(64 - 18)).astype(np.int64)


def features(text: str | None) -> np.ndarray:
    """The features of a text, ascending, each once."""
    words = _WORD.findall(text or "")
    codes = np.fromiter(map(_CODES.__getitem__, words), np.uint64, len(words))
    surface, shapes = codes >> np.uint64(32), codes & np.uint64(0xFFFFFFFF)
    if len(words) > 1:
        shapes[1:][surface[1:] == surface[:-1]] = _SAME
    found = [_slots(surface, 1), _slots(shapes, 2)]
    if len(words) > 1:
        found.append(_slots(surface[:-1] * _ODD[1] + surface[1:], 3))
        found.append(_slots(shapes[:-1] * _ODD[1] + shapes[1:], 4))
    if len(words) > 2:
        pairs = shapes[:-2] * _ODD[1] + shapes[1:-1]
        found.append(_slots(pairs * _ODD[2] + shapes[2:], 5))
    seen = np.zeros(FEATURES, bool) if len(words) > 50_000 else None
    if seen is not None:
        for part in found:
            seen[part] = True
        return np.flatnonzero(seen)
    return np.unique(np.concatenate(found))


@dataclass(frozen=True)
class Model:
    """Weights of the ratio-scaled features, the ratios, the bias and the probability."""

    ratios: np.ndarray
    weights: np.ndarray
    bias: float
    platt: Platt

    def margin(self, found: np.ndarray) -> float:
        ratios = self.ratios[found]
        norm = float(np.sqrt(np.dot(ratios, ratios)))
        return float(np.dot(self.weights[found], ratios)) / norm + self.bias if norm else self.bias


def log_ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    counts = np.full((2, FEATURES), SMOOTHING)
    for found, label in zip(rows, labels, strict=True):
        counts[label][found] += 1
    counts /= counts.sum(axis=1, keepdims=True)
    return np.log(counts[1] / counts[0])


def dual_descent(
    rows: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, costs: np.ndarray
) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge-loss model: one dual variable at a time.

    A row is (features, values) and a constant 1 for the bias. A dual variable moves to
    its best value between 0 and its cost, and the weights move with it.
    """
    weights, bias = np.zeros(FEATURES), 0.0
    duals = np.zeros(len(rows))
    norms = np.array([float(np.dot(values, values)) + 1 for _, values in rows])
    rng = np.random.default_rng(0)
    for _ in range(EPOCHS):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            found, values = rows[i]
            slope = signs[i] * (float(np.dot(weights[found], values)) + bias) - 1
            new = min(max(duals[i] - slope / norms[i], 0.0), costs[i])
            change = (new - duals[i]) * signs[i]
            if change:
                duals[i] = new
                weights[found] += change * values
                bias += change
                moved = max(moved, abs(change))
        if moved < 1e-4:
            break
    return weights, bias


def _fit(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    ratios = log_ratios(rows, labels)
    scaled = []
    for found in rows:
        values = ratios[found]
        norm = np.sqrt(np.dot(values, values))
        scaled.append((found, values / norm if norm else values))
    signs = np.where(labels == 1, 1.0, -1.0)
    share = np.bincount(labels, minlength=2) / len(labels)
    costs = COST * 0.5 / share[labels]  # either label counts for half
    weights, bias = dual_descent(scaled, signs, costs)
    return Model(ratios, weights, bias, Platt(1.0, 0.0))


def fit(rows: list[np.ndarray], labels: np.ndarray) -> Model | float:
    """The model; without both labels in every fold, the share of label 1 (or 0.5)."""
    fold = np.arange(len(labels)) % FOLDS
    if any(len(set(labels[fold != k])) < 2 for k in range(FOLDS)):
        return float(labels.mean()) if len(labels) else 0.5
    margins = np.zeros(len(labels))
    for k in range(FOLDS):
        part = np.flatnonzero(fold != k)
        model = _fit([rows[i] for i in part], labels[part])
        for i in np.flatnonzero(fold == k):
            margins[i] = model.margin(rows[i])
    whole = _fit(rows, labels)
    return Model(whole.ratios, whole.weights, whole.bias, fit_platt(margins, labels))


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [features(text).astype(np.int32) for text in batch.column("text").to_pylist()]
        yield batch_of(
            rank=(batch.column("rank"), None),
            label=(batch.column("label"), None),
            features=(found, pa.list_(pa.int32())),
        )


def train(docs: DataFrame, labels: DataFrame, label_col: str, **names: str) -> Model | float:
    """Fit on a sample of bounded size, on the driver: ``PER_CLASS``, ``SAMPLE_FEATURES``."""
    chosen = sample(docs, labels, label_col, PER_CLASS, **names)
    made = in_batches(chosen, _sample_features, "rank long, label int, features array<int>")
    rows, found, held = [], [], 0
    for row in written(made, "sample").orderBy("rank").toLocalIterator():
        held += len(row.features) + 1
        if held > SAMPLE_FEATURES:
            break
        rows.append(np.array(row.features, np.int64))
        found.append(row.label)
    return fit(rows, np.array(found, np.int64))


def _scores(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            if isinstance(known, float):
                scores = np.full(len(texts), known)
            else:
                margins = np.array([known.margin(features(text)) for text in texts], np.float64)
                scores = known.platt(margins)
            yield batch_of(id=(batch.column("id"), None), score=(pa.array(scores), None))

    return run


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Score every document: ``id_col``, held_out, score, one row per row.

    Labels are learnt from documents that are not held out. A null text counts as empty,
    and an empty text has the score of the bias; repeated ids each get their row, and a
    null id has no label; null labels and others than 0 and 1 are ignored. Without
    labels of both kinds every score is the share of label 1, or 0.5. An empty table
    gives no rows; other columns are ignored.
    """
    model = train(docs, labels, label_col, id_col=id_col, text_col=text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    scored = in_batches(rows, _scores(shared), f"id {kind}, score double")
    return scored.select(F.col("id").alias(id_col), held_out("id").alias("held_out"), "score")

"""Toxicity by a support vector machine over a subsequence string kernel.

The kernel of two strings counts the letter triples both have as subsequences; a triple
that spans more letters than three weighs less, by a decay for each; the kernel is
normalised and squared. So an insult still looks like itself with letters put in between,
and unlike most other words. Nystroem's method approximates the kernel by a few landmark
strings: insults, and the harmless words nearest to them.

Labels are those of whole documents, of which most words are harmless: a document counts
as its worst unit (a word, single letters in a row, or short pieces joined). A unit is
taken for an insult if several toxic documents hold it and hardly a harmless one does,
and the clearer that is, the larger the margin asked for. Harmless units are chosen anew
from round to round, those that look worst.

Most units are far from all insults. One table with the largest weight of each triple
among them bounds the kernel with any of them from above, so that the kernels with
landmarks are only computed for what is near.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punchcard.llm.common import batch_of, columns, in_batches, written
from punchcard.llm.labelled import Steps, fit_steps, held_out, sample

DECAY = 0.8
LETTERS = 64  # the last one stands for all letters that are not in the alphabet
LONGEST = 32  # longer units are taken as windows of so many letters, by half of it
FRAGMENT = 2  # words of so many letters may be pieces of one
JOINED = 10  # letters of pieces joined, at most
INSULTS, HARMLESS = 160, 160  # landmarks of either kind, at most
# The sample to fit on: documents of each label, and units of all of them together.
PER_CLASS = 2500
SAMPLE_UNITS = 2_000_000
SUPPORT = 3  # toxic documents that hold an insult, at least
SHARE = 0.02  # of toxic documents, likewise
GROUP = 8  # insults that have a bound together
SURE = 3.0  # log ratio of the labels that an insult has, at least
CLEAR = 4.5  # log ratio for which a margin of one is asked
NEAR = 0.6  # kernel with an insult below which a unit is harmless
WORST = 3  # units that stand for a harmless document in a round of training, at most
NEAREST = 8  # units of a document that are looked at in training: those nearest to insults
ROUNDS = 3
FOLDS = 6
EPOCHS = 300  # at most
SETTLED = 0.01  # slope of a dual variable that counts as none
COST = 20.0
# The margin of what is not near an insult, and the least there is.
FLOOR = -1.5
# Bytes of units that a worker remembers, by estimate; beyond, it forgets them all.
REMEMBERED = 192 << 20

def joined_units(words: list[str]) -> set[str]:
    """Neighbouring words that may be one word in pieces, joined.

    Each window of words of ``JOINED`` letters at most in which one word at most has more
    than ``FRAGMENT`` letters.
    """
    sizes = list(map(len, words))
    found: set[str] = set()
    last = len(words) - 1
    starts = [
        start
        for start, (size, following) in enumerate(zip(sizes, sizes[1:], strict=False))
        if size < JOINED and (size <= FRAGMENT or following <= FRAGMENT)
    ]
    for start in starts:
        size = sizes[start]
        held, long, end = size, size > FRAGMENT, start + 1
        while end <= last:
            held += sizes[end]
            long += sizes[end] > FRAGMENT
            if held > JOINED or long > 1:
                break
            end += 1
            if held > 2:
                found.add("".join(words[start:end]))
    return found


def text_units(text: str | None) -> set[str]:
    """All units of a text: its words, and neighbouring ones joined.

    Letters and digits only, in lower case: marks in and between words do not count, ends
    of sentences among them.
    """
    words = [
        own
        for word in (text or "").lower().split()
        if (own := word if word.isalnum() else _letters(word))
    ]
    return {word for word in words if len(word) > 2} | joined_units(words)


_END = 255  # parts units that are translated together


class _Codes(dict):
    def __missing__(self, _: int) -> int:
        return LETTERS - 1


@lru_cache(maxsize=LONGEST + 1)
def _triples(length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places i < j < k in a string of the length, and the decayed weight of each."""
    i, j, k = (
        np.array(
            [
                (i, j, k)
                for i in range(length)
                for j in range(i + 1, length)
                for k in range(j + 1, length)
            ],
            np.int64,
        )
        .reshape(-1, 3)
        .T
    )
    return i, j, k, DECAY ** (k - i - 2.0)


class Kernel:
    """Triples of strings over an alphabet."""

    def __init__(self, alphabet: str):
        self.alphabet = alphabet
        self._codes = _Codes({ord(c): i for i, c in enumerate(alphabet[: LETTERS - 1])})
        self._codes[ord("\n")] = _END

    def codes(self, units: list[str]) -> list[bytes]:
        """The codes of units of letters and digits, of any length."""
        if not units:
            return []
        return "\n".join(units).translate(self._codes).encode("latin-1").split(bytes([_END]))

    def windows(self, unit: str) -> list[bytes]:
        """Letters and digits of a unit as codes; of a long one, its windows."""
        own = unit if unit.isalnum() else "".join(filter(str.isalnum, unit))
        codes = own.translate(self._codes).encode("latin-1")
        if len(codes) <= LONGEST:
            return [codes]
        half = LONGEST // 2
        return [codes[at : at + LONGEST] for at in range(0, len(codes) - half, half)]

    @staticmethod
    def _keys(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the triples of strings of one length, and their weights."""
        i, j, k, weights = _triples(codes.shape[1])
        wide = codes.astype(np.int32)
        return (wide[:, i] * LETTERS + wide[:, j]) * LETTERS + wide[:, k], weights

    def table(self, codes: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The triples of a string, each once, and their normalised weights."""
        if len(codes) < 3:
            return np.empty(0, np.int64), np.empty(0)
        keys, weights = self._keys(np.frombuffer(codes, np.uint8)[None])
        found, place = np.unique(keys[0], return_inverse=True)
        sums = np.bincount(place, weights)
        return found, sums / np.sqrt(np.dot(sums, sums))

    def _by_length(self, strings: list[bytes]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
        """Places of strings of one length, a bounded number at a time, and their triples."""
        by_length: dict[int, list[int]] = {}
        for place, codes in enumerate(strings):
            if len(codes) > 2:
                by_length.setdefault(len(codes), []).append(place)
        for length, places in by_length.items():
            step = max(1, 1_000_000 // len(_triples(length)[0]))
            for at in range(0, len(places), step):
                part = places[at : at + step]
                raw = b"".join([strings[place] for place in part])
                yield part, *self._keys(np.frombuffer(raw, np.uint8).reshape(-1, length))

    @staticmethod
    def _norms(keys: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Norm of each row: the weights of equal triples add up first."""
        rows = len(keys)
        apart = keys.astype(np.int64) + np.arange(rows)[:, None] * LETTERS**3
        found, place = np.unique(apart.ravel(), return_inverse=True)
        sums = np.bincount(place, np.tile(weights, rows))
        return np.sqrt(np.bincount(found // LETTERS**3, sums * sums, minlength=rows))

    def kernels(
        self, strings: list[bytes], tables: list[tuple[np.ndarray, np.ndarray]]
    ) -> np.ndarray:
        """The normalised kernel of each string with each table."""
        result = np.zeros((len(strings), len(tables)))
        dense = np.zeros(LETTERS**3)
        for part, keys, weights in self._by_length(strings):
            norms = self._norms(keys, weights)
            for column, (found, values) in enumerate(tables):
                dense[found] = values
                result[part, column] = dense[keys] @ weights / norms
                dense[found] = 0.0
        return result

    def products(self, strings: list[bytes], table: np.ndarray, above: float) -> np.ndarray:
        """Inner products of normalised strings with a table, exact where above a bound.

        The norm of a string is at least that without repeated triples, so the rest can
        be told from the sum alone; it gets the value of the bound, or less.
        """
        result = np.zeros(len(strings))
        for part, keys, weights in self._by_length(strings):
            sums = table[keys] @ weights
            found = np.minimum(sums / np.sqrt(np.dot(weights, weights)), above)
            close = np.flatnonzero(sums / np.sqrt(np.dot(weights, weights)) > above)
            if len(close):
                found[close] = sums[close] / self._norms(keys[close], weights)
            result[part] = found
        return result


class Landmarks:
    """Landmark strings; the first ``insults`` of them are those."""

    def __init__(self, kernel: Kernel, strings: list[str], insults: int):
        self.kernel, self.strings, self.insults = kernel, strings, insults
        self.codes = [kernel.windows(text)[0] for text in strings]
        self.tables = [kernel.table(codes) for codes in self.codes]
        # Neighbours in the alphabet are alike, so that their common bound is close.
        order = sorted(range(insults), key=lambda place: strings[place])
        groups = [order[at : at + GROUP] for at in range(0, insults, GROUP)]
        self.bounds = [self._bound(group) for group in [order, *groups] if group]

    def __reduce__(self):
        return Landmarks, (self.kernel, self.strings, self.insults)

    def _bound(self, places: list[int]) -> np.ndarray:
        bound = np.zeros(LETTERS**3)
        for place in places:
            found, values = self.tables[place]
            bound[found] = np.maximum(bound[found], values)
        return bound

    def near(self, codes: list[bytes]) -> np.ndarray:
        """Places of the strings whose kernel with an insult may reach ``NEAR``: by the
        bound for all insults, and those that are left by the bounds for a few each."""
        if not self.bounds:
            return np.empty(0, np.int64)
        some = np.flatnonzero(self.kernel.products(codes, self.bounds[0], NEAR) > NEAR)
        left = [codes[place] for place in some.tolist()]
        close = np.zeros(len(left), bool)
        for bound in self.bounds[1:]:
            close |= self.kernel.products(left, bound, NEAR) > NEAR
        return some[close]

    def kernels(self, codes: list[bytes]) -> np.ndarray:
        return self.kernel.kernels(codes, self.tables) ** 2

    def nearest(self, units: list[str]) -> dict[str, float]:
        """The largest kernel with an insult of the units that reach ``NEAR``."""
        codes = _codes(self.kernel, units)
        places = self.near(codes).tolist()
        found = self.kernel.kernels([codes[i] for i in places], self.tables).max(axis=1, initial=0)
        return {units[i]: k for i, k in zip(places, found.tolist(), strict=True) if k >= NEAR}


@dataclass
class Model:
    """Weights by landmark, the bias, and the probability."""

    marks: Landmarks
    weights: np.ndarray
    bias: float
    curve: Steps | None

    def __post_init__(self):
        self._known: dict[str, float] = {}
        self._held = 0

    def __reduce__(self):
        return Model, (self.marks, self.weights, self.bias, self.curve)

    def unit_margins(self, units: list[str], floor: float = FLOOR) -> np.ndarray:
        """The margin of each unit, of a long one that of its worst window."""
        kernel = self.marks.kernel
        forms = [unit if unit.isalnum() else _letters(unit) for unit in units]
        windows = [
            [codes] if len(codes) <= LONGEST else kernel.windows(form)
            for form, codes in zip(forms, kernel.codes(forms), strict=True)
        ]
        flat = [codes for own in windows for codes in own]
        found = np.full(len(flat), floor)
        near = self.marks.near(flat)
        if len(near):
            kernels = self.marks.kernels([flat[i] for i in near.tolist()])
            found[near] = np.maximum(kernels @ self.weights + self.bias, floor)
        starts = np.cumsum([0, *map(len, windows)])[:-1]
        return np.maximum.reduceat(found, starts) if len(units) else found

    def margins(self, texts: list[str | None]) -> np.ndarray:
        """The margin of each text: of its worst unit, at least ``FLOOR``."""
        if self._held > REMEMBERED:
            self._known.clear()
            self._held = 0
        split = [text_units(text) for text in texts]
        known = self._known
        new = list({unit for own in split for unit in own if unit not in known})
        known.update(zip(new, self.unit_margins(new).tolist(), strict=True))
        self._held += sum(map(len, new)) + 150 * len(new)
        worst = [max(map(known.__getitem__, own), default=FLOOR) for own in split]
        return np.maximum(np.array(worst, np.float64), FLOOR)


def _letters(unit: str) -> str:
    return unit if unit.isalnum() else "".join(filter(str.isalnum, unit))


def _insults(documents: list[set[str]], labels: np.ndarray) -> dict[str, float]:
    """Units of toxic documents that hardly stand in harmless ones, with their log ratio."""
    counts = [Counter(), Counter()]
    for units, label in zip(documents, labels.tolist(), strict=True):
        counts[label].update(units)
    total = np.bincount(labels, minlength=2)
    least = max(SUPPORT, SHARE * total[1])
    ratios = {
        unit: float(
            np.log((n + 0.5) / (total[1] + 1))
            - np.log((counts[0][unit] + 0.5) / (total[0] + 1))
        )
        for unit, n in counts[1].items()
        if n >= least
    }
    return {unit: ratio for unit, ratio in ratios.items() if ratio > SURE}


def _strongest(insults: dict[str, float]) -> list[str]:
    return sorted(insults, key=lambda unit: (-insults[unit], unit))[:INSULTS]


def dual_descent(
    rows: np.ndarray, signs: np.ndarray, targets: np.ndarray, costs: np.ndarray
) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear hinge-loss model with a margin ``targets`` for each row.

    One dual variable at a time, until no slope that a variable can follow is above
    ``SETTLED``; variables at a bound that have nowhere to go are left out of a pass.
    """
    weights, bias = np.zeros(rows.shape[1]), 0.0
    duals = np.zeros(len(rows))
    norms = np.einsum("ij,ij->i", rows, rows) + 1
    rng = np.random.default_rng(0)
    active = np.arange(len(rows))
    for _ in range(EPOCHS):
        for i in rng.permutation(active).tolist():
            row = rows[i]
            slope = signs[i] * (float(row @ weights) + bias) - targets[i]
            new = min(max(duals[i] - slope / norms[i], 0.0), costs[i])
            change = (new - duals[i]) * signs[i]
            if change:
                duals[i] = new
                weights += change * row
                bias += change
        slopes = signs * (rows @ weights + bias) - targets
        free = np.where(duals <= 0, np.minimum(slopes, 0), slopes)
        free = np.where(duals >= costs, np.maximum(slopes, 0), free)
        if np.abs(free).max(initial=0) < SETTLED:
            break
        active = np.flatnonzero((np.abs(free) > SETTLED / 2) | ((duals > 0) & (duals < costs)))
    return weights, bias


def _train(
    kernel: Kernel,
    documents: list[set[str]],
    near: list[list[str]],
    score: dict[str, float],
    labels: np.ndarray,
) -> Model:
    """Rounds of: choose the units that stand for each harmless document, fit, score.

    ``near``: of each document, the units nearest to an insult; ``score``: how near.
    """
    insults = _insults(documents, labels)
    strongest = _strongest(insults)
    marks = Landmarks(kernel, strongest, len(strongest))
    if not strongest:
        return Model(marks, np.zeros(0), FLOOR, None)
    clean = [units for units, label in zip(near, labels.tolist(), strict=True) if not label]
    every = sorted({unit for units in clean for unit in units} - insults.keys())
    score = {unit: score[unit] for unit in every}
    positive = sorted(insults)
    chosen: set[str] = set()
    for _ in range(ROUNDS):
        for units in clean:
            own = [unit for unit in units if unit in score]
            chosen.update(sorted(own, key=lambda unit: (-score[unit], unit))[:WORST])
        harmless = sorted(chosen)
        hardest = sorted(harmless, key=lambda unit: (-score[unit], unit))[:HARMLESS]
        marks = Landmarks(kernel, strongest + hardest, len(strongest))
        gram = marks.kernels(marks.codes)
        values, vectors = np.linalg.eigh(gram)
        keep = values > 1e-6 * values.max()
        whiten = vectors[:, keep] / np.sqrt(values[keep])
        rows = marks.kernels(_codes(kernel, positive + harmless)) @ whiten
        signs = np.repeat([1.0, -1.0], [len(positive), len(harmless)])
        targets = np.ones(len(rows))
        targets[: len(positive)] = [insults[unit] / CLEAR for unit in positive]
        # Either label counts for half.
        costs = COST * len(rows) / 2 / np.repeat(
            [len(positive), max(1, len(harmless))], [len(positive), len(harmless)]
        )
        weights, bias = dual_descent(rows, signs, targets, costs)
        model = Model(marks, whiten @ weights, bias, None)
        score = dict(zip(every, model.unit_margins(every).tolist(), strict=True))
    return model


def _codes(kernel: Kernel, units: list[str]) -> list[bytes]:
    return [kernel.windows(unit)[0] for unit in units]


def _forms(kernel: Kernel, units: set[str]) -> set[str]:
    """Letters and digits of the units; of a long one those of each window."""
    found: set[str] = set()
    for unit in units:
        own = _letters(unit)
        if len(own) > LONGEST:
            half = LONGEST // 2
            found.update(own[at : at + LONGEST] for at in range(0, len(own) - half, half))
        elif len(own) > 2:
            found.add(own)
    return found


def fit(documents: list[set[str]], labels: np.ndarray) -> Model | float:
    """The model; with too few documents of a label, the share of label 1 (or 0.5).

    The probability is fitted to margins of documents that a fold's model has not seen.
    """
    fold = np.arange(len(labels)) % FOLDS
    parts = [fold == k for k in range(FOLDS)]
    if any(len(set(labels[~part])) < 2 or not part.any() for part in parts):
        return float(labels.mean()) if len(labels) else 0.5
    if len(set(labels)) < 2 or not any(documents):
        return float(labels.mean())
    letters = Counter(c for units in documents for unit in units for c in unit if c.isalnum())
    kernel = Kernel("".join(sorted(letters, key=lambda c: (-letters[c], c))[: LETTERS - 1]))
    forms = [_forms(kernel, units) for units in documents]
    # What is near an insult of a fold is near one of all documents, or of another fold.
    insults = _insults(forms, labels)
    for part in parts:
        some = _insults([forms[i] for i in np.flatnonzero(~part)], labels[~part])
        insults = some | insults
    strongest = _strongest(insults)
    marks = Landmarks(kernel, strongest, len(strongest))
    score = marks.nearest(sorted({unit for units in forms for unit in units}))
    near = [
        sorted(units & score.keys(), key=lambda unit: (-score[unit], unit))[:NEAREST] for units in forms
    ]
    margins = np.zeros(len(labels))
    for part in parts:
        seen = np.flatnonzero(~part)
        own = [forms[i] for i in seen], [near[i] for i in seen]
        model = _train(kernel, *own, score, labels[~part])
        for i in np.flatnonzero(part):
            margins[i] = max(model.unit_margins(near[i]), default=FLOOR)
    whole = _train(kernel, forms, near, score, labels)
    return Model(whole.marks, whole.weights, whole.bias, fit_steps(margins, labels))


def _sample_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The units of each document, each once: the same that are scored."""
    for batch in batches:
        (texts,) = columns(batch.select(["text"]))
        units = [sorted(text_units(text)) for text in texts]
        yield batch_of(
            rank=(batch.column("rank"), None),
            label=(batch.column("label"), None),
            units=(units, pa.list_(pa.string())),
        )


def train(docs: DataFrame, labels: DataFrame, label_col: str, **names: str) -> Model | float:
    """Fit on a sample of bounded size, on the driver: ``PER_CLASS``, ``SAMPLE_UNITS``."""
    chosen = sample(docs, labels, label_col, PER_CLASS, **names)
    made = in_batches(chosen, _sample_units, "rank long, label int, units array<string>")
    documents, found, held = [], [], 0
    for row in written(made, "sample").orderBy("rank").toLocalIterator():
        held += len(row.units) + 1
        if held > SAMPLE_UNITS:
            break
        documents.append(set(row.units))
        found.append(row.label)
    return fit(documents, np.array(found, np.int64))


_CALL_CHARS = 1 << 20


def _scores(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            if isinstance(known, float):
                scores = np.full(len(texts), known)
            else:
                scores = known.curve(known.margins(texts))
            yield batch_of(id=(batch.column("id"), None), score=(pa.array(scores), None))

    return run


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Score every document: ``id_col``, held_out, score, one row per row.

    Labels are learnt from documents that are not held out. A null or empty text has the
    least score; repeated ids each get their row, and a null id has no label; null labels
    and others than 0 and 1 are ignored. With too few labels of a kind every score is
    the share of label 1, or 0.5. An empty table gives no rows; other columns are ignored.
    """
    model = train(docs, labels, label_col, id_col=id_col, text_col=text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    scored = in_batches(rows, _scores(shared), f"id {kind}, score double")
    return scored.select(F.col("id").alias(id_col), held_out("id").alias("held_out"), "score")

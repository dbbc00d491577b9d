"""Labelled rows for the classifiers: the split, a bounded sample, probabilities."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: str | Column) -> Column:
    """True for the ids whose labels are never learnt from; a null id is not held out."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str,
    per_class: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """rank, label, text of at most ``per_class`` documents of either label, by a hash of the id.

    Held-out ids are left out. Only the ids of the sample are broadcast.
    """
    known = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
        .filter(F.col("label").isin(0, 1) & F.col("id").isNotNull())
        .filter(~held_out("id"))
        .groupBy("id")
        .agg(F.max("label").alias("label"))  # of labels that contradict each other, 1
        .withColumn("rank", F.xxhash64("id"))
    )
    parts = [
        known.filter(F.col("label") == label).orderBy("rank", "id").limit(per_class)
        for label in (0, 1)
    ]
    chosen = F.broadcast(parts[0].unionByName(parts[1]))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.join(chosen, "id").select("rank", "label", "text")


@dataclass(frozen=True)
class Platt:
    """The probability of label 1 from a margin."""

    slope: float
    offset: float

    def __call__(self, margins: np.ndarray) -> np.ndarray:
        z = np.clip(self.slope * margins + self.offset, -500, 500)
        return 1 / (1 + np.exp(-z))


def fit_platt(margins: np.ndarray, labels: np.ndarray, steps: int = 100) -> Platt:
    """Logistic fit by Newton's method, with targets drawn in from 0 and 1."""
    ones = int(labels.sum())
    zeros = len(labels) - ones
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    slope, offset = 0.0, np.log((ones + 1) / (zeros + 1))

    def loss(a: float, b: float) -> float:
        z = a * margins + b
        return float(np.sum(np.logaddexp(0, z) - target * z))

    now = loss(slope, offset)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + offset, -500, 500)))
        error, weight = p - target, p * (1 - p)
        gradient = np.array([np.sum(error * margins), np.sum(error)])
        hessian = np.array(
            [
                [np.sum(weight * margins * margins) + 1e-9, np.sum(weight * margins)],
                [np.sum(weight * margins), np.sum(weight) + 1e-9],
            ]
        )
        step = np.linalg.lstsq(hessian, gradient, rcond=None)[0]
        size = 1.0
        while size > 1e-6:
            new = slope - size * step[0], offset - size * step[1]
            value = loss(*new)
            if value < now:
                break
            size /= 2
        else:
            break
        done = now - value < 1e-9 * max(1.0, now)
        (slope, offset), now = new, value
        if done:
            break
    return Platt(float(slope), float(offset))


@dataclass(frozen=True)
class Steps:
    """The probability of label 1 from a margin: steps that rise, and a little within each."""

    edges: np.ndarray
    values: np.ndarray

    def __call__(self, margins: np.ndarray) -> np.ndarray:
        step = self.values[np.searchsorted(self.edges, margins, "right")]
        within = 1 / (1 + np.exp(-np.clip(margins, -50, 50)))
        return step * (1 - 2 * _WITHIN) + _WITHIN * (0.5 + within)


_WITHIN = 1e-3
# Margins that a step stands for, at least.
_STEP = 8
# Share of a step's margins that count as its range.
_MOST = 0.99


def fit_steps(margins: np.ndarray, labels: np.ndarray) -> Steps:
    """The likeliest rising steps: neighbours whose shares of label 1 fall are put together.

    A step begins midway between its first margin and the highest but a few of the one below.
    """
    places, at = np.unique(margins, return_inverse=True)
    blocks: list[list[float]] = []  # first and last margin, rows, of them label 1

    def merge() -> None:
        _, last, n, k = blocks.pop()
        blocks[-1][1:] = last, blocks[-1][2] + n, blocks[-1][3] + k

    rows, ones = np.bincount(at).tolist(), np.bincount(at, labels).tolist()
    for place, n, k in zip(places.tolist(), rows, ones, strict=True):
        blocks.append([place, place, n, k])
        while len(blocks) > 1 and blocks[-1][3] * blocks[-2][2] <= blocks[-2][3] * blocks[-1][2]:
            merge()
    # A small step goes to the one below it.
    steps, blocks = blocks, []
    for step in steps:
        blocks.append(step)
        if len(blocks) > 1 and (step[2] < _STEP or blocks[-2][2] < _STEP):
            merge()
    values = np.array([(k + 0.5) / (n + 1) for *_, n, k in blocks])
    edges = []
    for low, high in zip(blocks, blocks[1:], strict=False):
        own = margins[(margins >= low[0]) & (margins <= low[1])]
        edges.append((np.quantile(own, _MOST) + high[0]) / 2)
    return Steps(np.array(edges), np.maximum.accumulate(values))

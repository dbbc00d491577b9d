import random
import zlib

import numpy as np
import pytest

from punchcard.llm import nbsvm
from punchcard.llm.labelled import fit_platt, held_out, sample
from punchcard.llm.nbsvm import dual_descent, features, fit, log_ratios, quality_scores, shape

SF_DIR = "/root/testdata/sf0.01"


def auc(scores, labels):
    order = sorted(zip(scores, labels))
    ones = [i for i, (_, label) in enumerate(order) if label]
    n = len(ones)
    return (sum(ones) - n * (n - 1) / 2) / (n * (len(order) - n))


@pytest.fixture
def labelled(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")

    return make


def test_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    scored = quality_scores(docs, labels).collect()
    assert len(scored) == docs.count() and all(0 <= r.score <= 1 for r in scored)
    for r in scored:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    known = {r.doc_id: r.quality for r in labels.collect()}
    rows = [(r.score, known[r.doc_id]) for r in scored if r.held_out and r.doc_id in known]
    scores, truth = zip(*rows)
    assert auc(scores, truth) >= 0.97
    assert sum((s >= 0.5) == t for s, t in rows) >= 0.95 * len(rows)


def test_labels_of_held_out_documents_are_not_read(documents, labelled):
    docs = documents([f"good words {i}" if i % 2 else f"bad### stuff*** {i}" for i in range(120)])
    true = [(i, i % 2, 0) for i in range(120)]
    lied = [(i, q if zlib.crc32(str(i).encode()) % 3 != 1 else 1 - q, 0) for i, q, _ in true]
    first = sorted(map(tuple, quality_scores(docs, labelled(true)).collect()))
    assert first == sorted(map(tuple, quality_scores(docs, labelled(lied)).collect()))
    assert all((score >= 0.5) == i % 2 for i, _, score in first)


def test_the_sample_is_bounded(documents, labelled):
    docs = documents([str(i) for i in range(300)])
    labels = labelled([(i, int(i < 200), 0) for i in range(300)])
    rows = sample(docs, labels, "quality", 20).collect()
    assert sorted(r.label for r in rows) == [0] * 20 + [1] * 20
    assert all(zlib.crc32(r.text.encode()) % 3 != 1 for r in rows)


def test_odd_rows(documents, labelled, spark):
    texts = [None, "", (7, "a b"), (7, "a b"), (None, "x"), "word, " * 60_000]
    none = labelled([])
    rows = quality_scores(documents(texts), none).collect()
    assert len(rows) == 6 and {r.score for r in rows} == {0.5}
    odd = labelled([(1, None, None), (None, 1, 0), (7, 1, 0), (7, 1, 0), (0, 7, 7)])
    assert {r.score for r in quality_scores(documents(texts), odd).collect()} == {1.0}
    assert quality_scores(documents([]), none).count() == 0
    assert sorted(str(r.held_out) for r in rows if r.doc_id is None) == ["False"]


def test_features_are_the_same_either_way():
    rng = random.Random(0)
    words = ["a", "Bc", "D!!", "12", "é,", "x|y"]
    text = " ".join(rng.choices(words, k=60_000))
    found = features(text)
    assert list(found) == sorted(set(found))
    assert set(features(text[:100_000])) <= set(found)
    assert len(features("")) == len(features(None)) == 0
    assert len(features("one")) == 2


def test_shapes():
    words = {"word": "a", "Word,": "Aa,", "ABC!!": "A!", "a1b22": "a0a0", "###": "#", "é.": "a.", "McX": "AaA"}
    assert {w: shape(w) for w in words} == words


def test_ratios_and_descent_against_plain_forms(monkeypatch):
    monkeypatch.setattr(nbsvm, "EPOCHS", 400)
    rng = np.random.default_rng(1)
    rows = [np.unique(rng.integers(0, 30, 8)) for _ in range(60)]
    labels = np.array([int(7 in r or 9 in r) for r in rows])
    ratios = log_ratios(rows, labels)
    ones = sum(label and 7 in r for r, label in zip(rows, labels))
    zeros = sum(not label and 7 in r for r, label in zip(rows, labels))
    size = [sum(len(r) for r, x in zip(rows, labels) if x == k) + nbsvm.FEATURES for k in (0, 1)]
    assert ratios[7] == pytest.approx(np.log((ones + 1) / size[1] / ((zeros + 1) / size[0])))

    scaled = [(r, ratios[r]) for r in rows]
    signs, costs = np.where(labels == 1, 1.0, -1.0), np.ones(60)
    weights, bias = dual_descent(scaled, signs, costs)

    def loss(w, b):
        margins = [s * (w[r] @ v + b) for (r, v), s in zip(scaled, signs)]
        return 0.5 * (w @ w + b * b) + sum(max(0, 1 - m) for m in margins)

    best = loss(weights, bias)
    for _ in range(300):  # no step near it is better
        step = rng.normal(size=30) * 10 ** rng.uniform(-4, 0)
        other = weights.copy()
        other[:30] += step
        assert loss(other, bias + rng.normal() * 0.01) >= best - 1e-3


def test_platt_separates():
    margins = np.r_[np.linspace(-3, 0.4, 50), np.linspace(-0.4, 3, 50)]
    labels = np.r_[np.zeros(50, int), np.ones(50, int)]
    platt = fit_platt(margins, labels)
    p = platt(margins)
    assert platt.slope > 0 and p[0] < 0.1 and p[-1] > 0.9
    assert p.mean() == pytest.approx(0.5, abs=0.02)
    assert isinstance(fit([], np.array([], int)), float)

import itertools
import random
import re

import pytest

from punchcard.llm import decontamination
from punchcard.llm.decontamination import MASKS, SPAN, decontaminated, overlaps

SF_DIR = "/root/testdata/sf0.01"


def words(text):
    return [w for w in re.split(r"[\s!-/:-@\[-`{-~]+", (text or "").lower()) if w]


def needed(size):
    return size - (3 if size >= 15 else 2 if size >= 13 else 1)


def plain_overlaps(docs, items):
    """{(doc, item): (window, matched, doc start, item start)} by trying all places."""
    found = {}
    for item_id, item_text in items:
        iw = words(item_text)
        size = min(15, len(iw))
        if size < 8:
            continue
        places = {}
        for i, w in enumerate(iw):
            places.setdefault(w, []).append(i)
        for doc_id, text in docs:
            dw = words(text)
            shifts = {d - i for d, w in enumerate(dw) for i in places.get(w, ())}
            best = None
            for shift in shifts:
                low, high = max(0, -shift), min(len(iw), len(dw) - shift)
                equal = [dw[i + shift] == iw[i] for i in range(low, high)]
                for at in range(len(equal) - size + 1):
                    matched = sum(equal[at : at + size])
                    if matched >= needed(size):
                        key = (matched, -(low + at + shift), -(low + at))
                        best = max(best or key, key)
            if best:
                found[doc_id, item_id] = (size, best[0], -best[1], -best[2])
    return found


def check(docs, items):
    found = {(r.id, r.item): tuple(r)[3:] for r in overlaps(docs, items).collect()}
    want = plain_overlaps(
        docs.select("doc_id", "text").collect(), items.select("item_id", "text").collect()
    )
    assert found == want
    return found


@pytest.mark.parametrize("size", range(8, 22))
def test_masks_hit_every_allowed_window(size):
    """Windows longer than 15 hold one of 15 with its share of differences or fewer."""
    window = min(size, 15)
    most = window - needed(window)
    for differing in itertools.combinations(range(window), most):
        assert any(
            all(at + offset not in differing for offset in mask)
            for mask in MASKS
            for at in range(window - SPAN + 1)
        )


@pytest.fixture
def items(spark):
    def make(texts):
        rows = list(enumerate(texts))
        return spark.createDataFrame(rows, "item_id long, text string")

    return make


def test_documents_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert check(docs, spark.read.parquet(f"{SF_DIR}/benchmark.parquet"))


def test_substitutions(documents, items):
    rng = random.Random(5)
    passages = [[f"w{rng.randrange(10**6)}" for _ in range(n)] for n in (8, 12, 13, 14, 15, 40, 600)]
    texts = []
    for passage in passages:
        for changed in range(6):
            for _ in range(4):
                own = list(passage)
                for at in rng.sample(range(len(own)), changed):
                    own[at] = "other"
                texts.append("before it " + ", ".join(own).upper() + ". After it")
                cut = rng.randrange(len(own))
                texts.append(" ".join(own[cut:] + ["tail"]))
    assert check(documents(texts), items([" ".join(p) for p in passages]))


def test_blocks_of_seeds(documents, items, monkeypatch):
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", 150)
    passages = [" ".join(f"{i}x{j}" for j in range(30)) for i in range(20)]
    check(documents([f"a b {p} c" for p in passages[::3]] + ["none"]), items(passages))


def test_odd_rows(documents, items):
    text = "one two three four five six seven eight nine"
    docs = documents([(1, None), (2, ""), (3, text), (3, text), (None, text), (4, "word " * 30_000)])
    found = check(docs, items([None, "", "too short", text, text]))
    assert set(found) == {(3, 3), (3, 4), (None, 3), (None, 4)}
    left = decontaminated(docs, items([text]))
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [1, 2, 4]


def test_names_that_clash(spark, items):
    text = "one two three four five six seven eight nine"
    schema = "doc_id long, text string, _hit_id string, _hit_h string, h int, piece int, id int, dw int"
    docs = spark.createDataFrame([(1, text, "a", "b", 1, 2, 3, 4), (2, "x", *"ab", 1, 2, 3, 4)], schema)
    left = decontaminated(docs, items([text]))
    assert left.columns == docs.columns and [r.doc_id for r in left.collect()] == [2]


def test_repetitive_texts(documents, items):
    """An item many times over, and a word many times over: hits are places, not texts."""
    passage = " ".join(f"w{i}" for i in range(30))
    same = "same " * 40
    texts = [f"{passage}. " * 60, "same " * 3000, f"{same} x " * 20, passage]
    check(documents(texts), items([passage, same, "same " * 9]))


def test_long_repetitive_text_in_little_memory(documents, items):
    """Five megabytes of one item: 800,000 words and as many hits."""
    passage = " ".join(f"w{i}" for i in range(30))
    found = overlaps(documents([f"{passage} " * 50_000]), items([passage])).collect()
    assert [tuple(r)[2:] for r in found] == [(0, 15, 15, 0, 0)]


def test_empty_tables(documents, items):
    assert overlaps(documents([]), items(["a b c d e f g h"])).count() == 0
    assert overlaps(documents(["a b c d e f g h"]), items([])).count() == 0
    assert decontaminated(documents(["a"]), items([])).count() == 1


def test_no_python(documents, items):
    plan = overlaps(documents(["a"]), items(["b"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan

import hashlib
import random

import numpy as np
import pytest

from punchcard.llm import suffix_dedup
from punchcard.llm.suffix_dedup import IndexFamily, anchors, remove_repeats
from punchcard.llm.common import written

SF_DIR = "/root/testdata/sf0.01"


def plain_removal(rows, length=100):
    """(n_bytes, n_removed, n_spans, sha) of each (id, text), from all strings."""
    seen, result = set(), []
    for _, text in rows:
        raw = (text or "").encode()
        covered = np.zeros(len(raw) + 1, bool)
        for at in range(len(raw) - length + 1):
            own = raw[at : at + length]
            if own in seen:
                covered[at : at + length] = True
            else:
                seen.add(own)
        flags = covered[:-1]
        rest = bytes(b for b, gone in zip(raw, flags) if not gone)
        spans = int(np.sum(flags & ~np.r_[False, flags[:-1]]))
        result.append((len(raw), int(flags.sum()), spans, hashlib.sha256(rest).hexdigest()))
    return result


def check(docs, length=100, **options):
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    found = remove_repeats(docs, length, **options).collect()
    figures = {r.row.doc_id: tuple(r)[1:5] for r in found}
    assert len(found) == len(rows)
    assert [figures[i] for i, _ in rows] == plain_removal(rows, length)
    for r in found:
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256
    return figures


def test_all_documents(spark):
    figures = check(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    assert sum(f[1] for f in figures.values()) > 0


def made_texts(seed, count=60):
    rng = random.Random(seed)
    lines = ["".join(rng.choices("abcé ", k=rng.randrange(40, 400))) for _ in range(12)]
    texts = []
    for _ in range(count):
        own = [rng.choice(lines) for _ in range(rng.randrange(5))]
        own.append("".join(rng.choices("abc ", k=rng.randrange(300))))
        rng.shuffle(own)
        text = "".join(own)
        cut = rng.randrange(len(text) + 1)
        texts.append(text[cut:] + rng.choice(["", "x"]) + text[:cut])
    return texts


@pytest.mark.parametrize("batches", [1, 2, 3, 5])
def test_shared_passages(documents, batches):
    check(documents(made_texts(batches)), batches=batches)


@pytest.mark.parametrize("length", [48, 200])
def test_other_lengths(documents, length):
    check(documents(made_texts(length)), length)


def test_repeats_inside_one_document(documents):
    check(documents(["a" * 500, "ab" * 300, "a" * 99, "a" * 100, "abc" * 33, None, "", "é" * 120]))


def test_long_texts_are_cut(documents, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 300)
    texts = made_texts(9, 12)
    long = "".join(texts)
    check(documents([long, "y" + long[50:900], *texts, long]))


def test_repeated_rows_and_null_ids(documents):
    text = "".join(random.Random(1).choices("abcdef ", k=300))
    rows = remove_repeats(documents([(5, text), (5, text), (9, text), (None, text)])).collect()
    found = sorted((r.row.doc_id is not None, r.row.doc_id, r.n_removed) for r in rows)
    assert found == [(False, None, 0), (True, 5, 300), (True, 5, 300), (True, 9, 300)]
    alone = remove_repeats(documents([(5, text), (5, text)])).collect()
    assert [r.n_removed for r in alone] == [0, 0]


def test_empty_table_and_names(documents, spark):
    assert remove_repeats(documents([])).count() == 0
    schema = "doc_id long, text string, h int, c int, t int, loc int, row int, id int, found int"
    one = spark.createDataFrame([(1, "x" * 150, 1, 2, 3, 4, 5, 6, 7)], schema)
    assert remove_repeats(one).first().row.found == 7
    with pytest.raises(ValueError):
        remove_repeats(one, 40)


def test_anchors_of_equal_windows_are_alike():
    rng = random.Random(2)
    passage = bytes(rng.choices(b"abc", k=180))
    texts = [bytes(rng.choices(b"abc", k=n)) + passage + b"zz" for n in (0, 7, 150)]
    per_window = []
    for text in texts:
        data = np.frombuffer(text, np.uint8)
        h, c, first, left, span = anchors(data, np.array([len(text)]), 100)
        starts = {}
        for k in range(len(h)):
            for i in range(span[k] + 1):
                starts[int(first[k]) + i] = (int(h[k]), int(left[k]) - i)
        assert sorted(starts) == list(range(len(text) - 99))
        base = len(text) - len(passage) - 2
        per_window.append([starts[base + i] for i in range(81)])
    assert per_window[0] == per_window[1] == per_window[2]


def test_equal_levels_merge(spark):
    family = IndexFamily()
    for i in range(7):
        rows = [(1, 2, i, 0, 5, False), (i, i, i, 0, 0, False), (7, i, i, 0, 9, True)]
        schema = "h long, c long, id long, t int, loc long, later boolean"
        family.add(spark.createDataFrame(rows, schema))
    assert sorted(family.levels) == [0, 1, 2]
    whole = sorted((r.h, r.id) for r in family.whole().collect())
    assert whole == sorted([(1, 0), *((i, i) for i in range(7))])
    later = sorted((r.id, r.loc) for frame in family.found for r in frame.collect())
    assert later == sorted([*((i, 5) for i in range(1, 7)), *((i, 9) for i in range(7))])


def test_earlier_entries_are_told_within_rows():
    import pyarrow as pa

    rng = np.random.default_rng(3)
    ids, ts = [3, None, 3, 5, None], [1, 1, 1, 0, 2]
    for _ in range(50):
        n = 60
        h, c = (rng.integers(0, 3, n).astype(np.uint64) for _ in range(2))
        rows, loc = rng.integers(0, 5, n), rng.integers(0, 4, n)
        made = suffix_dedup._marked(
            h, c, pa.array(ids, pa.int64()), pa.array(ts, pa.int32()), rows, loc
        ).to_pylist()
        place = lambda k: (ids[rows[k]] is not None, ids[rows[k]] or 0, ts[rows[k]], loc[k])
        for k in range(n):
            own = [place(j) for j in range(n) if h[j] == h[k] and c[j] == c[k]]
            assert made[k]["later"] == (place(k) > min(own))
            assert made[k]["later"] or made[k]["c"] == c[k]

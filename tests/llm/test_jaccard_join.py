import random
import re

import pytest

from punchcard.llm import jaccard_join
from punchcard.llm.jaccard_join import jaccard_components, shingle_set

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, node string, component string, n string, shingles string"


def plain_set(text, size=3):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return frozenset()
    return frozenset(" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def plain_components(rows, percent=90, size=3):
    """(id, size of its set, least id of its group) of each row, by comparing all."""
    sets = [plain_set(text, size) for _, text in rows]
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            small, large = sorted((len(a), len(b)))
            if a and b and 100 * small >= percent * large:
                shared = len(a & b)
                if 100 * shared >= percent * (len(a) + len(b) - shared):
                    group[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            at = find(i)
            least[at] = min(doc_id, least.get(at, doc_id))
    return [
        (doc_id, len(sets[i]), least.get(find(i)) if sets[i] else doc_id)
        for i, (doc_id, _) in enumerate(rows)
    ]


def check(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA)
    found = [tuple(r) for r in jaccard_components(frame, **options).collect()]
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    want = plain_components(rows, options.get("percent", 90), options.get("shingle", 3))
    assert sorted(found, key=key) == sorted(want, key=key)
    return want


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        how = rng.random()
        if how < 0.4:
            words[at] = f"w{rng.randrange(5000)}"
        elif how < 0.7:
            words.insert(at, f"w{rng.randrange(5000)}")
        else:
            del words[at]
    return " ".join(words)


def test_all_documents_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    groups = check(spark, [tuple(r) for r in rows])
    assert sum(doc != group for doc, _, group in groups) > 10


@pytest.mark.parametrize(("frequent", "percent"), [(3, 90), (16, 60)])
def test_groups_of_near_copies(spark, monkeypatch, frequent, percent):
    """Many near copies of few texts, near the limit, and texts that share a long passage."""
    monkeypatch.setattr(jaccard_join, "FREQUENT", frequent)
    rng = random.Random(frequent + percent)
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for _ in range(6):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([12, 40, 90, 150]))]
        texts += [edited(rng, words, rng.randrange(8)) for _ in range(45)]
    for _ in range(60):
        own = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(1, 90))]
        texts.append(" ".join([*own, *passage, *own[:3]]))
    texts += [edited(rng, passage, rng.randrange(3)) for _ in range(40)]
    rng.shuffle(texts)
    groups = check(spark, list(enumerate(texts)), percent=percent)
    assert len({group for _, _, group in groups}) < len(groups) * 0.8


@pytest.mark.parametrize("rounds", [0, 2])
def test_what_leaders_miss(spark, monkeypatch, rounds):
    """A chain of texts, each like the next one only, found by pairs alone or with a round."""
    monkeypatch.setattr(jaccard_join, "ROUNDS", rounds)
    monkeypatch.setattr(jaccard_join, "FREQUENT", 4)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words[4 * i : 4 * i + 100]) for i in range(60)]
    groups = check(spark, [(100 - i, t) for i, t in enumerate(texts)])
    assert {group for _, _, group in groups} == {41}


def test_odd_texts(spark):
    texts = [None, "", " \n\t", "one", "One", "two words", "two\x0bWORDS", "é\xa0x", "a b c", "A b\nC", "b c a"]
    texts += ["x y " * 60_000, "y x " * 60_000, "a b c d " * 30, "日" * 3000]
    check(spark, list(enumerate(texts)))


def test_repeated_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(7, text), (7, text + " more"), (7, "else"), (None, text), (3, text), (3, None), (None, "")]
    check(spark, [*rows, (None, "alone here"), (None, "alone here")])


def test_empty_tables(spark):
    check(spark, [])
    check(spark, [(1, None), (2, " ")])


def test_words_in_blocks(monkeypatch):
    text = " ".join(f"Word{i % 700}" for i in range(9000)) + "\n"
    whole = shingle_set(text, 3)
    assert len(whole) == len(plain_set(text))
    monkeypatch.setattr(jaccard_join, "_BLOCK", 100)
    assert (shingle_set(text, 3) == whole).all()

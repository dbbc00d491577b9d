import random
import re
from collections import Counter

import pytest

from punchcard.llm.quality_rules import LineRules, judge, quality_rules

SF_DIR = "/root/testdata/sf0.01"
PROSE = "The river ran past the mill, and nobody in the village minded it much that year. "


def plain_figures(text):
    text = text or ""
    words = re.split(r"[\x20\x09-\x0D]+", text)
    words = [w for w in words if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (
        len(words),
        sum(len(w) for w in words),
        sum(text.count(c) for c in "#*$%&|<>"),
        sum(line in lines[:i] for i, line in enumerate(lines)),
        len(covered),
        failed,
    )


def figures(row):
    return tuple(row)[1:7]


def test_all_documents_against_plain_figures(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = quality_rules(docs, with_text=False).collect()
    assert len(found) == len(texts)
    for row in found:
        assert figures(row) == plain_figures(texts[row.doc_id])
        assert not (row.base_failed and row.kept)


def test_random_texts():
    rng = random.Random(2)
    for _ in range(3000):
        text = "".join(rng.choices(["a", "b ", "c\n", "\t", "é ", "# ", "\x0b", "\xa0"], k=rng.randrange(90)))
        assert judge(text, LineRules())[:6] == plain_figures(text)


@pytest.mark.parametrize(
    "line",
    [
        "Home | News | Sport | Weather | Contact",
        "win### money*** now$$$ for%%% all&&& of### you***",
        "BUY THIS NOW OR MISS OUT ON THE DEAL OF THE YEAR",
        "GREAT!! DEAL!! TODAY!! ONLY!! HERE!!",
        "We use cookies to make this site better.",
        "and and and and and and and and and and",
        "word " * 70,
    ],
)
def test_failing_lines_go(documents, line):
    text = PROSE * 8 + "\n" + line + "\n" + PROSE
    row = quality_rules(documents([text])).first()
    assert row.n_failed_lines == 1 and line not in row.clean_text
    assert PROSE * 8 in row.clean_text


@pytest.mark.parametrize(
    "line",
    [
        PROSE,
        "A heading without a full stop",
        "NASA and ESA signed it.",
        "Costs rose by 5% to $40 & fell again.",
        "He asked whether it was in the privacy policy, which it was not, as far as anybody knew then.",
        "Ist das so? Ja!",
    ],
)
def test_good_lines_stay(documents, line):
    assert line in quality_rules(documents([line])).first().clean_text


def test_documents_that_lose_too_much_go(documents):
    junk = [f"a{i} | b{i} | c{i} | d{i} | e{i}" for i in range(60)]
    prose = [", ".join(f"word{i}x{j}" for j in range(10)) + "." for i in range(12)]
    mixed, mostly = "\n".join(prose + junk[:5]), "\n".join(prose[:2] + junk)
    first, second = quality_rules(documents([mixed, mostly])).orderBy("doc_id").collect()
    assert first.kept and not second.kept


def test_odd_rows(documents, spark):
    texts = [None, "", " \n\t\n", (7, PROSE * 9), (7, PROSE * 9), (None, "x"), "word " * 200_000]
    rows = quality_rules(documents(texts)).collect()
    assert len(rows) == 7
    for row in rows[:3]:
        assert row.n_words == 0 and row.base_failed and not row.kept
    assert quality_rules(documents([])).count() == 0
    schema = "doc_id long, text string, kept string, row int, clean_text int"
    one = spark.createDataFrame([(1, PROSE, "k", 2, 3)], schema)
    assert quality_rules(one, keep_columns=True).first().row.kept == "k"


def test_labelled_quality(spark):
    """Clean documents of enough words stay, and most of the others go."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    rows = quality_rules(docs).join(labels, "doc_id").collect()
    clean = [r.kept for r in rows if r.quality == 1 and not r.base_failed]
    poor = [r.kept for r in rows if r.quality == 0]
    assert sum(clean) >= 0.98 * len(clean) and sum(poor) <= 0.1 * len(poor)

from collections import defaultdict

import corpus_pipeline
from corpus_pipeline import COLUMNS, STAGES, decontamination_stage, line_stage
from corpus_pipeline import near_duplicate_stage, packing_stage, quality_stage
from punchcard.llm.common import written
from punchcard.llm.quality_rules import LineRules, judge
from tests.llm.test_decontamination import plain_overlaps
from tests.llm.test_line_chunks import searched_removal
from tests.llm.test_simhash import plain_components, plain_fingerprint

SF_DIR = "/root/testdata/sf0.01"


def rows_of(frame):
    assert tuple(frame.columns) == COLUMNS
    return sorted((tuple(r) for r in frame.collect()), key=lambda r: (r[0], r[1] or ""))


def with_text(row, text):
    doc_id, old, lang, source, n_chars = row
    return (doc_id, text, lang, source, n_chars if text == old else len(text))


def test_stages_against_brute_force(spark):
    """Each stage on what the one before it kept, over all documents."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select(*COLUMNS)
    before = rows_of(docs)

    docs = written(quality_stage(spark, docs, SF_DIR), "quality")
    want = []
    for row in before:
        verdict = judge(row[1], LineRules())
        if verdict[9]:
            want.append(with_text(row, verdict[10]))
    after = rows_of(docs)
    assert after == want and 0 < len(after) < len(before)

    docs = written(line_stage(spark, docs, SF_DIR), "lines")
    kept = searched_removal([(r[0], r[1]) for r in after])
    before, after = after, rows_of(docs)
    # Repeats within a document are left to the test of periodic lines.
    plain = {r[0] for r in before if len(set(r[1].split("\n"))) == r[1].count("\n") + 1}
    want = [
        with_text(row, kept[row[0]])
        for row in before
        if row[0] in plain and (kept[row[0]] == row[1] or kept[row[0]].strip())
    ]
    assert [row for row in after if row[0] in plain] == want and after != before
    assert len(plain) > len(before) * 0.8

    docs = written(near_duplicate_stage(spark, docs, SF_DIR), "near")
    groups = plain_components([plain_fingerprint(row[1]) for row in after])
    want = [row for i, row in enumerate(after) if groups[i] == i]
    before, after = after, rows_of(docs)
    assert after == want and len(after) < len(before)

    docs = written(decontamination_stage(spark, docs, SF_DIR), "clean")
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()
    hit = {doc for doc, _ in plain_overlaps([row[:2] for row in after], items)}
    want = [row for row in after if row[0] not in hit]
    before, after = after, rows_of(docs)
    assert after == want and hit

    pieces = packing_stage(spark, docs, SF_DIR).collect()
    assert {p.doc_id for p in pieces} == {row[0] for row in after}
    ends = defaultdict(int)
    for p in pieces:
        ends[p.sequence_id] = max(ends[p.sequence_id], p.offset + p.length)
    assert sum(ends.values()) == sum(p.length for p in pieces)
    whole = corpus_pipeline.run(spark, SF_DIR).select("doc_id", "piece", "ids_crc32").collect()
    assert sorted(map(tuple, whole)) == sorted((p.doc_id, p.piece, p.ids_crc32) for p in pieces)


def test_odd_documents_through_all_stages(documents, spark):
    prose = " ".join(f"word{i}," for i in range(80)) + "."
    lines = "\n".join(f"Line {i} of a text that says {i} and {i + 1}, then {i * 7}." for i in range(9))
    docs = documents(
        [None, "", prose, prose, (2, lines), (2, prose + " more"), (None, lines), "x y " * 90_000]
    )
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, SF_DIR), "stage")
        assert tuple(docs.columns) == COLUMNS
    found = docs.select("doc_id", "text").collect()
    assert (2, prose) in map(tuple, found)
    assert STAGES[-1][1](spark, docs, SF_DIR).count() >= len(found)


def test_empty_table(documents, spark):
    docs = documents([])
    for _, stage in STAGES:
        docs = stage(spark, docs, SF_DIR)
        assert docs.count() == 0

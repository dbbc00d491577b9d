"""The registered queries: names, columns, and results against SQL."""

import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from punchcard.llm.queries import ORACLE, QUERIES

SF_DIR = os.environ.get("PUNCHCARD_SF_DIR", "/root/testdata/sf0.01")

COLUMNS = {
    "op1_string_kernel_toxicity": {"doc_id", "held_out", "score", "predicted"},
    "op2_site_style": {"page_id", "url", "text", "n_chars"},
    "op3_nbsvm_quality": {"doc_id", "held_out", "score", "predicted"},
    "op4_benchmark_overlaps": {"doc_id", "item_id"},
    "op5_best_fit_packing": {
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        "sequence_id",
        "offset",
    },
    "op6_suffix_dedup": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
    "op7_token_counts": {"doc_id", "n_bytes", "n_tokens", "over_limit"},
    "op8_line_chunks": {"doc_id", "text"},
    "op9_quality_rules": {
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    },
    "op10_simhash_components": {"doc_id", "fingerprint", "component_id"},
    "op11_conversation_repair": {
        "conv_id",
        "gaps",
        "blank",
        "duplicate",
        "truncated",
        "illegal",
        "cost",
        "audit",
        "repaired_sha256",
    },
    "op12_jaccard_components": {"doc_id", "n_shingles", "component_id"},
    "op13_nsimplex_clusters": {
        "vec_id",
        "cluster",
        "distance",
        "cluster_inertia",
        "inertia",
        "centroid_sha256",
    },
    "pipeline": {"doc_id", "piece", "sequence_id", "offset"},
}


def test_all_are_registered():
    assert set(COLUMNS) == set(QUERIES)
    assert contract.queries().items() >= QUERIES.items()
    assert contract.oracle_sql().items() >= ORACLE.items()


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, name):
    found = QUERIES[name](spark, "/root/testdata/sf0.001")
    assert COLUMNS[name] <= set(found.columns)
    rows = found.collect()
    source = {"op2": "pages", "op11": "conversations", "op13": "embeddings"}.get(
        name.split("_")[0], "documents"
    )
    if name not in ("op4_benchmark_overlaps", "op5_best_fit_packing", "pipeline"):
        whole = spark.read.parquet(f"/root/testdata/sf0.001/{source}.parquet")
        whole = whole.select("conv_id").distinct() if source == "conversations" else whole
        assert len(rows) == whole.count()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, name):
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    rows = connection.execute(ORACLE[name]).fetchall()
    columns = [column[0] for column in connection.description]
    found = QUERIES[name](spark, SF_DIR)
    assert sorted(found.columns) == sorted(columns)
    assert Counter(tuple(r) for r in found.select(*columns).collect()) == Counter(rows)
    connection.close()

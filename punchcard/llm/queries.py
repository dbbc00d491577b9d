"""The registered queries of this package, each over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punchcard.llm.common import shared_folder, table
from punchcard.llm.conversations import conversation_repairs, damaged
from punchcard.llm.decontamination import overlaps
from punchcard.llm.jaccard_join import jaccard_components
from punchcard.llm.line_chunks import remove_repeated_chunks
from punchcard.llm.nbsvm import quality_scores
from punchcard.llm.nsimplex import centroid_clusters
from punchcard.llm.oracle import ORACLE
from punchcard.llm.packing import pack_documents
from punchcard.llm.quality_rules import quality_rules
from punchcard.llm.simhash import simhash_components
from punchcard.llm.site_style import main_texts
from punchcard.llm.string_kernel import toxicity_scores
from punchcard.llm.suffix_dedup import remove_repeats
from punchcard.llm.token_counts import token_counts

TOKEN_LIMIT = 4096


def op1_string_kernel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from the labels that are not held out."""
    scored = toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op2_site_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = main_texts(table(spark, sf_dir, "pages"))
    return found.select(
        F.col("row.page_id").alias("page_id"),
        F.col("row.url").alias("url"),
        "text",
        F.length("text").cast("long").alias("n_chars"),
    )


def op3_nbsvm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learnt from the labels that are not held out."""
    scored = quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op4_benchmark_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a passage of a benchmark item, with its best window."""
    found = overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    best = F.max(F.struct("matched", "n_words", (-F.col("doc_start")).alias("d"), (-F.col("item_start")).alias("i")))
    return (
        found.groupBy(F.col("id").alias("doc_id"), F.col("item").alias("item_id"))
        .agg(best.alias("best"))
        .select(
            "doc_id",
            "item_id",
            "best.n_words",
            "best.matched",
            (-F.col("best.d")).alias("doc_start"),
            (-F.col("best.i")).alias("item_start"),
        )
    )


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, packed into sequences of at most 4096 tokens."""
    return pack_documents(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("word_bpe_49k.json"),
        capacity=TOKEN_LIMIT,
        by_words=True,
    )


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes under strings of 100 bytes that start earlier."""
    found = remove_repeats(table(spark, sf_dir, "documents"), length=100)
    figures = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    return found.select(F.col("row.doc_id").alias("doc_id"), *figures)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, in two batches through a cache that starts empty."""
    counted = token_counts(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("piece_bpe_32k.model"),
        shared_folder(spark, "token_cache"),
        batches=2,
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op8_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the multi-line chunks that an earlier place holds."""
    cleaned = remove_repeated_chunks(table(spark, sf_dir, "documents"))
    return cleaned.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_lines",
        "n_chunks",
        "n_removed_chunks",
        "n_removed_lines",
        F.col("clean_text").alias("text"),
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures and verdict of every document."""
    return quality_rules(table(spark, sf_dir, "documents"), with_text=False)


def op10_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document: 4-word shingles, 4 bits."""
    grouped = simhash_components(table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return grouped.select("doc_id", "fingerprint", "component_id")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation, after the damage that its turns' crc32 tells."""
    harmed = damaged(table(spark, sf_dir, "conversations"))
    return conversation_repairs(harmed, live_col="live")


def op12_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of the set of 3-word shingles of every document, and its group: 90 of 100 shared."""
    return jaccard_components(table(spark, sf_dir, "documents"), shingle=3, percent=90)


def op13_nsimplex_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's cluster of 40, after 5 rounds, and the distances within the clusters."""
    return centroid_clusters(table(spark, sf_dir, "embeddings"), k=40, rounds=5, dims=64, scale=256)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in [
        op1_string_kernel_toxicity,
        op2_site_style,
        op3_nbsvm_quality,
        op4_benchmark_overlaps,
        op5_best_fit_packing,
        op6_suffix_dedup,
        op7_token_counts,
        op8_line_chunks,
        op9_quality_rules,
        op10_simhash_components,
        op11_conversation_repair,
        op12_jaccard_components,
        op13_nsimplex_clusters,
    ]
} | {"pipeline": corpus_pipeline.run}

__all__ = ["ORACLE", "QUERIES"]

"""A corpus made ready for training: five stages over the documents.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it kept,
and is written as Parquet before the next one reads it. All but the last give
documents again, with the columns doc_id, text, lang, source and n_chars.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punchcard.llm.common import table, written
from punchcard.llm.decontamination import decontaminated
from punchcard.llm.line_chunks import remove_repeated_chunks
from punchcard.llm.packing import pack_documents
from punchcard.llm.quality_rules import quality_rules
from punchcard.llm.simhash import simhash_components

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _with_text(cleaned: DataFrame) -> DataFrame:
    """Documents with their cleaned text; one that lost nothing stays as it was."""
    same = F.col("row.text") == F.col("clean_text")
    return cleaned.select(
        F.col("row.doc_id").alias("doc_id"),
        F.when(F.col("row.text").isNull(), None).otherwise(F.col("clean_text")).alias("text"),
        F.col("row.lang").alias("lang"),
        F.col("row.source").alias("source"),
        F.when(F.col("row.text").isNull() | same, F.col("row.n_chars"))
        .otherwise(F.length("clean_text").cast("long"))
        .alias("n_chars"),
    )


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, without the lines that fail a rule."""
    judged = quality_rules(docs.select(*COLUMNS), keep_columns=True)
    return _with_text(judged.filter("kept"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated runs of lines; one that is all repeats goes."""
    cleaned = remove_repeated_chunks(docs.select(*COLUMNS))
    gone = (F.col("n_removed_lines") > 0) & (F.trim("clean_text") == "")
    return _with_text(cleaned.filter(~gone))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the least id."""
    # Rows equal in id and text are one document; an id alone need not be.
    keyed = docs.select(*COLUMNS).withColumn("key", F.struct("doc_id", F.xxhash64("text").alias("h")))
    grouped = simhash_components(keyed, shingle=4, radius=4, id_col="key")
    kept = grouped.filter(F.col("key") == F.col("component_id")).select("key").distinct()
    return keyed.join(kept, "key", "left_semi").dropDuplicates(["key"]).select(*COLUMNS)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    return decontaminated(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences of 4096 tokens."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return pack_documents(docs, path, capacity=4096, by_words=True)


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

# Hashes and a tokenizer decide; tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs

"""Token counts through a digest cache.

The cache is a Parquet table of (content digest, token count) for each tokenizer
version. Digests of the texts are joined to it; only distinct texts that it does
not hold are encoded, and their counts are appended. Content is a text's UTF-8 bytes with
a null as empty: a library normalises on its own, so any other form would change counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from importlib.metadata import version

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punchcard.llm.common import batch_of, columns, if_small, in_batches, text_of, written

_CACHE = "digest binary, n_tokens long"
# Texts that go to the library in one call hold about this many characters.
_CALL_CHARS = 1 << 18


def tokenizer_digest(path: str) -> str:
    """Names the tokenizer version: the vocabulary file and the library that reads it."""
    library = "tokenizers" if path.endswith(".json") else "sentencepiece"
    with open(path, "rb") as file:
        content = hashlib.sha256(file.read()).hexdigest()
    return hashlib.sha256(f"{library} {version(library)} {content}".encode()).hexdigest()


@lru_cache(maxsize=2)
def _counter(path: str):
    """Counts the tokens of a list of texts, with the library of the file."""
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return lambda texts: [
            len(e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ]
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(path)
        for batch in batches:
            digests, texts = columns(batch)
            counts: list[int] = []
            part: list[str] = []
            held = 0
            for text in texts:
                part.append(text)
                held += len(text)
                if held >= _CALL_CHARS:
                    counts += count(part)
                    part, held = [], 0
            if part:
                counts += count(part)
            yield batch_of(digest=(digests, pa.binary()), n_tokens=(counts, pa.int64()))

    return run


def read_cache(spark: SparkSession, folder: str) -> DataFrame | None:
    """The stored counts of one tokenizer version; None if there are none yet."""
    try:
        stored = spark.read.schema(_CACHE).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    # Two runs at a time may both store a text; its count is the same.
    return stored.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def _fill(texts: DataFrame, folder: str, model_path: str) -> None:
    """Append the counts of the texts (digest, text) that the cache does not hold."""
    stored = read_cache(texts.sparkSession, folder)
    if stored is not None:
        # Digests alone find the misses, so that known texts are not moved.
        missing = texts.select("digest").distinct().join(stored, "digest", "left_anti")
        texts = texts.join(if_small(written(missing, "missing")), "digest", "left_semi")
    misses = texts.dropDuplicates(["digest"])
    in_batches(misses, _encode(model_path), _CACHE).write.mode("append").parquet(folder)


def token_counts(
    docs: DataFrame,
    model_path: str,
    cache_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    batches: int = 1,
) -> DataFrame:
    """Count the tokens of every text: ``id_col``, n_bytes, n_tokens, one row per row.

    A null text counts as empty (0 bytes, 0 tokens); null and repeated ids each give their
    row; equal texts are encoded once; an empty table gives no rows. Other columns of
    ``docs`` are ignored. Rows go through the cache in ``batches``, by a hash of the id: if
    the job breaks off, a later one with the same cache goes on after the last whole batch.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).select(
        "id",
        "text",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
    )
    folder = f"{cache_path.rstrip('/')}/{tokenizer_digest(model_path)}"
    for batch in range(batches):
        own = rows if batches == 1 else rows.filter(F.pmod(F.xxhash64("id"), F.lit(batches)) == batch)
        _fill(own.select("digest", "text"), folder, model_path)
    # Written, so that a digest with very many rows can be split in the join.
    counts = written(read_cache(docs.sparkSession, folder), "counts")
    counted = rows.drop("text").join(counts, "digest")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens")

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from punchcard.llm.common import shared_folder
from punchcard.llm.token_counts import read_cache, token_counts, tokenizer_digest

SF_DIR = "/root/testdata/sf0.01"
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def counter(path):
    if path.endswith(".model"):
        model = SentencePieceProcessor(model_file=path)
        return lambda text: len(model.encode(text or "", num_threads=1))
    tokenizer = Tokenizer.from_file(path)
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def check(docs, path, cache):
    count = counter(path)
    found = token_counts(docs, path, cache).collect()
    rows = docs.select("doc_id", "text").collect()
    want = [(r.doc_id, len((r.text or "").encode()), count(r.text)) for r in rows]
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)


def test_all_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    check(docs, PIECES, shared_folder(spark, "cache"))


@pytest.mark.parametrize("path", [PIECES, WORDS])
def test_odd_rows(documents, spark, path):
    texts = [None, "", " ", "<s>a</s>", "<|endoftext|>", "é😀", (3, "x"), (3, "x"), (None, "y"), "word " * 90_000]
    check(documents(texts), path, shared_folder(spark, "cache"))
    check(documents([]), path, shared_folder(spark, "cache"))


def test_only_misses_are_encoded(documents, spark):
    cache = shared_folder(spark, "cache")
    stored = f"{cache}/{tokenizer_digest(PIECES)}"
    check(documents(["a", "a", "b"]), PIECES, cache)
    assert spark.read.parquet(stored).count() == 2
    check(documents(["b", "c", "c", "a"]), PIECES, cache)
    assert spark.read.parquet(stored).count() == 3
    # The other tokenizer has a cache of its own.
    check(documents(["a"]), WORDS, cache)
    assert spark.read.parquet(stored).count() == 3
    assert read_cache(spark, f"{cache}/none") is None


def test_stored_counts_are_used(documents, spark):
    cache = shared_folder(spark, "cache")
    stored = f"{cache}/{tokenizer_digest(PIECES)}"
    check(documents(["some text"]), PIECES, cache)
    digest = spark.read.parquet(stored).first().digest
    wrong = f"{cache}-2/{tokenizer_digest(PIECES)}"
    for _ in range(2):  # as if two runs had stored it
        spark.createDataFrame([(digest, 99)], "digest binary, n_tokens long").write.mode(
            "append"
        ).parquet(wrong)
    found = token_counts(documents(["some text"]), PIECES, f"{cache}-2").collect()
    assert [r.n_tokens for r in found] == [99]


def test_later_batches_meet_stored_counts(documents, spark):
    """Copies in both batches are stored once, as the second joins what the first stored."""
    texts = [f"text {i % 20}" for i in range(200)]
    cache = shared_folder(spark, "cache")
    count = counter(PIECES)
    found = token_counts(documents(texts), PIECES, cache, batches=2).collect()
    assert sorted(r.n_tokens for r in found) == sorted(map(count, texts))
    files = spark.read.parquet(f"{cache}/{tokenizer_digest(PIECES)}")
    assert files.count() == files.select("digest").distinct().count() == 20


def test_the_query_meets_stored_counts(spark, monkeypatch):
    from punchcard.llm import queries, token_counts as module

    seen = []
    real = module.read_cache

    def spied(session, folder):
        stored = real(session, folder)
        seen.append(None if stored is None else stored.count())
        return stored

    monkeypatch.setattr(module, "read_cache", spied)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = queries.op7_token_counts(spark, SF_DIR).count()
    distinct = docs.fillna("", ["text"]).select("text").distinct().count()
    assert found == docs.count()
    assert seen[0] is None and 0 < seen[1] < seen[2] == distinct < found

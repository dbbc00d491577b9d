import math
import random
import zlib
from array import array
from collections import defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from punchcard.llm import packing
from punchcard.llm.packing import Capacities, TextIds, WordIds, best_fit, pack_documents

PATH = public_tokenizers.path("word_bpe_49k.json")
SF_DIR = "/root/testdata/sf0.01"

ODD = [
    "a\x1cb c\x85d \xa0e",
    "İstanbul ΑΣ Σ ß ΑΣ. Straße!!",
    "<|endoftext|>x <|startoftext|> <|ENDOFTEXT|> a<|endoftext|>",
    "it's  don't\r\nx\x0by é ́x wörd,' naïvé! Áb.",
    " ",
    "",
    "\n\n\t",
    "日本語 テスト😀👍🏽 1234 ½ ²",
    "İx É. ǅe ab²c x²! _a_ a_b ﬁre,, ſt! KelvinK <a>b|c ÷× a÷b",
    "ALL!! word### $$$ a-b (c) [d] {e}",
]


@pytest.fixture(scope="module")
def plain_ids():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def check(docs, plain_ids, capacity=4096):
    rows = pack_documents(docs, PATH, capacity, by_words=True).collect()
    want = defaultdict(list)
    for row in docs.select("doc_id", "text").collect():
        ids = plain_ids(row.text)
        for piece, start in enumerate(range(0, len(ids), capacity)):
            own = ids[start : start + capacity]
            want[row.doc_id].append(
                (piece, start, len(own), zlib.crc32(array("I", own).tobytes()))
            )
    found = defaultdict(list)
    places = defaultdict(list)
    for r in rows:
        found[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        places[r.sequence_id].append((r.offset, r.length))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}
    for own in places.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= capacity
    return len(places), sum(r.length for r in rows)


def test_all_documents(spark, plain_ids):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    sequences, tokens = check(docs, plain_ids)
    assert sequences <= math.ceil(tokens / 4096) * 1.01


@pytest.mark.parametrize("shard", [3, 8192])
def test_odd_texts_in_shards(documents, plain_ids, monkeypatch, shard):
    monkeypatch.setattr(packing, "SHARD", shard)
    docs = documents([*ODD, None, None, "word " * 5000, (3, "again"), (3, "again")])
    check(docs, plain_ids, 16)


def test_empty_table_and_null_ids(documents, plain_ids):
    assert pack_documents(documents([]), PATH).count() == 0
    check(documents([(None, "some text"), (None, "")]), plain_ids)


@pytest.mark.parametrize("remembered", [0, 50, 10**6])
def test_words_give_the_ids_of_the_text(spark, monkeypatch, remembered):
    monkeypatch.setattr(packing, "REMEMBERED", remembered)
    rng = random.Random(remembered)
    letters = "aAbéÉß.,!'<|> \n\t1²日_́-"
    texts = ODD + ["".join(rng.choices(letters, k=rng.randrange(60))) for _ in range(2000)]
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(100).collect()
    texts += [row.text for row in rows]
    by_words = WordIds(PATH)
    assert by_words(texts) + by_words(texts) == 2 * TextIds(PATH)(texts)


def test_best_fit_takes_the_tightest():
    rng = random.Random(1)
    lengths = sorted((rng.randint(1, 100) for _ in range(800)), reverse=True)
    remaining, want = [], []
    for length in lengths:
        fitting = [r for r in remaining if r >= length]
        want.append(min(fitting) - length if fitting else 100 - length)
        if fitting:
            remaining.remove(min(fitting))
        remaining.append(want[-1])
    placed = best_fit(lengths, 100)
    assert [100 - o - n for (_, o), n in zip(placed, lengths)] == want


def test_capacities():
    tree = Capacities(7)
    tree.add(3, 1)
    tree.add(6, 2)
    assert tree.tightest(7) is None
    assert tree.tightest(4) == (6, 2)
    assert tree.tightest(4) is None
    assert tree.tightest(1) == (3, 1)


def test_remembered_bytes_are_bounded(monkeypatch, plain_ids):
    """Text without blanks: long words, none of which comes again."""
    monkeypatch.setattr(packing, "REMEMBERED", 1 << 20)
    encode = WordIds(PATH)
    rng = random.Random(2)
    for _ in range(30):
        texts = [" ".join(chr(rng.randrange(0x4E00, 0x9000)) * 500 for _ in range(20))]
        assert list(array("I", encode(texts)[0])) == plain_ids(texts[0])[:-1]
        held = sum(4 * len(w) + len(ids) for w, ids in encode._words.items())
        assert held < 2 << 20

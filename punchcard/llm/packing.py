"""Best-fit packing of tokenized documents into sequences of bounded length.

Documents are tokenized and cut into pieces; pieces are dealt into shards of about
``SHARD`` pieces, and each shard is packed by best fit in decreasing order: a
segment tree over remaining capacities names the tightest open sequence for a
piece in logarithmic time. A shard leaves about one sequence partly empty, of the
thousands it fills.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punchcard.llm.common import batch_of, in_batches, written

SHARD = 8192
# Bytes of words that a worker remembers, by estimate; beyond, it forgets them all.
REMEMBERED = 320 << 20
# Latin letters, then marks other than the apostrophe and the brackets of special tokens.
_LETTERS_MARKS = re.compile(
    r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+([!-%(-/:;=?@\[-`{|}~]*)"
)
_WORD_END = "</w>"
_JOINED = 200


def _spaced(text: str) -> str:
    """Blanks for the white space that parts words here; the tokenizer sees to the rest."""
    return text.replace("\n", " ").replace("\t", " ").replace("\r", " ")


def _tokenizer(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class WordIds:
    """Ids of texts as little-endian unsigned 32-bit bytes, word by word.

    For a tokenizer that drops white space, parts letters from marks, and ends each part
    with a token that says so: the ids of a text are those of its words in a row, and a
    word is encoded once. Plain words go to the library joined by blanks, and the ends of
    their parts tell them apart; all others go one by one.
    """

    def __init__(self, path: str):
        self._tokenizer = _tokenizer(path)
        vocabulary = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends[[i for token, i in vocabulary.items() if token.endswith(_WORD_END)]] = True
        self._words: dict[str, bytes] = {}
        self._held = 0  # bytes, by estimate

    def __call__(self, texts: list[str]) -> list[bytes]:
        if self._held > REMEMBERED:
            self._words.clear()
            self._held = 0
        split = [_spaced(text).split(" ") for text in texts]
        found = [list(map(self._words.get, words)) for words in split]
        gaps = [[i for i, ids in enumerate(own) if ids is None] for own in found]
        new = {words[i] for words, own in zip(split, gaps, strict=True) for i in own}
        self._learn(new)
        # A letter takes up to four bytes; two objects and a place in the table, the rest.
        self._held += sum(4 * len(word) + len(self._words[word]) + 200 for word in new)
        for words, own, empty in zip(split, found, gaps, strict=True):
            for i in empty:
                own[i] = self._words[words[i]]
        return [b"".join(own) for own in found]

    def _learn(self, words: set[str]) -> None:
        whole: list[str] = []
        plain: list[str] = []
        parts: list[int] = []
        for word in words:
            match = _LETTERS_MARKS.fullmatch(word)
            if match:
                plain.append(word)
                parts.append(2 if match[1] else 1)
            else:
                whole.append(word)
        self._words.update(zip(whole, self._encode(whole), strict=True))
        joined = [plain[i : i + _JOINED] for i in range(0, len(plain), _JOINED)]
        encoded = self._tokenizer.encode_batch_fast(
            [" ".join(own) for own in joined], add_special_tokens=False
        )
        for number, (own, one) in enumerate(zip(joined, encoded, strict=True)):
            ids = np.array(one.ids, "<u4")
            ends = np.flatnonzero(self._ends[ids]) + 1
            last = np.cumsum(parts[number * _JOINED : (number + 1) * _JOINED])
            if len(ends) != last[-1]:
                self._words.update(zip(own, self._encode(own), strict=True))
                continue
            cuts = [0, *(4 * ends[last - 1]).tolist()]
            raw = ids.tobytes()
            self._words.update(
                (word, raw[a:b]) for word, a, b in zip(own, cuts, cuts[1:], strict=False)
            )

    def _encode(self, texts: list[str]) -> list[bytes]:
        encoded = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", one.ids).tobytes() for one in encoded]


class TextIds:
    """Ids of whole texts, for any tokenizer of the library."""

    def __init__(self, path: str):
        self._tokenizer = _tokenizer(path)

    def __call__(self, texts: list[str]) -> list[bytes]:
        encoded = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", found.ids).tobytes() for found in encoded]


@lru_cache(maxsize=2)
def _encoder(path: str, by_words: bool):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
    return WordIds(path) if by_words else TextIds(path)


# Texts that are encoded in one call hold about this many characters.
_CALL_CHARS = 1 << 20


def _calls(texts: list[str | None]) -> Iterator[list[str]]:
    part: list[str] = []
    held = 0
    for text in texts:
        part.append(text or "")
        held += len(part[-1])
        if held >= _CALL_CHARS:
            yield part
            part, held = [], 0
    if part:
        yield part


def _pieces(path: str, by_words: bool, end_id: int, capacity: int):
    end = array("I", [end_id]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path, by_words)
        for batch in batches:
            rows, numbers, starts, lengths, sums = [], [], [], [], []
            row = 0
            for texts in _calls(batch.column("text").to_pylist()):
                for ids in encode(texts):
                    ids += end
                    for number, at in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[at : at + 4 * capacity]
                        rows.append(row)
                        numbers.append(number)
                        starts.append(at // 4)
                        lengths.append(len(own) // 4)
                        sums.append(zlib.crc32(own))
                    row += 1
            yield batch_of(
                id=(batch.column("id").take(pa.array(rows, pa.int64())), None),
                piece=(numbers, pa.int32()),
                start=(starts, pa.int64()),
                length=(lengths, pa.int64()),
                ids_crc32=(sums, pa.int64()),
            )

    return run


class Capacities:
    """Open sequences by remaining capacity, under a segment tree.

    A node tells how many open sequences lie below it; ``tightest`` climbs from a
    capacity to the first node on its right that holds one, and goes down its left edge.
    """

    def __init__(self, capacity: int):
        self._size = 1 << capacity.bit_length()
        self._held = [0] * (2 * self._size)
        self._open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, remaining: int, sequence: int) -> None:
        self._open[remaining].append(sequence)
        self._count(remaining, 1)

    def _count(self, remaining: int, step: int) -> None:
        node = remaining + self._size
        while node:
            self._held[node] += step
            node >>= 1

    def tightest(self, length: int) -> tuple[int, int] | None:
        """Takes out (remaining, sequence) with the least remaining that is enough."""
        held, node = self._held, length + self._size
        while not held[node]:
            while node & 1:  # a right child: what is on its right lies higher up
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self._size:
            node *= 2
            if not held[node]:
                node += 1
        remaining = node - self._size
        self._count(remaining, -1)
        return remaining, self._open[remaining].pop()


def best_fit(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """(sequence, offset) of each length; the lengths come in decreasing order."""
    open_, placed, opened = Capacities(capacity), [], 0
    for length in lengths:
        found = open_.tightest(length)
        if found is None:
            found = capacity, opened
            opened += 1
        remaining, sequence = found
        placed.append((sequence, capacity - remaining))
        if remaining > length:
            open_.add(remaining - length, sequence)
    return placed


def _packed(capacity: int):
    def pack(shard: pd.DataFrame) -> pd.DataFrame:
        # One shard, of about SHARD pieces.
        shard = shard.sort_values(
            ["length", "id", "piece", "ids_crc32"], ascending=[False, True, True, True]
        )
        placed = best_fit(shard["length"].tolist(), capacity)
        number = int(shard["shard"].iloc[0])
        return shard.drop(columns="shard").assign(
            sequence_id=[(number << 32) + sequence for sequence, _ in placed],
            offset=[offset for _, offset in placed],
        )

    return pack


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 4096,
    end_id: int = 1,
    by_words: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pack all documents: ``id_col``, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and ``end_id``; only those longer than ``capacity`` are cut.
    A null or empty text is the end alone. Null and repeated ids each give their own
    pieces; an empty table gives no rows; other columns are ignored. ``by_words`` is for
    tokenizers that drop white space, see ``WordIds``.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    fields = f"id {kind}, piece int, start long, length long, ids_crc32 long"
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    pieces = written(
        in_batches(rows, _pieces(tokenizer_path, by_words, end_id, capacity), fields), "pieces"
    )
    shards = max(1, round(pieces.count() / SHARD))
    # The number of a row deals evenly, also where one id has very many rows.
    shard = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)).cast("long")
    packed = (
        pieces.withColumn("shard", shard)
        .groupBy("shard")
        .applyInPandas(_packed(capacity), f"{fields}, sequence_id long, offset long")
    )
    return packed.withColumnRenamed("id", id_col)

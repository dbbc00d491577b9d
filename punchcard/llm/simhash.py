"""SimHash near-duplicates, compared bit plane by bit plane.

Fingerprints that agree in enough blocks of bits meet in a bucket. In a bucket
the bits stand vertically: one plane holds one bit of all fingerprints. The
distances of many pairs grow together in carry-save counters, three more planes,
and a block is given up once all its distances exceed the radius.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punchcard.llm.common import batch_of, columns, in_batches, written
from punchcard.llm.components import components

BITS = 64
SEED = 42
# Largest part of a bucket that one task compares with another part.
PART = 4096
# Rows that a task compares at a time; buckets are never cut by it.
CHUNK = 200_000
# Buckets of at most this many rows are compared together, by shifted planes.
SMALL = 6
_HASHES = 1 << 14


def fingerprint(text: str | None, shingle: int) -> int:
    """The unsigned fingerprint of the words of a text; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(word) + 1 for word in words))
    starts = [0, *ends]
    size = min(shingle, len(words))
    n = len(words) - size + 1
    digest = xxhash.xxh64_digest
    total = np.zeros(BITS, np.int64)
    for at in range(0, n, _HASHES):
        hashes = b"".join(
            [
                digest(joined[a : b - 1], SEED)
                for a, b in zip(
                    starts[at : min(n, at + _HASHES)], ends[at + size - 1 :], strict=False
                )
            ]
        )
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, BITS)
        total += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big")


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (texts,) = columns(batch.select(["text"]))
            found = np.array([fingerprint(text, shingle) for text in texts], np.uint64)
            yield batch_of(
                id=(batch.column("id"), None), fp=(pa.array(found.view(np.int64)), None)
            )

    return run


def fingerprints(docs: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """(id, fp) of every row; fp is the fingerprint as a signed long."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return in_batches(rows, _fingerprints(shingle), f"id {kind}, fp long")


def _bucket_keys(radius: int, intact: int) -> list[Column]:
    """Keys such that fingerprints within the radius share at least one.

    Of radius + intact blocks, the differing bits touch at most radius; one key
    for each choice of intact blocks, from their bits and the number of the choice.
    """
    blocks = radius + intact
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    keys = []
    for number, chosen in enumerate(combinations(masks, intact)):
        mask = sum(chosen)
        signed = mask - (1 << BITS) if mask >> (BITS - 1) else mask
        keys.append(F.xxhash64(F.lit(number), F.col("fp").bitwiseAND(F.lit(signed))))
    return keys


def _planes(fps: np.ndarray) -> list[int]:
    """Bit planes: the number at b has bit i set if fingerprint i has bit b set."""
    bits = np.unpackbits(fps.astype("<u8").view(np.uint8), bitorder="little").reshape(-1, BITS)
    packed = np.packbits(bits.T, axis=1, bitorder="little")
    return [int.from_bytes(row.tobytes(), "little") for row in packed]


def _bits(mask: int, n: int) -> np.ndarray:
    """Places of the bits set in ``mask``."""
    raw = np.frombuffer(mask.to_bytes((n + 7) // 8, "little"), np.uint8)
    return np.flatnonzero(np.unpackbits(raw, bitorder="little", count=n))


def _within(differing: Iterator[int], open_: int, radius: int) -> int:
    """Of the pairs in ``open_``, those with at most ``radius`` differing planes.

    Counters: as many planes as radius + 1 needs, and pairs whose count passes the
    radius are closed at once; the block is given up when none is open.
    """
    counters = [0] * radius.bit_length()
    for b, plane in enumerate(differing):
        carry = plane & open_
        for i, counter in enumerate(counters):
            counters[i], carry = counter ^ carry, counter & carry
        open_ &= ~carry
        if b >= radius:
            open_ &= ~_above(counters, radius)
            if not open_:
                return 0
    return open_


def _above(counters: list[int], radius: int) -> int:
    """The pairs whose counter, less than a power of two, is above the radius."""
    above, equal = 0, -1
    for i in reversed(range(len(counters))):
        if radius >> i & 1:
            equal &= counters[i]
        else:
            above |= equal & counters[i]
            equal &= ~counters[i]
    return above


def _bucket_forest(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges that join what is linked in one bucket, found by search from each row."""
    n = len(fps)
    planes = _planes(fps)
    unseen = (1 << n) - 1
    values = [int(fp) for fp in fps]
    edges: list[tuple[int, int]] = []
    while unseen:
        start = (unseen & -unseen).bit_length() - 1
        unseen ^= 1 << start
        frontier = [start]
        while frontier and unseen:
            at = frontier.pop()
            value = values[at]
            near = _within(
                (~plane if value >> b & 1 else plane for b, plane in enumerate(planes)),
                unseen,
                radius,
            )
            if near:
                unseen &= ~near
                found = _bits(near, n).tolist()
                edges += [(at, other) for other in found]
                frontier += found
    return edges


def linked(keys: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked places among rows sorted by key: a forest for each large bucket."""
    n = len(keys)
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, n])
    left: list[np.ndarray] = []
    right: list[np.ndarray] = []
    small = np.repeat((sizes > 1) & (sizes <= SMALL), sizes)
    places = np.flatnonzero(small)
    if len(places):
        own_keys, planes = keys[places], _planes(fps[places])
        for shift in range(1, SMALL):
            same = own_keys[shift:] == own_keys[:-shift]
            if not same.any():
                break
            mask = int.from_bytes(np.packbits(same, bitorder="little").tobytes(), "little")
            near = _within((plane ^ plane >> shift for plane in planes), mask, radius)
            found = _bits(near, len(places))
            left.append(places[found])
            right.append(places[found + shift])
    for start, size in zip(
        starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist(), strict=True
    ):
        edges = _bucket_forest(fps[start : start + size], radius)
        if edges:
            pairs = np.array(edges, np.int64) + start
            left.append(pairs[:, 0])
            right.append(pairs[:, 1])
    none = np.empty(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _links(radius: int):
    def compare(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        a, b = linked(keys, fps.view(np.uint64), radius)
        pairs = np.unique(np.stack([fps[a], fps[b]], axis=1), axis=0)
        return batch_of(u=(pa.array(pairs[:, 0]), None), v=(pa.array(pairs[:, 1]), None))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_keys, held_fps, held = [], [], 0
        for batch in batches:
            held_keys.append(batch.column("key").to_numpy(zero_copy_only=False))
            held_fps.append(batch.column("fp").to_numpy(zero_copy_only=False))
            held += batch.num_rows
            if held < CHUNK:
                continue
            keys, fps = np.concatenate(held_keys), np.concatenate(held_fps)
            cut = int(np.searchsorted(keys, keys[-1], "left"))  # the last bucket may go on
            if cut:
                yield compare(keys[:cut], fps[:cut])
            held_keys, held_fps, held = [keys[cut:]], [fps[cut:]], len(keys) - cut
        if held:
            yield compare(np.concatenate(held_keys), np.concatenate(held_fps))

    return run


def fingerprint_links(nodes: DataFrame, radius: int, intact: int = 2) -> DataFrame:
    """Edges (u, v) that connect the distinct fingerprints ``fp`` within the radius.

    Every two linked fingerprints are connected by the edges; not every pair is an
    edge. A bucket of more than ``PART`` rows is dealt out in parts, and every two
    parts meet in a task of their own.
    """
    keys = nodes.select("fp", F.explode(F.array(*_bucket_keys(radius, intact))).alias("key"))
    sizes = keys.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > PART)
    large = written(sizes.withColumn("parts", F.ceil(F.col("n") / PART).cast("int")), "large")
    if not large.isEmpty():
        # A large bucket has over PART rows, so there are few of them; the join is
        # left to Spark, which splits what is skewed.
        part = F.pmod(F.xxhash64(F.col("fp"), F.lit(1)), F.col("parts")).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
        spread = (
            keys.join(large.select("key", "parts"), "key", "left")
            .withColumn("parts", F.coalesce("parts", F.lit(1)))
            .withColumn("part", part)
            .withColumn("other", other)
        )
        # One key for every two parts; a bucket in one part keeps its key.
        keys = spread.select(
            "fp",
            F.when(F.col("parts") == 1, F.col("key"))
            .otherwise(F.xxhash64("key", F.least("part", "other"), F.greatest("part", "other")))
            .alias("key"),
        )
    dealt = keys.repartition("key").sortWithinPartitions("key")
    return in_batches(dealt.select("key", "fp"), _links(radius), "u long, v long")


def simhash_components(
    docs: DataFrame,
    shingle: int = 4,
    radius: int = 4,
    intact: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Group documents: ``id_col``, fp (signed long), fingerprint, component_id, one row per row.

    component_id is the least id that links reach from a row, its own included. A null
    or empty text has the fingerprint zero and is linked like any other. A null id
    counts only where a group has no other. Repeated ids give their rows each; an
    empty table gives no rows. Other columns are ignored.
    """
    fps = written(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    nodes = written(fps.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    grouped = components(fingerprint_links(nodes, radius, intact))
    rooted = nodes.join(grouped, nodes["fp"] == grouped["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("root")
    )
    rooted = written(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return fps.join(named, "fp").select(
        F.col("id").alias(id_col),
        "fp",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )

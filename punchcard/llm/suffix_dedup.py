"""Removal of long byte strings that stand earlier in the corpus, by a family of indexes.

An index is a sparse suffix array: of the suffixes of all documents it holds those at
anchors, sorted by head and context. An anchor is where the hash of ``HEAD`` bytes is the
least among the heads in a window of ``length`` bytes; that depends on nothing but the
bytes of the window, so that equal windows have their anchor at the same place, and
suffixes with equal heads lie next to each other. The documents come in batches, by
ascending id. Each batch gets an array of its own, and arrays of equal size are merged,
so that few are left. The scan of a sorted array, or of two that are merged, tells which
contexts stand earlier: those of an anchor with all its windows at once. Where a head
has several contexts, its windows are looked at in cells of neighbouring ones, and where
the common part of a cell has several contexts, one by one.

Repeats within a batch of rows are told before the shuffle, so that copies do not pile up
in a task, and no step needs all contexts of a head in one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punchcard.llm.common import batch_of, discard, in_batches, text_of, written_and_swept

HEAD = 24
BATCHES = 2
CELL = 16  # neighbouring windows that are first looked at together
# Bytes that are looked at together; longer texts are cut, with windows over the cuts.
SEGMENT = 1 << 20
# Bounds of the length; an entry holds offsets below 256.
SHORTEST, LONGEST = 2 * HEAD, 200

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_BYTES = np.random.default_rng(20).integers(0, 1 << 64, 256, np.uint64)
_ORDER = ("id", "t", "loc")
_ENTRY = "h long, c long, id long, t int, loc long, later boolean"


class _Powers:
    """Powers of an odd base and of its inverse, modulo 2 ** 64."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
            self.up, self.down = (
                np.cumprod(np.r_[np.ones(1, np.uint64), np.full(n, base)], dtype=np.uint64)
                for base in (_BASE, inverse)
            )
        return self.up, self.down


_POWERS = _Powers()


def _mixed(values: np.ndarray) -> np.ndarray:
    mixed = values >> np.uint64(31)
    mixed ^= values
    mixed *= _MIX
    mixed ^= mixed >> np.uint64(29)
    return mixed


class Hashes:
    """Hashes of any strings of an array of bytes, from one pass of sums."""

    def __init__(self, data: np.ndarray):
        up, self._down = _POWERS.of(len(data))
        terms = _BYTES[data] * up[: len(data)]
        self._sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])

    def all(self, width: int) -> np.ndarray:
        """Of all strings of the width, in order."""
        sums = self._sums[width:] - self._sums[:-width]
        return _mixed(sums * self._down[: len(sums)])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _mixed((self._sums[ends] - self._sums[starts]) * self._down[starts])


# Places in a segment; the rest of a number is the top of a hash.
_PLACE_BITS = 22
_PLACE = np.uint64((1 << _PLACE_BITS) - 1)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the least of ``width`` values from each place on; ties go to the first."""
    now = (values & ~_PLACE) | np.arange(len(values), dtype=np.uint64)
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        now = np.minimum(now[:-step], now[step:])
        reach += step
    return (now & _PLACE).astype(np.int64)


def anchors(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: (head hash, context hash, first start, left, span).

    ``ends`` are the ends of the documents in ``data``; no window crosses one. The
    windows of a run start at first start .. first start + span, and the anchor is at
    first start + left.
    """
    if len(data) < length:
        return (np.empty(0, np.uint64),) * 2 + (np.empty(0, np.int64),) * 3
    hashes = Hashes(data)
    heads = hashes.all(HEAD)
    least = _least(heads, length - HEAD + 1)
    ends_at = np.repeat(ends, np.diff(ends, prepend=0))[: len(least)]
    places = np.flatnonzero(np.arange(length, len(least) + length) <= ends_at)
    if not len(places):
        return (np.empty(0, np.uint64),) * 2 + (np.empty(0, np.int64),) * 3
    own = least[places]
    new = np.r_[True, (own[1:] != own[:-1]) | (places[1:] != places[:-1] + 1)]
    first = places[new]
    last = places[np.r_[np.flatnonzero(new)[1:] - 1, len(places) - 1]]
    anchor = own[new]
    left, span = anchor - first, last - first
    context = hashes.of(first, last + length)
    context = _mixed(context ^ (left * 256 + span).astype(np.uint64))
    return heads[anchor], context, first, left, span


def _segments(texts: list[str | None], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, list]]:
    """Bytes of several texts with their ends, and (row, offset in the text) of each."""
    parts: list[bytes] = []
    marks: list[tuple[int, int]] = []
    held = 0
    for row, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass")
        # Pieces of a long text overlap such that each window is in one of them.
        for at in range(0, max(1, len(raw) - length + 1), SEGMENT):
            piece = raw[at : at + SEGMENT + length - 1]
            if len(piece) < length:
                continue
            parts.append(piece)
            marks.append((row, at))
            held += len(piece)
            if held >= SEGMENT:
                yield np.frombuffer(b"".join(parts), np.uint8), np.cumsum([*map(len, parts)]), marks
                parts, marks, held = [], [], 0
    if parts:
        yield np.frombuffer(b"".join(parts), np.uint8), np.cumsum([*map(len, parts)]), marks


def _marked(
    h: np.ndarray, c: np.ndarray, ids: pa.Array, ts: pa.Array, rows: np.ndarray, loc: np.ndarray
) -> pa.RecordBatch:
    """Entries of some rows, with those marked that one of the same rows has earlier.

    A marked entry is settled; it gets a context of its own, so that the copies of a
    text, however many, are spread over the tasks.
    """
    missing = np.array([value is None for value in ids.to_pylist()])
    plain = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    t = ts.to_numpy(zero_copy_only=False)
    order = np.lexsort((loc, t[rows], plain[rows], ~missing[rows], c, h))
    same = np.zeros(len(h), bool)
    if len(h) > 1:
        a, b = order[:-1], order[1:]
        equal = (h[a] == h[b]) & (c[a] == c[b])
        tied = (plain[rows[a]] == plain[rows[b]]) & (missing[rows[a]] == missing[rows[b]])
        tied &= (t[rows[a]] == t[rows[b]]) & (loc[a] == loc[b])
        # After a tie for the first place, all have the first before them but those.
        first = np.maximum.accumulate(np.where(np.r_[True, ~equal], np.arange(len(h)), 0))
        at_first = np.r_[True, equal & tied]
        leading = np.maximum.accumulate(np.where(~at_first, np.arange(len(h)), 0)) <= first
        same[order] = (np.arange(len(h)) != first) & ~leading
    own = _mixed(loc.astype(np.uint64) ^ _mixed(plain[rows].astype(np.uint64)))
    c = np.where(same, own, c)
    at = pa.array(rows)
    return batch_of(
        h=(pa.array(h.view(np.int64)), None),
        c=(pa.array(c.view(np.int64)), None),
        id=(ids.take(at), None),
        t=(ts.take(at), None),
        loc=(pa.array(loc), None),
        later=(pa.array(same), None),
    )


def _entries(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[np.ndarray, ...]] = []
            for data, ends, marks in _segments(batch.column("text").to_pylist(), length):
                head, context, first, left, span = anchors(data, ends, length)
                owner = np.searchsorted(ends, first, "right")
                rows, offsets = np.array(marks, np.int64).T
                start = first - np.r_[0, ends[:-1]][owner] + offsets[owner]
                found.append((head, context, rows[owner], start << 16 | left << 8 | span))
            if found:
                h, c, rows, loc = map(np.concatenate, zip(*found, strict=True))
                yield _marked(h, c, batch.column("id"), batch.column("t"), rows, loc)

    return run


def entries(keyed: DataFrame, length: int) -> DataFrame:
    """h, c, id, t, loc, later of every suffix at an anchor. loc: first start, left, span."""
    return in_batches(keyed.select("id", "t", "text"), _entries(length), _ENTRY)


def scanned(found: DataFrame) -> DataFrame:
    """Entries in the order of (head, context, place), marked if one stands earlier."""
    order = Window.partitionBy("h", "c").orderBy(*_ORDER)
    return found.withColumn("later", F.col("later") | (F.rank().over(order) > 1))


class IndexFamily:
    """Arrays by level; one of level n is made of 2 ** n batches.

    ``found`` has the entries that the scans have shown to stand earlier.
    """

    def __init__(self):
        self.levels: dict[int, DataFrame] = {}
        self.found: list[DataFrame] = []

    def _scan(self, entries_: DataFrame) -> DataFrame:
        table = written_and_swept(scanned(entries_), "array")
        later = table.filter("later").select("id", "t", "loc")
        self.found.append(written_and_swept(later, "found"))
        return table

    def _merge(self, one: DataFrame, other: DataFrame) -> DataFrame:
        table = self._scan(one.unionByName(other).filter(~F.col("later")))
        discard(one)
        discard(other)
        return table

    def add(self, batch: DataFrame) -> None:
        """Add the entries of a batch; two arrays of a level become one of the next."""
        array, level = self._scan(batch), 0
        while level in self.levels:
            array = self._merge(self.levels.pop(level), array)
            level += 1
        self.levels[level] = array

    def whole(self) -> DataFrame:
        """All levels as one array, of h, id, t, loc."""
        while len(self.levels) > 1:
            low, high = sorted(self.levels)[:2]
            self.levels[high] = self._merge(self.levels.pop(low), self.levels.pop(high))
        (array,) = self.levels.values()
        return array.filter(~F.col("later")).select("h", *_ORDER)


def open_entries(array: DataFrame) -> DataFrame:
    """The entries whose head has several contexts."""
    heads = array.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h")
    return array.join(written_and_swept(heads, "heads"), "h", "left_semi")


def _batches(keyed: DataFrame, batches: int) -> list[Column]:
    """Conditions that part the documents by id, in ascending order; nulls come first."""
    shares = [i / batches for i in range(1, batches)]
    cuts = sorted(set(keyed.approxQuantile("id", shares, 0.01))) if shares else []
    bounds = [None, *cuts, None]
    conditions = []
    for low, high in zip(bounds, bounds[1:], strict=False):
        condition = F.lit(True) if high is None else F.col("id") <= int(high)
        if low is not None:
            condition = condition & (F.col("id") > int(low))
        elif high is not None:
            condition = condition | F.col("id").isNull()
        conditions.append(condition)
    return conditions


def _contexts(length: int):
    """The bytes of the contexts that a row names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, heads, locs, found = [], [], [], []
            pairs = zip(batch.column("text").to_pylist(), batch.column("named").to_pylist(), strict=True)
            for row, (text, named) in enumerate(pairs):
                raw = (text or "").encode("utf-8", "surrogatepass")
                for item in named:
                    start, span = item["loc"] >> 16, item["loc"] & 255
                    rows.append(row)
                    heads.append(item["h"])
                    locs.append(item["loc"])
                    found.append(raw[start : start + span + length])
            at = pa.array(rows, pa.int64())
            yield batch_of(
                h=(heads, pa.int64()),
                id=(batch.column("id").take(at), None),
                t=(batch.column("t").take(at), None),
                loc=(locs, pa.int64()),
                context=(found, pa.binary()),
            )

    return run


def _parts(length: int, cell: int):
    """The windows of each context, in cells of so many places by the anchor.

    The head of a cell is the part all its windows have in common, also those that this
    context lacks; its context is that of its own windows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            contexts = batch.column("context").to_pylist()
            if not contexts:
                continue
            locs = batch.column("loc").to_numpy(zero_copy_only=False)
            starts, lefts, spans = locs >> 16, locs >> 8 & 255, locs & 255
            hashes = Hashes(np.frombuffer(b"".join(contexts), np.uint8))
            sizes = np.array([len(context) for context in contexts])
            begins = np.cumsum(sizes) - sizes
            low, high = (lefts - spans) // cell, lefts // cell
            count = high - low + 1
            rows = np.repeat(np.arange(len(contexts)), count)
            number = low[rows] + np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)
            left = lefts[rows]
            # Windows of the cell, by their start in the context.
            first = np.maximum(0, left - (cell * number + cell - 1))
            last = np.minimum(spans[rows], left - cell * number)
            begin = begins[rows]
            core = begin + left - cell * number
            head = batch.column("h").to_numpy(zero_copy_only=False).view(np.uint64)[rows]
            head = _mixed(head ^ hashes.of(core, core + length - cell + 1))
            head = _mixed(head + number.astype(np.uint64))
            context = hashes.of(begin + first, begin + last + length)
            context = _mixed(context ^ ((left - first) * 256 + last - first).astype(np.uint64))
            loc = (starts[rows] + first) << 16 | (left - first) << 8 | (last - first)
            yield _marked(head, context, batch.column("id"), batch.column("t"), rows, loc)

    return run


def _removed(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, spans, digests, kept = [], [], [], [], []
            pairs = zip(batch.column("text").to_pylist(), batch.column("found").to_pylist(), strict=True)
            for text, found in pairs:
                raw = (text or "").encode("utf-8", "surrogatepass")
                left, at, gone, runs, end = [], 0, 0, 0, -1
                for item in sorted((i["start"], i["start"] + i["span"] + length) for i in found or ()):
                    if item[0] > end:
                        runs += 1
                        left.append(raw[at : item[0]])
                    gone += max(0, item[1] - max(end, item[0]))
                    end = max(end, item[1])
                    at = end
                left.append(raw[at:])
                rest = b"".join(left)
                sizes.append(len(raw))
                removed.append(gone)
                spans.append(runs)
                digests.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest)
            yield batch_of(
                row=(batch.column("row"), None),
                n_bytes=(sizes, pa.int64()),
                n_removed=(removed, pa.int64()),
                n_spans=(spans, pa.int64()),
                kept_sha256=(digests, pa.string()),
                kept=(kept, pa.binary()),
            )

    return run


def remove_repeats(
    docs: DataFrame,
    length: int = 100,
    batches: int = BATCHES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Remove each byte under a string of ``length`` bytes that also starts earlier: row
    (all columns of ``docs`` but the text, as one struct), n_bytes, n_removed, n_spans,
    kept_sha256 and kept (the bytes that are left).

    Earlier is a smaller id, or in one document a smaller place; ids are whole numbers, and
    a null id comes before all others. Rows that share an id but not the text are held
    in the order of a hash of the text; rows equal in both are one document that is
    there twice, and get the same result. A null text is empty; texts shorter than ``length``
    lose nothing; an empty table gives no rows. ``length`` is 48 to 200.
    """
    if not SHORTEST <= length <= LONGEST:
        raise ValueError(f"length {length} is not in {SHORTEST} .. {LONGEST}")
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    keyed = docs.select(
        F.struct(*rest).alias("row"),
        F.col(id_col).cast("long").alias("id"),
        text_of(text_col).alias("text"),
    ).withColumn("t", F.hash("text"))
    same = keyed["id"].eqNullSafe(F.col("own_id")) & (keyed["t"] == F.col("own_t"))
    family = IndexFamily()
    for condition in _batches(keyed, batches):
        family.add(entries(keyed.filter(condition), length))

    def parts_of(array: DataFrame, cell: int) -> DataFrame:
        named = (
            open_entries(array)
            .groupBy(F.col("id").alias("own_id"), F.col("t").alias("own_t"))
            .agg(F.collect_set(F.struct("h", "loc")).alias("named"))
        )
        texts = keyed.join(written_and_swept(named, "named"), same)
        contexts = in_batches(
            texts.select("id", "t", "text", "named"),
            _contexts(length),
            "h long, id long, t int, loc long, context binary",
        )
        return in_batches(contexts, _parts(length, cell), _ENTRY)

    found = family.found
    array = family.whole()
    for cell in (CELL, 1):
        finer = IndexFamily()
        finer.add(parts_of(array, cell))
        discard(array)
        found += finer.found
        array = finer.whole()

    later = found[0]
    for more in found[1:]:
        later = later.unionByName(more)
    places = (
        later.select(
            F.col("id").alias("own_id"),
            F.col("t").alias("own_t"),
            F.shiftright("loc", 16).alias("start"),
            F.col("loc").bitwiseAND(F.lit(255)).cast("int").alias("span"),
        )
        .groupBy("own_id", "own_t")
        .agg(F.collect_set(F.struct("start", "span")).alias("found"))
    )
    kind = keyed.schema["row"].dataType.simpleString()
    # Written, so that the join finds its size and the files of the scans are not read again.
    judged = keyed.join(written_and_swept(places, "places"), same, "left").select("row", "text", "found")
    return in_batches(
        judged,
        _removed(length),
        f"row {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary",
    )

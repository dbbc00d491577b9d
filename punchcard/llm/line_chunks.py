"""Removal of repeated multi-line chunks.

A text is dealt into chunks of lines: a rolling hash over the hashes of a few lines
chooses where one ends, so that boundaries depend on the lines near them and come back
after a shift. Chunks that another document of the table holds before go. What is
repeated reaches further than its whole chunks, and a run of a few lines may hold none:
so each two neighbouring lines outside of these are looked up as well, and a repeat is
widened line by line to both sides as far as it goes. Equal hashes are not trusted: the
bytes of all places of a hash are compared.

With ``widened=False`` whole chunks go and nothing else, so fewer are compared, but most
runs of a few lines stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punchcard.llm.common import batch_of, columns, if_small, in_batches
from punchcard.llm.common import written_and_swept as written

_MULTIPLIER = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
# Documents whose spans are broadcast, at most.
SPANS = 20_000


@dataclass(frozen=True)
class ChunkRules:
    window: int = 2  # lines under the rolling hash
    divisor: int = 3  # one line in so many ends a chunk
    min_lines: int = 2
    max_lines: int = 64
    widened: bool = True  # also the lines round whole chunks, two by two


def chunk_ends(lines: list[bytes], rules: ChunkRules) -> list[int]:
    """Where the chunks of a document end: places after their last line, ascending."""
    hashes = [xxhash.xxh64_intdigest(line) for line in lines]
    oldest = pow(_MULTIPLIER, rules.window, 1 << 64)
    ends: list[int] = []
    rolling, start = 0, 0
    for i, value in enumerate(hashes):
        rolling = rolling * _MULTIPLIER + value
        if i >= rules.window:
            rolling -= hashes[i - rules.window] * oldest
        rolling &= _MASK
        held = i + 1 - start
        cut = (rolling >> 33) % rules.divisor == 0 and held >= rules.min_lines
        if cut or held >= rules.max_lines:
            ends.append(i + 1)
            start = i + 1
    if start < len(lines):
        ends.append(len(lines))
    return ends


def lines_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split(b"\n")


def chunks_of(text: str | None, rules: ChunkRules) -> list[tuple[int, int, bytes, bool]]:
    """(first line, line count, bytes, counts as multi-line) of each chunk of a text."""
    return _chunks(lines_of(text), rules)


def _chunks(lines: list[bytes], rules: ChunkRules) -> list[tuple[int, int, bytes, bool]]:
    found, start = [], 0
    for end in chunk_ends(lines, rules):
        own = lines[start:end]
        many = len(own) > 1 and sum(1 for line in own if line.strip()) > 1
        found.append((start, end - start, b"\n".join(own), many))
        start = end
    return found


def _pairs(lines: list[bytes], rules: ChunkRules) -> list[tuple[int, int, bytes, bool]]:
    """The same for each line that is not blank and the next such line."""
    if not rules.widened:
        return []
    full = [i for i, line in enumerate(lines) if line.strip()]
    return [
        (i, j + 1 - i, b"\n".join(lines[i : j + 1]), True)
        for i, j in zip(full, full[1:], strict=False)
    ]


def _bare(lines: list[bytes], start: int, count: int) -> tuple[int, int]:
    """First line and end of a chunk without blank lines at its edges."""
    end = start + count
    while start < end and not lines[start].strip():
        start += 1
    while end > start and not lines[end - 1].strip():
        end -= 1
    return start, end


def _digests(rules: ChunkRules, seed: int):
    """The chunks of each text, and its pairs of lines, by their digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = [], []
            (texts,) = columns(batch.select(["text"]))
            for row, text in enumerate(texts):
                lines = lines_of(text)
                for pair, own in enumerate((_chunks(lines, rules), _pairs(lines, rules))):
                    for place, (start, count, data, many) in enumerate(own):
                        if many:
                            digest = xxhash.xxh64_intdigest(data, seed) - (1 << 63)
                            first, end = _bare(lines, start, count)
                            rows.append(row)
                            found.append((bool(pair), place, first, end, digest))
            at = pa.array(rows, pa.int64())
            pair, place, start, end, digest = zip(*found, strict=True) if found else [()] * 5
            yield batch_of(
                id=(batch.column("id").take(at), None),
                h=(batch.column("h").take(at), None),
                pair=(list(pair), pa.bool_()),
                place=(list(place), pa.int32()),
                start=(list(start), pa.int32()),
                end=(list(end), pa.int32()),
                digest=(list(digest), pa.int64()),
            )

    return run


def _bytes_of(rules: ChunkRules):
    """The bytes of the chunks and pairs that a row names, with their digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            named = batch.column("named").to_pylist()
            digests, chunks = [], []
            for text, wanted in zip(texts, named, strict=True):
                lines = lines_of(text)
                own = _chunks(lines, rules), _pairs(lines, rules)
                for item in wanted or ():
                    digests.append(item["digest"])
                    chunks.append(own[item["pair"]][item["place"]][2])
            yield batch_of(digest=(digests, pa.int64()), chunk=(chunks, pa.binary()))

    return run


def _cleaned(rules: ChunkRules, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("row").field(text_col).to_pylist()
            named = batch.column("named").to_pylist()
            figures = []
            for text, marked in zip(texts, named, strict=True):
                lines = lines_of(text)
                own, pairs = _chunks(lines, rules), _pairs(lines, rules)
                items = [i for i in marked or () if i["later"]]
                drop: set[int] = set()
                for item in items:
                    if not item["pair"]:
                        start, count = own[item["place"]][:2]
                        if rules.widened:
                            drop.update(range(*_bare(lines, start, count)))
                        else:
                            drop.update(range(start, start + count))
                later = {i["place"]: i["first_here"] for i in items if i["pair"]}
                kept: dict[int, int] = {}
                for place in sorted(later, reverse=True):
                    start, count = pairs[place][:2]
                    first = later[place]
                    if first is not None:
                        # A run that overlaps its own first place leaves that whole.
                        if later.get(place + 1) == first + 1:
                            kept[place] = kept[place + 1]
                        else:
                            kept[place] = pairs[first][0] + pairs[first][1]
                    drop.update(range(max(start, kept.get(place, 0)), start + count))
                left = [line for i, line in enumerate(lines) if i not in drop]
                figures.append(
                    (
                        b"\n".join(left).decode("utf-8", "surrogatepass") if drop else text or "",
                        len(lines),
                        len(own),
                        len(items),
                        len(drop),
                    )
                )
            clean, *counts = zip(*figures, strict=True) if figures else [()] * 5
            names = ("n_lines", "n_chunks", "n_removed_chunks", "n_removed_lines")
            yield batch_of(
                row=(batch.column("row"), None),
                clean_text=(list(clean), pa.string()),
                **{n: (list(c), pa.int64()) for n, c in zip(names, counts, strict=True)},
            )

    return run


def _repeated(chunks: DataFrame, elsewhere: bool) -> DataFrame:
    """Chunks whose digest is repeated. later: not the first place, and if ``elsewhere``,
    that is in another document; first_here: the first place if it is in this one."""
    place = F.struct("id", "h", "place")
    repeated = chunks.groupBy("digest").agg(F.count("*").alias("n"), F.min(place).alias("first"))
    # Written, so that a digest with very many places can be split in the join.
    repeated = written(repeated.filter("n > 1").drop("n"), "repeated")
    here = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("h") == F.col("first.h"))
    later = ~here if elsewhere else ~place.eqNullSafe(F.col("first"))
    return (
        chunks.join(repeated, "digest")
        .withColumn("later", later)
        .withColumn("first_here", F.when(here, F.col("first.place")))
        .drop("first")
    )


def _marked(keyed: DataFrame, text: Column, rules: ChunkRules, seed: int) -> DataFrame:
    """Each document with its chunks, and pairs of lines, whose digest is repeated."""
    kind = keyed.schema["id"].dataType.simpleString()
    found = written(
        in_batches(
            keyed.select("id", "h", text.alias("text")),
            _digests(rules, seed),
            f"id {kind}, h long, pair boolean, place int, start int, end int, digest long",
        ),
        "chunks",
    )
    named = _repeated(found.filter("NOT pair"), rules.widened)
    if rules.widened:
        named = written(named, "named")
        # Pairs within a chunk that goes are never the first of their kind, and go with it.
        spans = named.filter("later").groupBy(F.col("id").alias("own_id"), F.col("h").alias("own_h"))
        spans = written(spans.agg(F.collect_set(F.struct("start", "end")).alias("spans")), "spans")
        within = F.exists("spans", lambda s: (s["start"] <= F.col("start")) & (F.col("end") <= s["end"]))
        same = F.col("id").eqNullSafe(F.col("own_id")) & (F.col("h") == F.col("own_h"))
        rest = found.filter("pair").join(if_small(spans, SPANS), same, "left")
        rest = rest.filter(~F.coalesce(within, F.lit(False))).select(found.columns)
        named = named.unionByName(_repeated(written(rest, "pairs"), False))
    item = F.struct("pair", "place", "digest", "later", "first_here")
    by_document = named.groupBy(F.col("id").alias("own_id"), F.col("h").alias("own_h")).agg(
        F.collect_set(item).alias("named")
    )
    same = keyed["id"].eqNullSafe(F.col("own_id")) & (keyed["h"] == F.col("own_h"))
    return keyed.join(by_document, same, "left").select("row", "named")


def remove_repeated_chunks(
    docs: DataFrame,
    rules: ChunkRules | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Remove repeated multi-line chunks: row (all columns of ``docs``, as one struct),
    clean_text, n_lines, n_chunks, n_removed_chunks, n_removed_lines; one row per row.

    A chunk counts if at least two of its lines are not blank. The place with the least
    (id, hash of the text, place) stays; a null id comes before all others. A line goes if
    any later place of a chunk or of a pair of lines holds it, so that any run of two lines
    or more that stands before goes whole. Rows equal
    in id and text are one document that is there twice, and get the same result. A null
    text counts as one empty line, and becomes an empty text; an empty table gives no rows.
    """
    used = rules or ChunkRules()
    # The text is carried once, inside the row.
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(id_col).alias("id"),
        F.xxhash64(text_col).alias("h"),
    )
    text = F.col("row")[text_col]
    seed = 0
    while True:
        marked = written(_marked(keyed, text, used, seed), "marked")
        named = marked.filter(F.col("named").isNotNull()).select(text.alias("text"), "named")
        compared = in_batches(named, _bytes_of(used), "digest long, chunk binary")
        texts = compared.distinct().groupBy("digest").count()
        if texts.filter("count > 1").isEmpty():
            break
        seed += 1  # some digest stands for different bytes: take another hash
    kind = docs.schema.simpleString()
    return in_batches(
        marked,
        _cleaned(used, text_col),
        f"row {kind}, clean_text string, n_lines long, n_chunks long,"
        " n_removed_chunks long, n_removed_lines long",
    )

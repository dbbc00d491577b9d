"""Benchmark passages in documents, found by spaced seeds.

A mask looks at five of six neighbouring words and ignores the other, so that a
replaced word does not hide a passage. Seeds of documents and of benchmark items
are joined; a hit is no more than the two places. Where a document and an item have
hits, their texts are laid against each other, once for each shift between the places,
and a window in which at least 0.8 of the words agree is a verified overlap. Built-in
functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punchcard.llm.common import BROADCAST_ROWS, if_small, text_of, written

# Words of a window that take part. Any 15 words of which at most 3 differ (14 and 13
# words: 2, 12 to 8 words: 1) hold a hit of one of the two; a test tries all cases.
MASKS = ((0, 1, 2, 4, 5), (0, 2, 3, 4, 5))
SPAN = 6
WINDOW = 15
MIN_WORDS = 8
# Long items are laid out in pieces of so many words, such that every window lies in one.
PIECE = 256


def words_of(text: Column) -> Column:
    """Lower-case words, as hashes; white space and ASCII punctuation part them."""
    words = F.array_remove(F.split(F.lower(text), r"[\s\p{Punct}]+"), "")
    return F.transform(words, lambda word: F.xxhash64(word))


def _seeds(words: Column, count: Column) -> Column:
    """Hashes of the words under each mask at each of ``count`` places, mask after mask."""

    def under(number: int, mask: tuple[int, ...]):
        def seed(first: Column, i: Column) -> Column:
            rest = [F.get(words, i + offset) for offset in mask[1:]]
            return F.xxhash64(F.lit(number), first, *rest)

        return F.transform(F.slice(words, 1, count), seed)

    return F.concat(*[under(number, mask) for number, mask in enumerate(MASKS)])


def _needed(window: Column) -> Column:
    """Words that must agree in a window."""
    return window - F.when(window >= 15, 3).when(window >= 13, 2).otherwise(1)


def _with_seeds(rows: DataFrame, words: str) -> DataFrame:
    """A row for each place and mask of the array ``words``: pos, mask, seed beside the rest.

    The array itself is left behind, as a long one would be copied for each place.
    """
    places = F.greatest(F.size(words) - (SPAN - 1), F.lit(0))
    placed = rows.withColumn("places", places).withColumn(
        "seeds", _seeds(F.col(words), F.col("places"))
    )
    kept = [F.col(name) for name in [*rows.columns, "places"] if name != words]
    # Outer: else Spark would test the size of the array first, and make it twice.
    flat = placed.select(*kept, F.posexplode_outer("seeds").alias("p", "seed"))
    return (
        flat.withColumn("pos", (F.col("p") % F.col("places")).cast("int"))
        .withColumn("mask", F.expr("cast(p div places as int)"))
        .drop("p", "places")
    )


def _pieces(items: DataFrame, item_id: str, item_text: str) -> DataFrame:
    """piece (a number), item, start, iw (its hashed words) and window of each piece of an item."""
    rows = items.select(F.col(item_id).alias("item"), words_of(text_of(item_text)).alias("all"))
    size = F.size("all")
    stride = PIECE - (WINDOW - 1)
    starts = F.sequence(F.lit(0), F.greatest(size - WINDOW, F.lit(0)), F.lit(stride))
    return (
        rows.withColumn("window", F.least(size, F.lit(WINDOW)))
        .filter(F.col("window") >= MIN_WORDS)
        .withColumn("start", F.explode(starts))
        .withColumn("iw", F.slice("all", F.col("start") + 1, F.lit(PIECE)))
        .withColumn("piece", F.monotonically_increasing_id())
        .drop("all")
    )


def _blocks(seeds: DataFrame, pieces: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """Seeds with their pieces, in blocks that are each small enough to broadcast.

    A piece has at most 2 * PIECE seeds, and its words are fewer than its seeds and ten.
    """
    blocks = max(1, -(-seeds.count() // BROADCAST_ROWS))
    block = F.lit(0)
    while blocks > 1:
        block = F.pmod(F.xxhash64("piece"), F.lit(blocks))
        if seeds.groupBy(block).count().agg(F.max("count")).first()[0] <= BROADCAST_ROWS:
            break
        blocks *= 2
    return [(seeds.filter(block == n), pieces.filter(block == n)) for n in range(blocks)]


def overlaps(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Verified overlaps, one row per (id, text hash, item): id, h, item, n_words, matched,
    doc_start, item_start.

    n_words is the length of the best window (15, or the item if that is shorter), matched
    its words that agree, the starts its first words; ties go to the first. At least 0.8 of
    a window must agree, and items of fewer than 8 words show nothing. Null and empty
    texts, and empty tables, give no rows; null ids are kept as they are; rows equal in
    id and text count once. Other columns are ignored.

    The seeds of the items are broadcast in blocks of bounded size, and each block reads
    the documents once. Of these only places are shuffled, one for each shift against an
    item, so that long and repetitive texts pass in the memory of their words; texts are
    then read once more where a document has hits.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).select(
        "id", F.xxhash64("text").alias("h"), words_of(F.col("text")).alias("dw")
    )
    placed = _with_seeds(rows, "dw")
    pieces = written(_pieces(items, item_id, item_text), "pieces")
    seeds = written(
        _with_seeds(pieces.select("piece", "iw"), "iw")
        .filter("seed is not null")
        .select("piece", "seed", F.col("pos").alias("ipos"), F.col("mask").alias("imask")),
        "item_seeds",
    )
    found = None
    for block_seeds, block_pieces in _blocks(seeds, pieces):
        hits = placed.join(F.broadcast(block_seeds), "seed").filter("mask = imask")
        shift = (F.col("pos") - F.col("ipos")).alias("shift")
        shifts = hits.select("id", "h", "piece", shift).distinct()
        laid = written(
            shifts.groupBy("id", "h", "piece").agg(F.collect_list("shift").alias("shifts")), "shifts"
        )
        verified = _verified(rows, laid, block_pieces)
        found = verified if found is None else found.unionByName(verified)
    return found.groupBy("id", "h", "item").agg(F.max("best").alias("best")).select(
        "id",
        "h",
        "item",
        "best.n_words",
        "best.matched",
        (-F.col("best.doc_start")).alias("doc_start"),
        (-F.col("best.item_start")).alias("item_start"),
    )


def _verified(rows: DataFrame, laid: DataFrame, pieces: DataFrame) -> DataFrame:
    """id, h, item, best: the best window of each document and piece that agrees enough."""
    own = laid.select(F.col("id").alias("own_id"), F.col("h").alias("own_h"), "piece", "shifts")
    same = F.col("id").eqNullSafe(F.col("own_id")) & (F.col("h") == F.col("own_h"))
    texts = rows.join(if_small(own), same).join(F.broadcast(pieces), "piece")
    needed = _needed(F.col("window"))

    def total(flags: Column) -> Column:
        return F.aggregate(flags, F.lit(0), lambda sum_, flag: sum_ + flag)

    def length(doc_at: Column, item_at: Column) -> Column:
        return F.least(F.size("dw") - doc_at, F.size("iw") - item_at)

    def best(shift: Column) -> Column:
        doc_at, item_at = F.greatest(shift, F.lit(0)), F.greatest(-shift, F.lit(0))
        long = length(doc_at, item_at)
        flags = F.zip_with(
            F.slice("dw", doc_at + 1, long),
            F.slice("iw", item_at + 1, long),
            lambda a, b: F.when(a == b, 1).otherwise(0),
        )

        def windows(equal: Column) -> Column:
            def window(i: Column) -> Column:
                return F.struct(
                    total(F.slice(equal, i + 1, F.col("window"))).alias("matched"),
                    (-(doc_at + i)).alias("doc_start"),
                    (-(F.col("start") + item_at + i)).alias("item_start"),
                    F.col("window").alias("n_words"),
                )

            places = F.sequence(F.lit(0), long - F.col("window"))
            return F.when(total(equal) >= needed, F.array_max(F.transform(places, window)))

        # As an array of one, the flags are made once for all windows.
        return F.get(F.transform(F.array(flags), windows), F.lit(0))

    wide = F.filter(
        "shifts", lambda s: length(F.greatest(s, F.lit(0)), F.greatest(-s, F.lit(0))) >= F.col("window")
    )
    tried = texts.withColumn("best", F.array_max(F.transform(wide, best)))
    return tried.filter(F.col("best.matched") >= needed).select("id", "h", "item", "best")


def decontaminated(docs: DataFrame, items: DataFrame, **names: str) -> DataFrame:
    """``docs`` without the documents that overlap an item. ``names``: as in ``overlaps``."""
    id_col, text_col = names.get("id_col", "doc_id"), names.get("text_col", "text")
    hit = written(overlaps(docs, items, **names).select("id", "h").distinct(), "hit")
    free = "_" * (1 + max((len(name) for name in docs.columns), default=0))  # no such name yet
    hit = hit.toDF(free + "id", free + "h")
    same = F.col(id_col).eqNullSafe(F.col(free + "id")) & (
        F.xxhash64(text_of(text_col)) == F.col(free + "h")
    )
    return docs.join(hit, same, "left_anti")

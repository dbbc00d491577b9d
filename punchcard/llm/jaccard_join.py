"""Components of documents whose sets of word shingles are alike, by a grouped prefix join.

All shingles have one order, rare ones first. Two sets that are alike enough share a
shingle in the first few of each, their prefixes; the longer the sets, the longer these.
Sets of equal size and equal prefix form a group and go through the filters as one:
groups that share a shingle, have near sizes, and hold it early enough for the overlap
still needed become a pair. Their members are then compared in full.

Of copies, only one takes part. Links that would join what is joined already are not
looked at: first each group is compared with one leader of its shingles, in rounds, and
then only what lies in different components, exactly.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from punchcard.llm.common import batch_of, columns, discard, if_small, in_batches
from punchcard.llm.common import written_and_swept as written
from punchcard.llm.components import components

# A shingle that this many sets hold among their first is a frequent one and goes behind.
FREQUENT = 16
# Rounds of comparing with leaders, at most, before what is left is compared pair by pair;
# they end when fewer than one in FEW of the pairs with leaders are alike.
ROUNDS = 8
FEW = 20
_BLOCK = 4 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_SEED = 42
_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(_MIX[1])
    values = (values ^ (values >> np.uint64(27))) * np.uint64(_MIX[2])
    return values ^ (values >> np.uint64(31))


def _word_hashes(text: str | None) -> np.ndarray:
    """A hash for each word of a text, taken in blocks so that few words are held."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()
    parts, at, digest = [np.empty(0, np.uint64)], 0, xxhash.xxh64_intdigest
    while at < len(data):
        cut = _SPACE.search(data, at + _BLOCK)
        end = cut.start() if cut else len(data)
        words = data[at:end].split()
        parts.append(np.fromiter((digest(word, _SEED) for word in words), np.uint64, len(words)))
        at = end
    return np.concatenate(parts)


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text, as signed longs.

    Fewer words than a shingle has are one shingle; no words, none.
    """
    words = _word_hashes(text)
    if not len(words):
        return np.empty(0, np.int64)
    size = min(shingle, len(words))
    n = len(words) - size + 1
    found = np.full(n, size, np.uint64)
    for i in range(size):
        found = _mixed(found * np.uint64(_MIX[0]) + words[i : i + n])
    return np.unique(found.view(np.int64))


def _sets(shingle: int, percent: int, whole: bool):
    """id, n, digest and shingles of each text: all of them, or some more than a prefix has.

    Those are the first by hash, so that frequent ones among them can go behind.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            (texts,) = columns(batch.select(["text"]))
            sets = [shingle_set(text, shingle) for text in texts]
            sizes = np.array([len(s) for s in sets], np.int64)
            digests = np.frombuffer(
                b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets), np.int64
            ).reshape(-1, 2)
            if not whole:
                prefixes = sizes - (percent * sizes + 99) // 100 + 1
                sets = [s[: 2 * p + 8] for s, p in zip(sets, prefixes.tolist(), strict=True)]
            offsets = np.cumsum([0, *map(len, sets)], dtype=np.int32)
            yield batch_of(
                id=(batch.column("id"), None),
                n=(pa.array(sizes), None),
                d1=(pa.array(digests[:, 0]), None),
                d2=(pa.array(digests[:, 1]), None),
                first=(pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(sets))), None),
            )

    return run


class _Bounds:
    """The least figures that a similarity of ``percent`` in a hundred asks for, as SQL."""

    def __init__(self, percent: int) -> None:
        self.percent = percent

    def prefix(self, n: str) -> str:
        """How many first shingles meet those of any set that is alike."""
        return f"({n} - ({self.percent} * {n} + 99) div 100 + 1)"

    def index(self, n: str) -> str:
        """The same for sets that are no smaller only."""
        both = 100 + self.percent
        return f"({n} - ({2 * self.percent} * {n} + {both - 1}) div {both} + 1)"

    def overlap(self, n: str, m: str) -> str:
        """How many shingles sets of these sizes must share."""
        both = 100 + self.percent
        return f"(({self.percent} * ({n} + {m}) + {both - 1}) div {both})"

    def near(self, n: str, m: str) -> str:
        """Whether sets of these sizes can be alike at all."""
        return f"(100 * least({n}, {m}) >= {self.percent} * greatest({n}, {m}))"

    def open(self, one: str, two: str) -> str:
        """Whether two sets with one shingle in common can share enough.

        Each has a size n, the place ``at`` of the shingle, and the number ``met`` of
        those before it that other groups have too: only these can be shared.
        """
        n, m = one.format("n"), two.format("n")
        before = f"least({one.format('met')}, {two.format('met')})"
        after = f"least({n} - {one.format('at')}, {m} - {two.format('at')})"
        return f"({self.near(n, m)} AND {before} + {after} >= {self.overlap(n, m)})"


def _frequent(sets: DataFrame) -> DataFrame:
    """(shingle, level) of what many sets hold; the level grows with their number."""
    counted = sets.select(F.explode("first").alias("shingle")).groupBy("shingle").count()
    frequent = counted.filter(F.col("count") >= FREQUENT)
    return frequent.select("shingle", F.floor(F.log2("count")).cast("int").alias("level"))


def _with_prefix(sets: DataFrame, frequent: DataFrame, bounds: _Bounds) -> DataFrame:
    """(node, n, rare, prefix) of sets (node, n, first), which hold the ``first`` shingles
    by hash of each. The prefix is null if these do not tell it."""
    hits = (
        sets.select("node", F.explode("first").alias("shingle"))
        .join(if_small(frequent), "shingle")
        .groupBy("node")
        .agg(F.sort_array(F.collect_list(F.struct("level", "shingle"))).alias("hits"))
    )
    late = F.coalesce(F.col("hits.shingle"), F.array().cast("array<long>"))
    parted = sets.join(hits, "node", "left").select(
        "node",
        "n",
        F.expr(bounds.prefix("n")).cast("int").alias("p"),
        (F.size("first") == F.col("n")).alias("whole"),
        F.when(F.col("hits").isNull(), F.col("first")).otherwise(F.array_except("first", late)).alias("early"),
        late.alias("late"),
    )
    told = F.col("whole") | (F.size("early") >= F.col("p"))
    prefix = F.slice(F.concat("early", "late"), F.lit(1), F.col("p"))
    return parted.select(
        "node", "n", F.least(F.size("early"), "p").alias("rare"), F.when(told, prefix).alias("prefix")
    )


class _Corpus:
    """The documents, and the nodes (node, row_id, d1, d2) that stand for equal sets."""

    def __init__(self, docs: DataFrame, shingle: int, percent: int, id_col: str, text_col: str):
        self.rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        self.kind = docs.schema[id_col].dataType.simpleString()
        self.shingle, self.percent = shingle, percent
        self.nodes: DataFrame | None = None
        self.stored: DataFrame | None = None  # (node, n, first)

    def _hashed(self, rows: DataFrame, whole: bool) -> DataFrame:
        schema = f"id {self.kind}, n long, d1 long, d2 long, first array<long>"
        return in_batches(rows, _sets(self.shingle, self.percent, whole), schema)

    def firsts(self) -> DataFrame:
        return self._hashed(self.rows, False)

    def sets(self, of: DataFrame) -> DataFrame:
        """(node, n, first) with all shingles of the nodes in ``of``, a written table, hashed again.

        Shingles of all documents take several times the space of their texts, so only
        prefixes are stored.
        """
        wanted = written(self.nodes.join(if_small(of), "node", "left_semi"), "wanted")
        few = if_small(wanted.select("row_id", "d1", "d2", "node"))
        ids = if_small(wanted.select("row_id"))
        texts = self.rows.join(ids, F.col("id").eqNullSafe(F.col("row_id")), "left_semi")
        found = self._hashed(texts, True).withColumnsRenamed({"d1": "e1", "d2": "e2"})
        same = F.col("id").eqNullSafe(F.col("row_id")) & F.expr("d1 = e1 AND d2 = e2")
        # An id may stand for rows with equal texts.
        rows = found.join(few, same).select("node", "n", "first")
        return rows.groupBy("node").agg(F.first("n").alias("n"), F.first("first").alias("first"))


def _prefixes(firsts: DataFrame, corpus: _Corpus, bounds: _Bounds) -> DataFrame:
    """(node, n, rare, prefix) of all nodes, by one order of all shingles.

    The order is: level, then hash. Sets mostly of frequent shingles have to be seen
    whole; what is frequent among these is added once, and the order stays from there.
    """

    def whole(parted: DataFrame) -> DataFrame:
        untold = written(parted.filter(F.col("prefix").isNull()).select("node"), "untold")
        return written(corpus.sets(untold), "whole")

    frequent = written(_frequent(firsts), "frequent")
    parted = written(_with_prefix(firsts, frequent, bounds), "parted")
    seen = whole(parted)
    if seen.isEmpty():
        return parted
    both = frequent.unionByName(_frequent(seen)).groupBy("shingle").agg(F.max("level").alias("level"))
    frequent = written(both, "frequent")
    discard(parted)
    others = firsts.join(if_small(seen.select("node")), "node", "left_anti")
    parted = written(
        _with_prefix(others, frequent, bounds).unionByName(_with_prefix(seen, frequent, bounds)), "parted"
    )
    more = whole(parted)
    if more.isEmpty():
        return parted
    told = parted.filter(F.col("prefix").isNotNull())
    return written(told.unionByName(_with_prefix(more, frequent, bounds)), "prefixes")


def _both(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) with size and shingles of each: na, sa, nb, sb."""
    one = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("first").alias("sa"))
    two = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("first").alias("sb"))
    return pairs.join(two, "b").join(one, "a")


def _ends(pairs: DataFrame) -> DataFrame:
    return written(
        pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct(),
        "ends",
    )


def _alike(pairs: DataFrame, corpus: _Corpus, bounds: _Bounds) -> DataFrame:
    """The pairs (a, b) of nodes that are alike, by their whole sets.

    The stored first shingles by hash tell most others apart: up to the smaller of both
    last hashes nothing is left out, and what one set has there alone, it has for good.
    """
    if pairs.isEmpty():
        return pairs
    need = bounds.overlap("na", "nb")
    firsts = corpus.stored.join(if_small(_ends(pairs)), "node", "left_semi")
    last = "IF(size(s{0}) < n{0}, element_at(s{0}, -1), 9223372036854775807L)"
    ended = _both(pairs, firsts).withColumns(
        {
            "cut": F.expr(f"least({last.format('a')}, {last.format('b')})"),
            "shared": F.size(F.array_intersect("sa", "sb")),
        }
    )
    alone = "size(filter(s{0}, x -> x <= cut)) - shared <= n{0} - {1}"
    likely = ended.filter(" AND ".join(alone.format(own, need) for own in "ab")).select("a", "b")
    likely = written(likely, "likely")
    if likely.isEmpty():
        return likely
    sets = written(corpus.sets(_ends(likely)), "compared")
    shared = F.size(F.array_intersect("sa", "sb"))
    found = written(_both(likely, sets).filter(shared >= F.expr(need)).select("a", "b"), "alike")
    discard(sets)
    return found


def _grown(joined: DataFrame, found: DataFrame) -> DataFrame:
    """Components (node, component) of what was joined before and the alike pairs found."""
    if found.isEmpty():
        return joined
    edges = joined.select(F.col("node").alias("u"), F.col("component").alias("v"))
    more = found.select(F.col("a").alias("u"), F.col("b").alias("v"))
    return written(components(edges.unionByName(more)), "joined")


def _led(live: DataFrame, joined: DataFrame, turn: int, bounds: _Bounds) -> DataFrame:
    """One pair (a, b) for each group that shares a shingle with a leader of another component.

    The leader of a shingle is at first the set with the fewest rare shingles, which is
    the likeliest to be alike many; then another in each turn. A group takes the leader
    with which it shares most.
    """
    rank = F.col("rare") if turn == 0 else F.xxhash64("node", F.lit(turn))
    rows = live.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    leader = F.min(F.struct(rank.alias("rank"), "node", "n", "at", "met", "component")).alias("l")
    heads = rows.groupBy("shingle").agg(leader, F.max("component").alias("high"), F.min("component").alias("low"))
    heads = heads.filter("high > low").select("shingle", "l")
    led = rows.join(heads, "shingle").filter(
        (F.col("component") != F.col("l.component")) & F.expr(bounds.open("{}", "l.{}"))
    )
    shared = led.groupBy("node", F.col("l.node").alias("leader")).agg(F.count("*").alias("shared"))
    best = shared.groupBy("node").agg(F.max(F.struct("shared", "leader")).alias("best"))
    return best.select(F.col("node").alias("a"), F.col("best.leader").alias("b"))


def _apart(live: DataFrame, groups: DataFrame, joined: DataFrame) -> DataFrame:
    """Rows of shingles that groups of different components share, with the least and the
    largest component of each group's members."""
    own = groups.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    spans = own.groupBy(F.col("g").alias("node")).agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    )
    rows = live.join(spans, "node")
    mixed = rows.groupBy("shingle").agg(F.min("low").alias("a"), F.max("high").alias("b"))
    return rows.join(mixed.filter("a < b").select("shingle"), "shingle")


def _pairs(left: DataFrame, groups: DataFrame, joined: DataFrame, bounds: _Bounds) -> DataFrame:
    """Pairs (a, b) of nodes in different components that no filter of their groups rules out."""
    short = left.filter(F.col("at") < F.expr(bounds.index("n")))
    names = ("node", "n", "at", "met", "low", "high")
    one = short.select("shingle", *(F.col(c).alias(f"{c}1") for c in names))
    two = left.select("shingle", *(F.col(c).alias(f"{c}2") for c in names))
    smaller = "(n1 < n2 OR (n1 = n2 AND node1 < node2))"
    apart = "(low1 < high1 OR low2 < high2 OR low1 != low2)"
    met = one.join(two, "shingle").filter(
        f"{smaller} AND {apart} AND {bounds.open('{}1', '{}2')}"
    )
    met = met.select(F.col("node1").alias("g1"), F.col("node2").alias("g2")).distinct()
    # Within a group, all members share the prefix.
    members = groups.join(joined, "node", "left").select(
        "g", "node", F.coalesce("component", "node").alias("component")
    )
    spans = members.groupBy("g").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    within = spans.filter("low < high").select(F.col("g").alias("g1"), F.col("g").alias("g2"))
    left_, right = (
        members.select(F.col("g").alias(f"g{i}"), F.col("node").alias(c), F.col("component").alias(f"c{i}"))
        for i, c in ((1, "a"), (2, "b"))
    )
    expanded = met.unionByName(within).join(left_, "g1").join(right, "g2")
    return expanded.filter("c1 != c2 AND (g1 != g2 OR a < b)").select("a", "b")


def jaccard_components(
    docs: DataFrame,
    shingle: int = 3,
    percent: int = 90,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Group documents: ``id_col``, n_shingles, component_id, one row per row.

    Words are runs without ASCII white space, A-Z in lower case. Two documents are linked
    if 100 * shared shingles >= percent * all shingles of both. component_id is the least
    id that links reach from a row, its own included; null ids count only where a group
    has no other. A text of fewer words than a shingle is one shingle; a null text or one
    without words has none and is linked with nothing. Rows with equal sets, whatever their
    ids, are one group. An empty table gives no rows; other columns are ignored.

    Shingles are compared by 64-bit hashes and copies found by 128-bit digests of sets.
    """
    bounds = _Bounds(percent)
    corpus = _Corpus(docs, shingle, percent, id_col, text_col)
    sets = written(corpus.firsts().withColumn("row", F.monotonically_increasing_id()), "sets")
    # Of equal sets one row stands for all.
    copies = sets.filter("n > 0").groupBy("n", "d1", "d2")
    head = F.min(F.struct("row", "id"))
    nodes = written(
        copies.agg(head.alias("head"), F.min("id").alias("least"), F.first("first").alias("first")).select(
            F.col("head.row").alias("node"), F.col("head.id").alias("row_id"), "least", "n", "d1", "d2", "first"
        ),
        "nodes",
    )
    corpus.nodes = nodes.select("node", "row_id", "d1", "d2")
    corpus.stored = nodes.select("node", "n", "first")
    prefixes = _prefixes(corpus.stored, corpus, bounds)

    keyed = prefixes.select(
        "node", "n", F.xxhash64("n", "prefix").alias("k1"), F.xxhash64(F.lit(1), "prefix", "n").alias("k2")
    )
    heads = keyed.groupBy("n", "k1", "k2").agg(F.min("node").alias("g"))
    groups = written(keyed.join(heads, ["n", "k1", "k2"]).select("node", "g", "n"), "groups")
    first = groups.filter("node = g").select("node")
    places = prefixes.join(first, "node", "left_semi").select(
        "node", "n", "rare", F.posexplode("prefix").alias("at", "shingle")
    )
    shared = places.groupBy("shingle").agg(F.count("*").alias("k")).filter("k > 1").select("shingle")
    met = F.row_number().over(Window.partitionBy("node").orderBy("at")) - 1
    live = written(places.join(shared, "shingle").withColumn("met", met), "live")

    members = groups.filter("node != g").select(F.col("node").alias("a"), F.col("g").alias("b"))
    none = written(groups.filter("node < g").select("node", F.col("g").alias("component")), "none")
    joined = _grown(none, _alike(written(members, "members"), corpus, bounds))
    for turn in range(ROUNDS):
        pairs = written(_led(live, joined, turn, bounds), "led")
        found = _alike(pairs, corpus, bounds)
        joined = _grown(joined, found)
        if found.count() * FEW <= pairs.count():
            break
    left = written(_apart(live, groups, joined), "apart")
    pairs = written(_pairs(left, groups, joined, bounds), "pairs")
    joined = _grown(joined, _alike(pairs, corpus, bounds))

    named = nodes.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(least, "component").select("n", "d1", "d2", "component_id")
    result = sets.select("id", "n", "d1", "d2").join(named, ["n", "d1", "d2"], "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return result.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), own.alias("component_id")
    )

"""Main text of web pages, by a style tree for each host.

The block elements of a host's pages are merged by their path. A node of the merged
tree has the styles (sequences of children) and the contents (texts) its pages show
there. Importance is entropy: a place that looks and reads the same on every page
of a host matters little, one that differs from page to page matters much. Branches
of little importance are taken out of each page.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punchcard.llm.common import batch_of, in_batches, text_of, written

# Names of HTML elements.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt"
    " fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup html li main"
    " menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
RAW = frozenset(
    "script style textarea title noscript template iframe svg math object canvas audio"
    " video select button xmp noembed noframes".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements that end where a new one of the second kind begins.
CLOSED_BY = {
    "p": BLOCK - {"html", "body"},
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"},
    "tr": {"tr", "tbody", "tfoot"},
    "thead": {"tbody", "tfoot"},
    "tbody": {"tbody", "tfoot"},
}
CLOSERS: dict[str, list[str]] = {}
for _open, _new in CLOSED_BY.items():
    for _tag in _new:
        CLOSERS.setdefault(_tag, []).append(_open)
# What those do not look beyond.
SCOPE = frozenset("ul ol dl table article main section div blockquote menu dir".split())
FURNITURE = frozenset("nav header footer aside form menu dialog fieldset address".split())
CONTENT = frozenset("article main".split())
# Words in class, id and role attributes of page furniture.
FURNITURE_WORDS = frozenset(
    "ad ads adsense advert advertisement advertising banner breadcrumb breadcrumbs comment"
    " comments complementary consent contentinfo cookie cookies copyright disqus footer"
    " gdpr legal login masthead menu modal nav navbar navigation newsletter notice"
    " notification pager pagination popup promo promotion recommended related replies"
    " respond search share sharing sidebar signup social sponsor sponsored subscribe"
    " toolbar widget".split()
)
# Those that a part of an article's own text may have as well.
DOUBTFUL_WORDS = frozenset(
    "legal login notice promotion recommended related search share sharing social".split()
)
# Elements that are furniture however much of a page they hold.
NO_WRAPPER = frozenset("nav footer menu dialog address".split())
# Share of a page's text from which an element with a furniture name is a wrapper, and
# from which the tree is asked.
WRAPPER, LARGE = 0.9, 0.5
HEADER_WORDS = frozenset("banner header masthead".split())

_MARKUP = re.compile(r"<(?:!|\?|/?[a-zA-Z])")
# A tag without < and > in its values: the usual one.
_PLAIN = re.compile(r"</?([a-zA-Z][^\s/<>]*+)([^<>]*+)>")
_PAIRED = re.compile(r"(?:[^\"']++|\"[^\"]*+\"|'[^']*+')*+")
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_CLOSE = re.compile(">")
_COMMENT_END = re.compile("-->")
_QUOTE = re.compile(r"=\s*([\"'])")
_HEAD_END = re.compile(r"</head\s*>|<body\b", re.IGNORECASE)
_ATTRIBUTE = re.compile(
    r"\b(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?",
    re.IGNORECASE,
)
_WORD = re.compile(r"[a-z]+|[0-9]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"

# Standing of a node by its element or names; its branch has it too. DOUBTFUL is page
# furniture unless the tree knows the place and finds it important.
NEUTRAL, INSIDE, OUTSIDE, HIDDEN, DOUBTFUL = 0, 1, 2, 3, 4


@dataclass(slots=True)
class Node:
    tag: str
    path: str
    parent: int
    standing: int
    start: int  # where its tag begins in the source
    own: bool  # page furniture by its own element or names
    children: list[str] = field(default_factory=list)


@dataclass(slots=True)
class Page:
    """Nodes, and blocks of text as (node, text) in page order."""

    nodes: list[Node]
    blocks: list[tuple[int, str]]


def _names(attributes: str) -> tuple[str, set[str], bool]:
    """Names for the path, their words, and whether the element is hidden."""
    if not attributes or attributes.isspace():
        return "", set(), False
    names, hidden = [], False
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key in ("class", "id", "role"):
            names += [value.lower(), _CAMEL.sub("-", value).lower()]
        elif key == "hidden":
            hidden = True
        elif key == "style":
            hidden = hidden or bool(_HIDDEN.search(value))
        else:
            hidden = hidden or value.lower() == "true"
    words = set(_WORD.findall(" ".join(names)))
    return ".".join(sorted(w for w in words if w.isalpha())), words, hidden


def _furniture(tag: str, words: set[str]) -> bool:
    return tag in FURNITURE or bool(words & FURNITURE_WORDS) or "header" in words


def _standing(tag: str, words: set[str], hidden: bool, above: int, wrapper: int | None) -> int:
    """``wrapper``: the standing the whole page gives the element, in place of its names'."""
    if above == HIDDEN or hidden:
        return HIDDEN
    if above == OUTSIDE:
        return OUTSIDE
    if wrapper is not None:
        return above if wrapper == NEUTRAL else wrapper
    if above != DOUBTFUL:
        if tag in CONTENT:
            return INSIDE
        if tag in ("html", "body"):
            return above
        if above == INSIDE and (tag == "header" or words & HEADER_WORDS):
            return INSIDE  # the article's own head, with its title
    if _furniture(tag, words):
        doubtful = tag not in FURNITURE and words & FURNITURE_WORDS <= DOUBTFUL_WORDS
        if above == INSIDE and doubtful and "header" not in words:
            return DOUBTFUL
        return OUTSIDE
    return above


class _Scanner:
    """Tags of a source, asked for at places that only grow, in time as its length.

    A tag ends at the first ``>`` outside of quoted values; if there is none, at the first
    one. What a search found is kept until the asking place is beyond it, and a quoted
    value from which no tag ends is not tried again.
    """

    def __init__(self, source: str) -> None:
        self.source = source
        self.next: dict[re.Pattern, tuple[int, re.Match]] = {}
        self.none: dict[re.Pattern, int] = {}
        self.vain: set[int] = set()

    def find(self, pattern: re.Pattern, at: int) -> re.Match | None:
        """The first match from ``at``, not searched for again where that is known."""
        if at >= self.none.get(pattern, len(self.source) + 1):
            return None
        since, found = self.next.get(pattern, (0, None))
        if found is None or not since <= at <= found.start():
            found = pattern.search(self.source, at)
            if found is None:
                self.none[pattern] = at
            else:
                self.next[pattern] = at, found
        return found

    def _tag_end(self, at: int) -> int:
        """Where the tag whose name ends at ``at`` ends, or -1."""
        nearest = self.find(_CLOSE, at)
        if nearest is None:
            return -1
        tried, place = [], at
        while close := self.find(_CLOSE, place):
            quote = self.find(_QUOTE, place)
            if quote is None or close.start() < quote.start(1):
                return close.end()
            if quote.start(1) in self.vain:
                break
            tried.append(quote.start(1))
            place = self.source.find(quote[1], quote.end()) + 1
            if not place:
                break
        self.vain.update(tried)
        return nearest.end()

    def tag(self, at: int) -> tuple[int, int, str, str] | None:
        """start, end, name and attributes of the next markup; a comment has no name."""
        while found := _MARKUP.search(self.source, at):
            start = found.start()
            if plain := _PLAIN.match(self.source, start):
                attributes = plain[2]
                # With quotes in pairs it ends here.
                if '"' not in attributes and "'" not in attributes or _PAIRED.fullmatch(attributes):
                    return start, plain.end(), plain[1], attributes
            if self.source.startswith("<!--", start):
                end = self.find(_COMMENT_END, start + 4)
                return start, end.end() if end else len(self.source), "", ""
            if self.source[start + 1] in "!?":
                end = self.find(_CLOSE, start)
                return start, end.end() if end else len(self.source), "", ""
            name = _NAME.match(self.source, start)
            end = self._tag_end(name.end())
            if end > 0:
                return start, end, name[1], self.source[name.end() : end - 1]
            at = name.end()
        return None


def parse(source: str) -> Page:
    """Block elements of a page and their text; inline elements leave no node.

    Broken markup is taken as browsers do: elements that are not closed end with their
    parent or where a next one of their kind begins, stray end tags are ignored.
    An element with a furniture name that holds the page's article, or nearly all text,
    is a wrapper and stands as what it is in.
    """
    page = _parse(source, {})
    wrappers = _wrappers(page)
    return _parse(source, wrappers) if wrappers else page


def _wrappers(page: Page) -> dict[int, int]:
    """By start: the standing of elements whose names the page as a whole overrules."""
    nodes = page.nodes
    if not any(node.own for node in nodes):
        return {}
    size = [0] * len(nodes)
    for node, text in page.blocks:
        if nodes[node].standing != HIDDEN:
            size[node] += len(text)
    for node in range(len(nodes) - 1, 0, -1):
        size[nodes[node].parent] += size[node]
    articles = [n for n, node in enumerate(nodes) if node.tag in CONTENT and size[n]]
    free = {n for n in articles if nodes[n].standing == INSIDE}
    found: dict[int, int] = {}
    if articles and not free:
        # The largest article, the outermost of those of one size.
        node = max(articles, key=lambda n: (size[n], -n))
        while node:
            if nodes[node].own:
                found[nodes[node].start] = NEUTRAL
            node = nodes[node].parent
        return found
    # In what each node stands: its outermost article, or else the page.
    within = [0] * len(nodes)
    for n, node in enumerate(nodes):
        if n:
            within[n] = within[node.parent] or (n if n in free else 0)
            whole = size[within[n]]
            if not node.own or node.tag in NO_WRAPPER or not whole or free and not within[n]:
                continue
            if size[n] >= WRAPPER * whole:
                found[node.start] = NEUTRAL
            elif size[n] > LARGE * whole and not within[n]:
                found[node.start] = DOUBTFUL
    return found


def _parse(source: str, wrappers: dict[int, int]) -> Page:
    nodes = [Node("", "", -1, NEUTRAL, -1, False)]
    blocks: list[tuple[int, str]] = []
    stack = [0]
    text: list[str] = []
    # Open tags, all of them and by the SCOPE element they stand in: no search in vain
    # goes through the stack, however deep it is.
    opened: dict[str, int] = {}
    scopes: list[dict[str, int]] = [{}]

    def close(depth: int) -> None:
        while len(stack) > depth:
            tag = nodes[stack.pop()].tag
            opened[tag] -= 1
            if tag in SCOPE:
                scopes.pop()
            elif tag in CLOSED_BY:
                scopes[-1][tag] -= 1

    def flush() -> None:
        if text:
            joined = html.unescape("".join(text))
            text.clear()
            words = joined.split()
            if words:
                blocks.append((stack[-1], " ".join(words)))

    at, headed, scanner = 0, False, _Scanner(source)
    while found := scanner.tag(at):
        begin, end, tag, attributes = found
        if begin > at:
            text.append(source[at:begin])
        at = end
        if not tag:
            continue
        tag = tag.lower()
        closing = source[begin + 1] == "/"
        if tag == "br":
            text.append(" ")
            continue
        if closing:
            if opened.get(tag):
                flush()
                depth = len(stack) - 1
                while nodes[stack[depth]].tag != tag:
                    depth -= 1
                close(depth)
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag in RAW:
            # Nothing in here is text; it ends at its own end tag.
            ends = scanner.find(re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.IGNORECASE), at)
            if ends:
                at = ends.end()
            elif tag in ("script", "style", "textarea", "title", "xmp"):
                at = len(source)
            continue
        if tag == "head":
            ends = None if headed else _HEAD_END.search(source, at)
            headed = True
            if ends and not _in_raw(source[at : ends.start()]):
                at = ends.start()
            continue
        block = tag in BLOCK
        name, words, hidden = _names(attributes)
        above = nodes[stack[-1]].standing
        wrapper = wrappers.get(begin)
        standing = _standing(tag, words, hidden, above, wrapper)
        own = _furniture(tag, words)
        if not block and standing == above and not own:
            continue
        flush()
        if block:
            here = scopes[-1]
            for open_tag in CLOSERS.get(tag, ()) if here else ():
                if here.get(open_tag):
                    depth = len(stack) - 1
                    while tag not in CLOSED_BY.get(nodes[stack[depth]].tag, ()):
                        depth -= 1
                    close(depth)
                    break
            above = nodes[stack[-1]].standing
            standing = _standing(tag, words, hidden, above, wrapper)
        if source[end - 2] == "/" and not block:
            continue
        parent = stack[-1]
        label = f"{tag}.{name}" if name else tag
        siblings = nodes[parent].children
        if not siblings or siblings[-1] != label:
            siblings.append(label)
        # The path is hashed step by step, so that a deep page stays small.
        path = xxhash.xxh64_hexdigest(f"{nodes[parent].path}/{label}".encode("utf-8", "surrogatepass"))
        nodes.append(Node(tag, path, parent, standing, begin, own))
        stack.append(len(nodes) - 1)
        opened[tag] = opened.get(tag, 0) + 1
        if tag in SCOPE:
            scopes.append({})
        elif tag in CLOSED_BY:
            scopes[-1][tag] = scopes[-1].get(tag, 0) + 1
    if at < len(source):
        text.append(source[at:])
    flush()
    return Page(nodes, blocks)


def _in_raw(head: str) -> bool:
    """True if ``head`` ends within a script or style."""
    found = re.findall(r"<(/?)(?:script|style)\b", head, re.IGNORECASE)
    return bool(found) and not found[-1]


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def page_nodes(page: Page) -> tuple[dict[str, str], dict[str, set[str]]]:
    """By path: the style (children of all its elements) and the texts."""
    styles: dict[str, list[str]] = {}
    for node in page.nodes:
        styles.setdefault(node.path, []).append(",".join(node.children))
    texts: dict[str, set[str]] = {}
    for node, text in page.blocks:
        texts.setdefault(page.nodes[node].path, set()).add(text)
    return {path: ";".join(sorted(set(own))) for path, own in styles.items()}, texts


_STYLE, _TEXT = 0, 1


def _observations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each page: its nodes, each with its style and its texts."""
    for batch in batches:
        rows, nodes, kinds, values = [], [], [], []
        for row, source in enumerate(batch.column("html").to_pylist()):
            styles, texts = page_nodes(parse(source))
            for path, style in styles.items():
                node = _hash(path)
                found = [(_STYLE, style), *((_TEXT, text) for text in texts.get(path, ()))]
                for kind, value in found:
                    rows.append(row)
                    nodes.append(node)
                    kinds.append(kind)
                    values.append(_hash(value))
        at = pa.array(rows, pa.int64())
        yield batch_of(
            host=(batch.column("host").take(at), None),
            node=(nodes, pa.int64()),
            kind=(kinds, pa.int32()),
            value=(values, pa.int64()),
        )


def _own_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, nodes = [], []
        for row, source in enumerate(batch.column("html").to_pylist()):
            for path in {node.path for node in parse(source).nodes}:
                rows.append(row)
                nodes.append(_hash(path))
        at = pa.array(rows, pa.int64())
        yield batch_of(
            key=(batch.column("key").take(at), None),
            host=(batch.column("host").take(at), None),
            node=(nodes, pa.int64()),
        )


def _payloads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the verdict needs of a page, compressed: far less than its source is moved."""
    packer = zstandard.ZstdCompressor(level=9)
    for batch in batches:
        packed = []
        for source in batch.column("html").to_pylist():
            page = parse(source)
            lines = [str(len(page.nodes))]
            for node in page.nodes:
                lines.append(f"{node.parent} {node.standing} {_hash(node.path)}")
            lines += [
                f"{node} {text}"
                for node, text in page.blocks
                if page.nodes[node].standing not in (OUTSIDE, HIDDEN)
            ]
            packed.append(packer.compress("\n".join(lines).encode("utf-8", "surrogatepass")))
        yield batch_of(
            key=(batch.column("key"), None),
            row=(batch.column("row"), None),
            payload=(packed, pa.binary()),
        )


@dataclass(frozen=True)
class StyleRules:
    gamma: float = 0.9  # attenuation of what lies below a node
    threshold: float = 0.3  # branches of less importance go
    min_pages: int = 10  # a place seen on fewer pages of a host tells nothing
    outside: float = 0.1  # weight of the importance of page furniture
    inside: float = 0.5  # least importance in an article, unless all pages are the same there
    same: float = 1e-6  # importance of a place that is the same on all pages, at most
    doubtful: float = 0.5  # weight where a furniture name may be wrong


def verdict(lines: list[str], stats: dict[int, dict], rules: StyleRules) -> str:
    """The text that is left of a page, given the figures of its nodes on its host.

    The composite importance of a node is that of its own styles, and, attenuated by the
    number of styles, the mean of its children's on this page; that of a leaf is the one
    of its texts. It is weighted by the standing of the node. A branch goes if neither
    its top nor any node in it is important.
    """
    count = int(lines[0])
    parents, standings, hashes = [], [], []
    for line in lines[1 : count + 1]:
        parent, standing, own = line.split(" ")
        parents.append(int(parent))
        standings.append(int(standing))
        hashes.append(int(own))
    blocks = [line.split(" ", 1) for line in lines[count + 1 :]]
    below = [0.0] * count
    children = [0] * count
    kept = [False] * count
    for node in range(count - 1, -1, -1):
        own = stats.get(hashes[node])
        if own is None or own["pages"] < rules.min_pages:
            importance = 1.0
        else:
            parts = []
            if own["text"] is not None:
                parts.append(own["text"])
            if children[node]:
                weight = rules.gamma ** own["styles"]
                parts.append(
                    (1 - weight) * own["style"] + weight * below[node] / children[node]
                )
            importance = max(parts) if parts else own["style"]
        if node:
            below[parents[node]] += importance
            children[parents[node]] += 1
        known = own is not None and own["pages"] >= rules.min_pages
        if standings[node] in (OUTSIDE, HIDDEN) or (standings[node] == DOUBTFUL and not known):
            importance *= rules.outside
        elif standings[node] == DOUBTFUL:
            importance *= rules.doubtful
        elif standings[node] == INSIDE and importance > rules.same:
            importance = max(importance, rules.inside)
        kept[node] = kept[node] or importance >= rules.threshold
        if node and kept[node]:
            kept[parents[node]] = True
    left = [text for node, text in blocks if kept[int(node)]]
    # Nothing important: a page of one copied text, say. Then all but furniture is left.
    sure = (NEUTRAL, INSIDE)
    return "\n".join(left or [text for node, text in blocks if standings[int(node)] in sure])


def _verdicts(rules: StyleRules):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            texts = []
            payloads = batch.column("payload").to_pylist()
            for payload, own in zip(payloads, batch.column("stats").to_pylist(), strict=True):
                lines = unpacker.decompress(payload).decode("utf-8", "surrogatepass").split("\n")
                texts.append(verdict(lines, {s["node"]: s for s in own or ()}, rules))
            yield batch_of(row=(batch.column("row"), None), text=(texts, pa.string()))

    return run


def node_figures(pages: DataFrame) -> DataFrame:
    """host, node, pages, styles, style, text: figures of the merged nodes of each host.

    style is the entropy of the styles over the pages that have the node, to the base of
    their number; text is 1 less the mean entropy of where its texts stand: 0 for
    texts on every page, 1 for texts of one page. Both are sums, so that a host with
    very many pages is reduced before the shuffle.
    """
    seen = in_batches(
        pages.select("host", "html"),
        _observations,
        "host string, node long, kind int, value long",
    )
    counted = seen.groupBy("host", "node", "kind", "value").agg(F.count("*").alias("n"))

    def over(kind: int, value: Column) -> Column:
        return F.sum(F.when(F.col("kind") == kind, value))

    n = F.col("n")
    sums = counted.groupBy("host", "node").agg(
        over(_STYLE, n).alias("pages"),
        over(_STYLE, F.lit(1)).alias("styles"),
        over(_STYLE, n * F.ln(n)).alias("style_sum"),
        over(_TEXT, n).alias("texts"),
        over(_TEXT, n * F.ln(n)).alias("text_sum"),
    )
    alone = F.col("pages") < 2
    return sums.select(
        "host",
        "node",
        "pages",
        "styles",
        F.when(alone, 1.0)
        .otherwise(1 - F.col("style_sum") / F.col("pages") / F.ln(F.greatest("pages", F.lit(2))))
        .alias("style"),
        F.when(F.col("texts").isNull(), None)
        .when(alone, 1.0)
        .otherwise(
            F.greatest(
                F.lit(0.0),
                1 - F.col("text_sum") / F.col("texts") / F.ln(F.greatest("pages", F.lit(2))),
            )
        )
        .alias("text"),
    )


def main_texts(
    pages: DataFrame,
    rules: StyleRules | None = None,
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """The main text of every page: row (all columns of ``pages`` but the html), text.

    A null html is an empty page and gives an empty text; a null url counts as a host of
    its own. Equal rows get equal texts, one row per row; an empty table gives no
    rows. Page ids are not read.
    """
    used = rules or StyleRules()
    host = F.lower(F.regexp_extract(text_of(url_col), _HOST, 1))
    rest = [F.col(f"`{c}`") for c in pages.columns if c != html_col]
    source = pages.select(
        F.struct(*rest).alias("row"), host.alias("host"), text_of(html_col).alias("html")
    )
    key = F.struct(F.xxhash64("host", "html").alias("a"), F.xxhash64("html", "host").alias("b"))
    source = source.withColumn("key", key)
    stats = node_figures(source).filter(F.col("pages") >= used.min_pages)
    nodes = in_batches(
        source.select("key", "host", "html"),
        _own_nodes,
        "key struct<a: bigint, b: bigint>, host string, node long",
    )
    figures = F.struct("node", "pages", "styles", "style", "text")
    # Written, so that a host with very many pages can be split in the join.
    known = nodes.join(written(stats, "figures"), ["host", "node"])
    by_page = known.groupBy("key").agg(F.collect_set(figures).alias("stats"))
    kind = source.schema["row"].dataType.simpleString()
    payloads = in_batches(
        source.select("key", "row", "html"),
        _payloads,
        f"key struct<a: bigint, b: bigint>, row {kind}, payload binary",
    )
    judged = payloads.join(by_page, "key", "left").select("row", "payload", "stats")
    return in_batches(judged, _verdicts(used), f"row {kind}, text string")

import html
import math
import random
import re
import time
from collections import Counter, defaultdict

import pytest

from punchcard.llm.site_style import StyleRules, main_texts, node_figures, page_nodes, parse
from punchcard.llm.site_style import _hash, verdict

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture
def pages(spark):
    def make(rows):
        return spark.createDataFrame(rows, "page_id long, url string, html string")

    return make


def texts(frame):
    return {r.row.page_id: r.text for r in main_texts(frame).collect()}


def article_of(source):
    """Text of the article of a generated page, by its markup."""
    inside = re.search(r"<article>(.*)</article>", source, re.DOTALL)[1]
    blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>|<br>", " ", inside))
    found = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks)
    return "\n".join(b for b in found if b)


def test_all_pages(spark):
    frame = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    want = {r.page_id: article_of(r.html) for r in frame.collect()}
    assert texts(frame) == want


def test_figures_against_brute_force(spark):
    frame = spark.read.parquet(f"{SF_DIR}/pages.parquet").selectExpr(
        "case when page_id % 3 = 0 then 'hot' else substr(url, 1, 14) end host", "html"
    )
    seen = defaultdict(lambda: (Counter(), Counter()))
    for row in frame.collect():
        styles, found = page_nodes(parse(row.html))
        for path, style in styles.items():
            seen[row.host, _hash(path)][0][style] += 1
            seen[row.host, _hash(path)][1].update(found.get(path, ()))
    rows = node_figures(frame).collect()
    assert len(rows) == len(seen)
    for row in rows:
        styles, found = seen[row.host, row.node]
        m = sum(styles.values())
        assert (row.pages, row.styles) == (m, len(styles))
        entropy = -sum(n / m * math.log(n / m, m) for n in styles.values()) if m > 1 else 1
        assert row.style == pytest.approx(entropy, abs=1e-9)
        if found and m > 1:
            # Each text as often as it stands: the place of its pages is even.
            spread = sum(n * math.log(n, m) for n in found.values()) / sum(found.values())
            assert row.text == pytest.approx(max(0, 1 - spread), abs=1e-9)
        else:
            assert row.text == (1 if found else None)


def test_repeated_places_without_names_go(pages):
    """No article, no telling names: only the tree of the host tells."""
    rng = random.Random(1)

    def page(i):
        own = " ".join(f"word{rng.randrange(10**6)}" for _ in range(30))
        return (
            f"<html><body><div class=top><div>Home</div><div>Weather today</div></div>"
            f"<div class=x1><p>{own}</p><p>Second {own}</p></div>"
            f"<table><tr><td>Call us now</td></tr></table></body></html>"
        ), f"{own}\nSecond {own}"

    made = [page(i) for i in range(40)]
    rows = [(i, f"http://Site.example.com/{i}", source) for i, (source, _) in enumerate(made)]
    assert texts(pages(rows)) == {i: text for i, (_, text) in enumerate(made)}
    # On hosts of their own the pages tell nothing of each other.
    alone = [(i, f"http://s{i}.example.com/", source) for i, (source, _) in enumerate(made[:3])]
    assert texts(pages(alone))[0].startswith("Home\nWeather today\n")


def test_copies_keep_their_article(pages):
    source = "<body><nav>Menu</nav><article><p>The same text.</p></article></body>"
    rows = [(i, "http://a.example.com/", source) for i in range(30)]
    assert set(texts(pages(rows)).values()) == {"The same text."}
    plain = "<body><div>The same text.</div></body>"
    rows = [(i, "http://a.example.com/", plain) for i in range(30)]
    assert set(texts(pages(rows)).values()) == {"The same text."}


CASES = {
    "<p>a &amp; b&nbsp;&#233;&lt;p&gt;</p>": "a & b é<p>",
    "<p>one<p>two<br>three\n\t four<b>five</b>": "one\ntwo three fourfive",
    "<ul><li>a<li>b</ul>c": "a\nb\nc",
    "<article><header><h1>T</h1></header><p>x</p><aside>y</aside><footer>z</footer></article>": "T\nx",
    "<header><h1>Site</h1></header><main><p>x</p></main>": "x",
    "<div class='cookie-notice'>c</div><div id=sideBar>s</div><p>x</p>": "x",
    "<article><p>x</p><div class='comments'><p>reader</p></div></article>": "x",
    "<p>x</p><form><p>name</p><input></form><p>y</p>": "x\ny",
    "<script>if (a<b) { '</p>' }</script><style>p{}</style><p>x</p>": "x",
    "<p>x<!-- <p>no --></p><!-- open": "x",
    "<p hidden>h</p><p style='display: none'>h</p><p>x <span class=ad>buy</span> y</p>": "x\ny",
    "<p title='a > b'>x</p><p>1 < 2</p>": "x\n1 < 2",
    "</div></p>x<unknown>y</unknown>": "xy",
    "<head><title>t</title><script>'</head>'</script></head><body>x": "x",
    "<table><tr><td>a<td>b<tr><td>c</table>": "a\nb\nc",
    "": "",
    "   ": "",
    "plain text": "plain text",
    "<p>unclosed <a href='": "unclosed <a href='",
}


@pytest.mark.parametrize("source", CASES)
def test_markup(source):
    page = parse(source)
    lines = [str(len(page.nodes))]
    lines += [f"{n.parent} {n.standing} {_hash(n.path)}" for n in page.nodes]
    lines += [f"{n} {t}" for n, t in page.blocks if page.nodes[n].standing != 2]
    assert verdict(lines, {}, StyleRules()) == CASES[source]


def test_random_markup():
    rng = random.Random(4)
    parts = ["<p>", "</p>", "<div class='a", "'>", "<br/>", "text ", "<!--", "-->", "&am", "<", ">", "</", "<script>", "\""]
    for _ in range(3000):
        parse("".join(rng.choices(parts, k=rng.randrange(40))))


def test_deep_and_long_pages(pages):
    deep = "<div>" * 5000 + "x" + "</div>" * 5000
    long = "<p>word</p>" * 60_000
    found = texts(pages([(1, None, deep), (2, "no url", long), (3, "http://a/", None)]))
    assert found[1] == "x" and found[2] == "\n".join(["word"] * 60_000) and found[3] == ""


def test_repeated_rows_and_names(spark, pages):
    rows = [(1, "http://a/", "<p>x</p>")] * 3 + [(None, None, None)]
    assert sorted(r.text for r in main_texts(pages(rows)).collect()) == ["", "x", "x", "x"]
    assert main_texts(pages([])).count() == 0
    schema = "page_id long, url string, html string, text string, host int, row int, key int"
    one = spark.createDataFrame([(1, "u", "<p>x</p>", "t", 1, 2, 3)], schema)
    assert main_texts(one).first().row.text == "t"


def plain_text(source, stats=None):
    page = parse(source)
    lines = [str(len(page.nodes))]
    lines += [f"{n.parent} {n.standing} {_hash(n.path)}" for n in page.nodes]
    lines += [f"{n} {t}" for n, t in page.blocks]
    return verdict(lines, stats or {}, StyleRules())


@pytest.mark.parametrize("depth", [10, 59, 60, 61, 200])
def test_elements_count_at_any_depth(depth):
    own = "<div>" * depth + "<p>a</p><nav>menu</nav><div class=ad>buy</div>" + "</div>" * depth
    source = f"<article>{own}<p>b</p></article><footer>f</footer><p>c</p>"
    assert plain_text(source) == "a\nb\nc"
    unclosed = "<article>" + "<div>" * depth + "<nav>menu</nav><p>a</p><footer>f</footer></article>"
    assert plain_text(unclosed) == "a"
    page = parse(source)
    assert len({n.path for n in page.nodes}) == len(page.nodes) == depth + 8


def test_deep_broken_pages_take_no_search_for_each_tag():
    n = 20_000
    assert len(parse("<div>" * n + "x</b></td>" * n).nodes) == n + 1
    assert len(parse("<ul><li><div>" + "<form><li>y</li>" * n).blocks) == n


ARTICLE = "<article><h1>T</h1><p>Own text of the page.</p></article>"
MENU = "<nav>Menu</nav><div class=sidebar>side</div>"


@pytest.mark.parametrize(
    "before, after",
    [
        ("<form id=aspnetForm>", "</form>"),
        ("<div class='layout has-sidebar'>", "</div>"),
        ("<div class=no-sidebar><div><section class=search-page>", "</section></div></div>"),
        ("<form>" * 100, "</form>" * 100),
    ],
)
def test_wrappers_with_furniture_names_keep_their_page(before, after):
    assert plain_text(f"<body>{before}{MENU}{ARTICLE}<footer>f</footer>{after}") == (
        "T\nOwn text of the page."
    )
    text = "Some text. " * 20
    assert plain_text(f"<body>{before}{MENU}<p>{text}</p>{after}") == text.strip()
    assert plain_text(f"<article>{before}<p>{text}</p><span class=ad>buy</span>{after}</article>") == (
        text.strip()
    )


def test_furniture_with_articles_stays_furniture():
    more = "<aside class=related><article><p>teaser</p></article></aside>"
    assert plain_text(f"<div class=no-sidebar><main><p>Long text</p></main>{more}</div>") == (
        "Long text"
    )
    assert plain_text(f"{ARTICLE}{more}") == "T\nOwn text of the page."
    assert plain_text(f"<div style='display:none'>{ARTICLE}</div><p>x</p>") == "x"


def test_the_tree_decides_on_doubtful_names_in_articles(pages):
    def page(i, name):
        return (
            f"<article><p>Text {i} of the page, {i * 7} words.</p>"
            f"<div class={name}><p>Part {i}.</p></div><div class=share><p>Share!</p></div></article>"
        )

    rows = [(i, "http://a.example.com/", page(i, "legal-analysis")) for i in range(30)]
    rows += [(i + 30, f"http://b{i}.example.com/", page(i, "legal")) for i in range(3)]
    rows += [(i + 40, "http://c.example.com/", page(i, "comments")) for i in range(30)]
    found = texts(pages(rows))
    assert found[4] == "Text 4 of the page, 28 words.\nPart 4."
    assert found[31] == "Text 1 of the page, 7 words."
    assert found[44] == "Text 4 of the page, 28 words."


def test_the_tree_overrules_an_article(pages):
    """What all pages of a host show in their articles goes; one page less, and it stays."""

    def page(i, line="All rights with the author."):
        return f"<article><p>Text {i}, {i * 7} words.</p><div><b>{line}</b></div></article>"

    rows = [(i, "http://a.example.com/", page(i)) for i in range(30)]
    rows += [(i + 40, f"http://b{i}.example.com/", page(i)) for i in range(3)]
    rows += [(i + 60, "http://c.example.com/", page(i)) for i in range(29)]
    rows += [(90, "http://c.example.com/", page(30, "Another line."))]
    found = texts(pages(rows))
    assert found[4] == "Text 4, 28 words."
    assert found[41] == "Text 1, 7 words.\nAll rights with the author."
    assert found[64] == "Text 4, 28 words.\nAll rights with the author."
    assert found[90] == "Text 30, 210 words.\nAnother line."


@pytest.mark.parametrize(
    "unit",
    [
        "<a ",
        "<a '",
        '<a ="',
        "<head>",
        "<button>",
        "<svg>",
        "<a x=\"'>'\"",
        '<a <a ="',
        "<a x='>",
        "<div>",
        "<p",
        "<!",
        "&",
        "<head><script>",
        "<li><ul>",
    ],
)
def test_time_in_proportion_to_length(unit):
    """Broken markup, a hundred thousand times: no search goes over the rest again and again."""
    began = time.process_time()
    parse(unit * 100_000)
    assert time.process_time() - began < 8


def test_values_with_marks():
    def text(source):
        return [t for _, t in parse(source).blocks]

    assert text("<p title='a>b'>one</p>") == ["one"]
    assert text('<p title="a>b>">one<p class=x>two') == ["one", "two"]
    assert text("<p title='a>one</p><p>two</p>") == ["one", "two"]
    assert text("a < b <p it's>c</p> d <") == ["a < b", "c", "d <"]
    assert text("<p <b>x</b>y") == ["xy"]

import random
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pagewell.functions import markup, pages
from pagewell.functions.lines import line_documents
from pagewell.functions.walker import walk
from pagewell.operators import parse
from pagewell.operators.parse import parse_pages, parse_rows, utc_timestamp
from pagewell.plans import registry

SAMPLE = """<html lang=en>
<head><script>if (a < b) { document.write("<main>never</main>"); }</script>
<meta property="og:title" content="Rye, shared"><title>Rye &amp; wheat</title>
<meta content='rye, flour' name='keywords'><meta name="description" content="Two grains compared">
</head><body><aside>Buy flour</aside>
<article>Outside the region</article>
<main><ul><li>Rye is <i>dark</i></li><!-- hidden --><li>Wheat is light</li></ul><nav>next page</nav></main>
<header><h1>The mill</h1></header><style>li { margin: 0 }</style><footer>Since 1902</footer>
</body></html>"""


def parsed(rows, *contents, **options):
    pages = rows("ordinal long, source string, content string",
                 *[(i, "https://mill.example/grain", c) for i, c in enumerate(contents)])
    return parse_pages(pages, "2025-01-01T00:00:00Z", **options).orderBy("ordinal").collect()


def test_sample_page(rows):
    page, = parsed(rows, SAMPLE)
    assert page.title == "Rye & wheat"
    assert page.content == "Rye is\ndark\nWheat is light"
    assert page.metadata == {
        "domain": "mill.example", "path": "/grain", "description": "Two grains compared",
        "keywords": "rye, flour", "og_title": "Rye, shared"}
    assert (page.source, page.source_type, page.part) == ("https://mill.example/grain", "html", 0)
    assert page.timestamp == "2025-01-01T00:00:00Z"


def test_custom_exclusion(rows):
    page, = parsed(rows, SAMPLE, exclude_elements=["main"])
    assert page.content == "Outside the region"
    assert parsed(rows, SAMPLE, exclude_elements=[])[0].content == parsed(rows, SAMPLE)[0].content


CASES = [
    # content, title, text
    ("<body><p>before</p><h1>A mill</h1>after</body>", "A mill", "before\nA mill\nafter"),
    ("<title></title><h1> A <b>b</b> c</h1>", "Abc", "A\nb\nc"),
    ("<title>  </title><h1>no</h1>", "", "no"),
    ("<title> a &amp; b </title>", "a & b", "a & b"),
    ("<header><h1>gone</h1></header><p>x", "", "x"),
    ("<p>a<p>b<br>c", "", "a\nb\nc"),
    ("<body><main></main><p>x</p></body>", "", ""),
    ("<article>a</article><main>m</main>", "", "m"),
    ("plain text", "", "plain text"),
    ("", "", ""),
    ("a &lt;b&gt; &amp;lt; &nbsp;", "", "a <b> &lt;"),
    ("<p>x&amp</p><p>a &ampere; &amp-b &am</p>", "", "x&\na &ampere &amp-b &am"),
    ("<p>&eacute; &#233; &#xe9; &#150;</p>", "", "é é é –"),
    ("<nav><nav>in</nav>out</nav>x", "", "x"),
    ("<article>a<article>b</article>c</article>d", "", "a\nb\nc"),
    ("<div><nav>a</div>b</nav>c", "", "b\nc"),
    ("<p title='a>b'>x</p>", "", "x"),
    ("<body><aside><p>x</aside>y</body>", "", "y"),
    ("<p>a</p></div></p>b", "", "a\nb"),
    ("<aside/>x", "", "x"),
    ("<template><h1>t</h1></template><ruby>a<rt>b</rt></ruby>", "", "a"),
    ("<!--> a --><p>x", "", None),
    ("<custom-nav>a</custom-nav><nav-bar>b</nav-bar>", "", "a\nb"),
    ("<MAIN>Up<BR/>per</MAIN>", "", "Up\nper"),
    ("a<nav>n</nav>b", "", "a\nb"),
    ("a &nbsp;<b>  c</b>", "", "a\nc"),
    ("<textarea><b>x</b></textarea>", "", "x"),
    ("<script>if (a < b) x()</script>y", "", "y"),
    ("a\x01b", "", "a\x01b"),
    ("<p>&amp&amp</p>", "", "&&"),
]


def test_cases(rows):
    for page, (content, title, text) in zip(parsed(rows, *[c for c, _, _ in CASES]), CASES):
        assert page.title == title, content
        if text is not None:
            assert page.content == text, content


METAS = [
    ('<meta content="x" name="keywords">', {"keywords": "x"}),
    ("<meta name=description content=bare>", {"description": "bare"}),
    ('<meta name="description" content=""><meta name="description" content="second">', {}),
    ('<meta name="description"><meta name="keywords" content=" k ">', {"keywords": " k "}),
    ('<meta name="Description" content="x">', {}),
    ('<meta property="og:title" content="a &quot;b&quot;">', {"og_title": 'a "b"'}),
    ("<meta content=\"name='keywords' y\" name=\"description\">", {"description": "name='keywords' y"}),
    ('<meta name="description" content="a > b">', {"description": "a > b"}),
    ('<nav><meta name="description" content="gone"></nav>', {}),
    ('<meta NAME="keywords" Content="K"/>', {"keywords": "K"}),
]


def test_metas(rows):
    for page, (content, want) in zip(parsed(rows, *[c for c, _ in METAS]), METAS):
        found = {k: v for k, v in page.metadata.items() if k not in ("domain", "path")}
        assert found == want, content


def test_null_content_gives_no_document(rows):
    assert parsed(rows, None) == []


PIECES = (
    ["text", " ", "\n", "&amp;", "&amp", "&lt;p&gt;", "&foo;", "&copy", "a > b", "don't", "é", "\xa0"]
    + [f"<{t}>" for t in ("p", "div", "b", "br", "li", "nav", "main", "article", "aside", "body",
                          "header", "h1", "title", "script", "style", "html", "template")] * 2
    + [f"</{t}>" for t in ("p", "div", "b", "br", "li", "nav", "main", "article", "aside", "body",
                           "header", "h1", "title", "script", "style", "html", "template")] * 2
    + ["<!-- c -->", "<!-- <nav> -->", "<br/>", "<div/>", "<nav/>", "<p class=x>", '<a href="u">',
       "<a title='>'>", "</a>", "<", "</", "<!DOCTYPE html>", '<meta name="description" content="d">',
       "<meta content=e name=keywords>", "<p title='\">"])

NESTED = ("p", "div", "b", "li", "nav", "main", "article", "aside", "header", "h1", "title", "section")


def _tree(rng, depth=0):
    """Mostly well-nested markup."""
    out = []
    for _ in range(rng.randint(0, 4)):
        kind = rng.random()
        if kind < 0.45 or depth > 5:
            out.append(rng.choice(["text", " a ", "&amp;", "<br>", "<!-- x -->", "x &lt; y"]))
        else:
            name = rng.choice(NESTED)
            end = "" if rng.random() < 0.06 else f"</{name}>"
            out.append(f"<{name}>{_tree(rng, depth + 1)}{end}")
    return "".join(out)


def test_expressions_and_walker_agree_on_plain_markup(rows):
    rng = random.Random(7)
    pages = ["".join(rng.choice(PIECES) for _ in range(rng.randint(1, 14))) for _ in range(4000)]
    pages += [_tree(rng) for _ in range(4000)]
    pages = [p for p in dict.fromkeys(pages)]
    frame = rows("ordinal long, content string", *enumerate(pages)).repartition(4)
    content = F.col("content")
    checked = (
        frame.withColumn("o", markup.strip_opaque(content))
        .withColumn("b", markup.bare_tags(F.col("o")))
        .withColumn("plain", markup.is_plain(content, F.col("o"), F.col("b")))
        .withColumn("h", markup.strip_named(F.col("o")))
        .select("content", "plain", markup.plain_title(F.col("h")).alias("t"),
                markup.plain_text(F.col("h")).alias("x"), markup.page_meta(F.col("h")).alias("m"))
        .collect())
    plain = [r for r in checked if r.plain]
    assert 1000 < len(plain) < len(checked)
    for r in plain:
        title, text, *metas = walk(r.content, markup.DEFAULT_EXCLUDED)
        assert (r.t, r.x, [m or None for m in r.m]) == (title, text, [m or None for m in metas]), \
            r.content


def test_public_functions_agree_with_the_walker_on_any_markup(rows):
    """Stripping, then title and text of what is left, and both without stripping."""
    rng = random.Random(11)
    made = ["".join(rng.choice(PIECES) for _ in range(rng.randint(1, 14))) for _ in range(1500)]
    made += [_tree(rng) for _ in range(1500)]
    made += ["<nav>a<nav>b</nav>c</nav>x", "<p title='a>b'>x</p>", "caf&eacute; &#8217;", "<nav>a<p>b", "a<nav>b</div>c"]
    frame = rows("content string", *((p,) for p in dict.fromkeys(made))).repartition(4)
    left = frame.withColumn("s", pages.strip_elements(F.col("content"))).select(
        "content", "s", pages.page_title(F.col("s")).alias("st"), pages.page_text(F.col("s")).alias("sx"),
        pages.page_title(F.col("content")).alias("t"), pages.page_text(F.col("content")).alias("x")).collect()
    for r in left:
        title, text, *_ = walk(r.content, markup.DEFAULT_EXCLUDED)
        assert (r.t, r.x, r.sx) == (title, text, text), r.content
        # Markup inside of a title is no longer told apart once it is stripped.
        if not re.search("(?i)<title[^>]*>[^<]*<(?!/title)", r.content):
            assert r.st == title, r.content
    nulls = rows("content string", (None,)).select(*(f(F.col("content")) for f in (
        pages.strip_elements, pages.page_title, pages.page_text))).first()
    assert list(nulls) == [None] * 3


@pytest.mark.parametrize("page,names,want", [
    ("<nav>a<nav>b</nav>c</nav>x<form>y</form>", ["form"], "<nav>a<nav>b</nav>c</nav>x<!---->"),
    ("<nav>a<nav>b</nav>c</nav>x", None, "<!---->x"), ("<p title='a>b'>x", None, "<p title='a>b'>x"),
    ("<div>a<nav>b</div>c&copy 1", None, "<div>a<!----></div>c&copy 1"),
    ("a\n<!-- x -->\n<NAV\n>b</nav\n><aside/>c", None, "a\n<!---->\n<!----><!---->c"), ("a<nav>b", None, "a<!---->")])
def test_stripped_markup(rows, page, names, want):
    assert rows("c string", (page,)).select(pages.strip_elements(F.col("c"), names)).first()[0] == want


def test_a_filter_on_the_result_is_not_pushed_below_the_reading(rows):
    pages = rows("ordinal long, source string, content string", (0, "a", "<h1>x</h1>"))
    plan = parse_pages(pages, "T").where("title = 'x'")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("read(") == 1


def test_timestamp(rows):
    from datetime import datetime, timedelta, timezone
    when = datetime(2025, 1, 2, 3, 4, 5, 999, tzinfo=timezone(timedelta(hours=2)))
    frame = rows("a long", (1,)).select(
        utc_timestamp(when), utc_timestamp(F.lit(when).cast("timestamp")), utc_timestamp())
    got = frame.first()
    assert got[0] == got[1] == "2025-01-02T01:04:05Z"
    assert len(got[2]) == 20


def _two(content, source):
    if content == "bad":
        raise KeyError("inside the parser")
    if content == "one":
        return {"content": "single"}
    if content == "none":
        return None
    return [{"content": c, "title": c.upper(), "metadata": {"n": 1}} for c in content.split(",")]


def test_row_parser(rows):
    pages = rows("ordinal long, source string, content string",
                 (0, "s0", "a,b"), (1, "s1", "bad"), (2, "s2", "one"), (3, "s3", "none"), (4, "s4", None))
    import sys

    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    documents, rejects = parse_rows(pages, _two, "csv", "T")
    got = [(r.ordinal, r.part, r.title, r.content, r.metadata) for r in
           documents.orderBy("ordinal", "part").collect()]
    assert got == [(0, 0, "A", "a", {"n": "1"}), (0, 1, "B", "b", {"n": "1"}), (2, 0, "", "single", {})]
    reject, = rejects.collect()
    assert (reject.source, reject.reason) == ("s1", "parse_error")
    assert reject.detail.startswith("KeyError")


def test_registry():
    with pytest.raises(ValueError, match="html"):
        registry.get_parser("pdf")
    with pytest.raises(ValueError, match="hashed"):
        registry.get_embedder("none")
    first, second = object(), object()
    try:
        registry.register_parser("x", first)
        registry.register_parser("x", second)
        assert registry.get_parser("x") is second
    finally:
        registry.PARSERS.pop("x", None)


def test_end_tags_without_a_start_cost_no_search():
    import time
    page = "<ul>" + "<li>x<b>y</b></q>" * 40_000
    start = time.perf_counter()
    walk(page, ())
    assert time.perf_counter() - start < 5


def test_user_code_runs_once_per_page(spark, rows, tmp_path):
    from pagewell.plans.ingest import ingest_points
    calls = spark.sparkContext.accumulator(0)

    def counted(content, source):
        calls.add(1)
        if content == "bad":
            raise ValueError(source)
        return [{"content": f"{content} {n}"} for n in range(3)]

    parsers = {"txt": lambda pages, timestamp=None: parse_rows(pages, counted, "txt", timestamp)}
    sources = rows("ordinal long, source string, content string", (0, "a.txt", "x"), (1, "b.txt", "bad"),
                   (2, "a.txt", "y"), (3, "c.txt", "z"))
    points, rejects = ingest_points(sources, timestamp="T", parsers=parsers)
    assert points.count() == 2 and rejects.count() == 1 and len(points.collect()) == 2
    assert {(r.payload["content"], r.copies) for r in points.collect()} == {("y 2", 6), ("z 2", 3)}
    assert calls.value == 4


def test_documents_of_a_parser_are_given_out_in_parts(rows, monkeypatch):
    """A batch of pages is not held as documents at once; an error still drops a whole page."""
    made = [(n, f"s{n}", "\n".join(f"{n} {k}" for k in range(n % 30))) for n in range(300)]
    frame = rows("ordinal long, source string, content string", *made).coalesce(1)

    def lines(content, source):
        if source.endswith("9"):
            return ({} if line.endswith(" 5") else {"content": line} for line in content.split("\n"))
        return line_documents(content, source)

    ran, given = type(frame).mapInPandas, []
    monkeypatch.setattr(type(frame), "mapInPandas", lambda self, run, *more: (given.append(run), ran(self, run, *more))[1])
    monkeypatch.setattr(parse, "ROWS_HELD", 7, raising=False)
    documents, rejects = parse_rows(frame, lines, "txt", "t")
    want = [(n, k, f"{n} {k}") for n in range(300) if n % 10 != 9 for k in range(n % 30)]
    assert sorted((r["ordinal"], r["part"], r["content"]) for r in documents.collect()) == want
    assert sorted(r["ordinal"] for r in rejects.collect()) == list(range(9, 300, 10))
    parts = list(given[0](iter([pd.DataFrame(made, columns=["ordinal", "source", "content"])])))
    assert sum(map(len, parts)) == len(want) + 30 and max(map(len, parts)) == 7

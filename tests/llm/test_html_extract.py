from __future__ import annotations

import html
import math
import re
import time
from random import Random
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from stridelog.llm.html_extract import Counts, Page, densities, extract, main_text

BODY = ("<p>The first paragraph of the article is long enough to weigh something.</p>"
        "<p>The second &amp; last one\n  has <b>bold</b> and <a href='x'>linked</a> words<br>too.</p>")
TEXT = ("The first paragraph of the article is long enough to weigh something.\n"
        "The second & last one has bold and linked words too.")
JUNK = ("<nav><ul><li><a href='/'>Home</a></li><li><a href='/b'>Blog</a></li></ul></nav>",
        "<header><p>Site name and a slogan of some length</p></header>",
        "<div class='cookie-notice'><p>We use cookies, which this long sentence tells you.</p></div>",
        "<div class=\"ad\">Buy this now, it is an advert with words.</div>",
        "<aside><p>About the author, who wrote many things in a life.</p></aside>",
        "<div id=sidebar><p>Archive of many posts that nobody reads any more.</p></div>",
        "<form><label>Name</label><input name=n><p>Please sign up for letters.</p></form>",
        "<script>var x = '<p>not text</p>';</script><style>p{color:red}</style>",
        "<section class='comments'><p>A reader comment as long and dense as the article.</p></section>",
        "<div role=navigation><p>One two three</p></div>", "<!-- <p>comment</p> -->",
        "<footer><p>Copyright and address of the publisher of the site.</p></footer>")
WRAPS = ("<article><h1>Title</h1>{}</article>", "<main><h1>Title</h1>{}</main>",
         "<div id='page'><div class='post'><h1>Title</h1>{}</div></div>",
         "<div><h1>Title</h1><div class='text'>{}</div></div>")


@pytest.mark.parametrize("wrap", WRAPS)
def test_article_without_what_stands_around(wrap):
    middle = len(JUNK) // 2
    page = ("<!DOCTYPE html><html><head><title>T</title></head><body>" + "".join(JUNK[:middle])
            + wrap.format(BODY) + "".join(JUNK[middle:]) + "</body></html>")
    assert main_text(page) == "Title\n" + TEXT


@pytest.mark.parametrize("part", JUNK)
def test_each_part_goes_also_inside_the_article(part):
    if not part.startswith("<header"):
        assert main_text(f"<body><article>{BODY}{part}</article></body>") == TEXT


@pytest.mark.parametrize(("page", "text"), [
    ("", ""), ("plain words", "plain words"), ("<p>open <b>bold<p>next</b> one", "open bold\nnext one"),
    ("<ul><li>a<li>b</ul>", "a\nb"), ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"),
    ("<p>a < b &lt;c&gt; &#233;&eacute;&nbsp;&copy x</p>", "a < b <c> éé © x"),
    ("<div><p>x</div></div></p>y", "x\ny"), ("<script>never closed <p>text", ""),
    ("<p title='a > b'>quoted</p>", "quoted"), ("<p>cut off <a href='", "cut off <a href='"),
    ("<p hidden>no</p><p>yes</p>", "yes"),
])
def test_broken_and_small_pages(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(("page", "text"), [
    ("<article><svg class='x'/><p>one</p><p>two</p></article>", "one\ntwo"),
    ("<article><h1>T</h1><iframe src='x' /><p>one</p></article>", "T\none"),
    ("<div><script src='x'/><p>one</p><script>code</script><p>two</p></div>", "one\ntwo"),
    ("<div><script src='x'/>code</script><p>one</p></div>", "one"),
    ("<p>see <select><option>a</select> rest</p>", "see rest"),
    ("<p>see <label><b>a</label> rest</p>", "see rest"),
    ("<article><p class='share'>The share of it.</p><p id='notice'>Note it.</p></article>",
     "The share of it.\nNote it."),
    ("<article><p>Text of it.</p><p class='share'><a href=x>This</a> <a href=y>That</a></p>"
     "<p class=ad>Buy it.</p></article>", "Text of it."),
    ("<body><nav>Home About</nav><footer>Copyright</footer></body>", ""),
    ("<form>Name <input></form>", ""),
    ("<form id=aspnet><nav>Home</nav><div><p>one two</p></div><footer>c</footer></form>", "one two"),
    ("<p><b>bold<div>in</b>side</div></p>after", "bold\ninside\nafter"),
])
def test_markup_that_once_gave_a_wrong_text(page, text):
    assert main_text(page) == text


def test_articles_of_other_stories_stay_out():
    page = ("<main><article><h1>Story</h1>{0}{0}</article>"
            "<article><h2><a href=x>Other story</a></h2>{0}</article>"
            "<div><article><h2>Third</h2><p>In short.</p></article></div></main>")
    assert main_text(page.format(f"<p>{LINE}</p>")) == f"Story\n{LINE}\n{LINE}"
    listed = "<main>" + "<article><h2><a href=x>A story</a></h2><p>{0}</p></article>" * 3 + "</main>"
    assert main_text(listed.format(LINE)) == "\n".join(["A story", LINE] * 3)


def test_time_grows_with_the_page_and_not_with_its_depth_squared():
    deep = "<div><b>" * 100_000 + "deep"
    start = time.process_time()
    assert main_text(deep) == "deep"
    assert time.process_time() - start < 30


def plain_densities(page):
    """Composite text density from its formula, node by node, over a tree of another parser."""
    root = ElementTree.fromstring(f"<html>{page}</html>")
    nodes = list(root.iter())

    def measure(node):
        inner = [x for x in node.iter() if x is not node]
        links = [x for x in node.iter() if x.tag == "a"]
        chars = sum(len(t.strip()) for x in node.iter()
                    for t in ([x.text] + [y.tail for y in x]) if t)
        return (chars, max(len(inner), 1), sum(measure_chars(x) for x in links), len(links))

    def measure_chars(node):
        return len("".join(t.strip() for t in node.itertext()))

    all_chars, _, all_links, _ = measure(root)
    density, sums = [], []
    for node in nodes:
        c, t, lc, lt = measure(node)
        value = 0.0
        if c:
            base = math.log(c / max(c - lc, 1) * lc + all_links / all_chars * c + math.e) + 1
            value = c / t * math.log(
                max(c / max(lc, 1) * t / max(lt, 1), 1) + 1) / math.log(base)
        density.append(value)
    for node in nodes:
        sums.append(sum(density[nodes.index(x)] for x in node))
    return density, sums


@pytest.mark.parametrize("seed", range(30))
def test_densities_equal_the_formula_on_pages_without_articles(seed):
    random = Random(seed)

    def part(depth):
        if depth == 0 or random.random() < 0.3:
            words = " ".join(random.choices(["one", "second", "third"], k=random.randint(1, 30)))
            link = "<a>linked</a>" if random.random() < 0.4 else ""
            return f"<p>{words}{link}</p>"
        return "<div>" + "".join(part(depth - 1) for _ in range(random.randint(1, 4))) + "</div>"

    source = "".join(part(3) for _ in range(3))
    page = Page(source)
    content = page.content_nodes()
    counts = Counts(page, content)
    found = densities(page, content, counts)
    want, sums = plain_densities(source)
    assert found == pytest.approx(want)
    # The node of the largest sum is part of the text, and the text is not more than the page.
    best = max(range(len(sums)), key=lambda n: (sums[n], want[n]))
    inner = "".join(list(ElementTree.fromstring(f"<html>{source}</html>").iter())[best].itertext())
    assert inner.replace(" ", "") in main_text(source).replace("\n", "").replace(" ", "")


def test_deep_and_long_pages():
    assert main_text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    many = "".join(f"<p>paragraph {i} of a long page</p>" for i in range(20000))
    assert main_text(f"<article>{many}</article>").count("\n") == 19999


LONG = "<p>" + "A sentence of the text that goes on for a while. " * 4 + "</p>"
LINE = ("A sentence of the text that goes on for a while. " * 4).strip()


@pytest.mark.parametrize(("page", "text"), [
    # Sections without an article around them.
    (f"<div><section>{LONG * 5}</section><section>{LONG}</section></div>", [LINE] * 6),
    (f"<div><div>{LONG}</div><div>{LONG * 5}</div><div>{LONG}</div></div>", [LINE] * 7),
    (f"<div><div><section>{LONG * 5}</section></div><div><section>{LONG}</section></div></div>",
     [LINE] * 6),
    (f"<div><section>{LONG * 5}</section><h2>Results</h2><div>Brief.</div><section>{LONG}</section>"
     "<p>The end.</p></div>", [*[LINE] * 5, "Results", "Brief.", LINE, "The end."]),
    (f"<main><section>{LONG * 5}</section><section><h2>End</h2><p>Brief.</p></section></main>",
     [*[LINE] * 5, "End", "Brief."]),
    # What comes after the best block.
    (f"<div><h1>T</h1><div>{LONG * 5}</div><h2>Sizes</h2><ul><li>One</ul><table><tr><td>1"
     "<td>2</table><p>Done.</p></div>", ["T", *[LINE] * 5, "Sizes", "One", "1", "2", "Done."]),
    # Several articles.
    (f"<main><article>{LONG * 5}</article><article>{LONG}</article></main>", [LINE] * 6),
    (f"<main><h1>T</h1><div><article>{LONG}</article></div><div><article>{LONG * 5}</article></div>"
     "</main>", ["T", *[LINE] * 6]),
    # Links and small parts around stay out.
    (f"<div><div>{LONG * 5}</div><div><a>One</a> <a>Two</a></div></div>"
     "<div><p>Of the site.</p></div>", [LINE] * 5),
])
def test_text_in_several_parts(page, text):
    assert main_text(f"<body>{page}</body>") == "\n".join(text)


@pytest.mark.parametrize("tag", [
    "section title='The hidden valley'", "article aria-label='A hidden cost'", "div data-hidden=1",
    "div class='post comments-open'", "div class='layout has-sidebar'", "div id='share-prices'",
    "div class=notice-period", "div class=search-result", "div class=sidebar", "article class=ad",
    "main class=menu"])
def test_names_do_not_hide_the_text(tag):
    name = tag.split()[0]
    assert main_text(f"<body><{tag}>{LONG * 3}</{name}></body>") == "\n".join([LINE] * 3)
    if "=sidebar" not in tag:
        text = f"<p>Of the site.</p><div>{LONG * 2}<{tag}>{LONG}</{name}></div>"
        assert main_text(f"<body>{text}</body>").count(LINE) == 3


def test_long_comments_and_hidden_parts_stay_out_and_names_alone_leave_no_page_empty():
    comments = f"<section class=comments-list>{LONG * 9}</section>"
    assert main_text(f"<article>{LONG}</article>{comments}") == LINE
    assert main_text(f"<article>{LONG}{comments}</article>") == LINE
    assert main_text(f"<div hidden>{LONG}</div><div HIDDEN=''>{LONG}</div><p>x</p>") == "x"
    assert main_text(f"<form>{LONG}</form>") == LINE
    both = f"<div class=menu>{LONG}</div><div class=footer>{LONG}</div>"
    assert main_text(both) == f"{LINE}\n{LINE}"
    assert main_text(f"<div style='display:none'>{LONG}</div>") == ""


def plain(page):
    """The article of the given pages, which all have one layout."""
    inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
    blocks = (html.unescape(re.sub(r"<[^<>]*>", " ", b)) for b in re.split(r"</?(?:p|h1)>", inner))
    return "\n".join(b for b in (" ".join(b.split()) for b in blocks) if b)


def test_all_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = extract(pages).join(pages, "page_id").collect()
    assert len(rows) == pages.count()
    assert all(r["main_text"] == plain(r["html"]) for r in rows)


def test_nulls_repeats_odd_columns_and_empty_tables(spark):
    pages = spark.createDataFrame([(1, "u", None), (None, None, "<p>x</p>"), (None, None, "<p>x</p>")],
                                  "page_id LONG, url STRING, html STRING")
    odd = pages.withColumn("main_text", F.lit(3)).withColumn("tag", F.lit(4))
    rows = extract(odd).collect()
    assert sorted((r["main_text"], r["tag"]) for r in rows) == [("", 4), ("x", 4), ("x", 4)]
    assert extract(pages.where("false")).count() == 0

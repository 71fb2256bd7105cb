"""Main text of web pages by composite text density.

A page is parsed into a tree. For each node the composite density is its characters per tag,
adjusted for how much of its text stands in links. The sum of its children's densities says how
much of the main text a node holds together; the node of the largest sum is where the main content is
found. From there the page is climbed to the highest part around it that holds further content of
the same kind, and that part is taken with all its content; see ``chosen_nodes``.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from stridelog.llm.textbatch import batches

# Names of HTML elements by what they mean for a parser.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title iframe noembed noframes xmp noscript template svg".split())
HEAD = set("base link meta noscript script style template title".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol p pre section summary table tbody td tfoot th thead tr ul".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
PROSE = HEADINGS | {"p", "blockquote", "pre"}
SCOPE = set("table td th caption button object html".split())
# What an opening tag closes first, and where the search for it ends.
CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr"}),
    "th": ({"td", "th"}, {"tr"}), "option": ({"option"}, {"select"}),
}

# Elements, roles and words of a class or id that mark what is not part of the article.
NO_CONTENT = RAW | set(
    "aside button canvas dialog fieldset footer form head input label menu nav object select "
    "audio video map".split())
NO_CONTENT_ROLES = set(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation "
    "search toolbar".split())
NO_CONTENT_WORDS = set(
    "ad ads advert adverts advertisement advertisements advertising alert banner breadcrumb "
    "breadcrumbs comment comments consent cookie cookies disqus footer login menu menus modal nav "
    "navbar navigation newsletter notice notices notification pager pagination popup promo "
    "promotion recommended related replies respond search share sharing sidebar signup skip "
    "social sponsor sponsored subscribe subscription toolbar widget widgets".split())
HEADER_WORDS = set("header masthead topbar".split())
ADVERT_WORDS = set("ad ads advert adverts advertisement advertisements advertising promo promotion "
                   "sponsor sponsored".split())
# A form around one of these is the frame of a whole page; one without controls is no form.
FRAMED = set("article main nav footer".split())
CONTROLS = set("input select textarea button label".split())
# Parts of a name that say nothing of its content. A name counts by the words above only if all
# its other parts are such: "comments-list" does, "comments-open" and "share-prices" do not.
NEUTRAL_WORDS = set(
    "area articles bar block body bottom box button buttons col column container content copyright "
    "desktop facebook fb fixed form gdpr global google group holder icons inner item items left "
    "link links list main mobile next outer page panel post posts previous primary reading right "
    "row secondary section site slot small sticky stories strip text thread top twitter unit wrap "
    "wrapper".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:\"[^\"]*+\"|'[^']*+'|[^'\">])*+)>", re.S)
_ATTRIBUTE = re.compile(
    r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_WORD = re.compile(r"[a-z]{2,}")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Page:
    """A page's tree: for each node its element, parent, and children (numbers) or texts."""

    def __init__(self, source: str) -> None:
        self.tag, self.parent, self.inside = ["html"], [-1], [[]]
        self.attributes = [""]
        self._most: tuple[list[int], list[int]] | None = None
        self._counts: Counts | None = None
        # Open elements, and for each name their places there. An inline element that ends before
        # the blocks inside it stays in the stack, as ended, until it comes to the top.
        self._stack = [0]
        self._places: dict[str, list[int]] = {}
        self._ended: set[int] = set()
        self._parse(source)

    def _open(self, tag: str, attributes: str) -> None:
        top = self._stack[-1]
        node = len(self.tag)
        self.tag.append(tag)
        self.parent.append(top)
        self.attributes.append(attributes)
        self.inside.append([])
        self.inside[top].append(node)
        if tag not in VOID:
            self._places.setdefault(tag, []).append(len(self._stack))
            self._stack.append(node)

    def _innermost(self, tags: set[str]) -> int:
        """The place in the stack of the innermost open element of ``tags``; 0 if none is."""
        return max((self._places[t][-1] for t in tags if self._places.get(t)), default=0)

    def _leave(self, place: int) -> None:
        """Leave the element at a place of the stack and all that is open in it."""
        while len(self._stack) > place or self._stack[-1] in self._ended:
            node = self._stack.pop()
            if node not in self._ended:
                self._places[self.tag[node]].pop()

    def _close(self, tags: set[str], until: set[str]) -> None:
        """Leave the innermost open element of ``tags``, unless one of ``until`` is in between."""
        place = self._innermost(tags)
        if place > self._innermost(until):
            self._leave(place)

    def _end(self, tag: str) -> None:
        if tag in BLOCK or tag in NO_CONTENT or tag in SCOPE:
            self._close({tag}, set() if tag in ("table", "td", "th", "tr") else SCOPE - {tag})
            return
        place = self._innermost({tag})
        if place == len(self._stack) - 1 and place:
            self._leave(place)
        elif place > self._innermost(SCOPE):
            self._ended.add(self._stack[place])  # blocks opened since stay open
            self._places[tag].pop()

    def _parse(self, source: str) -> None:
        at, find = 0, _TAG.search
        while True:
            found = find(source, at)
            text = source[at:found.start()] if found else source[at:]
            if text:
                self.inside[self._stack[-1]].append(text)
            if not found:
                return
            at = found.end()
            if found[2] is None:
                continue
            tag = found[2].lower()
            if found[1]:
                if tag not in ("html", "body"):
                    self._end(tag)
                continue
            if tag in ("html", "body"):
                self._close({"head"}, set())
                continue
            if tag not in HEAD and tag != "head":
                self._close({"head"}, BLOCK)
            if tag in CLOSED_BY:
                self._close(*CLOSED_BY[tag])
            if tag in BLOCK:
                self._close({"p"}, SCOPE)
            self._open(tag, found[3])
            if tag in RAW:
                at = self._raw_end(source, at, tag, found[3].endswith("/"))
                self._leave(len(self._stack) - 1)

    def _raw_end(self, source: str, at: int, tag: str, closed: bool) -> int:
        """Where an element of raw text ends. One written as closed has content only if its end
        tag comes before another opening tag of its name; an svg never has."""
        if closed and tag == "svg":
            return at
        first = "/?" if closed else "/"
        end = re.compile(rf"<({first}){re.escape(tag)}\b[^>]*>?", re.I).search(source, at)
        if closed:
            return end.end() if end and end[1] else at
        return end.end() if end else len(source)

    def _majorities(self) -> tuple[list[int], list[int]]:
        """Characters below every node, without elements that are no content, and those of them
        that stand in an article or main."""
        size = len(self.tag)
        chars, in_articles = [0] * size, [0] * size
        for node in range(size - 1, -1, -1):
            chars[node] += sum(len(x.strip()) for x in self.inside[node] if isinstance(x, str))
            if self.tag[node] in ("article", "main"):
                in_articles[node] = chars[node]
            above = self.parent[node]
            if above >= 0 and self.tag[node] not in NO_CONTENT:
                chars[above] += chars[node]
                in_articles[above] += in_articles[node]
        return chars, in_articles

    def _holds_most(self, node: int) -> bool:
        """Whether a node has most of the page's text, and every article or main."""
        if self._most is None:
            self._most = self._majorities()
        chars, in_articles = self._most
        return 2 * chars[node] > chars[0] and in_articles[node] == in_articles[0]

    def _is_text(self, node: int) -> bool:
        """Whether a node has text, most of it outside links, on the page as it is."""
        if self._counts is None:
            self._counts = Counts(self, [True] * len(self.tag))
        return self._counts.is_text(node)

    def _frames(self) -> set[int]:
        """Forms around the page's parts, and forms with nothing to fill in."""
        framed = [tag in FRAMED for tag in self.tag]
        filled = [tag in CONTROLS for tag in self.tag]
        for node in range(len(self.tag) - 1, 0, -1):
            above = self.parent[node]
            framed[above] |= framed[node]
            filled[above] |= filled[node]
        return {n for n, tag in enumerate(self.tag)
                if tag == "form" and (framed[n] or not filled[n])}

    def _no_content(self, node: int, in_article: bool, names_count: bool) -> bool:
        tag = self.tag[node]
        if tag in NO_CONTENT or (tag == "header" and not in_article):
            return True
        if not self.attributes[node]:
            return False
        names: list[str] = []
        for name, *values in _ATTRIBUTE.findall(self.attributes[node]):
            name, value = name.lower(), "".join(values)
            if name in ("class", "id"):
                names.extend(value.lower().split())
            elif name == "role" and value.lower() in NO_CONTENT_ROLES:
                return True
            elif name == "style" and _HIDDEN.search(value):
                return True
            elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
                return True
        if not names_count or tag in ("article", "main"):
            return False
        marks = NO_CONTENT_WORDS if in_article else NO_CONTENT_WORDS | HEADER_WORDS
        for name in names:
            words = set(_WORD.findall(name))
            if words & marks and words <= marks | NEUTRAL_WORDS:
                if tag in PROSE and not words & ADVERT_WORDS and self._is_text(node):
                    continue
                return not self._holds_most(node)
        return False

    def content_nodes(self, names_count: bool = True) -> list[bool]:
        """Which nodes are not, and are not inside, a part that is no content.

        Such are hidden parts, and others by element, role or name. A name does not count for an
        article, for a part with most of the text, and, adverts excepted, for a paragraph or
        heading with a text of its own. A form that frames the page, or has no controls, is like a div.
        """
        frames = self._frames()
        inside_article = [False] * len(self.tag)
        out = [True] * len(self.tag)
        for node in range(1, len(self.tag)):  # parents come before their children
            above = self.parent[node]
            inside_article[node] = inside_article[above] or self.tag[above] in ("article", "main")
            out[node] = out[above] and (node in frames or not self._no_content(
                node, inside_article[node], names_count))
        return out


class Counts:
    """Characters and tags below every node, all and in links, and nodes with a text of their own;
    0 for nodes that do not count."""

    def __init__(self, page: Page, content: list[bool]) -> None:
        size = len(page.tag)
        self.chars, self.tags = chars, tags = [0] * size, [0] * size
        self.link_chars, self.link_tags = link_chars, link_tags = [0] * size, [0] * size
        self.holders = holders = [0] * size
        for node in range(size - 1, -1, -1):
            if not content[node]:
                continue
            own = sum(len(x.strip()) for x in page.inside[node] if isinstance(x, str))
            chars[node] += own
            holders[node] += own > 0
            if page.tag[node] == "a":
                link_chars[node], link_tags[node] = chars[node], tags[node] + 1
            above = page.parent[node]
            if above >= 0:
                chars[above] += chars[node]
                holders[above] += holders[node]
                tags[above] += tags[node] + 1
                link_chars[above] += link_chars[node]
                link_tags[above] += link_tags[node]

    def is_text(self, node: int) -> bool:
        """Whether a node has text, most of it outside links."""
        return 0 <= 2 * self.link_chars[node] < self.chars[node]

    def plain(self, node: int) -> float:
        """Characters outside links per node with text, whatever the size and the wrappers."""
        return (self.chars[node] - self.link_chars[node]) / max(self.holders[node], 1)


def densities(page: Page, content: list[bool], counts: Counts) -> list[float]:
    """Composite density of every node; 0 for nodes that do not count."""
    size = len(page.tag)
    share = counts.link_chars[0] / max(counts.chars[0], 1)
    out = [0.0] * size
    for node in range(size):
        c, t = counts.chars[node], max(counts.tags[node], 1)
        lc, lt = counts.link_chars[node], counts.link_tags[node]
        if content[node] and c:
            # One is added to the base, which would be 1 on a page without links.
            base = 1 + math.log(c / max(c - lc, 1) * lc + share * c + math.e)
            ratio = c / max(lc, 1) * (t / max(lt, 1))
            out[node] = c / t * math.log(max(ratio, 1.0) + 1) / math.log(base)
    return out


def _teasers(page: Page, content: list[bool], counts: Counts) -> set[int]:
    """Articles whose first heading is a link as a whole: they tell of another page."""
    article = [-1] * len(page.tag)
    seen: set[int] = set()
    out: set[int] = set()
    for node in range(1, len(page.tag)):
        above = page.parent[node]
        article[node] = node if page.tag[node] == "article" else article[above]
        if page.tag[node] in HEADINGS and content[node] and article[node] not in seen:
            seen.add(article[node])
            if counts.chars[node] and counts.link_chars[node] == counts.chars[node]:
                out.add(article[node])
    return out - {-1}


def chosen_nodes(page: Page) -> tuple[set[int], list[bool]]:
    """The nodes whose text is the main text, and which nodes count as content at all.

    Where no text is left, names are no longer heeded; a page of menus and forms alone has none.
    The way up from the best node, or from an article around it, ends at the highest node with
    another child like it: one of no less than half (a heading and a paragraph) of the least
    characters per node with text on the path, and beside an article one that holds an article
    which is no teaser (a heading that is all link), unless the best is one itself. That node is
    taken as a whole, and so is a ``main``. Only children before the first and after the last such
    one must be text by their element: headings, paragraphs, lists, tables and sections are, divs
    and lists of links are not. Articles between them that are not like it go.
    """
    for names_count in (True, False):
        content = page.content_nodes(names_count)
        counts = Counts(page, content)
        if counts.chars[0]:
            break
    density = densities(page, content, counts)
    total = [0.0] * len(page.tag)
    for node in range(1, len(page.tag)):
        total[page.parent[node]] += density[node]
    best = max(range(len(total)), key=lambda n: (total[n], density[n]))
    path = [best]
    while page.parent[path[-1]] >= 0:
        path.append(page.parent[path[-1]])
    threshold = min(density[n] for n in path)
    least = min(counts.plain(n) for n in path) / 2

    articles = [n for n in path if page.tag[n] == "article"]
    teasers = _teasers(page, content, counts)
    if articles and articles[-1] in teasers:
        teasers = set()
    any_article = [tag == "article" for tag in page.tag]
    with_article = [tag == "article" and node not in teasers
                    for node, tag in enumerate(page.tag)]
    for node in range(len(page.tag) - 1, 0, -1):
        if content[node]:
            above = page.parent[node]
            any_article[above] |= any_article[node]
            with_article[above] |= with_article[node]

    def alike(node: int) -> bool:
        if not counts.is_text(node):
            return False
        return counts.plain(node) >= least and (with_article[node] or not articles)

    def is_prose(node: int) -> bool:
        return counts.is_text(node) and page.tag[node] not in ("div", "section")

    way = path[path.index(articles[-1]):] if articles else path
    top, alone = 0, True
    for i, above in enumerate(way[1:], 1):
        others = [x for x in page.inside[above]
                  if (x.strip() if isinstance(x, str)
                      else x != way[i - 1] and content[x] and counts.chars[x])]
        parts = [x for x in others if isinstance(x, int)]
        if any(map(alike, parts)):
            top = i
        elif not articles and (page.tag[above] == "main" or alone and (
                len(parts) < len(others) or any(map(is_prose, parts)))):
            top = i
        alone = alone and not others
    for i in range(1, top + 1):
        parts = [x for x in page.inside[way[i]] if isinstance(x, int) and content[x]]
        places = [j for j, x in enumerate(parts) if x == way[i - 1] or alike(x)]
        for j, x in enumerate(parts):
            if places[0] <= j <= places[-1]:
                content[x] = j in places or not any_article[x]
            else:
                content[x] = (page.tag[x] in HEADINGS if articles else
                              is_prose(x) or page.tag[x] == "section" and counts.is_text(x))
    chosen = {way[top]}
    if articles:
        return chosen, content
    previous = way[top]
    for above in way[top + 1:]:
        before = True
        for x in page.inside[above]:
            if x == previous and not isinstance(x, str):
                before = False
            elif isinstance(x, int) and content[x]:
                heading = before and page.tag[x] in HEADINGS
                if heading or (density[x] >= threshold and density[x] > 0):
                    chosen.add(x)
        previous = above
    return chosen, content


def main_text(source: str) -> str:
    """The main text of a page: its blocks in order, one line each."""
    page = Page(source)
    chosen, content = chosen_nodes(page)
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = " ".join("".join(line).split())
        if text:
            blocks.append(text)
        line.clear()

    # Depth first without recursion; a negative number marks the end of a block.
    todo: list[tuple[int | str, bool]] = [(0, False)]
    while todo:
        item, taken = todo.pop()
        if isinstance(item, str):
            if taken:
                line.append(html.unescape(item) if "&" in item else item)
            continue
        if item < 0:
            flush()
            continue
        if not content[item]:
            continue
        taken = taken or item in chosen
        if page.tag[item] == "br":
            line.append(" ")
            continue
        if page.tag[item] in BLOCK:
            flush()
            todo.append((-1, taken))
        todo.extend((x, taken) for x in reversed(page.inside[item]))
    flush()
    return "\n".join(blocks)


def extract(pages: DataFrame, html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` of ``pages`` (default: all but the html and that name) and ``main_text``.

    A null or empty page, or one without text, gives the empty text. Pages are handled one by
    one, whole, so repeated rows give repeated results and nulls elsewhere stay as they are.
    """
    added = (html_col, "main_text")
    kept = [c for c in pages.columns if c not in added] if keep is None else keep

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for first, end, batch in batches(part.column(0)):
                texts = [main_text(batch.text(i).decode("utf-8", "replace"))
                         for i in range(end - first)]
                yield pa.RecordBatch.from_arrays(
                    [c.slice(first, end - first) for c in part.columns[1:]]
                    + [pa.array(texts, pa.string())], names=[*kept, "main_text"])

    plain = pages.select(html_col, *kept)
    return plain.mapInArrow(run, plain.drop(html_col).schema.add("main_text", "string"))

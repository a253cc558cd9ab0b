"""Main text of web pages: hosts agree on the container that holds it."""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ident, staged, unident

#: Elements by their part in a page.
BLOCKS = {
    "p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "td", "th", "caption", "figcaption", "pre", "blockquote", "address", "summary",
    "div", "section", "article", "main", "body", "ul", "ol", "dl", "table", "tr", "tbody", "thead", "tfoot", "figure", "details", "center",
    "nav", "header", "footer", "aside", "form", "fieldset", "menu", "dialog", "html",
}
CONTAINERS = {"div", "section", "article", "main", "body", "td", "blockquote", "center", "details", "ul", "ol", "dl", "table", "figure"}
AWAY = {"nav", "header", "footer", "aside", "form", "fieldset", "menu", "dialog", "button", "select", "label", "option", "head", "noscript", "template", "svg", "iframe", "object"}
RAW = {"script", "style", "textarea", "title", "xmp", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr", "param"}
#: What a start tag closes: paragraphs end at any block, items and cells at the next one.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}}
_WORDS_AWAY = (
    r"ad|ads|advert\w*|banner|breadcrumb\w*|comments?|respond|reply|replies|cookie\w*|consent|copyright|footer|header|masthead|menu|modal|nav\w*"
    r"|newsletter|notice|pager|pagination|popup|promo\w*|related|recommend\w*|share|sharing|sidebar|social|sponsor\w*|subscribe|toolbar|widget"
)
HINTS_AWAY = re.compile(rf"(?:^|[-_])(?:{_WORDS_AWAY})(?:$|[-_])")
#: A name of such words alone, numbers, and words for a place in a page. Inside an article only these count by themselves.
HINTS_WHOLE = re.compile(rf"(?:(?:{_WORDS_AWAY}|\d+|area|articles|bar|block|box|buttons|container|form|icons|inner|items|left|links|list|posts|right|site|slot|top|unit|wrap|wrapper)(?:[-_]+|$))+")
#: The head of an article or of a part of it.
HINTS_HEAD = re.compile(r"(?:article|chapter|entry|post|section|story)[-_]header$")
#: Elements whose names count; those of headings, paragraphs, items and cells say how they look.
NAMED = CONTAINERS - {"article", "main", "body", "td", "blockquote"} | {"tr", "tbody", "span"}
#: Words that begin the name of a page's layout ("with-sidebar", "no-menu"), which says nothing about the element itself;
#: and names of what readers add, which may be longer than the article.
LAYOUT = re.compile(r"(?:with|without|no|not|has|have|hide|show|is|wide|fixed|sticky|full)[-_]")
HINTS_READERS = re.compile(r"(?:^|[-_])(?:comments?|respond|reply|replies)(?:$|[-_])")
HINTS_MAIN = re.compile(r"(?:^|[-_ ])(?:article|body|content|entry|main|page|post|story|text)(?:$|[-_ ])")
#: Names of what holds an article whole, other than those that are common on wrappers of a page.
HINTS_ARTICLE = re.compile(r"(?:^| )(?:article|entry|post|story)(?:$|[-_ ])")

_OPEN = re.compile(r"<(?:(?P<comment>!--)|(?P<data>!\[CDATA\[)|(?P<other>[!?])|/?(?P<tag>[a-zA-Z][^\s/>]*))")
#: From a tag's name to its end. Quotes count after '=' only, and one that is never closed is a character like others.
_ATTRIBUTES = re.compile(r"((?:[^>=]|=\s*+(?:\"[^\"]*\"|'[^']*')?)*+)>")
_CLASS = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_RAW_END = {tag: re.compile(rf"</{tag}(?![^\s/>])", re.I) for tag in RAW}
_DIGITS = re.compile(r"\d+")
_HEADING = frozenset(f"h{k}" for k in range(1, 7))


class Element:
    """A block element: its place in the page's tree of paths, and what its tag and names say of it."""

    __slots__ = ("tag", "path", "parent", "away", "cut", "main", "article", "titled", "hinted", "doubtful", "readers", "holder", "heads", "inside")

    def __init__(self, tag: str, names: str, parent: "Element | None", path: int):
        self.tag, self.parent, self.path, self.titled = tag, parent, path, False
        low = names.lower()
        hints = [n for n in low.split() if HINTS_AWAY.search(n) and not LAYOUT.match(n) and not HINTS_HEAD.match(n)] if names and tag in NAMED else []
        # Inside an article a name such as "share-price" only counts if links make up most of the text.
        self.inside = bool(parent and (parent.inside or parent.article or parent.tag in ("article", "main")))
        self.doubtful = bool(hints) and self.inside and not any(HINTS_WHOLE.fullmatch(n) for n in hints)
        self.hinted, self.readers = bool(hints) and not self.doubtful, any(HINTS_READERS.search(n) for n in hints)
        self.cut = bool(parent and parent.cut) or tag in AWAY
        self.away = bool(parent and parent.away) or tag in AWAY or self.hinted
        self.main = tag in ("article", "main") or bool(names and HINTS_MAIN.search(low))
        self.article = bool(names and HINTS_ARTICLE.search(low))
        # The container that holds the text of this element, and whether a main heading lies between.
        if parent is None or tag in CONTAINERS or self.away:
            self.holder, self.heads = self, False
        else:
            self.holder, self.heads = parent.holder, parent.heads or tag in ("h1", "h2")


def _step(tag: str, names: str) -> str:
    """A tag with its classes and identifiers in order, digits generalised."""
    kept = ".".join(sorted({_DIGITS.sub("#", n).replace("/", "|") for n in names.split()}))
    return f"{tag}.{kept}" if kept else tag


class Page:
    """A page's text blocks in order (text, characters of it inside links, the container that holds it), its elements with
    parents first, and its paths as numbers: ``paths`` has (number of the path above, step) to number.

    One pass over the page, in time proportional to its length whatever its markup. Character references are decoded,
    white space becomes one space. Missing and crossing end tags are tolerated; a tag that is cut off ends the page.
    """

    def __init__(self, page: str):
        root = Element("html", "", None, 0)
        self.blocks: list[tuple[str, int, Element]] = []
        self.elements, self.paths, self.steps = [root], {}, [(-1, "html")]
        stack, text, linked, at, link = [root], [], 0, 0, 0
        opened: dict[str, int] = {}

        def flush() -> None:
            nonlocal text, linked
            if text:
                joined = " ".join(html.unescape("".join(text)).split())
                if joined:
                    holder = stack[-1].holder
                    holder.titled = holder.titled or stack[-1].heads
                    self.blocks.append((joined, linked, holder))
            text, linked = [], 0

        def add(piece: str) -> None:
            nonlocal linked
            if piece:
                text.append(piece)
                if link:
                    linked += len(piece)

        def pop() -> None:
            opened[stack.pop().tag] -= 1

        def after(mark: str, start: int) -> int:
            end = page.find(mark, start)
            return size if end < 0 else end + len(mark)

        size = len(page)
        while at < size:
            found = _OPEN.search(page, at)
            if not found:
                add(page[at:])
                break
            add(page[at : found.start()])
            at = found.end()
            if not found["tag"]:
                at = after("-->", at - 2) if found["comment"] else after("]]>" if found["data"] else ">", at)
                continue
            rest = _ATTRIBUTES.match(page, at)
            if not rest:
                break
            at = rest.end()
            tag, closing = found["tag"].lower(), page[found.start() + 1] == "/"
            if closing:
                if tag == "a":
                    link = max(0, link - 1)
                if tag in BLOCKS or tag in AWAY:
                    if opened.get(tag):
                        flush()
                        while stack[-1].tag != tag:
                            pop()
                        pop()
                    elif tag == "p":
                        flush()
            elif tag in RAW:
                end = _RAW_END[tag].search(page, at)
                at = after(">", end.end()) if end else size
            elif tag == "a":
                link += 1
            elif tag == "br":
                text.append(" ")
            elif tag == "hr":
                flush()
            elif (tag in BLOCKS or tag in AWAY) and tag not in VOID:
                flush()
                link = 0
                if tag == "html":
                    continue
                closed = ENDS.get(tag, set()) | ({"p"} if tag in BLOCKS else set())
                while stack[-1].tag in closed or (tag in _HEADING and stack[-1].tag in _HEADING):
                    pop()
                names = " ".join(m[2] or m[3] or m[4] or "" for m in _CLASS.finditer(rest[1])) if rest[1].strip() else ""
                place = (stack[-1].path, _step(tag, names))
                number = self.paths.setdefault(place, len(self.steps))
                if number == len(self.steps):
                    self.steps.append(place)
                stack.append(Element(tag, names, stack[-1], number))
                opened[tag] = opened.get(tag, 0) + 1
                self.elements.append(stack[-1])
        flush()
        if any(x.doubtful for x in self.elements):
            self._decide()
        if any(x.hinted for x in self.elements):
            self._reconsider()

    def up(self, own: dict[Element, float], share=lambda at: 1.0) -> dict[Element, float]:
        """Sums over what lies inside each element; an element passes on ``share`` of its sum."""
        out = dict(own)
        for at in reversed(self.elements):
            if at.parent is not None and out.get(at):
                out[at.parent] = out.get(at.parent, 0) + share(at) * out[at]
        return out

    def worth(self, counts) -> dict[Element, int]:
        """Characters without links that each container holds itself, in those of which ``counts`` is true."""
        out: dict[Element, int] = {}
        for text, linked, holder in self.blocks:
            w = len(text) - min(len(text), 2 * linked)
            if w > 0 and counts(holder):
                out[holder] = out.get(holder, 0) + w
        return out

    def _decide(self) -> None:
        """Doubtful names count where at least half of the text inside is links."""
        lengths, links = {}, {}
        for text, linked, holder in self.blocks:
            lengths[holder] = lengths.get(holder, 0) + len(text)
            links[holder] = links.get(holder, 0) + min(linked, len(text))
        lengths, links = self.up(lengths), self.up(links)
        for at in self.elements:
            at.hinted = at.hinted or (at.doubtful and 2 * links.get(at, 0) >= lengths.get(at, 0) > 0)
            at.away = bool(at.parent and at.parent.away) or at.tag in AWAY or at.hinted

    def _reconsider(self) -> None:
        """Take back hints of names that can't be right: on an element, other than of readers' texts, with most of a page's
        text without links; around the largest article or main element, if it has more text than all that is not away; and
        all of them, if they leave nothing. Elements away by their tag stay away."""
        own = self.worth(lambda at: not at.cut)
        total, kept = sum(own.values()), sum(w for at, w in own.items() if not at.away)
        inside = self.up(own)
        wrong = {at for at in self.elements if at.hinted and not at.readers and 2 * inside.get(at, 0) > total}
        whole = max((at for at in self.elements if at.tag in ("article", "main") and inside.get(at)), key=lambda at: inside[at], default=None)
        if whole is not None and whole.away and inside[whole] > kept:
            at = whole
            while at is not None:
                wrong |= {at} if at.hinted else set()
                at = at.parent
        for taken_back in (wrong, None):
            for at in self.elements:
                at.hinted = at.hinted and taken_back is not None and at not in taken_back
                at.away = bool(at.parent and at.parent.away) or at.tag in AWAY or at.hinted
            if not total or self.worth(lambda at: not at.away):
                break

    def name(self, number: int) -> str:
        """A path as text."""
        steps = []
        while number >= 0:
            number, step = self.steps[number]
            steps.append(step)
        return "/".join(reversed(steps))

    def number(self, name: str) -> int | None:
        """A path's number, None if the page doesn't have it."""
        number: int | None = 0
        for step in name.split("/")[1:]:
            number = self.paths.get((number, step))
            if number is None:
                break
        return number


def best_path(page: Page) -> str | None:
    """The path of the containers that score most: their own text without links, and half of what lies in containers inside.

    Text away from the main part (menus, headers, forms, adverts, comments) counts for nothing. Of equal scores the shorter
    path wins, then the one with the least checksum; lengths and checksums are carried from the path above, so that only
    the best path is written out.
    """
    sums = page.up(page.worth(lambda at: not at.away), lambda at: 0.5 if at.tag in CONTAINERS else 1.0)
    scores: dict[int, float] = {}
    for at in page.elements:
        if at.tag in CONTAINERS and sums.get(at):
            scores[at.path] = scores.get(at.path, 0.0) + sums[at] * (1.5 if at.main else 1.0)
    if not scores:
        return None
    length, check = [len(page.steps[0][1])], [zlib.crc32(page.steps[0][1].encode(errors="replace"))]
    for above, step in page.steps[1:]:
        length.append(length[above] + 1 + len(step))
        check.append(zlib.crc32(b"/" + step.encode(errors="replace"), check[above]))
    return page.name(min(scores, key=lambda number: (-scores[number], length[number], check[number])))


def _outermost(page: Page, direct: set[Element]) -> dict[Element, Element]:
    """For each element the highest container around it that the article takes up, else itself: an article or main element,
    one whose names say that it holds the article, one with text of its own beside the containers in it, or a body with a
    heading of its own.
    """
    highest: dict[Element, Element | None] = {}
    out = {}
    for at in page.elements:
        above = highest[at.parent] if at.parent is not None else None
        out[at] = above or at
        if at.tag in ("body", "html"):
            belongs = at.titled and at in direct
        else:
            belongs = at.tag in ("article", "main") or at.article or (at in direct and at.tag in CONTAINERS)
        highest[at] = above or (at if belongs else None)
    return out


def main_text(source: str, winners: list[str]) -> tuple[str, str]:
    """The text of the first winning path that the page has, else of its own best one; and the path of what it came from.

    What is taken is the outermost container of the article around that path, so that a title, a lead or a section beside
    a nested container stays.
    """
    page = Page(source)
    own = [x for x in page.blocks if not x[2].away]
    holds = page.up({holder: 1 for _, _, holder in own})
    best = best_path(page)
    for path in [*winners, *([best] if best else [])]:
        number = page.number(path)
        places = [at for at in page.elements if at.path == number and holds.get(at)] if number is not None else []
        if places:
            outer = _outermost(page, {holder for text, linked, holder in own if len(text) > 2 * linked})
            whole, inside = {outer[at] for at in places}, {}
            for at in page.elements:
                inside[at] = at if at in whole else inside.get(at.parent)
            taken = [(text, inside[holder]) for text, _, holder in own if inside[holder] is not None]
            return "\n".join(text for text, _ in taken), page.name(taken[0][1].path)
    return "\n".join(text for text, _, _ in own), ""


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_share: float = 0.02) -> DataFrame:
    """The main text of each page: identifier, url, ``text``, ``path`` (of the container it came from).

    Each page's containers are scored and its best one is a vote for its path of tags and classes, with digits
    generalised. Names that speak of menus and the like count on containers only, and inside an article only where they
    consist of such words or most of the text is links. Votes are counted by host with partial sums; paths with ``least_share`` of a host's votes win, most votes
    first, equal ones in the order of their paths. Each page is then read again by its host's winning paths, and by its own best path if it has none of them, each
    with what its article holds beside them (see ``main_text``).

    Null html is empty and gives an empty text; a page without host has the host ''. One row out for each row in,
    repeated ones too; an empty table gives an empty result; other columns are ignored. What is joined to pages is one row
    a host with at most 1 / ``least_share`` paths.
    """
    rows = pages.select(
        ident(id_col).alias("nid"), F.col(url_col).alias("url"),
        F.lower(F.coalesce(F.regexp_extract(F.col(url_col), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit(""))).alias("host"),
        F.coalesce(F.col(html_col), F.lit("")).alias("page"),
    )

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = [best_path(Page(page.as_py())) for page in batch.column(1)]
            hosts = [h for h, b in zip(batch.column(0).to_pylist(), best) if b]
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array([b for b in best if b], pa.string())], names=["host", "path"])

    votes = rows.select("host", "page").mapInArrow(vote, "host string, path string").groupBy("host", "path").agg(F.count("*").alias("n"))
    totals = votes.groupBy("host").agg(F.sum("n").alias("total"))
    won = votes.join(totals, "host").filter(F.col("n") >= least_share * F.col("total"))
    won = won.groupBy("host").agg(F.transform(F.array_sort(F.collect_list(F.struct(F.negative("n").alias("n"), "path"))), lambda x: x.path).alias("paths"))
    won = staged(won, "paths")  # its size is known then: pages are shuffled only if hosts are very many

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [main_text(page.as_py(), paths or []) for page, paths in zip(batch.column(2), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1).cast(pa.string()), pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.string())],
                names=["nid", "url", "text", "path"],
            )

    texts = rows.join(won, "host", "left").select("nid", "url", "page", "paths").mapInArrow(read, "nid long, url string, text string, path string")
    return texts.select(unident("nid").alias(id_col), F.col("url").alias(url_col), "text", "path")


def op8_html_extraction(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extract_main_text(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))

"""Main text of web pages by consensus of each host's pages.

Every page is read once to score its containers: each is worth the text in it outside links and
outside boilerplate, less for every level in between. A page's best container votes for its
generalised path (tags and classes from the root down, digits left out). Votes are summed per host
and path in Spark; the path with most votes wins. On the second reading the elements at the
winning path give the page's text; a page without such an element uses its own best container.

Pages are read in time and memory in proportion to their length, however broken they are: tags are
scanned by hand, an element knows its parent and a digest of its path, and what was searched in
vain once is not searched again.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywright.llm.text_units import spare_name
from tallywright.session import materialize

#: Worth of a container's text one level further up, and the worth of semantic containers.
DECAY, SEMANTIC = 0.6, 1.5
#: Parts that the pages of a host are dealt into where they meet its winning path.
SALTS = 16

# HTML element names by what they mean for text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noframes template svg math select object".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr img ruby rt rp".split()
)
DROPPED = frozenset("nav footer aside form button dialog menu head".split())
MAIN = frozenset("article main".split())
#: Elements that end an open paragraph.
PARAGRAPH = "p"
# Words in class names and ids that mark boilerplate.
BOILERPLATE = frozenset(
    "ad ads adv advert adverts advertisement advertisements adsense adbox banner breadcrumb breadcrumbs byads "
    "comment comments consent cookie cookies copyright discussion disqus footer form gdpr login masthead menu modal "
    "nav navbar navigation newsletter notice notices notification overlay pager pagination popup promo promotion "
    "recommended related replies reply respond search share sharing sidebar signup skip social sponsor sponsored "
    "subscribe toolbar topbar widget widgets".split()
)
HEADERS = frozenset("header head topnav".split())
OF_SITE = frozenset("site page global top".split())
OF_ARTICLE = frozenset("article post entry story content main".split())
WRAPPERS = frozenset("has with no is without".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())

OPENING = re.compile(r"<(?=[a-zA-Z/!?])")
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
TAG_MARK = re.compile("[>\"']")
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
# Attributes that tell boilerplate.
TELLING = frozenset("class id role hidden style aria-hidden".split())
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


class Element(NamedTuple):
    """An element: a digest of its path, its parent's number (-1 for none), whether it is boilerplate."""

    tag: str
    path: str
    parent: int
    dropped: bool
    main: bool


class Block(NamedTuple):
    """A run of text between block boundaries: its innermost element, and how much of it is links."""

    text: str
    owner: int
    linked: int


class Scanner:
    """Finds the ends of tags and elements of a page; a search that failed once is not done again."""

    def __init__(self, source: str) -> None:
        self.source = source
        self.last_gt = source.rfind(">")
        self.last_quote = {q: source.rfind(q) for q in "\"'"}
        self.failed: set[int] = set()
        self.unclosed: set[str] = set()

    def tag_end(self, start: int) -> int:
        """Place after the tag that begins before ``start``, -1 if it has no end.

        Quoted values may hold ``>``; a tag with an unclosed quote ends at its first ``>``.
        """
        at, seen = start, []
        while at <= self.last_gt and at not in self.failed:
            seen.append(at)
            mark = TAG_MARK.search(self.source, at)
            if mark[0] == ">":
                return mark.end()
            if mark.start() >= self.last_quote[mark[0]]:
                break
            at = self.source.index(mark[0], mark.end()) + 1
        # whatever starts at one of these places ends here too
        self.failed.update(seen)
        return self.source.find(">", start) + 1 or -1

    def element_end(self, tag: str, start: int, else_end: bool) -> int:
        """Place after the end tag of an element; without one the end of the page, or -1."""
        if tag not in self.unclosed:
            found = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.IGNORECASE).search(self.source, start)
            if found and found.end() <= self.last_gt:
                return self.source.index(">", found.end()) + 1
            self.unclosed.add(tag)
        return len(self.source) if else_end else -1


def attributes(text: str) -> dict[str, str]:
    """The telling attributes of a tag; the first of equal names counts."""
    found: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(text):
        if m[1].lower() in TELLING:
            found.setdefault(m[1].lower(), html.unescape((m[2] or "").strip("\"'")))
    return found


def is_boilerplate(tag: str, attrs: dict[str, str], in_main: bool) -> bool:
    """True for an element whose name, role, visibility, class or id marks it as no article text."""
    if tag in DROPPED or (tag == "header" and not in_main):
        return True
    if tag in ("html", "body") or not attrs:
        return False
    style = attrs.get("style", "").replace(" ", "").lower()
    if "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or "display:none" in style:
        return True
    if attrs.get("role", "").lower() in ROLES:
        return True
    if tag in MAIN and "comment" not in attrs.get("class", "").lower():
        return False
    for name in f"{attrs.get('class', '')} {attrs.get('id', '')}".split():
        parts = [p.lower() for p in PART.findall(name)]
        if not parts or parts[0] in WRAPPERS:
            continue
        if BOILERPLATE.intersection(parts):
            return True
        if HEADERS.intersection(parts) and OF_SITE.intersection(parts):
            return True
        if HEADERS.intersection(parts) and not OF_ARTICLE.intersection(parts) and not in_main:
            return True
    return False


def step_of(tag: str, attrs: dict[str, str]) -> str:
    classes = sorted({re.sub(r"\d+", "#", c) for c in attrs.get("class", "").split()})
    return ".".join([tag, *classes])


def read_page(source: str) -> tuple[list[Element], list[Block]]:
    """The containers and the kept text blocks of a page, in page order; tag soup is allowed."""
    scan = Scanner(source)
    elements: list[Element] = []
    stack: list[int] = []
    open_tags: Counter[str] = Counter()
    blocks: list[Block] = []
    run: list[str] = []
    linked = links = 0
    at, size = 0, len(source)

    def close_block() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(run)).split())
        run.clear()
        if text:
            blocks.append(Block(text, stack[-1] if stack else -1, min(linked, len(text))))
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text and not (stack and elements[stack[-1]].dropped):
            run.append(text)
            if links:
                linked += len(text)

    def pop() -> None:
        open_tags[elements[stack.pop()].tag] -= 1

    while at < size:
        found = OPENING.search(source, at)
        if not found:
            add(source[at:])
            break
        add(source[at : found.start()])
        begin = found.end()
        if source[begin] in "!?":
            for opening, closing in (("!--", "-->"), ("![CDATA[", "]]>"), ("", ">")):
                if source.startswith(opening, begin):
                    end = source.find(closing, begin + len(opening))
                    at = end + len(closing) if end >= 0 else size
                    break
            continue
        ending = source[begin] == "/"
        name = NAME.match(source, begin + ending)
        if not name:  # an end tag without a name
            add("<")
            at = begin
            continue
        end = scan.tag_end(name.end())
        if end < 0:  # the page ends inside a tag
            break
        tag, rest, at = name[0].lower(), source[name.end() : end - 1], end
        if ending:
            if tag == "a":
                links = max(0, links - 1)
            elif tag not in INLINE:
                close_block()
                if open_tags[tag]:
                    while elements[stack[-1]].tag != tag:
                        pop()
                    pop()
            continue
        if tag in RAW:
            at = scan.element_end(tag, at, else_end=True)
            continue
        attrs = attributes(rest) if rest else {}
        if tag in INLINE:
            if tag == "a":
                links += 1
            if attrs and tag not in VOID and is_boilerplate(tag, attrs, True):
                closing = scan.element_end(tag, at, else_end=False)
                if closing >= 0:
                    at = closing
                    links -= tag == "a"
            continue
        close_block()
        if tag in VOID or rest.endswith("/") and tag not in ("p", "div"):
            continue
        upper = elements[stack[-1]] if stack else None
        if upper and (upper.tag == PARAGRAPH or (tag in ("li", "td", "th", "tr", "dd", "dt", "option") and upper.tag == tag)):
            pop()
            upper = elements[stack[-1]] if stack else None
        main = bool(upper and upper.main)
        elements.append(
            Element(
                tag,
                xxhash.xxh128_hexdigest(f"{upper.path if upper else ''}>{step_of(tag, attrs)}"),
                stack[-1] if stack else -1,
                bool(upper and upper.dropped) or is_boilerplate(tag, attrs, main),
                main or tag in MAIN,
            )
        )
        stack.append(len(elements) - 1)
        open_tags[tag] += 1
        links = 0
    close_block()
    return elements, blocks


def container_worth(elements: list[Element], blocks: list[Block]) -> dict[int, float]:
    """Worth of each container that holds text; paragraphs and list items count for what holds them."""
    carried = [0.0] * len(elements)
    for block in blocks:
        if block.owner >= 0:
            carried[block.owner] += len(block.text) - block.linked
    worth: dict[int, float] = {}
    for n in range(len(elements) - 1, -1, -1):  # an element comes after what holds it
        tag, value = elements[n].tag, carried[n]
        if not value:
            continue
        if tag not in ("p", "li", "h1", "h2", "h3", "h4", "h5", "h6"):
            worth[n] = value * (SEMANTIC if tag in MAIN else 1.0)
            value *= DECAY
        if elements[n].parent >= 0:
            carried[elements[n].parent] += value
    return worth


def best_container(elements: list[Element], blocks: list[Block]) -> int | None:
    """The container worth most, the first of equals; none without text."""
    worth = container_worth(elements, blocks)
    return max(worth, key=lambda n: (worth[n], -n), default=None)


def text_inside(elements: list[Element], blocks: list[Block], chosen: set[int]) -> str:
    inside = [False] * len(elements)
    for n, element in enumerate(elements):
        inside[n] = n in chosen or (element.parent >= 0 and inside[element.parent])
    return " ".join(b.text for b in blocks if b.owner >= 0 and inside[b.owner])


def vote_of(source: str) -> str | None:
    """Path of the page's best container: a digest of its steps from the root down."""
    elements, blocks = read_page(source)
    best = best_container(elements, blocks)
    return None if best is None else elements[best].path


def main_text(source: str, path: str | None) -> str:
    """The text of the elements at a path, or of the page's best container if there are none."""
    elements, blocks = read_page(source)
    if path is not None:
        text = text_inside(elements, blocks, {n for n, e in enumerate(elements) if e.path == path and not e.dropped})
        if text:
            return text
    best = best_container(elements, blocks)
    return " ".join(b.text for b in blocks) if best is None else text_inside(elements, blocks, {best})


def host_of(url: Column) -> Column:
    """Lower-case host without port; null where the address has none."""
    host = F.lower(F.regexp_extract(url, HOST, 1))
    return F.when(host != "", host)


def host_paths(pages: DataFrame, url: str = "url", source: str = "html") -> DataFrame:
    """Rows (host, path): the winning path of every host. Ties go to the path that sorts first."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = [vote_of(page.as_py()) for page in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(paths, pa.string())], ["host", "path"])

    asked = pages.select(host_of(F.col(f"`{url}`")).alias("host"), F.col(f"`{source}`").cast("string").alias("page"))
    asked = asked.filter("host is not null and page is not null")
    votes = asked.mapInArrow(vote, "host string, path string").filter("path is not null")
    votes = votes.groupBy("host", "path").agg(F.count(F.lit(1)).alias("votes"))
    best = Window.partitionBy("host").orderBy(F.col("votes").desc(), "path")
    return votes.withColumn("rank", F.row_number().over(best)).filter("rank = 1").select("host", "path")


def extract_main_text(
    pages: DataFrame, url: str = "url", source: str = "html", out: str = "text"
) -> DataFrame:
    """Add the main text of every page; other columns are kept, one named like ``out`` is replaced.

    A null or empty page has the text ''. Pages whose address is null or has no host do not vote
    and use their own best container. Repeated pages vote once each. Character references are
    decoded, white space inside a block becomes one blank, blocks are joined by one blank; nothing
    is cut off. A page is one row; none is read beside another.
    """
    winners = materialize(host_paths(pages, url, source), "host-paths")
    host, path, page, salt = (spare_name(pages, stem) for stem in ("host", "path", "page", "salt"))
    kept = [F.col(f"`{c}`") for c in pages.columns if c.lower() != out.lower()]
    # pages are dealt into parts, so that one host's do not all meet its path in one task
    asked = pages.select(
        *kept,
        host_of(F.col(f"`{url}`")).alias(host),
        F.pmod(F.xxhash64(F.col(f"`{url}`")), F.lit(SALTS)).alias(salt),
        F.col(f"`{source}`").cast("string").alias(page),
    )
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
    named = winners.select(F.col("host").alias(host), F.col("path").alias(path), parts.alias(salt))
    joined = asked.join(named, [host, salt], "left").select(*kept, path, page)
    schema = joined.drop(path, page).schema.add(out, "string")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_columns
            texts = [
                main_text(text.as_py() or "", chosen)
                for chosen, text in zip(batch.column(n - 2).to_pylist(), batch.column(n - 1), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(n - 2)], pa.array(texts, pa.string())], names=schema.names
            )

    return joined.mapInArrow(extract, schema)

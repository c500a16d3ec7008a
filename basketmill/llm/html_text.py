"""Main text of web pages by two passes of block rules.

A page is cut into blocks at its block-level tags. The first pass decides what it can of each block by itself: blocks in
menus, footers, forms and the like are bad, as are those made of links; long blocks with many stop words are good. Short
blocks, and long ones without stop words, stay ambiguous. In the second pass these take the label of their nearest decided
neighbours. The stop words are of English, German, French and Spanish; where they tell no block of a page to be good, long
blocks with few links are.
"""

from __future__ import annotations

import html
import re
import string
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketmill.llm.common import ship_code, texts

# Names of HTML elements by what they do to the text.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td"
    " tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN_TAGS = frozenset("head noscript template svg math object audio video canvas select button datalist map".split())
BOILERPLATE_TAGS = frozenset("nav footer aside form dialog menu".split())
HEADING_TAGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Start tags that end an open element of these names.
CLOSED_BY = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
}
LIST_TAGS = ("ul", "ol", "dl", "table", "select")
#: Words in class, id or role that mark what is not the article.
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments complementary"
    " contentinfo cookie cookies consent disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice"
    " notices pager pagination popup promo promotion related respond search share sharing sidebar signup skip social"
    " sponsor sponsored subscribe subscription toolbar widget".split()
)
#: Words that mark what readers wrote, also on an article element of its own.
READER_WORDS = frozenset("comment comments commentlist reply replies response responses respond".split())
#: Words that mark a header as the article's own.
OWN_HEADER_WORDS = frozenset("article entry post story content".split())
MARK_BORDER = re.compile(r"[\s_-]+|(?<=[a-z])(?=[A-Z])")
STOP_WORDS = frozenset(
    # English
    "the of and to in a is that it for was on are as with be by this at from or have an which not you but his they"
    # German
    " der die und den von zu das mit sich des auf für ist im dem nicht ein eine auch es aus bei sind oder wie"
    # French
    " le la les et un une du dans que qui pour sur pas par au avec ce il est sont plus ne se en de"
    # Spanish
    " el los las y del por con para su al lo como más pero sus ha o este sí porque esta entre cuando".split()
)

SHORT = 70
LONG = 200
STOP_LOW, STOP_HIGH = 0.15, 0.25
LINKS = 0.4
#: Share of links up to which a block whose language isn't known may be good by its length.
FEW_LINKS = 0.1

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)"
    r"(?P<attributes>(?:[^>\"'=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))?|[\"'])*+)(?:>|\Z)",
    re.DOTALL,
)
MARKS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)|'([^']*)|([^\s>]+))", re.IGNORECASE)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|/|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.IGNORECASE)
EDGES = string.punctuation + "«»„“”…–—¡¿"


@dataclass
class Block:
    text: str
    linked: float
    boilerplate: bool
    article: bool
    heading: bool
    label: str = ""


@dataclass
class _Open:
    name: str
    hidden: bool
    boilerplate: bool
    article: bool


@dataclass
class _Builder:
    """Collects the text between two block borders."""

    parts: list[str] = field(default_factory=list)
    links: int = 0
    heading: bool = False

    def add(self, text: str, in_link: bool) -> None:
        self.parts.append(text)
        if in_link:
            self.links += len(text.strip())


def _is_boilerplate(name: str, attributes: str, in_article: bool) -> bool:
    if name in BOILERPLATE_TAGS or (name == "header" and not in_article):
        return True
    if name in ("html", "body", "main") or not attributes:
        return False
    marks = " ".join(next(filter(None, found), "") for found in MARKS.findall(attributes))
    words = {word.lower() for word in MARK_BORDER.split(marks)} | set(MARK_BORDER.split(marks.lower()))
    if name == "article":  # its classes also tell whether it may be commented on
        return not READER_WORDS.isdisjoint(marks.lower().split())
    if not READER_WORDS.isdisjoint(words):
        return True
    if not in_article and "header" in words and OWN_HEADER_WORDS.isdisjoint(words):
        return True
    return not BOILERPLATE_WORDS.isdisjoint(words)


def blocks_of(page: str) -> list[Block]:
    """The visible blocks of a page in order; markup that is cut off or not closed is taken as far as it goes."""
    found: list[Block] = []
    stack: list[_Open] = []
    now = _Builder()
    links = 0

    def text(raw: str) -> None:
        if raw and not (stack and stack[-1].hidden):
            now.add(html.unescape(raw) if "&" in raw else raw, links > 0)

    def border() -> None:
        nonlocal now
        joined = " ".join("".join(now.parts).split())
        if joined:
            top = stack[-1] if stack else _Open("", False, False, False)
            found.append(Block(joined, now.links / len(joined), top.boilerplate, top.article, now.heading))
        now = _Builder()

    #: Where each open element's name, and a block of any name, is on the stack.
    places: dict[str, list[int]] = {}
    blocks: list[int] = []

    def innermost(names: Iterable[str]) -> int:
        return max((places[name][-1] for name in names if places.get(name)), default=-1)

    def close(names: tuple[str, ...], until: Callable[[], int] = lambda: -1) -> None:
        """End the innermost open element of these names, unless what `until` tells the place of is inside it."""
        nonlocal links
        at = innermost(names)
        if at < 0 or until() > at:
            return
        for one in reversed(stack[at:]):
            links -= one.name == "a"
            places[one.name].pop()
            if one.name in BLOCK_TAGS:
                blocks.pop()
        del stack[at:]

    def last_block() -> int:
        return blocks[-1] if blocks else -1

    at = 0
    while tag := TOKEN.search(page, at):
        text(page[at : tag.start()])
        at = tag.end()
        name = (tag["name"] or "").lower()
        if not name:
            continue
        if name == "br":
            text(" ")
        elif tag["end"]:
            if name in BLOCK_TAGS:
                border()
            if name in BLOCK_TAGS:
                close((name,))
            else:
                close((name,), last_block)
        elif name in RAW_TAGS:
            end = re.compile(f"</{name}(?=[\\s/>]|\\Z)", re.IGNORECASE).search(page, at)
            at = end.start() if end else len(page)
        else:
            if name in BLOCK_TAGS:
                border()
                close(("p",), last_block)
                now.heading = name in HEADING_TAGS
            if name in CLOSED_BY:
                close(CLOSED_BY[name], lambda: innermost(LIST_TAGS))
            if name not in VOID_TAGS:
                top = stack[-1] if stack else _Open("", False, False, False)
                attributes = tag["attributes"]
                links += name == "a"
                places.setdefault(name, []).append(len(stack))
                if name in BLOCK_TAGS:
                    blocks.append(len(stack))
                stack.append(
                    _Open(
                        name,
                        top.hidden or name in HIDDEN_TAGS or bool(attributes and HIDDEN.search(attributes)),
                        top.boilerplate or _is_boilerplate(name, attributes, top.article),
                        top.article or name in ("article", "main"),
                    )
                )
    # A "<" that begins no tag is text; one that begins a tag has been matched to the page's end.
    text(page[at:])
    border()
    return found


def stop_density(text: str) -> float:
    words = text.lower().split()
    return sum(word in STOP_WORDS or word.strip(EDGES) in STOP_WORDS for word in words) / len(words)


def first_pass(block: Block) -> str:
    """good, bad, or "" for what its neighbours must tell."""
    if block.boilerplate:
        return "bad"
    if block.linked > LINKS:
        return "" if block.article and len(block.text) >= LONG else "bad"
    if len(block.text) < SHORT:
        return "bad" if not block.article and "©" in block.text else ""
    density = stop_density(block.text)
    if density >= (STOP_LOW if len(block.text) >= LONG else STOP_HIGH):
        return "good"
    # Text in another language, numbers and code have few stop words too.
    return ""


def by_length(blocks: list[Block]) -> None:
    """Where stop words tell no block of a page to be good, length and links do: its language is none of theirs."""
    rest = [block for block in blocks if not block.boilerplate]
    if not any(block.label == "good" for block in rest):
        for block in rest:
            # Scripts that have no spaces say more with a character.
            size = len(block.text) + sum(2 for c in block.text if c >= "\u2e80")
            if not block.label and size >= SHORT and block.linked <= FEW_LINKS:
                block.label = "good"


def second_pass(blocks: list[Block]) -> None:
    """Ambiguous blocks take the label of the nearest decided ones before and after.

    What is in marked boilerplate is no neighbour of what is not. Inside an article only neighbours there count; where they differ
    or there are none, the block belongs to it. Outside, where the neighbours differ, a heading goes with what follows and any
    other block with the nearer one, the earlier one in a tie; without neighbours it is good. Last, where articles hold more
    good text than was found good by itself elsewhere, blocks outside them are bad, but for headings right before one.
    """
    inside = [block for block in blocks if block.article and not block.boilerplate]
    outside = [block for block in blocks if not block.article and not block.boilerplate]
    elsewhere = sum(len(block.text) for block in outside if block.label == "good")
    for region in (inside, outside):
        for block, label in zip(region, _inherited(region), strict=True):
            block.label = label
    if sum(len(block.text) for block in inside if block.label == "good") > elsewhere:
        leads = False  # whether the next block that is not a heading is in an article
        for block in reversed([block for block in blocks if not block.boilerplate]):
            leads = block.article or (leads and block.heading)
            if not leads:
                block.label = "bad"


def _inherited(region: list[Block]) -> list[str]:
    before: list[tuple[str, int]] = []
    for at, block in enumerate(region):
        before.append((block.label, at) if block.label else (before[-1] if at else ("", -1)))
    labels = [""] * len(region)
    after = ("", -1)
    for at in range(len(region) - 1, -1, -1):
        block = region[at]
        after = (block.label, at) if block.label else after
        near = [one for one in (before[at], after) if one[0]]
        if block.label:
            labels[at] = block.label
        elif len({label for label, _ in near}) <= 1:
            labels[at] = near[0][0] if near else "good"
        elif block.article:
            labels[at] = "good"
        elif block.heading:
            labels[at] = after[0]
        else:
            labels[at] = min(near, key=lambda one: abs(one[1] - at))[0]
    return labels


def main_text(page: str) -> str:
    """The good blocks, joined by an empty line."""
    blocks = blocks_of(page)
    for block in blocks:
        block.label = first_pass(block)
    by_length(blocks)
    second_pass(blocks)
    return "\n\n".join(block.text for block in blocks if block.label == "good")


def extract_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """Per row: page_id, url, text, n_chars.

    Every input row gives one row, repeated ids included; other input columns are ignored. A null or empty page, and one
    without a good block, has the empty text. Null ids and addresses stay null. An empty table gives an empty one.
    """
    ship_code(pages.sparkSession)

    @F.pandas_udf("string")
    def extracted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(one) for one in texts(batch)], dtype=object)

    pages = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(page).alias("html"))
    done = pages.select("page_id", "url", extracted("html").alias("text"))
    return done.withColumn("n_chars", F.length("text").cast("long"))

"""Main text of web pages by two passes of rules over blocks.

A page is cut into blocks at block-level tags. The first pass looks at each block by
itself: its length, the share of stop words, the share of text inside links, and
whether it stands inside an element made for something else than the article. It
calls a block good, bad or leaves it open. In the second pass an open block takes the
label of its nearest decided neighbours.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Thresholds: characters, share of stop words, share of characters inside links.
SHORT, STOP_HIGH, LINK_HIGH = 70, 0.12, 0.4
# For pages in other languages than those of the stop words.
FOREIGN_LENGTH, FOREIGN_LINKS, FOREIGN_STOP = 40, 0.2, 0.02

STOP_WORDS = frozenset("""
a an and are as at be but by for from had has have he her his in is it its not of on or
that the their they this to was we were which will with you
aber als am an auch auf aus bei das dem den der des die ein eine einen einer es für ich im in
ist mit nicht noch nur oder sich sie sind so und von vor war wie wir zu zum zur
au aux avec ce ces dans de des du elle en est et il la le les leur lui mais ne nous on ou où
par pas pour qui que sa se ses son sur un une vous
al como con de del el ella en entre es esta este fue ha la las lo los más no o para pero por que
se sin su sus también un una y ya
""".split())

# Elements whose text is never prose of the page.
_SILENT = ("script style noscript template svg math iframe object canvas textarea select button "
           "head audio video map datalist").split()
# Attributes up to the end of a tag. Quotes pair up only where no < or > comes between, and
# nothing once read is read again, so a tag costs its own length.
_INSIDE = r"(?>[^<>\"']+|\"[^\"<>]*\"|'[^'<>]*'|[\"'])*+"
_CUT = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<({})\b{}>.*?(?:</\1\s*+>|\Z)"
    .format("|".join(_SILENT), _INSIDE), re.S | re.I)
_TAG = re.compile(rf"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)({_INSIDE})>|<[!?][^<>]*+>")
_HALF_TAG = re.compile(r"<[a-zA-Z/!?][^<>]*\Z")
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"[^\W\d_]+")

INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label
mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img br input""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ARTICLE = frozenset(["article", "main"])
ASIDE_TAGS = frozenset("nav footer aside form header menu dialog fieldset".split())
ASIDE_ROLES = frozenset("""navigation banner contentinfo complementary search form dialog
alertdialog alert menu menubar toolbar""".split())
ASIDE_NAMES = frozenset("""ad ads adv advert adverts advertisement advertising banner sponsor
sponsored promo promotion nav navbar navigation navi menu submenu breadcrumb breadcrumbs sidebar
aside footer foot header masthead topbar toolbar cookie cookies consent gdpr notice notices popup
modal overlay newsletter subscribe subscription signup signin login register share sharing social
related recommended recommendations widget widgets comment comments commentlist disqus respond
reply replies pagination pager paging skip copyright legal disclaimer tags search form alert
""".split())
# Before such a name they say that the page goes with or without the thing, not that it is one.
_ABOUT = frozenset("no non not without with has have hide hides".split())


@dataclass
class Block:
    text: str
    linked: int
    aside: bool
    article: int  # number of the article element around it, 0 for none
    heading: bool


def _parts(token: str) -> list[str]:
    """The words of a class or id that name what the element is."""
    words = re.split(r"[_-]+", token)
    return [] if words[0] in _ABOUT else words


def _is_aside(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in ASIDE_TAGS and not (tag == "header" and in_article):
        return True
    if not attributes.strip() or tag in ("html", "body") or tag in ARTICLE:
        return False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id"):
            names = [n for token in value.split() for n in _parts(token)]
            if not ASIDE_NAMES.isdisjoint(names) and not (in_article and "header" in names):
                return True
        elif name == "role" and value in ASIDE_ROLES or name == "hidden":
            return True
        elif name == "aria-hidden" and value == "true":
            return True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def blocks_of(page: str) -> list[Block]:
    page = _HALF_TAG.sub("", _CUT.sub(" ", page))
    out: list[Block] = []
    open_: list[tuple[str, bool, int]] = []  # tag, opens an aside, article number
    asides = articles = article = links = linked = 0
    heading = False
    parts: list[str] = []

    def flush():
        nonlocal linked, parts
        text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
        if text:
            out.append(Block(text, linked, asides > 0, article, heading))
        parts, linked = [], 0

    def close(at: int):
        nonlocal asides, article, links
        for tag, aside, before in reversed(open_[at:]):
            asides -= aside
            article = before
            links -= tag == "a"
        del open_[at:]

    at = 0
    for m in _TAG.finditer(page):
        if m.start() > at:
            parts.append(page[at: m.start()])
            if links:
                linked += m.start() - at
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        inline = tag in INLINE
        if tag == "br":
            parts.append(" ")
            continue
        if not inline:
            flush()
        if m[1]:
            for k in range(len(open_) - 1, -1, -1):
                if open_[k][0] == tag:
                    if inline and any(t not in INLINE for t, _, _ in open_[k + 1:]):
                        break
                    close(k)
                    break
            if tag[0] == "h" and tag[1:].isdigit():
                heading = False
        elif tag not in VOID and not m[3].endswith("/"):
            if tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and open_:
                # These end an open element of their kind, with what is open inside it.
                for k in range(len(open_) - 1, -1, -1):
                    if open_[k][0] == tag:
                        close(k)
                    elif open_[k][0] in INLINE or open_[k][0] == "p":
                        continue
                    break
            aside = _is_aside(tag, m[3], article > 0)
            open_.append((tag, aside, article))
            asides += aside
            links += tag == "a"
            if tag in ARTICLE and not article:
                articles += 1
                article = articles
            if tag[0] == "h" and tag[1:].isdigit():
                heading = True
    if at < len(page):
        parts.append(page[at:])
        if links:
            linked += len(page) - at
    flush()
    return out


def _alone(block: Block) -> bool | None:
    """First pass: good, bad, or None for open."""
    if block.aside or block.linked > LINK_HIGH * len(block.text):
        return False
    if len(block.text) < SHORT:
        return None
    words = _WORD.findall(block.text.lower())
    dense = sum(w in STOP_WORDS for w in words) >= STOP_HIGH * max(1, len(words))
    return True if dense else None


def _foreign(block: Block) -> bool:
    """Long, with few links, and without words of the listed languages."""
    if len(block.text) < FOREIGN_LENGTH or block.linked > FOREIGN_LINKS * len(block.text):
        return False
    words = _WORD.findall(block.text.lower())
    return sum(w in STOP_WORDS for w in words) <= FOREIGN_STOP * len(words)


def main_blocks(blocks: list[Block]) -> list[Block]:
    labels = [_alone(b) for b in blocks]
    n = len(blocks)
    if True not in labels:
        # No list of stop words fits the page: length and link density decide.
        labels = [True if label is None and _foreign(b) else label
                  for b, label in zip(blocks, labels)]

    def nearest(k: int, step: int) -> tuple[int, bool | None]:
        j = k + step
        while 0 <= j < n and blocks[j].article == blocks[k].article:
            if labels[j] is not None:
                return abs(j - k), labels[j]
            j += step
        return n + 1, None

    def settle(k: int) -> bool:
        if labels[k] is not None:
            return labels[k]
        (before, left), (after, right) = nearest(k, -1), nearest(k, 1)
        inside = blocks[k].article > 0
        if left is None and right is None:
            return inside
        if inside and not (left is False and right is False):
            # An article's own edges count as good neighbours.
            return True
        if left is None or right is None or left == right:
            return bool(right if left is None else left)
        # A heading belongs to what follows it.
        return bool(right if blocks[k].heading or after < before else left)
    return [b for k, b in enumerate(blocks) if settle(k)]


def main_text(page: str | None) -> str:
    """The text of the main blocks, one a line; empty for null."""
    return "\n".join(b.text for b in main_blocks(blocks_of(page))) if page else ""


def extract(pages: DataFrame, page: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with its html replaced by the main text ``out``, never null.

    Whole pages are read, cut off tags and elements included. Character references are
    decoded, white space inside a block becomes one space. A column ``out`` of the
    input is replaced.
    """
    kept = [c for c in pages.columns if c not in (page, out)]
    rows = pages.select(F.col(page).cast("string").alias("_page"),
                        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"))
    schema = StructType([rows.schema["_row"], StructField("_out", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(value.as_py()) for value in batch.column(0)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(texts, pa.string())],
                                             ["_row", "_out"])
    return rows.mapInArrow(run, schema).select(
        "_row.*", F.col("_out").alias(out))

"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. First pass: a block is
boilerplate if it lies in boilerplate structure (menus, footers, forms,
elements, paragraphs, list items and cells of which a whole class or id names
advertising, comments, notices ..., not one that only mentions them, as
``has-sidebar`` or ``related-work``), outside the article of a page that marks
one, or is mostly link text (but for paragraphs of the marked article); it is content if
it is long and rich in stop words; short or poor blocks stay undecided. An article
that holds less than a third of the page's long texts is a teaser, as is one that is named so, and marks nothing. Second
pass: an undecided block takes the label of its nearest decided neighbours in
the same part of the page; a heading takes the label of what follows it. A page
without a block rich in the listed stop words is judged by length and link
density alone, and a long block of few links never follows a list of links.

Defined cases: null or empty html gives an empty text; markup that never
closes runs to the end of the page; a page without any block decided to be
content keeps its undecided ones; a page that is empty but for a long text in an
element only named like boilerplate is read again without such names; nothing is
cut off, however long.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

LONG = 70
LINKED = 0.5
FEW_LINKED = 0.2
STOP_SHARE = 0.08
# Frequent function words of four languages.
STOP_WORDS = frozenset((
    "a an and are as at be been but by for from had has have he her his i if in is it its not of on or she that the their they this to was we were which with you "
    "aber als am an auf aus bei das dass dem den der des die ein eine einem einen einer er es für hat ich im in ist mit nach nicht sich sie sind und von war wie wird zu "
    "au aux avec ce dans de des du elle en est et il ils je la le les leur mais ne nous ou par pas plus pour que qui sa se ses son sur un une vous "
    "al como con de del el en es esta fue ha la las lo los más no o para pero por que se ser sin sobre su sus un una y").split())
_OPAQUE = "script|style|title|textarea|noscript|template|svg|iframe|select|object|canvas|math|button"
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?:svg|math)\b(?:[^>\"'/]++|/(?!>)|\"[^\"]*+\"|'[^']*+')*+/>"
    rf"|<(?P<opaque>{_OPAQUE})\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=opaque)\s*>|\Z)"
    r"|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)", re.S | re.I)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_NESTING = frozenset("html body head div section article main nav header footer aside form ul ol dl table figure details fieldset dialog menu blockquote".split())
_BLOCKS = _NESTING | _HEADINGS | frozenset("p li dt dd tr td th thead tbody tfoot caption figcaption pre hr address summary legend option center".split())
_BAD_TAGS = frozenset("head nav header footer aside form menu dialog".split())
_PARAGRAPHS = frozenset("p pre blockquote".split())
# An element without an end tag is ended by the next one of these names, up to the enclosing list or table.
_ENDED_BY = {name: names for names in map(frozenset, (("li",), ("dt", "dd"), ("td", "th"), ("tr", "td", "th"), ("thead", "tbody", "tfoot", "tr", "td", "th"))) for name in names}
_ENDED_BY.update({name: frozenset(("td", "th")) for name in ("td", "th")}, tr=frozenset(("tr", "td", "th")))
_SCOPES = frozenset("table ul ol dl menu article main section body".split())
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_BAD_WORDS = frozenset((
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs ccpa comment commenter commenters comments comentarios cookie cookies consent copyright disqus dialog footer form "
    "gdpr header hidden login masthead menu modal nav navbar navigation newsletter notice notices notification pagination pager popup promo promotion recommended related "
    "replies reply respond search share sharing sidebar social sponsor sponsored subscribe subscription tags toolbar widget alert complementary contentinfo").split())
# Words that say where or how a named part is laid out, not what it is about.
_PLAIN_WORDS = frozenset((
    "area article articles bar block bottom box button buttons cell center col column container content desktop entry facebook fixed floating global google group icon icons inner "
    "item items js left link links list main media message messages mini mobile module news outer page panel post posts primary region results right row secondary section signup site slot small sticky "
    "stories sub top twitter unit user web wp wrap wrapper").split())
_MODIFIERS = frozenset("has have is no non not off on show hide toggle with without".split())
_TEASER = re.compile(r"\b(?:teasers?|cards?|previews?|promos?|related|recommended)\b", re.I)
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_WORD = re.compile(r"[^\W\d_]+")
CONTENT, BOILERPLATE = True, False
NAMED, STRUCTURE = 1, 2


def _split(word: str) -> list[str]:
    """A compound of a listed word of boilerplate and another listed word (``commentlist``) as the two."""
    if word not in _BAD_WORDS and word not in _PLAIN_WORDS:
        for k in range(2, len(word) - 1):
            a, b = word[:k], word[k:]
            if (a in _BAD_WORDS and (b in _PLAIN_WORDS or b in _BAD_WORDS)) or (a in _PLAIN_WORDS and b in _BAD_WORDS):
                return [a, b]
    return [word]


@lru_cache(maxsize=65_536)
def _bad_name(name: str) -> bool:
    """A class, id or role all of whose words name boilerplate or its place."""
    spaced = re.sub(r"(?<=[a-z])(?=[A-Z])", " ", name).lower()
    words = [part for w in re.split(r"[^a-z]+", spaced) if len(w) > 1 for part in _split(w)]
    return not _BAD_WORDS.isdisjoint(words) and all(w in _BAD_WORDS or w in _PLAIN_WORDS for w in words) and _MODIFIERS.isdisjoint(words)


def _boilerplate_element(name: str, rest: str, in_article: bool) -> int:
    """0: no, NAMED: by a name alone, STRUCTURE: by its tag or as hidden."""
    if name in _BAD_TAGS and not (in_article and name == "header"):
        return STRUCTURE
    if not rest or name in ("html", "body", "main") or (name == "article" and not in_article):
        return 0
    attributes: dict[str, str] = {}
    for key, a, b, c in _ATTRIBUTE.findall(rest):
        attributes.setdefault(key.lower(), a or b or c)
    if (attributes.get("hidden", "until-found").lower() != "until-found" or attributes.get("aria-hidden", "").lower() == "true"
            or _HIDING.search(attributes.get("style", ""))):
        return STRUCTURE
    return NAMED if any(_bad_name(x) for key in ("class", "id", "role") for x in attributes.get(key, "").split()) else 0


class _Block:
    __slots__ = ("text", "linked", "bad", "region", "heading", "paragraph")

    def __init__(self, text: str, linked: int, bad: int, region: bool, heading: bool, paragraph: bool):
        self.text, self.linked, self.bad, self.region, self.heading, self.paragraph = text, linked, bad, region, heading, paragraph


def _end_implied(stack: list[tuple[str, int, bool]], name: str) -> None:
    """Close what an opening tag ends without an end tag of its own: paragraphs, headings, items, cells, rows."""
    while stack and (stack[-1][0] == "p" or (name in _HEADINGS and stack[-1][0] in _HEADINGS)):
        stack.pop()
    ended = _ENDED_BY.get(name)
    if ended:
        reach, k = None, len(stack) - 1
        while k >= 0 and stack[k][0] not in _SCOPES:
            reach = k if stack[k][0] in ended else reach
            k -= 1
        if reach is not None:
            del stack[reach:]


def blocks(page: str) -> tuple[list[_Block], bool]:
    """The page's blocks in order, and whether it marks an article."""
    out: list[_Block] = []
    parts: list[str] = []
    state = {"linked": 0, "heading": False}
    stack: list[tuple[str, int, bool]] = []  # name, boilerplate, inside the article
    link = marked = False

    def flush() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                inner, bad, region = stack[-1] if stack else ("", 0, False)
                out.append(_Block(text, state["linked"], bad, region, state["heading"], inner in _PARAGRAPHS))
            parts.clear()
        state["linked"] = 0

    def say(piece: str) -> None:
        if piece:
            piece = html.unescape(piece) if "&" in piece else piece
            parts.append(piece)
            if link:
                state["linked"] += len(piece.strip())

    at = 0
    for m in _TAG.finditer(page):
        say(page[at:m.start()])
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        if name == "a":
            link = not (m["end"] or m["end2"])
        elif name == "br":
            parts.append(" ")
        elif name in _BLOCKS:
            flush()
            link = False
            if m["end"] or m["end2"]:
                state["heading"] = False
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == name or (name in _HEADINGS and stack[k][0] in _HEADINGS):
                        del stack[k:]
                        break
                    if name not in _NESTING and stack[k][0] in _SCOPES:
                        break
            else:
                state["heading"] = name in _HEADINGS
                rest = m["rest"] or m["rest2"] or ""
                _end_implied(stack, name)
                if name != "hr" and not (name in _NESTING and rest.endswith("/")):
                    article = name == "main" or (name == "article" and not _TEASER.search(rest))
                    if article or name == "body":  # whatever was left open before does not reach into it
                        stack = [s for s in stack if not s[1]]
                    _, bad, region = stack[-1] if stack else ("", 0, False)
                    stack.append((name, max(bad, _boilerplate_element(name, rest, region)), region or article))
                    marked |= article
    say(page[at:])
    flush()
    return out, marked


def _first_pass(b: _Block, marked: bool) -> bool | None:
    if b.bad or (marked and not b.region):
        return BOILERPLATE
    if b.linked > LINKED * len(b.text):
        if not (marked and b.paragraph):
            return BOILERPLATE
        return CONTENT if len(b.text) >= LONG else None
    if len(b.text) < LONG:
        return None
    words = [w.lower() for w in _WORD.findall(b.text)]
    if words and sum(w in STOP_WORDS for w in words) >= STOP_SHARE * len(words):
        return CONTENT
    return None


def _long_text(b: _Block) -> bool:
    return len(b.text) >= LONG and b.linked <= FEW_LINKED * len(b.text)


def _by_length(found: list[_Block], labels: list[bool | None]) -> list[bool | None]:
    """Labels for a page on which no block was found rich in stop words (another language, code, tables)."""
    if CONTENT in labels:
        return labels
    return [CONTENT if lab is None and _long_text(b) else lab for b, lab in zip(found, labels, strict=True)]


def _second_pass(found: list[_Block], labels: list[bool | None], marked: bool) -> list[bool]:
    """Undecided blocks between decided ones; structure's own verdicts say nothing about their neighbours."""
    n, out = len(found), list(labels)
    telling = [lab if not found[i].bad and not (marked and not found[i].region) else None for i, lab in enumerate(labels)]
    if CONTENT not in telling:  # links alone do not tell what is around them
        telling = [None] * n
    before: list[int] = []
    last = -1
    for i in range(n):
        before.append(last)
        last = i if telling[i] is not None else last
    after, last = [0] * n, n
    for i in range(n - 1, -1, -1):
        after[i] = last
        last = i if telling[i] is not None else last
    for i in range(n):
        if labels[i] is None:
            a, b = before[i], after[i]
            left, right = telling[a] if a >= 0 else None, telling[b] if b < n else None
            if left is None or right is None or left == right:
                near = right if left is None else left
            elif found[i].heading:
                near = right
            else:
                near = CONTENT if i - a == b - i else (left if i - a < b - i else right)
            out[i] = CONTENT if near is None or _long_text(found[i]) else near
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    found, marked = blocks(page)
    marked = marked and _marks(found)
    kept = _kept(found, marked)
    if not kept and any(b.bad == NAMED for b in found):
        for b in found:
            b.bad = b.bad if b.bad == STRUCTURE else 0
        if any(_long_text(b) and _first_pass(b, marked) == CONTENT for b in found):
            kept = _kept(found, marked)
    return "\n".join(kept)


def _marks(found: list[_Block]) -> bool:
    """Whether what is marked as article is the page's text: it holds at least a third of the long texts."""
    inside = outside = 0
    for b in found:
        if not b.bad and _long_text(b):
            if b.region:
                inside += len(b.text)
            elif _first_pass(b, False) == CONTENT:
                outside += len(b.text)
    return 2 * inside >= outside


def _kept(found: list[_Block], marked: bool) -> list[str]:
    labels = _by_length(found, [_first_pass(b, marked) for b in found])
    return [b.text for b, keep in zip(found, _second_pass(found, labels, marked), strict=True) if keep]


@F.pandas_udf(StringType())
def _main_texts(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in pages:
        yield pd.Series([main_text(p) for p in batch], dtype=object)


def main_text_of(page: Column) -> Column:
    return _main_texts(page)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    return (pages.select("page_id", "url", main_text_of(F.col("html")).alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))

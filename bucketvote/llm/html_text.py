"""Main text of HTML pages by two-pass block rules.

A page is cut into blocks at block-level tags.  The first pass labels a block
by the container it is in, its share of linked text, its length and its share
of stop words: good, bad, or (short or in between) undecided.  In the second
pass an undecided block takes the label of the nearest decided block of its
section; of two equally near ones, good wins.  A section without any decided
block counts as good if it is an article or the page has no article at all.
Stop words say nothing about a page in a language that has none of those
listed; there length and links decide, as in an article.

Containers that are never main text (menus, headers, footers, sidebars,
forms, notices, adverts, reader comments) are known by their tag, their role
or a name among their classes or their id.  A name counts if it is such a word
(``sidebar``), ends in one (``site-footer``) or begins with one and goes on
with words of layout (``comment-list``, ``nav-2``), but not if it says what a
page has or lacks (``has-sidebar``).  In an article only what cannot belong to
it counts, and ``main``, or a container with the id of the page's content, is
never judged by its classes.  Of a page where this leaves nothing, the names
are disregarded.  In an article only length and links count, since whatever
prose it has belongs to it.

Nulls: a null page has the empty text.  Markup that is cut off or wrongly
nested is read as far as it goes; nothing is dropped for its length.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import bounded_batches, slices, utf8

LINKED, SHORT, LONG, FEW_STOPS, MANY_STOPS = 0.4, 10, 30, 0.1, 0.25

# Frequent function words of four languages.
STOP_WORDS = frozenset(
    "a an and are as at be been but by for from had has have he her his i in is it its no not of on or she so that the their they"
    " this to was we were which who will with would you"
    " aber als am an auch auf aus bei bis das dass dem den der des die durch ein eine einem einen einer er es für hat ich im in ist"
    " mit nach nicht noch nur oder sein sich sie sind so über um und uns vom von vor war wenn werden wie wir zu zum zur"
    " au aux avec ce ces cette dans de des du elle en est et eux il ils je la le les leur mais ne nous on ou par pas plus pour qu que"
    " qui sa se ses son sont sur un une vous y"
    " al como con cuando de del desde donde el ella ellos en entre era es esta este fue ha hasta la las le lo los más muy no nos o para"
    " pero por que se ser si sin sobre su sus también un una uno y ya".split()
)
# What containers are called.
ARTICLE_WORDS = frozenset("article content entry main post story".split())
#: ... of what never belongs to an article,
COMMENT_WORDS = frozenset("comment comments commentlist disqus remark remarks replies reply respond responses".split())
ADVERT_WORDS = frozenset("ad ads advert advertisement advertising adverts promo promoted promotion sponsor sponsored".split())
INSIDE_WORDS = (
    COMMENT_WORDS
    | ADVERT_WORDS
    | frozenset(
        "alert alerts aside banner breadcrumb breadcrumbs consent cookie cookies footer form gdpr login menu modal nav navbar navigation"
        " newsletter notice notices overlay pager pagination paywall popup search sidebar signup subscribe subscription toolbar".split()
    )
)
#: and of what does not belong to the main text elsewhere.
OTHER_WORDS = INSIDE_WORDS | frozenset(
    "byline copyright disclaimer discussion footnote header legal masthead recommended related reviews share sharing social teaser widget".split()
)
#: Words that only say where or what kind of box it is, and words after which a
#: name says what a page has or lacks.
LAYOUT_WORDS = frozenset(
    "area articles bar block body bottom box col column container content entries entry form group inline inner item items label left link"
    " links list main menu nav outer panel posts primary right row secondary section slot stories text title top unit widget widgets wrap wrapper".split()
)
MODIFIERS = frozenset("has is no not show hide with without".split())
CONTENT_IDS = frozenset("article content main maincontent".split())
_OTHER_TAGS = frozenset("nav header footer aside form menu dialog button select option label fieldset datalist".split())
_OTHER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_CONTAINERS = frozenset("div section article main nav header footer aside form menu dialog ul ol table figure details fieldset body td".split())
_BLOCKS = _CONTAINERS | frozenset(
    "address blockquote caption center dd dl dt figcaption h1 h2 h3 h4 h5 h6 head hr html legend li option p pre summary tbody tfoot th thead tr title button select label".split()
)
_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<(?P<raw>script|style|noscript|iframe|textarea|title|xmp)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-zA-Z][^>]*+(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S | re.I,
)
#: Elements whose content is no text; one that is never closed is passed over.
_HOLLOW = {t: re.compile(rf"</{t}\s*>", re.I) for t in "template object svg math canvas audio video".split()}
_ATTRIBUTE = re.compile(r"([^\s\"'=/>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_WORD = re.compile(r"[a-z]+")


class Block(NamedTuple):
    text: str
    linked: int  # characters inside links
    kind: str  # "article", "other" or "plain": the container it is in
    section: int


def _named(names: list[str], words: frozenset) -> bool:
    """Whether one of a container's names is of these words."""
    for name in names:
        parts = _WORD.findall(name)
        if parts and not (parts[0] in MODIFIERS and len(parts) > 1):
            if parts[-1] in words or parts[0] in words and all(p in LAYOUT_WORDS for p in parts[1:]):
                return True
    return False


def _kind(tag: str, attrs: str, outer: str, by_name: bool) -> str:
    """The kind of a container, given what it lies in."""
    if outer == "other":
        return outer
    own: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(attrs):
        own.setdefault(name.lower(), value.strip("\"'").lower())
    if "hidden" in own or own.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", own.get("style", "")):
        return "other"
    role = own.get("role")
    if role in _OTHER_ROLES or tag in _OTHER_TAGS and not (tag == "header" and outer == "article"):
        return "other"
    names = [*own.get("class", "").split(), *own.get("id", "").split()]
    if tag == "main" or role == "main":
        return "article"
    if tag == "article" or role == "article":
        return "other" if by_name and _named(names, COMMENT_WORDS | ADVERT_WORDS) else "article"
    whole = "".join(_WORD.findall(own.get("id", ""))) in CONTENT_IDS
    if by_name and tag != "body" and not whole and _named(names, INSIDE_WORDS if outer == "article" else OTHER_WORDS):
        return "other"
    words = {w for n in names for w in _WORD.findall(n)}
    return "article" if tag in ("div", "section", "td") and (whole or words & ARTICLE_WORDS and not words & MODIFIERS) else outer


def blocks(page: str, by_name: bool = True) -> list[Block]:
    """The text blocks of a page, in order."""
    out: list[Block] = []
    stack: list[tuple[str, str, int]] = [("", "plain", 0)]
    parts: list[str] = []
    sections = linked = link_depth = at = 0
    open_ended: set[str] = set()  # hollow elements that are closed nowhere further on

    def close() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            out.append(Block(text, linked, stack[-1][1], stack[-1][2]))
        parts.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        text = html.unescape(raw) if "&" in raw else raw
        parts.append(text)
        if link_depth:
            linked += len("".join(text.split()))

    while m := _TOKEN.search(page, at):
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if not tag:
            continue
        tag = tag.lower()
        if tag in _HOLLOW:
            if not m["end"] and not m["attrs"].endswith("/") and tag not in open_ended:
                closed = _HOLLOW[tag].search(page, at)
                if closed:
                    at = closed.end()
                else:
                    open_ended.add(tag)
        elif tag == "a":
            link_depth = 0 if m["end"] else 1
        elif tag == "br":
            parts.append(" ")
        elif tag in _BLOCKS:
            close()
            link_depth = 0
            if tag in _CONTAINERS:
                if m["end"]:
                    for i in range(len(stack) - 1, 0, -1):
                        if stack[i][0] == tag:
                            del stack[i:]
                            break
                elif not m["attrs"].endswith("/"):
                    kind = _kind(tag, m["attrs"], stack[-1][1], by_name)
                    if kind != stack[-1][1]:
                        sections += 1
                        stack.append((tag, kind, sections))
                    else:
                        stack.append((tag, kind, stack[-1][2]))
    if at < len(page):
        add(page[at:])
    close()
    return out


def _stops(words: list[str]) -> int:
    return sum(w.strip(".,;:!?\"'()").lower() in STOP_WORDS for w in words)


def _label(block: Block, has_article: bool, known: bool) -> bool | None:
    """First pass: good, bad or undecided."""
    if block.kind == "other" or has_article and block.kind != "article":
        return False
    words = block.text.split()
    if block.linked > LINKED * len("".join(words)):
        return False
    if len(words) < SHORT:
        return False if "©" in block.text and block.kind != "article" else None
    if block.kind == "article" or not known:
        return True
    stops = _stops(words) / len(words)
    if stops >= MANY_STOPS:
        return True
    return None if stops >= FEW_STOPS or len(words) < LONG else False


def main_blocks(page: str) -> list[str]:
    """The blocks of a page that are main text."""
    return _main(blocks(page)) or _main(blocks(page, by_name=False))


def _main(found: list[Block]) -> list[str]:
    """Both passes."""
    has_article = any(b.kind == "article" for b in found)
    plain = [w for b in found if b.kind == "plain" for w in b.text.split()]
    known = _stops(plain) >= FEW_STOPS * len(plain)  # the page is in a language with stop words
    labels = [_label(b, has_article, known) for b in found]
    far = len(found) + 1
    before, after = [(far, False)] * len(found), [(far, False)] * len(found)
    for near, order in ((before, range(len(found))), (after, range(len(found) - 1, -1, -1))):
        last: dict[int, int] = {}
        for i in order:
            section = found[i].section
            # in an article a linked line says nothing about its neighbours
            if labels[i] or labels[i] is False and found[i].kind != "article":
                last[section] = i
            elif labels[i] is None and section in last:
                near[i] = (abs(i - last[section]), labels[last[section]])
    out = []
    for i, block in enumerate(found):
        label = labels[i]
        if label is None:
            (x, left), (y, right) = before[i], after[i]
            label = block.kind == "article" or not has_article if x == y == far else left or right if x == y else left if x < y else right
        if label:
            out.append(block.text)
    return out


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "_llm_html"):
        rest = [i for i, c in enumerate(batch.schema.names) if c != "_llm_html"]
        texts = ["\n".join(main_blocks(p.decode(errors="replace"))) if p else "" for p in batch.column("_llm_html").to_pylist()]
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in rest), pa.array(texts, pa.string())], names=[*(batch.schema.names[i] for i in rest), "text"])


def main_text(pages: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """One row for each row of ``pages``: the ``carry`` columns (page_id and
    url unless named) and text, the main blocks joined by line feeds."""
    bounded_batches(pages.sparkSession)
    carry = ["page_id", "url"] if carry is None else carry
    shape = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*carry).schema), "text string"])
    return pages.select(*carry, utf8("html").alias("_llm_html")).mapInArrow(_extracted, shape)

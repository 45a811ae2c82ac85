"""Main-text extraction by two-pass block rules.

A page is cut into text blocks at block-level tags.  The first pass classifies
each block on its own: by stop-word density, length and link density, and by
the kind of place it stands in (a block inside a menu, header, footer,
sidebar, notice, advert, form or comment section is never main text).  Blocks
that stay ambiguous, short ones and those of middling density, inherit in the
second pass the label of the nearest decided neighbours; between a good and a
bad one they follow the good.  Long blocks with few stop words (a language the
list does not hold) are ambiguous too, and menus and the like beside them do
not count against them.  A page without a good block has its long ambiguous
ones as text, or else its short ones.  Inside an article element the first
pass decides with the element as evidence (fewer stop words make a block good,
and no share of links makes it bad), and ambiguous blocks inherit from the
decided ones of the articles; blocks beside it follow it only as headings or
between two.  An id on a heading never marks a
place, nor inside an article one on a paragraph or a word that may name a topic.

Text is decoded from character references; white space inside a block becomes
one space; blocks are joined in page order by one line feed.

Defined results: null or empty html, and pages without main text, give the
empty text and 0 characters; cut-off pages are read as far as they go, a
script or style that is never closed hides the rest; repeated pages get equal
results; very long pages are read whole.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .quality_rules import STOP_WORDS

LENGTH_LOW, LENGTH_HIGH = 70, 200
STOP_LOW, STOP_HIGH = 0.12, 0.25
LINKS_MAX = 0.33

# A quote opens a value only after an equals sign; elsewhere it is a character
# like any other.  A tag always ends, at the latest with the page, so no part of
# a page is read again.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(?:[!?][^>]*+)(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=][^\s>/=]*+)\s*+(?:=\s*+("[^"]*+"|'[^']*+'|[^\s>]++))?""")
_PLACE = {"class", "id", "role", "hidden", "style"}
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"\w+")

RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "title", "svg", "math", "noembed", "noframes", "object", "canvas"}
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr", "param"}
INLINE = set("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var img wbr input".split())
BOILER_TAGS = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "select", "button", "head"}
ARTICLE_TAGS = {"article", "main"}
BOILER_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "menubar"}
#: words of class and id names that mark places beside the article (parameter)
BOILER_WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
    "sidebar aside widget widgets menu nav navbar navigation breadcrumb breadcrumbs topbar masthead header footer foot copyright legal "
    "comment comments reply replies respond discussion disqus reader share sharing social related recommended trending popular newsletter subscribe "
    "subscription signup login search popup modal overlay alert toolbar pagination pager tags skip form".split())
#: of these, words that inside an article may name a topic or part of its text (parameter)
TOPIC_WORDS = set("legal notice notices discussion reader related popular trending header form search alert sponsor promotion respond skip tags".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: elements of running text: their names say less about the place than those of containers
TEXT_TAGS = HEADINGS | INLINE | {"p", "li", "dl", "dt", "dd", "td", "th", "tr", "table", "blockquote", "pre", "figure", "figcaption", "section", "header"}
_NAME = re.compile(r"[a-z]+")
_STOP = frozenset(STOP_WORDS)


def _is_boiler(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in BOILER_TAGS and not (tag == "header" and in_article):
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name not in _PLACE:
            continue
        if name == "id" and (tag in HEADINGS or in_article and (tag == "p" or tag in INLINE)):
            continue
        words = BOILER_WORDS - TOPIC_WORDS if in_article and tag in TEXT_TAGS else BOILER_WORDS
        if name in ("class", "id") and any(w in words for w in _NAME.findall(value)):
            return True
        if name == "role" and value in BOILER_ROLES:
            return True
        if name == "hidden" or name == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


class Block:
    __slots__ = ("text", "links", "boiler", "article", "heading", "label")

    def __init__(self, text, links, boiler, article, heading):
        self.text, self.links, self.boiler, self.article, self.heading, self.label = text, links, boiler, article, heading, ""


def blocks_of(page: str) -> list[Block]:
    """The page's text blocks in order."""
    out: list[Block] = []
    parts: list[str] = []
    linked = [0]
    stack: list[tuple[str, bool, bool]] = []  # tag, is boilerplate, is in an article
    at = 0

    def flush():
        raw = "".join(parts)
        parts.clear()
        text = _SPACE.sub(" ", html.unescape(raw)).strip()
        if text:
            out.append(Block(text, min(1.0, linked[0] / len(text)), bool(stack) and stack[-1][1], bool(stack) and stack[-1][2],
                             any(t in HEADINGS for t, _, _ in stack[-2:])))
        linked[0] = 0

    def said(text: str):
        if text:
            parts.append(text)
            if any(t == "a" for t, _, _ in stack[-3:]):
                linked[0] += len(_SPACE.sub(" ", html.unescape(text)))

    while True:
        m = _TOKEN.search(page, at)
        if m is None:
            lost = page.find("<", at)
            tail = page[at:]
            if lost >= 0 and re.match(r"</?[a-zA-Z]", page[lost:lost + 3]):  # a tag that is cut off
                tail = page[at:lost]
            said(tail)
            break
        said(page[at:m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:  # end tag
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if tag not in INLINE:
                flush()
            if depth is not None and (tag not in INLINE or all(t in INLINE for t, _, _ in stack[depth:])):
                del stack[depth:]
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            if not m[3].rstrip().endswith("/"):
                at = end.end() if end else len(page)
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag not in INLINE:
            flush()
            if tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option") or tag[0] == "h" and tag[1:].isdigit():  # closed by the next of its kind
                while stack and (stack[-1][0] in INLINE or stack[-1][0] in ("p", tag) and stack[-1][0] not in ("div",)):
                    stack.pop()
        if tag in VOID:
            continue
        above = stack[-1] if stack else ("", False, False)
        article = above[2] or tag in ARTICLE_TAGS
        stack.append((tag, above[1] or _is_boiler(tag, m[3], above[2]), article))
    flush()
    return out


def first_pass(b: Block) -> str:
    """good, bad, dense, near or unknown (ambiguous), or short, from the block alone."""
    if b.boiler or not b.article and (b.links > LINKS_MAX or "©" in b.text[:3]):
        return "bad"
    words = _WORD.findall(b.text.lower())
    density = sum(w in _STOP for w in words) / len(words) if words else 0.0
    if len(b.text) < LENGTH_LOW:
        return "short"
    if density >= STOP_HIGH:
        return "good" if len(b.text) > LENGTH_HIGH or b.article else "dense"
    if density >= STOP_LOW:
        return "good" if b.article else "near"
    return "near" if b.article else "unknown"


def _sides(decided: list[bool]) -> list[list[int]]:
    """The nearest decided block before and after each one, where there is one."""
    n = len(decided)
    before, after = [-1] * n, [n] * n
    for i in range(1, n):
        before[i] = i - 1 if decided[i - 1] else before[i - 1]
    for i in range(n - 2, -1, -1):
        after[i] = i + 1 if decided[i + 1] else after[i + 1]
    return [[k for k in pair if 0 <= k < n] for pair in zip(before, after)]


def inside_articles(blocks: list[Block], labels: list[str]) -> list[str]:
    """Labels with those of article blocks settled.  The article element is
    evidence that what stands in it is text: ambiguous blocks follow the nearest
    decided blocks of the articles, which links and places beside them do not
    make bad; where the first pass decided none, the ambiguous ones are the text."""
    inside = [i for i, b in enumerate(blocks) if b.article and not b.boiler]
    decided = [labels[i] in ("good", "bad") for i in inside]
    out = list(labels)
    for i, near, known in zip(inside, _sides(decided), decided):
        if not known:
            out[i] = "good" if not any(decided) or any(labels[inside[k]] == "good" for k in near) else "bad"
    return out


def second_pass(blocks: list[Block]) -> None:
    """Give ambiguous blocks the label of their nearest decided neighbours."""
    labels = [first_pass(b) for b in blocks]
    # a page of short blocks only: those full of stop words are its text
    dense = "near" if "good" in labels else "good"
    labels = [dense if x == "dense" else x for x in labels]
    no_article = not any(b.article for b in blocks)
    for kinds in (("near", "unknown"), ("short",)):  # nothing for the others to follow
        if no_article and "good" not in labels:
            labels = ["good" if x in kinds else x for x in labels]
    labels = inside_articles(blocks, labels)

    def drawn(near: list[int]) -> bool:
        """By good neighbours; an article draws in what stands beside it from both sides only."""
        good = [k for k in near if labels[k] == "good"]
        return len(good) == 2 or any(not blocks[k].article for k in good)

    sides = _sides([x in ("good", "bad") and not b.boiler for b, x in zip(blocks, labels)])
    known = [drawn(near) or no_article and not near for near in sides]
    labels = [("good" if k else "bad") if x == "unknown" else x for x, k in zip(labels, known)]
    for i, near in enumerate(_sides([x in ("good", "bad") for x in labels])):
        b, x = blocks[i], labels[i]
        if x == "near":
            x = "good" if any(labels[k] == "good" for k in near) else "bad"
        elif x == "short":
            heads = b.heading and any(k > i and labels[k] == "good" for k in near)
            x = "good" if heads or drawn(near) else "bad"
        b.label = x


def main_text(page: str | None) -> str:
    if not page:
        return ""
    blocks = blocks_of(page)
    second_pass(blocks)
    return "\n".join(b.text for b in blocks if b.label == "good")


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        col = batch.column("html")
        text = [main_text(col[i].as_py()) for i in range(len(col))]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()),
                                          pa.array([len(t) for t in text], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    d = pages.select("page_id", "url", "html")
    kinds = {f.name: f.dataType.simpleString() for f in d.schema}
    return d.mapInArrow(_run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")

"""Main text of HTML pages by two-pass block rules.

A page is cut into blocks at block-level tags; script, style and other hidden
content is skipped.  The first pass leaves out what stands in navigation,
footers, forms, comments or hidden elements.  It adds up the evidence on every
other block: an article or main element around it speaks for it, such an
element elsewhere on the page and a name of boilerplate (advert, sidebar ...)
against it, and length, stop-word density and link density either way.
Blocks without a balance of evidence stay open, on any page; the second pass
gives them the class of their nearest decided neighbours.

A name of reader comments is no verdict: it says nothing on ``html``, ``body``, ``article`` or ``main``, nor on an element
with a main element or a page heading inside, nor where no other block of the page is content.  Lengths count words, or
pairs of characters in scripts without spaces; on a page in a language without stop words here, ends of sentences stand in
for them.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Element names by role, name parts of boilerplate, frequent words.
SKIPPED = {"script", "style", "noscript", "template", "iframe", "svg", "math", "object", "canvas", "audio", "video",
           "textarea", "select", "title", "button"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl",
          "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head",
          "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "search", "section",
          "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
BOILERPLATE_TAGS = {"nav", "footer", "aside", "form", "menu", "dialog", "search", "fieldset", "head"}
BOILERPLATE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alertdialog",
                     "alert", "menu", "menubar", "toolbar", "status"}
BOILERPLATE_NAMES = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo",
                     "promotion", "banner", "sidebar", "sidebars", "menu", "menus", "nav", "navbar", "navigation",
                     "breadcrumb", "breadcrumbs", "footer", "masthead", "topbar", "cookie", "cookies", "consent", "gdpr",
                     "notice", "notices", "notification", "alert", "popup", "modal", "overlay", "newsletter", "subscribe",
                     "subscription", "signup", "login", "share", "sharing", "social", "related", "recommended", "widget",
                     "toolbar", "pagination", "pager", "copyright", "disclaimer"}
COMMENT_NAMES = {"comment", "comments", "commentlist", "disqus", "discussion", "reply", "replies", "respond", "responses"}
STOP_WORDS = frozenset("""
the of and to a in that is was for it with as his on be at by he had not are but from or have an they which one you
were her all she there would their we him been has when who will no if this these
der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie
nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder
de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec aux ou cette
mais on été ses être ont comme nous vous leur
el que y los del se las por un para con no una su al lo como más pero sus le ya o este sí porque esta entre cuando
muy sin sobre también me hasta hay donde
""".split())

#: Raw text up to their end tag, whatever it holds, or to the end of the page; the other skipped ones only if they are closed.
RAW = {"script", "style", "textarea", "title", "iframe"}
#: Headings of lists of other pages.
ELSEWHERE = re.compile(r"(you (may|might) also (like|enjoy)|related (posts|articles|stories|reading)|read next|more (from|stories)\b.*|"
                       r"recommended( for you| reading)?|popular (posts|now|stories)|trending( now)?)\W*", re.I)

LONG, SHORT = 25, 10            # words
MANY_LINKS, SOME_LINKS = 0.5, 0.3
STOPS = 0.15

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+|[^>]*)(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""([^\s=/"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_WORD = re.compile(r"[^\W\d_]+")
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u3040-\u30ff\u3400-\u9fff]")        # scripts without spaces: South-East and East Asia
_SENTENCE = re.compile(r"[.!?…؟۔।]\s|[.!?…؟۔।]\W*$|[。！？]")


@dataclass
class Block:
    tag: str
    text: str
    link_chars: int
    boilerplate: bool
    article: bool
    named: bool = False
    comment: int = 0                # number of the outermost element with a name of comments, if any
    elsewhere: bool = False         # under a heading of other pages
    good: bool | None = None


@dataclass
class _Open:
    tag: str
    boilerplate: bool
    article: bool
    named: bool = False             # by a name of boilerplate, its own or an enclosing one's
    comment: int = 0


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2].strip("\"'")) if m[2] else "" for m in _ATTR.finditer(raw)} if raw.strip(" /") else {}


def _opened(tag: str, raw: str, parent: _Open) -> tuple[_Open, bool]:
    """State inside an element, and whether it is hidden."""
    a = _attributes(raw)
    names = {x.lower() for x in _NAME.findall(f"{a.get('class', '')} {a.get('id', '')}")}
    hidden = _hidden(a)
    comment = parent.comment or -(tag not in ("html", "body") and bool(names & COMMENT_NAMES))      # -1: a new one
    junk = parent.boilerplate or tag in BOILERPLATE_TAGS or a.get("role", "") in BOILERPLATE_ROLES
    if tag in ("article", "main") or a.get("role") in ("main", "article") or "articleBody" in a.get("itemprop", ""):
        if tag in ("article", "main"):
            # An article of its own, or one comment of a list of them.
            comment = parent.comment or -bool(names & COMMENT_NAMES and "comment" in names and not names & {"open", "enabled", "closed", "post"})
        outside = parent.boilerplate or parent.named or comment
        return _Open(tag, parent.boilerplate, not outside or parent.article, parent.named, comment), hidden
    named = parent.named
    if tag not in ("body", "html"):
        named = named or bool(names & BOILERPLATE_NAMES)
        if not parent.article:
            junk, named = junk or tag == "header", named or "header" in names
    return _Open(tag, junk, parent.article, named, comment), hidden


def _hidden(a: dict[str, str]) -> bool:
    return "hidden" in a or a.get("aria-hidden") == "true" or bool(re.search(r"display\s*:\s*none", a.get("style", "")))


def _skip(page: str, tag: str, pos: int) -> int:
    """End of the element whose start tag ends at ``pos``; ``pos`` itself if it is not closed."""
    if tag in RAW:
        end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, pos)
        return end.end() if end else len(page)
    depth = 1
    for m in re.compile(rf"<(/?){re.escape(tag)}(?=[\s/>])[^>]*(/?)>", re.I).finditer(page, pos):
        depth += -1 if m[1] else 0 if m[0].endswith("/>") else 1
        if not depth:
            return m.end()
    return pos


def blocks_of(page: str) -> list[Block]:
    """Blocks with text, in page order.  Mis-nested and unclosed elements are
    closed where an enclosing one closes, or at the end."""
    stack, out, parts = [_Open("", False, False)], [], []
    link, link_chars, pos = 0, 0, 0
    comments, framed, elsewhere = 0, set(), False

    def flush():
        nonlocal link, link_chars, elsewhere
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            top = stack[-1]
            byline = top.article and any(x.tag == "header" for x in stack) and not any(x.tag in HEADINGS for x in stack)
            if top.tag in HEADINGS:
                elsewhere = bool(ELSEWHERE.fullmatch(text))
            out.append(Block(top.tag, text, link_chars, top.boilerplate or byline, top.article, top.named, top.comment, elsewhere))
        parts.clear()
        link, link_chars = 0, 0

    def text(upto: int):
        nonlocal link_chars
        if upto > pos:
            parts.append(page[pos:upto])
            if link:
                link_chars += upto - pos

    while m := _TOKEN.search(page, pos):
        text(m.start())
        pos = m.end()
        if not m[2]:
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if closing:
            if tag in BLOCKS:
                flush()
                at = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag), 0)
                if at:
                    del stack[at:]
            elif tag == "a":
                link = 0
            continue
        if tag in SKIPPED and not (tag in ("svg", "math") and m[3].endswith("/")):
            pos = _skip(page, tag, pos)
            continue
        if tag not in BLOCKS and tag not in VOID and ("hidden" in m[3] or "none" in m[3]) and _hidden(_attributes(m[3])):
            pos = _skip(page, tag, pos)
            continue
        if tag == "br" or tag == "img":
            parts.append(" ")
        if tag == "a":
            link = 1
        if tag not in BLOCKS:
            continue
        flush()
        if tag in ("p", "li", "dt", "dd", "td", "th", "tr", "option") or tag in HEADINGS:
            # These end an open one of their kind; a block ends an open paragraph.
            if stack[-1].tag == tag or stack[-1].tag in HEADINGS and tag in HEADINGS:
                stack.pop()
        if len(stack) > 1 and stack[-1].tag == "p":
            stack.pop()
        if tag in VOID:
            continue
        state, hidden = _opened(tag, m[3], stack[-1])
        if state.comment < 0:
            comments += 1
            state.comment = comments
        if state.comment and tag in ("main", "h1"):
            framed.add(state.comment)
        stack.append(_Open(tag, state.boilerplate or hidden, state.article or tag == "main" and not (state.boilerplate or state.named),
                           state.named, state.comment))
    text(len(page))
    flush()
    for b in out:
        if b.comment in framed:
            b.comment = 0
    return out


def _words(text: str) -> tuple[list[str], int]:
    """Words in lower case, and the length of a text in words."""
    words = _WORD.findall(text.lower())
    unspaced = len(_UNSPACED.findall(text))
    return words, len(words) if not unspaced else len(_WORD.findall(_UNSPACED.sub(" ", text))) + unspaced // 2


def _evidence(b: Block, framed: bool, known: bool) -> int:
    """Above zero for content, below for boilerplate; ``framed``: some article or main element holds text; ``known``: the
    page's language has stop words here."""
    words, n = _words(b.text)
    links = min(1.0, b.link_chars / max(1, len(b.text)))
    prose = sum(w in STOP_WORDS for w in words) >= STOPS * max(1, len(words)) if known else bool(_SENTENCE.search(b.text))
    if b.named:
        place = -2 - (framed and not b.article)
    else:
        place = 2 if b.article else -(framed and n >= SHORT)
    if b.elsewhere:
        place -= 5
    if links > MANY_LINKS:
        return place - (2 if n < SHORT and b.tag != "li" or b.tag in HEADINGS else 3)
    if n >= LONG:
        return place + (2 if prose or links <= SOME_LINKS and n >= 2 * LONG else -1)
    return place + (n >= SHORT and prose and links <= SOME_LINKS and b.tag not in HEADINGS)


def classify(blocks: list[Block]) -> None:
    """Both passes; sets ``good`` of every block."""
    framed = any(b.article and not (b.boilerplate or b.comment) for b in blocks)
    words = [w for b in blocks if not b.boilerplate for w in _WORD.findall(b.text.lower())]
    known = 20 * sum(w in STOP_WORDS for w in words) >= len(words)
    rest = [b for b in blocks if not (b.boilerplate or b.comment)]
    spared = any(b.comment for b in blocks) and not any(_evidence(b, framed, known) > 0 for b in rest)
    for b in blocks:
        if b.boilerplate or b.comment and not spared:
            b.good = False
        elif evidence := _evidence(b, framed, known):
            b.good = evidence > 0
    before, last = [], None                 # nearest decided block to the left of each: (distance, class)
    for i, b in enumerate(blocks):
        last = (i, b.good) if b.good is not None else last
        before.append(last)
    last = None
    for i in range(len(blocks) - 1, -1, -1):
        b = blocks[i]
        if b.good is not None:
            last = (i, b.good)
            continue
        left, right = before[i], last
        if b.tag in HEADINGS and right:      # a heading goes with what it heads
            left = None
        if left and right and left[1] != right[1] and i - left[0] == right[0] - i:
            right = left = (0, False)        # between the two: left out
        near = min((x for x in (left, right) if x), key=lambda x: abs(x[0] - i), default=(0, True))
        b.good = near[1]


def main_text(page: str | None) -> str:
    """Content blocks joined by line feeds; empty for null, empty or text-free pages."""
    if not page:
        return ""
    blocks = blocks_of(page)
    classify(blocks)
    return "\n".join(b.text for b in blocks if b.good)


def extract(pages: DataFrame, key: str = "page_id", source: str = "html", carry: tuple[str, ...] = ("url",)) -> DataFrame:
    """``key``, the columns ``carry``, ``text`` and ``n_chars`` of every row of
    ``pages``.  Nulls are empty pages; equal rows are extracted alike; null keys are returned; an empty table gives no
    rows; other columns are ignored, whatever their names."""
    schema = ", ".join([f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in (key, *carry)] + ["text string", "n_chars long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column("_html")]
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=[key, *carry, "text", "n_chars"])

    return pages.select(key, *carry, F.col(source).alias("_html")).mapInArrow(run, schema)

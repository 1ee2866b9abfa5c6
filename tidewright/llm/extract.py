"""Main text of web pages from flat text blocks (operator 5).

A page is cut into the texts between block-level tags. A block is described by its own and its
neighbours' word counts and link densities (share of words inside links) and by where it stands:
under an element that says it is no content, under one that says it is, on a page that has such
an element at all, under a longer class or id with a word of the former kind, in a
bare container while the page's text stands in paragraphs; and by whether it holds a phrase that
asks the reader to do something (``CALLS``) or states rights or terms (``RIGHTS``; an article may). Headings are never set apart by class or id. An element
whose class as a whole is one of ``TALK_WORDS`` is set apart unless it starts with a heading. Content by class or id alone counts if it has
``LEAST_SHARE`` of the unlinked words that are not set apart. A decision tree decides; it is grown here from the
small table ``LABELLED``. Blocks that the tree keeps are joined in page order.

Everything about a page is in the page, so there is no shuffle and no state.

Edge cases: null and empty pages give an empty text; unclosed and misnested elements close with
the element around them; an unclosed comment, script or tag runs to the end of the page; cut or
unknown character references stay as they are; repeated pages are extracted alike; an empty table
gives no rows; other columns are ignored.
"""
from __future__ import annotations

import html
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import per_process, pieces

# Elements of HTML by what they do to text, and words that name parts of a page.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr br img".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
WITHOUT_TEXT = frozenset(
    "button canvas datalist fieldset head iframe map object optgroup option select svg template "
    "video audio".split())
RAW = "script|style|noscript|textarea|title|xmp|noembed|noframes"
ASIDE = frozenset("nav footer aside form menu dialog".split())
CONTENT = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LISTS = frozenset("ul ol dl menu".split())
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment "
    "comments consent cookie cookies copyright disclaimer disqus footer gdpr login masthead menu "
    "modal nav navbar navigation newsletter notice notices notification pager pagination popup "
    "promo promoted promotion recommended related reply replies respond search share sharing "
    "sidebar signup skip social sponsor sponsored subscribe subscription tags toolbar topbar "
    "widget".split())
ASIDE_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation "
    "search toolbar".split())
COMMENT_WORDS = frozenset("comment comments disqus reply replies respond".split())
TALK_WORDS = frozenset("discussion feedback responses thread threads".split())
BARE = frozenset("div section center font span".split())
CALLS = re.compile(
    r"\b(?:subscribe|sign ?up|newsletter|log ?in|contact us|follow us|share (?:this|on|with)|tell a friend"
    r"|buy (?:now|our|your)|shop now|order now|half price|free trial|advertisement|sponsored"
    r"|we use cookies"
    r"|read (?:more|next|also)|(?:next|previous|related|more) (?:story|stories|articles?|posts?|pages?)"
    r"|you may also like|leave a (?:comment|reply)|print this|click here|back to top|skip to)\b", re.I)
RIGHTS = re.compile(
    r"\b(?:all rights reserved|cookie policy|privacy policy|terms of (?:use|service))\b", re.I)
MOST_CALLING = 40  # words of a block that is searched for such a phrase
LEAST_SHARE = 0.2
MOST_BARE = 0.25  # share of a page's unlinked words in bare containers, up to which these stand out
CONTENT_WORDS = frozenset("article content entry main post story".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{RAW})(?=[\s/>])(?P<rawattrs>(?:[^>\"']|\"[^\"<]*\"|'[^'<]*')*)>"
    r".*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"<]*\"|'[^'<]*')*|[^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)", re.I | re.S)
_ATTR = re.compile(r"(class|id|role|style|hidden|aria-hidden)(?=[\s=/]|\Z)"
                   r"(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


NOWHERE = ("",) + (False,) * 6


class Block(NamedTuple):
    text: str
    words: int
    linked: int
    aside: bool
    content: bool
    heading: bool
    listed: bool
    weak: bool = False  # content by class or id alone
    hinted: bool = False  # in the content, under a longer class or id that holds a word of ASIDE_WORDS
    bare: bool = False  # directly in an element of BARE
    calls: int = 0  # short and with a phrase of RIGHTS (1) or CALLS (2)


def _hints(attrs: str) -> tuple[set[str], set[str], bool, bool, bool]:
    """Words of class and id, roles, whether the element is hidden, whether a class or id as a
    whole, or a word of a class for comments, sets it apart, and whether a class is one of talk."""
    words, roles, hidden, surely, talk = set(), set(), False, False, False
    for name, *values in _ATTR.findall(attrs):
        name, value = name.lower(), next((v for v in values if v), "")
        if name in ("class", "id"):
            for token in value.split():
                found = {w.lower() for w in _WORD.findall(token)}
                words |= found
                surely |= bool(found) and found <= ASIDE_WORDS or name == "class" and bool(
                    found & COMMENT_WORDS)
                talk |= name == "class" and bool(found) and found <= TALK_WORDS
        elif name == "role":
            roles.update(value.lower().split())
        elif name == "style":
            hidden |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
        elif name == "hidden" or value.lower() == "true":
            hidden = True
    return words, roles, hidden, surely, talk


def _calls(text: str) -> int:
    return 2 if CALLS.search(text) else 1 if RIGHTS.search(text) else 0


def blocks(page: str) -> list[Block]:
    """Flat text blocks of a page in page order."""
    out: list[Block] = []
    # name, aside, content, silent, listed, weak, hinted
    stack: list[tuple[str, bool, bool, bool, bool, bool, bool]] = []
    aside = content = silent = listed = weak = hinted = False
    heading, links, holder = "", 0, ""
    talks: list[tuple[int, int]] = []  # depth of an element of talk, blocks before it
    parts: list[tuple[str, bool]] = []

    def close() -> None:
        if not parts:
            return
        text = " ".join("".join(t for t, _ in parts).split())
        if text:
            linked = sum(len(t.split()) for t, in_link in parts if in_link)
            words = len(text.split())
            out.append(Block(text, words, linked, aside, content, bool(heading), listed, weak, hinted,
                             holder in BARE, _calls(text) if words <= MOST_CALLING else 0))
        parts.clear()

    def leave(depth: int) -> tuple[str, bool, bool, bool, bool, bool, bool]:
        """Ends the elements from this depth on; the element that is left on top."""
        del stack[depth:]
        while talks and talks[-1][0] >= depth:
            start = talks.pop()[1]
            if start < len(out) and not out[start].heading:
                out[start:] = [b._replace(aside=True) for b in out[start:]]
        return stack[-1] if stack else NOWHERE

    def add(raw: str) -> None:
        if raw and not silent:
            parts.append((html.unescape(raw) if "&" in raw else raw, links > 0))

    at = 0
    for tag in _TAG.finditer(page):
        add(page[at:tag.start()])
        at = tag.end()
        name = tag["name"]
        if name is None:
            if tag["raw"] and not silent:
                parts.append((" ", links > 0))
            continue
        name = name.lower()
        if tag["end"]:
            if name == "a":
                links = max(0, links - 1)
            if name not in INLINE:
                close()
            if name == heading:
                heading = ""
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    close()
                    _, aside, content, silent, listed, weak, hinted = leave(depth)
                    break
            if name not in INLINE:
                holder = stack[-1][0] if stack else ""
            continue
        if name == "br":
            add(" ")
            continue
        if name not in INLINE:
            close()
            links = 0
            heading = ""
            if stack and stack[-1][0] == "p" or stack and stack[-1][0] == "li" == name:
                _, aside, content, silent, listed, weak, hinted = leave(len(stack) - 1)
            holder = name
        if name == "a":
            links += 1
        if name in VOID:
            continue
        attrs = tag["attrs"]
        words, roles, hidden, surely, talk = (
            _hints(attrs) if attrs and not attrs.isspace() else (set(), set(), False, False, False))
        if tag["attrs"].endswith("/") and name in ("svg", "path"):
            continue
        if name in HEADINGS:
            heading = name
        if name in ("html", "body"):
            words, roles = set(), set()
        elif name in HEADINGS:
            words = set()
        # A hint inside the content is a verdict only if it is all of a class or id.
        partly = content and name not in CONTENT and not surely and bool(words & ASIDE_WORDS)
        apart = (name in ASIDE or bool(roles & ASIDE_ROLES) or hidden
                 or not partly and bool(
                     words & (ASIDE_WORDS if name not in CONTENT else {"comment", "comments"}))
                 or not content and (name == "header" or "header" in words))
        within = name in CONTENT or "main" in roles
        by_word = not content and not within and name not in INLINE and bool(words & CONTENT_WORDS)
        mute = name in WITHOUT_TEXT
        if apart or within or by_word or partly or mute or name in LISTS or name not in INLINE and name not in (
                "p", "html", "body", "tr", "td", "th", "tbody", "thead", *HEADINGS):
            if (apart or partly or mute) and not (aside and silent):
                close()  # an inline element set apart is a block of its own
            if talk and name in BARE:
                talks.append((len(stack), len(out)))
            stack.append((name, aside or apart, content or within or by_word, silent or mute,
                          listed or name in LISTS, not within and (weak or by_word), hinted or partly))
            _, aside, content, silent, listed, weak, hinted = stack[-1]
    add(page[at:])
    close()
    leave(0)
    return out


FEATURES = ("place", "words", "density", "words_before", "density_before", "words_after",
            "density_after", "hinted", "loose", "calls")
# Places: under an element apart, outside the content element, on a page that has none, inside it.
APART, OUTSIDE, ANYWHERE, INSIDE = range(4)


def describe(page: list[Block]) -> np.ndarray:
    """A row of features per block."""
    words = np.array([0, *(b.words for b in page), 0], float)
    density = np.array([0, *(b.linked / b.words for b in page), 0], float)
    inside = [b.content and not b.aside for b in page]
    if not any(x and not b.weak for x, b in zip(inside, page)):
        free = [0 if b.aside else b.words - b.linked for b in page]
        share = sum(n for x, n in zip(inside, free) if x)
        if share < LEAST_SHARE * sum(free):
            inside = [False] * len(page)
    has_content = any(inside)
    place = [APART if b.aside else INSIDE if x else OUTSIDE if has_content else ANYWHERE
             for b, x in zip(page, inside)]
    return np.column_stack([place, words[1:-1], density[1:-1], words[:-2], density[:-2], words[2:],
                            density[2:], [b.hinted for b in page],
                            _loose(page), [b.calls for b in page]])


def _loose(page: list[Block]) -> list[bool]:
    """Blocks in bare containers of a page whose unlinked words mostly stand in other elements."""
    free = [0 if b.aside else b.words - b.linked for b in page]
    bare = sum(n for n, b in zip(free, page) if b.bare)
    return [b.bare and not b.heading and bare <= MOST_BARE * sum(free) for b in page]


#: Small labelled pages. A line is a page; a block is + (main text) or -, its words, of those in
#: links, and letters for where it stands: a under an element apart, c under a content element,
#: h heading, l list, p under a longer class or id with a word that sets apart, d in a bare container,
#: q with a phrase that asks for something, r with one that states rights. Neighbours follow from the order.
LABELLED = """
-1/1al -1/1al -2/2al -14/0a +9/0ch +34/0c +120/0c +3/0c +1/0c +52/2c -9/0a
-1/1al -1/1al -3/0a +1/0ch +1/0c +1/0c -4/0a
-1/1al -30/0a +12/0ch +8/0c +44/3c +16/0cl +22/0cl +6/6c -12/0a
-2/2al -2/2al -60/0a +7/0ch +300/0c +2/0ch +210/1c -80/0ac -45/0ac -7/1a
-6/0a -1/1al -25/0a +10/0c +25/0c +14/0c -33/0a -21/0a -5/5a -16/0
-1/1 -1/1 -4/0h -5/0 +6/0ch +18/0c +95/0c +5/5c +2/0c -11/0 -3/3 -40/2
-20/0 -2/2l -2/2l +11/0ch +1/0cl +3/0cl +70/0c -26/0 -90/0 -4/0
-3/3 -2/2 -14/0 +2/0c +33/0c +8/0c -55/0ac -70/0ac -2/0
-8/0 -12/1 +400/4c -7/0ac -6/6ac +250/0c -15/0
-1/1 -1/1 -1/1 +8/0h +45/0 +61/1 +38/0 +90/2 -4/4 -3/3 -5/1
-1/1l -1/1l -2/2l +6/0h +28/0 +140/3 +12/0h +77/0 +55/0 -6/6l -5/5l -7/0
-2/2 -3/3 -2/2 -1/1 +9/0h +22/1 +48/0 +33/0 -9/0a -12/0a -2/2
-4/2 -5/5l -4/4l +31/0 +18/0 +66/0 +9/0 +40/0 -3/0h -7/7l -6/6l -8/8l -4/0
-18/0a -22/0a -1/1al +30/0 +24/0 +41/0 -17/0a -36/0a -70/0a
-1/1 -2/1 -1/0 +5/0h +19/0l +25/0l +36/0l +52/0 -2/2 -1/1 -6/0
-3/3l -3/3l -3/3l -40/38 +7/0h +150/6 +88/0 -30/29 -6/4 -3/0
+16/0 +64/0 +4/0 +51/1 -2/2
+700/12
+85/0 +60/0
+13/0h +26/0 +17/0 -1/1 -1/1
-1/1al -1/1al -1/1al -5/0a
-2/2 -1/1 -3/3 -2/2
-1/1 -2/2 +8/0ch +40/1c +12/0c
-1/1al -1/1al +6/0ch +90/2c +5/0c
-3/0a +4/0ch +30/0c +2/0c
-1/1 +7/0ch +55/3c +20/0c +33/0c
-6/0 +9/0c
+14/0c
+3/0c
+25/0c +1/0c
+2/0ch +18/0c +26/0cl
-1/1 +30/0c
-1/1al -2/2 +11/0ch +60/0c +8/0ch +14/0c
+9/0ch +44/0c +3/0chp +38/0cp +6/0cp +27/1cp -5/0
-2/2 +5/0ch +70/1c +2/0chp +120/4cp +4/0cp +16/0cp
+6/0ch +35/0c -4/4cp -3/3cp -5/5cp +22/0c -6/0
-2/2 -1/1 +8/0h +80/0 +31/0 +14/0
-3/3 +7/0h +60/0 +24/0
+30/0c +6/6c +3/0c
+8/8cl +5/0c
+40/0c +4/4c +2/0c
+9/5c +6/0c
+12/12c +1/0c
-10/5 -12/8 +7/0h +60/2 +45/1 +20/0 -20/10 -16/6 -9/6 -14/12
-30/12 -9/3 +90/0 +34/1 -25/10 -7/5 -12/6
+30/0c -8/5cp -12/7cp -6/4cp +20/0c -10/6cp
+30/0c +3/0c +4/4c +2/0c +8/8c +5/0c +3/3c +1/0c -2/2 -5/5
+9/9cl +2/0c +7/7c +12/12cl +100/0c +5/5cl +6/6cl +20/20cl +3/0ch +4/4cl -3/3al
-1/1 -3/3 +6/0c +2/2cl +3/3cl +9/0c +14/14c +1/0ch +95/95c +40/0c +8/0c -4/4 -9/9
+2/2cl +3/3cl +4/4cl +8/0ch +9/7cl +3/2cl +2/0c +10/9c +1/1c
-2/2 -4/4 +3/0ch +5/0c +60/50c +6/0c +6/6c +7/0cl -8/8 -2/2
-8/0ah -30/0a +7/0ch +61/0c -12/0a
-6/0ah +6/0h +64/0 -9/0a -14/0ah -66/0a -3/0a -62/0a -11/0ah -25/0a
-12/0ah -5/0a +64/0c -10/0a -60/0a -7/0a
-7/0h -20/0 +9/0ch +63/0c -12/0 -62/0 -8/0 -9/0h -61/0 -5/0h -40/0 -12/0h -64/0 -10/0
+4/0ch +10/0c +1/0c +2/1cl +2/0cl -3/0a
-1/1al +12/0ch +3/1c +40/0c +4/2cl +6/3cl -2/0
+8/0ch +51/2c -2/2clp -9/9clp -11/10clp
-1/1 -2/2 +1/0h +40/0 +9/5 +50/0 +5/0 -6/0q -7/0q
-2/2l -3/3l +3/0h +35/1 +11/6 +28/0 +4/0 -8/0q -3/3
+2/0h +60/0 +14/8 +33/2 +7/0 -2/2 -1/1
-1/1 +3/0h +24/0 +44/0 +6/0 -9/0q
-4/4 -3/3 +1/0h +70/3 +8/5 +90/1 +25/0 +3/0 -10/1q -6/6 -5/5
+2/0h +30/0 +2/0h +45/0 +6/0
-2/2 -1/1 +1/0h +27/0 +2/0h +38/2 +1/0h +64/0 +8/0 -4/4l -5/5l
-3/3 -1/0 -2/2 +4/0h +55/0 -8/8 +47/1 +7/4 +39/0 -12/0q -2/0 -3/3
-5/0d -3/3d +2/0h +80/0 +6/0 -4/4d -7/0dq -5/5d
-2/0h -5/5l -6/6l -4/4l +1/0h +31/0 +12/7 +42/0 +2/0 -2/0h -6/6l -5/5l
+52/0q +31/0 -11/0q -4/0q
+48/1 +36/0q +3/0
+6/0ch +60/0c -8/0cdq +44/0c -3/3cdq -7/0cq +5/0c
+40/0c -3/3cd +35/0c -9/9cd +12/0c
+6/0cd +80/0c +11/0cd +60/0c +3/0cd
+60/2cq +50/0c -7/0cdq +24/0cq +31/0cq
+5/0ch +33/0c -6/0cq -4/4cq +48/0c -5/5cd -12/0cdq
+9/0cd +45/0c -7/6cd +70/0c +28/0c +34/9c -2/2cdq -9/2cq
-2/2 +3/0h +50/0 +41/0 +5/0 -6/0q -2/2
+1/0h +28/0 +36/0 +6/0 -7/7 -5/5
-1/1 +2/0h +49/0 +31/0 +4/0 -3/0h -6/6l -4/4l
+2/0h +45/0 +3/0 -2/0h -5/5l -7/7l -3/3l
+3/0h +62/1 +7/0 -4/0h -8/8 -6/6 -3/0h -9/9
+1/0h +44/0 +10/5 +40/0 +12/7 +61/0 +14/8 +29/0
+2/0h +58/0 +9/5 +36/0 -6/6 +40/0 -9/9 +52/0 +6/0
+39/0 +8/4 +57/0 +1/0 +66/0 +2/0 +90/0 +5/3 +48/0
+5/0ch +9/9c +70/0c +5/5cl +90/0c +12/12c +64/0c +3/3c +120/1c +6/4c +58/0c
+2/2c +61/0c +4/3cl +75/0c +20/20c +140/0c +1/1c +66/0c
-3/3 -2/0 -4/4 -1/0 +1/0h +26/0 +30/0 -1/1 -2/0 -3/3
+5/0ch +40/0c +3/0cr +62/0c +8/0cr
-2/2 +9/0ch +3/0cr +16/0c +3/0cr +30/0c
-2/2 +2/0h +50/0 +44/0 -4/0r
-1/1 +1/0h +33/0 +65/0 +6/0 -9/0r -2/2
+70/0 -3/0r -8/0r
-2/2 +4/0ch +28/0c +6/0cr +90/0c +12/0cr +55/0c +4/0cr
+7/0ch +60/0c +10/0cr +14/0cr +70/0c +5/0cr -6/0
+64/0c +3/0cr +8/0cr +35/0c +2/0cr +120/0c +17/0cr
+26/0 +58/0 -3/0r -2/2 -1/1
-2/2 +66/0 +39/0 -12/0r -3/0r -5/0r
-4/0 -2/2 -3/0 -5/5 -2/0h -6/6 -3/0h +3/0h +85/0 +4/0 +33/0 -5/0h -8/8l -9/9l
"""


def labelled() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels (1 for main text) of the labelled blocks."""
    rows, labels = [], []
    for line in LABELLED.split("\n"):
        page = []
        for block in line.split():
            words, linked, where = re.fullmatch(r"[+-](\d+)/(\d+)(\w*)", block).groups()
            page.append(Block("", int(words), int(linked), *(c in where for c in "achl"),
                              hinted="p" in where, bare="d" in where, calls=2 if "q" in where else int("r" in where)))
            labels.append(block[0] == "+")
        if page:
            rows.append(describe(page))
    return np.concatenate(rows), np.array(labels, float)


class Tree(NamedTuple):
    """Nodes side by side; a leaf has feature -1 and the share of label 1 as its value."""
    feature: np.ndarray
    value: np.ndarray
    below: np.ndarray
    above: np.ndarray

    def predict(self, rows: np.ndarray) -> np.ndarray:
        node = np.zeros(len(rows), np.int64)
        while True:
            feature = self.feature[node]
            inner = np.flatnonzero(feature >= 0)
            if not len(inner):
                return self.value[node]
            here = node[inner]
            low = rows[inner, feature[inner]] <= self.value[here]
            node[inner] = np.where(low, self.below[here], self.above[here])


def grow(rows: np.ndarray, labels: np.ndarray, deepest: int = 12, least: int = 2) -> Tree:
    """A tree by least Gini impurity; the first feature and lowest threshold win ties."""
    nodes: list[list[float]] = []

    def impurity(ones: np.ndarray, count: np.ndarray) -> np.ndarray:
        share = ones / np.maximum(count, 1)
        return count * share * (1 - share)

    def split(at: np.ndarray, depth: int) -> int:
        number, y = len(nodes), labels[at]
        nodes.append([-1, float(y.mean()), 0, 0])
        if depth == deepest or y.min() == y.max():
            return number
        best = (float(impurity(y.sum(), np.array(len(y)))) - 1e-9, -1, 0.0)
        for feature in range(rows.shape[1]):
            order = np.argsort(rows[at, feature], kind="stable")
            x, ones = rows[at, feature][order], np.cumsum(y[order])[:-1]
            count = np.arange(1, len(x))
            cost = impurity(ones, count) + impurity(y.sum() - ones, len(x) - count)
            cost[(x[1:] == x[:-1]) | (count < least) | (len(x) - count < least)] = np.inf
            if len(cost) and cost.min() < best[0]:
                i = int(cost.argmin())
                best = (float(cost[i]), feature, (x[i] + x[i + 1]) / 2)
        _, feature, value = best
        if feature >= 0:
            low = rows[at, feature] <= value
            nodes[number] = [feature, value, split(at[low], depth + 1), split(at[~low], depth + 1)]
        return number

    split(np.arange(len(labels)), 0)
    feature, value, below, above = zip(*nodes)
    return Tree(np.array(feature, np.int64), np.array(value), np.array(below, np.int64),
                np.array(above, np.int64))


def texts(pages: list[str], tree: Tree) -> list[str]:
    found = [blocks(page) for page in pages]
    rows = [describe(page) for page in found]
    keep = iter((tree.predict(np.concatenate(rows)) > 0.5).tolist() if rows else ())
    return [" ".join(b.text for b in page if next(keep)) for page in found]


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and the main text of every row."""
    def extracted(batches):
        tree = per_process(("tree",), lambda: grow(*labelled()))
        for batch in batches:
            for part in pieces(batch, "html"):
                found = texts(part.column("html").fill_null("").to_pylist(), tree)
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(found, pa.string())],
                    names=["page_id", "url", "text"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"),
                        F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(extracted, "page_id long, url string, text string")

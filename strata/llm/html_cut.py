"""Main text of web pages by minimum-cut labelling (operator 8).

A page is read into blocks of text in page order. A small linear classifier gives each block the
cost of being called boilerplate and that of being called content; these are the capacities of its
edges from the source and to the sink. Neighbouring blocks, and blocks of one container, are tied
by smoothness edges, stronger the nearer they stand in the tree. The minimum cut, found by
maximum flow, separates content from boilerplate at the least total cost.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.common import picked

# How HTML treats its elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Dropped with all they hold; select is a control of a form.
RAW = frozenset("script style template textarea iframe select title".split())
CODE = frozenset(["script", "style"])
DRAWN = frozenset(["math", "svg"])  # stand in a line of text, with all elements inside
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark math nobr object q rp rt ruby s "
    "samp small span strike strong sub sup svg time tt u var wbr".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# An element that a start tag closes, if it is the innermost open block.
CLOSED_BY = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
# Blocks a paragraph can't hold.
ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section table ul".split()
)

# The classifier: evidence for (positive) and against (negative) content, in thousandths.
CONTENT_TAGS = {"article": 4000, "main": 3000}
BOILERPLATE_TAGS = {"nav": -9000, "footer": -9000, "aside": -9000, "form": -9000, "button": -9000, "menu": -9000,
                    "dialog": -9000, "fieldset": -9000, "header": -5000}
CONTENT_WORDS = {"article": 1500, "content": 1500, "main": 1500, "post": 1000, "entry": 1000, "story": 1500, "body": 500}
BOILERPLATE_WORDS = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "copyright disqus footer form gdpr header legal login masthead menu modal nav navbar navigation newsletter "
    "notice pager pagination popup promo promotion related reply replies share sharing sidebar signup skip social "
    "respond responses sponsor sponsored subscribe subscription teaser toolbar widget".split()
)
# Endings that make no other word of a boilerplate word: commentlist, replylist, sidebarbox.
BOX_WORDS = ("area", "bar", "block", "box", "container", "form", "item", "list", "section", "thread", "wrap", "wrapper")
BOILERPLATE_WORD = -9000
NEVER_CHARGED = frozenset(["body", "html", "article", "main"])
# What follows one of these in a class or id tells how the page is laid out, not what the element is.
STATE_WORDS = frozenset("has is no not with without hide hides show shows enable enabled disable disabled".split())
# Shares of the page's text outside links from which an article is its chief one, and an element holds nearly all.
CHIEF_SHARE, WHOLE_SHARE = 0.25, 0.9
WORD_GAIN, MOST_WORDS = 60, 40  # for each word of the block, up to so many
SENTENCE_GAIN = 600
HEADING_GAIN = 600
LINK_LOSS = 4000  # times the share of characters in links
BIAS = -900
SMOOTH_PARENT, SMOOTH_GRAND, SMOOTH_FAR = 900, 450, 100
# Blocks whose elements' evidence differs by so much belong to different parts of the page, however near.
CONTRAST = 3000

_TAG = re.compile(r"<(?:!--|[!?]|/?[A-Za-z])")
# A quote counts only where a value begins. All parts are possessive, so a tag is read once, however it ends.
_OPEN = re.compile(r"""<(/?+)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)>""")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=][^\s>/=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++)))?+""")
_UNSEEN = re.compile(r"display\s*:\s*none", re.I)
_WORD = re.compile(r"[a-z]+")
_SENTENCE = re.compile(r"[.!?。！？…](?:\s|$)")


@dataclass
class Block:
    text: str
    path: tuple[int, ...]  # numbers of the three innermost open elements, the innermost last
    score: int  # evidence of tags, ids and classes
    linked: int  # characters in links
    heading: bool


@dataclass
class _Open:
    tag: str
    number: int
    parent: int  # number of the element around it, 0 for none
    score: int
    charge: int  # for the words of its ids and classes
    heading: bool
    own: int = 0  # characters outside links; in the end with those of the elements inside


def _is_boilerplate(name: str) -> bool:
    """Whether a class, id or role names boilerplate: cookie-notice does; has-sidebar and entry-header don't."""
    words = _WORD.findall(name)
    words = [next((w.removesuffix(b) for b in BOX_WORDS if w.removesuffix(b) in BOILERPLATE_WORDS), w) for w in words]
    words = words[: next((i for i, w in enumerate(words) if w in STATE_WORDS), None)]
    found = BOILERPLATE_WORDS.intersection(words)
    return bool(found) and not (found == {"header"} and any(w in CONTENT_WORDS for w in words))


def _attributes(text: str) -> dict[str, str]:
    """A tag's attributes by lower-case name; of repeated ones the first counts."""
    out: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), double or single or bare)
    return out


def _is_hidden(attributes: dict[str, str]) -> bool:
    return "hidden" in attributes or bool(_UNSEEN.search(attributes.get("style", "")))


def _evidence(tag: str, attributes: dict[str, str], inside: list[_Open]) -> tuple[int, int]:
    """The score of an element's tag and content words, and the charge for its boilerplate words."""
    score, charge = CONTENT_TAGS.get(tag, 0) + BOILERPLATE_TAGS.get(tag, 0), 0
    own_head = tag == "header" and any(o.tag == "article" for o in inside)
    if own_head:
        score = 0  # an article's own head
    for value in (attributes.get(name, "").lower() for name in ("id", "class", "role")):
        charged = any(_is_boilerplate(name) for name in value.split())
        charge += BOILERPLATE_WORD * charged
        if not charged or tag in NEVER_CHARGED:
            score += max((CONTENT_WORDS.get(w, 0) for w in _WORD.findall(value)), default=0)
    return score, 0 if own_head else charge


def _totals(elements: list[_Open], text: int) -> list[int]:
    """Each element's evidence with that of the elements around it; ``text``: the page's characters
    outside links.

    The charge isn't made for an element that holds the page's chief part or nearly all its text. The
    chief part is the first main element, or else the longest article, unless it is itself named
    boilerplate (a comment, a teaser) or is but a small part of the page.
    """
    for e in reversed(elements[1:]):
        elements[e.parent].own += e.own
    chief = next((e for e in elements if e.tag == "main"), None)
    if not chief:
        articles = [e for e in elements if e.tag == "article" and not e.charge]
        chief = max(articles, key=lambda e: e.own, default=None)
        if chief and chief.own < CHIEF_SHARE * text:
            chief = None
    around = set()
    while chief and chief.number:
        around.add(chief.number)
        chief = elements[chief.parent]
    totals = [0]
    for e in elements[1:]:
        waived = e.tag in NEVER_CHARGED or e.number in around or e.own >= max(1, WHOLE_SHARE * text)
        totals.append(totals[e.parent] + e.score + (0 if waived else e.charge))
    return totals


def blocks(page: str) -> list[Block]:
    """The text blocks of a page, in order. Unclosed and misplaced tags are taken as they come."""
    out: list[Block] = []
    stack: list[_Open] = []
    parts: list[str] = []
    elements = [_Open("", 0, 0, 0, 0, False)]  # by number
    linked, in_link, place, hidden, drawn = 0, False, 0, 0, 0
    endless: set[str] = set()  # elements that have no end tag from here on

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text and not hidden:
            inner = stack[-1] if stack else elements[0]
            near = tuple(o.number for o in stack[-3:])
            out.append(Block(text, near, 0, min(linked, len(text)), inner.heading))
            inner.own += len(text) - out[-1].linked
        parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            text = html.unescape(text)
            parts.append(text)
            linked += len(text) if in_link else 0

    def end_of(name: str) -> re.Match[str] | None:
        """The next end tag of an element; each search that fails is made once."""
        end = None if name in endless else re.compile(f"</{re.escape(name)}\\s*>", re.I).search(page, place)
        if not end:
            endless.add(name)
        return end

    def close(upto: int) -> None:
        nonlocal hidden
        for closed in stack[upto:]:
            hidden -= closed.score == HIDDEN_SCORE
        del stack[upto:]

    while True:
        found = _TAG.search(page, place)
        if not found:
            add(page[place:])
            break
        add(page[place : found.start()])
        at = found.start()
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            place = len(page) if end < 0 else end + 3
            continue
        if page[at + 1] in "!?":
            end = page.find(">", at)
            place = len(page) if end < 0 else end + 1
            continue
        tag = _OPEN.match(page, at) if page.find(">", at) >= 0 else None
        if not tag:  # no tag ends after this: what is left is text
            add(page[at:])
            break
        place = tag.end()
        closing, name, attributes = tag[1], tag[2].lower(), tag[3]
        if name in RAW:
            if not closing and not attributes.endswith("/"):
                end = end_of(name)
                if end:
                    place = end.end()
                elif name in CODE:  # without an end: code up to the next tag
                    after = _TAG.search(page, place)
                    place = after.start() if after else len(page)
            continue
        if name in DRAWN and not closing and not attributes.endswith("/"):
            end = end_of(name)
            drawn = max(drawn, end.start() if end else 0)
            if end and _is_hidden(_attributes(attributes)):
                place = end.end()
                continue
        if name in INLINE or at < drawn:
            if name == "a":
                in_link = not closing
            elif name == "br":
                parts.append(" ")
            continue
        flush()
        in_link = False
        if name in VOID:
            continue
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag == name:
                    close(i)
                    break
            continue
        if name in ENDS_P and stack and stack[-1].tag == "p":
            close(len(stack) - 1)
        while stack and stack[-1].tag in CLOSED_BY.get(name, ()):
            close(len(stack) - 1)
        given = _attributes(attributes)
        score, charge = (HIDDEN_SCORE, 0) if _is_hidden(given) else _evidence(name, given, stack)
        hidden += score == HIDDEN_SCORE
        around = stack[-1] if stack else elements[0]
        stack.append(_Open(name, len(elements), around.number, score, charge, around.heading or name in HEADINGS))
        elements.append(stack[-1])
    flush()
    totals = _totals(elements, sum(len(b.text) - b.linked for b in out))
    for block in out:
        block.score = totals[block.path[-1]] if block.path else 0
    return out


HIDDEN_SCORE = -10**9


def costs(block: Block) -> int:
    """Evidence for content (positive) or boilerplate (negative)."""
    score = block.score + BIAS + WORD_GAIN * min(len(block.text.split()), MOST_WORDS)
    score += SENTENCE_GAIN * bool(_SENTENCE.search(block.text)) + HEADING_GAIN * block.heading
    return score - LINK_LOSS * block.linked // len(block.text)


def smoothness(found: list[Block]) -> list[tuple[int, int, int]]:
    """Edges (i, j, capacity): page neighbours, and the next block of the same container."""
    edges = []
    last_in: dict[tuple[int, ...], int] = {}
    for j, block in enumerate(found):
        parent, grand = block.path[:-1], block.path[:-2]
        if j:
            before = found[j - 1].path
            near = SMOOTH_PARENT if before[:-1] == parent else SMOOTH_GRAND if before[:-2] == grand else SMOOTH_FAR
            if abs(block.score - found[j - 1].score) > CONTRAST:
                near = SMOOTH_FAR
            edges.append((j - 1, j, near))
        i = last_in.get(parent)
        if i is not None and i != j - 1:
            edges.append((i, j, SMOOTH_GRAND if abs(block.score - found[i].score) <= CONTRAST else SMOOTH_FAR))
        last_in[parent] = j
    return edges


def minimum_cut(terminals: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes stay with the source. ``terminals``: capacity from the source (positive) or to
    the sink (negative) of each node; ``edges`` carry flow both ways.

    Augments along shortest paths, level by level (Dinic). Nodes the sink can still be reached
    from are cut off, so ties go to the source.
    """
    n = len(terminals)
    source, sink = n, n + 1
    to: list[int] = []
    capacity: list[int] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def edge(a: int, b: int, there: int, back: int) -> None:
        for x, y, c in ((a, b, there), (b, a, back)):
            out[x].append(len(to))
            to.append(y)
            capacity.append(c)

    for i, c in enumerate(terminals):
        edge(*((source, i, c, 0) if c > 0 else (i, sink, -c, 0)))
    for i, j, c in edges:
        edge(i, j, c, c)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if capacity[e] and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            break
        following = [0] * (n + 2)
        path: list[int] = []
        node = source
        while True:
            if node == sink:
                flow = min(capacity[e] for e in path)
                for k, e in enumerate(path):
                    capacity[e] -= flow
                    capacity[e ^ 1] += flow
                cut = next(k for k, e in enumerate(path) if not capacity[e])
                node = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while following[node] < len(out[node]):
                e = out[node][following[node]]
                if capacity[e] and level[to[e]] == level[node] + 1:
                    break
                following[node] += 1
            if following[node] < len(out[node]):
                path.append(out[node][following[node]])
                node = to[path[-1]]
            elif path:
                e = path.pop()
                node = to[e ^ 1]
                following[node] += 1
            else:
                break
    reaches = [False] * (n + 2)
    reaches[sink] = True
    queue = deque([sink])
    while queue:
        b = queue.popleft()
        for e in out[b]:
            a = to[e]
            if capacity[e ^ 1] and not reaches[a]:
                reaches[a] = True
                queue.append(a)
    return [not r for r in reaches[:n]]


def main_text(page: str | None) -> str:
    """The blocks labelled content, joined by line feeds."""
    found = blocks(page or "")
    if not found:
        return ""
    labels = minimum_cut([costs(b) for b in found], smoothness(found))
    return "\n".join(b.text for b, content in zip(found, labels) if content)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page.as_py()) for page in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64()),
            ],
            names=["k", "u", "text", "n_chars"],
        )


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """Per row of ``pages``: ``key``, ``url``, ``text`` and ``n_chars`` (code points).

    A null or empty page, and one without content, has an empty text. Every row is read by itself,
    whole; repeated rows give repeated results, null keys and urls are handed through.
    """
    rows = picked(pages, {"k": key, "u": url, "h": page})
    kinds = dict(rows.dtypes)
    out = rows.mapInArrow(_extract, f"k {kinds['k']}, u {kinds['u']}, text string, n_chars long")
    return out.withColumnsRenamed({"k": key, "u": url})

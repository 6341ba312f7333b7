"""Operator 8: main text of web pages by minimum-cut labelling.

A page becomes a row of text blocks. A linear classifier scores each block from
its text, its links and the elements around it; the score is the capacity of
the block's edge to the terminal *content* (if positive) or *boilerplate*.
Smoothness edges join blocks that follow each other and blocks that follow each
other within one container, the stronger the nearer they are in the tree. No
cue of a place is so strong that text, links and neighbours can't outweigh it;
only what a page hides is never shown. The maximum flow between the terminals gives the cheapest labelling; the
blocks left on the content side, in page order, are the main text.

Pages are independent: one mapping, no shuffle. The classifier's weights follow
from stated inequalities (below), as there are no labelled pages to fit them on.

Defined results: null or empty html, or no block on the content side, is the
empty text with 0 characters; broken markup is read as far as it goes; rows
with the same id are extracted each; pages of any length are read whole.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque

from pyspark.sql import DataFrame

from .common import map_batches

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
CUE_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+(?![a-z])")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is never text of the page.
SKIPPED = frozenset("script style title textarea noscript template svg math iframe object select button canvas audio video".split())
#: Elements that run on with the text around them; all others start a block.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: An element of these ends an open one of the same kind.
SELF_CLOSING = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CLOSED_BY_BLOCK = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul".split())

BAD_ELEMENTS = frozenset("nav footer aside form menu dialog fieldset".split())
GOOD_ELEMENTS = frozenset("article main".split())
#: Elements of the bad ones that only say how the page works, so they may also frame all of it.
FORMS = frozenset("form fieldset".split())
BAD_WORDS = frozenset(
    """ad ads advert advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs
    footer masthead topbar sidebar aside widget cookie cookies consent notice notices notification alert popup modal overlay newsletter
    subscribe signup login search share sharing social related recommended recommendations comment comments reply replies respond
    disqus discussion copyright legal pagination pager toolbar skip complementary contentinfo""".split()
)
GOOD_WORDS = frozenset("article main content post entry story body text".split())

#: The classifier: score of a block, positive for content. There are no labelled pages, so
#: the weights are set by these inequalities (the tests hold them):
#: 1. no cue decides alone: a long text between content can outweigh a bad place
#:    (BASE + LONGEST + SENTENCE + 2 * SIBLING * OTHER_PLACE > -BAD_PLACE), and links a good one
#:    (BASE + LINKED + NO_SENTENCE < -GOOD_PLACE);
#: 2. a bad place that is a container of its own is never won by what surrounds it
#:    (BASE + LONGEST + SENTENCE + 2 * SIBLING * STEP * OTHER_PLACE < -BAD_PLACE);
#: 3. a heading without any cue goes with the paragraph after it, also if boilerplate stands
#:    before their container (BASE + NO_SENTENCE + PER_LENGTH * log2(1 + 6 / 20) > SIBLING * (STEP - 1));
#: 4. a lone sentence is not lost to links on both sides (BASE + SENTENCE + PER_LENGTH *
#:    log2(1 + 100 / 20) > 2 * SIBLING * (1 - CONTRAST)).
BAD_PLACE, GOOD_PLACE, HIDDEN = -6.0, 5.0, -99.0
LINKED, PER_LENGTH, LONGEST, SENTENCE, NO_SENTENCE, RIGHTS, BASE = -4.0, 0.7, 4.0, 1.0, -1.0, -3.0, -1.5
#: Smoothness of blocks side by side in one container; the factor for each step further apart in
#: the tree and for a change of place; what a difference of all in the share of linked text takes off.
SIBLING, STEP, OTHER_PLACE, CONTRAST = 3.0, 0.25, 0.5, 0.8


class Block:
    __slots__ = ("text", "linked", "place", "path")  # linked: characters of the text that lie in links

    def __init__(self, text: str, linked: int, place: int, path: tuple[int, ...]):
        self.text, self.linked, self.place, self.path = text, linked, place, path


def _place(tag: str, attributes: str, outer: int, frame: bool = False) -> int:
    """Whether an element is a bad (-1, not shown: -2) or good (1) place; ``outer`` where it says nothing.

    A ``frame`` is no bad place for its name, unless its element says so.
    """
    if (tag in BAD_ELEMENTS and not (frame and tag in FORMS)) or (tag == "header" and outer != 1):
        return -1
    if attributes:
        words = set()
        for name, value in ATTRIBUTE.findall(attributes):
            name = name.lower()
            if name in ("class", "id", "role"):
                words.update(w.lower() for w in CUE_WORD.findall(value))
            elif name == "hidden" or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
                return -2
            elif name == "aria-hidden" and "true" in value:
                return -1
        if not frame and (words & BAD_WORDS or ("header" in words and outer != 1)):
            return -1
        if outer == 0 and words & GOOD_WORDS:
            return 1
    return 1 if tag in GOOD_ELEMENTS and outer != -1 else outer


def _settle(found: list[Block], elements: list[tuple[str, str, int]]) -> None:
    """Turns the elements that the blocks lie in (``place``, numbers from 1) into places.

    html and body give no cue. An element with more than half of the page's text
    is a frame if it holds an article, main or heading of the page, or the page
    has none. An article or main in a bad place starts anew, as neutral.
    """
    parents = [0] + [e[2] for e in elements]
    chars = [0] * len(parents)
    for block in found:
        at = block.place
        while at:
            chars[at] += len(block.text)
            at = parents[at]
    half = sum(len(b.text) for b in found) / 2
    named, holds = [False], set()  # named: in an element that is never a frame
    for number, (tag, attributes, parent) in enumerate(elements, 1):
        named.append(named[parent] or tag == "header" or tag in BAD_ELEMENTS - FORMS)
        if (tag in GOOD_ELEMENTS or (tag == "h1" and not named[number])) and chars[number] and _place(tag, attributes, 0) >= 0:
            while number and number not in holds:
                holds.add(number)
                number = parents[number]
    places = [0]
    for number, (tag, attributes, parent) in enumerate(elements, 1):
        outer = places[parent]
        if tag in ("html", "body") or outer == -2:
            places.append(outer)
        elif outer == -1:
            own = _place(tag, attributes, 0)
            places.append(min(own, 0) if tag in GOOD_ELEMENTS else min(own, -1))
        else:
            places.append(_place(tag, attributes, outer, chars[number] > half and (not holds or number in holds)))
    for block in found:
        block.place = places[block.place]


def blocks(page: str) -> list[Block]:
    """The text blocks of a page, in order."""
    found: list[Block] = []
    stack: list[tuple[str, int]] = []  # element, number
    elements: list[tuple[str, str, int]] = []  # element, attributes, number of the one around it
    held: list[str] = []
    linked = anchors = at = 0
    skip_until = None

    def text(raw: str) -> None:
        nonlocal linked
        if raw:
            raw = html.unescape(raw)
            held.append(raw)
            if anchors:
                linked += len(raw.split()) and len(" ".join(raw.split()))

    def end_block() -> None:
        nonlocal linked
        if held:
            joined = " ".join("".join(held).split())
            if joined:
                found.append(Block(joined, linked, stack[-1][1] if stack else 0, tuple(s[1] for s in stack if s[0] not in INLINE)))
            held.clear()
        linked = 0

    def close(count: int) -> None:
        nonlocal anchors
        for tag, _ in stack[count:]:
            anchors -= tag == "a"
        del stack[count:]

    while True:
        token = TOKEN.search(page, at)
        if token is None:
            text(page[at:])
            break
        if token.start() > at:
            text(page[at : token.start()])
        at = token.end()
        tag = token[2]
        if tag is None:
            if token[0].startswith("<![CDATA["):
                text(html.escape(token[0][9:].removesuffix("]]>")))
            continue
        tag = tag.lower()
        if token[1]:
            where = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), None)
            if where is not None:
                if tag not in INLINE:
                    end_block()
                close(where)
            elif tag in ("p", "br"):
                end_block()
            continue
        if tag in SKIPPED:
            if not token[3].rstrip().endswith("/"):
                skip_until = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
                if tag not in INLINE:
                    held.append(" ") if tag in ("select", "button", "textarea") else None
                at = skip_until.end() if skip_until else len(page)
            continue
        if tag in ("br", "hr"):
            if tag == "br":
                held.append(" ")
            else:
                end_block()
            continue
        if tag in VOID:
            continue
        if tag not in INLINE:
            end_block()
            ends = SELF_CLOSING.get(tag, set()) | ({"p"} if tag in CLOSED_BY_BLOCK else set())
            if ends:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in ends:
                        close(k)
                        break
                    if stack[k][0] not in INLINE and stack[k][0] not in SELF_CLOSING:
                        break
        elements.append((tag, token[3], stack[-1][1] if stack else 0))
        stack.append((tag, len(elements)))
        anchors += tag == "a"
    end_block()
    _settle(found, elements)
    return found


def _link_share(block: Block) -> float:
    return min(1.0, block.linked / len(block.text))


def score(block: Block) -> float:
    """The classifier."""
    n = len(block.text)
    value = BASE + LINKED * _link_share(block) + min(LONGEST, PER_LENGTH * math.log2(1 + n / 20))
    value += SENTENCE if block.text[-1] in ".!?…:;\"'»”’)" else NO_SENTENCE
    if "©" in block.text or "all rights reserved" in block.text.lower():
        value += RIGHTS
    return value + (0.0, GOOD_PLACE, HIDDEN, BAD_PLACE)[block.place]


def _likeness(a: Block, b: Block) -> float:
    """Weight of an edge: by the steps up and down the tree from one block to the other, their places and links."""
    shared = 0
    for x, y in zip(a.path, b.path):
        if x != y:
            break
        shared += 1
    steps = max(0, len(a.path) + len(b.path) - 2 * shared - 2)
    weight = SIBLING * STEP**steps * (1 - CONTRAST * abs(_link_share(a) - _link_share(b)))
    return weight if a.place == b.place else weight * OTHER_PLACE


def smoothness(found: list[Block]) -> list[tuple[int, int, float]]:
    """(block, later block, weight) of the smoothness edges."""
    edges, last = [], {}
    for k, block in enumerate(found):
        if k:
            edges.append((k - 1, k, _likeness(found[k - 1], block)))
        before = {last[container] for container in block.path[-2:] if container in last} - {k - 1}
        edges += [(j, k, _likeness(found[j], block)) for j in sorted(before)]
        last.update(dict.fromkeys(block.path[-2:], k))
    return edges


def source_side(gains: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay with the source in a minimum cut (Dinic's maximum flow, in thousandths).

    A positive gain is the capacity from the source, a negative one to the sink.
    """
    n = len(gains)
    source, sink = n, n + 1
    head: list[list[int]] = [[] for _ in range(n + 2)]
    to, room = [], []

    def edge(a: int, b: int, there: int, back: int) -> None:
        head[a].append(len(to))
        to.append(b)
        room.append(there)
        head[b].append(len(to))
        to.append(a)
        room.append(back)

    for k, gain in enumerate(gains):
        units = round(gain * 1000)
        if units > 0:
            edge(source, k, units, 0)
        elif units < 0:
            edge(k, sink, -units, 0)
    for a, b, weight in edges:
        units = round(weight * 1000)
        if units:
            edge(a, b, units, units)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue and level[sink] < 0:
            a = queue.popleft()
            for e in head[a]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [lv >= 0 for lv in level[:n]]
        following = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                cut = next(k for k, e in enumerate(path) if not room[e])
                a = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while following[a] < len(head[a]):
                e = head[a][following[a]]
                if room[e] and level[to[e]] == level[a] + 1:
                    break
                following[a] += 1
            if following[a] < len(head[a]):
                path.append(head[a][following[a]])
                a = to[path[-1]]
            elif a == source:
                break
            else:
                a = to[path.pop() ^ 1]
                following[a] += 1


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    if not found:
        return ""
    kept = source_side([score(b) for b in found], smoothness(found))
    return " ".join(b.text for b, stays in zip(found, kept) if stays)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row."""

    def run(cols: dict[str, list]) -> dict[str, list]:
        texts = [main_text(p) for p in cols["html"]]
        return {"page_id": cols["page_id"], "url": cols["url"], "text": texts, "n_chars": [len(t) for t in texts]}

    rows = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].alias("url"), pages[html_col].alias("html"))
    return map_batches(rows, run, "page_id long, url string, text string, n_chars long")

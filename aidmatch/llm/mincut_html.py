"""Main text of web pages by minimum-cut labelling.

A page is read into text blocks. A logistic classifier, trained here on a few
labelled pages, gives each block a cost for either label; these costs are the
capacities to the two terminals. Blocks that follow each other, and blocks under
one parent, are joined by edges that weigh less the farther apart they stand in
the document tree. The minimum cut, found by maximum flow, is the cheapest
labelling, in which a short line inside an article follows its surroundings and
an advert between two paragraphs may still stand alone.
"""

from __future__ import annotations

import html as markup
import re
from collections import Counter, deque
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aidmatch.llm.html_labelled import LABELLED_PAGES

#: Weight of an edge between neighbours in one parent, and how fast it falls with each further step in the tree.
SMOOTH, FALL = 1.2, 0.45
STEPS, PENALTY = 40, 0.05

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HIDDEN = frozenset("script style noscript template head title textarea select button iframe object svg canvas audio video".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data dfn del em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
#: An element that opens closes the elements of these names that are open inside the nearest holder.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: What can stand in a head; all else ends it.
_IN_HEAD = frozenset("html head base basefont bgsound link meta title script style noscript template noframes".split())
#: Hidden elements that go on over other elements when their end tag is missing, and the blocks that then end them.
_OPEN_ENDED = frozenset("noscript select button object svg canvas audio video".split())
_BLOCKS = frozenset(
    "address article aside blockquote center dd details dialog div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 header li main nav ol p "
    "pre section table tbody td th tr ul".split()
)
#: Elements that an element of this name ends.
_ENDS = {"button": "button", "select": "select", "input": "select", "textarea": "select"}
_HOLDERS = frozenset("ul ol dl table tbody thead tfoot body html article section div main aside nav".split())

_TAGS = "nav footer header aside form article main section p li td pre blockquote h1 h2 h3 figure".split()
#: Words in classes and ids, by what they speak for.
_WORDS = {
    "content": "article content entry post story main text body".split(),
    "advert": "ad ads advert advertisement banner promo sponsor sponsored".split(),
    "comment": "comment comments reply replies discussion disqus respond".split(),
    "notice": "cookie cookies consent notice popup modal alert gdpr overlay newsletter subscribe signup".split(),
    "frame": "nav menu header footer sidebar aside breadcrumb breadcrumbs widget masthead topbar copyright toolbar".split(),
    "links": "share social related recommended tags pagination pager more".split(),
}
_SPLIT = re.compile(r"[^a-z0-9]+")
_RIGHTS = re.compile(r"©|(?i:copyright|all rights reserved)")


class Element(NamedTuple):
    """An open element with what its ancestors and it say: bits of ``_TAGS`` and ``_WORDS``, depth among block elements."""

    name: str
    number: int
    parent: int
    depth: int
    tags: int
    words: int
    label: str


class Block(NamedTuple):
    text: str
    linked: int
    inside: Element
    #: Depth of the nearest common ancestor with the block before.
    common: int


_ROOT = Element("", 0, 0, 0, 0, 0, "")
_TAG_BIT = {t: 1 << i for i, t in enumerate(_TAGS)}
_WORD_BIT = {w: 1 << i for i, words in enumerate(_WORDS.values()) for w in words}


#: One attribute; groups never give back what they have taken, so a page is read in time linear in its length.
_ATTRIBUTE = re.compile(r"""[\s/]*+([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?+""")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
_REST = re.compile(r"[\s/]*+")
_COMMENT_END = re.compile(r"--!?>")
#: Elements whose content is text up to their end tag; in the first two even references are plain text.
_PLAIN = ("script", "style", "title", "textarea", "noembed", "noframes", "iframe", "xmp")


def read_markup(page: str, to) -> None:
    """Give the tags and the text of a page, with references decoded, to ``to``'s handlers.

    What is still open at the end of the page, a comment or a tag, ends there with nothing.
    """
    at, size, raw, gone = 0, len(page), None, set()
    while at < size:
        if raw:  # up to the end tag, if there is one
            end = re.compile(rf"</{raw}(?=[\s/>])", re.I).search(page, at)
            text = page[at:end.start() if end else size]
            to.handle_data(text if raw in _PLAIN[:2] else markup.unescape(text))
            at, raw = end.start() if end else size, None
            continue
        low = page.find("<", at)
        if low < 0:
            to.handle_data(markup.unescape(page[at:]))
            return
        name = _NAME.match(page, low + 2 if page.startswith("/", low + 1) else low + 1)
        other = page[low + 1:low + 2] in ("!", "?") or page.startswith("</", low) and page[low + 2:low + 3] not in ("", ">")
        if low > at:
            to.handle_data(markup.unescape(page[at:low]))
        if name is None and not other:
            to.handle_data("<")  # only a sign, unless nothing stands in it
            at = low + 1
            continue
        if name is None:
            if page.startswith("<!--", low):
                # "<!-->" and "<!--->" are whole comments
                short = next((s for s in ("<!-->", "<!--->") if page.startswith(s, low)), None)
                end = None if short else _COMMENT_END.search(page, low + 4)
                at = low + len(short) if short else end.end() if end else size
            else:
                end = page.find(">", low)
                at = end + 1 if end >= 0 else size
            continue
        tag, closing, attributes = name.group().lower(), page[low + 1] == "/", {}
        at = name.end()
        while True:
            found = _ATTRIBUTE.match(page, at)
            if found is None:
                break
            value = next((v for v in found.groups()[1:] if v is not None), None)
            attributes.setdefault(found.group(1).lower(), value and markup.unescape(value))
            at = found.end()
        rest = _REST.match(page, at)
        at = rest.end()
        if at >= size:
            return
        # a stray sign such as "=" before the end of the tag
        end = at if page[at] == ">" else page.find(">", at)
        if end < 0:
            return
        itself = page[end - 1] == "/" and not closing
        at = end + 1
        if closing:
            to.handle_endtag(tag)
        elif itself:
            to.handle_startendtag(tag, attributes)
        else:
            to.handle_starttag(tag, attributes)
            raw = tag if tag in _PLAIN and tag not in gone else None
            if raw and not re.compile(rf"</{raw}(?=[\s/>])", re.I).search(page, at):
                gone.add(tag)  # searched for once: no later one has an end tag either
                if tag not in _PLAIN[:2]:
                    raw = None  # HTML would end the page here


class _Reader:
    """Reads a page into blocks; work per tag doesn't grow with the depth of the page.

    ``unclosed`` are the numbers of elements of ``_OPEN_ENDED`` that lack their
    end tag, known from an earlier reading: the first block in them ends them.
    """

    def __init__(self, unclosed: frozenset[int] = frozenset()):
        self.unclosed = unclosed
        self.lacking: set[int] = set()  # found without an end tag
        self.ending: list[Element] = []  # open elements of ``unclosed``
        self.open: list[Element] = []
        self.holders: list[Element] = [_ROOT]  # the open block elements
        self.names: Counter = Counter()
        self.blocks: list[Block] = []
        self.text: list[str] = []
        self.linked = self.count = self.hidden = self.lowest = 0

    def flush(self):
        text = " ".join("".join(self.text).split())
        if text:
            self.blocks.append(Block(text, self.linked, self.holders[-1], self.lowest))
            self.lowest = self.holders[-1].depth
        self.text, self.linked = [], 0

    def pop(self):
        last = self.open[-1]
        if last.name not in _INLINE:
            self.flush()
            self.holders.pop()
            self.lowest = min(self.lowest, self.holders[-1].depth)
        self.open.pop()
        self.names[last.name] -= 1
        self.hidden -= last.name in _HIDDEN
        if self.ending and self.ending[-1] is last:
            self.ending.pop()

    def drop(self):
        """Pop what has no end tag."""
        if self.open[-1].name in _OPEN_ENDED:
            self.lacking.add(self.open[-1].number)
        self.pop()

    def pop_to(self, name):
        while self.open[-1].name != name:
            self.drop()
        self.pop()

    def end_head(self):
        """Close an open head unless something in it, such as a template, holds what comes."""
        if self.names["head"] > 0 and (self.open[-1].name == "head" or self.open[-1].name == "noscript" and self.open[-2].name == "head"):
            self.pop_to("head")

    def handle_starttag(self, tag, attrs):
        if tag not in _IN_HEAD:
            self.end_head()
        elif tag == "head" and any(e.name != "html" for e in self.open):
            return
        ends = _ENDS.get(tag)
        if ends and self.names[ends] > 0:
            while self.open[-1].name != ends:
                self.drop()
            self.drop()
        if self.ending and tag in _BLOCKS:
            first = self.ending[0]
            while self.ending and self.ending[0] is first:
                self.drop()
        if tag in _VOID:
            self.text.append(" ")
            if tag == "hr":
                self.flush()
            return
        inline = tag in _INLINE
        if not inline:
            self.flush()
            while self.names["p"] > 0 and tag not in _HIDDEN:
                self.pop_to("p")
            closes = _CLOSES.get(tag, ())
            while any(self.names[c] > 0 for c in closes):
                at = next((e.name for e in reversed(self.open) if e.name in closes or e.name in _HOLDERS), "")
                if at not in closes:
                    break
                self.pop_to(at)
        self.count += 1
        up, words = self.holders[-1], 0
        # names of the whole page say nothing about a block
        if tag not in ("html", "body"):
            for w in _SPLIT.split(f"{attrs.get('class') or ''} {attrs.get('id') or ''} {attrs.get('role') or ''}".lower()):
                words |= _WORD_BIT.get(w, 0)
        here = Element(
            tag, self.count, up.number, up.depth + 1, up.tags | _TAG_BIT.get(tag, 0), up.words | words, attrs.get("data-y") or up.label
        )
        self.open.append(here)
        if not inline:
            self.holders.append(here)
        self.names[tag] += 1
        self.hidden += tag in _HIDDEN
        if self.count in self.unclosed:
            self.ending.append(here)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID and self.open and self.open[-1].name == tag:
            self.pop()

    def handle_endtag(self, tag):
        if tag == "br":
            self.text.append(" ")
        elif self.names[tag] > 0:
            self.pop_to(tag)
        elif tag == "p":
            self.flush()

    def handle_data(self, data):
        if self.names["head"] > 0 and self.open[-1].name == "head" and data.strip():
            self.end_head()
        if not self.hidden:
            self.text.append(data)
            if self.names["a"] > 0:
                self.linked += len(data)

    def done(self) -> list[Block]:
        while self.open:
            self.drop()
        self.flush()
        return self.blocks


def blocks_of(html: str) -> list[Block]:
    """The page's text blocks; pages with hidden elements that lack their end tag are read a second time."""
    reader = _Reader()
    read_markup(html, reader)
    blocks = reader.done()
    if not reader.lacking:
        return blocks
    reader = _Reader(frozenset(reader.lacking))
    read_markup(html, reader)
    return reader.done()


def features(block: Block) -> list[float]:
    text, inside = block.text, block.inside
    return [
        1.0, *(float(inside.tags >> i & 1) for i in range(len(_TAGS))), *(float(inside.words >> i & 1) for i in range(len(_WORDS))),
        min(1.0, block.linked / len(text)), min(np.log1p(len(text)) / 6, 1.5), float(text[-1] in ".!?:;\"”»…"), float(bool(_RIGHTS.search(text))),
    ]


def train(pages: list[str] = LABELLED_PAGES) -> np.ndarray:
    """Weights of the block classifier, by Newton steps on the labelled pages."""
    rows, labels = [], []
    for page in pages:
        for block in blocks_of(page):
            rows.append(features(block))
            labels.append(block.inside.label == "1")
    x, y = np.array(rows), np.array(labels, dtype=float)
    weights = np.zeros(x.shape[1])
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-x @ weights))
        weights += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(len(weights)) * PENALTY, x.T @ (y - p) - PENALTY * weights)
    return weights


def edges_of(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness edges: neighbours in page order, and neighbours under one parent that others stand between."""
    edges, last = [], {}
    for i, block in enumerate(blocks):
        if i:
            steps = block.inside.depth + blocks[i - 1].inside.depth - 2 * block.common
            edges.append((i - 1, i, SMOOTH * FALL ** max(0, steps - 2)))
        parent = block.inside.parent
        if last.get(parent, i - 1) < i - 1:
            edges.append((last[parent], i, SMOOTH / 2))
        last[parent] = i
    return edges


def min_cut(costs: np.ndarray, edges: list[tuple[int, int, float]]) -> np.ndarray:
    """Which nodes stay with the source in a minimum cut.

    ``costs`` are gains of the source label where positive, of the sink label
    where negative: of the two terminal edges of a node only the difference is
    left after the flow straight through it. Blocking flows over shortest paths.
    """
    n = len(costs)
    room = [float(abs(c)) for c in costs]  # left at the node's terminal edge
    ways: list[list[int]] = [[] for _ in range(n)]
    to, left = [], []
    for a, b, w in edges:
        ways[a].append(len(to))
        ways[b].append(len(to) + 1)
        to += [b, a]
        left += [w, w]
    tiny = 1e-9
    while True:
        level = [-1] * n
        queue = deque(i for i in range(n) if costs[i] > 0 and room[i] > tiny)
        for i in queue:
            level[i] = 0
        reached = False
        while queue:
            i = queue.popleft()
            reached = reached or costs[i] < 0 and room[i] > tiny
            for e in ways[i]:
                if left[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[i] + 1
                    queue.append(to[e])
        if not reached:
            return np.array([x >= 0 for x in level])
        turn = [0] * n
        for start in (i for i in range(n) if costs[i] > 0):
            while room[start] > tiny:
                path, at = [], start
                while not (costs[at] < 0 and room[at] > tiny):
                    while turn[at] < len(ways[at]):
                        e = ways[at][turn[at]]
                        if left[e] > tiny and level[to[e]] == level[at] + 1:
                            break
                        turn[at] += 1
                    if turn[at] < len(ways[at]):
                        path.append(e)
                        at = to[e]
                    elif path:
                        at = to[path.pop() ^ 1]
                        turn[at] += 1
                    else:
                        break
                else:
                    amount = min([room[start], room[at], *(left[e] for e in path)])
                    room[start] -= amount
                    room[at] -= amount
                    for e in path:
                        left[e] -= amount
                        left[e ^ 1] += amount
                    continue
                break


def main_text(html: str, weights: np.ndarray) -> str:
    """Content blocks in page order, joined by blank lines."""
    blocks = blocks_of(html)
    if not blocks:
        return ""
    # log odds: the difference of the two costs of a block
    costs = np.clip(np.array([features(b) for b in blocks]) @ weights, -20, 20)
    return "\n\n".join(b.text for b, kept in zip(blocks, min_cut(costs, edges_of(blocks))) if kept)


def extract_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """Every row as ``page_id, url, text, n_chars``; null or empty pages give empty text, other columns play no part."""
    weights = train()
    kinds = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                texts = [main_text(h, weights) for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    return pages.select("page_id", "url", F.coalesce(html, F.lit("")).alias("html")).mapInArrow(run, f"{kinds}, text string, n_chars bigint")

"""A light, forgiving HTML reader: block elements, their text, and features of every node."""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_left
from collections import Counter

INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong"
    " sub sup time tt u var wbr br input".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title svg iframe object select".split())
TO_THE_END = frozenset("script style textarea title".split())  # without an end tag, these take the rest of the page
CLOSES = {
    "p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
ENDS_P = frozenset(
    "address article aside blockquote details dialog div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav"
    " ol p pre section table ul".split())
SCOPE = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}
UNWANTED_TAGS = frozenset("nav aside footer header form menu button dialog fieldset datalist".split())
MAIN_TAGS = frozenset({"article", "main"})
UNWANTED = frozenset(
    "nav navbar navigation menu header masthead topbar footer sidebar aside rail widget ad ads advert adverts advertisement sponsor"
    " sponsored promo banner cookie cookies consent gdpr privacy notice alert popup modal overlay newsletter subscribe subscription"
    " signup login share sharing social related recommended breadcrumb breadcrumbs pagination pager form search toolbar copyright"
    " legal disclaimer hidden skip".split())
REMARKS = frozenset("comment comments commentlist reply replies discussion respond reader readers feedback reviews disqus".split())
MAIN = frozenset("article content main maincontent post entry story body text hentry prose markdown articlebody".split())
TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
START = re.compile(r"<!--|<[!?]|</?[a-zA-Z]?")
NAME_END = re.compile(r"[\s/>]|\Z")
VALUES = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
SPECIAL = re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"(?<![a-zA-Z-])([a-zA-Z-]++)\s*+=\s*+(\"[^\"]*\"|'[^']*'|[^\s\"'>]++)")
SPACE = re.compile(r"\s+")
N_FEATURES = 26


class Node:
    __slots__ = ("tag", "parent", "children", "tokens", "runs", "depth", "links", "keep", "hidden", "at", "rank")

    def __init__(self, tag: str, parent: Node | None):
        self.tag, self.parent, self.children, self.runs = tag, parent, [], []
        self.depth = parent.depth + 1 if parent else 0
        self.rank = len(parent.children) if parent else 0  # place among the siblings
        self.tokens: frozenset = frozenset()
        self.links, self.keep, self.hidden, self.at = 0, False, False, 0


class Tags:
    """The tags of a page, found in time linear in its length however its quotes stand.

    A tag ends at the first ``>`` outside quotes. Where a quote that is never closed leaves a tag without an
    end, its ``<`` is text. After the first such tag the ends are looked up in a table made from
    behind: the end seen from a quote is the end seen from behind its partner.
    """

    def __init__(self, source: str):
        self.source, self.size = source, len(source)
        self.name_end = 0
        self.places: list[int] | None = None
        self.missing: set[str] = set()
        self.closers: dict[str, re.Pattern] = {}

    def _end(self, place: int) -> int:
        """Behind the ``>`` that ends a tag whose name ends at ``place``, or -1."""
        if self.places is None:
            found = VALUES.match(self.source, place)
            if found:
                return found.end()
            self._table()
        return self.ends[bisect_left(self.places, place)]

    def _table(self) -> None:
        source = self.source
        self.places = [m.start() for m in SPECIAL.finditer(source)]
        n = len(self.places)
        self.ends = [-1] * (n + 1)
        partner = {}
        for i in range(n - 1, -1, -1):
            mark = source[self.places[i]]
            if mark == ">":
                self.ends[i] = self.places[i] + 1
            else:
                if mark in partner:
                    self.ends[i] = self.ends[partner[mark] + 1]
                partner[mark] = i

    def next(self, place: int) -> tuple[int, int, str, bool, str] | None:
        """Start, end, name, whether it closes, and attributes of the next tag; comments and the like have no name."""
        source = self.source
        while found := START.search(source, place):
            start, begin = found.span()
            opening = found.group()
            if opening == "<!--":
                end = source.find("-->", begin)
                return start, end + 3 if end >= 0 else self.size, "", False, ""
            if opening[-1] in "!?/":
                end = -1 if ">" in self.missing else source.find(">", begin)
                if end >= 0:
                    return start, end + 1, "", False, ""
                self.missing.add(">")
            elif opening != "<":
                if begin > self.name_end:
                    self.name_end = NAME_END.search(source, begin).start()
                name_end = max(self.name_end, begin)
                end = self._end(name_end)
                if end >= 0:
                    closing = opening[1] == "/"
                    return start, end, source[start + 1 + closing : name_end], closing, source[name_end : end - 1]
                if opening[1] == "/":  # without an end by quotes, a closing tag ends at the next >
                    end = -1 if ">" in self.missing else source.find(">", begin)
                    if end >= 0:
                        return start, end + 1, source[start + 2 : name_end], True, ""
                    self.missing.add(">")
            place = start + 1
        return None

    def behind(self, tag: str, place: int) -> int:
        """Behind the end tag of the raw element ``tag`` opened before ``place``."""
        if tag not in self.missing:
            if tag not in self.closers:
                self.closers[tag] = re.compile(rf"</{re.escape(tag)}\b", re.I)
            found = self.closers[tag].search(self.source, place)
            end = self.source.find(">", found.end()) if found else -1
            if end >= 0:
                return end + 1
            self.missing.add(tag)
        return self.size if tag in TO_THE_END else place


def parse(source: str) -> tuple[list[Node], list[tuple[Node, str]]]:
    """Block nodes in order of the page, parents first, and the blocks of text with their nodes.

    White space in a block is one space; an inline element does not end a block. Raw elements
    (scripts, styles, selects, ...) and comments have no text.
    """
    root = Node("#root", None)
    nodes, blocks = [root], []
    stack = [root]  # open block elements
    is_open: Counter = Counter()
    anchors = 0
    run: list[str] = []
    linked = 0

    def end_block():
        nonlocal run, linked
        text = SPACE.sub(" ", html.unescape("".join(run))).strip()
        if text:
            node = stack[-1]
            node.runs.append(len(text))
            node.links += min(linked, len(text))
            blocks.append((node, text))
        run, linked = [], 0

    def leave(i):
        for left in stack[i:]:
            is_open[left.tag] -= 1
        del stack[i:]

    place = 0
    size = len(source)
    tags = Tags(source)
    while place < size:
        found = tags.next(place)
        piece = source[place : found[0]] if found else source[place:]
        if piece:
            run.append(piece)
            if anchors:
                linked += len(piece.strip())
        if not found:
            break
        _, place, name, closing, attributes = found
        if not name:
            continue
        tag = name.lower()
        if tag in RAW and not closing:
            if not attributes.endswith("/"):
                place = tags.behind(tag, place)
            continue
        if tag in INLINE:
            if tag == "a":
                anchors = max(0, anchors + (-1 if closing else 1))
            elif tag == "br":
                run.append(" ")
            continue
        end_block()
        if closing:
            for i in range(len(stack) - 1 if is_open[tag] else 0, 0, -1):
                if stack[i].tag == tag:
                    leave(i)
                    break
            anchors = 0
            continue
        if tag in ENDS_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    leave(i)
                    break
                if stack[i].tag not in {"li", "dd", "dt"}:
                    break
        if tag in CLOSES:
            for i in range(len(stack) - 1 if any(is_open[t] for t in CLOSES[tag]) else 0, 0, -1):
                if stack[i].tag in CLOSES[tag]:
                    leave(i)
                    break
                if stack[i].tag in SCOPE.get(tag, ()):
                    break
        node = Node(tag, stack[-1])
        if attributes:
            read_attributes(node, attributes)
        node.parent.children.append(node)
        nodes.append(node)
        if tag not in VOID and not attributes.endswith("/"):
            stack.append(node)
            is_open[tag] += 1
    end_block()
    return nodes, blocks


def read_attributes(node: Node, text: str) -> None:
    tokens = []
    for key, value in ATTRIBUTE.findall(text):
        key, value = key.lower(), value.strip("\"'")
        if key in ("class", "id", "role", "itemprop", "aria-label"):
            tokens += [t.lower() for t in TOKEN.findall(value)]
        elif key == "data-keep":
            node.keep = True
        elif key == "aria-hidden" and value == "true" or key == "style" and "none" in value and "display" in value:
            node.hidden = True
    if re.search(r"(?:^|\s)hidden(?:\s|=|$)", text):
        node.hidden = True
    node.tokens = frozenset(tokens)


def features(nodes: list[Node], blocks: list[tuple[Node, str]]) -> list[list[float]]:
    """One row of ``N_FEATURES`` for each node.

    Tag, attribute tokens of the node and of those around it, depth, siblings, and the density of
    text, tags, links and punctuation in the subtree.
    """
    n = len(nodes)
    for i, node in enumerate(nodes):
        node.at = i
    text, links, tags, marks, paragraphs, start = ([0] * n for _ in range(6))
    own = [sum(x.runs) for x in nodes]
    seen = 0
    for node, block in blocks:
        i = node.at
        text[i] += len(block)
        marks[i] += sum(map(block.count, ".,;!?"))
        start[i] = start[i] or seen + 1
        seen += len(block)
    for i in range(n - 1, -1, -1):
        node = nodes[i]
        links[i] += node.links
        tags[i] += 1
        paragraphs[i] += node.tag == "p"
        if node.parent:
            j = node.parent.at
            for values in (text, links, tags, marks, paragraphs):
                values[j] += values[i]
            if start[i]:
                start[j] = min(start[i], start[j]) if start[j] else start[i]
    whole = max(text[0], 1)
    log = math.log1p
    state: list[tuple] = []
    out = []
    for i, node in enumerate(nodes):
        up = state[node.parent.at] if node.parent else (0, 0, 0, 0, 0, 0)
        tokens = node.tokens
        bad, remark, good = len(tokens & UNWANTED), len(tokens & REMARKS), len(tokens & MAIN)
        bad_tag, main_tag = node.tag in UNWANTED_TAGS, node.tag in MAIN_TAGS
        if node.tag in ("body", "html"):
            bad = remark = good = 0
        now = (up[0] + bool(bad), up[1] + bool(remark), up[2] + bool(good), up[3] + bad_tag, up[4] + main_tag, up[5] + node.hidden)
        state.append(now)
        siblings = node.parent.children if node.parent else [node]
        t = text[i]
        out.append([
            bad, remark, good, bad_tag, main_tag, *now, node.tag in ("p", "blockquote", "pre", "figcaption"),
            len(node.tag) == 2 and node.tag[0] == "h" and node.tag[1].isdigit(), node.tag in ("li", "ul", "ol", "dl", "dd", "dt"),
            min(node.depth, 30), node.rank / len(siblings), log(len(siblings)), log(t), log(tags[i]), t / (1 + tags[i]),
            links[i] / max(t, 1), t / whole, 100 * marks[i] / max(t, 1), log(own[i]), log(paragraphs[i]), start[i] / whole,
        ])
    return out

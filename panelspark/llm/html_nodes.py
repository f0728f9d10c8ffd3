"""Web pages as lists of block nodes in page order, and the nodes' features."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import numpy as np

# Elements by their part in a page.
SKIPPED = frozenset("script style noscript template svg iframe object canvas audio video math head title select option datalist textarea button".split())
RAW = frozenset("script style noscript template svg iframe title textarea".split())
BLOCKS = tuple(
    "html body div p article section main nav header footer aside form ul ol li dl dt dd table thead tbody tfoot tr td th caption h1 h2 h3 h4 h5 h6 "
    "blockquote pre figure figcaption address fieldset legend details summary dialog center hr menu".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that end an open element of the same group.
ENDS = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
IN_P = frozenset(BLOCKS) - {"html", "body"}
LISTS = frozenset("ul ol table dl menu".split())
TAGS = {t: i for i, t in enumerate((*BLOCKS, "text"))}
# Groups of words in class, id and role attributes.
WORD_GROUPS = {
    "content": "article content post entry main body story text prose page copy paragraph markdown richtext",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs toc tabs pagination pager skip",
    "head": "header masthead topbar top banner logo branding toolbar",
    "foot": "footer foot bottom copyright legal colophon credits imprint",
    "side": "sidebar side aside rail widget widgets secondary complementary related recommended recommendations trending popular more",
    "ad": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion promoted adsense dfp",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay dialog banner warning subscribe newsletter signup paywall message",
    "form": "form login search contact input field",
    "comment": "comment comments reply replies respond discussion disqus responses reviews",
    "share": "share sharing social follow tweet meta byline author tags tag category categories actions tools rating",
}
_GROUP = {w: i for i, ws in enumerate(WORD_GROUPS.values()) for w in ws.split()}
HASHED = 24

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTR = re.compile(r"\b(?:class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"\bhidden\b(?!\s*=\s*[\"']?false)|display\s*:\s*none|visibility\s*:\s*hidden|aria-hidden\s*=\s*[\"']?true", re.I)
_PIECE = re.compile(r"[A-Za-z]+")


@dataclass
class Page:
    """Nodes in page order; the subtree of node i is i to end[i] - 1."""

    tag: list[int] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    end: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    groups: list[int] = field(default_factory=list)
    hashed: list[int] = field(default_factory=list)
    hidden: list[int] = field(default_factory=list)
    text: list[str] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)
    links: list[int] = field(default_factory=list)
    inputs: list[int] = field(default_factory=list)


def _bucket(word: str) -> int:
    h = 5381
    for c in word[:24]:
        h = (h * 33 + ord(c)) & 0xFFFFFF
    return h % HASHED


def _attributes(raw: str) -> tuple[int, int]:
    """Bits of the word groups and of the hashed words of an element's attributes."""
    groups = hashed = 0
    for m in _ATTR.finditer(raw):
        for w in _PIECE.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", m[1] or m[2] or m[3] or "")):
            w = w.lower()
            if w in _GROUP:
                groups |= 1 << _GROUP[w]
            hashed |= 1 << _bucket(w)
    return groups, hashed


class _Builder:
    def __init__(self):
        self.page, self.stack, self.names = Page(), [], []
        self.pieces: list[str] = []
        self.linked = self.links = self.in_link = 0
        self.children: list[int] = []

    def add(self, name: str, groups: int, hashed: int, hidden: bool) -> int:
        p = self.page
        up = self.stack[-1] if self.stack else -1
        p.tag.append(TAGS[name])
        p.parent.append(up)
        p.end.append(len(p.tag))
        p.depth.append(len(self.stack))
        p.groups.append(groups)
        p.hashed.append(hashed)
        p.hidden.append(int(hidden))
        p.text.append("")
        p.linked.append(0)
        p.links.append(0)
        p.inputs.append(0)
        return len(p.tag) - 1

    def flush(self, closing: bool) -> None:
        """Give the gathered text to the innermost node, or to a text node of its own beside other blocks."""
        if not self.pieces:
            return
        text = "".join(self.pieces)
        self.pieces.clear()
        text = " ".join((html.unescape(text) if "&" in text else text).split())
        if text:
            if not self.stack:
                self.open("body", 0, 0, False)
            whole = closing and not self.children[-1]
            node = self.stack[-1] if whole else self.add("text", 0, 0, False)
            self.children[-1] += 1
            self.page.text[node] = text
            self.page.linked[node] = min(self.linked, len(text))
            self.page.links[node] = self.links
        self.linked = self.links = 0

    def open(self, name: str, groups: int, hashed: int, hidden: bool) -> None:
        if self.children:
            self.children[-1] += 1
        node = self.add(name, groups, hashed, hidden)
        self.stack.append(node)
        self.names.append(name)
        self.children.append(0)

    def close_top(self) -> None:
        self.flush(True)
        node = self.stack.pop()
        self.names.pop()
        self.children.pop()
        self.page.end[node] = len(self.page.tag)

    def close(self, name: str, stop: frozenset = frozenset()) -> None:
        for i in range(len(self.names) - 1, -1, -1):
            if self.names[i] == name:
                while len(self.names) > i:
                    self.close_top()
                return
            if self.names[i] in stop:
                return

    def starts(self, name: str) -> None:
        """End the elements that the start of this one ends."""
        if name in IN_P and "p" in self.names:
            self.close("p", frozenset(("td", "th", "li", "blockquote", "div", "article", "section", "main", "body")))
        for other in ENDS.get(name, ()):
            if other != "p":
                self.close(other, LISTS)


def parse(text: str) -> Page:
    """The block nodes of a page. Unclosed and misplaced tags are taken as browsers take the common cases."""
    b = _Builder()
    at, n = 0, len(text)
    for m in iter(lambda: _TOKEN.search(text, at), None):
        if m.start() > at:
            b.pieces.append(piece := text[at : m.start()])
            if b.in_link:
                b.linked += len(piece)
        at = m.end()
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if m[1]:
            if name == "a":
                b.in_link = 0
            elif name in TAGS and name != "text":
                b.close(name)
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(text, at)
            at = end.end() if end else n
            continue
        if name in SKIPPED:
            if not m[3].rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(text, at)
                if end:
                    at = end.end()
            if b.stack:
                b.page.inputs[b.stack[-1]] += 1
            continue
        if name == "br":
            b.pieces.append(" ")
        elif name == "input" and b.stack:
            b.page.inputs[b.stack[-1]] += 1
        elif name == "a":
            b.in_link, b.links = 1, b.links + 1
        elif name in TAGS and name != "text":
            if name in ("html", "body") and name in b.names:
                continue
            b.starts(name)
            b.flush(False)
            groups, hashed = _attributes(m[3]) if m[3] else (0, 0)
            b.open(name, groups, hashed, bool(m[3]) and _HIDDEN.search(m[3]) is not None)
            if name in VOID or m[3].rstrip().endswith("/"):
                b.close_top()
    if at < n:
        b.pieces.append(re.sub(r"<[a-zA-Z/!][^>]*\Z", "", text[at:]))
    b.flush(bool(b.stack))
    while b.stack:
        b.close_top()
    return b.page


STRUCTURE = (
    "depth size words linked_share links inputs subtree_text subtree_share subtree_words text_per_node subtree_linked_share subtree_links paragraphs paragraph_share subtree_inputs marks_per_word "
    "siblings place_among_siblings same_tag_siblings parent_share start_share nodes hidden has_article has_main heading_before same_tag_text named parent_named"
).split()
KINDS = (("article",), ("main",), ("section",), ("div", "center"), ("p",), ("h1", "h2", "h3", "h4", "h5", "h6"), ("ul", "ol", "menu", "dl"), ("li", "dt", "dd"), ("nav",), ("header",), ("footer",), ("aside",), ("form", "fieldset"), ("table", "tr", "td", "th", "tbody"), ("blockquote", "pre", "figure", "figcaption"), ("text",), ("body", "html"), ("dialog", "details"))
FEATURES = len(STRUCTURE) + 2 * len(KINDS) + 2 * len(WORD_GROUPS) + HASHED


def features(pages: list[Page]) -> np.ndarray:
    """nodes x FEATURES of several pages, laid end to end."""
    sizes = np.array([len(p.tag) for p in pages])
    first = np.concatenate(([0], np.cumsum(sizes)))
    n = int(first[-1])
    page = np.repeat(np.arange(len(pages)), sizes)
    joined = lambda name: np.fromiter((x for p in pages for x in getattr(p, name)), np.int64, n)
    tag, parent, end, depth = joined("tag"), joined("parent"), joined("end"), joined("depth")
    end = end + first[page]
    root = parent < 0
    up = np.where(root, np.arange(n), parent + first[page])
    me = np.arange(n)
    texts = [t for p in pages for t in p.text]
    length = np.fromiter(map(len, texts), np.int64, n)
    words = np.fromiter((t.count(" ") + 1 if t else 0 for t in texts), np.int64, n)
    marks = np.fromiter((t.count(",") + t.count(".") for t in texts), np.int64, n)
    linked, links, inputs = joined("linked"), joined("links"), joined("inputs")

    def below(x: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(x)))
        return total[end] - total[me]

    def of_page(x: np.ndarray) -> np.ndarray:
        return np.bincount(page, x, minlength=len(pages))[page]

    is_p = tag == TAGS["p"]
    text, text_words = below(length), below(words)
    whole = np.maximum(1, of_page(length))
    children = np.bincount(up[~root], minlength=n)
    by_parent = np.lexsort((me, np.where(root, -1, up)))
    ranked = np.where(root, -1, up)[by_parent]
    begin = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    order = np.empty(n, np.int64)
    order[by_parent] = np.arange(n) - np.flatnonzero(begin)[np.cumsum(begin) - 1]
    _, inverse, counts = np.unique(np.where(root, -1 - page, up) * len(TAGS) + tag, return_inverse=True, return_counts=True)
    before = np.cumsum(length) - length
    before = before - before[first[page]]
    headings = np.cumsum(np.isin(tag, [TAGS[f"h{i}"] for i in range(1, 7)]))
    structure = [
        depth, length, words, linked / np.maximum(length, 1), links, inputs, text, text / whole, text_words, text / np.maximum(end - me, 1), below(linked) / np.maximum(text, 1), below(links),
        below(is_p), below(is_p * below(length)) / np.maximum(text, 1), below(inputs), below(marks) / np.maximum(text_words, 1),
        np.where(root, 1, children[up]), order, counts[inverse], text / np.maximum(text[up], 1), before / whole, end - me, joined("hidden"),
        of_page(tag == TAGS["article"]) > 0, of_page(tag == TAGS["main"]) > 0, headings > np.concatenate(([0], headings))[first[page]],
        np.bincount(inverse, text, minlength=len(counts))[inverse] / whole, joined("hashed") > 0, joined("hashed")[up] > 0,
    ]
    kinds = [np.isin(tag, [TAGS[t] for t in k]) for k in KINDS]
    bits, hashed = joined("groups"), joined("hashed")
    own = np.stack(kinds + [(bits >> i) & 1 for i in range(len(WORD_GROUPS))], axis=1).astype(np.float32)
    above = np.zeros_like(own)
    for d in range(1, int(depth.max(initial=0)) + 1):
        at = np.flatnonzero(depth == d)
        above[at] = np.maximum(above[up[at]], own[up[at]])
    return np.concatenate([np.stack(structure, axis=1).astype(np.float32), own, above, np.stack([(hashed >> i) & 1 for i in range(HASHED)], axis=1).astype(np.float32)], axis=1)

"""Leaf blocks of web pages: their text, the tags above them, and the vectors the block labeller reads."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from dataclasses import dataclass, field
from functools import cached_property, lru_cache
from html.parser import HTMLParser

import numpy as np

#: Elements that start a block, elements without content, elements whose text is never shown.
BLOCK_TAGS = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2"
    " h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table tbody td tfoot th thead tr caption ul option"
    " select button label legend textarea title".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_TAGS = frozenset("script style noscript template svg annotation annotation-xml iframe object canvas head title textarea select option audio video".split())
#: Opening one of these closes an open element of the same group.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
HOLDS_ITEMS = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}

#: What names of classes, ids and roles say about a block, by kind.
NAME_STEMS = {
    "menu": "nav menu navbar navigation breadcrumb breadcrumbs pagination pager tabs tab toc skip",
    "head": "header masthead topbar logo brand banner hero toolbar",
    "foot": "footer foot colophon copyright legal bottom contentinfo",
    "side": "sidebar side aside widget related trending popular recommended rail complementary tags tag archive blogroll more",
    "notice": "notice cookie cookies consent gdpr alert popup modal newsletter subscribe subscription signup paywall overlay toast message warning",
    "ad": "ad ads advert adverts advertisement sponsor sponsored promo promotion promoted dfp adsense teaser",
    "form": "form search login register contact input poll survey",
    "comment": "comment comments reply replies respond discussion disqus responses feedback review reviews thread",
    "share": "share social sharing follow like buttons byline author meta",
    "content": "article content post entry main body story text page single blog articlebody maincontent prose copy",
}
NAMES = {w: k for k, (_, words) in enumerate(NAME_STEMS.items()) for w in words.split()}
#: Elements with a meaning of their own.
TAG_KINDS = "nav header footer aside form button label article main section figure figcaption table ul ol li a h1 h2 h3 p blockquote pre div dialog".split()
TAGS = {t: k for k, t in enumerate(TAG_KINDS)}

WORD_VECTOR = 16
PATH_VECTOR = 24
N_FEATURES = len(TAG_KINDS) + 2 * len(NAME_STEMS) + PATH_VECTOR + WORD_VECTOR + 9


class Element:
    """An open element; its path is found over the parents, so that paths share what they have in common."""

    __slots__ = ("parent", "tag", "named", "place", "seen")

    def __init__(self, parent: Element | None, tag: str, named: tuple[str, ...]):
        self.parent, self.tag, self.named, self.place, self.seen = parent, tag, named, None, None


@dataclass
class Block:
    element: Element | None
    parts: list = field(default_factory=list)
    linked: int = 0

    @cached_property
    def text(self) -> str:
        return " ".join("".join(self.parts).split())


def down_to(element: Element | None, known) -> list[Element]:
    """The element and those above it that are not ``known`` yet, outermost first."""
    found = []
    while element is not None and not known(element):
        found.append(element)
        element = element.parent
    return found[::-1]


def _named(attrs) -> tuple[str, ...]:
    found = []
    for name, value in attrs:
        if value and name in ("class", "id", "role", "itemprop"):
            found += re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower())
    return tuple(found)


class _Reader(HTMLParser):
    """Cuts a page at block elements and line breaks; what is never closed ends with what it stands in.

    ``at`` has the places of each tag in the stack of open elements, ``block_at`` those of all block elements, so the
    nearest one is found at once, however deep the stack is.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.blocks, self.now, self.hidden = [], [], None, 0
        self.at, self.block_at = defaultdict(list), []

    def _pop_to(self, at: int):
        while len(self.open) > at:
            tag = self.open.pop().tag
            self.at[tag].pop()
            if tag in BLOCK_TAGS:
                self.block_at.pop()
            self.hidden -= tag in HIDDEN_TAGS

    def _nearest(self, tags) -> int:
        return max((self.at[t][-1] for t in tags if self.at[t]), default=-1)

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK_TAGS or tag == "br":
            self.now = None
        if tag in VOID_TAGS:
            return
        if tag in BLOCK_TAGS and self.block_at and self.open[self.block_at[-1]].tag == "p":
            self._pop_to(self.block_at[-1])
        if tag in CLOSES:
            at = self._nearest(CLOSES[tag])
            if at > self._nearest(HOLDS_ITEMS[tag]):
                self._pop_to(at)
        if tag == "body" and self.hidden:
            self._pop_to(0)  # an unclosed head
        self.at[tag].append(len(self.open))
        if tag in BLOCK_TAGS:
            self.block_at.append(len(self.open))
        self.open.append(Element(self.open[-1] if self.open else None, tag, _named(attrs)))
        self.hidden += tag in HIDDEN_TAGS

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if self.at[tag]:
            self._pop_to(self.at[tag][-1])
        elif tag != "p":  # nothing to close, but a lone </p> is an empty paragraph
            return
        if tag in BLOCK_TAGS:
            self.now = None

    def handle_data(self, data):
        if self.hidden:
            return
        if self.now is None:
            if not data.strip():
                return
            self.now = Block(self.open[-1] if self.open else None)
            self.blocks.append(self.now)
        self.now.parts.append(data)
        if self.at["a"]:
            self.now.linked += len(data)

    def finish(self):
        """What is open at the end of the page is no text: a comment or declaration up to the end, a tag up to its ``>``."""
        while self.rawdata.startswith(("<!", "<?")) or re.match("</?[a-zA-Z]", self.rawdata):
            end = -1 if self.rawdata[1] in "!?" else self.rawdata.find(">")
            rest, self.rawdata = self.rawdata[end + 1 :] if end >= 0 else "", ""
            self.feed(rest)
        self.close()

    def parse_marked_section(self, i, report=1):
        """A section of no known kind is a comment up to the next ``>``, as browsers have it."""
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:
            end = self.rawdata.find(">", i)
            return end + 1 if end >= 0 else len(self.rawdata)


def blocks_of(html: str | None) -> list[Block]:
    """The blocks of a page that hold text, in page order."""
    reader = _Reader()
    reader.feed(html or "")
    reader.finish()
    return [b for b in reader.blocks if b.text]


@lru_cache(1 << 16)
def _hash(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "replace"))


def _placed(element: Element | None) -> np.ndarray:
    """Tags and names on the path to an element, the innermost named kind, and the hashed path: all of it, and near ends."""
    names_at, inner_at = len(TAG_KINDS), len(TAG_KINDS) + len(NAME_STEMS)
    path_at = inner_at + len(NAME_STEMS)
    above = None
    for e in down_to(element, lambda e: e.place is not None):
        above = e.parent.place if e.parent is not None else np.zeros(path_at + 2 * PATH_VECTOR, np.float32)
        own = above.copy()
        if e.tag in TAGS:
            own[TAGS[e.tag]] = 1
        for kind in {NAMES[w]: None for w in e.named if w in NAMES}:
            own[names_at + kind] = 1
            own[inner_at:path_at] = 0  # the innermost named element speaks last
            own[inner_at + kind] = 1
        h = _hash(e.tag + "." + ".".join(e.named))
        sign = 1 if h & 0x10000 else -1
        own[path_at + PATH_VECTOR :] *= 0.5
        own[path_at + h % PATH_VECTOR] += sign
        own[path_at + PATH_VECTOR + h % PATH_VECTOR] += sign
        e.place = own
    placed = element.place if element is not None else np.zeros(path_at + 2 * PATH_VECTOR, np.float32)
    return np.concatenate([placed[:path_at], (placed[path_at : path_at + PATH_VECTOR] + placed[path_at + PATH_VECTOR :]) / 2])


def vectors(blocks: list[Block]) -> np.ndarray:
    """One row of numbers per block: tag path, names on the path, hashed words, and plain measures."""
    out = np.zeros((len(blocks), N_FEATURES), np.float32)
    word_at = len(TAG_KINDS) + 2 * len(NAME_STEMS) + PATH_VECTOR
    rest_at = word_at + WORD_VECTOR
    paths = {}
    for k, block in enumerate(blocks):
        row = out[k]
        own = paths.get(id(block.element))
        if own is None:
            own = paths[id(block.element)] = _placed(block.element)
        row[:word_at] = own
        text = block.text
        found = text.lower().split()
        if found:
            h = np.array([_hash(w) for w in found], np.int64)
            row[word_at:rest_at] = np.bincount(h % WORD_VECTOR, np.where(h & 0x10000, 1, -1), WORD_VECTOR) / np.sqrt(len(found))
        size = max(1, len(text))
        row[rest_at:] = (
            min(1.5, block.linked / size), np.log1p(len(found)) / 5, np.log1p(size) / 8, text[-1] in ".!?…\"'»)", text.count(",") / size * 20,
            text[0] in "©©", k / max(1, len(blocks) - 1), k == 0, k == len(blocks) - 1,
        )
    return out

"""A page's blocks of text and the elements they stand in; the standard library's parser, run inside tasks."""

from __future__ import annotations

import re
from collections import Counter
from hashlib import blake2b
from html.parser import HTMLParser
from typing import NamedTuple

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements that hold no reading text, whatever the site. Their text is left out.
NOISE_TAGS = frozenset("head title nav footer script style noscript template button select option textarea input iframe svg canvas object audio video".split())
#: What may stand in a page's head; anything else ends a head left open.
HEAD_TAGS = frozenset("html head base link meta title style script noscript template".split())
#: Noise that stays noise even where an article opens inside it.
SEALED_TAGS = frozenset("head script style noscript template select option textarea iframe svg canvas object audio video".split())
#: Elements that are furniture more often than not, as those with a name of furniture.
DOUBTED_TAGS = frozenset("aside form menu dialog".split())
#: Words of a class or id that name page furniture.
NOISE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement sponsor sponsored promo promotion banner cookie cookies consent gdpr notice alert popup modal overlay nav navbar navigation menu "
    "breadcrumb breadcrumbs pagination pager sidebar widget footer header masthead comment comments disqus share sharing social related recommended newsletter subscribe signup login search".split()
)
_SELF_CLOSING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPES = frozenset("ul ol dl table tbody thead tfoot div article section main body html nav footer aside form header blockquote figure".split())
_NAME = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")
#: What an element's kind adds to its importance on a host of no pages; the more pages, the less (``style_tree``).
MAIN, NEUTRAL, NAMED = 0.15, 0.0, -2.0
#: Elements named as furniture that hold this share of a page's text are wrappers of the page: their name says nothing.
WRAPS = 0.7


class Mark(NamedTuple):
    """What an element's tag and name, and those above it, say of its text."""

    noise: bool = False
    main: bool = False
    named: tuple[str, ...] = ()  # paths of the elements named as furniture, within the nearest article or main


def path_key(path: str) -> int:
    return int.from_bytes(blake2b(path.encode(), digest_size=8).digest(), "little", signed=True)


class _Page(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, str, Mark]] = []
        self.held: list[str] = []
        self.marked: list[tuple[str, Mark, str]] = []
        self.children: dict[str, list[str]] = {"": []}
        self.elements: dict[str, int] = {}

    def _mark(self, tag: str, names: list[str], path: str) -> Mark:
        above = self.stack[-1][2] if self.stack else Mark()
        if tag in ("article", "main") and not any(t in SEALED_TAGS for t, _, _ in self.stack):
            return Mark(main=True)  # also where a menu or button before it was left open
        if above.noise or tag in NOISE_TAGS:
            return Mark(noise=True)
        furniture = any(n in NOISE_NAMES for n in names) and not any(n in ("has", "with", "no") for n in names)
        if tag in DOUBTED_TAGS or (tag == "header" and not above.main) or (furniture and tag not in ("html", "body")):
            return above._replace(named=(*above.named, path))
        return above

    def _flush(self) -> None:
        text = _SPACE.sub(" ", "".join(self.held)).strip()
        self.held = []
        if text:
            path = next((p for t, p, _ in reversed(self.stack) if t not in INLINE), "")
            # Furniture may be inline too.
            mark = self.stack[-1][2] if self.stack else Mark()
            if not mark.noise:
                self.marked.append((path, mark, text))

    def blocks(self) -> list[tuple[str, float, str]]:
        """Path, prior and text of every block outside noise."""
        shares: Counter[str] = Counter()
        for _, mark, text in self.marked:
            for path in set(mark.named):
                shares[path] += len(text)
        most = WRAPS * sum(len(text) for _, _, text in self.marked)
        prior = lambda mark: NAMED if any(shares[p] < most for p in mark.named) else MAIN if mark.main else NEUTRAL
        return [(path, prior(mark), text) for path, mark, text in self.marked]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in HEAD_TAGS and any(t == "head" for t, _, _ in self.stack):
            self._flush()
            del self.stack[next(k for k, (t, _, _) in enumerate(self.stack) if t == "head") :]
        if tag not in INLINE and tag != "br":
            self._flush()
            self._imply_end(tag)
        elif tag == "br":
            self.held.append(" ")
        names = _NAME.findall(" ".join(v or "" for k, v in attrs if k in ("class", "id", "role")).lower())
        above = self.stack[-1][1] if self.stack else ""
        sign = ".".join([tag, *names])
        # Inline elements are part of the text, not of the layout.
        if tag not in INLINE and tag != "br":
            self.children.setdefault(above, []).append(sign)
        if tag in VOID:
            return
        path = f"{above}/{sign}"
        mark = self._mark(tag, names, path)
        if tag in INLINE and self.stack and mark != self.stack[-1][2]:
            self._flush()
        self.stack.append((tag, path, mark))
        self.children.setdefault(path, [])
        self.elements[path] = self.elements.get(path, 0) + 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        at = next((k for k in range(len(self.stack) - 1, -1, -1) if self.stack[k][0] == tag), None)
        if at is None:
            if tag not in INLINE:
                self._flush()
            return
        if tag not in INLINE or any(v != self.stack[at][2] for _, _, v in self.stack[at:]) or (at and self.stack[at - 1][2] != self.stack[at][2]):
            self._flush()
        elif any(t not in INLINE for t, _, _ in self.stack[at + 1 :]):
            return  # an inline end tag does not close the blocks inside
        del self.stack[at:]

    def _imply_end(self, tag: str) -> None:
        """A block ends an open paragraph; items and cells end their kind, within their list or table."""
        ends = _SELF_CLOSING.get(tag, set()) | {"p"}
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] in ends:
                del self.stack[k:]
            elif self.stack[k][0] in _SCOPES:
                return

    def handle_data(self, data: str) -> None:
        self.held.append(data)


def _read(html: str | None) -> _Page:
    page = _Page()
    page.feed(html or "")
    page.close()
    page._flush()
    return page


def parse(html: str | None) -> tuple[list[tuple[str, float, str]], dict[str, list[str]]]:
    """(blocks: path, prior, text; children: path to the block child elements it has here, in order)."""
    page = _read(html)
    return page.blocks(), page.children


def parse_counted(html: str | None) -> tuple[list[tuple[str, float, str]], dict[str, tuple[list[str], int]]]:
    """As ``parse``, with the number of a path's elements beside its children."""
    page = _read(html)
    return page.blocks(), {p: (c, page.elements.get(p, 1)) for p, c in page.children.items()}

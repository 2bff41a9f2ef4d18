"""Text blocks of HTML pages, with what the markup says about their place."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

# Searched only up to the last ">" of a page, so every search for one ends, and no branch goes over the same
# text twice: a tag is matched up to the next "<", others ("odd": quoted "<" or ">") are closed by _Quotes.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|(?P<comment>\Z))"
    r"|<(?P<raw>script|style)\b[^>]*>.*?(?:</(?P=raw)\s*>|(?P<cut>\Z))"
    # Closed before another of its kind begins, or else up to the next block of the body.
    r"|<(?P<skip>noscript|template|svg|iframe|object|textarea|select|title)\b[^>]*>"
    r"(?:(?:[^<]+|<(?!/?(?P=skip)\b))*+</(?P=skip)\s*>|(?:[^<]+|<(?!/?(?:address|article|aside|blockquote|body|center|div|dl|fieldset|figure|footer|form"
    r"|h[1-6]|head|header|hr|html|main|menu|nav|ol|p|pre|section|table|ul)\b))*+(?P<rest_skipped>\Z)?)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9-]*+)(?:(?P<rest>(?:[^<>\"']++|\"[^\"<>]*+\"|'[^'<>]*+')*+)>|(?P<odd>))"
    r"|<[!?/][^>]*>"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_STOP = re.compile("[>\"']")
_LONG_NUMBER = re.compile("&#([0-9]{9,})")
_BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th "
    "thead title tr ul".split()
)
_ASIDE = frozenset("nav header footer aside form menu dialog button".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_ATTRIBUTE = re.compile(r"(?<![\w-])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none", re.I)
_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner masthead cookie cookies consent gdpr notice "
    "notices alert sidebar menu menubar nav navbar navigation breadcrumb breadcrumbs header footer comment comments respond reply replies disqus "
    "share sharing social related recommended newsletter subscribe subscription signup login search popup modal overlay widget widgets toolbar "
    "pagination pager complementary contentinfo form".split()
)
_APART = frozenset("ad ads advert adverts advertisement comment promo recommended related reply sponsored".split())  # also on an article
# What the start of a tag closes, and where the search for it ends, if end tags are left out.
_ENDS_P = _BLOCK - frozenset("body button caption dd dt head html legend li option summary tbody td tfoot th thead title tr".split())
_ROW, _PART = frozenset("td th tr".split()), frozenset("thead tbody tfoot td th tr".split())
_CELL, _TABLE = frozenset("td th caption".split()), _PART | {"table", "caption", "body", "html"}
_IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, set()),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": (_ROW, {"table"}),
    "tbody": (_PART, {"table"}), "thead": (_PART, {"table"}), "tfoot": (_PART, {"table"}),
}
# Words that may follow such a name in a class or id, as in ad-slot-2; after others (notice-of-death) it tells nothing.
_PLACES = frozenset(
    "area bar block body bottom box button buttons card cell col column container content count desktop fixed form group head header holder "
    "icon icons inline inner item items label layer left link links list main message mobile module outer page panel placeholder primary right "
    "row secondary section site slot small space spot sticky tab tabs text thread title toggle top unit wide wrap wrapper zone".split()
)
_JOINED = ("comments", "sidebar", "advert", "advertisement", "breadcrumbs", "newsletter", "navbar", "popup")  # ends of names without hyphens
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption table tbody thead tr td th dl dt dd".split())
# On elements that hold prose, words for the place or use of a container tell nothing.
_PROSE_NAMES = _NAMES - frozenset("form header footer login signup search menu alert masthead recommended related overlay widget widgets respond social".split())
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"([a-z])([A-Z])")
_SPACE = re.compile(r"\s+")


class Block(NamedTuple):
    text: str
    aside: bool  # inside a menu, header, footer, sidebar, form, advert, notice or comments
    article: bool  # inside <article> or <main>


def _is_aside(tag: str, rest: str) -> bool:
    if tag in _ASIDE or (rest and _HIDDEN.search(rest) is not None):
        return True
    if not rest or tag in ("html", "body", "main", "a", "span"):
        return False
    names = _APART if tag == "article" else _PROSE_NAMES if tag in _PROSE else _NAMES
    return any(_names(one, names) for m in _ATTRIBUTE.findall(rest) for one in _CAMEL.sub(r"\1-\2", "".join(m)).lower().split())


def _names(one: str, names: frozenset[str]) -> bool:
    """Whether a class, id or role names furniture: its last word does, or one does that words for places alone follow."""
    for word in reversed(_WORDS.findall(one)):
        if word in names or (names is not _APART and word.endswith(_JOINED)):
            return True
        if word not in _PLACES and len(word) > 1:
            return False
    return False


class _Open:
    """Open elements, outermost first, as (tag, aside, number of the token)."""

    def __init__(self):
        self.stack: list[tuple[str, bool, int]] = []
        self.count: Counter = Counter()
        self.aside = self.article = 0
        # Of the outermost `settled` elements, which leave() has judged: asides that stay, tags without an end tag of their own.
        self.settled = self.kept = 0
        self.doubtful: Counter = Counter()
        self.closed: set[int] = set()

    def push(self, tag: str, aside: bool, at: int) -> None:
        self.stack.append((tag, aside, at))
        self.count[tag] += 1
        self.aside += aside
        self.article += tag in ("article", "main")

    def pop(self) -> tuple[str, bool, int]:
        last = self.stack.pop()
        if len(self.stack) < self.settled:
            self.settled -= 1
            self.kept -= last[1]
            self.doubtful[last[0]] -= last[2] not in self.closed
        self.count[last[0]] -= 1
        self.aside -= last[1]
        self.article -= last[0] in ("article", "main")
        return last

    def imply(self, tag: str) -> None:
        """Close what the start of a tag closes without an end tag."""
        if tag in _ENDS_P and self.count["p"]:
            k = len(self.stack) - 1
            while k >= 0 and self.stack[k][0] not in _BLOCK:
                k -= 1
            if k >= 0 and self.stack[k][0] == "p":
                del_to(self, k)
        if tag in _IMPLIED:
            closes, bounds = _IMPLIED[tag]
            if any(self.count[c] for c in closes):
                lowest = None
                for k in range(len(self.stack) - 1, -1, -1):
                    if self.stack[k][0] in bounds:
                        break
                    if self.stack[k][0] in closes:
                        lowest = k
                if lowest is not None:
                    del_to(self, lowest)

    def end(self, tag: str) -> int | None:
        """Close the innermost element of the tag and all inside it: its number, if there is one.

        An inline tag closes no block, and a block in a cell of a table nothing outside of the cell.
        """
        if not self.count[tag]:
            return None
        for k in range(len(self.stack) - 1, -1, -1):
            own, _, at = self.stack[k]
            if own == tag:
                del_to(self, k)
                return at
            if (own in _BLOCK and tag not in _BLOCK) or (own in _CELL and tag not in _TABLE):
                return None
        return None

    def leave(self, closed: set[int]) -> None:
        """An article begins: asides that were left open before it end, those that it lies in stay.

        A menu or header never holds the article; others hold it if each open
        element of their tag, from the outermost to them, gets its end tag.
        """
        self.closed = closed
        first = None
        for k in range(self.settled, len(self.stack)):
            tag, aside, at = self.stack[k]
            self.doubtful[tag] += at not in closed
            if aside and not self.kept and first is None:
                first = tag
            if aside and (self.doubtful[tag] or tag in ("nav", "header") or first in ("nav", "header")):
                self.stack[k] = (tag, False, at)
                self.aside -= 1
            else:
                self.kept += aside
        self.settled = len(self.stack)


def del_to(opened: _Open, k: int) -> None:
    while len(opened.stack) > k:
        opened.pop()


class _Quotes:
    """Where tags of a page end whose quoted attributes hold "<" or ">"; each quote is looked at once."""

    def __init__(self, page: str):
        self.page = page
        self.known: dict[int, int] = {}  # place of a quote that opens -> the ">" that ends its tag, -1 if none does

    def close(self, at: int) -> int:
        """The ">" that ends the tag which goes on at `at`: the next one if the quotes never close."""
        passed, place = [], at
        while True:
            stop = _STOP.search(self.page, place)
            if stop is None or stop[0] == ">":
                found = -1 if stop is None else stop.start()
                break
            if (begin := stop.start()) in self.known:
                found = self.known[begin]
                break
            passed.append(begin)
            place = self.page.find(stop[0], begin + 1) + 1
            if not place:
                found = -1
                break
        self.known.update(dict.fromkeys(passed, found))
        return found if found >= 0 else self.page.find(">", at)


def tokens(page: str) -> Iterator[tuple[str | None, str, bool, str]]:
    """(text, "", False, "") or (None, tag in lower case, whether it ends, attributes); time is linear in the page.

    Comments are left out; scripts, styles and other parts without text are one space. What follows the last ">" is text.
    """
    last, at, cut, quotes = page.rfind(">") + 1, 0, False, _Quotes(page)
    while at < last:
        for m in _TOKEN.finditer(page, at, last):
            if (text := m["text"]) is not None:
                yield text, "", False, ""
            elif (tag := m["tag"]) is not None:
                if m["odd"] is not None:
                    at = quotes.close(m.end()) + 1
                    yield None, tag.lower(), m["end"] != "", page[m.end():at - 1]
                    break
                yield None, tag.lower(), m["end"] != "", m["rest"]
            else:
                cut = cut or any(m[g] is not None for g in ("comment", "cut", "rest_skipped"))
                if m["raw"] is not None or m["skip"] is not None:
                    yield " ", "", False, ""
        else:
            break
    if not cut and (tail := page[max(at, last):].partition("<!--")[0]):
        yield tail, "", False, ""


def decoded(text: str) -> str:
    """Character references decoded, those of any length too; white space is one space."""
    if "&#" in text:
        text = _LONG_NUMBER.sub(lambda m: "&#" + (m[1].lstrip("0")[:8] or "0"), text)
    return _SPACE.sub(" ", html.unescape(text)).strip()


def _closed(page: str) -> set[int]:
    """Numbers of the tokens whose elements get an end tag of their own."""
    opened, out = _Open(), set()
    for at, (_, tag, ends, _) in enumerate(tokens(page)):
        if not tag:
            continue
        if ends:
            if (start := opened.end(tag)) is not None:
                out.add(start)
        elif (tag in _BLOCK or tag == "span") and tag not in _VOID:
            opened.imply(tag)
            opened.push(tag, False, at)
    return out


def blocks(page: str | None) -> list[Block]:
    """Blocks of a page in order; white space inside is one space, character references are decoded."""
    out: list[Block] = []
    held: list[str] = []
    opened = _Open()
    closed: set[int] | None = None

    def flush() -> None:
        if held:
            if text := decoded("".join(held)):
                out.append(Block(text, opened.aside > 0, opened.article > 0))
            held.clear()

    for at, (text, tag, ends, rest) in enumerate(tokens(page or "")):
        if text is not None:
            held.append(text)
            continue
        if tag in _BLOCK:
            flush()
        elif tag == "br":
            held.append(" ")
        if ends:
            if opened.count[tag]:
                if tag not in _BLOCK and opened.aside:
                    flush()
                opened.end(tag)
            continue
        if tag in _VOID:
            continue
        if tag in _BLOCK:
            opened.imply(tag)
        elif rest.endswith("/"):
            continue
        aside = not (tag in _BLOCK and rest.endswith("/")) and _is_aside(tag, rest)
        if tag in ("article", "main") and not aside and not opened.article and opened.aside:
            closed = _closed(page) if closed is None else closed
            opened.leave(closed)
        if tag in _BLOCK or aside or tag == "span":
            if aside:
                flush()
            opened.push(tag, aside, at)
    flush()
    return out

"""Leaf text blocks of a page with their tag paths, and the features the block labeller reads."""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter

import numpy as np

# The HTML elements that start a new block, never hold text, or have no end tag.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary "
    "table tbody td textarea tfoot th thead title tr ul".split()
)
NO_TEXT = ("script", "style", "noscript", "template", "svg", "iframe", "head", "title", "textarea", "select", "object", "canvas")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "textarea", "title", "iframe", "noscript")}
# A start tag of these ends an open element of the same group below the nearest list or table.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}}

_LISTS = frozenset(("ul", "ol", "dl", "table", "select", "menu"))
# Any other element ends an open head, whose end tag may be left out.
IN_HEAD = frozenset("html head base link meta title style script noscript template".split())

TAG = re.compile(r"""<(?:!--.*?(?:-->|\Z)|!\[CDATA\[.*?(?:\]\]>|\Z)|[!?][^>]*>|(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"'])*)(?:>|\Z))""", re.S)
NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
NAME_WORD = re.compile(r"[a-zA-Z]+")
WORD = re.compile(r"\w+")

PATH_SLOTS, WORD_SLOTS, SHAPE = 256, 32, 6
WIDTH = PATH_SLOTS + WORD_SLOTS + SHAPE


class Block:
    """One leaf: its text, the distinct names on its tag path and the characters inside links."""

    __slots__ = ("path", "parts", "linked")

    def __init__(self, path: tuple[str, ...]):
        self.path, self.parts, self.linked = path, [], 0

    @property
    def text(self) -> str:
        return " ".join(html.unescape("".join(self.parts)).split())


def blocks(page: str | None) -> list[Block]:
    """Blocks with text in page order. Comments, scripts and styles are no text; unclosed tags are allowed."""
    page = page or ""
    out: list[Block] = []
    stack = _Open()
    now, at = None, 0

    def add(text: str):
        nonlocal now
        if stack.count["head"] and stack.top == "head" and text.strip():
            stack.cut("head")
        if text and not stack.silent:
            if now is None:
                now = Block(stack.path)
                out.append(now)
            now.parts.append(text)
            if stack.count["a"]:
                now.linked += len(text)

    while True:
        m = TAG.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if tag in BLOCK_TAGS:
            now = None
        elif tag == "br":
            add(" ")
        if m[1]:
            stack.cut(tag)
            continue
        if tag not in IN_HEAD:
            stack.cut("head")
        if tag in VOID:
            continue
        raw = RAW.get(tag)
        if raw:
            end = raw.search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in CLOSES:
            stack.cut_within(CLOSES[tag], _LISTS)
        elif tag in BLOCK_TAGS:  # a block ends an open paragraph, whose inline elements end with it
            stack.cut_within({"p"}, BLOCK_TAGS)
        names = [f"<{tag}>"]
        if m[3]:
            for kind, *values in NAMED.findall(m[3]):
                names += [f"{kind[0].lower()}:{w.lower()}" for w in NAME_WORD.findall("".join(values))]
        stack.push(tag, names)
    return [b for b in out if b.text]


class _Open:
    """Open elements. What is asked of them is kept up to date, so deep pages cost no more per tag."""

    def __init__(self) -> None:
        self.elements: list[tuple[str, list[str]]] = []
        self.count: Counter[str] = Counter()  # open elements by tag
        self.names: dict[str, int] = {}  # names on the path, in order of their first place, with their number
        self.silent = 0

    @property
    def path(self) -> tuple[str, ...]:
        return tuple(self.names)

    @property
    def top(self) -> str:
        return self.elements[-1][0] if self.elements else ""

    def push(self, tag: str, names: list[str]) -> None:
        self.elements.append((tag, names))
        self.count[tag] += 1
        self.silent += tag in NO_TEXT
        for name in names:
            self.names[name] = self.names.get(name, 0) + 1

    def pop(self) -> str:
        tag, names = self.elements.pop()
        self.count[tag] -= 1
        self.silent -= tag in NO_TEXT
        for name in names:
            self.names[name] -= 1
            if not self.names[name]:
                del self.names[name]
        return tag

    def cut(self, tag: str) -> None:
        """Close the innermost element of this tag with all inside it; nothing if none is open."""
        if self.count[tag]:
            while self.pop() != tag:
                pass

    def cut_within(self, tags: set[str], borders) -> None:
        """Close the innermost element of these tags, unless one of ``borders`` is further in."""
        if not any(self.count[t] for t in tags):
            return
        for k in range(len(self.elements) - 1, -1, -1):
            if self.elements[k][0] in tags:
                while len(self.elements) > k:
                    self.pop()
                return
            if self.elements[k][0] in borders:
                return


def _slot(name: str, slots: int) -> int:
    return zlib.crc32(name.encode()) % slots


_WORD_SLOT: dict[str, int] = {}


def _word_slot(word: str) -> int:
    slot = _WORD_SLOT.get(word)
    if slot is None:
        if len(_WORD_SLOT) > 200_000:
            _WORD_SLOT.clear()
        slot = _WORD_SLOT[word] = _slot(word, WORD_SLOTS)
    return slot


def vector(path: tuple[str, ...], text: str, linked: int) -> np.ndarray:
    """Tag path and hashed words of one block, and its shape."""
    v = np.zeros(WIDTH, np.float32)
    for name in path:
        v[_slot(name, PATH_SLOTS)] = 1
    words = text.lower().split()
    hashed = np.bincount([_word_slot(w) for w in words], minlength=WORD_SLOTS)
    v[PATH_SLOTS : PATH_SLOTS + WORD_SLOTS] = np.sqrt(hashed / max(1, len(words)))
    n = max(1, len(text))
    ends = text[-1:] in ".!?:;…\"'»”)"
    v[PATH_SLOTS + WORD_SLOTS :] = (
        np.log1p(n) / 8, min(1.0, linked / n), ends, sum(map(text.count, ".,;")) / n * 20,
        sum(map(str.isdigit, text)) / n, 1.0,
    )
    return v

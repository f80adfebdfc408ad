"""Secret scan with multipart credential linking."""

from __future__ import annotations

import re
from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktrail.llm.common import append_columns

# Patterns of what is always reported, with the least length of a match.
ASSIGN = re.compile(
    rb"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
    rb"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_VALUE = 12
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
ACCESS_LENGTH = 18
HEX = re.compile(rb"[0-9a-f]+")
HEX_LENGTH = 16
BASE_KINDS = ("assign", "access", "hex")

# Weak candidates: reported only beside their complement.
IDENTIFIER = re.compile(
    rb"""(?i)\b(?:user(?:_?name)?|login|account|client_?id|access_?key(?:_?id)?|key_?id)["']?\x20*[:=]\x20*["']?[a-z0-9][a-z0-9._@+-]{2,}"""
)
SHORT_VALUE = 4
TOKEN = re.compile(rb"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}(?![A-Za-z0-9+/_-])")
ENDPOINT = re.compile(
    rb"""(?i)\b(?:[a-z][a-z0-9+.]{1,20}://[^\s"'<>]+|(?:host|server|endpoint)["']?\x20*[:=]\x20*["']?[a-z0-9.-]{4,}(?::\d{2,5})?|(?:\d{1,3}\.){3}\d{1,3}(?::\d{2,5})?\b)"""
)
WEAK_KINDS = ("identifier", "secret", "endpoint")
KINDS = (*BASE_KINDS, *WEAK_KINDS)
SCOPE_END = re.compile(rb"\n[ \t\r]*\n")  # a blank line ends a scope

_ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"api")
_HEX_MARKS = bytes(0x68 if c in b"0123456789abcdef" else 0x20 for c in range(256))
Span = tuple[str, int, int]


def base_spans(data: bytes) -> tuple[list[Span], list[Span]]:
    """Byte spans that are always reported, and assignments whose value is too short for that."""
    found, short = [], []
    lowered = data.lower()
    if any(word in lowered for word in _ASSIGN_WORDS):
        for m in ASSIGN.finditer(data):
            size = m.end(1) - m.start(1)
            if size >= ASSIGN_VALUE:
                found.append(("assign", *m.span()))
            elif size >= SHORT_VALUE:
                short.append(("secret", *m.span()))
    if b"AKIA" in data:
        found += [("access", *m.span()) for m in ACCESS.finditer(data) if m.end() - m.start() >= ACCESS_LENGTH]
    if b"h" * HEX_LENGTH in data.translate(_HEX_MARKS):
        found += [("hex", *m.span()) for m in HEX.finditer(data) if m.end() - m.start() >= HEX_LENGTH]
    return found, short


def _outside(spans: list[Span], taken: list[Span]) -> list[Span]:
    """Spans that overlap none of ``taken``."""
    ends = sorted((s, e) for _, s, e in taken)
    starts = [s for s, _ in ends]
    far = list(accumulate((e for _, e in ends), max))
    out = []
    for span in spans:
        k = bisect_right(starts, span[2] - 1)
        if not k or far[k - 1] <= span[1]:
            out.append(span)
    return out


def _mixed(token: bytes) -> bool:
    return bool(re.search(rb"[0-9]", token) and re.search(rb"[a-z]", token) and re.search(rb"[A-Z]", token))


def link_weak(data: bytes, base: list[Span], short: list[Span]) -> list[Span]:
    """Weak parts that complete a credential within their scope: the interval between two blank lines.

    Parts are identifiers (access spans; named users and key ids), secrets (assign and hex spans;
    short assigned values, long mixed tokens) and endpoints. A weak secret is reported beside an
    identifier, a weak identifier beside a secret, an endpoint beside both.
    """
    strong_ids = [s for s in base if s[0] == "access"]
    weak_ids = []
    if b"=" in data or b":" in data:
        weak_ids = _outside([("identifier", *m.span()) for m in IDENTIFIER.finditer(data)], base)
    if not strong_ids and not weak_ids:
        return []
    tokens = [("secret", *m.span()) for m in TOKEN.finditer(data) if _mixed(m.group())]
    tokens = _outside(tokens, [*base, *short, *weak_ids])
    weak_secrets = [*_outside(short, base), *tokens]
    strong_secrets = [s for s in base if s[0] != "access"]
    if not weak_secrets and not strong_secrets:
        return []
    breaks = [m.start() for m in SCOPE_END.finditer(data)]
    scope_of = lambda at: bisect_right(breaks, at)
    ids = {scope_of(start) for _, start, _ in strong_ids + weak_ids}
    secrets = {scope_of(start) for _, start, _ in strong_secrets + weak_secrets}
    out = [s for s in weak_secrets if scope_of(s[1]) in ids]
    out += [s for s in weak_ids if scope_of(s[1]) in secrets]
    both = ids & secrets
    if both:
        out += [("endpoint", *m.span()) for m in ENDPOINT.finditer(data) if scope_of(m.start()) in both]
    return out


def scan(text: str | None) -> list[Span]:
    """All spans of a text in characters, by start and then kind."""
    data = (text or "").encode()
    base, short = base_spans(data)
    spans = base + link_weak(data, base, short)
    if not text.isascii() if text else False:
        places = sorted({p for _, s, e in spans for p in (s, e)})
        at, chars, where = 0, 0, {}
        for p in places:  # code points before each place, in one pass
            chars += len(data[at:p].decode())
            at = p
            where[p] = chars
        spans = [(kind, where[s], where[e]) for kind, s, e in spans]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def find_secrets(df: DataFrame, text: str, out: str = "secrets", drop=()) -> DataFrame:
    """Add column ``out``: array of (kind, start, end) spans in code points, end exclusive.

    Kinds assign, access and hex are always reported; identifier, secret and endpoint only where
    complementary parts co-occur in one scope, the text between blank
    lines, at any distance. All parts of a credential are in one text, so the interval join runs inside the row and nothing is
    shuffled. Null and empty texts have no spans; repeated rows are all kept; a column already
    named ``out`` is replaced, others pass through; an empty table gives an empty table.
    """

    def start():
        return lambda texts: [[[dict(zip(("kind", "start", "end"), s, strict=True)) for s in scan(t)] for t in texts]]

    return append_columns(df, [text], f"`{out}` array<struct<kind:string,start:bigint,end:bigint>>", start, drop)


def without(text: str | None, spans: list[Span], mark: str) -> str | None:
    """Text with ``mark`` in place of each span; overlapping spans become one."""
    if text is None or not spans:
        return text
    parts, at, end = [], 0, -1
    for _, first, last in sorted(spans, key=lambda s: s[1]):
        if first >= end:
            parts += [text[at:first], mark]
        at = end = max(end, last)
    return "".join([*parts, text[at:]])


def redact(df: DataFrame, text: str, mark: str = "[SECRET]", count: str = "n_secrets") -> DataFrame:
    """Scan each whole text and replace its secrets by ``mark``, in one pass; add their number.

    Null stays null, texts without secrets stay as they are, and a column already named ``count``
    is replaced.
    """

    def start():
        def work(texts):
            found = [scan(t) for t in texts]
            return [[without(t, s, mark) for t, s in zip(texts, found, strict=True)], [len(s) for s in found]]

        return work

    return append_columns(df, [text], f"`{text}` string, `{count}` bigint", start)


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

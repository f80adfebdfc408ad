"""Byte-level BPE vocabulary files: merges, byte symbols, special tokens and the split into words."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import regex
from pyspark import Broadcast
from pyspark.sql import SparkSession

# The word pattern of this tokenizer family, and the letters and numbers that the
# `regex` module knows but the tokenizers library (Unicode 16) does not; there they are symbols.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
AFTER_UNICODE_16 = (
    "0558 058B-058C 088F 0C5C 0CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D "
    "107BB-107BF 10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F "
    "12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA "
    "18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 "
    "1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED "
    "1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F"
)
_NEWER = re.compile(
    "[" + "".join("-".join(chr(int(end, 16)) for end in span.split("-")) for span in AFTER_UNICODE_16.split()) + "]"
)
_SYMBOL = "͸"  # unassigned, neither letter, number nor space

# A space with other characters than white space on both sides always begins a new word, so a text
# may be cut there; any other space stays inside its piece.
_DOUBLE_SPACE = re.compile(r"\s | \s|^ | $")
_CLEAR_SPACE = re.compile(r"(?<=\S)(?= \S)")


@dataclass(frozen=True)
class ByteBpe:
    tokens: list[bytes]  # bytes of each id
    byte_ids: list[int]  # id of each single byte
    ranks: dict[int, int]  # left id << 32 | right id -> rank
    merged: list[int]  # rank -> id
    special: dict[str, int]  # text -> id
    special_pattern: re.Pattern | None


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def parse(content: bytes) -> ByteBpe:
    """Read the JSON file of a byte-level BPE tokenizer."""
    data = json.loads(content)
    letters = _byte_letters()
    vocab = data["model"]["vocab"]
    special = {t["content"]: t["id"] for t in data["added_tokens"]}
    size = 1 + max([*vocab.values(), *special.values()])
    tokens = [b""] * size
    for text, i in vocab.items():
        tokens[i] = bytes(letters[c] for c in text)
    for text, i in special.items():
        tokens[i] = text.encode()
    single = {token[0]: i for i, token in enumerate(tokens) if len(token) == 1}
    ranks, merged = {}, []
    for rank, pair in enumerate(data["model"]["merges"]):
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        ranks[vocab[left] << 32 | vocab[right]] = rank
        merged.append(vocab[left + right])
    names = sorted(special, key=len, reverse=True)
    pattern = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
    return ByteBpe(tokens, [single[b] for b in range(256)], ranks, merged, special, pattern)


def share(spark: SparkSession, path: str) -> Broadcast:
    """Send the vocabulary file to the workers; its size is that of one tokenizer, whatever the data."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def words(piece: str) -> list[str]:
    """Words of a piece of text, as the tokenizer cuts them before any merge."""
    shown = piece if piece.isascii() else _NEWER.sub(_SYMBOL, piece)
    found = WORDS.findall(shown)
    if shown == piece:
        return found
    out, at = [], 0
    for word in found:
        out.append(piece[at : at + len(word)])
        at += len(word)
    return out


def pieces(text: str) -> list[str]:
    """Cut a text into pieces at which its words can be found one piece at a time."""
    if _DOUBLE_SPACE.search(text):
        return _CLEAR_SPACE.split(text)
    first, *rest = text.split(" ")
    return [first, *[" " + piece for piece in rest]]


class PieceCache(dict):
    """Result of each piece of text: that of its word, or the sum of those of its words.

    Holds at most ``size`` pieces in the current generation and as many in the one before; a
    piece met again moves to the current one, so frequent pieces stay and memory is bounded.
    """

    def __init__(self, compute: Callable[[bytes], object], none: object, size: int):
        super().__init__()
        self.compute, self.none, self.size = compute, none, size
        self.older: dict[str, object] = {}

    def __missing__(self, piece: str) -> object:
        value = self.older.get(piece)
        if value is not None:
            return self._keep(piece, value)
        found = words(piece)
        if len(found) == 1:
            return self._keep(piece, self.compute(piece.encode()))
        value = self.none
        for word in found:
            one = self.get(word)
            if one is None:
                one = self.older.get(word)
                one = self._keep(word, self.compute(word.encode()) if one is None else one)
            value += one
        return self._keep(piece, value)

    def _keep(self, piece: str, value: object) -> object:
        if len(piece) <= 64:
            if len(self) >= self.size:
                self.older = dict(self)
                self.clear()
            self[piece] = value
        return value


def sections(bpe: ByteBpe, text: str) -> list[str]:
    """Text between special tokens at even places, special tokens at odd places."""
    return bpe.special_pattern.split(text) if bpe.special_pattern else [text]

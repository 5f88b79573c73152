"""Byte-pair vocabularies of the tokenizers file format, and how their texts fall into pieces.

A vocabulary file is read on the driver and travels as a broadcast of plain values, so executors
need neither the file nor this package.  Special tokens are found in the raw text first, as the tokenizers
library does; the stretches between them are normalised and cut by the pattern.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable
from typing import NamedTuple

import regex

# The two piece patterns of the vocabulary files.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The same for texts of ASCII alone, in the form that the faster engine runs; letters, the most frequent, come first.
BYTE_LEVEL_ASCII = r" ?[A-Za-z]+| ?[0-9]+|'(?:s|t|re|ve|m|ll|d)| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Vocabulary(NamedTuple):
    """Token strings (in the visible byte alphabet) with ids, merges in rank order, special tokens, word end."""
    ids: dict[str, int]
    merges: list[tuple[str, str]]
    special: dict[str, int]
    word_end: str


def read_vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    model = data["model"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    special = {t["content"]: t["id"] for t in data["added_tokens"]}
    return Vocabulary(model["vocab"], merges, special, model.get("end_of_word_suffix") or "")


def byte_alphabet() -> dict[int, str]:
    """The visible character of each byte: printable Latin-1 stands for itself, the rest follow from 256 on."""
    visible = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def lower_each(text: str) -> str:
    """Lower case of each character on its own (no context rule for a final sigma)."""
    lowered = text.lower()
    return "".join(c.lower() for c in text) if "Σ" in text else lowered


def word_normal(text: str) -> str:
    """NFC, white space as single spaces, lower case."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
    return lower_each(regex.sub(r"\s+", " ", text))


class Cutter:
    """Cuts a text into stretches of special tokens (as ids) and pieces (as strings)."""

    def __init__(self, special: dict[str, int], pattern: str, normal: Callable[[str], str] | None = None,
                 ascii_pattern: str | None = None):
        self.special = special
        self.find = regex.compile(pattern).findall
        self.find_ascii = re.compile(ascii_pattern, re.ASCII).findall if ascii_pattern else self.find
        longest_first = sorted(special, key=len, reverse=True)
        self.split = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")").split if special else None
        self.normal = normal

    def pieces(self, text: str) -> list[str]:
        text = self.normal(text) if self.normal else text
        return (self.find_ascii if text.isascii() else self.find)(text)

    def holds_special(self, text: str) -> bool:
        return "<|" in text and any(s in text for s in self.special)

    def stretches(self, text: str) -> list[int | list[str]]:
        """Special ids and lists of pieces in the order of the text."""
        if not self.holds_special(text):
            return [self.pieces(text)]
        return [self.special[part] if part in self.special else self.pieces(part) for part in self.split(text)]

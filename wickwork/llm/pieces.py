"""Splitting a text into the pieces that byte-level BPE merges within."""

from __future__ import annotations

import re

import public_tokenizers
import regex

# White_Space of Unicode; both libraries mean it by \s, Python's own \s is wider.
SPACE = "\t-\r\x20\x85\xa0  -     　"
# A run of non-space with one space before it, or what is left of a run of space.
# No piece crosses the end of such a chunk, and a chunk's pieces depend on it alone.
CHUNK = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
PIECE = regex.compile(
    public_tokenizers.PATTERN.replace(r"[^\s", f"[^{SPACE}")
    .replace(r"\s", f"[{SPACE}]")
    .replace(r"\S", f"[^{SPACE}]")
)


def chunks(text: str) -> list[str]:
    return CHUNK.findall(text)


def pieces(text: str) -> list[str]:
    return PIECE.findall(text)

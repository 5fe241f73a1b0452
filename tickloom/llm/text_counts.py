"""Counts over one text's words and lines, as plain numbers."""

from __future__ import annotations

import numpy as np

SYMBOLS = b"#*$%&|<>"
_ONLY_SYMBOLS = bytes(c for c in range(256) if c not in SYMBOLS)
_NOT_IN_WORDS = b" \t\n\x0b\x0c\r"
_CONTINUATION = bytes(range(128, 192))


def word_chars(text: bytes) -> int:
    """Code points outside white space."""
    return len(text.translate(None, _NOT_IN_WORDS + _CONTINUATION))


def symbol_count(text: bytes) -> int:
    return len(text.translate(None, _ONLY_SYMBOLS))


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    if b"\n" not in text:
        return 0
    seen: set[bytes] = set()
    count = 0
    for line in text.split(b"\n"):
        if line.strip(_NOT_IN_WORDS):
            if line in seen:
                count += 1
            seen.add(line)
    return count


def word_ids(words: list[bytes]) -> np.ndarray:
    """A number per distinct word, in order of first use."""
    known: dict[bytes, int] = {}
    return np.array([known.setdefault(w, len(known)) for w in words], np.int64)


def repeated_words(ids: np.ndarray) -> int:
    """Words that lie in a window of three which the text holds twice or more."""
    n = len(ids)
    if n < 4:
        return 0
    base = int(ids.max()) + 1
    pairs = ids[:-1] * base + ids[1:]
    if base > 1 << 20:
        # Three numbers would not fit 63 bits; pairs are numbered anew first.
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * base + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    if not same.any():
        return 0
    often = np.zeros(n - 2, bool)
    often[order[1:][same]] = True
    often[order[:-1][same]] = True
    inside = np.zeros(n, bool)
    for shift in range(3):
        inside[shift : n - 2 + shift] |= often
    return int(inside.sum())

"""Counts over a whole text that quality rules and quality scores are made of."""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np

WHITE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"

FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars", "n_upper", "n_lower",
          "n_digits", "n_marks", "n_distinct", "n_top", "n_lines")
SCHEMA = ", ".join(f"{f} long" for f in FIELDS)


def word_numbers(words: list[bytes]) -> tuple[np.ndarray, int]:
    """Each word as a number, equal for equal words, and how many differ."""
    known: defaultdict = defaultdict(count().__next__)
    return np.fromiter(map(known.__getitem__, words), np.int64, len(words)), len(known)


def repeat_words(numbers: np.ndarray, distinct: int) -> int:
    """Words inside a window of three words that occurs twice or more in the text."""
    n = len(numbers) - 2
    if n < 2:
        return 0
    a, b, c = numbers[:-2], numbers[1:-1], numbers[2:]
    if distinct < 1 << 21:
        key = (a << 42) | (b << 21) | c
    else:
        pair = np.unique(np.stack([a, b], 1), axis=0, return_inverse=True)[1].reshape(-1)
        key = np.unique(np.stack([pair, c], 1), axis=0, return_inverse=True)[1].reshape(-1)
    ordered = np.sort(key)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    twice = np.unique(twice)
    at = np.searchsorted(twice, key)
    hit = twice[np.minimum(at, len(twice) - 1)] == key
    covered = np.zeros(n + 2, bool)
    covered[:-2] |= hit
    covered[1:-1] |= hit
    covered[2:] |= hit
    return int(covered.sum())


def stats(text: str) -> tuple[int, ...]:
    """The counts named in FIELDS; all 0 for an empty text."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # at \\x20 and \\x09-\\x0D only, as these are bytes
    of = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    n_chars = len(text)
    white = int(sum(of[c] for c in WHITE))
    lines = data.split(b"\n")
    seen, repeated, filled = set(), 0, 0
    for line in lines:
        if line.strip(WHITE):
            filled += 1
            if line in seen:
                repeated += 1
            seen.add(line)
    numbers, distinct = word_numbers(words)
    top = int(np.bincount(numbers).max()) if words else 0
    upper, lower = int(of[65:91].sum()), int(of[97:123].sum())
    digits = int(of[48:58].sum())
    marks = int(of[33:127].sum()) - upper - lower - digits
    return (len(words), n_chars - white, int(sum(of[c] for c in SYMBOLS)), repeated, repeat_words(numbers, distinct),
            n_chars, upper, lower, digits, marks, distinct, top, filled)

"""Counts over one whole text, shared by the quality operators."""

from __future__ import annotations

import numpy as np

SYMBOLS = "#*$%&|<>"
_BLANK = " \t\n\v\f\r"


def words_of(text: str) -> list[str]:
    """Runs of anything but ASCII white space."""
    return [w.decode("utf-8", "surrogatepass") for w in text.encode("utf-8", "surrogatepass").split()]


def word_ids(words: list) -> tuple[np.ndarray, int]:
    """Each word as a number from 0, equal words alike, and how many there are."""
    seen: dict = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.int64, count=len(words))
    return ids, len(seen)


def repeated_words(ids: np.ndarray, kinds: int, size: int = 3) -> int:
    """Words that lie in a window of ``size`` words found at least twice, the first one included."""
    if len(ids) <= size:
        return 0
    key, span = ids[: len(ids) - size + 1], kinds
    for k in range(1, size):
        if span > 2**62 // max(kinds, 1):  # number what there is anew so that keys stay within 64 bits
            uniq, key = np.unique(key, return_inverse=True)
            span = len(uniq)
        key, span = key * kinds + ids[k : len(ids) - size + 1 + k], span * kinds
    _, where, n = np.unique(key, return_inverse=True, return_counts=True)
    twice = n[where] > 1
    covered = np.zeros(len(ids), dtype=bool)
    for k in range(size):
        covered[k : len(ids) - size + 1 + k] |= twice
    return int(covered.sum())


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a whole text (null: empty)."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    chars = len(text) - sum(text.count(c) for c in _BLANK)
    lines = [x for x in text.split("\n") if x.strip(_BLANK)]
    ids, kinds = word_ids(words)
    return (
        len(words), chars, sum(text.count(c) for c in SYMBOLS), len(lines) - len(set(lines)), repeated_words(ids, kinds),
    )

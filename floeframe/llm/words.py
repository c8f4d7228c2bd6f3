"""Words of a text: runs of anything but the six ASCII spaces."""

from __future__ import annotations

import re
from array import array

import numpy as np

#: Characters that Python splits at besides the six.
OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words_of(text: str) -> list[str]:
    return WORD.findall(text) if OTHER_SPACE.search(text) else text.split()


def ascii_lower(text: str) -> str:
    return text.encode().lower().decode()  # of bytes, only A-Z change


class Numbers(dict):
    """word -> a small number of its own."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def numbered(words: list[str]) -> np.ndarray:
    return np.frombuffer(array("q", map(Numbers().__getitem__, words)), dtype=np.int64)


def repeated_words(words: list[str], window: int = 3) -> int:
    """Words in windows whose words stand in the text twice or more, the first included."""
    if len(words) <= window:
        return 0
    n = numbered(words)
    _, codes = np.unique(n[:-1] * (n.max() + 1) + n[1:], return_inverse=True)
    for k in range(2, window):
        _, codes = np.unique(codes[:-1] * (n.max() + 1) + n[k:], return_inverse=True)
    twice = np.bincount(codes)[codes] > 1
    covered = np.zeros(len(words), dtype=bool)
    for k in range(window):
        covered[k : k + len(twice)] |= twice
    return int(covered.sum())

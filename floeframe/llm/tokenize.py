"""Token ids of whole texts from the vocabularies of public tokenizers, word by word through a bounded cache.

Both vocabularies split a text before any merge, so that no token crosses the end of a word. A word's ids
therefore don't depend on its neighbours: each worker encodes a word once with the tokenizers library and keeps
the ids while the cache has room. Letters beyond U+024F take the library's whole pipeline, word by word, and
texts with control characters or spaces that the library and Python class differently take it in one piece.
"""

from __future__ import annotations

import array
import functools
import os
import re
import sys
from collections.abc import Callable

import regex

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Words, and pieces of words, that a worker keeps; about 200 bytes each.
CACHED = 500_000
#: Below this, letters are in normal form C already, and Python and the library agree on classes and lower case.
WIDE = re.compile("[^\\x00-\u024f]")
WORD_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
ODD_SPACE = re.compile(r"[^\S \n]")
SEGMENT = re.compile(r"[ \n]*[^ \n]+|[ \n]+")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes for themselves, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


LETTERS = byte_letters()


class Ids(dict):
    """word -> its ids as little-endian unsigned 32-bit integers; emptied when full, so memory is bounded."""

    def __init__(self, encode: Callable[[str], bytes], most: int = CACHED):
        super().__init__()
        self.encode, self.most = encode, most

    def __missing__(self, word: str) -> bytes:
        ids = self.encode(word)
        if len(self) >= self.most:
            self.clear()
        self[word] = ids
        return ids


def packed(ids) -> bytes:
    made = array.array("I", ids)
    if sys.byteorder == "big":
        made.byteswap()
    return made.tobytes()


def load(path: str, markers_as_text: bool = False):
    """The vocabulary's tokenizer. markers_as_text: its markers (end of text and the like) are plain text in a text."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = markers_as_text
    return tokenizer


def piece_ids(model, most: int = CACHED) -> Ids:
    """Ids of what the merges see: one piece, its bytes as letters. ASCII letters stand for themselves."""
    merged = model.tokenize
    return Ids(lambda piece: packed([t.id for t in merged(piece if piece.isascii() and piece.isalnum() else piece.encode().decode("latin-1").translate(LETTERS))]), most)


@functools.cache
def word_encoder(path: str, most: int = CACHED) -> Callable[[str], bytes]:
    """text -> ids for a lower-casing vocabulary with word ends that drops white space. most: words that are kept.

    A text that holds one of the vocabulary's markers is left to the library, which gives the marker its own id.
    """
    tokenizer = load(path)
    markers = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    whole = lambda text: packed(tokenizer.encode(text, add_special_tokens=False).ids)
    pieces = piece_ids(tokenizer.model, most)

    def word(w: str) -> bytes:
        low = w.lower()
        if low.isalpha():
            return pieces[low]
        if low[:-1].isalpha() and not low[-1].isalnum():
            return pieces[low[:-1]] + pieces[low[-1]]
        return b"".join(map(pieces.__getitem__, WORD_PIECE.findall(low)))

    words, wide_words = Ids(word, most), Ids(lambda w: whole(w) if WIDE.search(w) else word(w), most)

    def text_ids(text: str) -> bytes:
        if "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text or any(m in text for m in markers):
            return whole(text)
        return b"".join(map((wide_words if WIDE.search(text) else words).__getitem__, text.split()))

    return text_ids


@functools.cache
def byte_encoder(path: str, pattern: str) -> Callable[[str], bytes]:
    """text -> ids for a byte-level vocabulary; pattern must be the one that the library itself splits by. Markers are plain text."""
    tokenizer = load(path, markers_as_text=True)
    whole = lambda text: packed(tokenizer.encode(text, add_special_tokens=False).ids)
    pieces, split = piece_ids(tokenizer.model), regex.compile(pattern).findall

    def segment(s: str) -> bytes:
        return whole(s) if WIDE.search(s) else b"".join(map(pieces.__getitem__, split(s)))

    def after_space(w: str) -> bytes:
        if w.isalpha() and not WIDE.search(w):
            return pieces[f" {w}"]
        return segment(w if w[0] == "\n" else f" {w}")

    segments, spaced = Ids(segment), Ids(after_space)

    def text_ids(text: str) -> bytes:
        if ODD_SPACE.search(text):
            return whole(text)
        if not text or text[0] in " \n" or text[-1] in " \n" or "  " in text or " \n" in text or "\n " in text or "\n\n" in text:
            return b"".join(map(segments.__getitem__, SEGMENT.findall(text)))
        first, *others = text.replace("\n", " \n").split(" ")
        return segments[first] + b"".join(map(spaced.__getitem__, others))

    return text_ids

"""A linear scorer over hashed words and character n-grams, trained on a bounded sample, scored in Arrow batches.

A text's features are the averages over its words of what each word has: the word itself and the character
trigrams of the word with its ends marked, hashed to SIZE buckets; with ngrams also two and three words in a row,
hashed to NGRAMS buckets of their own. A worker keeps each word's share of the score and its hash in a bounded cache,
so a text costs one look-up a word; its n-grams are hashed from the words' hashes at once.
"""

from __future__ import annotations

import operator
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, StructField, StructType

from floeframe.llm.common import arrow_map, released
from floeframe.llm.words import words_of

SIZE = 1 << 15
#: One bucket more: the share of words that equal the word before them (a repeated word bigram).
SAME, ALL = SIZE, SIZE + 1
#: Buckets of two and three words in a row, behind the others; how much one counts beside a word.
NGRAMS, NGRAM_SHARE = 1 << 18, 0.5
CACHED = 200_000
#: Texts that a scorer is fitted on, about: a share of the rows by a hash of the id that gives so many.
SAMPLE = 2_000
STEPS, RATE, PENALTY = 150, 0.3, 1e-4


def word_features(word: str) -> set[int]:
    marked = f"\x02{word}\x03"
    found = {marked[i : i + 3] for i in range(len(marked) - 2)} | {f"w{word}"}
    return {zlib.crc32(x.encode()) % SIZE for x in found}


def repeats(words: list[str]) -> int:
    return sum(map(operator.eq, words, words[1:]))


def hashed(word: str) -> int:
    return zlib.crc32(word.encode())


def ngrams_of(hashes: np.ndarray) -> np.ndarray:
    """Buckets, from 0, of two and three words in a row, from the words' hashes (unsigned, 64 bits)."""
    mixed = lambda x: ((x ^ x >> np.uint64(29)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 18)
    two = hashes[:-1] * np.uint64(0x100000001B3) + hashes[1:]
    three = two[:-1] * np.uint64(0x100000001B3) + hashes[2:] + np.uint64(1)
    return mixed(np.concatenate([two, three])).astype(np.int64)


class Buckets(dict):
    def __missing__(self, word: str) -> np.ndarray:
        if len(self) >= CACHED:
            self.clear()
        self[word] = x = np.fromiter(word_features(word), dtype=np.int64)
        return x


def text_features(words: list[str], buckets: Buckets, ngrams: bool = False) -> tuple[np.ndarray, np.ndarray]:
    if not words:
        return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.float32)
    index, counts = np.unique(np.concatenate([buckets[w] for w in words]), return_counts=True)
    index, counts = np.append(index, SAME), np.append(counts, repeats(words))
    if ngrams:
        found, n = np.unique(ngrams_of(np.array([*map(hashed, words)], dtype=np.uint64)), return_counts=True)
        index, counts = np.append(index, found + ALL), np.append(counts, n * NGRAM_SHARE)
    return index.astype("<i4"), (counts / len(words)).astype("<f4")


def sampled(df: DataFrame, rows: int, id_col: str = "doc_id", size: int = SAMPLE) -> DataFrame:
    """About `size` of the rows, the same ones each time. rows: how many there are."""
    share = min(1.0, size / max(rows, 1))
    return df.where(F.pmod(F.xxhash64(F.lit("sample"), F.col(id_col)), F.lit(1_000_000)) < int(share * 1_000_000)) if share < 1 else df


EXAMPLES = StructType([StructField("target", DoubleType()), StructField("index", BinaryType()), StructField("value", BinaryType())])


def examples(labelled: DataFrame, target_of=None, ngrams: bool = False) -> list:
    """Collected features of a bounded sample. labelled: (text, target), or (text) with target_of(words, text)."""

    def columns(batch):
        buckets, targets, index, value = Buckets(), [], [], []
        given = batch.column(1).to_pylist() if target_of is None else None
        for k, text in enumerate(batch.column(0).to_pylist()):
            words = words_of(text or "")
            i, v = text_features(words, buckets, ngrams)
            targets.append(float(given[k]) if given else target_of(words, text or ""))
            index.append(i.tobytes())
            value.append(v.tobytes())
        return [targets, index, value]

    return arrow_map(labelled, columns, EXAMPLES).collect()


def fitted(rows: list, ngrams: bool = False) -> tuple[np.ndarray, float] | None:
    """(weights, intercept) of a penalised logistic regression with soft targets; calibrated on every fifth row.

    None without both kinds of targets: then nothing can be told apart.
    """
    rows = sorted(rows, key=lambda r: (bytes(r["index"]), r["target"]))
    y = np.array([r["target"] for r in rows])
    if not len(y) or y.max() < 0.5 or y.min() >= 0.5:
        return None
    held = np.arange(len(y)) % 5 == 4
    index = [np.frombuffer(r["index"], dtype="<i4") for r in rows]
    value = np.concatenate([np.frombuffer(r["value"], dtype="<f4") for r in rows]).astype(np.float64)
    row = np.repeat(np.arange(len(rows)), [len(i) for i in index])
    column = np.concatenate(index)
    fit = ~held[row]
    balance = np.where(y >= 0.5, 0.5 / max((y >= 0.5).mean(), 1e-9), 0.5 / max((y < 0.5).mean(), 1e-9))
    size = ALL + NGRAMS * ngrams
    weights, bias = np.zeros(size), 0.0
    seen, seen_bias = np.full(size, 1e-8), 1e-8
    r_fit, c_fit, v_fit = row[fit], column[fit], value[fit]
    for _ in range(STEPS):
        score = np.bincount(r_fit, v_fit * weights[c_fit], len(y)) + bias
        error = np.where(held, 0.0, (1 / (1 + np.exp(-np.clip(score, -30, 30))) - y) * balance) / max((~held).sum(), 1)
        slope = np.bincount(c_fit, v_fit * error[r_fit], size) + PENALTY * weights / 100
        seen += slope**2
        seen_bias += error.sum() ** 2
        weights -= RATE * slope / np.sqrt(seen)
        bias -= RATE * error.sum() / np.sqrt(seen_bias)
    score = np.bincount(row, value * weights[column], len(y)) + bias
    a, b = calibrated(score[held] if 0 < (y[held] >= 0.5).mean() < 1 else score, y[held] if 0 < (y[held] >= 0.5).mean() < 1 else y)
    return weights * a, bias * a + b


def calibrated(score: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift that make the logistic of a * score + b a probability; targets kept off 0 and 1."""
    good, bad = (y >= 0.5).sum(), (y < 0.5).sum()
    soft = np.where(y >= 0.5, (good + 1) / (good + 2), 1 / (bad + 2))
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * score + b, -30, 30)))
        w = p * (1 - p) + 1e-9
        g = np.array([((p - soft) * score).sum() + 1e-3 * (a - 1), (p - soft).sum()])
        h = np.array([[(w * score * score).sum() + 1e-3, (w * score).sum()], [(w * score).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-8:
            break
    return (a, b) if a > 0 else (1.0, 0.0)


class Shares(dict):
    """word -> its number; at that number its part of the score and its hash."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights, self.parts, self.hashes = weights[:ALL].tolist(), np.zeros(1024), np.zeros(1024, dtype=np.uint64)

    def __missing__(self, word: str) -> int:
        self[word] = k = len(self)
        if k == len(self.parts):
            self.parts, self.hashes = (np.concatenate([x, np.zeros_like(x)]) for x in (self.parts, self.hashes))
        self.parts[k], self.hashes[k] = sum(map(self.weights.__getitem__, word_features(word))), hashed(word)
        return k

    def numbers(self, words: list[str]) -> np.ndarray:
        """Cleared between texts alone, so that a text's numbers hold."""
        if len(self) >= CACHED:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))


def scorer(model: tuple[np.ndarray, float] | None):
    """words -> probability of the good class; without a model all are good."""
    if model is None:
        return lambda words: 1.0
    shares, bias, same = Shares(model[0]), model[1], float(model[0][SAME])
    of_ngrams = model[0][ALL:] * NGRAM_SHARE

    def probability(words: list[str]) -> float:
        score = bias
        if words:
            at = shares.numbers(words)
            total = shares.parts[at].sum() + same * np.count_nonzero(at[1:] == at[:-1])
            if len(of_ngrams):
                total += of_ngrams[ngrams_of(shares.hashes[at])].sum()
            score += total / len(words)
        return float(1 / (1 + np.exp(-min(max(score, -30.0), 30.0))))

    return probability


def kept_rows(docs: DataFrame, judge, text_col: str = "text") -> DataFrame:
    """Rows of docs, all columns, whose words and text the judge accepts. judge() is made once a task."""
    place = docs.columns.index(text_col)

    def run(batches):
        accepts = judge()
        for batch in batches:
            keep = [bool(accepts(words_of(t or ""), t or "")) for t in batch.column(place).to_pylist()]
            yield batch.filter(pa.array(keep, type=pa.bool_()))

    return docs.mapInArrow(released(run), docs.schema)

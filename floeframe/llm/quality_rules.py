"""Quality rules: counts over whole texts, and a calibrated classifier trained on labelled rows.

A text fails outright with under LEAST_WORDS words or over half of its words in repeated three-word windows.
The rest gets the verdict of the hashed linear scorer over words, two and three words in a row and character trigrams, fitted on a bounded sample of the labelled rows
(linear.SAMPLE) and calibrated on rows held out; it is kept from THRESHOLD on.

Null text counts as empty: no words, so it fails. Repeated rows get equal results. Without labels of both kinds
the classifier keeps all. Labels that repeat or contradict each other each count. Null labels or ids teach nothing.
An empty table gives an empty one; other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from floeframe.llm import linear
from floeframe.llm.common import arrow_map, ids_and_text
from floeframe.llm.words import repeated_words, words_of

LEAST_WORDS, MOST_REPEATED = 50, 50
THRESHOLD = 0.5
SYMBOLS = "#*$%&|<>"

SCHEMA = StructType([StructField("doc_id", LongType())] + [StructField(n, LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] + [StructField("base_failed", BooleanType()), StructField("kept", BooleanType()), StructField("score", DoubleType())])


def duplicate_lines(text: str) -> int:
    seen, n = set(), 0
    for line in text.split("\n"):
        if line in seen:
            n += bool(line.strip("\t\n\x0b\x0c\r "))
        seen.add(line)
    return n


def counts(words: list[str], text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    return len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), duplicate_lines(text) if "\n" in text else 0, repeated_words(words)


def failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < LEAST_WORDS or 100 * n_repeat_words > MOST_REPEATED * n_words


def trained(docs: DataFrame, labels: DataFrame):
    """The scorer's weights, from about linear.SAMPLE labelled rows of docs."""
    told = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") > 0).cast("double").alias("target"))
    few = linear.sampled(told, told.count())
    # the sample is bounded by linear.SAMPLE, so it may be broadcast
    texts = ids_and_text(docs).join(F.broadcast(few), "doc_id").select("text", "target")
    return linear.fitted(linear.examples(texts, ngrams=True), ngrams=True)


def rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """SCHEMA of every row of docs."""
    model = trained(docs, labels)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    made = []

    def columns(batch):
        if not made:
            made.append(linear.scorer(sent.value))
        rows = []
        for text in batch.column(1).to_pylist():
            words = words_of(text)
            c = counts(words, text)
            bad, score = failed(c[0], c[4]), made[0](words)
            rows.append((*c, bad, not bad and score >= THRESHOLD, score))
        return [batch.column(0), *(zip(*rows) if rows else [[]] * 8)]

    return arrow_map(ids_and_text(docs), columns, SCHEMA)


def passed(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that are kept, all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(trained(docs, labels))

    def judge():
        probability = linear.scorer(sent.value)
        return lambda words, text: len(words) >= LEAST_WORDS and not failed(len(words), repeated_words(words)) and probability(words) >= THRESHOLD

    return linear.kept_rows(docs, judge)

"""Quality classifier from weak labels.

LABELLERS are overlapping heuristics, each of which votes good, bad or nothing on a text. Expectation maximisation
over the counts of vote patterns of all documents (at most 3 ** len(LABELLERS) of them) estimates the share of good
documents and how often each labeller votes what on good and on bad ones. The posterior of a pattern labels the
documents that have it; with these labels, on a bounded sample (linear.SAMPLE), a hashed linear scorer is trained,
which then scores every document. Documents from THRESHOLD on are kept.

Null text counts as empty: no labeller votes, the scorer has only its intercept. Repeated rows get equal results.
Where votes tell nothing apart, all are kept. An empty table gives an empty one; other columns play no part.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField, StructType

from floeframe.llm import linear
from floeframe.llm.common import arrow_map, ids_and_text
from floeframe.llm.words import repeated_words, words_of

THRESHOLD = 0.5
ROUNDS = 200
#: Frequent short words of four languages (fixed values).
FUNCTION_WORDS = frozenset("the of and to in is that for it with as on be at by this are or an from la de el que en y los se del las un por con una su para le les des et du une est pour dans der die und den von zu das mit sich auf ist im dem nicht ein eine".split())
EDGE = re.compile(r"[^\w\s]{2,}$")
ENDS = re.compile(r"[.!?]")


def ratio_vote(bad: float, good: float):
    """Bad from the first share on, good up to the second, nothing between; either may be the larger."""
    if bad > good:
        return lambda x: "0" if x >= bad else "1" if x <= good else "-"
    return lambda x: "0" if x <= bad else "1" if x >= good else "-"


#: name, least words of a text to vote on, share that it looks at, vote on the share.
LABELLERS = (
    ("symbols", 5, lambda w, t: sum(map(t.count, "#*$%&|<>")) / max(len(t), 1), ratio_vote(0.03, 0.004)),
    ("capitals", 5, lambda w, t: sum(x.isupper() for x in w) / len(w), ratio_vote(0.4, 0.1)),
    ("word ends", 5, lambda w, t: sum(EDGE.search(x) is not None for x in w) / len(w), ratio_vote(0.25, 0.03)),
    ("lone marks", 5, lambda w, t: sum(len(x) == 1 and not x.isalnum() for x in w) / len(w), ratio_vote(0.15, 0.01)),
    ("repetition", 50, lambda w, t: repeated_words(w) / len(w), ratio_vote(0.4, 0.1)),
    ("variety", 50, lambda w, t: len(set(w)) / len(w) / min(1.0, 8 / len(w) ** 0.5), ratio_vote(0.3, 0.8)),
    ("neighbours", 20, lambda w, t: linear.repeats(w) / len(w), ratio_vote(0.2, 0.05)),
    ("function words", 20, lambda w, t: sum(x.lower() in FUNCTION_WORDS for x in w) / len(w), ratio_vote(0.02, 0.12)),
    ("sentences", 20, lambda w, t: len(ENDS.findall(t)) / len(w), ratio_vote(0.5, 0.2)),
)


def votes(words: list[str], text: str) -> str:
    return "".join(vote(share(words, text)) if len(words) >= least else "-" for _, least, share, vote in LABELLERS)


def estimated(patterns: list[tuple[str, int]]) -> tuple[dict[str, float], np.ndarray, float]:
    """(pattern -> posterior of good, P(vote | class) as [labeller, class, vote of "01-"], share of good)."""
    patterns = sorted(patterns)
    n = np.array([float(k) for _, k in patterns])
    code = np.array([["01-".index(v) for v in p] for p, _ in patterns])
    each = np.arange(code.shape[1])
    # voters agree more often than not: begin from the majority
    good = np.array([(1 + p.count("1")) / (2 + p.count("1") + p.count("0")) for p, _ in patterns])
    for _ in range(ROUNDS):
        share = float(np.clip((n * good).sum() / n.sum(), 1e-6, 1 - 1e-6))
        table = np.empty((code.shape[1], 2, 3))
        for klass, weight in enumerate((n * (1 - good), n * good)):
            for vote in range(3):
                table[:, klass, vote] = ((code == vote) * weight[:, None]).sum(0) + 0.5
        table /= table.sum(2, keepdims=True)
        log = np.log(table)
        # nothing is learnt from silence: it depends on a text's length, not on its quality
        log[:, :, 2] = 0.0
        odds = np.log(share / (1 - share)) + (log[each, 1, code] - log[each, 0, code]).sum(1)
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        done = abs(new - good).max() < 1e-9
        good = new
        if done:
            break
    return {p: float(g) for (p, _), g in zip(patterns, good)}, table, share


def voted(docs: DataFrame) -> DataFrame:
    """(doc_id, votes) of every row of docs."""
    schema = StructType([StructField("doc_id", LongType()), StructField("votes", StringType())])
    return arrow_map(ids_and_text(docs), lambda batch: [batch.column(0), [votes(words_of(t), t) for t in batch.column(1).to_pylist()]], schema)


def trained(docs: DataFrame):
    """The scorer's weights; None where votes tell nothing apart."""
    patterns = [tuple(r) for r in voted(docs).groupBy("votes").count().collect()]  # 3 ** len(LABELLERS) rows at most
    if not patterns:
        return None
    posterior, _, _ = estimated(patterns)
    few = linear.sampled(ids_and_text(docs), sum(n for _, n in patterns))
    return linear.fitted(linear.examples(few.select("text"), lambda words, text: posterior[votes(words, text)]))


SCHEMA = StructType([StructField("doc_id", LongType()), StructField("score", DoubleType()), StructField("kept", BooleanType())])


def classified(docs: DataFrame) -> DataFrame:
    """(doc_id, score, kept) of every row of docs."""
    sent = docs.sparkSession.sparkContext.broadcast(trained(docs))
    schema = to_arrow_schema(SCHEMA)

    def run(batches):
        probability = linear.scorer(sent.value)
        for batch in batches:
            scores = [probability(words_of(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array([s >= THRESHOLD for s in scores], pa.bool_())], schema=schema)

    return ids_and_text(docs).mapInArrow(run, SCHEMA)


def passed(docs: DataFrame) -> DataFrame:
    """The rows of docs that are kept, all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(trained(docs))

    def judge():
        probability = linear.scorer(sent.value)
        return lambda words, text: probability(words) >= THRESHOLD

    return linear.kept_rows(docs, judge)

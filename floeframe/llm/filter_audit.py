"""What five filters remove, alone and one after the other, in each of their 120 orders.

A document fails each filter or it doesn't, so it has one of 32 masks, and for a mask and an order there is one filter
that removes it, or none: a table of 32 by 120 steps, made once, says which. Batches look their masks up there, count
(part, order, step, label) by bincount into a task's arrays, and Spark adds the arrays of all tasks; all else follows
from these removals and the counts of masks.

Filter E needs the table as a whole. Texts are compared by SHA-256. Documents that share text, part, labels and mask
come together in narrow rows, counted by id first, so that a text that a third of all documents share is a few rows
before they meet; the smallest id of a text passes, others fail. No text is shuffled.

Null text counts as empty, null lang as the empty part. A document without id is not identical to any smaller id, nor
is one for others: it passes E. Repeated rows (equal id and text) count each, and none is the other's smaller. An id
with several texts is several documents. Of an id's labels one that is 1 counts. An empty table gives no rows; other
columns play no part.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from floeframe.llm.common import arrow_map
from floeframe.llm.words import words_of

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in itertools.permutations(FILTERS)]
STEPS, MASKS, KINDS = len(FILTERS), 1 << len(FILTERS), 4
SIGNS = re.compile(r"[#$%&*|]")
#: Parts that a task counts before it hands their arrays on.
PARTS = 256


def first_failures() -> np.ndarray:
    """(mask, order) -> the step that removes, STEPS where none does."""
    bits = np.array([[FILTERS.index(f) for f in order] for order in ORDERS])
    fails = np.arange(MASKS)[:, None, None] >> bits[None] & 1
    return np.where(fails.any(2), fails.argmax(2), STEPS)


def failed(text: str) -> int:
    """The bits of the filters A to D that a text fails."""
    words, raw = words_of(text), np.frombuffer(text.encode(), dtype=np.uint8)
    capitals = int(((raw >= 65) & (raw <= 90)).sum())
    a, b = len(words) < 200, 100 * len(set(words)) < 50 * len(words)
    return a | b << 1 | (100 * capitals > 3 * len(text)) << 2 | bool(SIGNS.search(text)) << 3


def looked_at(docs: DataFrame) -> DataFrame:
    """(doc_id, part, digest, mask) of every row, filters A to D in the mask."""
    text, part = F.coalesce(F.col("text").cast("string"), F.lit("")), F.coalesce(F.col("lang").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), part.alias("part"), text.alias("text"))

    def columns(batch):
        texts = batch.column(2).to_pylist()
        return [batch.column(0), batch.column(1), [hashlib.sha256(t.encode()).digest() for t in texts], [*map(failed, texts)]]

    return arrow_map(rows, columns, StructType.fromDDL("doc_id long, part string, digest binary, mask int"))


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """rows with kind: 1 for good, 2 for toxic, 3 for both."""
    one = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("int"))
    by_id = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    kinds = by_id.agg((one("quality") + 2 * one("toxic")).alias("kind")).where("kind > 0")
    # rows without id have a key each, so that they don't meet in one task
    known = F.col("doc_id").isNotNull()
    keyed = rows.withColumns({"key": F.coalesce("doc_id", F.monotonically_increasing_id()), "known": known})
    keys = kinds.select(F.col("doc_id").alias("key"), F.lit(True).alias("known"), "kind")
    return keyed.join(keys, ["key", "known"], "left").drop("key", "known").fillna(0, ["kind"])


def with_copies(rows: DataFrame) -> DataFrame:
    """(part, mask, kind, n): the documents of each sort of each text, filter E in the mask."""
    sort = ["digest", "part", "kind", "mask"]
    by_id = rows.groupBy(*sort, "doc_id").agg(F.count("*").alias("n"))
    least = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    without = F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0))
    sorts = by_id.groupBy(*sort).agg(F.sum("n").alias("n"), least.alias("least"), without.alias("without"))
    of_text = F.min("least.doc_id").over(Window.partitionBy("digest"))  # as many rows as the text has sorts
    is_least = (F.col("least.doc_id") == F.col("of_text")).cast("long")
    passes = F.col("without") + F.coalesce(is_least * F.col("least.n"), F.lit(0))
    both = F.array(F.struct(F.col("mask"), passes.alias("n")), F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - passes).alias("n")))
    return sorts.withColumn("of_text", of_text).select("part", "kind", F.explode(both).alias("x")).select("part", "kind", "x.*").where("n > 0")


#: A task's sums: at slot order * (STEPS + 1) + step removals by kind, behind them the masks.
SLOTS = len(ORDERS) * (STEPS + 1)
SUMS = "part string, slot int, " + ", ".join(f"k{k} long" for k in range(KINDS))


def counted(sorts: DataFrame) -> DataFrame:
    """SUMS over all rows of (part, kind, mask, n)."""
    schema = StructType.fromDDL(SUMS)
    arrow, steps = to_arrow_schema(schema), first_failures()
    places = np.arange(len(ORDERS)) * (STEPS + 1)

    def counts(kind: np.ndarray, mask: np.ndarray, n: np.ndarray) -> np.ndarray:
        removals = ((places + steps[mask]) * KINDS + kind[:, None]).ravel()
        made = np.bincount(removals, np.repeat(n, len(ORDERS)), SLOTS * KINDS)
        masks = np.bincount(mask * KINDS + kind, n, MASKS * KINDS)
        return np.concatenate([made, masks]).astype(np.int64).reshape(-1, KINDS)

    def out(held: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for part, sums in held.items():
            (slots,) = sums.any(1).nonzero()
            columns = [[part] * len(slots), slots.astype(np.int32), *sums[slots].T]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            coded = batch.column(0).dictionary_encode()
            part, kind, mask, n = coded.indices.to_numpy(), *(batch.column(k).to_numpy() for k in (1, 2, 3))
            order = np.argsort(part, kind="stable")
            ends = np.cumsum(np.bincount(part, minlength=len(coded.dictionary)))
            for name, at in zip(coded.dictionary.to_pylist(), np.split(order, ends[:-1])):
                made = counts(kind[at], mask[at], n[at])
                held[name] = held[name] + made if name in held else made
                if len(held) >= PARTS:
                    yield from out(held)
                    held = {}
        yield from out(held)

    named = sorts.select("part", F.col("kind").cast("int"), F.col("mask").cast("int"), F.col("n").cast("long"))
    sums = named.mapInArrow(run, schema).groupBy("part", "slot")
    return sums.agg(*(F.sum(f"k{k}").alias(f"k{k}") for k in range(KINDS)))


RESULT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def told(sums: DataFrame) -> DataFrame:
    """RESULT of each part from its sums: every order and step, zeros too."""
    whole = sums.groupBy("part").agg(F.collect_list(F.struct("slot", *(f"k{k}" for k in range(KINDS)))).alias("sums"))
    schema = StructType.fromDDL(RESULT)
    arrow = to_arrow_schema(schema)

    def of_part(part: str, rows: list[dict]) -> list[list]:
        held = np.zeros((SLOTS + MASKS, KINDS), dtype=np.int64)
        for row in rows:
            held[row["slot"]] = [row[f"k{k}"] for k in range(KINDS)]
        steps = held[:SLOTS].reshape(len(ORDERS), STEPS + 1, KINDS)[:, :STEPS]
        masks = held[SLOTS:].sum(1)
        fails = [int(masks[np.arange(MASKS) >> f & 1 == 1].sum()) for f in range(STEPS)]
        removed, good, toxic = steps.sum(2), steps[:, :, [1, 3]].sum(2), steps[:, :, [2, 3]].sum(2)
        kept = masks.sum() - removed.cumsum(1)
        which = np.array([[FILTERS.index(f) for f in order] for order in ORDERS])
        shapley = np.bincount(which.ravel(), removed.ravel(), STEPS).astype(np.int64)
        alone = masks[1 << np.arange(STEPS)]
        grid = [kept, removed, np.array(fails)[which] - removed, alone[which], good, toxic, shapley[which]]
        names = [[part] * which.size, [o for o in ORDERS for _ in range(STEPS)], [*range(1, STEPS + 1)] * len(ORDERS)]
        return names + [x.ravel() for x in grid]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                made = of_part(part, rows)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(made, arrow)], schema=arrow)

    return whole.mapInArrow(run, schema)


def audited(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """RESULT: a row for each part, order of the filters and step."""
    return told(counted(with_copies(labelled(looked_at(docs), labels))))

"""Content-addressed store of token ids.

A document's ids, its end id included, are cut into chunks where a rolling hash of the last WINDOW ids has its
high bits at zero, so equal passages give equal chunks wherever they stand. A chunk's address is the BLAKE2b
digest of its bytes. The store is a folder in shared storage:

    chunks/   digest, n, payload      each unique chunk once
    recipes/  number, doc_id, start, n_tokens, digests, counts, leaf    one row a document, ascending doc_id
    tree/     level, number, digest   Merkle tree over the recipes' leaves, FAN children a node

`write` makes one, `checks` reads it back and returns each document's place and checksum, `documents` returns the
ids. Both recompute every chunk's digest from the stored bytes, and the tree's root from the recipes, and raise on
a difference. Only the ids' first occurrences in a task are shuffled with their bytes, and recipes are dealt by
document, so a chunk that a third of all documents share is no hot key.

Null text counts as empty: the end id alone. Repeated rows are documents of their own, side by side; null ids come
first. An empty table gives an empty store. Other columns play no part.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from floeframe.llm.common import arrow_map, ids_and_text, new_path, removed
from floeframe.llm.tokenize import packed, word_encoder

WINDOW, CUT_BITS, LONGEST = 8, 9, 4096
FAN = 1024
#: Digests that a task remembers to send a chunk's bytes only once.
REMEMBERED = 200_000
DIGEST = 16

ROWS = StructType([StructField("kind", StringType()), StructField("doc_id", LongType()), StructField("row", LongType()), StructField("n", LongType()), StructField("digests", BinaryType()), StructField("counts", ArrayType(IntegerType())), StructField("payload", BinaryType())])
#: Odd multipliers of the rolling hash, powers of one.
MULTIPLIERS = [pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(WINDOW)]


def cuts(ids: np.ndarray) -> list[int]:
    """Where chunks end."""
    rolled = np.zeros(len(ids), dtype=np.uint64)
    wide = ids.astype(np.uint64)
    for back, m in enumerate(MULTIPLIERS[: len(ids)]):
        rolled[back:] += wide[: len(ids) - back] * np.uint64(m)
    ends = np.flatnonzero(rolled >> np.uint64(64 - CUT_BITS) == 0) + 1
    out, at = [], 0
    for end in [*ends.tolist(), len(ids)]:
        out += range(at + LONGEST, end, LONGEST)
        if end > at:
            out.append(end)
        at = end
    return out


def digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=DIGEST).digest()


def _cut_documents(vocabulary: str, end_id: int, width: int):
    schema = to_arrow_schema(ROWS)

    def run(batches):
        encode, end, sent = word_encoder(vocabulary), packed([end_id]), set()
        for batch in batches:
            rows: list[tuple] = []
            for doc, row, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(1).to_pylist()):
                ids = np.frombuffer(encode(text) + end, dtype="<u4")
                data, at, digests, counts = memoryview(ids.astype(f"<u{width}").tobytes()), 0, [], []
                for stop in cuts(ids):
                    payload = data[at * width : stop * width]
                    digests.append(d := digest(payload))
                    counts.append(stop - at)
                    if d not in sent:
                        if len(sent) >= REMEMBERED:
                            sent.clear()
                        sent.add(d)
                        rows.append(("chunk", None, None, stop - at, d, None, bytes(payload)))
                    at = stop
                rows.append(("recipe", doc, row, len(ids), b"".join(digests), counts, None))
            yield pa.RecordBatch.from_arrays([pa.array(x, type=f.type) for x, f in zip(zip(*rows) if rows else [[]] * len(schema), schema)], schema=schema)

    return run


def _first_of_each(batches):
    """After chunks are dealt by digest: those not yet seen in this partition, and all recipes."""
    seen = set()
    for batch in batches:
        keep = []
        for kind, d in zip(batch.column(0).to_pylist(), batch.column(4).to_pylist()):
            keep.append(kind == "recipe" or d not in seen)
            if kind == "chunk":
                seen.add(d)
        yield batch.filter(pa.array(keep, type=pa.bool_()))


def _root(leaves: DataFrame, path: str) -> str | None:
    """The root of the Merkle tree over leaves (number, digest), whose levels above them are written below path.

    A level is made from the written one below it, whose nodes meet by FAN; so levels shrink fast and none is made twice.
    """
    spark, level, nodes = leaves.sparkSession, 0, leaves
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("number", "digest"))), lambda x: x["digest"])
    while True:
        level += 1
        above = nodes.groupBy(F.floor(F.col("number") / FAN).alias("above"))
        above = above.agg(F.sha2(F.array_join(ordered, ""), 256).alias("digest"))
        at = f"{path}/level={level}"
        above.select(F.col("above").alias("number"), "digest").write.option("compression", "zstd").parquet(at)
        nodes = spark.read.schema("number long, digest string").parquet(at)
        few = nodes.limit(2).collect()
        if len(few) <= 1:
            return few[0]["digest"] if few else None


def _leaf() -> Column:
    return F.sha2(F.concat_ws(",", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("start"), F.col("n_tokens"), F.hex("digests"), F.array_join("counts", ",")), 256)


def write(docs: DataFrame, path: str, vocabulary: str, end_id: int = 1, width: int = 2) -> None:
    """Store the ids of docs under path; width: bytes of a stored id, 2 for vocabularies of at most 65,536."""
    spark = docs.sparkSession
    rows = ids_and_text(docs).withColumn("row", F.xxhash64("doc_id", "text")).mapInArrow(_cut_documents(vocabulary, end_id, width), ROWS)
    dealt = rows.repartition(F.when(F.col("kind") == "chunk", F.xxhash64("digests")).otherwise(F.xxhash64("doc_id", "row")))
    dealt.mapInArrow(_first_of_each, ROWS).write.partitionBy("kind").option("compression", "zstd").parquet(f"{path}/cut")
    cut = spark.read.schema(ROWS).option("basePath", f"{path}/cut").parquet(f"{path}/cut")
    by_doc = cut.where(F.col("kind") == "recipe").select("doc_id", "row", F.col("n").alias("n_tokens"), "digests", "counts").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "row").withColumn("part", F.spark_partition_id())
    by_doc.write.option("compression", "zstd").parquet(f"{path}/ordered")
    ordered = spark.read.parquet(f"{path}/ordered")
    # one row for each of the partitions, which were just made
    totals, placed, before, first = sorted(map(tuple, ordered.groupBy("part").agg(F.sum("n_tokens"), F.count("*")).collect())), [], 0, 0
    for part, n, count in totals:
        placed.append((part, before, first))
        before, first = before + n, first + count
    places = spark.createDataFrame(placed, "part int, before long, first long")
    order = Window.partitionBy("part").orderBy("doc_id", "row")
    recipes = (
        ordered.join(F.broadcast(places), "part")
        .withColumn("start", F.col("before") + F.sum("n_tokens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n_tokens"))
        .withColumn("number", F.col("first") + F.row_number().over(order) - 1)
        .select("number", "doc_id", "start", "n_tokens", "digests", "counts")
        .withColumn("leaf", _leaf())
    )
    recipes.write.option("compression", "zstd").parquet(f"{path}/recipes")
    removed(spark, f"{path}/ordered")
    _root(spark.read.parquet(f"{path}/recipes").select("number", F.col("leaf").alias("digest")), f"{path}/tree")


def _verified_recipes(spark: SparkSession, path: str) -> DataFrame:
    recipes = spark.read.parquet(f"{path}/recipes")
    tree = spark.read.schema("number long, digest string, level int").parquet(f"{path}/tree")
    top = tree.orderBy(F.desc("level")).first()
    again = new_path(spark, "tree")
    found = _root(recipes.select("number", _leaf().alias("digest")), again)
    removed(spark, again)
    if (top["digest"] if top else None) != found:
        raise ValueError(f"{path}: the recipes don't give the root of the tree")
    return recipes


def _chunks(spark: SparkSession, path: str, width: int, with_payload: bool) -> DataFrame:
    """(digest, n, crc[, payload]) of each chunk, its digest recomputed from the stored bytes."""
    schema = StructType([StructField("digest", BinaryType()), StructField("n", LongType()), StructField("crc", LongType()), StructField("payload", BinaryType())][: 3 + with_payload])

    def columns(batch):
        sums, counts = [], []
        for d, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if digest(payload) != d:
                raise ValueError(f"{path}: a chunk isn't what its digest says")
            ids = np.frombuffer(payload, dtype=f"<u{width}").astype("<u4")
            sums.append(zlib.crc32(ids))
            counts.append(len(ids))
        return [batch.column(0), counts, sums, batch.column(1)][: 3 + with_payload]

    stored = spark.read.schema(ROWS).option("basePath", f"{path}/cut").parquet(f"{path}/cut").where(F.col("kind") == "chunk")
    return arrow_map(stored.select("digests", "payload"), columns, schema)


def _steps(recipes: DataFrame) -> DataFrame:
    """(number, at, digest) of each document's chunks."""
    each = recipes.select("number", "digests", F.explode(F.sequence(F.lit(0), F.size("counts") - 1)).alias("at"))
    return each.select("number", "at", F.substring("digests", F.col("at") * DIGEST + 1, F.lit(DIGEST)).alias("digest"))


def checks(spark: SparkSession, path: str, width: int = 2) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from what the store holds."""
    recipes = _verified_recipes(spark, path)
    joined = _steps(recipes).join(_chunks(spark, path, width, False), "digest", "left")
    found = joined.groupBy("number").agg(F.array_sort(F.collect_list(F.struct("at", "n", "crc"))).alias("parts"))
    rows = recipes.select("number", "doc_id", "start", "n_tokens").join(found, "number")
    schema = StructType([StructField("doc_id", LongType()), StructField("start", LongType()), StructField("n_tokens", LongType()), StructField("ids_crc32", LongType())])

    def columns(batch):
        zeros, sums = bytes(4 * LONGEST), []
        for n_tokens, parts in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            crc = 0
            for part in parts:  # crc32 is affine: what precedes shifts by as many zero bytes as follow
                gap = zeros[: 4 * part["n"]]
                crc = zlib.crc32(gap, crc) ^ zlib.crc32(gap) ^ part["crc"]
            if sum(part["n"] for part in parts) != n_tokens:
                raise ValueError(f"{path}: a document's chunks don't have its number of ids")
            sums.append(crc)
        return [batch.column(0), batch.column(1), batch.column(2), sums]

    return arrow_map(rows.select("doc_id", "start", "n_tokens", "parts"), columns, schema)


def documents(spark: SparkSession, path: str, width: int = 2) -> DataFrame:
    """(doc_id, start, ids array<int>) of every document, rebuilt from chunks."""
    recipes = _verified_recipes(spark, path)
    joined = _steps(recipes).join(_chunks(spark, path, width, True), "digest", "left")
    found = joined.groupBy("number").agg(F.array_sort(F.collect_list(F.struct("at", "payload"))).alias("parts"))
    schema = StructType([StructField("doc_id", LongType()), StructField("start", LongType()), StructField("ids", ArrayType(IntegerType()))])

    def columns(batch):
        ids = [np.frombuffer(b"".join(p["payload"] for p in parts), dtype=f"<u{width}").astype("<i4") for parts in batch.column(2).to_pylist()]
        return [batch.column(0), batch.column(1), [x.tolist() for x in ids]]

    return arrow_map(recipes.select("number", "doc_id", "start").join(found, "number").select("doc_id", "start", "parts"), columns, schema)

r"""N-gram Jaccard join: documents whose sets of five-word shingles have a similarity of 0.8 or more.

Sizes a and b with similarity 0.8 differ in at most (a + b) / 9 shingles. Shingles are hashed to GROUPS as many as
the size class has, about 1.5 to 3 a group, so documents that are that similar agree on all but so many groups: of
a document's groups, in the order of their numbers, the first a / 4 + 1 must hold one that the other has with
equal content among its own first. That content's hash is the partition that both meet in (a class has a factor two
of sizes; documents near its end also enter the next). Below SINGLE shingles each shingle is a group of its own.

In a partition, a document is first compared with one other, the one that leads most of its partitions: copies find
each other so, however many they are, and what links is contracted. Partitions that still hold different components
then go through the count-vector index: shingles are hashed to DIMENSIONS groups, the counts are points, points are
packed by size into the leaves of an R-tree, and the summed coordinate minima of two leaves' upper corners, then of
two points, bound the overlap. Pairs that survive are verified on the shingles of the whole texts. Partitions are
dealt by their own number, those above BLOCK documents as pairs of blocks, so a family of thousands of copies is
searched in as many tasks as it has partitions. Two documents that share many are to be found in one of them only:
each brings its FIRST smallest partitions along, and a pair is left to a smaller partition that both lists hold. In
the smallest that two documents share no such partition can be, so every pair that could link is compared, or
already known to hang together.

Shingles are compared by 64-bit hashes. Null text or no words: an empty set, linked with nothing. Fewer than five
words: the sequence is the one shingle. Rows that share an id are one node, linked with whatever any of them links
with: each different text of an id is searched under a key of its own. A null id takes no part: its component is
null. An empty table gives an empty one; other columns play no part.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from floeframe.llm.common import Scratch, ids_and_text, new_path, released, removed, written
from floeframe.llm.components import components
from floeframe.llm.words import ascii_lower, words_of

WIDTH, SINGLE, DIMENSIONS, BLOCK, LEAF = 5, 128, 192, 1024, 32
#: Coordinates of a second, wider vector that longer documents have besides: with few, they all look alike.
WIDE, LONG = 2048, 512
#: A coordinate is a byte; the largest one stands for anything from it on.
FULL = 255
#: Words of which a task keeps the hashes.
CACHED = 200_000
#: Smallest partitions that a document brings along, so that a pair is found once.
FIRST = 16
#: Rows that a task hands on at once, so that long documents fill no large batch.
SLICE = 256
STEP, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: Bits of the filter that says which texts a round needs: 8 MB whatever their number.
FILTER_BITS = 1 << 26


class Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= CACHED:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX
    x = (x ^ (x >> np.uint64(29))) * STEP
    return x ^ (x >> np.uint64(32))


def shingles(text: str, hashes: Hashes) -> np.ndarray:
    """Sorted hashes of the distinct shingles."""
    words = words_of(ascii_lower(text))
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    n = max(len(h) - WIDTH + 1, 1)
    rolled = np.full(n, min(len(h), WIDTH), dtype=np.uint64)
    for k in range(min(WIDTH, len(h))):
        rolled = rolled * STEP + h[k : k + n]
    return np.unique(mixed(rolled))


def grouped(s: np.ndarray, groups: int, seed: int, most: int) -> np.ndarray:
    """Hashes of the contents of the first `most` groups that hold a shingle."""
    group = (s >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)  # ascending, as s is
    at = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])[: most + 1]
    end = at[most] if len(at) > most else len(s)
    content = np.add.reduceat(mixed(s[:end] + np.uint64(1)), at[:most])
    return mixed(content * STEP + group[at[:most]] * MIX + np.uint64(seed))


def partitions(s: np.ndarray) -> np.ndarray:
    n = len(s)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    most, level = n // 4 + 1, max(n, SINGLE // 2).bit_length() - 1
    end = 1 << (level + 1)
    out = [mixed(s[:most] + STEP) if n < SINGLE else grouped(s, int((1 << level) / 1.5), level, most)]
    if 5 * n >= 4 * end:
        out.append(grouped(s, int(end / 1.5), level + 1, most))
    return np.concatenate(out)


def counts(s: np.ndarray, dimensions: int = DIMENSIONS) -> bytes:
    places = (s >> np.uint64(7)).astype(np.int64) % dimensions
    return np.minimum(np.bincount(places, minlength=dimensions), FULL).astype(np.uint8).tobytes()


SETS = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("n", LongType()),
        StructField("print", LongType()),
        StructField("counts", BinaryType()),
        StructField("wide", BinaryType()),
        StructField("partitions", ArrayType(LongType())),
    ]
)


def print_of(s: np.ndarray) -> int:
    """One number for a whole set."""
    return int((mixed(s ^ STEP).sum(dtype=np.uint64) + np.uint64(len(s))).astype(np.int64))


def slices(batches):
    for batch in batches:
        for at in range(0, max(batch.num_rows, 1), SLICE):
            yield batch.slice(at, SLICE)


def sets(docs: DataFrame) -> DataFrame:
    """SETS of every row of docs. Of rows with an id and equal sets in a task, only the first has counts and partitions."""
    schema = to_arrow_schema(SETS)

    def run(batches):
        hashes, seen = Hashes(), set()
        for batch in slices(batches):
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                s = shingles(text, hashes)
                mark = print_of(s) if len(s) else None
                if doc is None or mark is None or mark in seen:
                    rows.append((doc, len(s), mark, None, None, None))
                    continue
                seen.add(mark)
                wide = counts(s, WIDE) if len(s) >= LONG else None
                rows.append((doc, len(s), mark, counts(s), wide, partitions(s).astype(np.int64)))
            columns = zip(*rows) if rows else [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema)], schema=schema)

    return ids_and_text(docs).mapInArrow(released(run), SETS)


def marked(keys: DataFrame, at) -> np.ndarray:
    """FILTER_BITS bits, those set that `at` gives for a row of keys: its size doesn't depend on their number."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(64)).cast("int"))
    words = keys.groupBy(F.shiftright(at, 6).cast("int").alias("w")).agg(F.bit_or(bit).alias("bits"))
    size = 4096

    def pack(g: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros(size, dtype=np.int64)
        out[g["w"].to_numpy() % size] = g["bits"].to_numpy()
        return pd.DataFrame({"chunk": [int(g["w"].iat[0]) // size], "bits": [out.tobytes()]})

    made = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    for row in words.groupBy(F.floor(F.col("w") / size)).applyInPandas(pack, "chunk int, bits binary").collect():
        made[row["chunk"] * size : (row["chunk"] + 1) * size] = np.frombuffer(bytes(row["bits"]), dtype=np.int64)
    return made


def needed_shingles(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, shingles) of at least the rows whose id is in ids (id): the filter drops most others before the shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(marked(ids, F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS))))
    rows = ids_and_text(docs).where(F.col("doc_id").isNotNull())
    rows = rows.select("doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS)).alias("at"))
    schema = StructType([StructField("doc_id", LongType()), StructField("shingles", ArrayType(LongType()))])
    arrow = to_arrow_schema(schema)

    def run(batches):
        hashes = Hashes()
        for whole in batches:
            at = whole.column(2).to_numpy()
            there = whole.filter(pa.array((sent.value[at >> 6] >> (at & 63)) & 1 == 1))
            for batch in slices([there]):
                made = [shingles(text, hashes).astype(np.int64) for text in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, arrow.field(1).type)], schema=arrow)

    return rows.mapInArrow(released(run), schema)


def entered(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """(key, partition) of at least those partitions of rows that are in heads; the filter drops most others."""
    sent = rows.sparkSession.sparkContext.broadcast(marked(heads, F.pmod("partition", F.lit(FILTER_BITS))))

    def keep(batches):
        for batch in batches:
            lists = batch.column(1)
            key = lists.flatten().to_numpy()
            at = key & (FILTER_BITS - 1)
            there = (sent.value[at >> 6] >> (at & 63)) & 1 == 1
            row = np.repeat(batch.column(0).to_numpy(), np.diff(lists.offsets.to_numpy()))
            yield pa.RecordBatch.from_arrays([pa.array(row[there]), pa.array(key[there])], names=["key", "partition"])

    return rows.select("key", "partitions").mapInArrow(released(keep), "key long, partition long")


def linked(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of pairs (a, b) whose texts have similarity 0.8 or more."""
    if pairs.limit(1).count() == 0:
        return pairs.select("a", "b")
    known = needed_shingles(docs, pairs.select(F.explode(F.array("a", "b")).alias("id")))
    side = lambda x: known.select(F.col("doc_id").alias(x), F.col("shingles").alias(f"{x}_set"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    sized = both.select("a", "b", F.size("a_set").alias("n"), F.size("b_set").alias("m"), F.size(F.array_intersect("a_set", "b_set")).alias("common"))
    return sized.where("common > 0 AND 100L * common >= 80L * (n + m - common)").select("a", "b")


def close(n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    return (5 * n_a >= 4 * n_b) & (5 * n_b >= 4 * n_a)


def as_points(column, dimensions: int = DIMENSIONS) -> np.ndarray:
    points = np.frombuffer(b"".join(column), dtype=np.uint8).reshape(-1, dimensions).astype(np.int32)
    return np.where(points == FULL, 1 << 20, points)


def roomy(points: np.ndarray, n: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the summed coordinate minima of the points at a and b leave room for a similarity of 0.8."""
    out = np.zeros(len(a), dtype=bool)
    for at in range(0, len(a), 8_000):
        x, y = a[at : at + 8_000], b[at : at + 8_000]
        out[at : at + 8_000] = 9 * np.minimum(points[x], points[y]).sum(1) >= 4 * (n[x] + n[y])
    return out


def first_lists(column) -> np.ndarray:
    """A row of FIRST partitions for each document, ascending; the largest number where it has fewer."""
    out = np.full((len(column), FIRST), np.iinfo(np.int64).max)
    for row, firsts in zip(out, column):
        row[: len(firsts)] = firsts
    return out


def left_here(firsts: np.ndarray, part: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the pairs of places a, b, found in partitions part, no smaller partition of both lists finds."""
    out = (firsts[a, 0] != firsts[b, 0]) | (firsts[a, 0] >= part)
    rest = np.flatnonzero(out)
    for at in range(0, len(rest), 8_000):
        k = rest[at : at + 8_000]
        x, y, p = firsts[a[k]], firsts[b[k]], part[k]
        shared = np.zeros(len(k), dtype=bool)
        for i in range(FIRST):
            shared |= (x[:, i] < p) & (x[:, i : i + 1] == y).any(1)
        out[k] = ~shared
    return out


def bounded(pairs: DataFrame, vectors: DataFrame, dimensions: int) -> DataFrame:
    """Those of pairs (a, b) whose summed coordinate minima leave room for a similarity of 0.8, or that lack a vector.

    vectors: (key, n, vector).
    """
    side = lambda x: vectors.select(F.col("key").alias(x), F.col("n").alias(f"{x}_n"), F.col("vector").alias(f"{x}_vector"))
    both = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")

    def keep(batches):
        for batch in batches:
            a, b, n_a, n_b, x, y = batch.columns
            good = np.ones(len(a), dtype=bool)
            known = np.flatnonzero(x.is_valid().to_numpy(False) & y.is_valid().to_numpy(False))
            for at in range(0, len(known), 2_000):
                k = pa.array(known[at : at + 2_000])
                room = np.minimum(as_points(x.take(k).to_pylist(), dimensions), as_points(y.take(k).to_pylist(), dimensions)).sum(1)
                u, v = n_a.take(k).to_numpy(), n_b.take(k).to_numpy()
                good[known[at : at + 2_000]] = (9 * room >= 4 * (u + v)) & close(u, v)
            yield batch.filter(pa.array(good)).select([0, 1])

    return both.select("a", "b", "a_n", "b_n", "a_vector", "b_vector").mapInArrow(released(keep), "a long, b long")


def index_pairs(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places in rows of one partition that are to be found there and that the R-tree's bounds let pass.

    rows: (partition, n, component, counts, firsts), and `block` where only pairs of unlike blocks are wanted.
    """
    order = np.argsort(rows["n"].to_numpy(), kind="stable")
    n, component = rows["n"].to_numpy()[order], rows["component"].to_numpy()[order]
    part = rows["partition"].to_numpy()[order]
    block = rows["block"].to_numpy()[order] if "block" in rows else None
    points, firsts = as_points(rows["counts"].iloc[order]), first_lists(rows["firsts"].iloc[order])
    starts = np.arange(0, len(n), LEAF)
    corner = np.maximum.reduceat(points, starts)
    least, most = n[starts], n[np.minimum(starts + LEAF, len(n)) - 1]
    found_a, found_b = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for i, s in enumerate(starts):
        near = np.flatnonzero(5 * most[i] >= 4 * least[i:]) + i
        bound = np.minimum(corner[i], corner[near]).sum(1)
        for j in near[9 * bound >= 4 * (least[i] + least[near])]:
            t = starts[j]
            a, b = np.arange(s, min(s + LEAF, len(n))), np.arange(t, min(t + LEAF, len(n)))
            ok = (component[a][:, None] != component[b][None]) & close(n[a][:, None], n[b][None])
            if i == j:
                ok &= a[:, None] < b[None]
            if block is not None:
                ok &= block[a][:, None] != block[b][None]
            x, y = np.nonzero(ok)
            x, y = a[x], b[y]
            good = left_here(firsts, part[x], x, y)
            x, y = x[good], y[good]
            good = roomy(points, n, x, y)
            found_a.append(order[x[good]])
            found_b.append(order[y[good]])
    return np.concatenate(found_a), np.concatenate(found_b)


def runs(batches, key: list[str], pairs_of):
    """pairs_of whole runs of equal keys in sorted batches. Runs are bounded: small partitions, or two blocks."""
    kept = None
    for batch in batches:
        frame = batch if kept is None else pd.concat([kept, batch])
        if len(frame):
            last = (frame[key] == frame[key].iloc[-1]).all(axis=1).to_numpy()
            kept = frame[last]
            yield pairs_of(frame[~last])
    if kept is not None:
        yield pairs_of(kept)


def ordered_pairs(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"a": np.maximum(ids[a], ids[b]), "b": np.minimum(ids[a], ids[b])}).drop_duplicates()


def in_small(batches):
    """Pairs (a, b) of different components that the bound lets pass, of partitions of LEAF rows at most: one leaf each."""

    def pairs_of(frame: pd.DataFrame) -> pd.DataFrame:
        part, ids, component, n = (frame[c].to_numpy() for c in ("partition", "key", "component", "n"))
        points, firsts = as_points(frame["counts"]), first_lists(frame["firsts"])
        found_a, found_b = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for step in range(1, min(LEAF, len(part))):
            apart = (part[step:] == part[:-step]) & (component[step:] != component[:-step])
            a = np.flatnonzero(apart & close(n[step:], n[:-step]))
            a = a[left_here(firsts, part[a], a, a + step)]
            a = a[roomy(points, n, a, a + step)]
            found_a.append(a)
            found_b.append(a + step)
        return ordered_pairs(ids, np.concatenate(found_a), np.concatenate(found_b))

    return runs(batches, ["partition"], pairs_of)


def in_large(batches):
    """Pairs (a, b) of each pair (i, j) of a larger partition's blocks, by the R-tree over the count vectors."""
    key = ["partition", "i", "j"]

    def pairs_of(frame: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"a": [], "b": []}).astype("int64")]
        for (_, i, j), g in frame.groupby(key, sort=False):
            a, b = index_pairs(g if i != j else g.drop(columns="block"))
            out.append(ordered_pairs(g["key"].to_numpy(), a, b))
        return pd.concat(out)

    return runs(batches, key, pairs_of)


def open_pairs(met: DataFrame, labels: DataFrame, points: DataFrame, keep: Scratch) -> DataFrame:
    """Pairs (a, b) of keys that share a partition, aren't known to hang together and that the bounds let pass.

    Of partitions with the same members, one is searched.
    """
    nodes = points.select("key", "doc_id", "n", "counts")
    nodes = nodes.join(labels.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left")
    nodes = nodes.withColumn("component", F.coalesce("component", "doc_id"))
    # a row repeated in several tasks enters its partitions in each: distinct, else equal members cancel in the mark
    entries = met.select("partition", "key").distinct().join(nodes.select("key", "doc_id", "component"), "key")
    member = keep(entries, "member")
    seen = member.groupBy("partition").agg(
        F.min("component").alias("low"),
        F.max("component").alias("high"),
        F.count("*").alias("members"),
        F.bit_xor(F.xxhash64("key")).alias("mark"),
        F.min("doc_id").alias("least"),
        F.max("doc_id").alias("most"),
    )
    alike = seen.where("low <> high").groupBy("members", "mark", "least", "most")
    one = alike.agg(F.min("partition").alias("partition")).select("partition", "members")
    open_ = keep(member.select("partition", "key", "component").join(one, "partition"), "open")
    # a document has at most a third as many partitions as words, so its list fits a row
    firsts = open_.groupBy("key").agg(F.slice(F.array_sort(F.collect_list("partition")), 1, FIRST).alias("firsts"))
    rows = open_.join(nodes.select("key", "n", "counts"), "key").join(firsts, "key")
    carried = ["key", "component", "n", "counts", "firsts"]
    small = rows.where(F.col("members") <= LEAF).select("partition", *carried)
    near = small.repartition("partition").sortWithinPartitions("partition").mapInPandas(released(in_small), "a long, b long")
    one_block = rows.where((F.col("members") > LEAF) & (F.col("members") <= BLOCK))
    one_block = one_block.withColumns({x: F.lit(0) for x in ("i", "j", "block")})
    large = rows.where(F.col("members") > BLOCK).withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
    large = large.withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    large = large.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    large = large.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    columns = ["partition", "i", "j", "block", *carried]
    dealt = one_block.select(columns).unionByName(large.select(columns)).repartition("partition", "i", "j")
    far = dealt.sortWithinPartitions("partition", "i", "j").mapInPandas(released(in_large), "a long, b long")
    return near.unionByName(far).distinct()


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of docs."""
    spark = docs.sparkSession
    keep = Scratch(spark, "near-copies")
    heavy = new_path(spark, "sets")
    whole = written(sets(docs), "sets", heavy)
    made = written(whole.select("doc_id", "n", "print"), "sizes")
    known = made.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    equal = known.groupBy("print").agg(F.min("doc_id").alias("b"))
    exact = known.join(equal, "print").select(F.col("doc_id").alias("a"), "b").where("a <> b").distinct()
    exact = keep(exact, "exact")
    first_ones = whole.where(F.col("partitions").isNotNull()).withColumn("key", F.xxhash64("doc_id", "print"))
    all_entered = first_ones.select("doc_id", "key", F.explode_outer("partitions").alias("partition"))
    members = all_entered.groupBy("partition").agg(
        F.min_by("key", "doc_id").alias("lead"),
        F.min("doc_id").alias("lead_id"),
        F.min("key").alias("low"),
        F.max("key").alias("high"),
    )
    heads = keep(members.where("low <> high").select("partition", "lead", "lead_id"), "heads")
    met = keep(entered(first_ones, heads).join(heads, "partition"), "met")
    # one leader for each text of a document: that of most of its partitions
    times = met.where("key <> lead").groupBy("key", "lead", "lead_id").agg(F.count("*").alias("times"))
    led = times.groupBy(F.col("key").alias("a")).agg(F.max_by("lead", F.struct("times", -F.col("lead_id"))).alias("b"))
    distinct_texts = first_ones.select("key", "doc_id", "print", "n", "counts").dropDuplicates(["key", "doc_id", "print"])
    points = keep(distinct_texts, "points")
    wide_ones = first_ones.where(F.col("wide").isNotNull()).select("key", "n", F.col("wide").alias("vector"))
    wide = keep(wide_ones.dropDuplicates(["key", "n"]), "wide")
    removed(spark, heavy)  # half of what the search writes, and no longer read

    def side(x: str, p: str) -> DataFrame:
        return points.select(F.col("key").alias(x), F.col("doc_id").alias(f"{x}_id"), F.col("print").alias(p))

    def named(pairs: DataFrame) -> DataFrame:
        return pairs.join(side("a", "p"), "a").join(side("b", "q"), "b").where("a_id <> b_id")

    def ids(pairs: DataFrame) -> DataFrame:
        return named(pairs).select(F.col("a_id").alias("a"), F.col("b_id").alias("b")).distinct()

    unequal = named(led).where("p <> q").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    short = points.select("key", "n", F.col("counts").alias("vector"))
    leaders = keep(bounded(bounded(unequal, short, DIMENSIONS), wide, WIDE).distinct(), "leaders")
    first = keep(linked(docs, ids(leaders)), "links")
    labels = components(exact.unionByName(first))
    met_again = open_pairs(met, labels, points, keep).join(leaders, ["a", "b"], "left_anti")
    tried = keep(bounded(met_again, wide, WIDE).distinct(), "pairs")
    second = keep(linked(docs, ids(tried)), "links")
    final = components(exact.unionByName(first).unionByName(second))
    keep.drop()
    sized = made.select("doc_id", F.col("n").alias("n_shingles"))
    found = sized.join(final.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left")
    return found.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of docs, all their columns, whose id is the smallest of their component; of equal ids one row, the one
    with the least digests of its text and of all its columns, whatever the order of tasks. Rows without id stay."""
    stay = classes(docs).where("doc_id = component_id").select(F.col("doc_id").alias("__id")).distinct()
    unnamed = docs.where(F.col("doc_id").isNull())
    text = F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)
    marked = docs.withColumns({"__id": F.col("doc_id").cast("long"), "__mark": F.concat_ws(":", text, F.hex(F.xxhash64(*docs.columns)))})
    least = marked.groupBy("__id").agg(F.min("__mark").alias("__mark")).join(stay, "__id", "left_semi")
    kept = marked.join(least, ["__id", "__mark"], "left_semi").dropDuplicates(["__id", "__mark"])
    return kept.select(*docs.columns).unionByName(unnamed)

"""Exact top-k by inner product: dual-tree search over cover trees.

Equal vectors are one class: a class stands for the k + 1 smallest ids that have its vector, which are all that can be
among any query's k best, and equal queries are searched once. So a vector that a third of all rows share is one point.

Of the trees, the upper level is shared: centres, chosen farthest first from a bounded sample (SAMPLE; more where
there are more centres), cover all vectors. Each vector goes to its nearest, and a cell's radius is the largest
distance of all its vectors, so the bound holds for every row and the sample decides only how tight it is. Cells are
salted into blocks of about BLOCK vectors. Below, each block is a cover tree of its own, as are the queries that meet
it, in the task that joins them: pairs of nodes are descended from the roots, and a pair is pruned where the product
of its centres and the covering radii can't reach the worst kth score of the node's queries.

A query first meets the block that holds it, which gives it a kth score to beat. Any other block it visits only where
the cell's bound can reach that score; a block is sent only to groups of at most about GROUP queries that ask for it.
Equal scores never prune, and go to the smaller id.

A component is multiplied by SCALE and rounded down; beyond LONG it counts as LONG. Sums are exact whatever the size:
in doubles, 64-bit integers or Python's integers, as the largest components demand; a score beyond LONG counts as
LONG. Vectors that are null, empty or hold null or non-finite components take no part; of rows that share an id the
least vector counts; a shorter vector counts as padded with zeros. An empty table gives an empty one; other columns
play no part.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from floeframe.llm.common import Scratch, written

SCALE = 64
#: The largest double below 2 ** 63.
LONG = float(2**63 - 1024)
CENTRES, MOST_CENTRES, SAMPLE, BLOCK, GROUP = 48, 1024, 2_000, 4096, 8192
#: Points of a leaf, and children of a node, of the trees in tasks; points of a leaf whose children would be as wide
#: as itself (beyond SHRINK of its radius), so that descending would tell nothing.
LEAF, FAN, WIDE_LEAF, SHRINK = 16, 8, 512, 0.8
#: Queries whose visits are handed on at once.
SLICE = 64
#: Queries of equal vectors that get their answer in one task.
ALIKE = 65_536
FOUND = "query long, vec long, score long"


def matrix(rows, width: int | None = None) -> np.ndarray:
    width = width or max(map(len, rows), default=1)
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    square = (points**2).sum(1)[:, None] + (centres**2).sum(1)[None] - 2 * points @ centres.T
    return np.sqrt(np.maximum(square, 0))


def gaps(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Distances, not below the true ones."""
    return np.linalg.norm(points - centre, axis=1) * (1 + 1e-9)


def farthest_first(points: np.ndarray, most: int) -> np.ndarray:
    """Up to `most` of the points, each as far as can be from those before: the order in which a cover tree takes them."""
    chosen, gap = [0], gaps(points, points[0])
    while len(chosen) < min(most, len(points)) and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, gaps(points, points[chosen[-1]]))
    return points[chosen]


class Node:
    """A node of a cover tree: a point, the radius that covers what lies below it, and that."""

    __slots__ = ("centre", "norm", "radius", "own", "below")

    def __init__(self, points: np.ndarray, own: np.ndarray, centre: np.ndarray):
        self.centre, self.own, self.below = centre, own, []
        self.norm, self.radius = float(np.linalg.norm(centre)), float(gaps(points[own], centre).max())
        if len(own) > LEAF and self.radius > 0:
            centres = farthest_first(points[own], FAN)
            gap = np.stack([gaps(points[own], c) for c in centres])
            near = gap.argmin(0)
            wide = [gap[k][near == k].max() for k in range(len(centres)) if (near == k).any()]
            if len(own) > WIDE_LEAF or np.mean(wide) < SHRINK * self.radius:
                self.below = [Node(points, own[near == k], c) for k, c in enumerate(centres) if (near == k).any()]


def reach(q: Node, p: Node) -> float:
    """No product of a vector below q with one below p is larger."""
    top = float(q.centre @ p.centre) + q.norm * p.radius + p.norm * q.radius + q.radius * p.radius
    return top + 1e-9 * (1 + (q.norm + q.radius) * (p.norm + p.radius))


def exact(q: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in a type in which their products are exact."""
    most = q.shape[1] * float(np.abs(q).max(initial=0)) * float(np.abs(p).max(initial=0))
    if most < 2**53:
        return q, p
    if most < 2**62:
        return q.astype("int64"), p.astype("int64")
    whole = np.vectorize(int, otypes=[object])
    return whole(q), whole(p)


def searched(queries: pd.DataFrame, data: pd.DataFrame, k: int) -> pd.DataFrame:
    """(query, vec, score): the k best of data (cid, v) for each query (cid, v, bound) among those that reach its bound."""
    if not len(queries) or not len(data):
        return pd.DataFrame({"query": [], "vec": [], "score": []}).astype("int64")
    width = max(max(map(len, queries["v"])), max(map(len, data["v"])))
    q, p = matrix(queries["v"], width), matrix(data["v"], width)
    q_ids, p_ids, bound = queries["cid"].to_numpy(), data["cid"].to_numpy(), queries["bound"].to_numpy(dtype=float)
    q_exact, p_exact = exact(q, p)
    best: list[list[tuple]] = [[] for _ in q_ids]  # (score, -id) of each query's best so far, sorted
    kth = bound.copy()
    roots = Node(q, np.arange(len(q)), q[0]), Node(p, np.arange(len(p)), p[0])
    pairs = [(-reach(*roots), 0, *roots)]
    made = 1
    while pairs:
        top, _, a, b = heapq.heappop(pairs)
        if -top < kth[a.own].min():
            continue
        if not a.below and not b.below:
            scores = q_exact[a.own] @ p_exact[b.own].T
            if scores.dtype == object:
                scores = np.clip(scores, -int(LONG), int(LONG))
            for row, i in zip(scores, a.own.tolist()):
                good = np.flatnonzero(row >= kth[i])
                if len(good) > 4 * k and row.dtype != object:
                    least = np.partition(row[good], len(good) - k)[len(good) - k]
                    good = good[row[good] >= least]
                if len(good):
                    new = [(int(row[j]), -int(p_ids[b.own[j]])) for j in good.tolist()]
                    best[i] = heapq.nlargest(k, best[i] + new)
                    if len(best[i]) == k:
                        kth[i] = max(kth[i], np.nextafter(float(best[i][-1][0]), -np.inf))
            continue
        split_a = a.below and (not b.below or a.radius >= b.radius)
        for x, y in [(c, b) for c in a.below] if split_a else [(a, c) for c in b.below]:
            if (bounded := reach(x, y)) >= kth[x.own].min():
                heapq.heappush(pairs, (-bounded, made, x, y))
                made += 1
    rows = [(q_ids[i], -v, s) for i, found in enumerate(best) for s, v in found if s >= bound[i]]
    return pd.DataFrame(rows, columns=["query", "vec", "score"]).astype("int64")


def prepared(vectors: DataFrame) -> DataFrame:
    """(vec_id, v array<double>) of the vectors that take part."""
    component = F.col("embedding").cast("array<double>").alias("embedding")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), component).where(F.col("vec_id").isNotNull())
    finite = lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))
    rows = rows.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.forall("embedding", finite))
    # floor of a double gives a long, which holds what is within LONG; a negative zero becomes zero
    scaled = lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(LONG)), F.lit(-LONG))).cast("double")
    return rows.groupBy("vec_id").agg(F.min(F.transform("embedding", scaled)).alias("v"))


def classes_of(rows: DataFrame, k: int, every: int) -> DataFrame:
    """(cid, v, ids, asked) of each distinct vector: its least id, its k + 1 least ids, how many queries have it."""
    order = Window.partitionBy("v").orderBy("vec_id")
    few = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    few = few.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    asked = rows.where(F.col("vec_id") % every == 0).groupBy("v").agg(F.count("*").alias("asked"))
    made = few.join(asked, "v", "left")
    return made.select(F.get("ids", F.lit(0)).alias("cid"), "v", "ids", F.coalesce("asked", F.lit(0)).alias("asked"))


def chosen_centres(classes: DataFrame, n: int) -> tuple[np.ndarray, int]:
    """Centres of the cells, more of them where there are more vectors, and the vectors' width."""
    most = max(CENTRES, min(MOST_CENTRES, n // BLOCK))
    share = min(1.0, max(SAMPLE, 4 * most) / max(n, 1))
    place = F.pmod(F.xxhash64(F.lit("centre"), "cid"), F.lit(1_000_000))
    sample = classes.where(place <= int(share * 1_000_000)).orderBy("cid").select("v").collect()
    sample = sample or classes.orderBy("cid").limit(1).select("v").collect()
    width = classes.agg(F.max(F.size("v"))).first()[0]
    return farthest_first(matrix([r["v"] for r in sample], width), most), width


def top_k(vectors: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for each row whose vec_id is divisible by `every`."""
    spark = vectors.sparkSession
    keep = Scratch(spark, "top-k")
    rows = keep(prepared(vectors), "vectors")
    classes = keep(classes_of(rows, k, every), "classes")
    n = classes.count()
    if not n:
        keep.drop()
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    centres, width = chosen_centres(classes, n)

    def assign(batches):
        for batch in batches:
            points = matrix(batch["v"], width)
            cell = distances(points, centres).argmin(1)
            yield batch.assign(cell=cell.astype("int32"), gap=np.linalg.norm(points - centres[cell], axis=1) * (1 + 1e-9))

    columns = "cid long, v array<double>, asked long, cell int, gap double"
    placed = keep(classes.select("cid", "v", "asked").mapInPandas(assign, columns), "cells")
    # one row for each of at most MOST_CENTRES cells
    cells = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("gap").alias("radius")).orderBy("cell").collect()
    blocks = {r["cell"]: -(-r["n"] // BLOCK) for r in cells}
    radius, middle = np.array([r["radius"] for r in cells]), centres[[r["cell"] for r in cells]]
    salts = F.element_at(F.create_map(*(F.lit(x) for item in blocks.items() for x in item)), F.col("cell"))
    data = placed.withColumn("salt", F.pmod(F.xxhash64("cid"), salts).cast("int"))
    queries = data.where("asked > 0").select("cid", "v", "cell", "salt")

    def visit(asking: DataFrame, asked: DataFrame, *keys: str) -> DataFrame:
        sides = asking.groupBy(*keys).cogroup(asked.groupBy(*keys))
        return sides.applyInPandas(lambda q, p: searched(q, p, k + 1), FOUND)

    no_bound = F.lit(float("-inf")).alias("bound")
    home = keep(visit(queries.select("*", no_bound), data.select("cid", "v", "cell", "salt"), "cell", "salt"), "home")
    least = F.col("least").cast("double")
    known = home.groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    known = known.select(F.col("query").alias("cid"), F.when(F.col("n") > k, least - F.abs(least) * 1e-15).alias("bound"))
    known = queries.join(known, "cid", "left").withColumn("bound", F.coalesce("bound", no_bound))

    def onward(batches):
        """A row for each other block that may hold something better."""
        for whole in batches:
            for at in range(0, len(whole), SLICE):
                batch = whole.iloc[at : at + SLICE]
                q, bound = matrix(batch["v"], width), batch["bound"].to_numpy(dtype=float)
                size = np.linalg.norm(q, axis=1)[:, None]
                top = q @ middle.T + size * radius[None]
                top += 1e-9 * (1 + size * (np.linalg.norm(middle, axis=1) + radius)[None])
                row, column = np.nonzero(top >= bound[:, None])
                made = batch.iloc[row][["cid", "v", "bound"]].assign(cell=[cells[c]["cell"] for c in column])
                home_of = batch[["cell", "salt"]].to_numpy()[row]
                made["salt"] = [list(range(blocks[c])) for c in made["cell"]]
                made = made.assign(home_cell=home_of[:, 0], home_salt=home_of[:, 1]).explode("salt")
                there = (made["cell"] != made["home_cell"]) | (made["salt"] != made["home_salt"])
                yield made[there][["cid", "v", "bound", "cell", "salt"]]

    asks = keep(known.mapInPandas(onward, "cid long, v array<double>, bound double, cell int, salt int"), "asks")
    groups = asks.groupBy("cell", "salt").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("groups"))
    asking = asks.join(groups, ["cell", "salt"]).withColumn("group", F.pmod(F.xxhash64("cid"), F.col("groups")).cast("int"))
    sent = data.select("cid", "v", "cell", "salt").join(groups, ["cell", "salt"])
    sent = sent.withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
    further = visit(asking.drop("groups"), sent.drop("groups"), "cell", "salt", "group")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec")
    best = home.unionByName(further).withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    entries = best.join(classes.select(F.col("cid").alias("vec"), "ids"), "vec")
    entries = entries.select("query", F.transform("ids", lambda i: F.struct((-F.col("score")).alias("lack"), i.alias("id"))).alias("e"))
    answers = entries.groupBy("query").agg(F.slice(F.array_sort(F.flatten(F.collect_list("e"))), 1, k + 1).alias("best"))
    # queries of equal vectors share an answer: dealt by class and, where they are many, by salt
    parts = F.ceil(F.col("asked") / ALIKE).cast("int")
    asked = classes.where("asked > 0").select(F.col("cid").alias("query"), "v", parts.alias("parts"))
    named = rows.where(F.col("vec_id") % every == 0).join(asked, "v")
    named = named.select(F.col("vec_id").alias("query_id"), "query", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int").alias("part"))
    dealt = answers.join(asked.drop("v"), "query").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    own = named.join(dealt, ["query", "part"])
    others = F.slice(F.filter("best", lambda x: x["id"] != F.col("query_id")), 1, k)
    ranked = own.select("query_id", F.posexplode(others).alias("rank", "x"))
    ranked = ranked.select("query_id", (F.col("rank") + 1).alias("rank"), F.col("x.id").alias("vec_id"), (-F.col("x.lack")).alias("score"))
    found = written(ranked, "top-k-found")
    keep.drop()
    return found

"""Joins: charts to pixels, times to times, overlaps to one owner, names to names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floeframe.functions.codes import MASK, UNKNOWN, tenths
from floeframe.sources import tables


def chart_tenths(pixels: DataFrame, codes: DataFrame) -> DataFrame:
    """Pixels with `ct`, the tenths of their polygon's code; null without polygon or code.

    Of a polygon's codes the last that means something counts. Codes are a few rows a scene; whether they are
    broadcast is left to their size at run time.
    """
    each = codes.select("scene_id", "poly_id", "line", tenths(F.col("CT")).alias("ct")).where("ct IS NOT NULL")
    one = each.groupBy("scene_id", "poly_id").agg(F.max_by("ct", "line").alias("ct"))
    return pixels.join(one, ["scene_id", "poly_id"], "left")


def within(left: DataFrame, right: DataFrame, on: str, left_ts: str, right_ts: str, seconds: int) -> DataFrame:
    """Pairs on the same key whose times are at most `seconds` apart.

    Times are cut into buckets of that length and each left row meets its own and the two next buckets only, so a
    key with many rows is spread over its buckets.
    """
    bucket = lambda ts: F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / (seconds * 1_000_000))
    near = left.withColumn("__bucket", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: bucket(left_ts) + d)))
    there = right.withColumn("__bucket", bucket(right_ts))
    gap = F.abs(F.unix_micros(F.col(left_ts).cast("timestamp")) - F.unix_micros(F.col(right_ts).cast("timestamp")))
    return near.join(there, [on, "__bucket"]).drop("__bucket").where(gap <= seconds * 1_000_000).withColumn("gap_s", gap / 1_000_000.0)


def nearest(left: DataFrame, right: DataFrame, on: str, left_id: str, left_ts: str, right_ts: str, seconds: int, take: list[str]) -> DataFrame:
    """The nearest right row in time for each left row that has one: its columns `take`; ties to the least of them."""
    pairs = within(left, right, on, left_ts, right_ts, seconds)
    best = pairs.groupBy(left_id).agg(F.min(F.struct("gap_s", *take)).alias("best"))
    return best.select(left_id, "best.*")


def most_interior(patches: DataFrame, cell: list[str], value: str, row: str = "patch_i", col: str = "patch_j", side: int = 32) -> DataFrame:
    """Of patches that cover the same cell, the value of the one farthest from its chip's edge; ties by chip."""
    depth = F.least(F.col(row), F.col(col), side - 1 - F.col(row), side - 1 - F.col(col))
    return patches.groupBy(*cell).agg(F.max_by(value, F.struct(depth, F.col("chip_id"))).alias(value))


def by_name(left: DataFrame, right: DataFrame, part: Column, name: str) -> DataFrame:
    """Right rows with the key that `part` takes from their name, joined to the left rows of that key: an equi-join
    in place of a search of every name for every key."""
    return left.join(right.withColumn(name, part), name)


def first_by_name(left: DataFrame, right: DataFrame, part: Column, name: str, order: str) -> DataFrame:
    """`by_name` with the least right row by `order` of each key: one row for each left row."""
    keyed = right.withColumn("__key", part)
    rest = [c for c in right.columns if c not in (order, name)]
    one = keyed.groupBy(F.col("__key").alias(name)).agg(F.min(F.struct(order, *rest)).alias("__first"))
    return left.join(one.select(name, "__first.*"), name, "left")


def containing(ids: DataFrame, names: DataFrame, id: str, name: str) -> DataFrame:
    """(id, first, n): for each different id the least name that holds it somewhere, and how many different names do.

    Names are cut into their stretches of the lengths that ids have, and those meet ids by equality, so no name is
    searched for every id, and neither side has to fit anywhere: a name of L letters makes at most L stretches for each
    length. Stretches with a letter that no id has are left out. Names are sorted and numbered, and written down so: a
    stretch's count and its least number are of fixed width, so Spark adds them up by hash as names are cut, without
    sorting stretches, and what is shuffled is at most each different stretch once a task. The least numbers become names
    again by a join. Ids that no name holds have a null `first` and 0; null and empty ids are left out, null names hold
    nothing.
    """
    wanted = ids.select(F.col(id).alias("__id")).where(F.length("__id") > 0).distinct()
    # one short list: there are at most as many lengths as the longest id has letters
    lengths = wanted.agg(F.collect_set(F.length("__id"))).scalar()
    # as short a list: the letters of ids
    letters = "".join(r[0] for r in wanted.select(F.explode(F.split("__id", "")).alias("c")).where("c <> ''").distinct().collect())
    others = "[^" + "".join(rf"\x{{{ord(c):X}}}" for c in sorted(letters)) + "]+" if letters else "(?s).+"
    distinct = names.select(F.col(name).alias("__name")).where(F.col("__name").isNotNull()).distinct()
    path = tables.scratch_path(names.sparkSession, "names")
    distinct.orderBy("__name").select("__name", F.monotonically_increasing_id().alias("__at")).write.parquet(path)
    held = names.sparkSession.read.parquet(path)
    cut = lambda run, size: F.transform(F.sequence(F.lit(1), F.length(run) - size + 1), lambda at: F.substr(run, at, size))
    fit = lambda run: F.filter(F.col("__lengths"), lambda size: size <= F.length(run))
    stretches = F.flatten(F.transform(F.split("__name", others), lambda run: F.flatten(F.transform(fit(run), lambda size: cut(run, size)))))
    each = held.withColumn("__lengths", lengths).select("__at", F.explode(F.array_distinct(stretches)).alias("__id"))
    found = each.groupBy("__id").agg(F.min("__at").alias("__at"), F.count("*").alias("n"))
    made = wanted.join(found, "__id", "left").join(held.withColumnRenamed("__name", "first"), "__at", "left")
    return made.select(F.col("__id").alias(id), "first", F.coalesce("n", F.lit(0)).alias("n"))


def pixel_charts(pixels: DataFrame, classes: DataFrame, on: list[str] = ("poly_id",)) -> DataFrame:
    """Pixels with sic, sod and floe of their polygon; classes: one row a polygon (on..., sic, sod, floe).

    Without a row for its polygon a pixel keeps the polygon's number in all three charts, 0 as water and the unknown
    code as mask; without a polygon they are null. Classes are a few rows a scene; a broadcast is left to their size.
    """
    made = pixels.join(classes.withColumn("__coded", F.lit(True)), list(on), "left")
    bare = F.when(F.col("poly_id") == UNKNOWN, MASK).otherwise(F.col("poly_id"))
    named = {c: F.when(F.col("__coded"), F.col(c)).otherwise(bare).cast("int") for c in ("sic", "sod", "floe")}
    return made.withColumns(named).drop("__coded")


def with_chip_token(patches: DataFrame, chips: DataFrame, features: list[str]) -> DataFrame:
    """One vector a patch: its own token, its features, its chip's token."""
    scalars = F.array(*(F.col(f"`{f}`").cast("float") for f in features))
    joined = patches.join(chips.select("chip_id", "class_token"), "chip_id")
    return joined.withColumn("vector", F.concat("patch_token", scalars, "class_token"))


def not_done(todo: DataFrame, done: DataFrame, key: str = "scene_id") -> DataFrame:
    """Rows of todo whose key isn't in done: what makes a build resumable."""
    return todo.join(done.select(key).distinct(), key, "left_anti")

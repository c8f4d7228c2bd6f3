"""Samples that come out the same each time: by the MD5 of key and seed, which any SQL engine can repeat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def mark(seed: int, *keys: str) -> Column:
    """MD5 of the keys and the seed, joined by colons, in hexadecimal."""
    return F.md5(F.concat_ws(":", *(F.col(k).cast("string") for k in keys), F.lit(str(seed))).cast("binary"))


def rows(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    return df.orderBy(mark(seed, key), key).limit(n)


def rows_by(df: DataFrame, by: str, key: str, n: int, seed: int = 0) -> DataFrame:
    """n rows of each group; what can't be among them goes before the shuffle."""
    order = Window.partitionBy(by).orderBy(mark(seed, key), key)
    return df.withColumn("__rank", F.row_number().over(order)).where(F.col("__rank") <= n).drop("__rank")


def crops(scenes: DataFrame, size: int, per_scene: int, seed: int = 0) -> DataFrame:
    """Places (row0, col0) of random crops within scenes (scene_id, height, width): eight digits of a mark for each."""
    each = scenes.withColumn("crop", F.explode(F.sequence(F.lit(0), F.lit(per_scene - 1))))

    def at(side: str, first: int) -> Column:
        number = F.conv(F.substring(mark(seed, "scene_id", "crop"), first, 8), 16, 10).cast("long")
        return number % (F.col(side) - size + 1).cast("long")

    large = each.where((F.col("height") >= size) & (F.col("width") >= size))
    return large.withColumns({"row0": at("height", 1), "col0": at("width", 9)})


#: Of draws of a crop, the first after which each round looks: 1, 2, 4, ... at once.
ROUNDS = [(2**k - 1, 2 ** (k + 1) - 1) for k in range(6)]


def draws(scenes: DataFrame, size: int, per_scene: int, seed: int, first: int, last: int) -> DataFrame:
    """(scene_id, crop, attempt, row0, col0): of every crop the draws from first to last, exclusive."""
    large = scenes.where((F.col("height") >= size) & (F.col("width") >= size))
    each = large.withColumn("crop", F.explode(F.sequence(F.lit(0), F.lit(per_scene - 1))))
    each = each.withColumn("attempt", F.explode(F.sequence(F.lit(first), F.lit(last - 1))))

    def at(side: str, digit: int) -> Column:
        number = F.conv(F.substring(mark(seed, "scene_id", "crop", "attempt"), digit, 8), 16, 10).cast("long")
        return number % (F.col(side) - size + 1).cast("long")

    return each.select("scene_id", "crop", "attempt", at("height", 1).alias("row0"), at("width", 9).alias("col0"))


def within(pixels: DataFrame, crops: DataFrame, size: int) -> DataFrame:
    """pixels (scene_id, row, col, ...), once for each of crops (scene_id, row0, col0, ...) that they lie in.

    They meet by square of `size` pixels: a crop lies in four at most, a pixel in one.
    """
    squares = lambda at: F.array_distinct(F.array(*(F.floor(F.col(at) / size), F.floor((F.col(at) + size - 1) / size))))
    spread = crops.withColumn("__i", F.explode(squares("row0"))).withColumn("__j", F.explode(squares("col0")))
    placed = pixels.withColumns({"__i": F.floor(F.col("row") / size), "__j": F.floor(F.col("col") / size)})
    inside = lambda at, start: (F.col(at) >= F.col(start)) & (F.col(at) < F.col(start) + size)
    return placed.join(spread, ["scene_id", "__i", "__j"]).where(inside("row", "row0") & inside("col", "col0")).drop("__i", "__j")


def accepted_crops(scenes: DataFrame, charted: DataFrame, size: int, per_scene: int, seed: int = 0, least: int = 2) -> DataFrame:
    """(scene_id, crop, attempt, row0, col0): of each crop the first draw with `least` charted pixels.

    scenes (scene_id, height, width); charted (scene_id, row, col). A crop's draws are a sequence that anyone can
    repeat. They are looked at in rounds, twice as many in each, and only for crops that have none yet: most are
    accepted at once. A crop that has none in 63 draws is left out, as are scenes smaller than a crop.
    """
    found: DataFrame | None = None
    for first, last in ROUNDS:
        drawn = draws(scenes, size, per_scene, seed, first, last)
        if found is not None:
            drawn = drawn.join(found.select("scene_id", "crop"), ["scene_id", "crop"], "left_anti")
        counted = within(charted.select("scene_id", "row", "col"), drawn, size).groupBy("scene_id", "crop", "attempt", "row0", "col0").count()
        best = counted.where(F.col("count") >= least).groupBy("scene_id", "crop").agg(F.min(F.struct("attempt", "row0", "col0")).alias("d"))
        best = best.select("scene_id", "crop", "d.*")
        # kept for the next round; lost parts are worked out again
        found = (best if found is None else found.unionByName(best)).persist()
        if found.count() == scenes.where((F.col("height") >= size) & (F.col("width") >= size)).count() * per_scene:
            break
    return found


def crop_pixels(pixels: DataFrame, crops: DataFrame, size: int) -> DataFrame:
    """The pixels of crops (scene_id, crop, row0, col0): their place in the crop as i, j, and their other columns."""
    held = within(pixels, crops.select("scene_id", "crop", "row0", "col0"), size)
    return held.withColumns({"i": F.col("row") - F.col("row0"), "j": F.col("col") - F.col("col0")}).drop("row", "col", "row0", "col0")


def usable(crop_pixels: DataFrame, key: list[str], chart: str = "sic", mask: int = 255) -> DataFrame:
    """Crops with more than one charted pixel."""
    return crop_pixels.groupBy(*key).agg(F.count_if(F.col(chart) != mask).alias("charted")).where("charted > 1")

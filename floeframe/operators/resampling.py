"""Coarse grids on the fine raster: corner-aligned bilinear or nearest, with gaps kept to themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floeframe.functions.masks import present
from floeframe.functions.tiling import nearest_source

LEAST_WEIGHT = 1e-6


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """rows dealt by keys over all shuffle partitions. Rows made within a task are many times what it read, so tasks
    must not be merged by the bytes that they read."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def tap(at: Column, small: Column, large: Column) -> Column:
    """The coarse index below a fine one, and the share of the one after it; ends fall on ends."""
    place = F.when(large > 1, at * (small - 1) / (large - 1)).otherwise(F.lit(0.0))
    low = F.least(F.floor(place), F.greatest(small - 2, F.lit(0))).cast("long")
    return F.struct(low.alias("i"), (place - low).alias("share"))


def shaped(targets: DataFrame, coarse: DataFrame, on: list[str]) -> DataFrame:
    """targets with h and w of their coarse grid. Targets go past a hash table of the shapes, they aren't held: Spark
    takes rows that were exploded for few, and would broadcast them."""
    shape = coarse.groupBy(*on).agg(F.max("h").alias("h"), F.max("w").alias("w"))
    return targets.join(shape.hint("shuffle_hash"), list(on))


def windows(coarse: DataFrame, on: list[str]) -> DataFrame:
    """(on, cr, cc, s0, n0 ... s3, n3): of each two by two cells from (cr, cc) on, sum and number of present values."""
    cells = coarse.select(*on, F.col("row").cast("long").alias("r"), F.col("col").cast("long").alias("c"), F.col("value").cast("double").alias("v")).where(present(F.col("v")))
    corners = F.array(*(F.struct((F.col("r") - i).alias("cr"), (F.col("c") - j).alias("cc"), F.lit(2 * i + j).alias("k")) for i in (0, 1) for j in (0, 1)))
    each = cells.select(*on, "v", F.explode(corners).alias("at")).select(*on, "at.*", "v")
    here = [F.when(F.col("k") == k, F.col("v")) for k in range(4)]
    sums = [x for k in range(4) for x in (F.sum(here[k]).alias(f"s{k}"), F.count(here[k]).alias(f"n{k}"))]
    return spread(each, *on, "cr", "cc").groupBy(*on, "cr", "cc").agg(*sums)


def bilinear(targets: DataFrame, coarse: DataFrame, height: int, width: int, on: list[str] = ("scene_id",)) -> DataFrame:
    """(on, row, col, value) at targets (on, row, col) from coarse (on, row, col, h, w, value): what is present of
    the at most four cells around, by weight; NaN where less than LEAST_WEIGHT of them is.

    The cells around meet first, so that a target is one row all along; a target that comes again is left out."""
    t = shaped(targets, coarse, on).withColumns({"y": tap(F.col("row"), F.col("h"), F.lit(height)), "x": tap(F.col("col"), F.col("w"), F.lit(width))})
    t = t.select(*on, "row", "col", F.col("y.i").alias("cr"), F.col("x.i").alias("cc"), F.col("y.share").alias("y"), F.col("x.share").alias("x"))
    met = spread(t, *on, "cr", "cc").distinct().join(windows(coarse, on), [*on, "cr", "cc"], "left")
    total = weight = F.lit(0.0)
    for k in range(4):
        down, right = (F.col("y") if k // 2 else 1 - F.col("y")), (F.col("x") if k % 2 else 1 - F.col("x"))
        ok = (down > 0) & (right > 0) & (F.col(f"n{k}") > 0)
        total += F.when(ok, F.col(f"s{k}") * (down * right)).otherwise(0.0)
        weight += F.when(ok, F.col(f"n{k}") * (down * right)).otherwise(0.0)
    return met.select(*on, "row", "col", F.when(weight > LEAST_WEIGHT, total / weight).otherwise(F.lit(float("nan"))).alias("value"))


def nearest(targets: DataFrame, coarse: DataFrame, height: int, width: int, on: list[str] = ("scene_id",)) -> DataFrame:
    """(on, row, col, value): each target takes the cell it lies in."""
    t = shaped(targets, coarse, on).withColumn("cr", nearest_source(F.col("row"), F.col("h"), F.lit(height))).withColumn("cc", nearest_source(F.col("col"), F.col("w"), F.lit(width)))
    cells = coarse.select(*on, F.col("row").cast("long").alias("cr"), F.col("col").cast("long").alias("cc"), "value")
    return spread(t, *on, "cr", "cc").join(cells, [*on, "cr", "cc"], "left").select(*on, "row", "col", "value")


def corner_nearest(targets: DataFrame, coarse: DataFrame, height: int, width: int, on: list[str] = ("scene_id",)) -> DataFrame:
    """(on, row, col, value): each target takes the nearest cell where ends fall on ends; halves go to the later cell."""

    def cell(at: str, small: str, large: int) -> Column:
        place = F.col(at) * (F.col(small) - 1) / F.lit(max(large - 1, 1))
        return F.floor(place + 0.5).cast("long")

    t = shaped(targets, coarse, on).withColumns({"cr": cell("row", "h", height), "cc": cell("col", "w", width)})
    cells = coarse.select(*on, F.col("row").cast("long").alias("cr"), F.col("col").cast("long").alias("cc"), "value")
    return spread(t, *on, "cr", "cc").join(cells, [*on, "cr", "cc"], "left").select(*on, "row", "col", "value")

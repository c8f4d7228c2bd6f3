"""Checks of the written tables: violations as rows, one aggregation a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floeframe.functions.masks import present
from floeframe.schema import CHIP_TABLE, FRACTIONS, PATCH_TABLE, PATCHES, TOKEN


def column_faults(found: list[str], contract: list[str]) -> dict[str, list[str]]:
    """Missing and extra columns, and those out of order."""
    common = [c for c in contract if c in found]
    order = [c for c in found if c in contract]
    return {"missing": [c for c in contract if c not in found], "extra": [c for c in found if c not in contract], "moved": [a for a, b in zip(common, order) if a != b]}


def chip_sizes(patches: DataFrame, expected: int = PATCHES) -> DataFrame:
    """(scene_id, above, below): chips with more or fewer patches than expected."""
    sizes = patches.groupBy("scene_id", "chip_id").count()
    return sizes.groupBy("scene_id").agg(F.count_if(F.col("count") > expected).alias("above"), F.count_if(F.col("count") < expected).alias("below"))


def duplicates(chips: DataFrame, key: str = "chip_id") -> DataFrame:
    return chips.groupBy(key).agg(F.count("*").alias("copies")).where("copies > 1")


def out_of_bounds(x, low: float = 0.0, high: float = 1.0):
    """NaN passes: it is no number to compare."""
    return ~F.isnan(x) & ((x < low) | (x > high))


def fractions_off(tolerance: float = 1e-3, relative: float = 1e-5):
    """Labelled rows whose class shares don't add up to one."""
    total = sum((F.col(f).cast("double") for f in FRACTIONS), F.lit(0.0))
    return present(F.col("label")) & (F.abs(total - 1.0) > tolerance + relative)


def violations(patches: DataFrame, chips: DataFrame) -> DataFrame:
    """(scene_id, check, rows) of every check that a scene fails; the tables' columns are checked apart."""
    p = patches.groupBy("scene_id").agg(
        F.count_if(out_of_bounds(F.col("valid_fraction"))).alias("valid_fraction"), F.count_if(out_of_bounds(F.col("valid_class_fraction"))).alias("valid_class_fraction"),
        F.count_if(F.size("patch_token") != TOKEN).alias("patch_token"), F.count_if(fractions_off()).alias("fractions"),
    )
    c = chips.groupBy("scene_id").agg(F.count_if(F.size("class_token") != TOKEN).alias("class_token"), (F.count("*") - F.count_distinct("chip_id")).alias("repeated_chip"))
    s = chip_sizes(patches)
    long = [t.unpivot("scene_id", [x for x in t.columns if x != "scene_id"], "check", "rows") for t in (p, c, s)]
    return long[0].unionByName(long[1]).unionByName(long[2]).where("rows > 0")


def one_sided(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, side) of the keys that only one of two tables has."""
    a, b = left.select(key).distinct().withColumn("l", F.lit(True)), right.select(key).distinct().withColumn("r", F.lit(True))
    both = a.join(b, key, "full")
    return both.where(F.col("l").isNull() | F.col("r").isNull()).select(key, F.when(F.col("r").isNull(), "left").otherwise("right").alias("side"))


def passes(patches: DataFrame, chips: DataFrame) -> bool:
    """All of it: columns in order, no violation, same scenes and chips in both tables."""
    ordered = patches.columns[: len(PATCH_TABLE)] == PATCH_TABLE and chips.columns[: len(CHIP_TABLE)] == CHIP_TABLE
    gone = one_sided(patches, chips, "chip_id").unionByName(one_sided(patches, chips, "scene_id").withColumnRenamed("scene_id", "chip_id"))
    return ordered and violations(patches, chips).isEmpty() and gone.isEmpty()

"""Chips over a raster: starts, bounds, ids, and which chips a pixel lies in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floeframe.schema import CHIP, PATCH


def starts(size: Column, chip: int = CHIP) -> Column:
    """First pixels of the chips along a side; the last chip is moved back so that it ends with the raster."""
    fits = F.when(size >= chip, size).otherwise(F.raise_error(F.lit(f"a side is shorter than a chip of {chip}")))
    return F.transform(F.sequence(F.lit(0), fits - 1, F.lit(chip)), lambda s: F.least(s, size - chip))


def chips(scenes: DataFrame, chip: int = CHIP) -> DataFrame:
    """A row for each chip of scenes (height, width, ...), row by row: row0, row1, col0, col1."""
    rows = scenes.withColumn("row0", F.explode(starts(F.col("height"), chip)))
    both = rows.withColumn("col0", F.explode(starts(F.col("width"), chip)))
    return both.withColumns({"row1": F.col("row0") + chip, "col1": F.col("col0") + chip})


def chip_id(scene: Column, row0: Column, col0: Column) -> Column:
    return F.format_string("%s_r%05d_c%05d", scene, row0.cast("int"), col0.cast("int"))


def covering(at: Column, size: Column, chip: int = CHIP) -> tuple[Column, Column]:
    """Starts of the chips along a side that cover place `at`: the regular one, and the last one where it is another.

    Computed from the place, not joined, and in plain arithmetic, which compiles with the rest of a stage.
    """
    last, inside = size - chip, (at >= 0) & (at < size)
    regular = F.least(at - at % chip, last)
    return F.when(inside, regular), F.when(inside & (at >= last) & (regular != last), last)


def starts_over(at: Column, size: Column, chip: int = CHIP) -> Column:
    """The one or two of `covering` as an array; none outside of the side."""
    regular, last = covering(at, size, chip)
    one = F.when(regular.isNotNull(), F.array(regular)).otherwise(F.array().cast("array<bigint>"))
    return F.when(last.isNotNull(), F.array(regular, last)).otherwise(one)


def with_chips(pixels: DataFrame, height: Column, width: Column, chip: int = CHIP, patch: int = PATCH) -> DataFrame:
    """Pixels (row, col, ...), once for each chip they lie in: row0, col0, patch_i, patch_j. A narrow step."""
    rows = pixels.withColumn("row0", F.explode(starts_over(F.col("row"), height, chip)))
    both = rows.withColumn("col0", F.explode(starts_over(F.col("col"), width, chip)))
    place = lambda at, start: F.floor((F.col(at) - F.col(start)) / patch)
    return both.withColumns({"patch_i": place("row", "row0"), "patch_j": place("col", "col0")})


def owner(row: Column, col: Column, height: Column, width: Column, chip: int = CHIP, patch: int = PATCH) -> Column:
    """(row0, col0) of the chip in which a pixel's patch lies farthest from the edge; the later chip of equal ones.

    The chips over a pixel are computed from its place, so no other row is needed: no shuffle.
    """
    side = chip // patch

    def depth(at: Column, start: Column) -> Column:
        k = F.floor((at - start) / patch)
        return F.least(k, side - 1 - k)

    def one(r: Column, c: Column) -> Column:
        fits = r.isNotNull() & c.isNotNull()
        return F.when(fits, F.struct(F.least(depth(row, r), depth(col, c)).alias("depth"), r.alias("row0"), c.alias("col0")))

    rows, cols = covering(row, height, chip), covering(col, width, chip)
    best = F.greatest(*(one(r, c) for r in rows for c in cols))
    return F.struct(best["row0"].alias("row0"), best["col0"].alias("col0"))


def decimated(pixels: DataFrame, row_step: int, col_step: int, rows: int, cols: int) -> DataFrame:
    """Every row_step-th row and col_step-th column, the first rows x cols of them."""
    r, c = F.col("row"), F.col("col")
    return pixels.where((r % row_step == 0) & (c % col_step == 0) & (r < row_step * rows) & (c < col_step * cols))


def nearest_source(at: Column, small: Column, large: Column) -> Column:
    """Coarse index under fine index `at` when `small` cells are stretched over `large`."""
    return F.floor(at * small / large)


def coarse_grid(chip: int, spacing: int) -> dict[str, float | int]:
    """How a crop of `chip` pixels lies in the grids of microwave and weather, whose cells are 50 pixels of 40 m:
    pixels of `spacing` metres a cell, cells a crop, the whole part of what they are beyond whole cells (always 0), and
    the side that the cells around a crop are stretched to."""
    delta = 50 / (spacing // 40)
    cells = chip / delta
    beyond = int(cells - int(cells))
    return {"delta": delta, "cells": cells, "beyond": beyond, "side": int(chip + beyond * delta)}


def split_variables(variables: list[str], charts: list[str]) -> dict[str, list[str]]:
    """Variables on the radar's grid, those cropped as they are (charts first), and those on coarse grids."""
    radar = [v for v in variables if "sar" in v or "map" in v]
    return {"radar": radar, "full": [*charts, *radar], "coarse": [v for v in variables if v not in radar]}

"""Lists of scene files, and how coarse grids are stretched over a raster."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def listed(spark: SparkSession, root: str, split: str, pattern: str = "*.{nc,npz}") -> DataFrame:
    """(path, scene_id, split) of the files below root. Only names are read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(root)
    name = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "")
    return files.select("path", name.alias("scene_id"), F.lit(split).alias("split"))


def both_splits(spark: SparkSession, train: str, test: str, pattern: str = "*.{nc,npz}") -> DataFrame:
    return listed(spark, train, "train", pattern).unionByName(listed(spark, test, "test", pattern))


def first(scenes: DataFrame, n: int) -> DataFrame:
    """The first n by path; all if n isn't positive."""
    return scenes.orderBy("path").limit(n) if n > 0 else scenes


def chip_places(size: int, chip: int) -> list[int]:
    if size < chip:
        raise ValueError(f"a side of {size} is shorter than a chip of {chip}")
    return [min(s, size - chip) for s in range(0, size, chip)]


#: Less weight than this of present cells makes a stretched value NaN.
LEAST_WEIGHT = 1e-6


def weights(axis: np.ndarray, at: np.ndarray) -> tuple[slice, np.ndarray]:
    """The part of the axis that places `at` lie in, and the weights (place by axis value) that interpolate there.

    Outside of the axis its first or last cell goes on.
    """
    if len(axis) == 1:
        return slice(0, 1), np.ones((len(at), 1))
    low = np.clip(np.searchsorted(axis, at, side="right") - 1, 0, len(axis) - 2)
    share = (at - axis[low]) / (axis[low + 1] - axis[low])
    first, last = low.min(), low.max() + 2
    made, each = np.zeros((len(at), last - first)), np.arange(len(at))
    made[each, low - first], made[each, low - first + 1] = 1 - share, share
    return slice(first, last), made


def interpolated(values: np.ndarray, rows: tuple[slice, np.ndarray], cols: tuple[slice, np.ndarray]) -> np.ndarray:
    """Values at every place of rows and cols: what is present of the cells around, by weight, else NaN."""
    near = np.asarray(values, dtype=np.float64)[rows[0], cols[0]]
    held = ~np.isnan(near)
    whole = rows[1] @ np.where(held, near, 0.0) @ cols[1].T
    if held.all():
        return whole
    weight = rows[1] @ held.astype(np.float64) @ cols[1].T
    return np.divide(whole, weight, out=np.full_like(whole, np.nan), where=weight > LEAST_WEIGHT)


#: A scene's chart as polygon numbers, their coded rows (the header first), and the angle that the control grid gives.
CHART, CODES, ANGLE = "polygon_icechart", "polygon_codes", "sar_grid_incidenceangle"

#: What a decoded scene holds of its control grid.
GRID = {"lines": "gcp_lines", "samples": "gcp_samples", "lat": "gcp_lat", "lon": "gcp_lon", "angle": "gcp_angle"}

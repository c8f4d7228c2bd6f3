"""Prediction over whole scenes, tile by tile.

A scene is cut into tiles that don't overlap. A tile's task gets its pixels and a halo around them, so a model that looks
no farther than the halo sees what it would see of the whole scene; of its predictions only those of the tile's own
pixels are kept, which are the ones farthest from the window's edge, and they make up the scene again. What is masked
gets no prediction. A pixel goes to the tiles whose windows it lies in by its place, without a join; no task holds more
than a window.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _tiles_over(at: Column, tile: int, halo: int, side: Column) -> Column:
    """Numbers of the tiles along a side whose windows hold the place."""
    last = F.floor((side - 1) / tile)
    first = F.greatest(F.lit(0), F.floor((at - halo) / tile))
    return F.when((at >= 0) & (at < side), F.sequence(first, F.least(last, F.floor((at + halo) / tile))))


def with_windows(pixels: DataFrame, height: Column, width: Column, tile: int, halo: int) -> DataFrame:
    """Pixels (row, col, ...), once for each window they lie in: tile_row, tile_col. Outside of the scene they go."""
    rows = pixels.withColumn("tile_row", F.explode(_tiles_over(F.col("row"), tile, halo, height)))
    return rows.withColumn("tile_col", F.explode(_tiles_over(F.col("col"), tile, halo, width)))


def predicted(
    pixels: DataFrame, bands: list[str], model: Callable[[np.ndarray], np.ndarray], height: Column, width: Column, tile: int, halo: int, mask: str | None = None, nodata: float = 255.0
) -> DataFrame:
    """(scene_id, row, col, prediction) of every pixel (scene_id, row, col, bands..., mask boolean).

    model: (bands, rows, cols), NaN where there is no pixel -> (rows, cols). It is given windows, whose edges are either
    `halo` away from the tile or the last pixels there are. nodata where mask holds (a null doesn't). A place that has
    several pixels is an error.
    """
    masked = F.lit(False) if mask is None else F.coalesce(F.col(mask), F.lit(False))
    named = [f"b{k}" for k in range(len(bands))]
    held = pixels.select("scene_id", F.col("row").cast("long"), F.col("col").cast("long"), masked.alias("masked"), *(F.col(b).cast("double").alias(n) for b, n in zip(bands, named)), height.alias("h"), width.alias("w"))
    windows = with_windows(held, F.col("h"), F.col("w"), tile, halo).drop("h", "w")
    kind = windows.schema["scene_id"].dataType.simpleString()
    schema = StructType.fromDDL(f"scene_id {kind}, row bigint, col bigint, prediction double")

    def of_tile(key: tuple, window: pa.Table) -> pa.Table:
        first_row, first_col = (key[k].as_py() * tile - halo for k in (1, 2))
        side = tile + 2 * halo
        i, j = window["row"].to_numpy() - first_row, window["col"].to_numpy() - first_col
        place = i * side + j
        if len(np.unique(place)) < len(place):
            raise ValueError(f"several pixels at one place of scene {key[0].as_py()}")
        filled = np.full((len(named), side * side), np.nan)
        for k, name in enumerate(named):
            filled[k, place] = window[name].to_numpy()
        made = model(filled.reshape(-1, side, side)).reshape(-1)[place]
        made = np.where(window["masked"].to_numpy(), nodata, made)
        own = pa.array((i >= halo) & (i < halo + tile) & (j >= halo) & (j < halo + tile))
        return pa.table({"scene_id": window["scene_id"], "row": window["row"], "col": window["col"], "prediction": pa.array(made)}).filter(own)

    return windows.groupBy("scene_id", "tile_row", "tile_col").applyInArrow(of_tile, schema)


def box_mean(radius: int) -> Callable[[np.ndarray], np.ndarray]:
    """A model for trying things: the mean of the first band's pixels up to `radius` away; NaN without any."""

    def model(bands: np.ndarray) -> np.ndarray:
        held = ~np.isnan(bands[0])
        total, n = _boxes(np.where(held, bands[0], 0.0), radius), _boxes(held.astype(np.float64), radius)
        return np.divide(total, n, out=np.full_like(total, np.nan), where=n > 0.5)

    return model


def _boxes(values: np.ndarray, radius: int) -> np.ndarray:
    wide = np.pad(values, radius)
    made = np.zeros_like(values)
    for i in range(2 * radius + 1):
        for j in range(2 * radius + 1):
            made += wide[i : i + len(values), j : j + values.shape[1]]
    return made


def radar_masked(hh: Column, fill: float = 0.0) -> Column:
    """The mask of a scene without charts: where the radar has only its fill value, or none."""
    return F.coalesce((hh == fill) | F.isnan(hh), F.lit(True))

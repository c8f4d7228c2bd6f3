"""Distance to land: the exact Euclidean distance transform of rasters.

The square of a distance is the least, over the rows of a pixel's column, of the rows' distance squared and the square
of how far land is within that row. So a raster's rows are looked at one by one, first: narrow work. Then strips of
columns come together, one shuffle of one number a pixel, and in a strip the lower envelope of the rows' parabolas is
taken down all its columns at once. A strip is as high as its raster and STRIP wide, so no task holds a scene.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

STRIP = 256
#: Within a row without land.
NONE = -1


def along(land: np.ndarray) -> np.ndarray:
    """Of each place of a row how far the nearest land is; NONE without any."""
    places, n = np.arange(len(land)), len(land)
    if not land.any():
        return np.full(n, NONE, dtype=np.int64)
    left = np.maximum.accumulate(np.where(land, places, -n - 1))
    right = np.minimum.accumulate(np.where(land, places, 2 * n + 1)[::-1])[::-1]
    return np.minimum(places - left, right - places)


def down(near: np.ndarray) -> np.ndarray:
    """Squared distances of (rows, columns) from `along` of each row; NONE in a column without any land.

    An envelope for each column: `which` row's parabola holds from which row on (`since`), `top` of them so far.
    """
    rows, cols = near.shape
    each, square = np.arange(cols), near * near
    which, since = np.zeros((rows, cols), dtype=np.int64), np.zeros((rows, cols), dtype=np.int64)
    top = np.full(cols, -1)
    for u in range(rows):
        live = near[u] != NONE
        height = lambda x, i: (x - i) ** 2 + square[i, each]
        while True:
            last, start = which[top, each], since[top, each]
            below = live & (top >= 0) & (height(start, last) > (start - u) ** 2 + square[u])
            if not below.any():
                break
            top[below] -= 1
        first = live & (top < 0)
        last = which[top, each]
        meets = 1 + (u * u - last * last + square[u] - square[last, each]) // np.maximum(2 * (u - last), 1)
        more = live & ~first & (meets < rows)
        top[first | more] += 1
        which[top[first | more], each[first | more]] = u
        since[top[first], each[first]] = 0
        since[top[more], each[more]] = meets[more]
    made = np.full((rows, cols), NONE, dtype=np.int64)
    for u in range(rows - 1, -1, -1):
        live = top >= 0
        last = which[top, each]
        made[u, live] = ((u - last) ** 2 + square[last, each])[live]
        top[live & (since[top, each] == u)] -= 1
        top[live & (top < 0)] = 0
    return made


def raster_rows(land: DataFrame, scenes: DataFrame) -> DataFrame:
    """(scene_id, row, land array<boolean>) of scenes (scene_id, height, width) from land pixels (scene_id, row, col)."""
    every = scenes.select("scene_id", "width", F.explode(F.sequence(F.lit(0), F.col("height") - 1)).alias("row"))
    held = land.groupBy("scene_id", F.col("row").cast("int").alias("row")).agg(F.collect_set(F.col("col").cast("int")).alias("cols"))
    is_land = F.transform(F.sequence(F.lit(0), F.col("width") - 1), lambda c: F.coalesce(F.array_contains("cols", c), F.lit(False)))
    return every.join(held, ["scene_id", "row"], "left").select("scene_id", "row", is_land.alias("land"))


def to_land(rows: DataFrame, strip: int = STRIP) -> DataFrame:
    """(scene_id, row, col0, squared array<bigint>) of raster rows (scene_id, row, land array<boolean>): squared
    distances of the strip of columns from col0 on, null where a scene has no land. A null counts as no land; each row
    of a raster has to be there once."""
    narrow = StructType.fromDDL("scene_id string, row int, col0 int, near array<bigint>")
    arrow = to_arrow_schema(narrow)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for scene, row, land in zip(*(batch.column(k).to_pylist() for k in range(3))):
                near = along(np.array([bool(x) for x in land]))
                starts = [*range(0, len(near), strip)]
                columns = [[scene] * len(starts), [row] * len(starts), starts, [near[s : s + strip] for s in starts]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    wide = StructType.fromDDL("scene_id string, row int, col0 int, squared array<bigint>")
    out = to_arrow_schema(wide)

    def strip_of(group: pa.Table) -> pa.Table:
        held = group.sort_by("row")
        near = held["near"].combine_chunks()
        order = held["row"].to_numpy()
        if (order != np.arange(len(order))).any():
            raise ValueError(f"rows of {held['scene_id'][0]} are missing or there twice")
        made = down(near.flatten().to_numpy().reshape(len(order), -1))
        flat = pa.array(made.ravel(), mask=(made == NONE).ravel())
        lists = pa.ListArray.from_arrays(np.arange(0, made.size + 1, made.shape[1], dtype=np.int32), flat)
        return pa.table([held["scene_id"], held["row"], held["col0"], lists.cast(out.field("squared").type)], schema=out)

    rows = rows.select("scene_id", F.col("row").cast("int"), "land")
    return rows.mapInArrow(cut, narrow).groupBy("scene_id", "col0").applyInArrow(strip_of, wide)


def pixels(strips: DataFrame) -> DataFrame:
    """(scene_id, row, col, squared) of to_land's strips."""
    each = strips.select("scene_id", "row", "col0", F.posexplode("squared").alias("at", "squared"))
    return each.select("scene_id", "row", (F.col("col0") + F.col("at")).alias("col"), "squared")

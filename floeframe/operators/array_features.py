"""Per-patch statistics of rows that hold a patch's pixels as arrays, batch by batch.

The same as `patches.features` from pixels, without a shuffle: each Arrow batch's arrays lie end to end in memory, and
one count by row over them gives a sum for every patch. Arrays may have any length; a patch's own are PIXELS long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BooleanType, DoubleType, FloatType, StructField, StructType

from floeframe.functions.masks import LAND
from floeframe.schema import CLASSES, FRACTIONS, PATCH, PIXELS

RADAR = ["hh_mean", "hv_mean", "hh_std", "hv_std", "hv_hh_ratio", "valid_fraction"]
#: The pixel just below and right of a patch's middle.
MIDDLE = PATCH // 2 * PATCH + PATCH // 2


class Ragged:
    """A column of arrays: its values end to end, and the row of each."""

    def __init__(self, column: pa.Array):
        self.lengths = np.diff(column.offsets.to_numpy())
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]]).astype(np.int64)
        self.values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        self.rows = np.repeat(np.arange(len(column)), self.lengths)

    def sums(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, values, len(self.lengths))


def radar(hh: Ragged, hv: Ragged, valid: np.ndarray) -> dict[str, np.ndarray]:
    """Mean and population deviation of the valid pixels' polarisations, their mean difference, valid_fraction."""
    n = hh.sums(valid)
    with np.errstate(invalid="ignore", divide="ignore"):
        made = {"valid_fraction": n / PIXELS}
        for name, x in (("hh", hh.values), ("hv", hv.values)):
            mean = hh.sums(np.where(valid, x, 0.0)) / n
            apart = np.where(valid, x - mean[hh.rows], 0.0)
            made |= {f"{name}_mean": mean, f"{name}_std": np.sqrt(hh.sums(apart * apart) / n)}
        made["hv_hh_ratio"] = hh.sums(np.where(valid, hv.values - hh.values, 0.0)) / n
    return made


def labels(ct: Ragged) -> dict[str, pa.Array]:
    """Shares of each class as 32-bit floats, the floor of the expected class, and whether one class is all."""
    held = ~np.isnan(ct.values)
    klass = np.rint(ct.values[held]).astype(np.int64)
    inside = (klass >= 0) & (klass < CLASSES)
    size = len(ct.lengths)
    counts = np.bincount((ct.rows[held] * CLASSES + klass)[inside], minlength=size * CLASSES).reshape(size, CLASSES)
    n = ct.sums(held)
    with np.errstate(invalid="ignore", divide="ignore"):
        shares = (counts / n[:, None]).astype(np.float32)
    total = np.zeros(size)
    for k in range(CLASSES):
        total += k * shares[:, k].astype(np.float64)
    made = {name: pa.array(shares[:, k], mask=n == 0) for k, name in enumerate(FRACTIONS)}
    return made | {"valid_class_fraction": n / PIXELS, "label": np.floor(total), "is_pure": np.where(n > 0, shares.max(1) == 1, False)}


def with_features(
    patches: DataFrame, means: dict[str, str], hh: str = "hh", hv: str = "hv", distance: str = "distance", ct: str = "ct", filled: dict[str, float] | None = None,
    drop: tuple[str, ...] = (),
) -> DataFrame:
    """patches with RADAR, the label columns, distance_to_land and the plain mean of each band of means (column: new
    name; NaN where a pixel is missing). filled: columns whose invalid pixels then hold the given value. drop: columns
    left out of the result. A pixel is valid off land where neither polarisation is missing; nulls count as NaN.
    """
    kept = [f for f in patches.schema if f.name not in drop]
    doubles = [*RADAR, *means.values(), "distance_to_land", "valid_class_fraction", "label"]
    new = [StructField(c, DoubleType()) for c in doubles] + [StructField(c, FloatType()) for c in FRACTIONS] + [StructField("is_pure", BooleanType())]
    schema = StructType([*kept, *new])
    arrow = to_arrow_schema(schema)
    filled = filled or {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = lambda name: Ragged(batch.column(name))
            a, b, land = column(hh), column(hv), column(distance)
            valid = ~np.isnan(a.values) & ~np.isnan(b.values) & (land.values != LAND) & ~np.isnan(land.values)
            made = radar(a, b, valid) | labels(column(ct))
            at = np.minimum(land.starts + MIDDLE, max(len(land.values) - 1, 0))
            near = land.values[at] if len(land.values) else np.zeros(len(at))
            made["distance_to_land"] = pa.array(near, mask=land.lengths <= MIDDLE)
            for name, out in means.items():
                x = column(name)
                with np.errstate(invalid="ignore", divide="ignore"):
                    made[out] = x.sums(x.values) / x.lengths
            for name, value in filled.items():
                x = batch.column(name)
                values = pa.array(np.where(valid, column(name).values, value), x.type.value_type)
                made[name] = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(a.lengths)]).astype(np.int32), values)
            columns = [made[f.name] if f.name in made else batch.column(f.name) for f in arrow]
            yield pa.RecordBatch.from_arrays([x.cast(f.type) if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(columns, arrow)], schema=arrow)

    return patches.mapInArrow(run, schema)

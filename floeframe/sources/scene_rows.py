"""Scenes as rows of patches: a Spark data source that reads array files by byte ranges.

`planned` lists the files, reads their headers and cuts each raster into bands of whole chip rows; a task reads one
band's rows of the asked variables and nothing else of the file, composes it chip by chip, and hands on a chip's patches
as one Arrow batch. Neither a file nor a chip is ever one value of a row.

A patch's row has its place, its corners' latitude and longitude from the scene's control grid, the chip's corners and
middle, whether its chip has a valid pixel and a labelled one, and each band's PATCH * PATCH pixels. Bands coarser than
the raster are stretched over it; the incidence angle comes from the control grid where it is no raster; `ct` is decoded
from polygon numbers and the scene's coded rows where it has some.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from floeframe.functions.codes import tenths_of
from floeframe.functions.masks import LAND, POLYGON_NONE
from floeframe.schema import CHIP, PATCH, SAR
from floeframe.sources.arrays import Arrays
from floeframe.sources.scenes import ANGLE, CHART, CODES, GRID, chip_places, interpolated, weights

SUFFIXES = (".nc", ".npz")
#: Bytes of raster that a task reads, about.
SPLIT = 128 << 20
#: Headers read at once.
READERS = 16
#: A control grid as points (line, sample, lat, lon, angle), as scenes are delivered (fixed values).
POINTS = {"lines": "sar_grid_line", "samples": "sar_grid_sample", "lat": "sar_grid_latitude", "lon": "sar_grid_longitude", "angle": ANGLE}
PLACE = "scene_id string, split string, row0 int, col0 int, patch_i int, patch_j int, any_valid boolean, any_label boolean, corners array<double>, chip_corners array<double>, middle array<double>"


@dataclass(frozen=True)
class Split(InputPartition):
    """Chip rows of one scene: their first pixel rows."""

    path: str
    scene_id: str
    rows: tuple[int, ...]


def files_below(root: str) -> list[tuple[str, str]]:
    """(path, scene_id) of the array files below root, in the order of paths."""
    fs, place = pyarrow.fs.FileSystem.from_uri(root)
    scheme = root[: root.index(place)] if "://" in root and place in root else ""
    found = fs.get_file_info(pyarrow.fs.FileSelector(place, recursive=True))
    paths = sorted(x.path for x in found if x.is_file and x.path.endswith(SUFFIXES))
    return [(scheme + p, p.rsplit("/", 1)[-1].rsplit(".", 1)[0]) for p in paths]


def open_rows(file: tuple[str, str], raster: str, chip: int, done: set[tuple[str, int]]) -> tuple[int, list[int]]:
    """(bytes of a chip row, first pixel rows of the chip rows that aren't done)."""
    path, scene = file
    held = Arrays(path)
    height, width = held.shape(raster)
    if width < chip:
        raise ValueError(f"{path}: a side of {width} is shorter than a chip of {chip}")
    return chip * width * held.variables[raster].dtype.itemsize * 5, [r for r in chip_places(height, chip) if (scene, r) not in done]


def planned(root: str, chip: int = CHIP, raster: str = SAR[0], done: set[tuple[str, int]] = frozenset(), most: int | None = None, split: int = SPLIT) -> list[Split]:
    """Splits of the chip rows below root that aren't done, at most `most` chip rows of them."""
    made, left = [], most
    files = files_below(root)
    with ThreadPoolExecutor(READERS) as pool:
        for at in range(0, len(files), READERS):  # only as many headers as are needed
            if left == 0:
                break
            some = files[at : at + READERS]
            for (path, scene), (size, rows) in zip(some, pool.map(lambda f: open_rows(f, raster, chip, done), some)):
                rows = rows if left is None else rows[:left]
                left = left if left is None else left - len(rows)
                step = max(1, split // size)
                made += [Split(path, scene, tuple(rows[k : k + step])) for k in range(0, len(rows), step)]
    return made


class Band:
    """One chip row of a scene: the rows of its variables that it needs."""

    def __init__(self, held: Arrays, raster: str, row0: int, chip: int):
        self.held, self.row0, self.chip = held, row0, chip
        self.height, self.width = held.shape(raster)
        self.grid, self.tenths = control(held), charted(held) if CODES in held else None
        self.cut: dict[str, tuple] = {}

    def rows(self, name: str) -> tuple[np.ndarray, tuple, np.ndarray]:
        """Of a coarse variable the cells around the chip row, its weights down, and the axis across."""
        if name not in self.cut:
            shape = self.held.shape(name)
            ys = np.arange(self.row0, self.row0 + self.chip)
            if name == ANGLE and shape != (self.height, self.width):
                values, axis, across = self.grid["angle"], self.grid["lines"], self.grid["samples"]
                near, share = weights(axis, ys)
                self.cut[name] = values[near], (slice(0, near.stop - near.start), share), across
            elif shape == (self.height, self.width):
                self.cut[name] = self.held.rows(name, self.row0, self.row0 + self.chip), None, None
            else:
                down, across = (np.linspace(0.0, side - 1.0, n) if n > 1 else np.zeros(1) for side, n in zip((self.height, self.width), shape))
                near, share = weights(down, ys)
                first, last = near.start, min(near.stop, shape[0])
                self.cut[name] = self.held.rows(name, first, last), (slice(0, last - first), share), across
        return self.cut[name]

    def band(self, name: str, col0: int) -> np.ndarray:
        """A band's values of the chip at col0, 32-bit."""
        if name == "ct" and self.tenths is not None:
            values, _, _ = self.rows(CHART)
            return self.tenths(values[:, col0 : col0 + self.chip])
        if name == ANGLE and name not in self.held:
            ys, xs = np.arange(self.row0, self.row0 + self.chip), np.arange(col0, col0 + self.chip)
            return interpolated(self.grid["angle"], weights(self.grid["lines"], ys), weights(self.grid["samples"], xs)).astype(np.float32)
        values, down, across = self.rows(name)
        if down is None:
            return values[:, col0 : col0 + self.chip].astype(np.float32)
        return interpolated(values, down, weights(across, np.arange(col0, col0 + self.chip))).astype(np.float32)

    def located(self, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
        """(len(rows), len(cols), 2): latitude and longitude at every crossing; beyond the grid its planes go on."""
        (near, down), (side, across) = weights(self.grid["lines"], rows), weights(self.grid["samples"], cols)
        return np.stack([down @ self.grid[k][near, side] @ across.T for k in ("lat", "lon")], axis=-1)


def control(held: Arrays) -> dict[str, np.ndarray]:
    """A control grid's axes, and its values line by line."""
    if GRID["lines"] in held:
        made = {k: np.asarray(held.whole(v), dtype=np.float64).ravel() for k, v in GRID.items()}
        lines, samples = made["lines"], made["samples"]
    else:
        points = {k: np.asarray(held.whole(v), dtype=np.float64).ravel() for k, v in POINTS.items()}
        order = np.lexsort((points["samples"], points["lines"]))
        lines, samples = np.unique(points["lines"]), np.unique(points["samples"])
        made = {k: v[order] for k, v in points.items()} | {"lines": lines, "samples": samples}
    return made | {k: made[k].reshape(len(lines), len(samples)) for k in ("lat", "lon", "angle")}


def charted(held: Arrays):
    """Polygon numbers -> tenths, NaN without polygon, row or meaning; of a polygon's rows the last that means something."""
    lines = [x.split(";") for x in held.strings(CODES)]
    tenths: dict[int, float] = {}
    if lines and {"poly_id", "CT"} <= {*lines[0]}:
        number, total = lines[0].index("poly_id"), lines[0].index("CT")
        for line in lines[1:]:
            if max(number, total) < len(line) and line[number].strip().isdigit() and (ct := tenths_of(line[total])) is not None:
                tenths[int(line[number])] = ct
    known = np.array(sorted(tenths), dtype=np.float64)
    means = np.array([tenths[k] for k in sorted(tenths)] + [np.nan], dtype=np.float32)

    def decoded(numbers: np.ndarray) -> np.ndarray:
        numbers = np.trunc(numbers.astype(np.float64))
        at = np.searchsorted(known, numbers)
        found = (at < len(known)) & (numbers != POLYGON_NONE)
        found[found] = known[at[found]] == numbers[found]
        return means[np.where(found, at, len(known))]

    return decoded


def in_patches(values: np.ndarray, patch: int) -> np.ndarray:
    """A chip's pixels, patch by patch, row by row."""
    side = len(values) // patch
    return values.reshape(side, patch, side, patch).swapaxes(1, 2).reshape(side * side, patch * patch)


def ring(points: np.ndarray, i: np.ndarray, j: np.ndarray, size: int = 1) -> np.ndarray:
    """Corners of squares of a lattice: top left, top right, bottom right, bottom left; lat, lon of each."""
    return np.concatenate([points[i, j], points[i, j + size], points[i + size, j + size], points[i + size, j]], axis=-1)


def lists(values: np.ndarray, of: pa.DataType) -> pa.Array:
    """A matrix as an array of its rows."""
    return pa.ListArray.from_arrays(np.arange(0, values.size + 1, values.shape[1], dtype=np.int32), pa.array(values.ravel(), of))


def patches_of(held: Arrays, scene: str, split: str, row0: int, bands: Sequence[str], chip: int, patch: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """A batch for each chip of a chip row."""
    band, side = Band(held, SAR[0], row0, chip), chip // patch
    i, j = (x.ravel() for x in np.indices((side, side)))
    for col0 in chip_places(band.width, chip):
        pixels = {b: band.band(b, col0) for b in dict.fromkeys([*bands, *SAR, "distance_map", "ct"])}
        ok = ~np.isnan(pixels[SAR[0]]) & ~np.isnan(pixels[SAR[1]]) & (pixels["distance_map"] != LAND)
        at = band.located(row0 + np.arange(side + 1.0) * patch, col0 + np.arange(side + 1.0) * patch)
        middle = band.located(np.array([row0 + chip / 2]), np.array([col0 + chip / 2]))[0]
        n = side * side
        whole = ring(at, np.array([0]), np.array([0]), side)
        columns = [
            pa.array([scene] * n), pa.array([split] * n), *(pa.array(np.full(n, x, np.int32)) for x in (row0, col0)),
            pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
            *(pa.array(np.full(n, bool(x.any()))) for x in (ok, ~np.isnan(pixels["ct"]))),
            lists(ring(at, i, j), pa.float64()), lists(whole.repeat(n, 0), pa.float64()), lists(middle.repeat(n, 0), pa.float64()),
            *(lists(in_patches(pixels[b], patch), pa.float32()) for b in bands),
        ]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


class SceneRows(DataSource):
    """Format `scene_rows`; options: path, or plan (see `scene_rows`); split, bands (JSON), chip, patch."""

    @classmethod
    def name(cls) -> str:
        return "scene_rows"

    def bands(self) -> list[str]:
        return json.loads(self.options["bands"])

    def schema(self) -> str:
        return ", ".join([PLACE, *(f"`{b}` array<float>" for b in self.bands())])

    def reader(self, schema: StructType) -> DataSourceReader:
        return SceneReader(schema, self.options, self.bands())


class SceneReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str], bands: list[str]):
        self.schema, self.options, self.bands = schema, options, bands
        self.chip, self.patch = int(options.get("chip", CHIP)), int(options.get("patch", PATCH))

    def partitions(self) -> Sequence[Split]:
        if plan := self.options.get("plan"):
            return [Split(path, scene, tuple(rows)) for path, scene, rows in json.loads(plan)]
        return planned(self.options["path"], self.chip) or [Split("", "", ())]

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        held, schema = Arrays(partition.path) if partition.rows else None, to_arrow_schema(self.schema)
        for row0 in partition.rows:
            yield from patches_of(held, partition.scene_id, self.options.get("split", "train"), row0, self.bands, self.chip, self.patch, schema)


def scene_rows(spark: SparkSession, root: str, bands: Sequence[str], split: str = "train", chip: int = CHIP, patch: int = PATCH, plan: list[Split] | None = None) -> DataFrame:
    """Rows of patches of the scenes below root, or of a plan's chip rows."""
    spark.dataSource.register(SceneRows)
    reader = spark.read.format("scene_rows").option("bands", json.dumps([*bands])).option("split", split).option("chip", chip).option("patch", patch)
    if plan is not None:
        reader = reader.option("plan", json.dumps([[s.path, s.scene_id, s.rows] for s in plan] or [["", "", []]]))
    return reader.load(root)

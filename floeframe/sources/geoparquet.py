"""A sink of GeoParquet tables by scene, with a two-phase commit.

Rows come to a task scene by scene, part by part. A task writes its parts below `_temporary`; only when all tasks are
done does the driver move them to `<table>/scene_id=<scene>/part-<number>.parquet`, so a killed task or a failed job
leaves no part. A part's number is given with its rows: writing it once more replaces it. No rows, no file.

Several tables may be written from one pass over the rows. Each file's footer names its geometry column and the
coordinate reference system under `geo`.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from floeframe.functions.geo import AXIS, CENTRE, FLATTENING, PARALLELS

#: Rows of a row group.
GROUP = 4096


def _angle(name: str, value: float, code: int) -> dict:
    return {"name": name, "value": value, "unit": "degree", "id": {"authority": "EPSG", "code": code}}


def _length(name: str, code: int) -> dict:
    return {"name": name, "value": 0, "unit": "metre", "id": {"authority": "EPSG", "code": code}}


def _axes(subtype: str, unit: str, *axes: tuple[str, str, str]) -> dict:
    return {"subtype": subtype, "axis": [{"name": n, "abbreviation": a, "direction": d, "unit": unit} for n, a, d in axes]}


#: EPSG:3978 as PROJJSON (fixed values of the register).
CRS = {
    "$schema": "https://proj.org/schemas/v0.7/projjson.schema.json",
    "type": "ProjectedCRS",
    "name": "NAD83 / Canada Atlas Lambert",
    "base_crs": {
        "name": "NAD83",
        "datum": {"type": "GeodeticReferenceFrame", "name": "North American Datum 1983", "ellipsoid": {"name": "GRS 1980", "semi_major_axis": AXIS, "inverse_flattening": 1 / FLATTENING}},
        "coordinate_system": _axes("ellipsoidal", "degree", ("Geodetic latitude", "Lat", "north"), ("Geodetic longitude", "Lon", "east")),
        "id": {"authority": "EPSG", "code": 4269},
    },
    "conversion": {
        "name": "Canada Atlas Lambert",
        "method": {"name": "Lambert Conic Conformal (2SP)", "id": {"authority": "EPSG", "code": 9802}},
        "parameters": [
            _angle("Latitude of false origin", CENTRE[0], 8821), _angle("Longitude of false origin", CENTRE[1], 8822),
            _angle("Latitude of 1st standard parallel", PARALLELS[0], 8823), _angle("Latitude of 2nd standard parallel", PARALLELS[1], 8824),
            _length("Easting at false origin", 8826), _length("Northing at false origin", 8827),
        ],
    },
    "coordinate_system": _axes("Cartesian", "metre", ("Easting", "E", "east"), ("Northing", "N", "north")),
    "id": {"authority": "EPSG", "code": 3978},
}


def geo(column: str) -> str:
    """What a footer says of its geometry."""
    about = {"encoding": "WKB", "geometry_types": ["Polygon"], "crs": CRS, "edges": "planar"}
    return json.dumps({"version": "1.0.0", "primary_column": column, "columns": {column: about}})


@dataclass
class Parts(WriterCommitMessage):
    """(temporary path, path) of what a task wrote."""

    moves: list[tuple[str, str]]


class GeoParquet(DataSource):
    """Format `geoparquet_parts`; options: path, tables (JSON; see `write`), scene and part (columns)."""

    @classmethod
    def name(cls) -> str:
        return "geoparquet_parts"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return PartWriter(self.options)


class PartWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.root, self.tables = options["path"].rstrip("/"), json.loads(options["tables"])
        self.scene, self.part = options["scene"], options["part"]
        self.aside = f"{self.root}/_temporary/{uuid.uuid4().hex}"

    def files(self):
        return pyarrow.fs.FileSystem.from_uri(self.root)[0]

    def place(self, path: str) -> str:
        return pyarrow.fs.FileSystem.from_uri(path)[1]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Parts:
        attempt, moves = uuid.uuid4().hex, []
        key, open_parts = None, {}
        try:
            for batch in iterator:
                keys = [*zip(batch.column(self.scene).to_pylist(), batch.column(self.part).to_pylist())]
                cuts = [0, *(k for k in range(1, len(keys)) if keys[k] != keys[k - 1]), len(keys)]
                for a, b in zip(cuts, cuts[1:]):
                    if a == b:
                        continue
                    if keys[a] != key:
                        close(open_parts)
                        key = keys[a]
                        if any(place.endswith(end := f"/{self.scene}={key[0]}/part-{key[1]:04d}.parquet") for _, place in moves):
                            raise ValueError(f"rows of {end} don't follow one another")
                    for name, about in self.tables.items():
                        rows = batch.slice(a, b - a)
                        if about.get("where"):
                            rows = rows.filter(pc.fill_null(rows.column(about["where"]), False))
                        if rows.num_rows:
                            if name not in open_parts:
                                place = f"{name}/{self.scene}={key[0]}/part-{key[1]:04d}.parquet"
                                moves.append((f"{self.aside}/{attempt}/{place}", f"{self.root}/{place}"))
                                open_parts[name] = Part(self.files(), self.place(moves[-1][0]))
                            columns = about["columns"]
                            open_parts[name].add(pa.table({out: rows.column(held) for out, held in columns.items()}))
        finally:
            close(open_parts)
        return Parts(moves)

    def commit(self, messages: list[Parts | None]) -> None:
        fs = self.files()
        for source, target in (move for m in messages if m for move in m.moves):
            fs.create_dir(self.place(target.rsplit("/", 1)[0]), recursive=True)
            fs.move(self.place(source), self.place(target))
        self.cleared()

    def abort(self, messages: list[Parts | None]) -> None:
        self.cleared()

    def cleared(self) -> None:
        fs = self.files()
        if fs.get_file_info(self.place(self.aside)).type != pyarrow.fs.FileType.NotFound:
            fs.delete_dir(self.place(self.aside))
        above = self.place(f"{self.root}/_temporary")
        if fs.get_file_info(above).type != pyarrow.fs.FileType.NotFound and not fs.get_file_info(pyarrow.fs.FileSelector(above)):
            fs.delete_dir(above)


def close(parts: dict[str, Part]) -> None:
    for part in parts.values():
        part.close()
    parts.clear()


class Part:
    """A file that is being written, row group by row group."""

    def __init__(self, fs: pyarrow.fs.FileSystem, place: str):
        fs.create_dir(place.rsplit("/", 1)[0], recursive=True)
        self.fs, self.path, self.held, self.rows, self.file = fs, place, [], 0, None

    def add(self, table: pa.Table) -> None:
        self.held.append(table)
        self.rows += table.num_rows
        if self.rows >= GROUP:
            self.flush()

    def flush(self) -> None:
        table = pa.concat_tables(self.held)
        if self.file is None:
            self.file = pq.ParquetWriter(self.path, table.schema, filesystem=self.fs, compression="zstd")
        self.file.write_table(table)
        self.held, self.rows = [], 0

    def close(self) -> None:
        if self.held:
            self.flush()
        if self.file is not None:
            self.file.add_key_value_metadata({"geo": geo("geometry")})
            self.file.close()


def write(rows: DataFrame, root: str, tables: dict[str, dict], part: str, scene: str = "scene_id") -> None:
    """Write tables {name: {"columns": {name in the file: column}, "where": a boolean column or nothing}} below root.

    Each has a column `geometry` of WKB. Rows of a scene's part must lie in one partition, one after the other.
    """
    rows.sparkSession.dataSource.register(GeoParquet)
    writer = rows.write.format("geoparquet_parts").option("tables", json.dumps(tables)).option("scene", scene).option("part", part)
    writer.mode("append").save(root)

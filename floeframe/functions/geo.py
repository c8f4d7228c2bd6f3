"""Geolocation from a grid of ground control points, and footprints in a conformal conic projection."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floeframe.functions.encodings import place_encoding
from floeframe.schema import CHIP


def control_grids(points: DataFrame) -> DataFrame:
    """One row a scene of points (scene_id, line, sample, lat, lon, angle): axes, and values line by line."""
    ordered = F.array_sort(F.collect_list(F.struct("line", "sample", "lat", "lon", "angle"))).alias("p")
    grids = points.groupBy("scene_id").agg(ordered, F.array_sort(F.collect_set("line")).alias("lines"), F.array_sort(F.collect_set("sample")).alias("samples"))
    return grids.select("scene_id", "lines", "samples", *(F.col("p")[name].alias(name) for name in ("lat", "lon", "angle")))


def _cell(axis: Column, at: Column) -> Column:
    """Index of the cell for `at`; outside places take the nearest cell, so their weights extrapolate."""
    below = F.size(F.filter(axis, lambda a: a <= at)) - 1
    return F.greatest(F.lit(0), F.least(below, F.size(axis) - 2))


def bilinear(lines: Column, samples: Column, values: Column, row: Column, col: Column) -> Column:
    i, j = _cell(lines, row), _cell(samples, col)
    n = F.size(samples)
    value = lambda di, dj: F.get(values, (i + di) * n + j + dj)
    t = (row - F.get(lines, i)) / (F.get(lines, i + 1) - F.get(lines, i))
    u = (col - F.get(samples, j)) / (F.get(samples, j + 1) - F.get(samples, j))
    return (1 - t) * ((1 - u) * value(0, 0) + u * value(0, 1)) + t * ((1 - u) * value(1, 0) + u * value(1, 1))


#: EPSG:3978: conic with parallels 49 and 77, centre 49 N 95 W, GRS 80 (fixed values).
AXIS, FLATTENING, PARALLELS, CENTRE = 6378137.0, 1 / 298.257222101, (49.0, 77.0), (49.0, -95.0)


def conic(lat: Column, lon: Column) -> tuple[Column, Column]:
    """Easting and northing in metres: Lambert conformal conic with two parallels (Snyder 1987, 15-1 to 15-10)."""
    e = math.sqrt(2 * FLATTENING - FLATTENING**2)
    m = lambda p: math.cos(p) / math.sqrt(1 - (e * math.sin(p)) ** 2)
    t = lambda p: math.tan(math.pi / 4 - p / 2) / ((1 - e * math.sin(p)) / (1 + e * math.sin(p))) ** (e / 2)
    p1, p2, p0 = (math.radians(x) for x in (*PARALLELS, CENTRE[0]))
    n = (math.log(m(p1)) - math.log(m(p2))) / (math.log(t(p1)) - math.log(t(p2)))
    scale = AXIS * m(p1) / (n * t(p1) ** n)
    phi = F.radians(lat)
    es = F.sin(phi) * e
    tc = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((1 - es) / (1 + es), F.lit(e / 2))
    rho, theta = F.pow(tc, F.lit(n)) * scale, F.radians(lon - CENTRE[1]) * n
    return rho * F.sin(theta), F.lit(scale * t(p0) ** n) - rho * F.cos(theta)


def footprint(row0: Column, col0: Column, size: int) -> list[tuple[Column, Column]]:
    """Corners of a square: top left, top right, bottom right, bottom left."""
    return [(row0 + r, col0 + c) for r, c in ((0, 0), (0, size), (size, size), (size, 0))]


def located(grid: Column, row: Column, col: Column) -> Column:
    """(lat, lon, angle) at a place, from a scene's control grid (lines, samples, lat, lon, angle)."""
    value = lambda name: bilinear(grid["lines"], grid["samples"], grid[name], row, col)
    return F.struct(*(value(name).alias(name) for name in ("lat", "lon", "angle")))


def projected(grid: Column, row: Column, col: Column) -> tuple[Column, Column]:
    """Easting and northing of a place. The same place gives the same numbers, so neighbours' corners meet."""
    value = lambda name: bilinear(grid["lines"], grid["samples"], grid[name], row, col)
    return conic(value("lat"), value("lon"))


def square(grid: Column, row0: Column, col0: Column, size: int) -> list[tuple[Column, Column]]:
    """Projected corners of the square of pixels from (row0, col0): a patch of a chip, or the chip itself."""
    return [projected(grid, r.cast("double"), c.cast("double")) for r, c in footprint(row0, col0, size)]


def with_square(rows: DataFrame, name: str, row0: Column, col0: Column, size: int, grid: str = "grid") -> DataFrame:
    """rows with the projected square of pixels from (row0, col0) as WKB in column name: step by step, so that each
    number is computed once."""
    places = [(r.cast("double"), c.cast("double")) for r, c in footprint(row0, col0, size)]
    at = rows.withColumns({f"__at{i}": located(F.col(grid), r, c) for i, (r, c) in enumerate(places)})
    points = (conic(F.col(f"__at{i}.lat"), F.col(f"__at{i}.lon")) for i in range(4))
    flat = at.withColumns({f"__xy{i}": F.struct(x.alias("x"), y.alias("y")) for i, (x, y) in enumerate(points)})
    ring = polygon_wkb([(F.col(f"__xy{i}.x"), F.col(f"__xy{i}.y")) for i in range(4)])
    return flat.withColumn(name, ring).drop(*(f"__{k}{i}" for k in ("at", "xy") for i in range(4)))


def with_ring(rows: DataFrame, name: str, corners: str, where: Column | None = None) -> DataFrame:
    """rows with the projected square of four corners (lat and lon of each, in one array) as WKB in column name; null
    where `where` doesn't hold. Step by step, so that each number is computed once."""
    points = [conic(F.get(corners, F.lit(2 * i)), F.get(corners, F.lit(2 * i + 1))) for i in range(4)]
    flat = rows.withColumns({f"__xy{i}": F.struct(x.alias("x"), y.alias("y")) for i, (x, y) in enumerate(points)})
    ring = polygon_wkb([(F.col(f"__xy{i}.x"), F.col(f"__xy{i}.y")) for i in range(4)])
    return flat.withColumn(name, ring if where is None else F.when(where, ring)).drop(*(f"__xy{i}" for i in range(4)))


def chip_places(chips: DataFrame, grids: DataFrame, chip: int = CHIP) -> DataFrame:
    """Chips (scene_id, row0, col0, ...) with the place of their middle and its encodings: centroid_lat, centroid_lon,
    sin_lat, cos_lat, sin_lon, cos_lon. Grids are one row a scene; whether they are broadcast is left to their size."""
    half = chip / 2.0
    at = located(F.col("__grid"), F.col("row0") + half, F.col("col0") + half)
    held = grids.select("scene_id", F.struct("lines", "samples", "lat", "lon", "angle").alias("__grid"))
    made = chips.join(held, "scene_id").withColumn("__at", at)
    made = made.withColumns({"centroid_lat": F.col("__at.lat"), "centroid_lon": F.col("__at.lon")}).drop("__at", "__grid")
    names = ("sin_lat", "cos_lat", "sin_lon", "cos_lon")
    encoded = place_encoding(F.col("centroid_lat"), F.col("centroid_lon"))
    return made.withColumns(dict(zip(names, encoded)))


def _double(x: Column) -> Column:
    """A double's eight bytes, big-endian, in hexadecimal: sign, exponent and fraction taken apart arithmetically."""
    a = F.abs(x)
    exponent = F.floor(F.log2(F.when(a == 0, 1.0).otherwise(a))).cast("int")
    exponent = F.when(F.pow(F.lit(2.0), exponent) > a, exponent - 1).when(F.pow(F.lit(2.0), exponent + 1) <= a, exponent + 1).otherwise(exponent)
    fraction = ((a / F.pow(F.lit(2.0), exponent) - 1) * float(1 << 52)).cast("long")
    bits = F.when(a == 0, F.lit(0).cast("long")).otherwise((exponent + 1023).cast("long") * (1 << 52) + fraction)
    signed = F.lpad(F.hex(bits), 16, "0")
    first = F.hex(F.conv(F.substring(signed, 1, 1), 16, 10).cast("int") + 8)
    return F.when(x < 0, F.concat(first, F.substring(signed, 2, 15))).otherwise(signed)


def polygon_wkb(corners: list[tuple[Column, Column]]) -> Column:
    """A closed one-ring polygon in big-endian WKB, as Column arithmetic."""
    ring = [*corners, corners[0]]
    head = f"0000000003{1:08X}{len(ring):08X}"
    return F.unhex(F.concat(F.lit(head), *(_double(v) for point in ring for v in point)))

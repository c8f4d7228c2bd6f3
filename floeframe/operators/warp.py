"""Rasters brought onto a regular grid of a plane, by their control points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How far outside of its unit square a place may lie and still count as in a quad: rounding must not lose a place on
#: an edge that two quads share.
EDGE = 1e-9


def quads(points: DataFrame) -> DataFrame:
    """Cells of scenes' control grids, from points (scene_id, line, sample, x, y): (scene_id, line0, line1, sample0,
    sample1, p00, p01, p10, p11), p a struct of x and y, its first digit the line's side, its second the sample's.

    Grids are some hundred points a scene. A scene whose points aren't a full grid has no quad where one is missing.
    """
    key = F.struct("line", "sample")
    grids = points.groupBy("scene_id").agg(
        F.map_from_entries(F.collect_list(F.struct(key.alias("key"), F.struct("x", "y").alias("value")))).alias("at"),
        F.array_sort(F.collect_set("line")).alias("lines"),
        F.array_sort(F.collect_set("sample")).alias("samples"),
    )
    pairs = lambda axis: F.arrays_zip(
        F.slice(axis, F.lit(1), F.size(axis) - 1).alias("a"), F.slice(axis, F.lit(2), F.size(axis) - 1).alias("b")
    )
    each = grids.where((F.size("lines") > 1) & (F.size("samples") > 1))
    each = each.withColumn("l", F.explode(pairs(F.col("lines")))).withColumn("s", F.explode(pairs(F.col("samples"))))
    corner = lambda a, b: F.try_element_at("at", F.struct(F.col(f"l.{a}").alias("line"), F.col(f"s.{b}").alias("sample")))
    sides = {"line0": F.col("l.a"), "line1": F.col("l.b"), "sample0": F.col("s.a"), "sample1": F.col("s.b")}
    made = each.withColumns(sides | {"p00": corner("a", "a"), "p01": corner("a", "b"), "p10": corner("b", "a"), "p11": corner("b", "b")})
    whole = made.dropna(subset=["p00", "p01", "p10", "p11"])
    return whole.select("scene_id", *sides, "p00", "p01", "p10", "p11")


def _cross(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    return a[0] * b[1] - a[1] * b[0]


def inverse(rows: DataFrame, x: str, y: str) -> DataFrame:
    """rows of `quads` with places x, y: those that lie in their quad, with `line` and `sample` there.

    A quad is the bilinear image of its unit square; the place's share v of the way along the lines solves a quadratic
    whose leading term vanishes where the quad is a parallelogram, so the roots are taken in the form that stays finite.
    """
    p = lambda name: (F.col(f"{name}.x"), F.col(f"{name}.y"))
    less = lambda a, b: (a[0] - b[0], a[1] - b[1])
    pair = lambda name: (F.col(f"__{name}x"), F.col(f"__{name}y"))
    put = lambda name, v: {f"__{name}x": v[0], f"__{name}y": v[1]}
    b, c = less(p("p01"), p("p00")), less(p("p10"), p("p00"))
    made = rows.withColumns(put("e", less((F.col(x), F.col(y)), p("p00"))) | put("b", b) | put("c", c))
    d = less(less(p("p11"), p("p10")), pair("b"))
    made = made.withColumns(put("d", d))
    e, b, c, d = map(pair, "ebcd")
    made = made.withColumns({"__q2": -_cross(c, d), "__q1": _cross(e, d) - _cross(c, b), "__q0": _cross(e, b)})
    q2, q1, q0 = F.col("__q2"), F.col("__q1"), F.col("__q0")
    root = F.sqrt(F.greatest(q1 * q1 - 4 * q2 * q0, F.lit(0.0)))
    made = made.withColumn("__t", -(q1 + F.when(q1 < 0, -root).otherwise(root)) / 2)
    made = made.withColumn("__v", F.explode(F.array(F.try_divide(q0, F.col("__t")), F.try_divide(F.col("__t"), q2))))
    inside = lambda s: s.between(-EDGE, 1 + EDGE)
    made = made.where(inside(F.col("__v")))
    v = F.col("__v")
    along = (b[0] + v * d[0], b[1] + v * d[1])
    rest = (e[0] - v * c[0], e[1] - v * c[1])
    u = F.try_divide(rest[0] * along[0] + rest[1] * along[1], along[0] * along[0] + along[1] * along[1])
    made = made.withColumn("__u", u).where(inside(F.col("__u")))
    at = lambda low, high, share: F.col(low) + (F.col(high) - F.col(low)) * F.col(share)
    places = {"line": at("line0", "line1", "__v"), "sample": at("sample0", "sample1", "__u")}
    return made.withColumns(places).drop(*(c for c in made.columns if c.startswith("__")))


def targets(cells: DataFrame, step: float) -> DataFrame:
    """(scene_id, i, j, line, sample): the places in the raster of the grid cells whose middles quads cover.

    Cell (i, j) has its middle at ((j + 0.5) * step, (i + 0.5) * step) of the plane. Each quad makes the cells of its
    own bounding box, so nothing is compared with anything; a middle on the edge of several takes the least place.
    """
    name = lambda f, axis: f(*(F.col(f"p{k}.{axis}") for k in ("00", "01", "10", "11")))
    first = lambda axis: F.ceil(name(F.least, axis) / step - 0.5 - EDGE)
    last = lambda axis: F.floor(name(F.greatest, axis) / step - 0.5 + EDGE)
    over = lambda axis: F.when(first(axis) <= last(axis), F.sequence(first(axis), last(axis)))
    each = cells.withColumn("i", F.explode(over("y"))).withColumn("j", F.explode(over("x")))
    each = each.withColumns({"__x": (F.col("j") + 0.5) * step, "__y": (F.col("i") + 0.5) * step})
    held = inverse(each.withColumnsRenamed({"__x": "at_x", "__y": "at_y"}), "at_x", "at_y")
    one = held.groupBy("scene_id", "i", "j").agg(F.min(F.struct("line", "sample")).alias("at"))
    return one.select("scene_id", "i", "j", "at.line", "at.sample")


def warped(pixels: DataFrame, points: DataFrame, values: list[str], step: float) -> DataFrame:
    """(scene_id, i, j, row, col, values...): the grid's cells, each with its nearest pixel's values.

    pixels: (scene_id, row, col, values...), one row a pixel; points: as in `quads`, in the plane of the grid. A cell
    whose nearest pixel isn't there is left out. Cells meet pixels by place in an equi-join.
    """
    nearest = lambda c: F.floor(F.col(c) + 0.5).cast("bigint")
    places = targets(quads(points), step).select("scene_id", "i", "j", nearest("line").alias("row"), nearest("sample").alias("col"))
    held = pixels.select("scene_id", F.col("row").cast("bigint").alias("row"), F.col("col").cast("bigint").alias("col"), *values)
    return places.join(held, ["scene_id", "row", "col"])

"""Distance to land, crops that are drawn again, and prediction by tiles, against brute force."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from floeframe.functions import tiling
from floeframe.operators import distance, sampling, tiles


def squares(land):
    at = np.argwhere(land)
    places = np.indices(land.shape).reshape(2, -1).T
    return ((places[:, None] - at[None]) ** 2).sum(2).min(1).reshape(land.shape)


@pytest.mark.parametrize("seed", range(8))
def test_distance_transform(seed):
    r = np.random.default_rng(seed)
    land = r.random(r.integers(1, 40, 2)) < [0.01, 0.1, 0.5, 0.9][seed % 4]
    land[r.integers(len(land)), r.integers(land.shape[1])] = True
    near = np.array([distance.along(row) for row in land])
    assert (distance.down(near) == squares(land)).all()
    assert (distance.down(np.full((5, 3), distance.NONE)) == distance.NONE).all()


def test_distance_of_scenes(spark):
    r = np.random.default_rng(1)
    held = {"a": r.random((30, 21)) < 0.02, "b": r.random((7, 40)) < 0.3, "none": np.zeros((4, 5), dtype=bool)}
    rows = [(s, i, [bool(x) for x in row], 1) for s, land in held.items() for i, row in enumerate(land)]
    df = spark.createDataFrame(rows, "scene_id string, row int, land array<boolean>, near int").repartition(5)
    got = {(x.scene_id, x.row, x.col): x.squared for x in distance.pixels(distance.to_land(df, 8)).collect()}
    assert len(got) == sum(x.size for x in held.values()) and all(v is None for (s, *_), v in got.items() if s == "none")
    for s in "ab":
        want = squares(held[s])
        assert all(got[s, i, j] == want[i, j] for i, j in np.ndindex(want.shape))
    land = spark.createDataFrame([("a", int(i), int(j)) for i, j in np.argwhere(held["a"])], "scene_id string, row int, col int")
    scenes = spark.createDataFrame([("a", 30, 21), ("x", 2, 3)], "scene_id string, height int, width int")
    made = {(x.scene_id, x.row): x.land for x in distance.raster_rows(land.union(land), scenes).collect()}
    assert len(made) == 32 and all(made["a", i] == row.tolist() for i, row in enumerate(held["a"])) and made["x", 1] == [False] * 3
    for broken in (df.where("row <> 2"), df.union(df.where("row = 2"))):
        with pytest.raises(Exception, match="missing or there twice"):
            distance.to_land(broken).collect()
    assert distance.to_land(df.limit(0)).count() == 0


def test_crops_are_drawn_until_they_fit(spark):
    pixels = [("s", i, j, float(i * 50 + j)) for i in range(50) for j in range(50)]
    chart = [("s", i, j) for i in range(20) for j in range(50)]  # the upper part of a scene
    px = spark.createDataFrame(pixels, "scene_id string, row int, col int, v double")
    charted = spark.createDataFrame([*chart, ("bare", 3, 3)], "scene_id string, row int, col int")
    scenes = spark.createDataFrame([("s", 50, 50), ("bare", 50, 60), ("small", 9, 50)], "scene_id string, height int, width int")
    got = sampling.accepted_crops(scenes, charted, 10, 30, seed=4).collect()

    def draw(crop, attempt):
        m = hashlib.md5(f"s:{crop}:{attempt}:4".encode()).hexdigest()
        return int(m[:8], 16) % 41, int(m[8:16], 16) % 41

    want = []
    for crop in range(30):
        attempt = next(k for k in range(63) if draw(crop, k)[0] < 20)
        want.append(("s", crop, attempt, *draw(crop, attempt)))
    assert sorted(map(tuple, got)) == want and max(w[2] for w in want) > 1  # one pixel isn't enough, a small scene has none
    taken = sampling.crop_pixels(px, spark.createDataFrame(got), 10).collect()
    assert len(taken) == 30 * 100
    place = {c: (r, k) for _, c, _, r, k in want}
    assert all(x.v == (place[x.crop][0] + x.i) * 50 + place[x.crop][1] + x.j for x in taken)
    assert sampling.accepted_crops(scenes, charted.limit(0), 10, 3).count() == 0
    assert sampling.accepted_crops(scenes.limit(0), charted, 10, 3).count() == 0


@pytest.mark.parametrize("tile, halo", [(8, 0), (8, 1), (8, 3), (3, 5), (64, 2)])
def test_tiles_make_up_the_scene(spark, tile, halo):
    r = np.random.default_rng(tile)
    value = r.normal(size=(21, 34))
    value[r.random(value.shape) < 0.2] = np.nan
    rows = [("s", i, j, None if math.isnan(value[i, j]) else float(value[i, j]), [None, False, True][(i + j) % 3]) for i in range(21) for j in range(34) if (i * j) % 11 != 3]
    df = spark.createDataFrame(rows, "scene_id string, row int, col int, v double, cloud boolean")
    got = {(x.row, x.col): x.prediction for x in tiles.predicted(df, ["v"], tiles.box_mean(halo), F.lit(21), F.lit(34), tile, halo, "cloud").collect()}
    assert len(got) == len(rows)
    there = {(i, j): v for _, i, j, v, _ in rows}
    for _, i, j, _, cloud in rows:
        near = [there[k] for k in np.ndindex(21, 34) if k in there and there[k] is not None and max(abs(k[0] - i), abs(k[1] - j)) <= halo]
        want = 255 if cloud else np.mean(near) if near else math.nan
        assert got[i, j] == pytest.approx(want, nan_ok=True)


def test_tiles_of_odd_input(spark):
    df = spark.createDataFrame([("s", 0, 0, 1.0), ("s", 0, 0, 2.0)], "scene_id string, row int, col int, v double")
    args = ["v"], tiles.box_mean(1), F.lit(4), F.lit(4), 2, 1
    with pytest.raises(Exception, match="several pixels"):
        tiles.predicted(df, *args).collect()
    assert tiles.predicted(df.limit(0), *args).count() == 0
    outside = spark.createDataFrame([("s", 9, 0, 1.0), ("s", -1, 0, 2.0), ("s", 3, 3, 2.0)], "scene_id string, row int, col int, v double")
    assert [tuple(x) for x in tiles.predicted(outside, *args).collect()] == [("s", 3, 3, 2.0)]
    masks = spark.createDataFrame([(0.0,), (float("nan"),), (None,), (-5.0,)], "hh double").select(tiles.radar_masked(F.col("hh")))
    assert [x[0] for x in masks.collect()] == [True, True, True, False]


def test_coarse_grids():
    assert tiling.coarse_grid(256, 80) == {"delta": 25.0, "cells": 10.24, "beyond": 0, "side": 256}
    assert tiling.coarse_grid(100, 40) == {"delta": 50.0, "cells": 2.0, "beyond": 0, "side": 100}
    made = tiling.split_variables(["nersc_sar_primary", "btemp_18_7h", "distance_map", "t2m"], ["SIC", "SOD"])
    assert made == {"radar": ["nersc_sar_primary", "distance_map"], "full": ["SIC", "SOD", "nersc_sar_primary", "distance_map"], "coarse": ["btemp_18_7h", "t2m"]}

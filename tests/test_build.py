"""Sources, sinks and the whole build on small synthetic scenes."""

import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from floeframe import schema
from floeframe.operators import validation
from floeframe.plans import build
from floeframe.sources import scene_rows, scenes, tables
from floeframe.streaming import arrivals

NAME = "S1A_EW_GRDM_1SDH_20180124T194759_test"


def corners(wkb):
    """Points of a one-ring polygon in big-endian WKB."""
    return [struct.unpack(">dd", wkb[13 + 16 * i : 29 + 16 * i]) for i in range(5)]


def save(folder, name, side=16, chip_without_label=False):
    y, x = np.mgrid[0:side, 0:side].astype(float)
    held = {b: np.full((side, side), 200.0) for b in schema.MICROWAVE} | {b: np.full((side, side), 250.0) for b in schema.WEATHER}
    held |= {schema.SAR[0]: np.full((side, side), -15.0), schema.SAR[1]: np.full((side, side), -22.0), "distance_map": np.full((side, side), 5.0)}
    held |= {"sar_grid_incidenceangle": 30 + x / 10, "ct": np.full((side, side), 8.0)}
    line, sample = np.meshgrid([0.0, 10.0, 20.0], [0.0, 12.0], indexing="ij")
    held |= {"gcp_lines": [0.0, 10.0, 20.0], "gcp_samples": [0.0, 12.0], "gcp_lat": 61 - line / 100, "gcp_lon": -80 + sample / 100, "gcp_angle": 30 + sample / 10}
    if chip_without_label:
        held["ct"][:8, :8] = np.nan
    folder.mkdir(parents=True, exist_ok=True)
    np.savez(folder / f"{name}.npz", **held)


def rows_of(spark, folder, chip, bands=build.CHANNELS):
    return scene_rows.scene_rows(spark, str(folder / "in"), bands, chip=chip)


def test_build_and_validate(spark, tmp_path):
    save(tmp_path / "in", NAME, chip_without_label=True)
    build.build(spark, str(tmp_path / "in"), str(tmp_path / "out"), "train", chip=8)
    p = tables.read_by_scene(spark, str(tmp_path / "out/patches"), schema.PATCH_TABLE)
    c = tables.read_by_scene(spark, str(tmp_path / "out/chips"), schema.CHIP_TABLE)
    assert p.columns == [*schema.PATCH_TABLE, *schema.PLACE] and c.columns == schema.CHIP_TABLE
    assert c.count() == 3 and {r.chip_id for r in c.collect()} == {f"{NAME}_r{r:05d}_c{k:05d}" for r, k in ((0, 8), (8, 0), (8, 8))}
    r = p.first().asDict()
    assert (r["hh_mean"], r["hv_hh_ratio"], r["btemp_6.9h"], r["t2m"], r["label"], r["is_pure"], r["valid_fraction"], r["distance_to_land"]) == (-15, -7, 200, 250, 8, True, 1, 5)
    assert len(r["patch_token"]) == schema.TOKEN and len(r["geometry"]) == 93
    assert {(v.check, v.rows) for v in validation.violations(p, c).collect()} == {("below", 3)}  # chips of one patch
    same_square = p.select("chip_id", "geometry").join(c.select("chip_id", F.col("geometry").alias("g")), "chip_id")
    assert same_square.where("geometry = g").count() == 3  # a chip of one patch has its footprint
    rings = {x.chip_id[-13:]: corners(x.geometry) for x in c.collect()}
    assert rings["r00000_c00008"][3] == rings["r00008_c00000"][1]  # neighbours meet
    assert rings["r00000_c00008"][2] == rings["r00008_c00008"][1]
    save(tmp_path / "in", "S1B_20190101T000000_x")
    build.build(spark, str(tmp_path / "in"), str(tmp_path / "out"), "train", chip=8)
    after = spark.read.parquet(str(tmp_path / "out/chips"))
    assert after.groupBy("scene_id").count().orderBy("scene_id").select("count").collect() == [(3,), (4,)]

    assert build.build(spark, str(tmp_path / "in"), str(tmp_path / "out"), "train", chip=8) == 0  # all is done
    assert spark.read.parquet(str(tmp_path / "out/chips")).count() == 7
    assert sorted(x.name for x in (tmp_path / "out").iterdir()) == ["chips", "done", "patches"]


def test_a_scene_without_a_chip_is_done_too(spark, tmp_path):
    save(tmp_path / "in", NAME, side=8, chip_without_label=True)
    build.build(spark, str(tmp_path / "in"), str(tmp_path / "out"), "train", chip=8)
    assert [tuple(x) for x in spark.read.parquet(str(tmp_path / "out/done")).collect()] == [(NAME, 0, 1)]
    assert not (tmp_path / "out/patches").exists()  # no rows, no file


def test_patches_of_a_chip_tile_it(spark, tmp_path):
    """Four patches of a chip of 16: neighbours have their corners in common, the outer ones are the chip's."""
    save(tmp_path / "in", NAME)
    rows = build.patch_table(rows_of(spark, tmp_path, 16), chip=16)
    got = {(r.patch_i, r.patch_j): r for r in rows.select("patch_i", "patch_j", "geometry", "chip_geometry").collect()}
    ring = {k: corners(r.geometry) for k, r in got.items()}
    assert ring[0, 0][1] == ring[0, 1][0] and ring[0, 0][2] == ring[1, 1][0] == ring[0, 1][3] == ring[1, 0][1]
    chip = corners(got[0, 0].chip_geometry)
    assert chip == [ring[0, 0][0], ring[0, 1][1], ring[1, 1][2], ring[1, 0][3], ring[0, 0][0]]
    assert got[1, 1].chip_geometry is None


def save_raw(folder, name, side=16, coarse=None):
    """A scene as it is delivered: coarse weather and microwave, polygon numbers with coded rows, angles on the grid."""
    full = lambda v: np.full((side, side), v, dtype=np.float32)
    held = {b: np.full((2, 2), 200.0) for b in schema.MICROWAVE} | {b: np.full((2, 2), 250.0) for b in schema.WEATHER}
    held |= {schema.SAR[0]: full(-15), schema.SAR[1]: full(-22), "distance_map": full(5), "polygon_icechart": full(1).astype(float)}
    held |= {"polygon_codes": np.array(["poly_id;CT", "1;20", "2;-9", "1;80", "1;-9"])} | (coarse or {})
    held["polygon_icechart"][: side // 2, : side // 2] = 2
    held["polygon_icechart"][-1, -1], held["polygon_icechart"][-1, -2] = np.nan, 65535
    held |= {"gcp_lines": [0.0, side - 1.0], "gcp_samples": [0.0, side - 1.0], "gcp_lat": [60.0, 60, 61, 61], "gcp_lon": [-80.0, -79, -80, -79], "gcp_angle": [30.0, 31, 32, 33]}
    folder.mkdir(parents=True, exist_ok=True)
    np.savez(folder / f"{name}.npz", **held)


def test_a_raw_scene_is_composed(spark, tmp_path):
    save_raw(tmp_path / "in", NAME)
    build.build(spark, str(tmp_path / "in"), str(tmp_path / "out"), "train", chip=8)
    rows = {r.chip_id[-13:]: r for r in spark.read.parquet(str(tmp_path / "out/patches")).collect()}
    assert sorted(rows) == ["r00000_c00008", "r00008_c00000", "r00008_c00008"]  # the chip of polygon 2 has no label
    r = rows["r00008_c00008"].asDict()
    assert (r["hh_mean"], r["hv_mean"], r["btemp_6.9h"], r["t2m"], r["label"], r["distance_to_land"]) == (-15, -22, 200, 250, 8, 5)
    assert r["valid_class_fraction"] == 62 / 64 and rows["r00000_c00008"]["valid_class_fraction"] == 1
    assert r["ia_mean"] == pytest.approx(30 + 3 * 11.5 / 15, abs=1e-5)  # the plane's value at the patch's middle


def test_coarse_bands_are_stretched_as_the_operator_does(spark, tmp_path):
    from floeframe.operators import resampling

    small = np.arange(12.0).reshape(3, 4) ** 2
    small[1, 2] = np.nan
    save_raw(tmp_path / "in", NAME, coarse={"t2m": small})
    got = {(c.row0 + i // 8, c.col0 + i % 8): v for c in rows_of(spark, tmp_path, 8, ["t2m"]).collect() for i, v in enumerate(c.t2m)}
    cells = [("s", i, j, 3, 4, float(small[i, j])) for i in range(3) for j in range(4)]
    coarse = spark.createDataFrame(cells, "scene_id string, row int, col int, h int, w int, value double")
    targets = spark.createDataFrame([("s", r, c) for r in range(16) for c in range(16)], "scene_id string, row int, col int")
    want = {(r.row, r.col): r.value for r in resampling.bilinear(targets, coarse, 16, 16).collect()}
    assert len(got) == len(want) == 256 and got == pytest.approx(want, abs=1e-4, nan_ok=True)


def test_the_encoder_knows_time_and_place(spark, tmp_path):
    save_raw(tmp_path / "in", NAME)
    seen = []

    def encode(df):
        seen.append(df.where("patch_i = 0 AND patch_j = 0").select("time_encoding", "place_encoding"))
        return build.hashed_tokens(df)

    build.patch_table(rows_of(spark, tmp_path, 16), encode, 16)
    row = seen[0].first()
    week, hour, lat, lon = 2 * np.pi * 4 / 52, 2 * np.pi * (19 + 47 / 60) / 24, np.radians(60 + 8 / 15), np.radians(-80 + 8 / 15)
    assert row.time_encoding == pytest.approx([np.sin(week), np.cos(week), np.sin(hour), np.cos(hour)], abs=1e-6)
    assert row.place_encoding == pytest.approx([np.sin(lat), np.cos(lat), np.sin(lon), np.cos(lon)], abs=1e-6)


def test_the_encoder_sees_filled_radar(spark, tmp_path):
    save(tmp_path / "in", NAME)
    land = F.transform("distance_map", lambda x, i: F.when((i == 0) & (F.col("patch_i") + F.col("patch_j") == 0), F.lit(0.0)).otherwise(x).cast("float"))
    seen = []

    def encode(df):
        seen.append(df.where("patch_i = 0 AND patch_j = 0").select(F.get(schema.SAR[0], F.lit(0)), F.get(schema.SAR[0], F.lit(1)), "valid_fraction"))
        return build.hashed_tokens(df)

    build.patch_table(rows_of(spark, tmp_path, 16).withColumn("distance_map", land), encode, 16, {schema.SAR[0]: -12.5})
    assert seen[0].collect() == [(-12.5, -15.0, 63 / 64)]


def test_features_need_no_shuffle(spark, tmp_path):
    save(tmp_path / "in", NAME)
    made = build.patch_table(rows_of(spark, tmp_path, 8), chip=8)
    assert "Exchange" not in made._jdf.queryExecution().executedPlan().toString()


def test_listing(spark, tmp_path):
    save(tmp_path / "a/x", "s1")
    save(tmp_path / "b", "s2")
    both = scenes.both_splits(spark, str(tmp_path / "a"), str(tmp_path / "b"))
    assert {(r.scene_id, r.split) for r in both.collect()} == {("s1", "train"), ("s2", "test")}
    assert scenes.first(both, 1).count() == 1 and scenes.first(both, 0).count() == 2
    with pytest.raises(ValueError, match="shorter"):
        scenes.chip_places(200, 256)


def test_statistics_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("t2m", 1.5, 2.0, 3), ("hh", -1.0, 0.5, 4)], "variable string, mean double, std double, n_pixels bigint")
    tables.write_statistics(df, str(tmp_path / "s"))
    back = tables.read_statistics(spark, str(tmp_path / "s"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    assert [tuple(r) for r in tables.band_means(back, ["hh", "none"]).collect()] == [("hh", -1.0)]


def test_logs_pages_and_archives(spark, tmp_path):
    import zipfile

    row = spark.createDataFrame([("s", 1)], "scene string, n int")
    tables.append_log(row, str(tmp_path / "log"))
    tables.append_log(row, str(tmp_path / "log"))
    assert tables.read_log(spark, str(tmp_path / "log"), "scene string, n int").count() == 2
    assert list(tables.paged(lambda page, size: list(range(5))[page * size : (page + 1) * size], 2)) == [0, 1, 2, 3, 4]
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as held:
        held.writestr("d/x.nc", b"abc")
    assert [(r.member, bytes(r.content)) for r in tables.zip_members(spark, str(tmp_path)).collect()] == [("d/x.nc", b"abc")]
    files = spark.createDataFrame([("a",), ("b",)], "path string")
    assert [r.path for r in tables.absent(files, files.where("path = 'a'")).collect()] == ["b"]


def test_arrivals_are_handled_once(spark, tmp_path):
    seen = []
    handle = lambda files, batch: seen.extend(r.path.rsplit("/", 1)[1] for r in files.collect())
    for name in ("s1", "s2"):
        save(tmp_path / "in", name)
        arrivals.on_arrival(spark, str(tmp_path / "in"), str(tmp_path / "ck"), handle).awaitTermination()
    assert seen == ["s1.npz", "s2.npz"]

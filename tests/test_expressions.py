"""Hand-computed expectations of the single operators."""

import math
import struct

import pytest
from pyspark.sql import functions as F

from floeframe import schema
from floeframe.functions import codes, encodings, geo, masks, tiling
from floeframe.operators import array_features, audit, explore, matching, moments, patches, resampling, sampling, scores, validation

NAN = float("nan")


def column(df, c):
    return [r[0] for r in df.select(c).collect()]


def test_contract():
    assert len(schema.PATCH_TABLE) == 47 and len(schema.CHIP_TABLE) == 5
    assert (schema.PATCHES, schema.GRID, len(schema.MICROWAVE), len(schema.WEATHER), len(schema.SAR)) == (1024, 32, 14, 6, 2)
    assert schema.RENAMED["btemp_6_9h"] == "btemp_6.9h"


def test_code_tenths(spark):
    given = ["80", "0", "55", "91", "92", "-9", "99", "50-70", "90-92", " 10 ", "", "x"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(given)], "i int, c string").orderBy("i")
    assert column(df, codes.tenths(F.col("c"))) == [8, 0, 0, 10, 10, None, None, 6, 9.5, 1, None, None]


def test_field_by_header_name(spark):
    df = spark.createDataFrame([("poly_id;CT;CA", "1;80;-9"), ("poly_id;CA", "1;80"), ("poly_id;CT", "1")], "h string, r string")
    assert column(df, codes.field(F.col("h"), F.col("r"), "CT")) == ["80", None, None]


def test_starts_and_bounds(spark):
    df = spark.createDataFrame([(300, 512)], "height int, width int")
    assert column(df, tiling.starts(F.col("height"))) == [[0, 44]]
    got = tiling.chips(df).orderBy("row0", "col0").select("row0", "row1", "col0", "col1").collect()
    assert [tuple(r) for r in got] == [(0, 256, 0, 256), (0, 256, 256, 512), (44, 300, 0, 256), (44, 300, 256, 512)]


def test_side_shorter_than_chip_raises(spark):
    with pytest.raises(Exception, match="shorter than a chip"):
        spark.createDataFrame([(200,)], "height int").select(tiling.starts(F.col("height"))).collect()


def test_pixel_lies_in_up_to_four_chips(spark):
    px = spark.createDataFrame([(100, 100), (10, 100), (10, 290)], "row int, col int")
    got = tiling.with_chips(px, F.lit(300), F.lit(300)).groupBy("row", "col").count().collect()
    assert {(r[0], r[1]): r[2] for r in got} == {(100, 100): 4, (10, 100): 2, (10, 290): 1}


def test_mask_and_fill(spark):
    df = spark.createDataFrame([(1.0, 1.0, 5), (NAN, NAN, 5), (2.0, 2.0, 0), (3.0, 3.0, 5), (1.0, NAN, 5)], "hh double, hv double, d int")
    ok = masks.valid(F.col("hh"), F.col("hv"), F.col("d"))
    assert column(df, ok) == [True, False, False, True, False]
    assert column(df, masks.filled(F.col("hh"), ok, F.lit(-1.0))) == [1, -1, -1, 3, -1]
    arrays = spark.createDataFrame([([1.0, NAN, 2.0, 3.0], [1.0, 1.0, 2.0, 3.0], [5, 5, 0, 5])], "hh array<double>, hv array<double>, d array<int>")
    whole = masks.valid_array(F.col("hh"), F.col("hv"), F.col("d"))
    assert column(arrays, whole) == [[True, False, False, True]]
    assert column(arrays, masks.filled_array(F.col("hh"), whole, F.lit(None).cast("double"))) == [[1, 0, 0, 3]]


def patch(spark, rows, names):
    key = "'s' AS scene_id, 'c' AS chip_id, 0 AS patch_i, 0 AS patch_j"
    return spark.createDataFrame(rows, names).selectExpr("*", *key.split(", "))


@pytest.mark.parametrize(
    ("values", "label", "pure", "share"),
    [([8.0] * 64, 8, True, 1.0), ([8.0] * 32 + [9.0] * 32, 8, False, 1.0), ([9.0] * 32 + [10.0] * 32, 9, False, 1.0), ([NAN] * 64, NAN, False, 0.0), ([0.0] + [6.0] * 5, 4, False, 6 / 64)],
)
def test_labels(spark, values, label, pure, share):
    (r,) = patches.labels(patch(spark, [(v,) for v in values], "ct double")).collect()
    assert (r.label == label or math.isnan(r.label) and math.isnan(label)) and r.is_pure is pure and r.valid_class_fraction == share


def test_halves_round_to_even(spark):
    df = spark.createDataFrame([(x,) for x in (0.5, 1.5, 6.5, 8.5, 9.5)], "x double")
    assert column(df, F.rint("x")) == [0, 2, 6, 8, 10]


def test_radar_statistics(spark):
    rows = [(10.0 if i < 32 else 20.0, -20.0 if i < 32 else -10.0, True) for i in range(64)]
    (r,) = patches.radar(patch(spark, rows, "hh double, hv double, valid boolean")).collect()
    assert (r.hh_mean, r.hv_mean, r.hh_std, r.hv_std, r.hv_hh_ratio, r.valid_fraction) == (15, -15, 5, 5, -30, 1)
    half = [(999.0 if i < 32 else 100.0, 999.0 if i < 32 else 50.0, i >= 32) for i in range(64)]
    (r,) = patches.radar(patch(spark, half, "hh double, hv double, valid boolean")).collect()
    assert (r.hh_mean, r.hv_mean, r.hh_std, r.hv_hh_ratio, r.valid_fraction) == (100, 50, 0, -50, 0.5)
    (r,) = patches.radar(patch(spark, [(1.0, 1.0, False)] * 64, "hh double, hv double, valid boolean")).collect()
    assert math.isnan(r.hh_mean) and math.isnan(r.hv_std) and r.valid_fraction == 0


def test_array_form_equals_pixel_form(spark):
    hh, hv = [float(i % 7) for i in range(64)], [float(i % 5) for i in range(64)]
    ok, ct = [i % 3 > 0 for i in range(64)], [NAN if i % 4 == 0 else float(i % 11) for i in range(64)]
    px = patch(spark, list(zip(hh, hv, ok, ct)), "hh double, hv double, valid boolean, ct double")
    want = patches.radar(px).join(patches.labels(px), patches.KEY).collect()[0].asDict()
    land = [5.0 if x else 0.0 for x in ok]
    rows = [("a", hh, hv, land, ct, ct), ("none", [NAN] * 64, hv, land, [NAN] * 64, hh), ("empty", [], [], [], [], [])]
    df = spark.createDataFrame(rows, "k string, hh array<double>, hv array<double>, distance array<double>, ct array<double>, t array<double>")
    made = {r.k: r.asDict() for r in array_features.with_features(df, {"t": "t_mean"}, filled={"hv": -1.0}, drop=("distance",)).collect()}
    got, none = made["a"], made["none"]
    assert math.isnan(got["t_mean"]) and none["t_mean"] == sum(hh) / 64 and "distance" not in got
    assert got["hv"] == [x if y else -1 for x, y in zip(hv, ok)] and (got["distance_to_land"], none["distance_to_land"]) == (land[36], land[36])
    assert none["valid_fraction"] == 0 and math.isnan(none["label"]) and math.isnan(none["hh_std"]) and none["frac_sic3"] is None and none["is_pure"] is False
    assert made["empty"]["distance_to_land"] is None and math.isnan(made["empty"]["t_mean"])
    for name in ("hh_mean", "hv_mean", "hh_std", "hv_std", "hv_hh_ratio", "valid_fraction", "label", "is_pure", *schema.FRACTIONS):
        assert got[name] == pytest.approx(want[name]), name


def test_plain_mean_keeps_nan_and_centre(spark):
    px = patch(spark, [(r, c, 0, 0, 7 if (r, c) == (4, 4) else 3, NAN if r == c == 0 else 30.0) for r in range(8) for c in range(8)], "row int, col int, row0 int, col0 int, distance int, t2m double")
    assert math.isnan(patches.means(px, ["t2m"]).collect()[0].t2m)
    assert patches.centre_distance(px).collect()[0].distance_to_land == 7


def test_tokens_become_patches(spark):
    df = spark.createDataFrame([("c", [[float(i)] for i in range(1024)])], "chip_id string, t array<array<float>>")
    r = patches.patches_of(df, "t").where("patch_i = 3 and patch_j = 5").collect()
    assert [x.patch_token for x in r] == [[101.0]]


def test_moments_merge_equals_direct(spark):
    rows = [(f"s{i % 3}", "v", float(i * i % 17)) for i in range(60)] + [("s0", "v", 255.0), ("s1", "v", NAN), ("s2", "v", 2.0)]
    df = spark.createDataFrame(rows, "scene_id string, variable string, value double")
    (r,) = moments.finished(moments.merged(moments.scene_moments(df, masks.for_statistics))).collect()
    kept = [v for _, _, v in rows if not math.isnan(v) and v not in (255.0, 2.0)]
    mean = sum(kept) / len(kept)
    assert r.n_pixels == len(kept) and r.mean == pytest.approx(mean, abs=1e-6)
    assert r.std == pytest.approx(math.sqrt(sum((x - mean) ** 2 for x in kept) / len(kept)), abs=1e-6)


def test_audit(spark):
    rows = [("a", 1.0, NAN, 1), ("a", 1.0, 1.0, 1), ("a", NAN, 1.0, 1), ("a", 1.0, 1.0, 0), ("land", 1.0, 1.0, 0)]
    counts = audit.scene_counts(spark.createDataFrame(rows, "scene_id string, hh double, hv double, distance int"))
    assert [tuple(r) for r in counts.collect()] == [("a", 3, 2, 2, 1, 1, 1)]
    assert audit.worst(counts).collect()[0].mismatch_fraction == pytest.approx(2 / 3)


def test_bilinear_extrapolates(spark):
    rows = [("s", 10.0 * i, 10.0 * j, 60.0 + i, -80.0 + j, 30.0 + 2 * i + j) for i in range(2) for j in range(2)]
    grid = geo.control_grids(spark.createDataFrame(rows, "scene_id string, line double, sample double, lat double, lon double, angle double"))
    at = lambda name, y, x: geo.bilinear(F.col("lines"), F.col("samples"), F.col(name), F.lit(y), F.lit(x))
    r = grid.select(at("lat", 5.0, 5.0), at("lon", 5.0, 5.0), at("angle", 5.0, 5.0), at("lat", 20.0, 0.0)).collect()[0]
    assert tuple(r) == pytest.approx((60.5, -79.5, 31.5, 62.0))


def test_conic_centre_and_symmetry(spark):
    df = spark.createDataFrame([(49.0, -95.0), (60.0, -85.0), (60.0, -105.0)], "lat double, lon double")
    e, n = geo.conic(F.col("lat"), F.col("lon"))
    (a, b), (c, d), (x, y) = [tuple(r) for r in df.select(e, n).collect()]
    assert (a, b) == pytest.approx((0, 0), abs=1e-6) and c == pytest.approx(-x) and d == pytest.approx(y)


def test_wkb_is_exact(spark):
    points = [(1.5, -2.25), (1234567.890123, 0.0), (-0.1, 3e-7), (8.0, -1e9)]
    df = spark.createDataFrame([tuple(v for p in points for v in p)], ", ".join(f"v{i} double" for i in range(8)))
    got = column(df, geo.polygon_wkb([(F.col(f"v{2 * i}"), F.col(f"v{2 * i + 1}")) for i in range(4)]))[0]
    want = struct.pack(">BIII", 0, 3, 1, 5) + b"".join(struct.pack(">dd", *p) for p in [*points, points[0]])
    assert bytes(got) == want


def test_time(spark):
    df = spark.createDataFrame([("S1A_EW_GRDM_1SDH_20180124T194759_20180124T194859_x.nc",)], "n string")
    assert str(column(df, encodings.scene_time(F.col("n")))[0]) == "2018-01-24 19:47:59"
    assert column(df, encodings.year_month(F.col("n"))) == ["2018-01"]
    with pytest.raises(Exception, match="no time"):
        spark.createDataFrame([("x.nc",)], "n string").select(encodings.scene_time(F.col("n"))).collect()


def test_resampling_keeps_gaps_small(spark):
    gap = {(2, 2), (2, 3), (3, 2), (3, 3)}
    coarse = spark.createDataFrame([("s", r, c, 6, 6, NAN if (r, c) in gap else 100.0) for r in range(6) for c in range(6)], "scene_id string, row int, col int, h int, w int, value double")
    targets = spark.range(144).selectExpr("'s' AS scene_id", "int(id / 12) AS row", "int(id % 12) AS col")
    got = [r.value for r in resampling.bilinear(targets, coarse, 12, 12).collect()]
    assert any(math.isnan(v) for v in got) and all(math.isnan(v) or v == pytest.approx(100) for v in got) and len(got) == 144


def test_polygon_merge_variants(spark):
    df = spark.createDataFrame([(1, 1, 1, 3, 2, 4)], "a int, b int, c int, x int, y int, z int")
    args = [F.col("a"), F.col("b"), F.col("c")], [F.col("x"), F.col("y"), F.col("z")]
    assert [column(df, codes.merged(*args, how)[0])[0] for how in ("assign", "sum")] == [7, 9]


def test_violations(spark):
    token = [0.0] * 1024
    share = {f: 0.0 for f in schema.FRACTIONS} | {"frac_sic0": 0.5}
    good = {"scene_id": "s", "chip_id": "c", "valid_fraction": NAN, "valid_class_fraction": 1.0, "label": 0.0, "patch_token": token}
    p = spark.createDataFrame([good | share])
    c = spark.createDataFrame([("s", "c", token[:3]), ("s", "c", token)], "scene_id string, chip_id string, class_token array<double>")
    got = {(r.check, r.rows) for r in validation.violations(p, c).collect()}
    assert got == {("fractions", 1), ("class_token", 1), ("repeated_chip", 1), ("below", 1)}
    assert validation.column_faults(["b", "a", "x"], ["a", "b", "c"]) == {"missing": ["c"], "extra": ["x"], "moved": ["a", "b"]}


def test_scores():
    assert scores.combined({"sic": 0.9, "sod": 0.8, "floe": 0.7}) == pytest.approx(82.0)


def test_crops_stay_inside(spark):
    df = spark.createDataFrame([("a", 300, 400), ("b", 10, 10)], "scene_id string, height int, width int")
    got = sampling.crops(df, 256, 20).collect()
    assert len(got) == 20 and all(0 <= r.row0 <= 44 and 0 <= r.col0 <= 144 for r in got)


def test_by_name_and_block_means(spark):
    raw = spark.createDataFrame([("20180124T194759",)], "id string")
    files = spark.createDataFrame([("x_20180124T194759_y.nc",), ("z.nc",)], "file string")
    assert [r.file for r in matching.by_name(raw, files, F.regexp_extract("file", r"\d{8}T\d{6}", 0), "id").collect()] == ["x_20180124T194759_y.nc"]
    px = spark.createDataFrame([(0, 0, 1.0), (1, 1, NAN), (1, 0, 3.0)], "row int, col int, v double")
    assert [r.v for r in explore.block_means(px, "v", 2, 2).collect()] == [2.0]


def test_assembled_parts_must_hold_the_same_patches(spark):
    rows = [("s", "c", i, j) for i in range(2) for j in range(2)]
    a = spark.createDataFrame([(*r, 1.0) for r in rows], "scene_id string, chip_id string, patch_i int, patch_j int, x double")
    b = spark.createDataFrame([(*r, 2.0) for r in rows], "scene_id string, chip_id string, patch_i int, patch_j int, y double")
    assert {(r.x, r.y) for r in patches.assembled(a, b).collect()} == {(1.0, 2.0)} and patches.assembled(a, b).count() == 4
    for left, right in ((a, b.where("patch_i + patch_j > 0")), (a.where("patch_i = 1"), b)):
        with pytest.raises(Exception, match="only one part holds patch"):
            patches.assembled(left, right).collect()


def test_tenths_of_one_code_are_the_columns(spark):
    texts = ["80", "0", "55", "91", "92", "-9", "99", "50-70", "90-92", " 10 ", "", "x", "1-x", "-9-80", "70-", "40.7", "1e400", "nan"]
    got = spark.createDataFrame([(t,) for t in texts], "c string").select("c", codes.tenths(F.col("c")).alias("t")).collect()
    assert {r.c: r.t for r in got} == {t: codes.tenths_of(t) for t in texts}

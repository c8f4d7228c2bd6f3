"""Array files by ranges, the scene source, the GeoParquet sink and the encoder."""

import json
import math
import struct
import time

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from floeframe import schema
from floeframe.operators import encoder, validation
from floeframe.plans import build
from floeframe.sources import arrays, geoparquet, scene_rows, tables

NAME = "S1A_EW_GRDM_1SDH_20180124T194759_test"
KINDS = {"i1": 1, "S1": 2, "i2": 3, "i4": 4, "f4": 5, "f8": 6, "u1": 7, "u2": 8, "u4": 9, "i8": 10, "u8": 11}


def netcdf(path, variables, version=1, records=()):
    """A classic NetCDF file of variables {name: (values, attributes)}; those named in records grow."""
    count = lambda n: n.to_bytes(8 if version == 5 else 4)
    far = lambda n: n.to_bytes(4 if version == 1 else 8)
    filled = lambda data: data + bytes(-len(data) % 4)
    name = lambda x: count(len(x.encode())) + filled(x.encode())
    sides = [("record", 0)] + [(f"d{n}", n) for n in sorted({n for k, (v, _) in variables.items() for n in v.shape[k in records :]})]
    index = {n: k for k, (_, n) in enumerate(sides)}
    of_kind = lambda v: KINDS[v.dtype.str[1:]]

    def attributes(held):
        made = b""
        for key, value in held.items():
            data = np.array([value]).astype(np.dtype(value.dtype).newbyteorder(">"))
            made += name(key) + of_kind(data).to_bytes(4) + count(1) + filled(data.tobytes())
        return (12).to_bytes(4) + count(len(held)) + made if held else bytes(4) + count(0)

    big = {k: v.astype(v.dtype.newbyteorder(">")) for k, (v, _) in variables.items()}
    n_records = max([len(variables[k][0]) for k in records], default=0)
    size = {k: (v[0:1] if k in records else v).nbytes for k, v in big.items()}
    begins = dict.fromkeys(variables, 0)
    for _ in range(2):  # the header's size doesn't depend on what it says
        head = b"CDF" + bytes([version]) + count(n_records) + (10).to_bytes(4) + count(len(sides)) + b"".join(name(a) + count(b) for a, b in sides) + bytes(4) + count(0)
        head += (11).to_bytes(4) + count(len(variables))
        for k, (v, held) in variables.items():
            dims = [0] * (k in records) + [index[n] for n in v.shape[k in records :]]
            head += name(k) + count(len(dims)) + b"".join(map(count, dims)) + attributes(held) + of_kind(v).to_bytes(4) + count(size[k] + -size[k] % 4) + far(begins[k])
        at = len(head)
        for k in [*(k for k in variables if k not in records), *records]:
            begins[k] = at
            at += size[k] + -size[k] % 4
    body = b"".join(filled(big[k].tobytes()) for k in variables if k not in records)
    for r in range(n_records):
        body += b"".join(big[k][r].tobytes() if len(records) == 1 else filled(big[k][r].tobytes()) for k in records)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(head + body)


@pytest.mark.parametrize("version", [1, 2, 5])
@pytest.mark.parametrize("records", [(), ("a",), ("a", "s")])
def test_classic_netcdf(tmp_path, version, records):
    r = np.random.default_rng(version)
    held = {"a": r.normal(size=(7, 5)).astype("f4"), "s": r.integers(-9, 9, (7, 3)).astype("i2"), "t": np.array([[*b"ab;c"], [*b"x\0\0\0"]], dtype="u1").view("S1"), "z": np.arange(3.0)}
    netcdf(tmp_path / "x.nc", {k: (v, {"scale_factor": np.float64(0.5), "_FillValue": np.int16(-9)} if k == "s" else {}) for k, v in held.items()}, version, records)
    got = arrays.Arrays(str(tmp_path / "x.nc"))
    assert (got.rows("a", 2, 5) == held["a"][2:5]).all() and (got.whole("z") == held["z"]).all()
    want = np.where(held["s"] == -9, np.nan, held["s"] * 0.5)
    assert np.array_equal(got.rows("s", 0, 7), want, equal_nan=True) and got.shape("s") == (7, 3)
    assert got.strings("t") == ["ab;c", "x"] and "q" not in got


def test_long_headers_and_other_files(tmp_path, monkeypatch):
    monkeypatch.setattr(arrays, "HEAD", 40)
    netcdf(tmp_path / "x.nc", {"a" * 50: (np.arange(4.0), {})})
    assert arrays.Arrays(str(tmp_path / "x.nc")).whole("a" * 50).tolist() == [0, 1, 2, 3]
    (tmp_path / "cut.nc").write_bytes((tmp_path / "x.nc").read_bytes()[:60])
    (tmp_path / "y.nc").write_bytes(b"\x89HDF\r\n")
    for name in ("cut", "y"):
        with pytest.raises(ValueError, match="end|neither"):
            arrays.Arrays(str(tmp_path / f"{name}.nc"))


@pytest.mark.parametrize("save", [np.savez, np.savez_compressed])
def test_archives(tmp_path, save):
    a = np.arange(4000.0).reshape(1000, 4)
    save(tmp_path / "x.npz", a=a, s=np.array(["ab", "c;d"]), n=np.array(5))
    got = arrays.Arrays(str(tmp_path / "x.npz"))
    assert (got.rows("a", 30, 50) == a[30:50]).all() and got.strings("s") == ["ab", "c;d"] and got.whole("n") == 5
    save(tmp_path / "f.npz", a=np.asfortranarray(a))
    with pytest.raises(ValueError, match="column by column"):
        arrays.Arrays(str(tmp_path / "f.npz"))


def raw_scene(folder, side, name=NAME, seed=1, form="nc"):
    """A scene as it is delivered: coarse weather and microwave, polygon numbers, coded rows, control points."""
    r = np.random.default_rng(seed)
    full = lambda low, high: r.uniform(low, high, (side, side)).astype("f4")
    held = {schema.SAR[0]: full(-25, -5), schema.SAR[1]: full(-35, -15), "distance_map": r.integers(0, 42, (side, side)).astype("f4")}
    held |= {b: r.uniform(150, 250, (5, 6)).astype("f4") for b in [*schema.MICROWAVE, *schema.WEATHER]}
    held[schema.SAR[0]][r.random((side, side)) < 0.01] = np.nan
    held["polygon_icechart"] = np.where(r.random((side, side)) < 0.02, np.nan, 1 + np.indices((side, side)).sum(0) // max(1, side // 4))
    codes = ["poly_id;CT;CA", "1;80;x", "2;55;x", "3;50-70;x", "4;-9;x", "5;91;x", "7;20;x"]
    held["polygon_codes"] = np.array([list(c.ljust(16, "\0").encode()) for c in codes], dtype="u1").view("S1") if form == "nc" else np.array(codes)
    line, sample = (x.ravel() for x in np.meshgrid(np.linspace(0, side - 1, 4), np.linspace(0, side - 1, 3), indexing="ij"))
    held |= {"sar_grid_line": line, "sar_grid_sample": sample, "sar_grid_latitude": 61 - line / side, "sar_grid_longitude": -80 + sample / side, "sar_grid_incidenceangle": 20 + 20 * sample / side}
    folder.mkdir(parents=True, exist_ok=True)
    if form == "nc":
        netcdf(folder / f"{name}.nc", {k: (np.asarray(v), {}) for k, v in held.items()}, 5)
    else:
        np.savez(folder / f"{name}.npz", **held)
    return held


def test_few_bands_cost_few_bytes(spark, tmp_path):
    raw_scene(tmp_path, 512)
    path = str(tmp_path / f"{NAME}.nc")
    held = arrays.Arrays(path)
    row = 64 * 512 * 4
    list(scene_rows.patches_of(held, NAME, "train", 64, [*schema.SAR], 64, 8, build.to_arrow_schema(scene_rows.StructType.fromDDL(scene_rows.PLACE + ", " + ", ".join(f"`{b}` array<float>" for b in schema.SAR)))))
    # four bands of one chip row (polygon numbers in eight bytes), the header, the control grid and the codes
    assert held.file.taken < 5 * row + arrays.HEAD + 4096 < (tmp_path / f"{NAME}.nc").stat().st_size / 5


def test_a_scene_is_several_tasks(spark, tmp_path):
    raw_scene(tmp_path, 96)
    plan = scene_rows.planned(str(tmp_path), 16, split=1)
    assert [s.rows for s in plan] == [(0,), (16,), (32,), (48,), (64,), (80,)]
    assert [s.rows for s in scene_rows.planned(str(tmp_path), 16, done={(NAME, 0)}, most=2)] == [(16, 32)]
    df = scene_rows.scene_rows(spark, str(tmp_path), ["t2m"], chip=16, plan=plan)
    assert df.rdd.getNumPartitions() == 6 and df.count() == 36 * 4
    assert scene_rows.scene_rows(spark, str(tmp_path), ["t2m"], chip=16, plan=[]).count() == 0
    (tmp_path / "none").mkdir()
    assert scene_rows.scene_rows(spark, str(tmp_path / "none"), ["t2m"], chip=16).count() == 0


@pytest.mark.parametrize("form", ["nc", "npz"])
def test_rows_are_the_scenes_pixels(spark, tmp_path, form):
    held = raw_scene(tmp_path, 40, form=form)  # the last chip is moved back
    got = scene_rows.scene_rows(spark, str(tmp_path), [*schema.SAR, "ct", "sar_grid_incidenceangle"], chip=16).collect()
    tenths = {1: 8, 2: 0, 3: 6, 5: 10, 7: 2}
    assert len(got) == 9 * 4
    for r in got:
        i, j = r.row0 + 8 * r.patch_i, r.col0 + 8 * r.patch_j
        cut = lambda a: a[i : i + 8, j : j + 8].ravel()
        assert np.array_equal(r[schema.SAR[0]], cut(held[schema.SAR[0]]), equal_nan=True)
        assert np.array_equal(r.ct, [tenths.get(k, math.nan) for k in cut(held["polygon_icechart"])], equal_nan=True)
        assert r.sar_grid_incidenceangle[3] == pytest.approx(20 + 20 * (j + 3) / 40, abs=1e-4)
        assert r.corners[:2] == pytest.approx([61 - i / 40, -80 + j / 40]) and r.middle == pytest.approx([61 - (r.row0 + 8) / 40, -80 + (r.col0 + 8) / 40])


def test_the_build_at_its_real_size(spark, tmp_path):
    """A scene of 16 chips of 256 x 256 with all bands, in a session with 1 GB of heap (the tests' own)."""
    raw_scene(tmp_path / "in", 1024)
    began = time.time()
    assert build.build(spark, str(tmp_path / "in"), str(tmp_path / "out"), "train") == 1
    took = time.time() - began
    p = tables.read_by_scene(spark, str(tmp_path / "out/patches"), schema.PATCH_TABLE)
    c = tables.read_by_scene(spark, str(tmp_path / "out/chips"), schema.CHIP_TABLE)
    assert p.count() == 16 * 1024 and c.count() == 16 and took < 120
    assert validation.violations(p, c).collect() == []


def test_geoparquet_footer_and_names(spark, tmp_path):
    raw_scene(tmp_path / "in", 32)
    build.build(spark, str(tmp_path / "in"), str(tmp_path / "out"), "train", chip=16)
    files = sorted(str(f.relative_to(tmp_path / "out")) for f in (tmp_path / "out").rglob("part-0*.parquet") if "done" not in str(f))
    assert files == [f"{t}/scene_id={NAME}/part-{k:04d}.parquet" for t in ("chips", "patches") for k in (0, 1)]
    for f in files:
        held = pq.ParquetFile(tmp_path / "out" / f)
        geo = json.loads(held.metadata.metadata[b"geo"])
        assert geo["primary_column"] == "geometry" and geo["columns"]["geometry"]["crs"]["id"] == {"authority": "EPSG", "code": 3978}
        ring = held.read(["geometry"])["geometry"][0].as_py()
        assert struct.unpack(">bii", ring[:9]) == (0, 3, 1)
    assert not (tmp_path / "out/_temporary").exists()


def test_a_killed_task_leaves_no_part(spark, tmp_path):
    rows = spark.range(0, 40, 1, 2).selectExpr("concat('s', id div 20) AS scene_id", "cast(id div 5 AS int) AS part", "X'00' AS geometry", "id")
    dies = rows.withColumn("id", F.when(F.col("id") == 33, F.raise_error(F.lit("lost"))).otherwise(F.col("id")))
    about = {"t": {"columns": {"geometry": "geometry", "id": "id"}}}
    with pytest.raises(Exception, match="lost"):
        geoparquet.write(dies, str(tmp_path / "out"), about, "part")
    assert not [*(tmp_path / "out").rglob("*.parquet")]
    for _ in range(2):  # what is written again replaces what was there
        geoparquet.write(rows, str(tmp_path / "out"), about, "part")
    assert spark.read.parquet(str(tmp_path / "out/t")).count() == 40 and len([*(tmp_path / "out").rglob("*.parquet")]) == 8
    mixed = rows.withColumn("part", (F.col("id") % 2).cast("int"))
    with pytest.raises(Exception, match="follow one another"):
        geoparquet.write(mixed, str(tmp_path / "out"), about, "part")


def test_a_build_goes_on_where_it_was_killed(spark, tmp_path):
    for k in range(2):
        raw_scene(tmp_path / "in", 48, f"S1A_2018012{k}T000000", k)
    seen = []

    def encode(df, die_at=None):
        seen.append({(r.scene_id, r.row0) for r in df.select("scene_id", "row0").distinct().collect()})
        dying = df if die_at is None else df.withColumn("first", F.when(F.col("row0") == die_at, F.raise_error(F.lit("killed")).cast("boolean")).otherwise(F.col("first")))
        return build.hashed_tokens(dying)

    args = spark, str(tmp_path / "in"), str(tmp_path / "out"), "train"
    with pytest.raises(Exception, match="killed"):
        build.build(*args, lambda df: encode(df, 32 if len(seen) else None), 16, round_rows=2)
    assert len(seen) == 2 and spark.read.parquet(str(tmp_path / "out/done")).count() == 2
    first = seen[0]
    seen.clear()
    assert build.build(*args, encode, 16, round_rows=2) == 2
    assert not set.union(*seen) & first and len(set.union(*seen)) == 4  # only open chip rows
    chips = spark.read.parquet(str(tmp_path / "out/chips"))
    assert chips.count() == chips.select("chip_id").distinct().count() == 18
    assert spark.read.parquet(str(tmp_path / "out/patches")).count() == 18 * 4


def by_rows(w, pixels, about):
    """A chip's forward pass, token by token."""
    heads, width = int(w["heads"]), len(w["class"])
    size = width // heads
    norm = lambda x, k: (x - x.mean()) / np.sqrt(x.var() + 1e-5) * w[k] + w[f"{k}_bias"]
    side = round(len(pixels) ** 0.5)
    rates = [1 / 10_000 ** (k / (width / 4)) for k in range(width // 4)]
    place = lambda i, j: np.array([f(x * r) for x in (i, j) for f in (np.sin, np.cos) for r in rates])
    xs = [w["class"] + about @ w["about"]]
    for k, p in enumerate(pixels):
        flat = np.concatenate([(band - m) / s for band, m, s in zip(p, w["mean"], w["std"])])
        xs.append(flat @ w["embed"] + w["embed_bias"] + place(k // side, k % side))
    for b in range(sum(k.endswith(".qkv") for k in w)):
        qkv = [np.split(norm(x, f"{b}.norm1") @ w[f"{b}.qkv"] + w[f"{b}.qkv_bias"], 3) for x in xs]
        out = []
        for q, _, _ in qkv:
            parts = []
            for h in range(heads):
                cut = slice(h * size, (h + 1) * size)
                e = np.array([np.exp(q[cut] @ k[cut] / np.sqrt(size)) for _, k, _ in qkv])
                parts.append(sum(x * v[cut] for x, (_, _, v) in zip(e / e.sum(), qkv)))
            out.append(np.concatenate(parts) @ w[f"{b}.out"] + w[f"{b}.out_bias"])
        xs = [x + o for x, o in zip(xs, out)]
        for k, x in enumerate(xs):
            u = norm(x, f"{b}.norm2") @ w[f"{b}.up"] + w[f"{b}.up_bias"]
            xs[k] = x + (u / (1 + np.exp(-u))) @ w[f"{b}.down"] + w[f"{b}.down_bias"]
    return np.array([norm(x, "norm") for x in xs])


@pytest.mark.parametrize("limit", [1, 1 << 30])
def test_encoder_equals_rows(spark, tmp_path, limit):
    raw_scene(tmp_path / "in", 48)
    weights = encoder.initial(2, 64, 16, 2, 4, seed=3) | {"mean": np.array([-15, -25], np.float32), "std": np.array([5, 4], np.float32)}
    encoder.saved(weights, str(tmp_path / "w.npz"))
    rows = scene_rows.scene_rows(spark, str(tmp_path / "in"), build.CHANNELS, chip=16)
    seen = []

    def encode(df):
        seen.append(df.select("chip_id", "patch_i", "patch_j", *schema.SAR, "time_encoding", "place_encoding"))
        return build.transformer(str(tmp_path / "w.npz"), 16, limit)(df)

    made = build.patch_table(rows, encode, 16).collect()
    chips = {}
    for r in seen[0].collect():
        chips.setdefault(r.chip_id, []).append(r)
    assert len(made) == 36 and len(chips) == 9
    for chip, rs in chips.items():
        rs.sort(key=lambda r: (r.patch_i, r.patch_j))
        want = by_rows(weights, np.array([[r[b] for b in schema.SAR] for r in rs]), np.array(rs[0].time_encoding + rs[0].place_encoding))
        mine = sorted((r for r in made if r.chip_id == chip), key=lambda r: (r.patch_i, r.patch_j))
        assert np.allclose([r.patch_token for r in mine], want[1:], atol=1e-3) and np.allclose(mine[0].class_token, want[0], atol=1e-3)
        assert [r.class_token is None for r in mine] == [False, True, True, True]
    with pytest.raises(Exception, match="isn't whole"):
        build.patch_table(rows.where("patch_i = 0"), encode, 16).collect()
    with pytest.raises(Exception, match="isn't whole|out of order|follow"):
        build.patch_table(rows.orderBy("patch_i"), encode, 16).collect()

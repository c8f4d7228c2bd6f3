"""Names that hold ids, warped rasters, moments as they arrive, downloads, and the build on arrival."""

import hashlib
import http.server
import math
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from floeframe.operators import matching, resampling, warp
from floeframe.plans import catalog
from floeframe.sources import downloads
from floeframe.streaming import arrivals, running
from tests.test_build import NAME, save


def test_names_that_hold_ids(spark):
    ids = ["ab", "b", "zzz", "longer than any name", "", None, "ab", "é"]
    names = ["xaby", "b", "bb", None, "", "caféé", "xaby", "yyyyyyyyyyyyyy-zzz"]
    got = matching.containing(
        spark.createDataFrame([(i,) for i in ids], "id string"), spark.createDataFrame([(n,) for n in names], "name string"), "id", "name"
    )
    want = set()
    for i in {i for i in ids if i}:
        held = {n for n in names if n is not None and i in n}
        want.add((i, min(held, default=None), len(held)))
    assert {tuple(r) for r in got.collect()} == want
    assert got.count() == len(want)
    nothing = spark.createDataFrame([], "id string"), spark.createDataFrame([], "name string")
    assert matching.containing(*nothing, "id", "name").count() == 0
    alone = matching.containing(spark.createDataFrame([("a",)], "id string"), nothing[1], "id", "name")
    assert [tuple(r) for r in alone.collect()] == [("a", None, 0)]


def test_stretches_are_added_up_by_hash(spark):
    """Any letters, those of patterns too; and nothing that sorts all stretches."""
    letters = ["a", "é", "👩", "𝒳", "]", "^", "-", "\\", "\n", " ", "b"]
    r = np.random.default_rng(5)
    word = lambda n: "".join(letters[k] for k in r.integers(0, len(letters) - 1, n))
    ids = [word(n) for n in r.integers(1, 4, 40)]
    names = [word(n) + "b" * (n % 2) + word(n) for n in r.integers(0, 9, 300)]
    got = matching.containing(
        spark.createDataFrame([(i,) for i in ids], "id string"), spark.createDataFrame([(n,) for n in names], "name string").repartition(7), "id", "name"
    )
    held = {i: {n for n in names if i in n} for i in ids}
    # as Spark compares strings: by their bytes
    assert {tuple(x) for x in got.collect()} == {(i, min(h, key=str.encode, default=None), len(h)) for i, h in held.items()}
    assert "SortAggregate" not in got._jdf.queryExecution().executedPlan().toString()


def test_resampling_by_windows(spark, tmp_path):
    """Each target by hand: grids of one row, targets that come again or lie outside, cells that come again; in all tasks."""
    shapes, nan = {"a": (4, 3), "b": (1, 5), "c": (2, 1), "d": (1, 1)}, float("nan")
    cells = [(s, r, c, h, w, nan if (r + 2 * c) % 5 == 3 else (None if (r + c) % 7 == 5 else r * 10.0 + c * c)) for s, (h, w) in shapes.items() for r in range(h) for c in range(w)]
    cells += [("a", 1, 1, 4, 3, 50.0), ("a", 0, 0, 4, 3, float("inf"))]
    places = [(s, r, c) for s in shapes for r in range(-1, 10) for c in range(-1, 8)]
    extra = [("a", 1, 1), ("no such scene", 0, 0)]

    def around(at, small, large):
        place = at * (small - 1) / (large - 1)
        low = min(math.floor(place), max(small - 2, 0))
        return [(i, x) for i, x in ((low, 1 - (place - low)), (min(low + 1, small - 1), place - low)) if x > 0]

    want = {}
    for s, r, c in places:
        h, w = shapes[s]
        met = [(v, y * x) for i, y in around(r, h, 9) for j, x in around(c, w, 7) for q, k, m, _, _, v in cells if (q, k, m) == (s, i, j) and v is not None and v == v]
        n = sum(x for _, x in met)
        want[s, r, c] = sum(v * x for v, x in met) / n if n > 1e-6 else nan
    coarse = spark.createDataFrame(cells, "scene_id string, row int, col int, h int, w int, value double")
    made = resampling.bilinear(spark.createDataFrame(places + extra, "scene_id string, row int, col int"), coarse, 9, 7)
    got = made.collect()
    assert len(got) == len(want) and {(r.scene_id, r.row, r.col): r.value for r in got} == pytest.approx(want, nan_ok=True)

    part = spark.range(640).selectExpr("id AS p_partkey", "CAST(id AS DOUBLE) AS p_retailprice")
    part.write.parquet(str(tmp_path / "part.parquet"))
    for query in (catalog.gap_safe_resampling, catalog.nearest_resampling, catalog.corner_nearest_resampling):
        df = query(spark, str(tmp_path))
        assert df.count() == 4000 and df.rdd.getNumPartitions() == 4


def grid_of(spark, f, lines, samples, scene="s"):
    return spark.createDataFrame([(scene, float(r), float(c), *map(float, f(r, c))) for r in lines for c in samples], "scene_id string, line double, sample double, x double, y double")


def test_inverse_of_quads_that_are_no_parallelograms(spark):
    f = lambda r, c: (2 * c + 0.3 * r + 0.004 * r * c, -1.5 * r + 0.2 * c - 0.003 * r * c)
    q = warp.quads(grid_of(spark, f, (0, 50, 120), (0, 40, 100)))
    assert q.count() == 4
    rng = np.random.default_rng(3)
    places = [(float(r), float(c)) for r, c in zip(rng.uniform(0, 120, 200), rng.uniform(0, 100, 200))]
    rows = spark.createDataFrame([(r, c, *f(r, c)) for r, c in places], "r double, c double, at_x double, at_y double")
    # cells of the control grid are themselves bilinear pieces of f
    got = warp.inverse(q.join(F.broadcast(rows)), "at_x", "at_y").where("r BETWEEN line0 AND line1 AND c BETWEEN sample0 AND sample1").collect()
    assert len(got) == len(places)
    assert max(max(abs(g.line - g.r), abs(g.sample - g.c)) for g in got) < 1e-6


def test_warp_is_the_nearest_pixel_once_a_cell(spark):
    f = lambda r, c: (10.0 * c, 10.0 * r)
    points = grid_of(spark, f, (0, 4, 8), (0, 4, 8)).unionAll(grid_of(spark, f, (0,), (0, 4), "one line"))
    px = spark.createDataFrame([("s", r, c, r * 100 + c) for r in range(8) for c in range(8)], "scene_id string, row int, col int, v int")
    got = {(r.i, r.j): (r.row, r.col, r.v) for r in warp.warped(px, points, ["v"], 5.0).collect()}
    want = {}
    for i in range(16):
        for j in range(16):
            row, col = int((i + 0.5) / 2 + 0.5), int((j + 0.5) / 2 + 0.5)
            if row < 8 and col < 8:
                want[i, j] = (row, col, row * 100 + col)
    assert got == want
    # middles on edges that quads share are one cell each
    assert warp.targets(warp.quads(points), 80 / 3).groupBy("scene_id", "i", "j").count().where("count > 1").count() == 0
    assert warp.warped(px, points.where("false"), ["v"], 5.0).count() == 0


def test_a_quad_with_a_missing_corner_is_left_out(spark):
    points = grid_of(spark, lambda r, c: (c, r), (0, 1, 2), (0, 1)).where("NOT (line = 2 AND sample = 1)")
    assert [(r.line0, r.line1) for r in warp.quads(points).collect()] == [(0.0, 1.0)]


def test_running_moments_equal_those_of_the_whole(spark, tmp_path):
    rng = np.random.default_rng(5)
    held = {(f"s{k}", v): 1e6 + rng.normal(k, 1 + k, 3 + 40 * (k % 3)) for k in range(12) for v in ("hh", "hv")}
    parts = [(s, v, len(x), float(x.mean()), float(((x - x.mean()) ** 2).sum())) for (s, v), x in held.items()]
    odd = [("empty", "hh", 0, None, None), (None, "hh", 3, 1.0, 1.0), ("s1", None, 3, 1.0, 1.0)]

    def arrive(rows):
        spark.createDataFrame(rows, running.PARTS).repartition(3).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(running.PARTS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        running.write_running(stream, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
        return {r.variable: r for r in running.newest(spark.read.parquet(str(tmp_path / "out"))).collect()}

    arrive(parts[:10] + odd)
    got = arrive(parts[5:] + odd)  # some of them for the second time
    for v in ("hh", "hv"):
        every = np.concatenate([x for (_, name), x in held.items() if name == v])
        assert got[v].n == len(every)
        assert got[v].mean == pytest.approx(every.mean(), abs=1e-6) and got[v].m2 == pytest.approx(every.var() * len(every), rel=1e-9)
    assert set(got) == {"hh", "hv"}
    again = arrive(parts)
    assert again == got


class Answers(http.server.BaseHTTPRequestHandler):
    asked: dict = {}

    def do_GET(self):
        n = self.asked[self.path] = self.asked.get(self.path, 0) + 1
        body = b"scene" * 100_000
        if self.path == "/gone":
            return self.send_error(404)
        if self.path == "/twice" and n <= 2:
            if n == 1:
                return self.send_error(503)
            self.send_response(200)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body[: len(body) // 2])  # breaks off
            return None
        if self.path == "/never":
            return self.send_error(500)
        self.send_response(200)
        self.send_header("Content-Length", str(len(body)))
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *args):
        pass


def test_downloads(spark, tmp_path):
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Answers)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base, body = f"http://127.0.0.1:{server.server_port}", b"scene" * 100_000
    right = hashlib.sha256(body).hexdigest()
    rows = [(f"{base}/{n}", str(tmp_path / f"deep/{n}"), s) for n, s in (("ok", right), ("twice", right), ("gone", None), ("never", None), ("wrong", "0" * 64))]
    rows += [(None, str(tmp_path / "none"), None), (f"{base}/ok", None, None)]
    df = spark.createDataFrame(rows, "url string, target string, sha256 string")
    try:
        got = {(r.url or "").rsplit("/", 1)[-1] if r.target else "no target": r for r in downloads.fetched(df, spread=3, wait=0.01).collect()}
        assert (got["ok"].bytes, got["ok"].sha256, got["ok"].tries, got["ok"].error) == (len(body), right, 1, None)
        assert (got["twice"].tries, got["twice"].error, Answers.asked["/twice"]) == (3, None, 3)
        assert got["gone"].tries == 1 and "404" in got["gone"].error
        assert got["never"].tries == downloads.TRIES and got["wrong"].tries == downloads.TRIES and "sha256" in got["wrong"].error
        assert got[""].error == got["no target"].error == "no url or no target"
        assert sorted(p.name for p in (tmp_path / "deep").iterdir()) == ["ok", "twice"]
        assert (tmp_path / "deep/twice").read_bytes() == body
        before = Answers.asked["/ok"]
        again = downloads.fetched(df.where("url LIKE '%ok' AND target IS NOT NULL").drop("sha256")).collect()
        assert [(r.tries, r.sha256) for r in again] == [(0, right)] and Answers.asked["/ok"] == before
    finally:
        server.shutdown()


def test_build_on_arrival(spark, tmp_path):
    for name in (NAME, "S1B_20190101T000000_x"):
        save(tmp_path / "in", name)
        arrivals.build_on_arrival(spark, str(tmp_path / "in"), str(tmp_path / "out"), "train", str(tmp_path / "ck"), chip=8).awaitTermination()
    chips = spark.read.parquet(str(tmp_path / "out/chips"))
    assert {(r.scene_id, r["count"]) for r in chips.groupBy("scene_id").count().collect()} == {(NAME, 4), ("S1B_20190101T000000_x", 4)}

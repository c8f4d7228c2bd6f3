from pyspark.sql import functions as F

from floeframe.operators import inference
from floeframe.sources import metadata


def rows(spark):
    n = 60
    base = {c: 0.0 for c in inference.SCALARS}
    data = [base | {"hh_mean": float(i % 2), "hv_mean": float("nan"), "distance_to_land": 0.0 if i == 0 else 3.0, "valid_fraction": 0.5 if i == 1 else 1.0, "label": float(i % 2), "is_pure": i % 3 == 0, "split": "train" if i < 40 else "test", "i": i} for i in range(n)]
    return spark.createDataFrame(data)


def test_forest_and_nodata(spark):
    p = rows(spark)
    train = inference.readable(p, "train")
    assert train.count() == 39 and inference.readable(p, "train", pure_only=True).count() == 14
    got = {r.i: r.prediction for r in inference.predicted(inference.trained(train, trees=5), p).collect()}
    assert got.pop(0) == 255 and got.pop(1) == 255 and all(v == i % 2 for i, v in got.items())


def test_read_filters_reach_the_scan(spark, tmp_path):
    rows(spark).write.parquet(str(tmp_path / "p"))
    plan = inference.readable(spark.read.parquet(str(tmp_path / "p")), "test")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(split), IsNotNull(valid_fraction), EqualTo(split,test)" in plan


def test_dynamic(spark):
    df = spark.createDataFrame([(12.0, 7 * 3600.0), (5.0, 7 * 3600.0), (5.0, 13 * 3600.0)], "speed double, gap double")
    assert [r[0] for r in df.select(inference.dynamic(F.col("speed"), F.col("gap"))).collect()] == [False, True, False]


def test_metadata_upsert(tmp_path):
    path = str(tmp_path / "m.json")
    s = metadata.from_statistics({"hh": {"mean": -14.5, "std": 5.6}}, ["hh"], 40.0, [5.4])
    assert metadata.upsert(path, "s1", s) and not metadata.upsert(path, "s1", s) and metadata.load(path) == {"s1": s}

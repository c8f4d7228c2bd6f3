"""Tables by scene, statistics and logs: reading and writing."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_by_scene(df: DataFrame, path: str, rows_a_file: int = 51_200) -> None:
    """Parquet under scene_id=...; scenes that df holds are replaced, others stay; no rows, no file."""
    writer = df.write.partitionBy("scene_id").option("maxRecordsPerFile", rows_a_file)
    writer.option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def read_by_scene(spark: SparkSession, path: str, contract: list[str], scene: str | None = None) -> DataFrame:
    """The table in the contract's order, which partitioned writing loses; a scene prunes to its folder."""
    df = spark.read.parquet(path)
    df = df if scene is None else df.where(F.col("scene_id") == scene)
    return df.select(*(F.col(f"`{c}`") for c in [*contract, *(c for c in df.columns if c not in contract)]))


def scenes_in(spark: SparkSession, path: str) -> DataFrame:
    """(scene_id, files)"""
    return spark.read.parquet(path).groupBy("scene_id").agg(F.sort_array(F.collect_set(F.input_file_name())).alias("files"))


def write_statistics(finished: DataFrame, path: str) -> None:
    """One JSON object {variable: {mean, std, n_pixels}} as a text file; a row a variable, so few."""
    rows = {r["variable"]: {"mean": r["mean"], "std": r["std"], "n_pixels": r["n_pixels"]} for r in finished.orderBy("variable").collect()}
    finished.sparkSession.createDataFrame([(json.dumps(rows),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_statistics(spark: SparkSession, path: str) -> DataFrame:
    """(variable, mean, std, n_pixels) of such an object."""
    whole = spark.read.text(path, wholetext=True)
    entry = F.from_json("value", "map<string, struct<mean: double, std: double, n_pixels: bigint>>")
    return whole.select(F.explode(entry).alias("variable", "s")).select("variable", "s.*")


def band_means(statistics: DataFrame, bands: list[str]) -> DataFrame:
    """(variable, mean) of the bands asked for; those without statistics are left out."""
    return statistics.where(F.col("variable").isin(bands)).select("variable", "mean")


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("header", True).csv(path)


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def paged(fetch: Callable[[int, int], list], size: int = 100) -> Iterator:
    """All entries of a catalogue that answers (page, size) with a list, until a short page."""
    page = 0
    while True:
        got = fetch(page, size)
        yield from got
        if len(got) < size:
            return
        page += 1


def absent(wanted: DataFrame, present: DataFrame, key: str = "path") -> DataFrame:
    """What is still to be copied."""
    return wanted.join(present.select(key).distinct(), key, "left_anti")


def zip_members(spark: SparkSession, root: str) -> DataFrame:
    """(path, member, content) of every file in every zip archive below root."""
    import io
    import zipfile

    def unpack(batches):
        import pandas as pd

        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as held:
                    for info in held.infolist():
                        if not info.is_dir():
                            yield pd.DataFrame({"path": [path], "member": [info.filename], "content": [held.read(info)]})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", True).load(root)
    return files.select("path", "content").mapInPandas(unpack, "path string, member string, content binary")


def removed(spark: SparkSession, path: str) -> None:
    """Delete a table of ours, whichever file system holds it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share; a session on this machine alone may do without one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"{shared or tempfile.mkdtemp(prefix='floeframe-')}/floeframe/{name}-{uuid.uuid4().hex}"

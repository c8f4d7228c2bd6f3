"""Helpers that all training-data operators share: table access, shared storage, Arrow mapping."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. Where none is named: one of our own if all runs on this machine, else an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="floeframe-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named


#: Paths made in the innermost `scratch` block.
_made: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("made", default=None)


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/floeframe/{name}-{uuid.uuid4().hex}"
    if (made := _made.get()) is not None:
        made.append(path)
    return path


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Removes at its end what was written to new paths within: what is read later must have been written elsewhere."""
    paths: list[str] = []
    outer = _made.set(paths)
    try:
        yield
    finally:
        _made.reset(outer)
        for path in paths:
            removed(spark, path)


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Cut the lineage: write df to the shared folder and read it back (survives lost executors)."""
    spark = df.sparkSession
    path = path or new_path(spark, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a table of ours from the shared folder, whichever file system holds it."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def arrow_map(df: DataFrame, columns: Callable[[pa.RecordBatch], list], schema: StructType) -> DataFrame:
    """mapInArrow where `columns` gives one list or Arrow array for each field of schema, batch by batch."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = columns(batch)
            yield pa.RecordBatch.from_arrays(
                [x if isinstance(x, pa.Array) else pa.array(x, type=f.type) for x, f in zip(made, arrow)], schema=arrow
            )

    return df.mapInArrow(released(run), schema)


def released(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run, and at its end Arrow's freed memory goes back: else idle workers keep what their largest task needed."""

    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return wrapped


def ids_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just the id and the text, a null text as the empty one; other columns and their names play no part."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return df.select(F.col(id_col).cast("long").alias(id_col), text.alias(text_col))


class Scratch:
    """Tables of one job in the shared folder: written like `written`, removed together when none is read any more."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path, self.made = spark, new_path(spark, name), 0

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        self.made += 1
        return written(df, name, f"{self.path}/{self.made}-{name}")

    def drop(self) -> None:
        removed(self.spark, self.path)

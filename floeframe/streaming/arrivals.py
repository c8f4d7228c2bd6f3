"""The build, triggered by scenes as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from floeframe.plans import build


def on_arrival(spark: SparkSession, root: str, checkpoint: str, handle: Callable[[DataFrame, int], None], pattern: str = "*.npz") -> StreamingQuery:
    """handle(new files, batch) for the files that came below root since the last call; ends when all are handled.

    Handling may be repeated after a failure, so it has to replace what it wrote before, as write_by_scene does.
    """
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(root)
    return files.select("path", "length").writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def build_on_arrival(spark: SparkSession, root: str, out: str, split: str, checkpoint: str, pattern: str = "*.{nc,npz}", **options) -> StreamingQuery:
    """The feature-table build of scenes that came below root since the last call; options are those of `build.build`.

    The build itself knows which chip rows are done, so a batch that is repeated after a failure goes on where it
    stopped. Scenes must be put below root whole, as a renamed file is.
    """
    handle = lambda files, batch: build.build(spark, root, out, split, pattern=pattern, **options)
    return on_arrival(spark, root, checkpoint, handle, pattern)

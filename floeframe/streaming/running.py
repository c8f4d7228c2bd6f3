"""Moments that grow with what arrives."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Stored parts, as `moments.scene_moments` gives them, and what is kept of them.
PARTS = "scene_id string, variable string, n bigint, mean double, m2 double"
MERGED = "variable string, scenes bigint, n bigint, mean double, m2 double"
STATE = "scenes bigint, n bigint, mean double, m2 double"


def _merge(a: tuple, b: tuple) -> tuple:
    """(scenes, n, mean, m2) of two sets of values together (Chan, Golub and LeVeque 1979)."""
    n = a[1] + b[1]
    if not n:
        return (a[0] + b[0], 0, 0.0, 0.0)
    gap = b[2] - a[2]
    return (a[0] + b[0], n, a[2] + gap * b[1] / n, a[3] + b[3] + gap * gap * a[1] * b[1] / n)


def running_moments(parts: DataFrame) -> DataFrame:
    """MERGED of each variable that a batch of a stream of PARTS changes: (variable, scenes, n, mean, m2) so far.

    A scene's part counts once for each variable, however often it comes; the first counts. Parts without values change
    nothing but the number of scenes; parts without a scene or variable are left out. The state is four numbers a
    variable, and the scenes that were seen; only parts are shuffled, a row a scene and variable. A batch's parts are
    merged in order of scene within each piece that Arrow hands over.
    """

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = tuple(state.get) if state.exists else (0, 0, 0.0, 0.0)
        for frame in frames:
            for part in frame.sort_values("scene_id").itertuples(index=False):
                n = 0 if pd.isna(part.n) else int(part.n)
                held = _merge(held, (1, n, float(part.mean), float(part.m2)) if n else (1, 0, 0.0, 0.0))
        state.update(held)
        yield pd.DataFrame([(key[0], *held)], columns=["variable", "scenes", "n", "mean", "m2"])

    once = parts.select("scene_id", "variable", "n", "mean", "m2").dropna(subset=["scene_id", "variable"])
    once = once.dropDuplicates(["scene_id", "variable"])
    return once.groupBy("variable").applyInPandasWithState(run, MERGED, STATE, "append", GroupStateTimeout.NoTimeout)


def write_running(parts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """`running_moments` of what came since the last call, appended to a table at path; ends when all is merged.

    The newest row of a variable is the one of most scenes: see `newest`.
    """
    made = running_moments(parts).writeStream.format("parquet").outputMode("append").option("path", path)
    return made.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def newest(written: DataFrame) -> DataFrame:
    """(variable, n, mean, m2) of the last state of each variable."""
    from pyspark.sql import functions as F

    last = written.groupBy("variable").agg(F.max_by(F.struct("n", "mean", "m2"), "scenes").alias("at"))
    return last.select("variable", "at.*")

"""Moments of variables by scene, and their merge over a corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unpivoted(wide: DataFrame, variables: list[str], key: str = "scene_id") -> DataFrame:
    return wide.select(key, *(F.col(v).cast("double").alias(v) for v in variables)).unpivot(key, variables, "variable", "value")


def scene_moments(values: DataFrame, keep=None, key: str = "scene_id") -> DataFrame:
    """(key, variable, n, mean, m2, std, min, max) of rows (key, variable, value); keep: which values count."""
    if keep is not None:
        values = values.where(keep(F.col("value")))
    x = F.col("value")
    return values.groupBy(key, "variable").agg(F.count(x).alias("n"), F.avg(x).alias("mean"), (F.var_pop(x) * F.count(x)).alias("m2"), F.stddev_pop(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"))


def merged(parts: DataFrame) -> DataFrame:
    """(variable, n, mean, m2) of stored parts (variable, n, mean, m2): squares within, and of the parts' deviations.

    Deviations are taken from the merged mean, so nothing cancels; parts are a row a scene and variable.
    """
    held = parts.where("n > 0").select("variable", "n", "mean", "m2")
    n, mean = F.col("n"), F.col("mean")
    total = held.groupBy("variable").agg(F.sum(n).alias("all_n"), (F.sum(n * mean) / F.sum(n)).alias("all_mean"))
    squares = F.col("m2") + n * (mean - F.col("all_mean")) * (mean - F.col("all_mean"))
    sums = held.join(total, "variable").groupBy("variable", "all_n", "all_mean").agg(F.sum(squares).alias("m2"))
    return sums.select("variable", F.col("all_n").alias("n"), F.col("all_mean").alias("mean"), "m2")


def finished(parts: DataFrame, digits: int = 6) -> DataFrame:
    """(variable, mean, std, n_pixels), rounded."""
    m2 = F.greatest(F.col("m2"), F.lit(0.0))
    return parts.select("variable", F.round("mean", digits).alias("mean"), F.round(F.sqrt(m2 / F.col("n")), digits).alias("std"), F.col("n").alias("n_pixels"))

"""Scores of predicted charts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Weights of the charts in the combined score (fixed values).
WEIGHTS = {"sic": 2, "sod": 2, "floe": 1}


def scored(pairs: DataFrame, mask: int = 255) -> DataFrame:
    return pairs.where((F.col("truth") != mask) & F.col("predicted").isNotNull())


def r_squared(pairs: DataFrame, by: list[str] = ()) -> DataFrame:
    """(by..., r2): one less the squared errors over the squared deviations."""
    y, p = F.col("truth").cast("double"), F.col("predicted").cast("double")
    return pairs.groupBy(*by).agg((1 - F.try_divide(F.sum((y - p) * (y - p)), F.var_pop(y) * F.count(y))).alias("r2"))


def weighted_f1(pairs: DataFrame) -> DataFrame:
    """(f1): each true class's F1 weighted with its support, from the table of confusions."""
    cells = pairs.groupBy("truth", "predicted").agg(F.count("*").alias("n"))
    truth = cells.groupBy(F.col("truth").alias("class")).agg(F.sum("n").alias("support"), F.sum(F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0)).alias("hits"))
    said = cells.groupBy(F.col("predicted").alias("class")).agg(F.sum("n").alias("said"))
    each = truth.join(said, "class", "left")
    f1 = 2.0 * F.col("hits") / (F.col("support") + F.coalesce("said", F.lit(0)))
    return each.agg((F.sum(f1 * F.col("support")) / F.sum("support")).alias("f1"))


def combined(scores: dict[str, float]) -> float:
    """Weighted mean of the charts' scores, in percent."""
    return round(sum(round(100 * scores[k], 3) * w for k, w in WEIGHTS.items()) / sum(WEIGHTS.values()), 3)


def combined_score(scores: dict[str, Column]) -> Column:
    """`combined` over columns: one score a row."""
    return F.round(sum((F.round(x * 100, 3) * WEIGHTS[k] for k, x in scores.items()), F.lit(0.0)) / sum(WEIGHTS.values()), 3)


def ordinal_penalty(pairs: DataFrame, by: list[str] = ()) -> DataFrame:
    """Mean distance in classes: the choice made where weights are left open."""
    return pairs.groupBy(*by).agg(F.avg(F.abs(F.col("truth") - F.col("predicted"))).alias("penalty"))

"""Reading the patch table for training and prediction, and what becomes of predictions."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floeframe.schema import MICROWAVE, RENAMED, WEATHER

SCALARS = ["hh_mean", "hv_mean", "hh_std", "hv_std", "hv_hh_ratio", *RENAMED.values(), *WEATHER, "distance_to_land", "ia_mean"]


def readable(patches: DataFrame, split: str, least_valid: float = 0.8, pure_only: bool = False) -> DataFrame:
    """Rows of a split that are valid enough; plain comparisons, so they reach the Parquet scan."""
    rows = patches.where((F.col("split") == split) & (F.col("valid_fraction") >= least_valid))
    return rows.where("is_pure") if pure_only else rows


def features(patches: DataFrame, token: str | None = None) -> DataFrame:
    """With `features`: the SCALARS, missing ones as 0, and the token's values if one is named."""
    scalars = F.array(*(F.coalesce(F.when(~F.isnan(F.col(f"`{c}`").cast("double")), F.col(f"`{c}`").cast("double")), F.lit(0.0)) for c in SCALARS))
    whole = scalars if token is None else F.concat(scalars, F.col(token).cast("array<double>"))
    return patches.withColumn("features", array_to_vector(whole))


def trained(patches: DataFrame, trees: int = 50, seed: int = 0, token: str | None = None) -> RandomForestClassificationModel:
    """A forest on the labelled rows."""
    rows = features(patches.where("label IS NOT NULL AND NOT isnan(label)"), token)
    return RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=trees, seed=seed).fit(rows)


def predicted(model, patches: DataFrame, least_valid: float = 0.8, nodata: float = 255.0, token: str | None = None) -> DataFrame:
    """With `prediction`: nodata where a patch is not valid enough or its middle is land."""
    made = model.transform(features(patches, token)).drop("rawPrediction", "probability", "features")
    ok = F.coalesce((F.col("valid_fraction") >= least_valid) & (F.col("distance_to_land") != 0), F.lit(False))
    return made.withColumn("prediction", F.when(ok, F.col("prediction")).otherwise(nodata))


def dynamic(speed: Column, gap_s: Column, fast: float = 10.0, still_hours: float = 12.0, moving_hours: float = 6.0) -> Column:
    """Whether a chart is near enough in time for how fast the ice may move: fewer hours where the wind is strong."""
    return gap_s <= F.when(speed >= fast, moving_hours * 3600).otherwise(still_hours * 3600)

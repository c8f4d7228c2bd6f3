"""Which pixels each polarisation misses: counts by scene, corpus shares, worst scenes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floeframe.functions.masks import LAND, present

COUNTS = ["n_not_land_pixels", "primary_valid_pixels", "secondary_valid_pixels", "combined_valid_pixels", "primary_only_pixels", "secondary_only_pixels"]


def scene_counts(pixels: DataFrame) -> DataFrame:
    """COUNTS of each scene that has a pixel off land."""
    sea = F.coalesce(F.col("distance") != LAND, F.lit(False))
    p, s = present(F.col("hh")), present(F.col("hv"))
    rules = (sea, sea & p, sea & s, sea & p & s, sea & p & ~s, sea & s & ~p)
    made = pixels.groupBy("scene_id").agg(*(F.count_if(rule).alias(name) for rule, name in zip(rules, COUNTS)))
    return made.where("n_not_land_pixels > 0")


def native_counts(coarse: DataFrame, bands: list[str], name: str) -> DataFrame:
    """(scene_id, n_<name>_pixels, <name>_valid_pixels) of coarse rows (scene_id, band, value)."""
    rows = coarse.where(F.col("band").isin(bands))
    return rows.groupBy("scene_id").agg(F.count("*").alias(f"n_{name}_pixels"), F.count_if(present(F.col("value"))).alias(f"{name}_valid_pixels"))


def corpus_shares(counts: DataFrame) -> DataFrame:
    """Sums of all counts, and the pixel-weighted shares of the valid ones."""
    sums = counts.agg(*(F.sum(c).alias(c) for c in COUNTS))
    base = F.col(COUNTS[0])
    return sums.select("*", *(F.try_divide(F.col(f"{x}_valid_pixels"), base).alias(f"{x}_fraction") for x in ("primary", "secondary", "combined")))


def worst(counts: DataFrame, n: int = 10) -> DataFrame:
    """The n scenes with the largest share of one-sided pixels; ties by scene."""
    share = F.try_divide(F.col("primary_only_pixels") + F.col("secondary_only_pixels"), F.col("n_not_land_pixels"))
    return counts.select("scene_id", share.alias("mismatch_fraction")).orderBy(F.desc("mismatch_fraction"), "scene_id").limit(n)

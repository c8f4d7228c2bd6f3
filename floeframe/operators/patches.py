"""Per-patch statistics and labels.

Over pixels, as one aggregation by patch whose partial sums are combined before they are shuffled. `array_features`
has the same for rows that hold a patch's pixels as arrays, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floeframe.functions import tiling
from floeframe.functions.masks import nan_if_null, null_if_nan, present
from floeframe.schema import CLASSES, FRACTIONS, GRID, PATCH, PIXELS

KEY = ["scene_id", "chip_id", "patch_i", "patch_j"]
#: The same in whole numbers: cheaper to group by; the chip's id is written once a patch.
PLACES = ["scene_id", "row0", "col0", "patch_i", "patch_j"]


def _by_patch(pixels: DataFrame, key: list[str] | None, *aggregates: Column) -> DataFrame:
    """One aggregation by patch. Without a key: by KEY where pixels have chip ids, else by PLACES."""
    if key is not None or "chip_id" in pixels.columns:
        return pixels.groupBy(*(key or KEY)).agg(*aggregates)
    made = pixels.groupBy(*PLACES).agg(*aggregates)
    chip = tiling.chip_id(F.col("scene_id"), F.col("row0"), F.col("col0")).alias("chip_id")
    return made.select("scene_id", chip, "patch_i", "patch_j", *(c for c in made.columns if c not in PLACES))


def fraction(count: Column, n: Column) -> Column:
    """A class's share as a 32-bit float, null where nothing is labelled: the label depends on this rounding."""
    return F.when(n > 0, (count / n).cast("float"))


def expected_class(fractions: list[Column]) -> Column:
    """Floor of the expected class, of the rounded shares, in double arithmetic; NaN where nothing is labelled."""
    total = sum((f.cast("double") * k for k, f in enumerate(fractions)), F.lit(0.0))
    return nan_if_null(F.floor(total).cast("double"))


def with_labels(counts: DataFrame) -> DataFrame:
    """Columns n and count0..count10 turned into fractions, valid_class_fraction, label and is_pure."""
    made = counts.withColumns({name: fraction(F.col(f"count{k}"), F.col("n")) for k, name in enumerate(FRACTIONS)})
    shares = [F.col(name) for name in FRACTIONS]
    rest = {
        "valid_class_fraction": F.col("n") / float(PIXELS),
        "label": expected_class(shares),
        "is_pure": F.coalesce(F.greatest(*shares) == 1.0, F.lit(False)),
    }
    return made.withColumns(rest).drop("n", *(f"count{k}" for k in range(CLASSES)))


def _label_counts(tenths: str) -> list[Column]:
    value = null_if_nan(F.col(tenths).cast("double"))
    klass = F.rint(value)
    return [F.count(value).alias("n"), *(F.count(F.when(klass == k, 1)).alias(f"count{k}") for k in range(CLASSES))]


def _radar_means() -> list[Column]:
    ok, hh, hv = F.col("valid"), F.col("hh"), F.col("hv")
    of = lambda f, x: nan_if_null(f(F.when(ok, x.cast("double"))))
    return [
        of(F.avg, hh).alias("hh_mean"),
        of(F.avg, hv).alias("hv_mean"),
        of(F.stddev_pop, hh).alias("hh_std"),
        of(F.stddev_pop, hv).alias("hv_std"),
        of(F.avg, hv - hh).alias("hv_hh_ratio"),
        (F.count_if(ok) / float(PIXELS)).alias("valid_fraction"),
    ]


def _plain_means(bands: list[str]) -> list[Column]:
    return [F.avg(nan_if_null(F.col(b).cast("double"))).alias(b) for b in bands]


def _centre_distance() -> Column:
    row, col = F.col("row") - F.col("row0"), F.col("col") - F.col("col0")
    here = (row % PATCH == PATCH // 2) & (col % PATCH == PATCH // 2)
    return F.max(F.when(here, F.col("distance"))).alias("distance_to_land")


def labels(pixels: DataFrame, key: list[str] | None = None, tenths: str = "ct") -> DataFrame:
    """Label columns of each patch of pixels; tenths: null or NaN where unlabelled."""
    return with_labels(_by_patch(pixels, key, *_label_counts(tenths)))


def radar(pixels: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Mean and population deviation of the valid pixels' polarisations, their mean difference, valid_fraction."""
    return _by_patch(pixels, key, *_radar_means())


def means(pixels: DataFrame, bands: list[str], key: list[str] | None = None) -> DataFrame:
    """Plain means over all of a patch's pixels: one that is missing makes the mean NaN."""
    return _by_patch(pixels, key, *_plain_means(bands))


def centre_distance(pixels: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Distance to land at the pixel just below and right of a patch's middle."""
    return _by_patch(pixels, key, _centre_distance())


def features(pixels: DataFrame, bands: list[str], key: list[str] | None = None, tenths: str = "ct") -> DataFrame:
    """All of labels, radar, means and centre_distance from one aggregation: pixels are shuffled once."""
    every = [*_label_counts(tenths), *_radar_means(), *_plain_means(bands), _centre_distance()]
    return with_labels(_by_patch(pixels, key, *every))


def chip_flags(pixels: DataFrame, height: Column, width: Column) -> DataFrame:
    """(scene_id, row0, col0, any_valid, any_label) of each chip of pixels (scene_id, row, col, valid, ct).

    Pixels that lie in the same chips are put together first, so what goes out to each chip is a few rows a scene.
    """
    (r, r_last), (c, c_last) = tiling.covering(F.col("row"), height), tiling.covering(F.col("col"), width)
    over = [r.alias("r"), r_last.alias("r_last"), c.alias("c"), c_last.alias("c_last")]
    alike = pixels.groupBy("scene_id", *over).agg(
        F.bool_or("valid").alias("any_valid"), F.bool_or(present(F.col("ct").cast("double"))).alias("any_label")
    )
    each = alike.withColumn("row0", F.explode(F.array_compact(F.array("r", "r_last"))))
    each = each.withColumn("col0", F.explode(F.array_compact(F.array("c", "c_last"))))
    flags = [F.bool_or(x).alias(x) for x in ("any_valid", "any_label")]
    return each.groupBy("scene_id", "row0", "col0").agg(*flags)


def kept_chips(flags: DataFrame) -> DataFrame:
    """(scene_id, chip_id) of chip_flags with a valid pixel and a labelled one."""
    chip = tiling.chip_id(F.col("scene_id"), F.col("row0"), F.col("col0")).alias("chip_id")
    return flags.where("any_valid and any_label").select("scene_id", chip)


def skipped_chips(flags: DataFrame) -> DataFrame:
    """(scene_id, no_valid, no_label) of chip_flags: chips left out, the first reason counting."""
    none, no_label = ~F.col("any_valid"), F.col("any_valid") & ~F.col("any_label")
    return flags.groupBy("scene_id").agg(F.count_if(none).alias("no_valid"), F.count_if(no_label).alias("no_label"))


def patches_of(chips: DataFrame, tokens: str) -> DataFrame:
    """One row a patch from a chip's row-major token list: patch_i, patch_j and the token. No shuffle."""
    each = chips.select("*", F.posexplode(tokens).alias("__at", "patch_token"))
    return each.withColumns({"patch_i": F.floor(F.col("__at") / GRID).cast("int"), "patch_j": F.col("__at") % GRID}).drop("__at", tokens)


def assembled(*parts: DataFrame) -> DataFrame:
    """Parts of the patch table joined on KEY, each one row a patch. Parts that don't hold the same patches are an
    error, not fewer rows."""
    whole = parts[0]
    for part in parts[1:]:
        both = whole.withColumn("__left", F.lit(True)).join(part.withColumn("__right", F.lit(True)), KEY, "full")
        same = F.col("__left").isNotNull() & F.col("__right").isNotNull()
        fits = F.when(same, F.lit(True)).otherwise(F.raise_error(F.concat_ws(" ", F.lit("only one part holds patch"), *KEY)).cast("boolean"))
        whole = both.where(fits).drop("__left", "__right")
    return whole

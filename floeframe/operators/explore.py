"""Exploratory statistics: correlations, fits, distributions, histograms, block means."""

from __future__ import annotations

from functools import reduce
from itertools import combinations_with_replacement
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floeframe.functions.masks import null_if_nan, present


def correlations(rows: DataFrame, features: list[str], by: list[str] = (), least: int = 0) -> DataFrame:
    """(by..., x, y, r) of each pair of features over the rows that have them all; one aggregation.

    least: groups with fewer rows are left out, rows without a feature counted too.
    """
    has_all = " AND ".join(f"`{f}` IS NOT NULL AND NOT isnan(CAST(`{f}` AS DOUBLE))" for f in features)
    pairs = list(combinations_with_replacement(features, 2))
    value = lambda f: F.when(F.expr(has_all), F.col(f"`{f}`").cast("double"))
    each = [F.corr(value(x), value(y)).alias(f"r{i}") for i, (x, y) in enumerate(pairs)]
    wide = rows.groupBy(*by).agg(F.count("*").alias("__n"), F.count_if(F.expr(has_all)).alias("__whole"), *each)
    wide = wide.where((F.col("__n") >= least) & (F.col("__whole") > 0))
    named = [F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(f"r{i}").alias("r")) for i, (x, y) in enumerate(pairs)]
    return wide.select(*by, F.explode(F.array(*named)).alias("c")).select(*by, "c.*")


def correlations_with(rows: DataFrame, features: list[str], target: str, by: list[str] = ()) -> DataFrame:
    """(by..., feature, r): each feature's correlation with the target, the strongest first."""
    value = lambda f: null_if_nan(F.col(f"`{f}`").cast("double"))
    each = [F.corr(value(f), value(target)).alias(f"r{i}") for i, f in enumerate(features)]
    named = [F.struct(F.lit(f).alias("feature"), F.col(f"r{i}").alias("r")) for i, f in enumerate(features)]
    made = rows.groupBy(*by).agg(*each).select(*by, F.explode(F.array(*named)).alias("c")).select(*by, "c.*")
    return made.orderBy(*by, F.desc_nulls_last(F.abs(F.col("r"))), "feature")


def fisher_mean(r: DataFrame, by: list[str], value: str = "r", most: float = 0.9999) -> DataFrame:
    """Mean correlation by way of the inverse hyperbolic tangent."""
    z = F.atanh(F.greatest(F.lit(-most), F.least(F.lit(most), F.col(value))))
    return r.groupBy(*by).agg(F.tanh(F.avg(z)).alias(value))


def line_fit(rows: DataFrame, y: str, x: str, by: list[str] = ()) -> DataFrame:
    return rows.groupBy(*by).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.corr(y, x).alias("r"))


def class_shares(rows: DataFrame, klass: str, classes: int = 11) -> DataFrame:
    """(class, n, percent) of all classes, empty ones too."""
    spine = rows.sparkSession.range(classes).select(F.col("id").alias("class"))
    counts = rows.groupBy(F.col(klass).cast("long").alias("class")).agg(F.count("*").alias("n")).where(F.col("class").between(0, classes - 1))
    joined = spine.join(counts, "class", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    # the window holds one row a class
    return joined.select("class", "n", F.try_divide(F.col("n") * 100.0, F.expr("sum(n) over ()")).alias("percent"))


def histogram(rows: DataFrame, value: str, low: float, high: float, bins: int = 100) -> DataFrame:
    """(bin, n) from 1 to bins over [low, high], the last closed; values outside are left out."""
    x = F.col(value)
    held = rows.where((x >= low) & (x <= high))
    at = F.least(F.floor((x - low) / ((high - low) / bins)) + 1, F.lit(bins))
    return held.groupBy(at.alias("bin")).agg(F.count("*").alias("n"))


#: Parts that a group's range is cut into before its percentiles are looked for.
PARTS = 4096


def percentiles(rows: DataFrame, value: str, shares: list[float], by: list[str]) -> DataFrame:
    """(by..., p<share>...): exact percentiles, interpolated between the two values around.

    Values are counted in PARTS equal parts of each group's range; only the parts that hold a wanted rank are looked
    into, and there equal values are one row. So no task holds a group's values, whatever their number.
    """
    x = F.col(value).cast("double")
    held = rows.where(present(x)).select(*by, x.alias("x"))
    box = held.groupBy(*by).agg(F.min("x").alias("low"), F.max("x").alias("high"), F.count("*").alias("n"))
    part = F.least(F.floor((F.col("x") - F.col("low")) / (F.col("high") - F.col("low")) * PARTS), F.lit(PARTS - 1))
    placed = held.join(box, by).withColumn("part", F.when(F.col("high") > F.col("low"), part).otherwise(0).cast("int"))
    counts = placed.groupBy(*by, "part").agg(F.count("*").alias("c"), F.first("n").alias("n"))
    upto = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rank = [F.floor(F.lit(s) * (F.col("n") - 1)) + up for s in shares for up in (0, 1)]
    counts = counts.withColumn("before", F.sum("c").over(upto) - F.col("c"))
    wanted = [(r >= F.col("before")) & (r < F.col("before") + F.col("c")) for r in rank]
    looked = counts.where(reduce(or_, wanted)).select(*by, "part", "before")
    inside = placed.join(looked, [*by, "part"]).groupBy(*by, "part", "before", "x").agg(F.count("*").alias("c"), F.first("n").alias("n"))
    along = Window.partitionBy(*by, "part").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = inside.withColumn("first", F.col("before") + F.sum("c").over(along) - F.col("c"))
    has = lambda r: (r >= F.col("first")) & (r < F.col("first") + F.col("c"))
    made = first.groupBy(*by).agg(F.first("n").alias("n"), *(F.max(F.when(has(r), F.col("x"))).alias(f"v{i}") for i, r in enumerate(rank)))

    def between(i: int, s: float) -> Column:
        place = F.lit(s) * (F.col("n") - 1)
        low, high = F.col(f"v{2 * i}"), F.coalesce(F.col(f"v{2 * i + 1}"), F.col(f"v{2 * i}"))
        return (low + (place - F.floor(place)) * (high - low)).alias(f"p{round(s * 100)}")

    return made.select(*by, *(between(i, s) for i, s in enumerate(shares)))


def summary(rows: DataFrame, variables: list[str], keep, digits: int = 3) -> DataFrame:
    """(variable, n, mean, std, min, max) of the values that keep lets through."""
    long = rows.select(*(F.col(v).cast("double").alias(v) for v in variables)).unpivot([], variables, "variable", "value").where(keep(F.col("value")))
    x = F.col("value")
    return long.groupBy("variable").agg(F.count(x).alias("n"), *(F.round(f(x), digits).alias(name) for f, name in ((F.avg, "mean"), (F.stddev_pop, "std"), (F.min, "min"), (F.max, "max"))))


def block_means(pixels: DataFrame, value: str, rows: int, cols: int, by: list[str] = ()) -> DataFrame:
    """Means of what is present in blocks of rows x cols pixels."""
    x = F.col(value).cast("double")
    key = [*by, F.floor(F.col("row") / rows).alias("row"), F.floor(F.col("col") / cols).alias("col")]
    return pixels.groupBy(*key).agg(F.avg(F.when(present(x), x)).alias(value))


def bounding_box(points: DataFrame, by: list[str] = ()) -> DataFrame:
    box = [f(c).alias(f"{n}_{c}") for c in ("lat", "lon") for f, n in ((F.min, "min"), (F.max, "max"))]
    return points.groupBy(*by).agg(*box, F.avg("lat").alias("mid_lat"), F.avg("lon").alias("mid_lon"))


def distinct_values(charts: DataFrame, columns: list[str]) -> DataFrame:
    """(chart, value), each once."""
    return charts.select(*(F.col(c).cast("long").alias(c) for c in columns)).unpivot([], columns, "chart", "value").distinct()


def chip_labels(patches: DataFrame, fractions: list[str], by: list[str]) -> DataFrame:
    """One label a chip: the mean expected class of its labelled patches, rounded once."""
    expected = sum((F.col(f).cast("double") * k for k, f in enumerate(fractions)), F.lit(0.0))
    return patches.groupBy(*by).agg(F.rint(F.avg(expected)).alias("label"))

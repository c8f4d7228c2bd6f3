"""Validity of pixels, as Column expressions; arrays take the same rules element by element."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LAND, CHART_MASK, POLYGON_NONE = 0, 255, 65535
#: Fill codes that the corpus statistics leave out, of every variable.
SENTINELS = (255, 2)


def present(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x)


def valid(hh: Column, hv: Column, distance: Column) -> Column:
    """Not land, and neither polarisation missing."""
    return F.coalesce((distance != LAND) & present(hh) & present(hv), F.lit(False))


def filled(x: Column, is_valid: Column, mean: Column) -> Column:
    return F.when(is_valid, x).otherwise(F.coalesce(mean, F.lit(0.0)))


def valid_array(hh: Column, hv: Column, distance: Column) -> Column:
    return F.zip_with(F.zip_with(hh, hv, lambda a, b: present(a) & present(b)), distance, lambda ok, d: ok & (d != LAND))


def filled_array(x: Column, is_valid: Column, mean: Column) -> Column:
    return F.zip_with(x, is_valid, lambda v, ok: F.when(ok, v).otherwise(F.coalesce(mean, F.lit(0.0))))


def for_statistics(x: Column) -> Column:
    return present(x) & ~x.isin(*SENTINELS)


def for_summary(x: Column) -> Column:
    return present(x) & (x != CHART_MASK)


def polygon(x: Column) -> Column:
    """Polygon number; null where either encoding of none stands."""
    return F.when(present(x.cast("double")) & (x != POLYGON_NONE), x.cast("int"))


def nan_if_null(x: Column) -> Column:
    return F.coalesce(x, F.lit(float("nan")))


def null_if_nan(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def chart_masked(x: Column) -> Column:
    return x == CHART_MASK


def stamped(x: Column) -> Column:
    """A chart value as a byte, missing ones as the mask."""
    return F.when(present(x.cast("double")), x).otherwise(F.lit(CHART_MASK)).cast("int")


def nodata_of(dtype: str) -> float | int:
    """NaN for floating types, else the largest value of the unsigned type."""
    return float("nan") if dtype.startswith("float") else (1 << int(dtype.removeprefix("uint"))) - 1

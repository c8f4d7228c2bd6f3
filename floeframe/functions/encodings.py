"""Values from file names, cyclic encodings and small transforms."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def scene_time(name: Column) -> Column:
    """First YYYYMMDDThhmmss in a file name; an error where there is none."""
    found = F.regexp_extract(name, r"(\d{8}T\d{6})", 1)
    return F.to_timestamp(F.when(found != "", found).otherwise(F.raise_error(F.concat(F.lit("no time in "), name))), "yyyyMMdd'T'HHmmss")


def time_encoding(ts: Column) -> list[Column]:
    """Sine and cosine of the ISO week in 52 and of the hour in 24, as floats."""
    week = F.weekofyear(ts) * (2 * math.pi / 52)
    hour = (F.hour(ts) + F.minute(ts) / 60.0) * (2 * math.pi / 24)
    return [f(x).cast("float") for x in (week, hour) for f in (F.sin, F.cos)]


def place_encoding(lat: Column, lon: Column) -> list[Column]:
    return [f(F.radians(x)).cast("float") for x in (lat, lon) for f in (F.sin, F.cos)]


def year_month(name: Column, first: int = 2018, last: int = 2021) -> Column:
    """yyyy-MM of the file name's date, null outside the years."""
    found = F.regexp_extract(name, r"(\d{4})(\d{2})\d{2}T\d{6}", 0)
    year = F.substring(found, 1, 4).try_cast("int")
    return F.when(year.between(first, last), F.concat_ws("-", F.substring(found, 1, 4), F.substring(found, 5, 2)))


def prepared_name(raw: Column) -> Column:
    return F.concat(F.substring(raw, 18, 15), F.lit("_"), F.substring(raw, 78, 3), F.lit("_prep.nc"))


def standardised(values: Column, mean: Column, std: Column) -> Column:
    return F.transform(values, lambda x: (x - mean) / std)


def clip_scaled(x: Column, low: Column, high: Column) -> Column:
    """0 at low, 1 at high, clipped."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide(x - low, high - low)))


def composite(hh: Column, hv: Column, limits: dict[str, tuple[float, float]]) -> dict[str, Column]:
    """The three channels of a radar composite, each scaled by its limits: both polarisations and their difference."""
    bands = {"hh": hh, "hv": hv, "hh_hv": hh - hv}
    return {name: clip_scaled(band, *map(F.lit, limits[name])) for name, band in bands.items()}


def rotated(u: Column, v: Column, heading: Column) -> tuple[Column, Column]:
    """Wind components turned by a heading in degrees: along and across it."""
    h = F.radians(heading)
    return u * F.cos(h) + v * F.sin(h), v * F.cos(h) - u * F.sin(h)


def distance_bin(km: Column, edges: list[float]) -> Column:
    """0 on land; else one more than the edges that are at or below the distance."""
    return F.when(km <= 0, 0).otherwise(1 + sum(F.when(km >= e, 1).otherwise(0) for e in edges))


def utm_zone(lon: Column) -> Column:
    return (F.floor((lon + 180) / 6) + 1).cast("int")

"""Bands, sizes and the ordered columns of the two output tables (fixed values)."""

from __future__ import annotations

CHIP, PATCH = 256, 8
GRID = CHIP // PATCH
PATCHES = GRID * GRID
PIXELS = PATCH * PATCH
CLASSES = 11
TOKEN = 1024

SAR = ["nersc_sar_primary", "nersc_sar_secondary"]
MICROWAVE = [f"btemp_{ghz}{pol}" for ghz in ("6_9", "7_3", "10_7", "18_7", "23_8", "36_5", "89_0") for pol in "hv"]
WEATHER = ["u10m_rotated", "v10m_rotated", "t2m", "skt", "tcwv", "tclw"]
ANCILLARY = ["sar_grid_incidenceangle", "distance_map"]
BANDS = SAR + MICROWAVE + WEATHER

#: Output name of each microwave band (fixed values).
RENAMED = {
    "btemp_6_9h": "btemp_6.9h",
    "btemp_6_9v": "btemp_6.9v",
    "btemp_7_3h": "btemp_7.3h",
    "btemp_7_3v": "btemp_7.3v",
    "btemp_10_7h": "btemp_10.7h",
    "btemp_10_7v": "btemp_10.7v",
    "btemp_18_7h": "btemp_18.7h",
    "btemp_18_7v": "btemp_18.7v",
    "btemp_23_8h": "btemp_23.8h",
    "btemp_23_8v": "btemp_23.8v",
    "btemp_36_5h": "btemp_36.5h",
    "btemp_36_5v": "btemp_36.5v",
    "btemp_89_0h": "btemp_89.0h",
    "btemp_89_0v": "btemp_89.0v",
}

FRACTIONS = [f"frac_sic{k}" for k in range(CLASSES)]
PATCH_TABLE = [
    "hh_mean", "hv_mean", "hh_std", "hv_std", "hv_hh_ratio", "patch_token", *RENAMED.values(), *WEATHER, "distance_to_land", "ia_mean",
    *FRACTIONS, "valid_class_fraction", "label", "is_pure", "valid_fraction", "chip_id", "scene_id", "geometry", "split",
]
CHIP_TABLE = ["class_token", "chip_id", "scene_id", "geometry", "split"]
#: Rows have no order in Spark: a patch's place in its chip is kept after the contract's columns.
PLACE = ["patch_i", "patch_j"]

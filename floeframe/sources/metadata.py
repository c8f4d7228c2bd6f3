"""Sensor metadata: a small file beside the code, read and written on the driver."""

from __future__ import annotations

import json
import os
from dataclasses import asdict, dataclass


@dataclass(frozen=True)
class Sensor:
    bands: tuple[str, ...]
    gsd: float
    mean: tuple[float, ...]
    std: tuple[float, ...]
    wavelengths: tuple[float, ...]


def load(path: str) -> dict[str, Sensor]:
    if not os.path.exists(path):
        return {}
    with open(path, encoding="utf-8") as file:
        return {name: Sensor(**{k: tuple(v) if isinstance(v, list) else v for k, v in entry.items()}) for name, entry in json.load(file).items()}


def from_statistics(statistics: dict[str, dict], bands: list[str], gsd: float, wavelengths: list[float]) -> Sensor:
    return Sensor(tuple(bands), gsd, tuple(statistics[b]["mean"] for b in bands), tuple(statistics[b]["std"] for b in bands), tuple(wavelengths))


def upsert(path: str, name: str, sensor: Sensor) -> bool:
    """Write the entry if it is new or differs; whether it was written."""
    held = load(path)
    if held.get(name) == sensor:
        return False
    with open(path, "w", encoding="utf-8") as file:
        json.dump({k: asdict(v) for k, v in (held | {name: sensor}).items()}, file, indent=1, sort_keys=True)
    return True

"""A vision transformer over chips, as a batched operator on rows of patches.

A chip's patches follow one another in their partition, as the scene source gives them and every narrow step leaves
them. The operator gathers whole chips across Arrow batches, runs as many at once as their activations fit in a number
of bytes, and gives each patch its token; the class token, which stands first in a chip's sequence, goes with the
chip's first patch. Weights are read once a worker.

A patch's pixels, standardised band by band, are embedded with a fixed encoding of their place in the chip; the class
token takes in the encodings of the chip's time and place. Blocks are attention and a two-layer perceptron, each
behind a layer norm and added to what it read.
"""

from __future__ import annotations

import functools
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, FloatType, StructField, StructType

#: Bytes of activations that a forward pass may hold.
BYTES = 256 << 20
TIME_AND_PLACE = 8


def initial(bands: int, pixels: int, width: int, blocks: int, heads: int, seed: int = 0) -> dict[str, np.ndarray]:
    """Weights by name, random: what training starts from, and the form that trained ones are kept in."""
    r = np.random.default_rng(seed)
    some = lambda *shape: (r.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)
    made = {"heads": np.array(heads), "mean": np.zeros(bands, np.float32), "std": np.ones(bands, np.float32)}
    made |= {"embed": some(bands * pixels, width), "embed_bias": np.zeros(width, np.float32), "class": some(width), "about": some(TIME_AND_PLACE, width)}
    for k in range(blocks):
        for name, (a, b) in {"qkv": (width, 3 * width), "out": (width, width), "up": (width, 4 * width), "down": (4 * width, width)}.items():
            made |= {f"{k}.{name}": some(a, b), f"{k}.{name}_bias": np.zeros(b, np.float32)}
        made |= {f"{k}.norm{i}": np.ones(width, np.float32) for i in (1, 2)} | {f"{k}.norm{i}_bias": np.zeros(width, np.float32) for i in (1, 2)}
    return made | {"norm": np.ones(width, np.float32), "norm_bias": np.zeros(width, np.float32)}


def saved(weights: dict[str, np.ndarray], path: str) -> None:
    fs, place = pyarrow.fs.FileSystem.from_uri(path)
    held = io.BytesIO()
    np.savez(held, **weights)
    with fs.open_output_stream(place) as out:
        out.write(held.getvalue())


def places(side: int, width: int) -> np.ndarray:
    """Sines and cosines of rows and columns: a quarter of the width each."""
    rates = 1.0 / 10_000 ** (np.arange(width // 4) / (width / 4))
    i, j = (x.ravel()[:, None] * rates for x in np.indices((side, side)))
    return np.concatenate([np.sin(i), np.cos(i), np.sin(j), np.cos(j)], axis=1).astype(np.float32)


def normed(x: np.ndarray, scale: np.ndarray, shift: np.ndarray) -> np.ndarray:
    apart = x - x.mean(-1, keepdims=True)
    return apart / np.sqrt((apart * apart).mean(-1, keepdims=True) + 1e-5) * scale + shift


def bent(x: np.ndarray) -> np.ndarray:
    """The sigmoid-linear unit."""
    return x / (1 + np.exp(-x))


class Encoder:
    def __init__(self, weights: dict[str, np.ndarray]):
        self.w, self.heads, self.width = weights, int(weights["heads"]), len(weights["class"])
        self.blocks = sum(name.endswith(".qkv") for name in weights)

    def bytes_a_chip(self, patches: int) -> int:
        """Of the largest activations: attention by head, and the perceptron's."""
        n = patches + 1
        return 4 * n * (self.heads * n + 8 * self.width)

    def attention(self, x: np.ndarray, k: int) -> np.ndarray:
        b, n, d = x.shape
        q, key, v = (x @ self.w[f"{k}.qkv"] + self.w[f"{k}.qkv_bias"]).reshape(b, n, 3, self.heads, d // self.heads).transpose(2, 0, 3, 1, 4)
        scores = q @ key.swapaxes(-1, -2) / np.sqrt(d // self.heads).astype(np.float32)
        scores = np.exp(scores - scores.max(-1, keepdims=True))
        mixed = (scores / scores.sum(-1, keepdims=True)) @ v
        return mixed.swapaxes(1, 2).reshape(b, n, d) @ self.w[f"{k}.out"] + self.w[f"{k}.out_bias"]

    def __call__(self, pixels: np.ndarray, about: np.ndarray) -> np.ndarray:
        """(chips, patches + 1, width) of pixels (chips, patches, bands, pixels) and encodings (chips, 8); class first."""
        w, (b, n, bands, _) = self.w, pixels.shape
        scaled = (pixels - w["mean"][:, None]) / w["std"][:, None]
        tokens = scaled.reshape(b, n, -1).astype(np.float32) @ w["embed"] + w["embed_bias"] + places(round(n**0.5), self.width)
        first = w["class"] + about.astype(np.float32) @ w["about"]
        x = np.concatenate([first[:, None], tokens], axis=1)
        for k in range(self.blocks):
            x = x + self.attention(normed(x, w[f"{k}.norm1"], w[f"{k}.norm1_bias"]), k)
            inner = bent(normed(x, w[f"{k}.norm2"], w[f"{k}.norm2_bias"]) @ w[f"{k}.up"] + w[f"{k}.up_bias"])
            x = x + inner @ w[f"{k}.down"] + w[f"{k}.down_bias"]
        return normed(x, w["norm"], w["norm_bias"])


@functools.lru_cache(maxsize=1)
def loaded(path: str) -> Encoder:
    """One a worker."""
    fs, place = pyarrow.fs.FileSystem.from_uri(path)
    with fs.open_input_file(place) as file, np.load(io.BytesIO(file.read())) as held:
        return Encoder({k: held[k] for k in held.files})


KEY = ["scene_id", "row0", "col0"]


def whole_chips(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """The rows of each chip, in the order in which they come; an error where a chip isn't there as a whole."""
    held: list[pa.RecordBatch] = []
    key, n = None, 0
    for batch in batches:
        keys = [*zip(*(batch.column(k).to_pylist() for k in KEY))]
        at = 0
        while at < len(keys):
            if n == 0:
                key = keys[at]
            end = min(at + size - n, len(keys))
            if keys[end - 1] != key or keys[at] != key:
                raise ValueError(f"the chip {key} isn't whole, or its patches don't follow one another")
            held.append(batch.slice(at, end - at))
            n, at = n + end - at, end
            if n == size:
                chip = pa.Table.from_batches(held)
                order = [i * round(size**0.5) + j for i, j in zip(chip["patch_i"].to_pylist(), chip["patch_j"].to_pylist())]
                if order != [*range(size)]:
                    raise ValueError(f"the patches of chip {key} are out of order")
                yield chip
                held, n = [], 0
    if n:
        raise ValueError(f"the chip {key} isn't whole")


def matrix(chip: pa.Table, name: str) -> np.ndarray:
    column = chip[name].combine_chunks()
    return column.flatten().to_numpy().reshape(len(column), -1)


def encoded(patches: DataFrame, weights: str, bands: list[str], size: int, limit: int = BYTES) -> DataFrame:
    """patches with patch_token and class_token (of a chip's first patch, else null); size: patches of a chip.

    Reads scene_id, row0, col0, patch_i, patch_j, the bands' arrays, time_encoding and place_encoding.
    """
    token = ArrayType(FloatType())
    schema = StructType([*patches.schema, StructField("patch_token", token), StructField("class_token", token)])
    arrow = to_arrow_schema(schema)

    def told(chips: list[pa.Table], model: Encoder) -> Iterator[pa.RecordBatch]:
        pixels = np.stack([np.stack([matrix(c, b) for b in bands], axis=1) for c in chips])
        about = np.stack([np.concatenate([matrix(c, k)[0] for k in ("time_encoding", "place_encoding")]) for c in chips])
        for chip, tokens in zip(chips, model(pixels, about)):
            width = tokens.shape[1]
            ends = np.arange(0, size * width + 1, width, dtype=np.int32)
            own = pa.ListArray.from_arrays(ends, pa.array(tokens[1:].ravel(), pa.float32()))
            first = pa.array([tokens[0]] + [None] * (size - 1), pa.list_(pa.float32()))
            (batch,) = chip.combine_chunks().to_batches()
            columns = [*batch.columns, own, first]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded(weights)
        at_once, pending = max(1, limit // model.bytes_a_chip(size)), []
        for chip in whole_chips(batches, size):
            pending.append(chip)
            if len(pending) == at_once:
                yield from told(pending, model)
                pending = []
        if pending:
            yield from told(pending, model)

    return patches.mapInArrow(run, schema)

"""Array files read by byte ranges: classic NetCDF (CDF-1, CDF-2, CDF-5) and `.npz`.

A header says where each variable lies, so some rows of a band cost these rows' bytes and no others. Values come as a
NetCDF reader gives them: what equals `_FillValue` or `missing_value` is NaN, packed values are unpacked by
`scale_factor` and `add_offset`, characters are joined to strings along their last dimension. Members of an `.npz` that
are compressed are read from their beginning, still without holding what is not asked for.
"""

from __future__ import annotations

import io
import math
import struct
import zipfile
from dataclasses import dataclass, field

import numpy as np
import pyarrow.fs

#: Types by their number in a header (fixed values of the format).
TYPES = {1: ">i1", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8", 7: ">u1", 8: ">u2", 9: ">u4", 10: ">i8", 11: ">u8"}
DIMENSIONS, VARIABLES, ATTRIBUTES = 10, 11, 12
#: Bytes of a file's begin that are read at first; a longer header is read twice as far until it is whole.
HEAD = 1 << 16


class File:
    """A file opened for ranges; `taken` counts the bytes that were read."""

    def __init__(self, path: str):
        fs, place = pyarrow.fs.FileSystem.from_uri(path)
        self.held, self.taken = fs.open_input_file(place), 0
        self.size = self.held.size()

    def read(self, offset: int, size: int) -> bytes:
        self.taken += size
        return self.held.read_at(size, offset)


@dataclass
class Variable:
    """Where a variable lies: rows of `step` bytes from `begin` on."""

    dtype: np.dtype
    shape: tuple[int, ...]
    begin: int
    step: int
    attributes: dict = field(default_factory=dict)
    member: str | None = None  # of a compressed archive


class Arrays:
    """The variables of one file."""

    def __init__(self, path: str):
        self.file = File(path)
        magic = self.file.read(0, min(4, self.file.size))
        if magic[:3] == b"CDF" and magic[3:] in (b"\x01", b"\x02", b"\x05"):
            self.variables = classic(self.file)
        elif magic[:2] == b"PK":
            self.variables = archived(self.file)
        else:
            raise ValueError(f"{path} is neither a classic NetCDF file nor an .npz")

    def __contains__(self, name: str) -> bool:
        return name in self.variables

    def shape(self, name: str) -> tuple[int, ...]:
        return self.variables[name].shape

    def raw(self, name: str, first: int, last: int) -> np.ndarray:
        """Rows first to last (exclusive) of a variable, as they are stored."""
        v = self.variables[name]
        inner = v.shape[1:]
        size = math.prod(inner) * v.dtype.itemsize
        if v.member is not None:
            with zipfile.ZipFile(Reader(self.file)) as held, held.open(v.member) as member:
                member.seek(v.begin + first * v.step)
                data = member.read((last - first) * v.step)
        elif v.step == size:
            data = self.file.read(v.begin + first * v.step, (last - first) * v.step)
        else:  # records, other variables' values between them
            data = b"".join(self.file.read(v.begin + k * v.step, size) for k in range(first, last))
        return np.frombuffer(data, dtype=v.dtype).reshape(last - first, *inner)

    def rows(self, name: str, first: int, last: int) -> np.ndarray:
        """Rows of a numeric variable, as numbers: missing ones NaN, packed ones unpacked."""
        values, held = self.raw(name, first, last), self.variables[name].attributes
        gaps = [held[k] for k in ("_FillValue", "missing_value") if k in held]
        if not gaps and not held.keys() & {"scale_factor", "add_offset"}:
            return values
        made = values.astype(np.float64)
        made = made * held.get("scale_factor", 1) + held.get("add_offset", 0)
        for gap in gaps:
            made[values == gap] = np.nan
        return made

    def whole(self, name: str) -> np.ndarray:
        shape = self.shape(name)
        if not shape:
            return self.rows(name, 0, 1).reshape(())
        return self.rows(name, 0, shape[0])

    def strings(self, name: str) -> list[str]:
        """A variable of text as strings."""
        v = self.variables[name]
        held = self.raw(name, 0, v.shape[0]) if v.shape else np.array([])
        if v.dtype != np.dtype("S1"):
            return [x.decode() if isinstance(x, bytes) else str(x) for x in held.ravel()]
        lines = held.reshape(-1, held.shape[-1]) if held.ndim > 1 else held[None]
        return [line.tobytes().decode("utf-8", "replace").rstrip("\0 ") for line in lines]


class Reader(io.RawIOBase):
    """A File as zipfile wants it."""

    def __init__(self, file: File):
        self.file, self.at = file, 0

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.at

    def seek(self, offset: int, whence: int = 0) -> int:
        self.at = offset + (0, self.at, self.file.size)[whence]
        return self.at

    def read(self, size: int = -1) -> bytes:
        left = max(self.file.size - self.at, 0)
        data = self.file.read(self.at, left if size < 0 else min(size, left))
        self.at += len(data)
        return data


def archived(file: File) -> dict[str, Variable]:
    """Variables of an `.npz`."""
    made = {}
    with zipfile.ZipFile(Reader(file)) as held:
        for info in held.infolist():
            with held.open(info) as member:
                version = np.lib.format.read_magic(member)
                reads = np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0
                shape, fortran, dtype = reads(member)
                begin = member.tell()
            if fortran and len(shape) > 1:
                raise ValueError(f"{info.filename} is stored column by column")
            step = math.prod(shape[1:]) * dtype.itemsize
            if info.compress_type == zipfile.ZIP_STORED:
                name_size, extra = struct.unpack("<HH", file.read(info.header_offset + 26, 4))
                begin, place = begin + info.header_offset + 30 + name_size + extra, None
            else:
                place = info.filename
            made[info.filename.removesuffix(".npy")] = Variable(dtype, shape, begin, step, {}, place)
    return made


class Head:
    """A header's fields, one after the other."""

    def __init__(self, data: bytes):
        self.data, self.at, self.wide = data, 4, data[3] == 5
        self.far = data[3] != 1

    def take(self, size: int) -> bytes:
        got = self.data[self.at : self.at + size]
        if len(got) < size:
            raise EOFError
        self.at += size
        return got

    def number(self, wide: bool = False) -> int:
        return int.from_bytes(self.take(8 if wide else 4))

    def count(self) -> int:
        return self.number(self.wide)

    def name(self) -> str:
        size = self.count()
        return self.take(size + -size % 4)[:size].decode()

    def listed(self, tag: int) -> int:
        """Entries of a list; an absent one has none."""
        found, entries = self.number(), self.count()
        if found not in (0, tag):
            raise ValueError("broken header")
        return entries

    def attributes(self) -> dict:
        made = {}
        for _ in range(self.listed(ATTRIBUTES)):
            name, kind, entries = self.name(), TYPES[self.number()], self.count()
            size = entries * np.dtype(kind).itemsize
            data = self.take(size + -size % 4)[:size]
            made[name] = data.decode("utf-8", "replace") if kind == "S1" else np.frombuffer(data, kind)[0] if entries else None
        return made


def classic(file: File) -> dict[str, Variable]:
    """Variables of a classic NetCDF file."""
    size = HEAD
    while True:
        try:
            return described(Head(file.read(0, min(size, file.size))), file.size)
        except EOFError:
            if size >= file.size:
                raise ValueError("the header goes beyond the file's end") from None
            size *= 2


def described(head: Head, end: int) -> dict[str, Variable]:
    records = head.count()
    sides = [(head.name(), head.count())[1] for _ in range(head.listed(DIMENSIONS))]
    head.attributes()
    found = []
    for _ in range(head.listed(VARIABLES)):
        name = head.name()
        dims = [head.count() for _ in range(head.count())]
        held, kind, size = head.attributes(), np.dtype(TYPES[head.number()]), head.count()
        found.append((name, dims, held, kind, size, head.number(head.far)))
    grows = lambda dims: bool(dims) and sides[dims[0]] == 0
    sizes = [v[4] for v in found if grows(v[1])]
    made = {}
    for name, dims, held, kind, size, begin in found:
        inner = math.prod(sides[d] for d in dims[1:]) * kind.itemsize
        step = inner
        if grows(dims):
            # a single one is not filled up to four bytes
            step = inner if len(sizes) == 1 else sum(sizes)
            if records in (2**32 - 1, 2**64 - 1):  # being written when it was closed
                records = (end - begin) // step
        shape = tuple(records if sides[d] == 0 else sides[d] for d in dims)
        made[name] = Variable(kind, shape, begin, step, held)
    return made

"""Files fetched by executors: in pieces, with tries that wait longer each time, and put in place whole or not at all."""

from __future__ import annotations

import hashlib
import time
import urllib.error
import urllib.request
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tries for a file, and seconds before the second; each wait doubles.
TRIES, WAIT = 5, 2.0
PIECE = 1 << 20
TIMEOUT = 120
FETCHED = "url string, target string, bytes bigint, sha256 string, tries int, error string"


class _Again(Exception):
    """A failure that another try may mend."""


def _fetch(url: str, store: fs.FileSystem, path: str, piece: int) -> tuple[int, str]:
    """The url's bytes written to path; their number and SHA-256."""
    try:
        with urllib.request.urlopen(url, timeout=TIMEOUT) as answer, store.open_output_stream(path) as out:
            size, total, digest = 0, answer.headers.get("Content-Length"), hashlib.sha256()
            while block := answer.read(piece):
                digest.update(block)
                out.write(block)
                size += len(block)
    except urllib.error.HTTPError as error:
        if error.code < 500 and error.code not in (408, 429):
            raise
        raise _Again(str(error)) from error
    except (urllib.error.URLError, OSError) as error:
        raise _Again(str(error)) from error
    if total is not None and size != int(total):
        raise _Again(f"{size} of {total} bytes")
    return size, digest.hexdigest()


def fetched(wanted: DataFrame, spread: int | None = None, wait: float = WAIT, piece: int = PIECE) -> DataFrame:
    """FETCHED for rows (url, target) and, if there is such a column, the expected sha256: fetches when it is run.

    Each file is written beside its target under a name of its own and moved there when it is whole, so a killed or
    repeated task leaves no part of a file at the target; a target that is there already is left alone unless a sha256
    is expected and differs (then bytes and sha256 are those of the file). Server errors, broken connections and wrong
    sums are tried TRIES times; what fails for good is an `error` in its row, not a failed job. Rows without url or
    target are errors too. spread: number of tasks; rows are dealt evenly, whichever server they name. A url that comes
    twice is fetched twice, into whichever targets are named; of a target that comes twice the first row counts.
    """
    has_sum = "sha256" in wanted.columns
    rows = wanted.select("url", "target", (F.col("sha256") if has_sum else F.lit(None).cast("string")).alias("sha256"))
    rows = rows.groupBy("target").agg(F.min(F.struct("url", "sha256")).alias("at")).select("at.url", "target", "at.sha256")
    if spread:
        rows = rows.repartition(spread)

    def sum_of(store: fs.FileSystem, path: str) -> tuple[int, str]:
        digest, size = hashlib.sha256(), 0
        with store.open_input_stream(path) as held:
            while block := held.read(piece):
                digest.update(block)
                size += len(block)
        return size, digest.hexdigest()

    def one(url: str | None, target: str | None, expected: str | None) -> tuple:
        if not url or not target:
            return url, target, None, None, 0, "no url or no target"
        store, path = fs.FileSystem.from_uri(target) if "://" in target else (fs.LocalFileSystem(), target)
        if store.get_file_info(path).type == fs.FileType.File:
            size, digest = sum_of(store, path)
            if expected in (None, digest):
                return url, target, size, digest, 0, None
        store.create_dir(path.rpartition("/")[0] or ".", recursive=True)
        aside, last = f"{path}.{uuid.uuid4().hex}.part", ""
        for k in range(TRIES):
            if k:
                time.sleep(wait * 2 ** (k - 1))
            try:
                size, digest = _fetch(url, store, aside, piece)
                if expected not in (None, digest):
                    raise _Again(f"sha256 is {digest}")
                store.move(aside, path)
                return url, target, size, digest, k + 1, None
            except _Again as error:
                last = str(error)
            except (urllib.error.HTTPError, ValueError) as error:
                last = str(error)
                break
            finally:
                if store.get_file_info(aside).type == fs.FileType.File:
                    store.delete_file(aside)
        return url, target, None, None, k + 1, last

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["url", "target", "bytes", "sha256", "tries", "error"]
        types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.string()]
        for batch in batches:
            for row in batch.to_pylist():
                made = one(row["url"], row["target"], row["sha256"])
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(made, types)], names)

    return rows.mapInArrow(run, FETCHED)

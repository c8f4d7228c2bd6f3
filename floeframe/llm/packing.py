"""Packing documents into sequences of at most `capacity` tokens by swap-based local search.

Documents are tokenised where they lie; only (document, piece, length, checksum) rows are shuffled, to blocks of
about BLOCK documents by a hash of the document, so that a block fits a task whatever the number of documents.
Pieces of full length are sequences of their own. In a block, each of the rest goes to the fullest bin that has room
for it, in the order in which they come; then local search moves documents and exchanges one for one or two for one
from an emptier underfull bin to a fuller one, of each kind the step that moves most, so that the sum of squared
fills grows, until bins empty. It ends when the block has as few bins as a lower bound says it needs, or when no bin has a
step left; then it begins again from the documents in order of their length, and the better result counts. So a
block never has more bins than a best-fit-decreasing packing. What blocks cost is one bin in thousands at most.

Null text counts as empty and packs as its end id alone; repeated rows are packed each by itself, and equal rows
get interchangeable places; an empty table gives an empty one; other columns play no part.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from floeframe.llm.common import ids_and_text, released
from floeframe.llm.tokenize import packed, word_encoder

#: Documents in a block, about, and words whose ids a worker keeps.
BLOCK, WORDS_KEPT = 16_384, 150_000
#: Numbers that a step compares at once.
AT_ONCE = 4_000_000

PIECES = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("piece", IntegerType()),
        StructField("start", LongType()),
        StructField("length", LongType()),
        StructField("ids_crc32", LongType()),
        StructField("row", LongType()),
    ]
)
PACKED = StructType(PIECES.fields[:-1] + [StructField("sequence_id", LongType()), StructField("offset", LongType())])


def best_fit(lengths: list[int], capacity: int, order: Iterable[int] | None = None) -> list[list[int]]:
    """Bins of item numbers: each in its order (else as they come) to the fullest bin that has room."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = defaultdict(list)
    rooms: list[int] = []  # sorted rooms that some bin has
    for i in range(len(lengths)) if order is None else order:
        at = bisect.bisect_left(rooms, lengths[i])
        if at == len(rooms):
            bins.append([i])
            b, room = len(bins) - 1, capacity - lengths[i]
        else:
            old = rooms[at]
            b, room = by_room[old].pop(), old - lengths[i]
            if not by_room[old]:
                rooms.pop(at)
            bins[b].append(i)
        if room not in by_room or not by_room[room]:
            bisect.insort(rooms, room)
        by_room[room].append(b)
    return bins


def fewest(lengths: list[int], capacity: int) -> int:
    """A lower bound of the number of bins: for any k, items above capacity - k share a bin with none of k or more."""
    size = np.sort(np.array(lengths, dtype=np.int64))[::-1]
    if not len(size):
        return 0
    total = np.r_[0, np.cumsum(size)]
    above = lambda x: np.searchsorted(-size, -x)  # how many are larger than x
    k = np.r_[0, np.unique(size[2 * size <= capacity])]
    alone, large, small = above(capacity - k), above(capacity / 2), above(k - 0.5)
    room = (large - alone) * capacity - (total[large] - total[alone])
    rest = np.maximum(total[small] - total[large] - room, 0)
    return int((large + -(-rest // capacity)).max())


class Search:
    """Local search among underfull bins."""

    def __init__(self, bins: list[list[int]], lengths: list[int], capacity: int):
        self.bins, self.capacity = [list(b) for b in bins], capacity
        self.size = np.array(lengths, dtype=np.int64)
        self.home = np.empty(len(lengths), dtype=np.int64)
        for k, b in enumerate(bins):
            self.home[b] = k
        self.fill = np.array([self.size[b].sum() for b in bins], dtype=np.int64)

    def best_step(self, poor: int) -> tuple[list[int], int | None, int] | None:
        """(items to give, item to take back, to which bin); None where nothing makes a fuller bin fuller.

        A move where an item fits, else the exchange of one for one, else of two for one, that moves most.
        """
        room = self.capacity - self.fill
        rich = np.flatnonzero((self.fill >= self.fill[poor]) & (room > 0))
        rich = rich[rich != poor]
        if not len(rich):
            return None
        own = np.array(sorted(self.bins[poor], key=lambda i: (self.size[i], i)))
        fits = own[self.size[own] <= room[rich].max()]
        if len(fits):
            give = int(fits[-1])
            good = rich[room[rich] >= self.size[give]]
            return [give], None, int(good[room[good].argmin()])
        wanted = np.zeros(len(room), dtype=bool)
        wanted[rich] = True
        back = np.flatnonzero(wanted[self.home])
        spare = room[self.home[back]]
        return self.exchange([(i,) for i in own.tolist()], back, spare) or self.exchange(self.pairs(own), back, spare)

    def pairs(self, own: np.ndarray) -> list[tuple[int, int]]:
        """Two items of each total that two of own (sorted by size) have."""
        sizes = self.size[own]
        few = own[np.r_[True, True, sizes[2:] != sizes[:-2]][: len(own)]].tolist()  # of equal sizes, two are enough
        totals = {int(self.size[i] + self.size[j]): (i, j) for a, i in enumerate(few) for j in few[a + 1 :]}
        return list(totals.values())

    def exchange(self, gives: list[tuple], back: np.ndarray, spare: np.ndarray) -> tuple[list[int], int | None, int] | None:
        """The exchange of one of gives for one of back, whose bins have room to spare, that moves most."""
        best, moved, sizes = None, 0, self.size[back]
        step = max(1, AT_ONCE // len(back))
        for at in range(0, len(gives), step):
            part = gives[at : at + step]
            change = self.size[np.array(part)].sum(1)[:, None] - sizes[None]
            change[change > spare[None]] = 0
            x, y = divmod(int(change.argmax()), len(back))
            if change[x, y] > moved:
                taken = int(back[y])
                best, moved = (list(part[x]), taken, int(self.home[taken])), int(change[x, y])
        return best

    def take(self, poor: int, step: tuple[list[int], int | None, int]) -> None:
        give, taken, rich = step
        for i in give:
            self.bins[poor].remove(i)
            self.bins[rich].append(i)
            self.home[i] = rich
        if taken is not None:
            self.bins[rich].remove(taken)
            self.bins[poor].append(taken)
            self.home[taken] = poor
        for k in (poor, rich):
            self.fill[k] = self.size[self.bins[k]].sum() if self.bins[k] else 0

    def run(self, least: int) -> list[list[int]]:
        """Bins after the search: `least` of them, or no step left."""
        count, moving = int((self.fill > 0).sum()), True
        while moving and count > least:
            moving = False
            stuck = np.zeros(len(self.fill), dtype=bool)
            while count > least:
                live = np.flatnonzero((self.fill > 0) & (self.fill < self.capacity) & ~stuck)
                if not len(live):
                    break
                poor = int(live[self.fill[live].argmin()])
                step = self.best_step(poor)
                if step is None:
                    stuck[poor] = True
                    continue
                moving = True
                self.take(poor, step)
                count -= not self.bins[poor]
        return [b for b in self.bins if b]


def packed_bins(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers, as few as the search finds."""
    least = fewest(lengths, capacity)
    found = Search(best_fit(lengths, capacity), lengths, capacity).run(least)
    if len(found) > least:
        longest = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
        again = Search(best_fit(lengths, capacity, longest), lengths, capacity).run(least)
        found = min(found, again, key=len)
    return found


def tokenised(docs: DataFrame, vocabulary: str, end_id: int, capacity: int) -> DataFrame:
    schema = to_arrow_schema(PIECES)

    def run(batches):
        encode, end = word_encoder(vocabulary, WORDS_KEPT), packed([end_id])
        for batch in batches:
            rows: list[list] = [[] for _ in schema]
            for doc, row, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(1).to_pylist()):
                ids = memoryview(encode(text) + end)
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    for out, x in zip(rows, (doc, piece, at // 4, len(part) // 4, zlib.crc32(part), row)):
                        out.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(x, type=f.type) for x, f in zip(rows, schema)], schema=schema)

    return ids_and_text(docs).withColumn("row", F.xxhash64("doc_id", "text")).mapInArrow(released(run), PIECES)


def packed_sequences(docs: DataFrame, vocabulary: str, end_id: int = 1, capacity: int = 4096, block: int = BLOCK) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of docs.

    docs is counted first, by its ids alone: a scan of one column.
    """
    blocks = max(1, -(-docs.count() // block))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "row", "piece"], kind="stable").reset_index(drop=True)
        lengths = group["length"].tolist()
        full = [i for i, n in enumerate(lengths) if n == capacity]
        rest = [i for i, n in enumerate(lengths) if n < capacity]
        sizes = [lengths[i] for i in rest]
        bins = [[i] for i in full] + [[rest[i] for i in b] for b in packed_bins(sizes, capacity)]
        sequence, offset = [0] * len(lengths), [0] * len(lengths)
        base = int(group["block"].iloc[0]) << 32
        for number, b in enumerate(bins):
            at = 0
            for i in b:
                sequence[i], offset[i] = base + number, at
                at += lengths[i]
        return group.assign(sequence_id=sequence, offset=offset)[PACKED.names].astype({"doc_id": "Int64"})

    pieces = tokenised(docs, vocabulary, end_id, capacity)
    dealt = pieces.withColumn("block", F.pmod(F.coalesce("row", F.lit(0)), F.lit(blocks)).cast("long"))
    return dealt.groupBy("block").applyInPandas(pack, PACKED)

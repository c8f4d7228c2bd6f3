"""SentencePiece encoding and decoding for merge-type vocabularies.

A text starts as its characters. Every two neighbours that together are a piece stand on an agenda in the order of
that piece's score, of equal ones the leftmost first; the first entry whose neighbours are still there is merged, and
the pairs that the new symbol makes with what stands left and right of it come onto the agenda. What is no piece at
the end becomes its bytes' pieces, or the unknown one where a vocabulary has no bytes.

No piece holds a space mark behind another letter (else texts stay whole), so what follows a space mark and what
stands before it never merge: the agenda runs over one run of marks and letters at a time, and a worker keeps the ids
of the runs it met, MOST_RUNS at most, of LONGEST_RUN letters at most. With check "runs", the runs that an Arrow batch
brings are also encoded by the sentencepiece library, and all its ids decoded by it; with "texts" it encodes every text
as a whole. A difference is an error.

A null text counts as empty, an empty text has no ids; repeated rows give repeated results; an empty table gives an
empty one; other columns play no part. Null ids decode to the empty text, ids outside of the vocabulary raise.
"""

from __future__ import annotations

import contextlib
import functools
import gc
import hashlib
import heapq
import re
from itertools import chain, groupby
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from floeframe.llm.common import arrow_map, ids_and_text

MARK = "▁"
#: How much is checked; see above. "" for nothing.
RUNS, TEXTS = "runs", "texts"
MOST_RUNS, LONGEST_RUN = 500_000, 64
#: Characters of a run whose agenda is a plain list; the rank of what is no piece.
SHORT, NEVER = 32, 1 << 62
#: Bits of a place in a run, and the largest place: Spark's texts are shorter than 2 ** 31 characters.
PLACES = 31
LAST_PLACE = 2**PLACES - 1
#: What the library writes for an unknown piece, and for a byte that is in no character (fixed values).
UNKNOWN, BROKEN = " ⁇ ", "�"
LOST_BYTE = re.compile("[\udc80-\udcff]")


class Known(dict):
    """run -> its ids, worked out where they aren't held."""

    def __init__(self, work_out):
        super().__init__()
        self.work_out, self.fresh = work_out, []

    def __missing__(self, run: str) -> tuple[int, ...]:
        found = self.work_out(run)
        self.fresh.append((run, found))
        if len(run) <= LONGEST_RUN:
            if len(self) >= MOST_RUNS:
                self.clear()
            self[run] = found
        return found


class Pieces:
    """A vocabulary: pieces that merges may make, their scores, and how ids are read."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [lib.id_to_piece(i) for i in range(lib.vocab_size())]
        plain = [i for i in range(len(names)) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i))]
        self.ids = {names[i]: i for i in plain}
        scores = {name: lib.get_score(i) for name, i in self.ids.items()}
        places = {score: k for k, score in enumerate(sorted(set(scores.values()), reverse=True))}
        self.ranks = {name: places[score] for name, score in scores.items()}
        self.unknown, self.decimals = lib.unk_id(), [*map(str, range(len(names)))]
        by_byte = {int(names[i][3:5], 16): i for i in range(len(names)) if lib.is_byte(i)}
        self.bytes = [by_byte[b] for b in range(256)] if len(by_byte) == 256 else None
        # bytes from 0x80 as lone surrogates until their run is read
        self.read = [name.replace(MARK, " ") for name in names]
        for b, i in by_byte.items():
            self.read[i] = bytes([b]).decode("utf-8", "surrogateescape")
        self.read[self.unknown] = UNKNOWN
        self.lone = {i for b, i in by_byte.items() if b >= 0x80}
        self.silent = {i for i in range(len(names)) if lib.is_control(i)}
        self.prefixed = lib.normalize("a").startswith(MARK)
        self.marked = {i for name, i in self.ids.items() if self.prefixed and name.startswith(MARK)}
        inside = any(b == MARK != a for name in self.ids for a, b in zip(name, name[1:]))
        self.runs = re.compile("(?s:.+)" if inside else f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        self.known = Known(self.ids_of_run)

    def merged(self, run: str) -> list[str]:
        """The symbols that a run of characters ends up as."""
        return self.by_list(run) if len(run) <= SHORT else self.by_heap(run)

    def by_list(self, run: str) -> list[str]:
        """A short run's agenda: the rank of each symbol with its right neighbour, in the order of places."""
        symbols, rank_of = list(run), self.ranks.get
        agenda = [rank_of(pair, NEVER) for pair in map(add, run, run[1:])]
        while agenda and (best := min(agenda)) < NEVER:
            k = agenda.index(best)
            symbols[k] = both = symbols[k] + symbols.pop(k + 1)
            del agenda[k]
            if k < len(agenda):
                agenda[k] = rank_of(both + symbols[k + 1], NEVER)
            if k:
                agenda[k - 1] = rank_of(symbols[k - 1] + both, NEVER)
        return symbols

    def by_heap(self, run: str) -> list[str]:
        """A long run's agenda: a heap of ranks and places, each in one number; what is out of date is passed over."""
        symbols: list[str | None] = list(run)
        rank_of, push, pop = self.ranks.get, heapq.heappush, heapq.heappop
        agenda = [r << PLACES | i for i, pair in enumerate(map(add, run, run[1:])) if (r := rank_of(pair)) is not None]
        heapq.heapify(agenda)
        end = len(run)
        before, after = list(range(-1, end - 1)), [*range(1, end), -1]
        while agenda:
            entry = pop(agenda)
            left = entry & LAST_PLACE
            if (one := symbols[left]) is None or (right := after[left]) < 0:
                continue
            if rank_of(both := one + symbols[right]) != entry >> PLACES:
                continue  # a neighbour was merged meanwhile
            symbols[left], symbols[right] = both, None
            after[left] = right = after[right]
            if right >= 0:
                before[right] = left
                if (rank := rank_of(both + symbols[right])) is not None:
                    push(agenda, rank << PLACES | left)
            if (left := before[left]) >= 0 and (rank := rank_of(symbols[left] + both)) is not None:
                push(agenda, rank << PLACES | left)
        return [s for s in symbols if s is not None]

    def ids_of_run(self, run: str) -> tuple[int, ...]:
        made: list[int] = []
        for symbol in self.merged(run):
            if (i := self.ids.get(symbol)) is not None:
                made.append(i)
            elif self.bytes:
                made += map(self.bytes.__getitem__, symbol.encode())
            elif not made or made[-1] != self.unknown:
                made.append(self.unknown)
        return tuple(made)

    def encode(self, text: str) -> list[int]:
        """The ids of a text; the library's rules of writing (marks for spaces, a mark in front) come first."""
        runs = self.runs.findall(self.library.normalize(text))
        ids = list(chain.from_iterable(map(self.known.__getitem__, runs)))
        if self.bytes is None:  # unknown neighbours are one
            ids = [i for i, last in zip(ids, [None, *ids]) if not i == last == self.unknown]
        return ids

    def decode(self, ids: list[int]) -> str:
        """Pieces in a row, runs of bytes read as UTF-8, marks as spaces, without the mark in front."""
        if ids and min(ids) < 0:
            raise IndexError(f"no piece has id {min(ids)}")
        front = next((i for i in ids if i not in self.silent), None)
        if front is None:
            return ""
        parts = [ids] if self.silent.isdisjoint(ids) else cut(ids, self.silent)  # bytes don't go on behind a control piece
        text = "".join(map(self.part, parts))
        return text[1:] if front in self.marked else text

    def part(self, ids: list[int]) -> str:
        text = "".join(map(self.read.__getitem__, ids))
        if self.lone.isdisjoint(ids):
            return text
        return LOST_BYTE.sub(BROKEN, text.encode("utf-8", "surrogateescape").decode("utf-8", "surrogateescape"))


def cut(ids: list[int], at: set[int]) -> list[list[int]]:
    return [[*part] for silent, part in groupby(ids, at.__contains__) if not silent]


@functools.cache
def pieces(path: str) -> Pieces:
    """One a worker."""
    return Pieces(path)


@contextlib.contextmanager
def uncollected():
    """No garbage collection over a batch's many lists: none is part of a cycle."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


def compared(held: Pieces, texts: list[str], ids: list) -> None:
    for text, mine, theirs in zip(texts, ids, held.library.encode(texts, num_threads=1)):
        if [*mine] != theirs:
            raise ValueError(f"other ids than the library's for a text of {len(text)} characters, {text[:80]!r}")


def _encoded(held: Pieces, texts: list[str], check: str) -> list[list[int]]:
    with uncollected():
        made = [held.encode(t) for t in texts]
    fresh, held.known.fresh = held.known.fresh, []
    if check == RUNS:
        alone = [run[held.prefixed :].replace(MARK, " ") for run, _ in fresh]
        told = [k for k, x in enumerate(held.library.normalize(alone)) if x == fresh[k][0]] if alone else []
        compared(held, [alone[k] for k in told], [fresh[k][1] for k in told])
        if len(told) == len(fresh):
            return made
    if check:  # also where no text of its own is written as a run
        compared(held, texts, made)
    return made


def _decoded(held: Pieces, ids: list[list[int]], check: str) -> list[str]:
    with uncollected():
        made = [held.decode(x) for x in ids]
    if check and made and made != held.library.decode(ids, num_threads=1):
        raise ValueError("ids are read otherwise than by the library")
    return made


def encoded(docs: DataFrame, model: str, check: str = RUNS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, ids array<int>) of every row of docs."""
    schema = StructType([StructField(id_col, LongType()), StructField("ids", ArrayType(IntegerType()))])
    columns = lambda batch: [batch.column(0), _encoded(pieces(model), batch.column(1).to_pylist(), check)]
    return arrow_map(ids_and_text(docs, id_col, text_col), columns, schema)


def decoded(rows: DataFrame, model: str, check: str = RUNS, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id_col, text string) of rows of ids."""
    schema = StructType([StructField(id_col, LongType()), StructField("text", StringType())])

    def columns(batch):
        ids = [x or [] for x in batch.column(1).to_pylist()]
        return [batch.column(0), _decoded(pieces(model), ids, check)]

    return arrow_map(rows.select(rows[id_col].cast("long").alias(id_col), rows[ids_col].alias(ids_col)), columns, schema)


DIGESTS = StructType([
    StructField("doc_id", LongType()), StructField("n_tokens", LongType()),
    StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType()),
])


def round_trip(docs: DataFrame, model: str, check: str = RUNS) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode each text, decode its ids, digest both. One narrow stage.

    Ids are digested as decimals joined by commas, texts as UTF-8.
    """
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()

    def columns(batch):
        held = pieces(model)
        ids = _encoded(held, batch.column(1).to_pylist(), check)
        texts = _decoded(held, ids, check)
        written = [",".join(map(held.decimals.__getitem__, x)) for x in ids]
        return [batch.column(0), [*map(len, ids)], [*map(digest, written)], [*map(digest, texts)]]

    return arrow_map(ids_and_text(docs), columns, DIGESTS)

"""Sum-of-squares online packing of token documents into windows.

A document is cut into full windows and a rest. The rest goes to the fill
level whose choice makes the sum of squared counts of partially filled
windows smallest: a window at fill h that takes s tokens leaves level h and
joins level h + s. The counts are kept in an array by level, so a step looks
at levels, not at windows.

Each task packs the documents of its own input split and holds the pieces of
its open windows, never more than its split. The result is written, so the
text is encoded once. Windows that are still partial at the end of a split,
unless nearly full, go to a further round: whole windows are dealt by a hash
to tasks of about ROUND_TOKENS tokens, and their pieces are placed anew, the
longest first. Rounds end with one that fits a single task, or with the third.
What the last round leaves partial is strung together into full windows, as
pieces may be cut freely. Of each task less than one window stays over; it is
cut into sequences of powers of two, which need no padding.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_out, written
from .tokens import encoded_batches

WINDOW = 4096
#: A partial window that lacks at most so many tokens is padded, not cut.
MOST_PADDING = 16
#: Tokens of open windows that a task of a further round packs, on the average.
ROUND_TOKENS = 1 << 24
#: Rounds after that of the splits. A round leaves about a million tokens per task, the last one less than a window.
MORE_ROUNDS = 2
_COLUMNS = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
_SCHEMA = pa.schema([*((c, pa.binary() if c == "ids" else pa.int64()) for c in _COLUMNS), ("closed", pa.bool_())])
_DDL = ", ".join(f"{f.name} {'binary' if f.name == 'ids' else 'boolean' if f.name == 'closed' else 'long'}" for f in _SCHEMA)


class Levels:
    """Counts of partial windows by fill level, and the windows themselves."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.count = np.zeros(window + 1, np.int64)
        self.open: dict[int, list] = {}

    def choose(self, size: int) -> int:
        """The level to place ``size`` tokens on; 0 is a new window. Of equal
        choices the fullest level wins."""
        n = self.count
        levels = np.flatnonzero(n[1:self.window - size + 1] > 0) + 1
        if not len(levels):
            return 0
        change = 2 * (n[levels + size] - n[levels] + 1)
        if levels[-1] + size == self.window:
            change[-1] -= 1  # a full window is on no level
        best = len(levels) - 1 - int(change[::-1].argmin())
        return 0 if 2 * n[size] + 1 < change[best] else int(levels[best])

    def place(self, size: int, piece) -> list | None:
        """Place a piece; the pieces of its window if that is now full."""
        if size == self.window:
            return [piece]
        level = self.choose(size)
        pieces = self.open[level].pop() if level else []
        pieces.append(piece)
        self.count[level] -= level > 0
        if level + size == self.window:
            return pieces
        self.count[level + size] += 1
        self.open.setdefault(level + size, []).append(pieces)
        return None

    def rest(self) -> Iterator[list]:
        for level in sorted(self.open):
            yield from self.open[level]


def _nearly_full(pieces: list[tuple], window: int) -> bool:
    return window - sum(len(p[-1]) for p in pieces) <= MOST_PADDING


def cut_to_powers(pieces: list[tuple], window: int = WINDOW) -> list[list[tuple]]:
    """Sequences of power-of-two length from the pieces (.., start, ids) of one
    window; a full or nearly full one stays whole."""
    total = sum(len(p[-1]) for p in pieces)
    if _nearly_full(pieces, window):
        return [pieces]
    out, left = [], list(reversed(pieces))
    while total:
        room, now = 1 << (total.bit_length() - 1), []
        total -= room
        while room:
            *doc, start, ids = left.pop()
            now.append((*doc, start, ids[:room]))
            if len(ids) > room:
                left.append((*doc, start + room, ids[room:]))
            room -= len(now[-1][-1])
        out.append(now)
    return out


def strung(windows: Iterable[list[tuple]], window: int = WINDOW) -> Iterator[list[tuple]]:
    """Full windows from the pieces (.., start, ids) of partial ones, one
    behind the other and cut at the borders; the last window may be partial."""
    now, room = [], window
    for *doc, start, ids in (p for pieces in windows for p in pieces):
        at = 0
        while at < len(ids):
            part = ids[at:at + room]
            now.append((*doc, start + at, part))
            at += len(part)
            room -= len(part)
            if not room:
                yield now
                now, room = [], window
    if now:
        yield now


def _placed(windows: Iterator[tuple[list, bool]], first: int) -> Iterator[tuple]:
    """Rows of _SCHEMA from (pieces, closed), windows numbered from ``first``."""
    for k, (pieces, closed) in enumerate(windows):
        offset = 0
        for doc_id, n, start, ids in pieces:
            yield doc_id, start, len(ids), ids.tobytes(), n, first + k, offset, closed
            offset += len(ids)


def _again(open_windows: DataFrame, tasks: int, number: int, last: bool, window: int) -> DataFrame:
    """A further round over the rows of windows that are open."""
    def place(part: pa.Table) -> pa.Table:
        levels = Levels(window)
        first = (number << 60) | (part.column("task")[0].as_py() << 32)
        part = part.sort_by([("length", "descending"), ("sequence_id", "ascending"), ("offset", "ascending")])
        column = {c: part.column(c) for c in _COLUMNS}

        def windows():
            for doc_id, n, start, ids in zip(*(column[c] for c in ("doc_id", "doc_tokens", "start", "ids")), strict=True):
                piece = np.frombuffer(ids.as_buffer(), "<u4")
                full = levels.place(len(piece), (doc_id.as_py(), n.as_py(), start.as_py(), piece))
                if full:
                    yield full, True
            partial = []
            for pieces in levels.rest():
                if not last or _nearly_full(pieces, window):
                    yield pieces, _nearly_full(pieces, window)
                else:
                    partial.append(pieces)
            for pieces in strung(partial, window):
                yield from ((s, True) for s in cut_to_powers(pieces, window))

        return pa.Table.from_batches(arrow_out(_SCHEMA, _placed(windows(), first), weight=lambda r: len(r[3])), _SCHEMA)

    dealt = open_windows.withColumn("task", F.pmod(F.xxhash64("sequence_id"), F.lit(tasks).cast("long")))
    return dealt.groupBy("task").applyInArrow(place, _DDL)


def share_outside(pieces: DataFrame, window: int = WINDOW) -> float:
    """The share of the tokens of packed pieces that lies outside full or nearly full windows."""
    size = F.col("n")
    row = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.sum(F.when(size < window - MOST_PADDING, size).otherwise(0)), F.sum(size)).first()
    return (row[0] or 0) / (row[1] or 1)


def pack(docs: DataFrame, tokenizer: str, end_id: int, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
         round_tokens: int = ROUND_TOKENS) -> DataFrame:
    """doc_id, start, length, ids, doc_tokens, sequence_id, offset per piece.

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit
    integers. Null and empty texts are one end id. Every row is a document of
    its own: repeated rows and ids are packed as often as they are given, null
    ids stay null; other columns are ignored; an empty table gives no rows.
    ``docs`` should be a stored table: then splits, and with them sequence
    numbers, are the same if a task is repeated.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = Levels(window)

        def windows():
            for doc_id, raw in encoded_batches(tokenizer, batches):
                ids = np.frombuffer(raw + end_id.to_bytes(4, "little"), "<u4")
                for start in range(0, len(ids), window):
                    part = ids[start:start + window]
                    full = levels.place(len(part), (doc_id, len(ids), start, part))
                    if full:
                        yield full, True
            for pieces in levels.rest():
                yield pieces, _nearly_full(pieces, window)

        return arrow_out(_SCHEMA, _placed(windows(), TaskContext.get().partitionId() << 32), weight=lambda r: len(r[3]))

    now = written(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, _DDL),
                  "packed", compression="zstd")
    out = now.where("closed")
    for number in range(1, MORE_ROUNDS + 1):
        left = now.where("not closed").agg(F.sum("length")).first()[0] or 0
        if not left:
            break
        tasks = -(-left // round_tokens)
        last = tasks == 1 or number == MORE_ROUNDS
        now = _again(now.where("not closed"), tasks, number, last, window)
        if last:
            out = out.union(now)
            break
        now = written(now, "packed", compression="zstd")
        out = out.union(now.where("closed"))
    return out.select(_COLUMNS)

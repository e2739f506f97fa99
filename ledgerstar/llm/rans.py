"""Token files coded by a static range asymmetric numeral system.

All blocks share one frequency table, made from the token counts of the whole
corpus and scaled to 2**16. A block codes the ids of whole documents on LANES
interleaved states, token i on lane i mod LANES, so that encoder and decoder
work on vectors. Tokens too rare for a slot of the table are coded as one
escape symbol and listed beside the stream. Every CHECKPOINT steps the block
keeps the decoder's states and its place in the stream: a reader may start
there, and several readers may share a block. A checksum over the block and
one over its ids guard storage and decoding.

Blocks are independent and are stored as rows of a Parquet folder, in order
of ``start``: Spark's committer then decides which attempt of a task counts,
and any file system that Spark reads will do.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_out, arrow_rows, release_shuffles, scratch_path, written
from .tokens import encoded_batches

SCALE = 16
LANES = 2048
#: Steps between checkpoints; a step is a token on each lane.
CHECKPOINT = 64
BLOCK_TOKENS = 1 << 19
_MAGIC = b"RANSBLK1"
_HEAD = "<8sIIIIIIII"
#: States and all that is added to them stay below 2**32, as no frequency exceeds 2**16 - 1.
_LOW = np.uint32((1 << 16) - 1)
_LIMIT = np.uint32(1 << 16)
_HALF = np.uint32(16)


class Table:
    """Symbols with a slot, their frequencies (sum 2**16), and the escape as the last symbol."""

    def __init__(self, ids: np.ndarray, freq: np.ndarray):
        self.ids, self.freq = ids.astype(np.uint32), freq.astype(np.uint32)
        self.cum = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint32)
        self.escape = len(ids)
        self.slot = np.repeat(np.arange(len(freq), dtype=np.uint32), freq.astype(np.int64))
        self.symbol = np.full(int(ids.max(initial=0)) + 2, self.escape, np.int64)
        self.symbol[self.ids] = np.arange(len(ids))

    def symbols(self, tokens: np.ndarray) -> np.ndarray:
        return self.symbol[np.minimum(tokens, len(self.symbol) - 1)]


def make_table(ids: np.ndarray, counts: np.ndarray) -> Table:
    """Scale counts to 2**16; what rounds to nothing shares the escape symbol."""
    size = 1 << SCALE
    exact = counts * (size / max(1, counts.sum()))
    keep = exact >= 1
    ids, exact = ids[keep], exact[keep]
    freq = np.floor(exact).astype(np.int64)
    left = size - int(freq.sum())
    if left < 1:  # the escape needs one slot
        top = int(np.argmax(freq))
        freq[top] -= 1
        left = 1
        ids, exact, freq = (np.delete(a, top) for a in (ids, exact, freq)) if not freq[top] else (ids, exact, freq)
    rare = max(1, min(left, int(np.ceil(size - exact.sum()))))
    order = np.argsort(-(exact - freq), kind="stable")[:left - rare]
    freq[order] += 1
    return Table(ids, np.append(freq, size - int(freq.sum())))


def encode_block(tokens: np.ndarray, docs: list[tuple], table: Table, lanes: int = LANES, every: int = CHECKPOINT) -> bytes:
    """One block. docs: (doc_id or None, number of tokens), in order."""
    sym = table.symbols(tokens)
    escaped = tokens[sym == table.escape].astype("<u4")
    steps = -(-len(tokens) // lanes)
    x = np.full(lanes, _LIMIT, np.uint32)
    words, marks = [None] * steps, {}
    for t in range(steps - 1, -1, -1):
        s = sym[t * lanes:(t + 1) * lanes]
        f, xs = table.freq[s], x[:len(s)]
        over = xs >= f << _HALF
        words[t] = (xs[over] & _LOW).astype("<u2")
        xs = np.where(over, xs >> _HALF, xs)
        q = xs // f
        x[:len(s)] = (q << _HALF) + (xs - q * f) + table.cum[s]
        if t % every == 0:
            marks[t] = x.astype("<u4")
    at = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype("<u4")
    esc_at = np.concatenate([[0], np.cumsum(sym == table.escape)])
    points = b"".join(struct.pack("<III", t, at[t], esc_at[t * lanes]) + marks[t].tobytes() for t in sorted(marks))
    index = zlib.compress(np.array([(0 if i is None else i) for i, _ in docs], "<i8").tobytes() + np.array([n for _, n in docs], "<u4").tobytes()
                          + np.array([i is None for i, _ in docs], np.uint8).tobytes())
    stream = b"".join(w.tobytes() for w in words)
    raw_escapes = zlib.compress(escaped.tobytes())
    head = struct.pack(_HEAD, _MAGIC, lanes, every, len(tokens), len(docs), len(index), len(marks), len(raw_escapes), zlib.crc32(tokens.astype("<u4").tobytes()))
    body = head + index + points + raw_escapes + stream
    return body + struct.pack("<I", zlib.crc32(body))


class Block:
    """A stored block. ``segments`` are the token ranges between checkpoints,
    each decoded on its own; ``tokens`` joins and checks them."""

    def __init__(self, data: bytes, table: Table):
        if zlib.crc32(data[:-4]) != struct.unpack("<I", data[-4:])[0]:
            raise ValueError("block checksum differs")
        magic, self.lanes, self.every, self.n, n_docs, n_index, n_marks, n_escapes, self.crc = struct.unpack_from(_HEAD, data)
        if magic != _MAGIC:
            raise ValueError("not a block")
        self.table, at = table, struct.calcsize(_HEAD)
        index = zlib.decompress(data[at:at + n_index])
        at += n_index
        ids, sizes = np.frombuffer(index, "<i8", n_docs), np.frombuffer(index, "<u4", n_docs, 8 * n_docs)
        null = np.frombuffer(index, np.uint8, n_docs, 12 * n_docs)
        self.docs = [(None if z else int(i), int(s)) for i, s, z in zip(ids, sizes, null, strict=True)]
        self.marks = []
        for _ in range(n_marks):
            t, word, esc = struct.unpack_from("<III", data, at)
            self.marks.append((t, word, esc, np.frombuffer(data, "<u4", self.lanes, at + 12)))
            at += 12 + 4 * self.lanes
        self.escapes = np.frombuffer(zlib.decompress(data[at:at + n_escapes]), "<u4")
        at += n_escapes
        self.words = np.frombuffer(data, "<u2", (len(data) - 4 - at) // 2, at)

    def segment(self, k: int) -> np.ndarray:
        t0, word, esc, states = self.marks[k]
        t1 = self.marks[k + 1][0] if k + 1 < len(self.marks) else -(-self.n // self.lanes)
        x, table = states.astype(np.uint32), self.table
        out = np.empty(min(self.n, t1 * self.lanes) - t0 * self.lanes, np.int64)
        for t in range(t0, t1):
            m = min(self.lanes, self.n - t * self.lanes)
            xs = x[:m]
            low = xs & _LOW
            s = table.slot[low]
            out[(t - t0) * self.lanes:(t - t0) * self.lanes + m] = s
            xs = table.freq[s] * (xs >> _HALF) + (low - table.cum[s])
            under = np.flatnonzero(xs < _LIMIT)
            xs[under] = (xs[under] << _HALF) | self.words[word:word + len(under)]
            word += len(under)
            x[:m] = xs
        known = out != table.escape
        tokens = np.empty(len(out), "<u4")
        tokens[known] = table.ids[out[known]]
        tokens[~known] = self.escapes[esc:esc + int((~known).sum())]
        return tokens

    def tokens(self) -> np.ndarray:
        parts = [self.segment(k) for k in range(len(self.marks))]
        tokens = np.concatenate(parts) if parts else np.zeros(0, "<u4")
        if zlib.crc32(tokens.astype("<u4").tobytes()) != self.crc:
            raise ValueError("token checksum differs")
        return tokens


def tokenize_in_order(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(shard, at, doc_id, n, ids): documents in ascending id order; shards
    ascend too, ``at`` counts the shard's tokens before the document; ids take
    two bytes each in documents where all fit, else four. A last row of each
    shard, with ``at`` -1, holds the counts of its tokens."""
    schema = pa.schema([("shard", pa.int64()), ("at", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()

        def rows():
            at, size, held, counts = 0, 0, [], np.zeros(0, np.int64)
            for doc_id, raw in encoded_batches(tokenizer, batches):
                ids = np.frombuffer(raw + end_id.to_bytes(4, "little"), "<u4")
                n = len(ids)
                yield shard, at, doc_id, n, (ids.astype("<u2") if ids.max() < 1 << 16 else ids).tobytes()
                at += n
                size += n
                held.append(ids)
                if size >= 1 << 20:
                    size, held, counts = 0, [], _added(counts, np.bincount(np.concatenate(held)))
            if held:
                counts = _added(counts, np.bincount(np.concatenate(held)))
            if at:
                yield shard, -1, None, 0, zlib.compress(counts.astype("<i8").tobytes(), 1)
        return arrow_out(schema, rows(), weight=lambda r: len(r[4]))

    by = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # the hash parts rows that repeat one id, should they be many
    ordered = by.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    return ordered.mapInArrow(run, "shard long, at long, doc_id long, n long, ids binary")


def _unpacked(ids: bytes, n: int) -> np.ndarray:
    """Stored ids: two bytes each if all fit, else four."""
    return np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4").astype("<u4")


def _added(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sum of two count arrays, as long as the longer one."""
    if len(a) < len(b):
        a, b = b, a
    out = a.astype(np.int64)
    out[:len(b)] += b
    return out


def corpus_table(tokens: DataFrame) -> Table:
    """The frequency table of all tokens; it has as many rows as the vocabulary."""
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for (raw,) in arrow_rows(batches):
            total = _added(total, np.frombuffer(zlib.decompress(raw), "<i8"))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], schema=schema)

    counted = tokens.where("at = -1").select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas().sort_values("id")
    return make_table(counted["id"].to_numpy(np.int64), counted["n"].to_numpy(np.float64))


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int, path: str, block_tokens: int = BLOCK_TOKENS) -> Table:
    """Encode ``docs`` in ascending id order into ``path``: ``blocks`` holds
    the coded blocks, ``table`` the frequency table, which is also returned.

    Null and empty texts are one end id. Null ids come first; rows that
    repeat an id are ordered by their text. Repeated rows are each stored.
    Other columns are ignored; an empty table gives no blocks.
    """
    spark = docs.sparkSession
    tokens = written(tokenize_in_order(docs, tokenizer, end_id), "tokens", compression="zstd")
    release_shuffles(spark)
    table = corpus_table(tokens)
    spark.createDataFrame([(table.ids.astype("<u4").tobytes(), table.freq.astype("<u4").tobytes())], "ids binary, freq binary").write.parquet(f"{path}/table")
    totals = sorted((r["shard"], r["n"]) for r in tokens.groupBy("shard").agg(F.sum("n").alias("n")).collect())  # a row per partition
    before, sums = {}, 0
    for shard, n in totals:
        before[shard] = sums
        sums += n
    schema = pa.schema([("start", pa.int64()), ("n_tokens", pa.int64()), ("n_docs", pa.int64()), ("data", pa.binary())])
    held = spark.sparkContext.broadcast((table.ids, table.freq, before))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, freq, before = held.value
        table = Table(symbols, freq)

        def rows():
            start, size, parts, docs = 0, 0, [], []
            for shard, at, doc_id, n, ids in arrow_rows(batches):
                here = before[shard] + at
                if docs and (size >= block_tokens or here != start + size):
                    yield start, size, len(docs), encode_block(np.concatenate(parts), docs, table)
                    size, parts, docs = 0, [], []
                if not docs:
                    start = here
                size += n
                parts.append(_unpacked(ids, n))
                docs.append((doc_id, n))
            if docs:
                yield start, size, len(docs), encode_block(np.concatenate(parts), docs, table)
        return arrow_out(schema, rows(), weight=lambda r: len(r[3]))

    tokens.where("at >= 0").select("shard", "at", "doc_id", "n", "ids").mapInArrow(run, "start long, n_tokens long, n_docs long, data binary").write.parquet(f"{path}/blocks")
    return table


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids per document of the files in ``path``;
    ``ids`` as little-endian unsigned 32-bit integers. Damaged blocks raise."""
    ids, freq = spark.read.parquet(f"{path}/table").first()
    held = spark.sparkContext.broadcast((bytes(ids), bytes(freq)))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(*(np.frombuffer(x, "<u4") for x in held.value))

        def rows():
            for start, data in arrow_rows(batches):
                block = Block(data, table)
                tokens, at = block.tokens(), 0
                for doc_id, n in block.docs:
                    yield doc_id, start + at, n, tokens[at:at + n].tobytes()
                    at += n
        return arrow_out(schema, rows(), weight=lambda r: len(r[3]))

    blocks = spark.read.schema("start long, n_tokens long, n_docs long, data binary").parquet(f"{path}/blocks")
    return blocks.select("start", "data").mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def new_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "token-files")

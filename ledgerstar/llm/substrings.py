"""Removal of repeated passages by prefix-partitioned suffix trees.

A passage is a window of ``depth`` words that also starts elsewhere. The
suffix tree of the corpus is never built whole: suffixes are split by prefix
into groups that fit a task's memory, each group's subtree is built alone,
and its nodes at ``depth`` words or deeper that have two leaves or more are
the repeats.

The prefix of a suffix is taken where it is rarest to meet: of the windows'
grams of ``prefix`` words the one with the smallest hash, the window's
anchor. Equal windows have their anchor at the same place, so they meet in
the group of that prefix, and neighbouring windows share an anchor: the group
needs their words once, not once per suffix. A prefix that occurs once has
no node below it, so its suffixes are dropped before any words move. Groups
of more than ``group_words`` words are split by longer prefixes, up to the
whole window. Every window of every document takes one of these ways.

Documents travel in batches of about ``batch_words`` words. A batch sends a
passage that it holds many times once, with its number, so a text with any
number of copies sends one row per batch.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_out, arrow_rows, release_shuffles, written

DEPTH = 35
PREFIX = 8
BATCH_WORDS = 1 << 20
BATCH_BYTES = 8 << 20
#: Words of a group, and of the groups that one task holds at a time.
GROUP_WORDS = 1 << 18
BUCKET_WORDS = 1 << 21
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_BATCH = ("batch long, doc_ids array<bigint>, texts array<binary>, keys array<bigint>, counts array<int>, key_words array<bigint>, "
          "seg_key binary, seg_start binary, seg_size binary")


class _Numbers(dict):
    """Numbers words in the order of their first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def numbered(words: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    known = _Numbers()
    return np.fromiter(map(known.__getitem__, words), np.int64, len(words)), list(known)


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` words from the words' hashes."""
    n = max(0, len(words) - size + 1)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            out = out * _ODD + words[k:k + n]
        out ^= out >> np.uint64(32)
        out *= _MIX
        out ^= out >> np.uint64(29)
    return out


def leftmost_smallest(values: np.ndarray, span: int) -> np.ndarray:
    """For every ``span`` neighbours, the place of their leftmost smallest value."""
    at, low, width = np.arange(len(values)), values, 1

    def narrowed(step: int) -> None:
        nonlocal at, low
        right = low[step:] < low[:-step]
        low, at = np.where(right, low[step:], low[:-step]), np.where(right, at[step:], at[:-step])

    while 2 * width <= span:
        narrowed(width)
        width *= 2
    if span > width:
        narrowed(span - width)
    return at


def segments(words: np.ndarray, ends: np.ndarray, depth: int = DEPTH, prefix: int = PREFIX) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring windows with one anchor: the anchor's key, the
    first window's start and the number of windows. ``words``: hashes of the
    documents' words, ``ends``: where the document of each word ends."""
    n = len(words) - depth + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)
    grams = gram_hashes(words, prefix)
    at = leftmost_smallest(grams, depth - prefix + 1)
    whole = np.arange(n) + depth <= ends[:n]
    opens = whole & np.r_[True, ~whole[:-1] | (at[1:] != at[:-1])]
    start = np.flatnonzero(opens)
    run = np.cumsum(opens)[whole] - 1
    return grams[at[start]].view(np.int64), start.astype(np.int32), np.bincount(run, minlength=len(start)).astype(np.int32)


def batches_of(docs: DataFrame, depth: int, prefix: int, batch_words: int, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Documents in batches, with the keys of their anchors (``counts`` segments
    of ``key_words`` words each) and the segments of every key."""
    schema = pa.schema([("batch", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("texts", pa.list_(pa.binary())), ("keys", pa.list_(pa.int64())),
                        ("counts", pa.list_(pa.int32())), ("key_words", pa.list_(pa.int64())), *((c, pa.binary()) for c in ("seg_key", "seg_start", "seg_size"))])

    def packed(ids: list, texts: list[bytes], words: list[bytes], sizes: list[int]) -> tuple:
        numbers, known = numbered(words)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, known), np.uint64, len(known))[numbers]
        stops = np.cumsum(sizes)
        key, start, size = segments(hashes, np.repeat(stops, sizes), depth, prefix)
        keys, which, counts = np.unique(key, return_inverse=True, return_counts=True)
        key_words = np.bincount(which, weights=size + depth - 1, minlength=len(keys)).astype(np.int64)
        return (uuid.uuid4().int >> 65, ids, texts, keys, counts.astype(np.int32), key_words, which.astype(np.int32).tobytes(), start.tobytes(), size.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            ids, texts, words, sizes, held = [], [], [], [], 0
            for doc_id, text in arrow_rows(batches):
                own = (text or b"").split()  # bytes.split parts at \x20 and \x09-\x0D, no other space
                ids.append(doc_id)
                texts.append(text or b"")
                words += own
                sizes.append(len(own))
                held += len(texts[-1])
                if len(words) >= batch_words or held >= batch_bytes:
                    yield packed(ids, texts, words, sizes)
                    ids, texts, words, sizes, held = [], [], [], [], 0
            if ids:
                yield packed(ids, texts, words, sizes)
        return arrow_out(schema, rows(), size=1)

    return docs.mapInArrow(run, _BATCH)


def _wanted(stored: DataFrame, group_words: int) -> DataFrame:
    """(batch, key, words, heavy) of the prefixes that occur twice or more."""
    each = stored.select("batch", F.explode(F.arrays_zip("keys", "counts", "key_words")).alias("k")).select(
        "batch", F.col("k.keys").alias("key"), F.col("k.counts").alias("count"), F.col("k.key_words").alias("words"))
    over = Window.partitionBy("key")  # a row per batch at most
    counted = each.withColumn("n", F.sum("count").over(over)).withColumn("group_words", F.sum("words").over(over)).where("n > 1")
    return counted.select("batch", "key", "words", (F.col("group_words") > group_words).alias("heavy"))


def _extracted(stored: DataFrame, wanted: DataFrame, depth: int) -> DataFrame:
    """(key, body, batch, segs, n, first): the distinct segments of the wanted
    prefixes in each batch, and where they stand (``segs``). Of heavy
    prefixes every window is a row of its own: its prefix is the whole window,
    and it is the ``first``-th of its segments."""
    ddl = "key long, body binary, batch long, segs binary, n int, first int"
    schema = pa.schema([("key", pa.int64()), ("body", pa.binary()), ("batch", pa.int64()), ("segs", pa.binary()), ("n", pa.int32()), ("first", pa.int32())])
    per_batch = wanted.groupBy("batch").agg(F.collect_list(F.when(~F.col("heavy"), F.col("key"))).alias("light"),
                                            F.collect_list(F.when(F.col("heavy"), F.col("key"))).alias("heavy")).withColumnRenamed("batch", "wbatch")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch, texts, keys, seg_key, seg_start, seg_size, light, heavy in arrow_rows(batches):
                words = b" ".join(texts).split()
                key = np.array(keys, np.int64)[np.frombuffer(seg_key, np.int32)]
                start, size = np.frombuffer(seg_start, np.int32).tolist(), np.frombuffer(seg_size, np.int32).tolist()
                held: dict[tuple[int, bytes], list[int]] = {}
                for s in np.flatnonzero(np.isin(key, np.array(light, np.int64))).tolist():
                    held.setdefault((int(key[s]), b" ".join(words[start[s]:start[s] + size[s] + depth - 1])), []).append(s)
                for (k, body), segs in held.items():
                    yield k, body, batch, np.array(segs, np.int32).tobytes(), len(segs), None
                alone: dict[tuple[bytes, int], list[int]] = {}
                for s in np.flatnonzero(np.isin(key, np.array(heavy, np.int64))).tolist():
                    for j in range(size[s]):
                        alone.setdefault((b" ".join(words[start[s] + j:start[s] + j + depth]), j), []).append(s)
                for (body, j), segs in alone.items():
                    yield None, body, batch, np.array(segs, np.int32).tobytes(), len(segs), j
        return arrow_out(schema, rows(), weight=lambda r: len(r[1]) + len(r[3]))

    both = stored.join(per_batch, F.col("batch") == F.col("wbatch"))
    return both.select("batch", "texts", "keys", "seg_key", "seg_start", "seg_size", "light", "heavy").mapInArrow(run, ddl)


def deep_nodes(words: np.ndarray, leaves: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """The node at ``depth`` words above each leaf (a start in ``words``), as
    its rank in the order of the suffixes.

    Suffixes are ranked by their first word, then by twice as many words
    each time; ranks keep the order of the words, so leaves of one rank are
    neighbours in the sorted suffixes with ``depth`` words in common, and
    hang below one node.
    """
    rank, width = words.astype(np.int64), 1
    while 2 * width <= depth:
        rank = _joined(rank, width)
        width *= 2
    rest = depth - width
    return _joined(rank, rest)[leaves] if rest else rank[leaves]


def _joined(rank: np.ndarray, step: int) -> np.ndarray:
    """Ranks by what is ranked at a place and at ``step`` places further."""
    span = int(rank.max(initial=0)) + 2
    further = np.zeros(len(rank), np.int64)
    further[:max(0, len(rank) - step)] = rank[step:] + 1
    return np.unique(rank * span + further, return_inverse=True)[1]


def bit_runs(mask: int) -> Iterator[tuple[int, int]]:
    """Lowest bit and length of each run of set bits."""
    at = 0
    while mask:
        zeros = (mask & -mask).bit_length() - 1
        mask >>= zeros
        n = (~mask & (mask + 1)).bit_length() - 1
        yield at + zeros, n
        at, mask = at + zeros + n, mask >> n


def _subtrees(found: DataFrame, buckets: int, depth: int) -> DataFrame:
    """(batch, segs, mask): segments with the windows (bits) that hang below a
    node with another leaf. A bucket holds the groups of many prefixes."""

    def grow(part: pa.Table) -> pa.Table:
        bodies = [b.as_py().split() for b in part.column("body")]
        sizes = np.array([len(b) for b in bodies], np.int64)
        words, _ = numbered([w for b in bodies for w in b])
        n = sizes - depth + 1
        owner = np.repeat(np.arange(len(n)), n)
        window = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        node = deep_nodes(words, np.repeat(np.cumsum(sizes) - sizes, n) + window, depth)
        leaves = np.bincount(node, weights=part.column("n").to_numpy()[owner])
        repeated = leaves[node] > 1
        mask = np.zeros(len(n), np.int64)
        np.bitwise_or.at(mask, owner[repeated], 1 << window[repeated])
        hit = np.flatnonzero(mask)
        return pa.table({"batch": part.column("batch").take(hit), "segs": part.column("segs").take(hit), "mask": pa.array(mask[hit], pa.int64())})

    bucketed = found.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    return bucketed.select("bucket", "body", "batch", "segs", "n").groupBy("bucket").applyInArrow(grow, "batch long, segs binary, mask long")


def remove_repeats(docs: DataFrame, depth: int = DEPTH, prefix: int = PREFIX, id_col: str = "doc_id", text_col: str = "text", batch_words: int = BATCH_WORDS,
                   group_words: int = GROUP_WORDS, bucket_words: int = BUCKET_WORDS) -> DataFrame:
    """doc_id, n_words, n_removed, spans (first and last removed word, counted
    from 0) and kept_text (the other words, joined by a space) per row.

    Null, empty and blank texts have no words. A text shorter than ``depth``
    words keeps all of them. Rows are documents: a repeated row, also one
    with a null or equal id, loses every word if it has a window at all.
    A text of any length is one document of one batch. Other columns, also
    ones with the names used here, are ignored. An empty table gives no rows.
    ``depth`` may be up to ``prefix`` + 61 words.
    """
    if not prefix <= depth <= prefix + 61:
        raise ValueError("depth must lie between prefix and prefix + 61 words")
    spark = docs.sparkSession
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    stored = written(batches_of(given, depth, prefix, batch_words), "batches", "zstd")
    wanted = written(_wanted(stored, group_words), "prefixes", "zstd")
    release_shuffles(spark)
    found = written(_extracted(stored, wanted, depth), "segments", "zstd")
    release_shuffles(spark)
    light = int(wanted.where("not heavy").agg(F.sum("words")).first()[0] or 0)
    same = Window.partitionBy("body")  # a row per batch and place at most
    lone = (found.where("first is not null").withColumn("leaves", F.sum("n").over(same)).where("leaves > 1")
            .select("batch", "segs", F.expr("shiftleft(1L, first)").alias("mask")))
    # as many as the words need, and as a shuffle has partitions
    buckets = max(-(-light // bucket_words), int(spark.conf.get("spark.sql.shuffle.partitions")))
    hits = _subtrees(found.where("first is null"), buckets, depth).unionByName(lone)
    per_batch = written(hits.groupBy("batch").agg(F.collect_list(F.struct("segs", "mask")).alias("hits")).withColumnRenamed("batch", "hbatch"), "hits", "zstd")
    release_shuffles(spark)

    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                        ("spans", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))), ("kept_text", pa.string())])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for doc_ids, texts, seg_start, hits in arrow_rows(batches):
                parts = [t.split() for t in texts]
                stops = np.cumsum([len(p) for p in parts])
                start = np.frombuffer(seg_start, np.int32)
                opened, closed = [], []
                for hit in hits or ():
                    own = start[np.frombuffer(hit["segs"], np.int32)]
                    for first, n in bit_runs(hit["mask"]):
                        opened.append(own + first)
                        closed.append(own + (first + n - 1 + depth))
                size = int(stops[-1]) + 1
                edge = np.zeros(size, np.int64)
                if opened:
                    edge = np.bincount(np.concatenate(opened), minlength=size) - np.bincount(np.concatenate(closed), minlength=size)
                gone = np.cumsum(edge[:-1]) > 0
                for doc_id, words, stop in zip(doc_ids, parts, stops.tolist(), strict=True):
                    own = gone[stop - len(words):stop]
                    n = int(own.sum())
                    if n:
                        turn = np.flatnonzero(np.diff(np.r_[False, own, False]))
                        spans = [{"first": a, "last": b - 1} for a, b in zip(turn[::2].tolist(), turn[1::2].tolist(), strict=True)]
                        words = [words[k] for k in np.flatnonzero(~own).tolist()]
                    yield doc_id, len(own), n, spans if n else [], b" ".join(words).decode("utf-8", "replace")
        return arrow_out(schema, rows(), weight=lambda r: len(r[4]))

    both = stored.select("batch", "doc_ids", "texts", "seg_start").join(per_batch, F.col("batch") == F.col("hbatch"), "left")
    return both.select("doc_ids", "texts", "seg_start", "hits").mapInArrow(
        finish, "doc_id long, n_words long, n_removed long, spans array<struct<first: bigint, last: bigint>>, kept_text string")

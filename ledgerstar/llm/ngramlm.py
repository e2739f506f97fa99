"""Bigram language model in sharded Elias-Fano tries.

p(w | v) = (c(v, w) + MU p(w)) / (c(v) + MU), with p(w) = (c(w) + 0.1) / (N +
0.1 (V + 1)) over the training tokens: Dirichlet smoothing, which needs no
counts of a context but its own. All n-grams are kept, also those seen once.

The model grows with the corpus, so it is never gathered. Documents are cut
into batches of about BATCH_TOKENS tokens, written once, in buckets by batch:
what is later joined to a batch moves to it, not the batch. For every batch,

1. its distinct words are sent to the shards of a hash, which add up the
   training counts and answer with count and id, the more frequent the
   smaller; these are the unigram level;
2. its distinct bigrams of known words are sent to the shards of their
   context, a frequent context being split by the word so that none receives
   more than its share. A shard adds up the training counts, stores the
   quantised c(v, w) / (c(v) + MU) and the back-off weights MU / (c(v) + MU)
   in a trie, and answers each bigram by a search in it;
3. the answers return to the batch, which adds the back-off share and sums up
   by document.

What travels are packed arrays, a row per batch and shard. Words are known by
their 64-bit XXH64: two of a billion distinct words share one with a
probability of about 3 %, and would then be counted as one word.
"""

from __future__ import annotations

import struct
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_out, arrow_rows, release_shuffles, scratch_path
from .eliasfano import Trie, probability, quantise

MU = 20.0
BASE = 0.1
BATCH_TOKENS = 1 << 20
#: Tokens whose bigrams make up a shard, on the average.
SHARD_TOKENS = 1 << 21
#: A context of more tokens than a shard's, divided by this, is split.
SPLIT = 8
#: Spark's limit.
MAX_BUCKETS = 100_000
_FOLD = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
END = xxhash.xxh64_intdigest(b"\n")  # no word holds a line feed
_MIX = np.uint64(0x9E3779B97F4A7C15)


def pack(*arrays: np.ndarray) -> bytes:
    """Unsigned 64-bit numbers, byte plane by byte plane, compressed."""
    out = [struct.pack("<I", len(arrays))]
    for a in arrays:
        width = max(1, (int(a.max(initial=0)).bit_length() + 7) // 8)
        planes = np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
        body = zstandard.ZstdCompressor(level=1).compress(planes.tobytes())
        out.append(struct.pack("<QBQ", len(a), width, len(body)) + body)
    return b"".join(out)


def unpack(raw) -> list[np.ndarray]:
    raw, at, out = memoryview(raw), 4, []
    for _ in range(struct.unpack_from("<I", raw)[0]):
        n, width, size = struct.unpack_from("<QBQ", raw, at)
        planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw[at + 17:at + 17 + size], max_output_size=n * width + 1), np.uint8)
        full = np.zeros((n, 8), np.uint8)
        full[:, :width] = planes.reshape(width, n).T
        out.append(full.view("<u8").ravel())
        at += 17 + size
    return out


def batches_of(docs: DataFrame, batch_tokens: int = BATCH_TOKENS) -> DataFrame:
    """(batch, n_tokens, docs, keys, tokens): batches of whole documents given
    as (doc_id, learn, held_out, text). ``docs`` packs ids, flags (1 learn, 2
    held out, 4 null id) and lengths; ``keys`` the words, ascending."""
    schema = pa.schema([("batch", pa.int64()), ("n_tokens", pa.int64()), ("docs", pa.binary()), ("keys", pa.binary()), ("tokens", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 24

        def finish(k, number, tokens, docs):
            keys = np.fromiter((END if w is None else xxhash.xxh64_intdigest(w) for w in number), np.uint64, len(number))
            order = np.argsort(keys, kind="stable")
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order), dtype=np.uint32)
            ids, flags, sizes = (np.array(x, np.int64) for x in zip(*docs, strict=True))
            # tokens keep the order of first occurrence: frequent words have small numbers
            return first + k, len(tokens), pack(ids.view(np.uint64), flags, sizes), keys[order].tobytes(), pack(rank, np.frombuffer(tokens, np.uint32))

        def rows():
            k, number, tokens, docs = 0, {None: 0}, array("I"), []
            for doc_id, learn, held, text in arrow_rows(batches):
                words = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()
                put = number.setdefault
                tokens.extend([put(w, len(number)) for w in words])
                tokens.append(0)
                docs.append((doc_id or 0, learn + 2 * held + 4 * (doc_id is None), len(words) + 1))
                if len(tokens) >= batch_tokens:
                    yield finish(k, number, tokens, docs)
                    k, number, tokens, docs = k + 1, {None: 0}, array("I"), []
            if docs:
                yield finish(k, number, tokens, docs)

        return arrow_out(schema, rows(), size=1)

    return docs.select("doc_id", "learn", "held_out", "text").mapInArrow(run, "batch long, n_tokens long, docs binary, keys binary, tokens binary")


class _Batch:
    """The arrays of a stored batch."""

    def __init__(self, docs, keys, tokens):
        ids, self.flags, sizes = unpack(docs)
        self.ids, self.sizes, self.keys = ids.view(np.int64), sizes.astype(np.int64), np.frombuffer(keys, "<u8")
        rank, order = unpack(tokens)
        self.tokens = rank.astype(np.int64)[order.astype(np.int64)]
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        self.learn = np.repeat(self.flags & np.uint64(1), self.sizes).astype(bool)

    def bigrams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (context, word), the context of a first word being
        len(keys), and which of them each token is."""
        n = len(self.keys) + 1
        before = np.empty(len(self.tokens), np.int64)
        before[1:] = self.tokens[:-1]
        before[self.starts] = n - 1
        pairs, which = np.unique(before * n + self.tokens, return_inverse=True)
        return pairs // n, pairs % n, which


def _mixed(a: np.ndarray, n: int) -> np.ndarray:
    return ((a.astype(np.uint64) * _MIX) >> np.uint64(32)).astype(np.int64) % n


def _by_shard(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard that occurs, and the places of its members, in order."""
    order = np.argsort(shard, kind="stable")
    cuts = np.flatnonzero(np.diff(shard[order], prepend=-1))
    for a, b in zip(cuts, np.append(cuts[1:], len(order))[:len(cuts)], strict=True):
        yield int(shard[order[a]]), order[a:b]


def _answered(part: pa.Table, blobs: list[bytes], extra: bytes) -> pa.Table:
    """The answers to a shard's batches, and a row without batch for the shard itself."""
    ids = [x.as_py() for x in part.column("batch")]
    shard = part.column("shard")[0].as_py()
    return pa.table({"batch": pa.array([*ids, None], pa.int64()), "shard": pa.array([shard] * (len(ids) + 1), pa.int64()),
                     "answer": pa.array([*blobs, extra], pa.binary())})


_SENT = "shard long, batch long, body binary"
_ANSWER = "batch long, shard long, answer binary"
_SENT_ARROW = pa.schema([("shard", pa.int64()), ("batch", pa.int64()), ("body", pa.binary())])


def _word_counts(stored: DataFrame, shards: int) -> DataFrame:
    """Answers: training counts and ids (0 without a count) of the batch's
    words. A shard's own row holds its tokens, words, and its words' keys."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch, *raw in arrow_rows(batches):
                b = _Batch(*raw)
                counts = np.bincount(b.tokens[b.learn], minlength=len(b.keys))
                for shard, own in _by_shard(_mixed(b.keys, shards)):
                    yield shard, batch, struct.pack("<Q", len(own)) + b.keys[own].tobytes() + pack(counts[own])
        return arrow_out(_SENT_ARROW, rows(), weight=lambda r: len(r[2]))

    def add(part: pa.Table) -> pa.Table:
        keys, counts = [], []
        for body in part.column("body"):
            raw = body.as_py()
            n = struct.unpack_from("<Q", raw)[0]
            keys.append(np.frombuffer(raw, "<u8", n, 8))
            counts.append(unpack(raw[8 + 8 * n:])[0])
        seen, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(place, weights=np.concatenate(counts), minlength=len(seen)).astype(np.int64)
        shard = part.column("shard")[0].as_py()
        ids = np.empty(len(seen), np.int64)
        ids[np.argsort(-total, kind="stable")] = 1 + shard + shards * np.arange(len(seen))
        ids[total == 0] = 0
        ends = np.cumsum([len(k) for k in keys])
        answers = [pack(total[place[e - len(k):e]], ids[place[e - len(k):e]]) for k, e in zip(keys, ends, strict=True)]
        return _answered(part, answers, struct.pack("<QQ", int(total.sum()), int((total > 0).sum())) + seen[np.argsort(-total, kind="stable")].tobytes())

    sent = stored.select("batch", "docs", "keys", "tokens").mapInArrow(send, _SENT)
    return sent.groupBy("shard").applyInArrow(add, _ANSWER)


def _gather(answers: DataFrame) -> DataFrame:
    """(abatch, per_shard): the answers to each batch, by shard."""
    return (answers.where("batch is not null").groupBy("batch").agg(F.sort_array(F.collect_list(F.struct("shard", "answer"))).alias("per_shard"))
            .withColumnRenamed("batch", "abatch"))


def _spread(per_shard: list[dict] | None, shard: np.ndarray, n: int) -> list[np.ndarray]:
    """``n`` arrays of answers, back in the order of what was sent."""
    out = [np.empty(len(shard), "<u8") for _ in range(n)]
    blobs = {r["shard"]: r["answer"] for r in per_shard or ()}
    for s, own in _by_shard(shard):
        for a, got in zip(out, unpack(blobs[s]), strict=True):
            a[own] = got
    return out


class _Pairs:
    """A batch's distinct bigrams with the ids and counts of their words."""

    def __init__(self, b: _Batch, word_answers: list[dict], shards: int, split_tokens: int):
        counts, ids = _spread(word_answers, _mixed(b.keys, shards), 2)
        self.counts = counts.astype(np.int64)
        self.v, self.w, self.which = b.bigrams()
        # a learned text has one start, as it has one end; the start's id is 0
        ends = self.counts[np.searchsorted(b.keys, np.uint64(END))]
        self.context_counts, context_ids = np.append(self.counts, ends), np.append(ids, 0).astype(np.int64)
        sent = np.flatnonzero((self.counts[self.w] > 0) & (self.context_counts[self.v] > 0))
        self.sent = sent[np.argsort(context_ids[self.v[sent]], kind="stable")]  # by context, so in every shard
        v, w = self.v[self.sent], self.w[self.sent]
        self.vid, self.wid, self.vcount = context_ids[v], ids.astype(np.int64)[w], self.context_counts[v]
        parts = -(-self.vcount // split_tokens)
        self.shard = _mixed(self.vid * 1_000_003 + _mixed(self.wid, 1 << 31) % parts, shards)


def _pair_codes(with_words: DataFrame, shards: int, split_tokens: int, mu: float) -> DataFrame:
    """Answers: the codes of the batch's bigrams. A shard's own row is its trie."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch, *raw, word_answers in arrow_rows(batches):
                b = _Batch(*raw)
                p = _Pairs(b, word_answers, shards, split_tokens)
                n = np.bincount(p.which[b.learn], minlength=len(p.v))[p.sent]
                for s, own in _by_shard(p.shard):
                    vid, first, size = np.unique(p.vid[own], return_index=True, return_counts=True)
                    yield s, batch, pack(vid, p.vcount[own][first], size, p.wid[own], n[own])
        return arrow_out(_SENT_ARROW, rows(), weight=lambda r: len(r[2]))

    def score(part: pa.Table) -> pa.Table:
        rows = [unpack(x.as_buffer()) for x in part.column("body")]
        contexts, first, place = np.unique(np.concatenate([r[0] for r in rows]), return_index=True, return_inverse=True)
        counts = np.concatenate([r[1] for r in rows])[first].astype(np.float64)
        v = np.repeat(place, np.concatenate([r[2] for r in rows]).astype(np.int64))
        w, n = (np.concatenate([r[k] for r in rows]).astype(np.int64) for k in (3, 4))
        ends = np.cumsum([len(r[3]) for r in rows])
        learned = n > 0
        key, at = np.unique((v[learned] << 40) | w[learned], return_inverse=True)
        total = np.bincount(at, weights=n[learned], minlength=len(key))
        owner = key >> 40
        trie = Trie.encode(contexts, quantise(np.log10(mu / (counts + mu))), owner, key & ((1 << 40) - 1), quantise(np.log10(total / (counts[owner] + mu))))
        del key, at, owner, total, learned, n
        reader, ids = Trie(trie), contexts.astype(np.int64)
        answers = [pack(reader.codes(ids[v[e - len(r[3]):e]], w[e - len(r[3]):e])) for r, e in zip(rows, ends, strict=True)]
        return _answered(part, answers, trie)

    sent = with_words.select("batch", "docs", "keys", "tokens", "per_shard").mapInArrow(send, _SENT)
    return sent.groupBy("shard").applyInArrow(score, _ANSWER)


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _bucketed(df: DataFrame, buckets: int) -> DataFrame:
    """``df`` as a stored table in buckets by batch: joins on the batch then move the other side only."""
    spark: SparkSession = df.sparkSession
    name = f"lm_batches_{uuid.uuid4().hex}"
    (df.write.option("path", scratch_path(spark, "lm-batches")).option("compression", "zstd")
     .bucketBy(buckets, "batch").format("parquet").saveAsTable(name))
    return spark.table(name)


def score(docs: DataFrame, learn: Column, held_out: Column, mu: float = MU, id_col: str = "doc_id", text_col: str = "text",
          batch_tokens: int = BATCH_TOKENS, shard_tokens: int = SHARD_TOKENS, model: str | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score
    per row. ``learn`` tells the rows to learn from, ``held_out`` is returned.

    Null and empty texts are one end token. If nothing is learned, every
    token has the same probability. Null flags count as false. Every row is a
    document: repeated rows and ids learn and score as often as they are
    given; null ids stay null; other columns are ignored; an empty table gives
    no rows. ``model`` names the folder for the tries (rows without a batch);
    by default it is in the session's shared folder.
    """
    spark = docs.sparkSession
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(learn, F.lit(False)).alias("learn"),
                        F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    # with fewer buckets than a shuffle has partitions, Spark would rather move the batches
    buckets = min(MAX_BUCKETS, max(given.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    stored = _bucketed(batches_of(given, batch_tokens), buckets)
    shards = max(1, -(-int(stored.agg(F.sum("n_tokens")).first()[0] or 0) // shard_tokens))
    split_tokens = max(1, shard_tokens // SPLIT)
    words = _stored(_word_counts(stored, shards), scratch_path(spark, "lm-words"))
    # two numbers per shard
    stats = [struct.unpack("<QQ", r[0]) for r in words.where("batch is null").select(F.substring("answer", 1, 16)).toLocalIterator()]
    n_train, n_vocabulary = sum(s[0] for s in stats), sum(s[1] for s in stats)
    release_shuffles(spark)
    with_words = stored.join(_gather(words), F.col("batch") == F.col("abatch")).drop("abatch")
    pairs = _stored(_pair_codes(with_words, shards, split_tokens, mu), model or scratch_path(spark, "lm-tries"))
    release_shuffles(spark)

    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()),
                        ("base_score", pa.float64()), ("score", pa.float64())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, *raw, word_answers, pair_answers in arrow_rows(batches):
            b = _Batch(*raw)
            p = _Pairs(b, word_answers, shards, split_tokens)
            word = (p.counts + BASE) / (n_train + BASE * (n_vocabulary + 1))
            higher = np.zeros(len(p.v))
            higher[p.sent] = probability(_spread(pair_answers, p.shard, 1)[0])
            log10p = np.log10(higher + mu / (p.context_counts[p.v] + mu) * word[p.w])
            yield pa.RecordBatch.from_arrays([
                pa.array(b.ids, pa.int64(), mask=(b.flags & np.uint64(4)).astype(bool)), pa.array((b.flags & np.uint64(2)).astype(bool)),
                pa.array(b.sizes, pa.int64()), pa.array(np.add.reduceat((p.counts[b.tokens] > 0).astype(np.int64), b.starts)),
                pa.array(np.full(len(b.sizes), n_train, np.int64)), pa.array(np.add.reduceat(np.log10(word)[b.tokens], b.starts)),
                pa.array(np.add.reduceat(log10p[p.which], b.starts))], schema=schema)

    # a batch of unknown words only has no answers to bigrams
    both = with_words.join(_gather(pairs).withColumnRenamed("per_shard", "pair_answers"), F.col("batch") == F.col("abatch"), "left")
    return both.select("batch", "docs", "keys", "tokens", "per_shard", "pair_answers").mapInArrow(
        add, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")

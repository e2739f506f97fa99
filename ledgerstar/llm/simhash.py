"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two 64-bit fingerprints differ in at most ``radius`` bits exactly when some
64-bit word lies within ``radius // 2`` flips of one and within the rest of
the radius of the other. Every distinct fingerprint therefore emits all words
of its ball (its *variants*), the variants are shuffled, and fingerprints
that meet on a variant are linked and verified.

The variants are not shipped one by one. A bucket is the lowest ``k`` bits of
a variant, so the variants of x lie in the buckets that flips of those bits
reach from x: 1 + k + k(k-1)/2 of them for two flips. x is sent once to each
(8 bytes), and the bucket itself builds those variants of x that belong to
it, a part at a time: parts are set by a linear map over GF(2), for which
L(x ^ flips) = L(x) ^ L(flips), so each part is built without the others and
a task's memory does not grow with its bucket's variants. ``k`` grows with
the number of distinct fingerprints.

Members of one variant are linked as a star to one of them, not pairwise:
each of those links is within the radius, and the star connects the same
fingerprints. Components are found by rounds of large-star and small-star
joins, written to the shared folder after each round; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_out, arrow_rows, release_shuffles, written

SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42
#: Buckets have this many bits at least, and more once a bucket would have more variants.
LEAST_BITS = 6
BUCKET_VARIANTS = 1 << 29
#: Variants built at a time (24 bytes each while they are sorted).
PART_VARIANTS = 3_000_000
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_FOLD = bytes.maketrans(_UPPER, _LOWER)
_LANES = np.uint64(0x0101010101010101)


def majority_bits(hashes: np.ndarray) -> int:
    """The 64-bit word whose bit is 1 where over half of ``hashes`` have it."""
    n = len(hashes)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 255):  # a lane of eight bits counts to 255
        part = hashes[at:at + 255]
        for shift in range(8):
            lanes = ((part >> np.uint64(shift)) & _LANES).sum(dtype=np.uint64)
            counts[shift::8] += np.frombuffer(int(lanes).to_bytes(8, "little"), np.uint8)
    bits = np.flatnonzero(2 * counts > n)
    return int(sum(1 << int(b) for b in bits))


def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    """SimHash of the shingles of a text, repeats included; zero without words."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()  # bytes.split: \x20 \x09-\x0D
    if not words:
        return 0
    line = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    last = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b - 1], SEED) for a, b in zip(starts[:n], starts[last:], strict=False)), np.uint64, n)
    return majority_bits(hashes)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text",
                 id_type: str = "long") -> DataFrame:
    """(doc_id, fp) per row; fp is the fingerprint as a signed long, the id a long or a string."""
    schema = pa.schema([("doc_id", pa.int64() if id_type == "long" else pa.string()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for doc_id, text in arrow_rows(batches):
                f = fingerprint(text, shingle)
                yield doc_id, f - (1 << 64) if f >> 63 else f
        return arrow_out(schema, rows())

    return docs.select(F.col(id_col).cast(id_type).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"doc_id {id_type}, fp long")


def ball(flips: int) -> tuple[np.ndarray, np.ndarray]:
    """Masks of up to ``flips`` set bits of 64, and how many each has set."""
    masks, weights = [0], [0]
    level = [(0, -1)]
    for w in range(1, flips + 1):
        level = [(m | 1 << b, b) for m, last in level for b in range(last + 1, 64)]
        masks += [m for m, _ in level]
        weights += [w] * len(level)
    return np.array(masks, np.uint64), np.array(weights, np.int64)


def linear_map(x: np.ndarray, bits: int, part_bits: int) -> np.ndarray:
    """The lowest ``bits`` bits of x, and above them the exclusive or of one
    fixed random word of ``part_bits`` bits per set bit of x."""
    rows = np.random.default_rng(20240229).integers(0, 1 << 62, 64, dtype=np.uint64) & np.uint64((1 << part_bits) - 1)
    out = np.zeros(len(x), np.uint64)
    for b in range(64 if part_bits else 0):
        out ^= ((x >> np.uint64(b)) & np.uint64(1)) * rows[b]
    return ((out << np.uint64(bits)) | (x & np.uint64((1 << bits) - 1))).astype(np.int64)


def bucket_bits(n: int, radius: int, bucket_variants: int = BUCKET_VARIANTS) -> int:
    size = len(ball(radius - radius // 2)[0])
    return max(LEAST_BITS, min(40, int(np.ceil(np.log2(max(1, n * size / bucket_variants))))))


def _emit(bits: int, radius: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, packed fingerprints whose ball touches it)."""
    schema = pa.schema([("bucket", pa.int64()), ("fps", pa.binary())])
    offsets = np.unique(linear_map(ball(radius - radius // 2)[0], bits, 0))
    step = max(1, (1 << 20) // len(offsets))

    def rows():
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for at in range(0, len(fps), step):
                part = fps[at:at + step]
                to = (linear_map(part, bits, 0)[:, None] ^ offsets[None, :]).ravel()
                order = np.argsort(to, kind="stable")
                to, x = to[order], np.repeat(part, len(offsets))[order]
                cuts = np.flatnonzero(np.r_[True, to[1:] != to[:-1]])
                for a, b in zip(cuts, np.r_[cuts[1:], len(to)], strict=True):
                    yield int(to[a]), x[a:b].tobytes()

    return arrow_out(schema, rows(), weight=lambda r: len(r[1]))


def bucket_variants(x: np.ndarray, bucket: int, bits: int, masks: np.ndarray, part_variants: int = PART_VARIANTS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The variants of the fingerprints ``x`` that belong to ``bucket``, part
    by part: the variant, the index of its fingerprint, that of its mask."""
    reached = np.bincount(linear_map(masks, bits, 0))
    near = (x & np.uint64((1 << bits) - 1)).astype(np.int64) ^ bucket
    total = int(reached[near[near < len(reached)]].sum())
    part_bits = max(0, int(np.ceil(np.log2(max(1, total / part_variants)))))
    lm, lx = linear_map(masks, bits, part_bits), linear_map(x, bits, part_bits)
    by_l, order = np.argsort(lm, kind="stable"), np.argsort(lx, kind="stable")
    lm, lx = lm[by_l], lx[order]
    cuts = np.flatnonzero(np.r_[True, lx[1:] != lx[:-1]])
    ends = np.r_[cuts[1:], len(x)]
    for part in range(1 << part_bits):
        want = lx[cuts] ^ (part << bits | bucket)
        low, high = np.searchsorted(lm, want), np.searchsorted(lm, want, side="right")
        v, i, m = [], [], []
        for k in np.flatnonzero(low < high):
            own, flips = order[cuts[k]:ends[k]], by_l[low[k]:high[k]]
            v.append((x[own][:, None] ^ masks[flips][None, :]).ravel())
            i.append(np.repeat(own, len(flips)).astype(np.int32))
            m.append(np.tile(flips, len(own)).astype(np.int32))
        if v:
            yield np.concatenate(v), np.concatenate(i), np.concatenate(m)


def forest(edges: list[tuple[int, int]], parent: dict[int, int]) -> list[tuple[int, int]]:
    """Those of the edges that join two sets not joined by earlier ones;
    ``parent`` remembers the sets."""

    def root(a: int) -> int:
        top = a
        while parent.get(top, top) != top:
            top = parent[top]
        while parent.get(a, a) != top:
            parent[a], a = top, parent[a]
        return top

    kept = []
    for a, b in edges:
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
            kept.append((a, b))
    return kept


def collisions(x: np.ndarray, bucket: int, bits: int, radius: int, part_variants: int = PART_VARIANTS) -> list[tuple[int, int]]:
    """Verified links between fingerprints that meet on a variant of the
    bucket, as a spanning forest."""
    masks, weights = ball(radius - radius // 2)
    found: list[tuple[int, int]] = []
    sets: dict[int, int] = {}
    for v, i, m in bucket_variants(x, bucket, bits, masks, part_variants):
        order = np.argsort(v)
        v = v[order]
        same = v[1:] == v[:-1]
        meets = np.r_[same, False] | np.r_[False, same]
        v, order = v[meets], order[meets]
        if not len(v):
            continue
        i, near = i[order], weights[m[order]] <= radius // 2
        starts = np.flatnonzero(np.r_[True, v[1:] != v[:-1]])
        far = np.int64(len(x))
        head = np.minimum.reduceat(np.where(near, i, far).astype(np.int64), starts)
        heads = np.repeat(head, np.diff(np.r_[starts, len(v)]))
        pick = (heads != far) & (heads != i)
        pairs = np.unique(heads[pick] * len(x) + i[pick])
        a, b = x[pairs // len(x)], x[pairs % len(x)]
        close = np.bitwise_count(a ^ b) <= radius
        found += forest(list(zip(a[close].view(np.int64).tolist(), b[close].view(np.int64).tolist(), strict=True)), sets)
    return found


def link_edges(nodes: DataFrame, radius: int = RADIUS, part_variants: int = PART_VARIANTS) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints of ``nodes.fp``
    within ``radius`` bits; between the same sets as all such pairs."""
    bits = bucket_bits(nodes.count(), radius)
    sent = nodes.select("fp").mapInArrow(lambda it: _emit(bits, radius, it), "bucket long, fps binary")

    def meet(part: pa.Table) -> pa.Table:
        x = np.unique(np.concatenate([np.frombuffer(b.as_buffer(), np.uint64) for b in part.column("fps")]))
        edges = collisions(x, part.column("bucket")[0].as_py(), bits, radius, part_variants)
        a, b = zip(*edges, strict=True) if edges else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return sent.groupBy("bucket").applyInArrow(meet, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): the smallest node of
    its component. Alternates large-star and small-star rounds to a fixed
    point; each round is written, so a lost executor costs one round."""
    spark = edges.sparkSession

    def total(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    def star(sym: DataFrame, large: bool) -> DataFrame:
        # sym: (u, v) in both directions, or from the larger end only
        low = sym.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("lu"), F.least("u", "m").alias("low"))
        moved = sym.join(low, F.col("u") == F.col("lu"))
        if large:
            return moved.where("v > u").select(F.col("v").alias("a"), F.col("low").alias("b"))
        up = low.where("lu != low").select(F.col("lu").alias("a"), F.col("low").alias("b"))
        return moved.where("v != low").select(F.col("v").alias("a"), F.col("low").alias("b")).union(up)

    now = written(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = total(now)
    while before[0]:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = star(both, True).where("a != b").distinct()
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        now = written(star(down, False).where("a != b").distinct(), "links")
        after = total(now)
        release_shuffles(spark)
        if after == before:
            break
        before = after
    roots = now.groupBy("b").agg(F.lit(1)).select(F.col("b").alias("node"), F.col("b").alias("root"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS, radius: int = RADIUS, id_col: str = "doc_id",
                    text_col: str = "text", part_variants: int = PART_VARIANTS) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``.

    Null and empty texts, and texts of white space only, have fingerprint
    zero and link like any other. Repeated rows are returned as often as they
    come. A null id never names a component: component_id is the smallest id
    that is not null, or null if the component has none. Other columns, also
    ones with the names used here, are ignored. An empty table gives no rows.
    """
    fps = written(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    nodes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = written(components(link_edges(nodes, radius, part_variants)), "roots")
    # only fingerprints that have a link need their component's smallest id
    least = (roots.join(nodes, F.col("node") == F.col("fp")).groupBy("root").agg(F.min("least").alias("component"))
             .withColumnRenamed("root", "croot"))
    moved = roots.join(least, F.col("root") == F.col("croot")).select(F.col("node").alias("nfp"), "component")
    named = (nodes.join(moved, F.col("fp") == F.col("nfp"), "left")
             .select(F.col("fp").alias("cfp"), F.when(F.col("nfp").isNull(), F.col("least")).otherwise(F.col("component")).alias("component_id")))
    return fps.join(named, F.col("fp") == F.col("cfp"), "left").select("doc_id", "fp", "component_id")


def representatives(docs: DataFrame, shingle: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, ..) that stay, one of each group of
    near copies: the one with the smallest id, null ids last, of equal ids
    that with the smallest text hash, of equal texts that with the smallest
    hash of the row.

    The columns of ``docs``, of whatever name and type, come back as they are.
    A null text is an empty one. A null id is the largest. Of rows equal in
    every column one stays. Texts of any length are read whole. An empty table
    gives no rows.
    """
    text_hash = F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    # the row travels as one value beside the columns that decide, so no name of the user's can clash with them
    rows = docs.select(whole.alias("row"), F.col("doc_id").cast("long").alias("id"), text_hash.alias("thash"))
    fps = written(fingerprints(docs.select(text_hash.alias("thash"), "text"), shingle, "thash", "text", "string")
                  .select(F.col("doc_id").alias("thash"), "fp").distinct(), "fingerprints")
    nodes = written(fps.select("fp").distinct(), "nodes")
    roots = written(components(link_edges(nodes, radius)), "roots")
    rooted = (fps.join(roots, F.col("fp") == F.col("node"), "left")
              .select(F.col("thash").alias("rhash"), F.coalesce("root", "fp").alias("component")))
    order = F.struct(F.col("id").isNull().alias("a"), F.col("id").alias("b"), F.col("thash").alias("c"))
    best = (rows.select("thash", order.alias("o"))
            .join(rooted, F.col("thash") == F.col("rhash")).groupBy("component").agg(F.min("o").alias("o"))
            .select(F.col("o.b").alias("kept_id"), F.col("o.c").alias("kept_text")))
    kept = rows.join(best, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("thash") == F.col("kept_text")), "left_semi")
    first = Window.partitionBy("id", "thash").orderBy(F.sha2(F.to_json("row"), 256))
    return kept.withColumn("n", F.row_number().over(first)).where("n = 1").select("row.*")


def hex_fingerprint(col: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(col)), 16, "0"))

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerstar.llm import simhash


def plain_fingerprint(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps, radius):
    """Brute force: smallest index reachable over links."""
    label = list(range(len(fps)))
    changed = True
    near = [[j for j in range(len(fps)) if (fps[i] ^ fps[j]).bit_count() <= radius] for i in range(len(fps))]
    while changed:
        changed = False
        for i in range(len(fps)):
            low = min(label[j] for j in near[i])
            if low < label[i]:
                label[i], changed = low, True
    return label


def test_fingerprint_is_the_plain_one(odd_texts):
    for _, text in odd_texts:
        if text is None or len(text) < 50_000:
            assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_spark_hash_is_the_same(spark):
    got = spark.range(1).select(F.xxhash64(F.lit("a b é"))).first()[0]
    assert got % (1 << 64) == xxhash.xxh64_intdigest("a b é".encode(), seed=42)


@pytest.mark.parametrize("radius", [2, 3, 4])
@pytest.mark.parametrize("part_variants", [3_000_000, 5_000])
def test_links_connect_what_brute_force_connects(spark, radius, part_variants):
    r = np.random.default_rng(radius)
    fps = {0, (1 << 64) - 1}
    for _ in range(25):
        x = int(r.integers(0, 1 << 63)) * 2 + 1
        fps.add(x)
        for _ in range(4):
            for b in r.choice(64, r.integers(1, 7), replace=False):
                x ^= 1 << int(b)
            fps.add(x)
    fps = sorted(fps)
    nodes = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    edges = simhash.link_edges(nodes, radius, part_variants)
    assert all(((a ^ b) % (1 << 64)).bit_count() <= radius for a, b in edges.collect())
    found = {n % (1 << 64): root % (1 << 64) for n, root in simhash.components(edges).collect()}
    want = components(fps, radius)
    mine = [found.get(f, f) for f in fps]
    groups = lambda labels: {frozenset(i for i, x in enumerate(labels) if x == y) for y in labels}
    assert groups(mine) == groups(want)


def test_near_duplicates_equal_brute_force(frame, odd_texts):
    rows = [(i + 10, t) for i, t in odd_texts] + [(12, None), (None, "word"), (None, "only without an id, " * 20)]
    got = simhash.near_duplicates(frame(rows)).collect()
    fps = [simhash.fingerprint(t) for _, t in rows]
    label = components(fps, 4)
    least = {}
    for (i, _), c in zip(rows, label):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    want = sorted(((i, f - (1 << 64) if f >> 63 else f, least.get(c)) for (i, _), f, c in zip(rows, fps, label)), key=str)
    assert sorted((tuple(r) for r in got), key=str) == want


def test_empty_table(frame):
    assert simhash.near_duplicates(frame([])).count() == 0


def test_one_row_of_each_group_stays_also_without_an_id(frame):
    a, b, c = (" ".join(f"{x}{k}" for k in range(80)) for x in "abc")
    rows = [(1, a), (1, b), (2, a), (None, c), (None, c), (None, b), (7, a)]
    got = sorted(((r.doc_id, r.text) for r in simhash.representatives(frame(rows), 4, 4).collect()), key=str)
    assert got == sorted([(1, a), (1, b), (None, c)], key=str)
    assert simhash.representatives(frame([]), 4, 4).count() == 0


def test_representatives_keep_every_column(spark):
    a, b = (" ".join(f"{x}{k}" for k in range(80)) for x in "ab")
    rows = [("u0", "h", 5, {"k": 1}, 1, a, "x", 9), ("u1", "h", 5, {"k": 2}, 2, a, "x", 9), ("u2", None, None, None, None, b, None, None), ("u3", "h", 5, {"k": 3}, None, None, "x", 9)]
    docs = spark.createDataFrame(rows, "_id string, _text string, _n int, tags map<string,int>, doc_id long, text string, kept_id string, kept_text int")
    out = simhash.representatives(docs, 4, 4)
    assert out.schema == docs.schema
    assert sorted((r._id, r._text, r._n, r.tags, r.doc_id) for r in out.collect()) == [("u0", "h", 5, {"k": 1}, 1), ("u2", None, None, None, None), ("u3", "h", 5, {"k": 3}, None)]
    twice = spark.createDataFrame([rows[0], rows[0]], docs.schema)
    assert simhash.representatives(twice, 4, 4).count() == 1
    clash = docs.select("doc_id", "text", F.lit(1).alias("row"), F.lit(2).alias("id"), F.lit(3).alias("thash"), F.lit("f").alias("fp"), F.lit(4).alias("a.b"))
    assert {(r.doc_id, r.id, r["a.b"]) for r in simhash.representatives(clash, 4, 4).collect()} == {(1, 2, 4), (None, 2, 4)}

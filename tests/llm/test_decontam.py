import hashlib
import random
import re

import pytest

from ledgerstar.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

UPPER = {c: c - 32 for c in range(97, 123)}


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute_force(docs, items, window=10):
    wins = {}
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            wins.setdefault(tuple(w[k:k + window]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for m in {len(x) for x in wins}:
            for k in range(len(w) - m + 1):
                if tuple(w[k:k + m]) in wins:
                    hit.update(range(k, k + m))
                    found |= wins[tuple(w[k:k + m])] - {None}
        ids = ",".join(sorted(map(str, found)))
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return out


def check(spark, docs, items, **more):
    d = spark.createDataFrame([(t, "x", i, 1, 2) for i, t in docs], "text string, th string, doc_id long, sid long, item_id long")
    b = spark.createDataFrame([(i, t, "y") for i, t in items], "item_id long, text string, window_id string")
    got = [tuple(r) for r in decontam.decontaminate(d, b, **more).collect()]
    assert sorted(got, key=str) == sorted(brute_force(docs, items), key=str)
    return got


@pytest.mark.parametrize("broadcast_rows", [1_000_000, 0])
def test_equals_brute_force(spark, odd_texts, broadcast_rows):
    r = random.Random(3)
    vocabulary = ["the", "of", "Éa", "x1", "straße", "漢", "ÀB"]
    text = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate((10, 11, 25, 40, 9, 10))] + [(6, None), (7, ""), (8, "..."), (None, text(12)), (9, text(15)), (9, text(15))]
    docs = [(i, text(80)) for i in range(40)] + odd_texts[:9]
    docs += [(100 + i, f"{text(5)}, {t.translate(UPPER)}! {text(5)}") for i, (_, t) in enumerate(items) if t]
    docs += [(200, items[2][1]), (200, items[2][1]), (200, "other text"), (None, items[0][1]), (201, " ".join(items[2][1].split()[:9]))]
    got = check(spark, docs, items, broadcast_rows=broadcast_rows)
    assert sum(r[5] for r in got) >= 8


def test_short_items(spark):
    check(spark, [(1, "a b c"), (2, "b"), (3, "c a b"), (4, "b a"), (5, "a b")], [(1, "b"), (2, "a b"), (3, "a b c"), (10, "c A")])


def test_frequent_shingles(spark):
    check(spark, [(i, "a " * 50 + ("b " * 12 if i % 7 == 0 else "")) for i in range(30)], [(1, "a " * 12), (2, "a " * 9 + "b"), (3, "b " * 12), (4, "a " * 9 + "c")])


def test_empty_tables(spark):
    check(spark, [], [(1, "a b c d e f g h i j k")])
    check(spark, [(1, "a b"), (2, None)], [])

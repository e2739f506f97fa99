import random
import re

import numpy as np
import pytest

from ledgerstar.llm import substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(docs, depth):
    split = [(i, WORD.findall(t or "")) for i, t in docs]
    count = {}
    for _, w in split:
        for k in range(len(w) - depth + 1):
            count[tuple(w[k:k + depth])] = count.get(tuple(w[k:k + depth]), 0) + 1
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - depth + 1):
            if count[tuple(w[k:k + depth])] > 1:
                gone.update(range(k, k + depth))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)


def check(spark, docs, depth=35, **more):
    d = spark.createDataFrame([(t, 9, i, "k", 1) for i, t in docs], "text string, batch int, doc_id long, key string, n int")
    rows = substrings.remove_repeats(d, depth=depth, **more).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in rows), key=str) == brute_force(docs, depth)
    assert all(sum(s["last"] - s["first"] + 1 for s in r["spans"]) == r["n_removed"] for r in rows)
    return rows


def corpus(seed, depth):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdeéß漢") for _ in range(r.randint(1, 6))) for _ in range(500)]
    text = lambda n, of=500: " ".join(r.choice(vocabulary[:of]) for _ in range(n))
    shared = [text(n) for n in (depth - 1, depth, depth + 1, 3 * depth)]
    docs = [(k, text(r.randint(0, 4 * depth))) for k in range(40)]
    docs += [(100 + k, f"{text(r.randint(0, 50))} {r.choice(shared)} \n{text(r.randint(0, 50))}") for k in range(60)]
    docs += [(200 + k, text(3 * depth, 2)) for k in range(4)] + [(300, "a " * 200), (301, "a b c " * 100), (302, "a"), (303, None), (304, " \t\x0b\x0c\r\n")]
    near = shared[3].split()
    docs += [(400 + k, " ".join([*near[:k], "x" + str(k), *near[k + 1:]])) for k in range(0, 3 * depth, 3)]
    return [*docs, docs[45], docs[45], (None, docs[50][1]), (None, docs[50][1]), (7, docs[8][1])]


@pytest.mark.parametrize("more", [{}, {"batch_words": 50}, {"group_words": 0}, {"group_words": 500, "batch_words": 300, "bucket_words": 1000}])
def test_equals_brute_force(spark, odd_texts, more):
    rows = check(spark, corpus(3, 35) + [(i + 1000, t) for i, t in odd_texts], **more)
    assert sum(r["n_removed"] > 0 for r in rows) > 60


@pytest.mark.parametrize(("depth", "prefix"), [(8, 8), (9, 8), (5, 2), (16, 4), (64, 8)])
def test_other_depths(spark, depth, prefix):
    check(spark, corpus(5, depth), depth=depth, prefix=prefix, batch_words=400)


def test_empty_table(spark):
    assert check(spark, []) == []
    check(spark, [(1, None), (None, "")])


def test_equal_windows_have_equal_anchors():
    r = np.random.default_rng(1)
    shared = r.integers(0, 1 << 60, 80, dtype=np.uint64)
    words = np.r_[r.integers(0, 1 << 60, 33, dtype=np.uint64), shared, r.integers(0, 1 << 60, 50, dtype=np.uint64), shared]
    key, start, size = substrings.segments(words, np.repeat([163, 243], [163, 80]))
    of = {int(s) + j: int(k) for k, s, n in zip(key, start, size, strict=True) for j in range(n)}
    assert sorted(of) == [*range(163 - 34), *range(163, 243 - 34)]
    assert [of[33 + k] for k in range(80 - 34)] == [of[163 + k] for k in range(80 - 34)]
    assert (size <= 28).all()


def test_nodes_are_equal_passages_in_order():
    words = np.array([3, 1, 2, 1, 2, 1, 2, 9, 1, 2, 1])
    leaves = np.arange(len(words) - 2)
    node = substrings.deep_nodes(words, leaves, 3)
    passages = [tuple(words[k:k + 3]) for k in leaves]
    assert all((node[a] < node[b]) == (passages[a] < passages[b]) and (node[a] == node[b]) == (passages[a] == passages[b]) for a in leaves for b in leaves)

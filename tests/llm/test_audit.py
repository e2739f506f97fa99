import random
import re
from itertools import permutations

import numpy as np

from ledgerstar.llm import audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(docs, labels):
    """docs: (id, text, part); labels: (id, quality, toxic). Applies every order filter by filter."""
    def fails(i, doc):
        d, text, _ = doc
        t = text or ""
        w = WORD.findall(t)
        return {f for f, x in zip("ABCDE", (
            len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), bool(re.search(r"[#$%&*|]", t)),
            d is not None and any(o is not None and o < d and (s or "") == t for o, s, _ in docs)), strict=True) if x}

    failed = [fails(i, d) for i, d in enumerate(docs)]
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    out = {}
    for part in {p or "" for *_, p in docs}:
        own = [k for k, d in enumerate(docs) if (d[2] or "") == part]
        by_filter = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = set(own)
            for step, f in enumerate(order, 1):
                gone = {k for k in left if f in failed[k]}
                early = sum(f in failed[k] for k in own if k not in left)
                left -= gone
                by_filter[f] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), early, sum(failed[k] == {f} for k in own),
                                                   sum(docs[k][0] in good for k in gone), sum(docs[k][0] in toxic for k in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(by_filter[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def check(spark, docs, labels):
    d = spark.createDataFrame([(t, 9, i, p, "m", 1) for i, t, p in docs], "text string, n int, doc_id long, lang string, mask string, good int")
    b = spark.createDataFrame([(9, i, q, t) for i, q, t in labels], "n int, doc_id long, quality int, toxic int")
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in audit.COUNTS) for r in audit.audit(d, b).collect()}
    assert got == brute_force(docs, labels)
    return got


def texts():
    r = random.Random(11)
    vocabulary = ["".join(r.choice("abcdefgéß漢") for _ in range(6)) for _ in range(400)]
    make = lambda n, of: " ".join(r.choice(vocabulary[:of]) for _ in range(n))
    out = [make(n, of) for n in (5, 99, 100, 130, 300) for of in (20, 400) for _ in range(2)]
    return out + [out[-1] + " #", out[4].upper(), "A" * 40 + " x|y", make(120, 400) + "\x0b\x0c*", make(120, 400) + " nb"]


def test_equals_brute_force(spark, odd_texts):
    r = random.Random(1)
    base = texts()
    docs = [(k, r.choice(base), r.choice(["en", "de", None, ""])) for k in range(80)] + [(i + 200, t, "xx") for i, t in odd_texts]
    docs += [(None, base[0], "en"), (None, base[0], "en"), (3, base[1], "en"), (3, base[1], "en"), (3, base[1], "de"), docs[5], docs[5]]
    labels = [(k, r.choice([0, 1, None]), r.choice([0, 1, None])) for k in range(0, 120, 2)] + [(None, 1, 1), (2, 1, 0), (2, 0, 1), (2, None, None)]
    got = check(spark, docs, labels)
    assert len(got) == 600 * len({p for p, *_ in got})
    assert any(v[2] for v in got.values()) and any(v[4] for v in got.values()) and any(v[5] for v in got.values())


def test_many_copies_and_long_text(spark):
    base = texts()
    long = " ".join(f"w{k}" for k in range(60_000))
    check(spark, [(k, base[-1], "en") for k in range(300)] + [(-1, long, "en"), (400, long, "de"), (401, long + " ", "de")], [(7, 1, 1)])


def test_empty_tables(spark):
    assert check(spark, [], [(1, 1, 1)]) == {}
    assert set(check(spark, [(1, None, None), (None, None, None)], [])) == {("", "".join(o), s) for o in permutations("ABCDE") for s in range(1, 6)}


def test_ranks_are_a_min_plus_product():
    names, position = audit.orders("ABC")
    rank = audit.removal_ranks(np.array([[True, False, True], [False, False, False]]), position)
    assert [names[k] for k in range(6) if rank[0, k] == 2] == ["BAC", "BCA"] and (rank[1] == 4).all()

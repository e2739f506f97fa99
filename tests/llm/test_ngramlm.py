import math
import mmap
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerstar.llm import ngramlm
from ledgerstar.llm.eliasfano import MISS, EliasFano, Trie, probability, quantise
from ledgerstar.llm.langid import fold


@pytest.mark.parametrize("n,top", [(0, 1), (1, 5), (10, 10), (1000, 10**6), (5000, 2**62), (70_000, 300), (100_000, 10**12)])
def test_elias_fano(n, top):
    r = np.random.default_rng(n)
    v = np.sort(r.integers(0, top, n).astype(np.uint64))
    e = EliasFano(EliasFano.encode(v))
    assert (e.get(np.arange(n)) == v).all()
    if n:
        q = np.concatenate([r.integers(0, top + 5, 2000).astype(np.uint64), v[:500], v[:500] + np.uint64(1), np.array([2**64 - 1], np.uint64)])
        a = r.integers(0, n, len(q))
        b = np.minimum(n, a + r.integers(0, n + 1, len(q)))
        assert (e.successor(q, a, b) == np.clip(np.searchsorted(v, q), a, b)).all()


def test_trie_from_a_mapped_file(tmp_path):
    r = np.random.default_rng(1)
    contexts = np.unique(r.integers(0, 2**40, 3000))
    m = len(contexts)
    pairs = np.unique(r.integers(0, m * m, 20_000))
    c, s = pairs // m, pairs % m * 7
    code, backoff = quantise(-r.random(len(pairs)) * 5), quantise(-r.random(m))
    (tmp_path / "trie").write_bytes(Trie.encode(contexts, backoff, c, s, code))
    with open(tmp_path / "trie", "rb") as f, mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ) as raw:
        t = Trie(raw)
        assert (t.numbers(contexts) == np.arange(m)).all() and (t.numbers(np.setdiff1d(contexts + 1, contexts)) == -1).all()
        assert (t.backoff == backoff).all()
        v, w = np.concatenate([contexts[c], r.integers(0, 2**40, 500), contexts[r.integers(0, m, 5000)]]), np.concatenate([s, r.integers(0, 7 * m, 5500)])
        stored = dict(zip(zip(contexts[c].tolist(), s.tolist()), code.tolist()))
        assert t.codes(v, w).tolist() == [stored.get(x, MISS) for x in zip(v.tolist(), w.tolist())]
        del t


def test_codes():
    p = np.array([1.0, 0.5, 1e-7, 1e-30])
    assert np.allclose(np.log10(probability(quantise(np.log10(p)))), np.log10(p), atol=0.0003)
    assert probability(np.array([MISS]))[0] == 0


def test_packed_arrays():
    a = [np.array([], np.int64), np.arange(300), np.array([2**63, 1, 0], np.uint64), np.zeros(5, np.int64)]
    assert all((x == y).all() and len(x) == len(y) for x, y in zip(ngramlm.unpack(ngramlm.pack(*a)), a))


def brute_force(rows, learn, mu=ngramlm.MU):
    toks = [((t or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))).split() + [b"\n"]) for _, t in rows]
    u, b = Counter(), Counter()
    for (i, _), w in zip(rows, toks):
        if learn(i):
            u.update(w)
            b.update(zip([b"<s>", *w], w))
    n, v = sum(u.values()), len(u)
    p = lambda w: (u[w] + 0.1) / (n + 0.1 * (v + 1))
    ctx = lambda c: u[b"\n"] if c == b"<s>" else u[c]
    return [(i, len(w), sum(u[x] > 0 for x in w), n, sum(math.log10(p(x)) for x in w),
             sum(math.log10((b[c, x] + mu * p(x)) / (ctx(c) + mu)) for c, x in zip([b"<s>", *w], w))) for (i, _), w in zip(rows, toks)]


@pytest.mark.parametrize("batch_tokens,shard_tokens", [(1 << 20, 1 << 22), (300, 2000)])
def test_score_equals_brute_force(frame, odd_texts, batch_tokens, shard_tokens):
    rows = odd_texts + [(100 + i, "a b a c a b") for i in range(40)] + [(3, "word"), (3, "word"), (None, "a b")]
    part = fold(parts=10)
    got = ngramlm.score(frame(rows), part != 0, part == 0, batch_tokens=batch_tokens, shard_tokens=shard_tokens).collect()
    want = brute_force(rows, lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 != 0)
    key = lambda r: (str(r[0]), r[1], r[2], round(r[-2], 3))
    mine = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got), key=key)
    assert len(mine) == len(want)
    for a, b in zip(mine, sorted(want, key=key)):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4], rel=1e-9)
        assert abs(a[5] - b[5]) <= 0.0006 * a[1] + 1e-9  # codes are rounded
    assert {r.doc_id: r.held_out for r in got}[None] is False


def test_probabilities_of_a_context_sum_to_one(frame):
    rows = [(i, "a b a c b a") for i in range(20)]
    words = ["a", "b", "c"]
    probes = [(1000 + k, f"a {w}") for k, w in enumerate(words)] + [(1003, "a")]
    got = {r.doc_id: r.score for r in ngramlm.score(frame(rows + probes), F.col("doc_id") < 1000, F.col("doc_id") >= 1000).collect()}
    first = got[1003]
    want = brute_force(rows + probes, lambda i: i < 1000)
    assert all(abs(got[i] - s) < 0.002 for i, *_, s in want)
    assert first < 0


def test_a_bigram_model_beats_the_base_on_held_out_text(frame):
    r = np.random.default_rng(0)
    words = [f"w{i}" for i in range(50)]
    after = {w: r.choice(words, 3) for w in words}

    def text():
        w, out = "w0", []
        for _ in range(100):
            w = str(r.choice(after[w]))
            out.append(w)
        return " ".join(out)

    part = fold(parts=10)
    got = ngramlm.score(frame([(i, text()) for i in range(200)]), part != 0, part == 0).where("held_out").collect()
    assert sum(x.score for x in got) > 0.7 * sum(x.base_score for x in got)


def test_nothing_learned_and_empty_table(frame):
    r = ngramlm.score(frame([(1, "a b")]), F.lit(False), F.lit(True)).first()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (3, 0, 0) and r.base_score == pytest.approx(0)
    assert ngramlm.score(frame([]), F.lit(True), F.lit(False)).count() == 0

import os
import random

import numpy as np
import pytest

from ledgerstar.llm import langid
from ledgerstar.llm.common import table

SF = "/root/testdata/sf0.01"


def texts(seed, letters, n):
    r = random.Random(seed)
    words = ["".join(r.choice(letters) for _ in range(r.randint(2, 7))) for _ in range(80)]
    return [" ".join(r.choice(words) for _ in range(60)) for _ in range(n)]


def docs():
    return [(i, t, lang) for lang, letters, first in (("aa", "abcde", 0), ("bb", "stuvw", 100), ("cc", "ébäßk", 200))
            for i, t in enumerate(texts(first, letters, 40), first)]


def test_mixtures_have_their_proportions(frame):
    rows = docs()
    blocks = langid.train(frame(rows))
    a, b, c = (next(t for i, t, lang in rows if lang == x) for x in ("aa", "bb", "cc"))
    half = lambda t: t[:len(t) // 2]
    found = {r.doc_id: r for r in langid.predict(frame([(1, a), (2, f"{a} {half(b)}"), (3, f"{a} {b} {c}")]), blocks).collect()}
    assert found[1].mixture == "aa:1.000" and found[1].score > 0.99
    assert found[2].lang_pred == "aa" and found[2].mixture.count(":") == 2 and 0.55 < found[2].score < 0.75
    assert found[3].mixture.count(":") == 3


def test_em_likelihood_is_the_best_of_a_grid():
    p, n = np.array([[0.9, 0.1], [0.2, 0.8], [0.5, 0.5]]), np.array([5.0, 3.0, 2.0])
    share, like = langid.proportions(p, n, 1000)
    grid = max(float(n @ np.log(p @ np.array([x, 1 - x]))) for x in np.linspace(0, 1, 1001))
    assert abs(share.sum() - 1) < 1e-9 and like >= grid - 1e-3


def test_odd_rows(frame, odd_texts):
    rows = docs() + [(1000 + i, t, None) for i, t in odd_texts] + [(5, "abcde abcde", "aa"), (None, "stuvw", None)]
    got = langid.identify(frame(rows)).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for i, t in odd_texts:
        r = by_id[1000 + i]
        assert (r.lang_pred == "und") == (t is None or not any(c.isalpha() for c in t))
        assert 0 <= r.score <= 1
    assert by_id[None].held_out is False


def test_labels_of_the_held_out_fold_teach_nothing(frame):
    rows = docs()
    wrong = [(i, t, "zz" if langid_fold(i) == 2 else lang) for i, t, lang in rows]
    key = lambda r: (r.doc_id, r.lang_pred, r.score)
    assert sorted(map(key, langid.identify(frame(rows)).collect())) == sorted(map(key, langid.identify(frame(wrong)).collect()))


def langid_fold(i):
    import zlib
    return zlib.crc32(str(i).encode()) % 4


def test_nothing_learned_and_empty(frame):
    assert {r.lang_pred for r in langid.identify(frame([(1, "abc", None)])).collect()} == {"und"}
    assert langid.identify(frame([])).count() == 0


def test_blocks_agree_with_the_whole_model(frame):
    rows = [r for k in range(12) for r in ((100 * k + i, t, f"l{k:02d}") for i, t in enumerate(texts(k, f"{chr(97 + 2 * k)}{chr(98 + 2 * k)}e", 12)))]
    mixed = [(5000 + k, f"{rows[12 * k][1]} {rows[12 * ((k + 5) % 12)][1]}") for k in range(12)] + [(6000, None), (6001, "123"), (None, rows[3][1])]
    whole = langid.train(frame(rows))
    parted = langid.train(frame(rows), most=4)
    assert len(whole) == 1 and len(parted) == 6
    key = lambda r: str(r.doc_id)
    a, b = (sorted(langid.predict(frame(rows + mixed), m).collect(), key=key) for m in (whole, parted))
    assert len(a) == len(b) == len(rows) + len(mixed)
    for x, y in zip(a, b, strict=True):
        assert (x.doc_id, x.lang_pred, sorted(m.split(":")[0] for m in x.mixture.split())) == (y.doc_id, y.lang_pred, sorted(m.split(":")[0] for m in y.mixture.split()))
        assert x.score == pytest.approx(y.score, abs=2e-3)
    assert any(x.mixture.count(":") == 2 for x in a)


def test_more_labels_than_one_block_holds(frame):
    r = random.Random(3)
    rows = [(i, " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(25)), f"x{i:03d}") for i in range(400)]
    blocks = langid.train(frame(rows))
    assert len(blocks) > 1
    got = langid.predict(frame(rows), blocks).collect()
    assert len(got) == 400 and all(x.lang_pred == f"x{x.doc_id:03d}" for x in got)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_held_out_accuracy(spark):
    got = langid.identify(table(spark, SF, "documents")).where("held_out").join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id").collect()
    long = [r for r in got if r.score > 0.9]
    assert sum(r.lang_pred == r.lang for r in got) / len(got) > 0.97
    assert sum(r.lang_pred == r.lang for r in long) / len(long) > 0.99

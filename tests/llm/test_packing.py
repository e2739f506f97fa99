from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerstar.llm import packing
from ledgerstar.llm.tokens import ChunkEncoder

PATHS = {k: public_tokenizers.path(k) for k in ("word_bpe_49k.json", "byte_bpe_50k.json")}
TRICKY = ["a  b", " lead", "trail ", "tab\tnew\n\nline \n x", "nb sp   y", "ctrl\x1c x!\x1f?", "I'm we'll 'S", "<|endoftext|> <|startoftext|>", "é ́x Å",
          "ΣΑΣ İ", "a  b　 c", "\n\n", " ", "12345 6a7 !!?", "漢字 かな", "x\r\ny", "\u0085 a\u0085 b", "word " * 50]


def whole(path, text):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", PATHS)
def test_chunks_equal_whole_texts(name, odd_texts, monkeypatch):
    texts = TRICKY + [t for _, t in odd_texts if t is None or len(t) < 50_000]
    want = [whole(PATHS[name], t) for t in texts]
    e = ChunkEncoder(PATHS[name])
    assert [np.frombuffer(e.ids(t), "<u4").tolist() for t in texts] == want
    monkeypatch.setattr("ledgerstar.llm.tokens.GENERATION", 3)  # memory that is dropped all the time
    small = ChunkEncoder(PATHS[name])
    assert [np.frombuffer(small.ids(t), "<u4").tolist() for t in texts * 2] == want * 2


def test_choice_minimises_the_sum_of_squares():
    r = np.random.default_rng(0)
    levels = packing.Levels(16)
    for _ in range(400):
        size = int(r.integers(1, 16))
        n = levels.count.copy()

        def after(level):
            m = n.copy()
            m[level] -= level > 0
            m[level + size] += 1
            return int((m[1:16] ** 2).sum())

        allowed = [0] + [h for h in range(1, 17 - size) if n[h] > 0]
        assert after(levels.choose(size)) == min(map(after, allowed))
        levels.place(size, size)
        assert all(len(levels.open.get(h, [])) == levels.count[h] for h in range(1, 16))


def test_cut_to_powers():
    pieces = [(1, 5, 0, np.arange(1000)), (2, 5, 7, np.arange(1500))]
    out = packing.cut_to_powers(pieces, 4096)
    assert [sum(len(p[-1]) for p in s) for s in out] == [2048, 256, 128, 64, 4]
    flat = [(p[0], p[2] + i) for s in out for p in s for i in range(len(p[3]))]
    assert flat == [(1, i) for i in range(1000)] + [(2, 7 + i) for i in range(1500)]


def test_partial_windows_are_strung_together():
    windows = [[(1, 9000, 0, np.arange(3000)), (2, 5, 7, np.arange(5))], [(3, 9000, 50, np.arange(2500))], [(4, 1, 0, np.arange(1))]]
    out = list(packing.strung(windows, 1000))
    assert [sum(len(p[-1]) for p in s) for s in out] == [1000] * 5 + [506]
    flat = [(p[0], p[1], p[2] + i, x) for s in out for p in s for i, x in enumerate(p[3].tolist())]
    assert flat == [(*p[:2], p[2] + i, i) for w in windows for p in w for i in range(len(p[3]))]
    assert list(packing.strung([], 1000)) == [] and [len(w) for w in packing.strung([[(1, 1000, 0, np.arange(1000))]], 1000)] == [1]


def check(pieces, rows, path, window):
    want = Counter((i, tuple(whole(path, t) + [2])) for i, t in rows)
    assert all(p.length == len(p.ids) // 4 for p in pieces)
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append(p)
    padding = 0
    for s in sequences.values():
        s.sort(key=lambda p: p.offset)
        assert [p.offset for p in s] == [sum(q.length for q in s[:k]) for k in range(len(s))]
        n = sum(p.length for p in s)
        assert n <= window
        padding += 0 if n & (n - 1) == 0 else window - n
    got, by_doc = Counter(), {}
    for p in pieces:
        by_doc.setdefault((p.doc_id, p.doc_tokens), []).append(p)
    for (i, n), ps in by_doc.items():
        copies = sum(p.start == 0 for p in ps)
        tokens = {}
        for p in ps:
            for k, x in enumerate(np.frombuffer(p.ids, "<u4").tolist()):
                tokens.setdefault(p.start + k, []).append(x)
        assert sorted(tokens) == list(range(n)) and all(len(v) == copies for v in tokens.values())
        if copies == 1:
            got[i, tuple(tokens[k][0] for k in range(n))] += 1
        else:
            assert len({tuple(v) for v in tokens.values() if len(set(v)) > 1}) == 0
            got[i, tuple(tokens[k][0] for k in range(n))] += copies
    assert got == want
    return padding


@pytest.mark.parametrize("window", [64, 4096])
def test_pieces(frame, odd_texts, window):
    rows = odd_texts + [(3, "word"), (3, "word"), (None, "no id here")]
    path = PATHS["word_bpe_49k.json"]
    pieces = packing.pack(frame(rows).coalesce(2), path, 2, window).collect()
    padding = check(pieces, rows, path, window)
    assert padding <= 0.02 * sum(p.length for p in pieces)


def test_empty_table(frame):
    assert packing.pack(frame([]), PATHS["word_bpe_49k.json"], 2).count() == 0


def test_open_windows_of_all_splits_are_packed_together(frame):
    path = PATHS["word_bpe_49k.json"]
    rows = [(i, "word " * (1 + 37 * i % 400)) for i in range(400)]
    pieces = packing.pack(frame(rows).repartition(20), path, 2)
    check(pieces.collect(), rows, path, 4096)
    assert packing.share_outside(pieces) <= 4096 / (sum(len(t) // 5 + 1 for _, t in rows))  # less than one window
    several = packing.pack(frame(rows).repartition(20), path, 2, round_tokens=20_000)  # several tasks, then a last round
    check(several.collect(), rows, path, 4096)

import random
from collections import Counter

import numpy as np

from ledgerstar.llm import quality


def plain(text):
    text = text or ""
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    hit = {j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(hit)


def test_base_counts(odd_texts):
    r = random.Random(2)
    more = [" ".join(r.choice("abc") for _ in range(n)) for n in (4, 5, 6, 30, 500)]
    for text in [t for _, t in odd_texts] + more:
        assert quality.features(text)[:5] == plain(text)


def test_windows_are_exact_with_many_distinct_words():
    ids = np.concatenate([np.arange(9000), np.arange(4000, 4012)])  # 9000 ** 5 does not fit a key
    assert quality.repeated_window_words(ids, 9000) == 24


def test_em_finds_planted_accuracies():
    r = np.random.default_rng(0)
    good = r.random(20_000) < 0.85
    kind = r.integers(0, 4, 20_000)
    votes = np.ones((20_000, 4), int)
    for j in range(4):
        fires = np.where(good, r.random(20_000) < 0.003, (kind == j) & (r.random(20_000) < 0.95))
        votes[:, j] = np.where(fires, -1, np.where(r.random(20_000) < 0.2, 0, 1))
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    share, accuracy, posterior = quality.estimate(patterns, counts.astype(float))
    assert abs(share - 0.85) < 0.03
    assert (accuracy["bad"] > 0.85).all()
    kept = posterior[inverse.ravel()] >= 0.5
    assert (kept == good).mean() > 0.97


def test_no_votes_and_no_documents():
    assert len(quality.estimate(np.zeros((0, 3), int), np.zeros(0))[2]) == 0
    assert quality.estimate(np.zeros((1, 3), int), np.array([5.0]))[2].shape == (1,)


def test_score_on_odd_rows(frame, odd_texts):
    rows = odd_texts + [(3, "word"), (None, None)]
    got = quality.score(frame(rows)).collect()
    assert len(got) == len(rows)
    want = sorted(((i, *plain(t)) for i, t in rows), key=str)
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got), key=str) == want
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_keeps_clean_and_drops_junk(frame):
    r = random.Random(1)
    words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(3, 7))) for _ in range(2000)]
    sentence = lambda: " ".join(r.choice(words) for _ in range(12)).capitalize() + "."
    clean = [(i, "\n".join(sentence() for _ in range(6))) for i in range(300)]
    junk = [(1000 + i, " ".join(w + r.choice(["###", "$$$", "|"]) for w in sentence().split() * 3)) for i in range(20)]
    junk += [(2000 + i, "The " * 60) for i in range(20)] + [(3000 + i, "\n".join(sentence().upper() for _ in range(5))) for i in range(20)]
    got = {x.doc_id: x.kept for x in quality.score(frame(clean + junk)).collect()}
    assert all(got[i] for i, _ in clean)
    assert not any(got[i] for i, _ in junk)


def test_empty_table(frame):
    assert quality.score(frame([])).count() == 0


def test_one_bad_vote_does_not_outweigh_many_good_ones():
    names = [r.name for r in quality.RULES]
    good, code, junk = (np.ones((1, len(names)), int) for _ in range(3))
    code[0, names.index("symbols")] = -1
    junk[0, [names.index("symbols"), names.index("letters")]] = -1
    for share in (50, 200, 500, 2000):
        posterior = quality.estimate(np.vstack([good, code, junk]), np.array([9000.0, share, 300]), kinds=[r.kind for r in quality.RULES])[2]
        assert posterior[0] > 0.9 and posterior[1] > 0.5 and posterior[2] < 0.5


def test_final_marks_of_all_scripts_end_lines():
    text = "\n".join(["a.", "नमस्ते।", "سلام؟", "هذا۔", "完。", "「完」", "ሰላም።", "no", "é", "nor,", "漢"])
    assert quality.features(text)[quality.FEATURES.index("n_ended_lines")] == 7


def test_strewn_symbols_are_not_markdown():
    at = quality.FEATURES.index("n_strewn")
    assert quality.features("word### and,%%% **bold** `a && b` | x | $$y$$ f(**k) <p><b>")[at] == 2

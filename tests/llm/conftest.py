import random

import pytest

SCHEMA = "text string, n_chars long, doc_id long, lang string, source string, fp long, words string, batch long, component_id long"


@pytest.fixture()
def frame(spark):
    """(doc_id, text[, lang]) rows as documents with further columns, some named like the operators' own."""
    def make(rows):
        full = [(r[1], 3, r[0], r[2] if len(r) > 2 else "en", "s", 7, "w", 9, -1) for r in rows]
        return spark.createDataFrame(full, SCHEMA)
    return make


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, one word, symbols, other scripts, line ends, a very long text, and repeats."""
    r = random.Random(5)
    vocabulary = ["".join(r.choice("abcdeéß漢") for _ in range(r.randint(1, 6))) for _ in range(300)]
    long = " ".join(r.choice(vocabulary) for _ in range(40_000))
    some = [" ".join(r.choice(vocabulary[:40]) for _ in range(r.randint(1, 60))) for _ in range(30)]
    texts = [None, "", " \t\n\x0b\x0c\r ", "word", "###$$$|<>", "İSTANBUL ΣΑΣ ÀÉ 漢字", "A\nA\n\nA\nb A", "nb\u00a0sp \u2003em", "1234 567", long,
             long + " x", "x" * 100_000, *some, some[0], some[0] + " tail"]
    return list(enumerate(texts))

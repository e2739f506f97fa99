import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from ledgerstar.llm.tokens import ChunkEncoder, encoded_batches, encoded_rows


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_strings_of_special_tokens_are_the_librarys_ids(name):
    path = public_tokenizers.path(name)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|startoftext|>y  z", "<|ENDOFTEXT|> <|endoftext|", "漢 <|endoftext|>\n\n", "plain words here"]
    plain = Tokenizer.from_file(path)
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(ids, "<u4").tolist() for _, ids in encoded_rows(path, enumerate(texts))] == want


PIECES = [*" '  \n\t\r\x0b\x85\xa0\u2003\u3000\x1cabcstSTZéÉßİıΣσȺ漢かÅ0129²½٣!.,|;#“”…ª", "\u0301", "H\u0331", "'s", "'LL", "'t", "word", "the ", " The", "<|endoftext|>", "👍🏽", "ﬁ"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_batches_equal_the_library(name, monkeypatch):
    monkeypatch.setattr("ledgerstar.llm.tokens.GENERATION", 500)
    monkeypatch.setattr("ledgerstar.llm.tokens.SLICE", 300)
    path, r = public_tokenizers.path(name), random.Random(1)
    texts = [None, ""]
    for _ in range(30):
        some = r.sample(PIECES, r.randint(3, len(PIECES)))
        texts += ["".join(r.choices(some, k=r.randint(0, 40))) for _ in range(60)]
    plain = Tokenizer.from_file(path)
    want = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    batch = pa.RecordBatch.from_pydict({"id": pa.array(range(-3, len(texts))), "text": pa.array(["cut off"] * 3 + texts, pa.string())})
    got = list(encoded_batches(path, [batch.slice(0, 0), batch.slice(3)]))
    assert [i for i, _ in got] == list(range(len(texts)))
    assert [np.frombuffer(ids, "<u4").tolist() for _, ids in got] == want


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_a_word_is_encoded_once_whatever_stands_beside_it(name):
    e = ChunkEncoder(public_tokenizers.path(name))
    model, seen = e.model, []
    e.model = lambda piece: seen.append(piece) or model(piece)
    text = "x" + "".join(f" wordy{mark} wordy\nother{mark} wordy" for mark in (".", ",", "!?", "###", "=", "\n+"))
    for _ in range(2):
        e.ids(text)
    assert sum("wordy" in p for p in seen) == 1 and sum("other" in p for p in seen) == 1

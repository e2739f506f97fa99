import zlib

import numpy as np
import public_tokenizers
import pytest

from ledgerstar.llm import rans
from ledgerstar.llm.tokens import encoded_rows

PATH = public_tokenizers.path("byte_bpe_50k.json")


def sample(n, seed=0):
    return np.minimum(np.random.default_rng(seed).zipf(1.3, n) - 1, 50_000).astype(np.uint32)


@pytest.mark.parametrize("n,lanes,every", [(1, 4, 2), (3, 4, 2), (1000, 4, 3), (5000, 1024, 64), (100_003, 256, 16)])
def test_round_trip(n, lanes, every):
    tokens = sample(n, n)
    ids, counts = np.unique(sample(200_000), return_counts=True)
    table = rans.make_table(ids, counts)
    assert table.freq.sum() == 1 << 16 and table.freq.min() >= 1
    data = rans.encode_block(tokens, [(None, n)], table, lanes, every)
    block = rans.Block(data, table)
    assert (block.tokens() == tokens).all() and block.docs == [(None, n)]
    for k in reversed(range(len(block.marks))):  # any checkpoint can be the first one read
        a = block.marks[k][0] * lanes
        part = rans.Block(data, table).segment(k)
        assert (part == tokens[a:a + len(part)]).all()


@pytest.mark.parametrize("counts", [[1], [5, 0.001], [1e9, 1, 1, 1], [1] * 70_000, [3] * 65_536])
def test_tables_of_any_shape(counts):
    table = rans.make_table(np.arange(len(counts)), np.array(counts, float))
    assert table.freq.sum() == 1 << 16 and table.freq.min() >= 1
    tokens = np.array([0, len(counts) - 1, 0, 99_999], np.uint32)
    assert (rans.Block(rans.encode_block(tokens, [(1, 4)], table, 4, 2), table).tokens() == tokens).all()


def test_size_is_near_the_entropy():
    # states and checkpoints take 6 %, and an escaped token three bytes
    tokens = sample(1 << 18)
    ids, counts = np.unique(tokens, return_counts=True)
    p = counts / counts.sum()
    data = rans.encode_block(tokens, [(1, len(tokens))], rans.make_table(ids, counts))
    assert len(data) < 1.15 * (-(p * np.log2(p)).sum() * len(tokens) / 8)


def test_damage_is_found():
    ids, counts = np.unique(sample(5000), return_counts=True)
    table = rans.make_table(ids, counts)
    data = bytearray(rans.encode_block(sample(5000), [(1, 5000)], table))
    data[len(data) // 2] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        rans.Block(bytes(data), table)


@pytest.mark.parametrize("block_tokens", [50, 1 << 18])
def test_files(spark, frame, odd_texts, block_tokens):
    rows = odd_texts + [(3, "word"), (3, "word"), (None, "no id"), (-5, "negative")]
    folder = rans.new_folder(spark)
    rans.write_tokens(frame(rows).repartition(5), PATH, 0, folder, block_tokens)
    got = sorted(rans.read_tokens(spark, folder).collect(), key=lambda r: r.start)
    want = [(i, bytearray(ids + bytes(4))) for i, ids in encoded_rows(PATH, rows)]
    assert sorted(((r.doc_id, r.ids) for r in got), key=str) == sorted(want, key=str)
    ids = [(r.doc_id is not None, r.doc_id or 0) for r in got]
    assert ids == sorted(ids)
    assert [r.start for r in got] == np.concatenate([[0], np.cumsum([r.n_tokens for r in got])[:-1]]).tolist()
    assert all(r.n_tokens * 4 == len(r.ids) for r in got)
    assert zlib.crc32(got[0].ids) == spark.createDataFrame([(got[0].ids,)], "b binary").selectExpr("crc32(b)").first()[0]


def test_empty_table(spark, frame):
    folder = rans.new_folder(spark)
    rans.write_tokens(frame([]), PATH, 0, folder)
    assert rans.read_tokens(spark, folder).count() == 0

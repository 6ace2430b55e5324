"""Bit-packed token blocks: layout, order, round trip."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tideline.llm import tokens as K

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("bits", [1, 3, 7, 8, 13, 16, 17, 20, 32])
def test_pack_round_trip_and_random_access(bits):
    rng = np.random.default_rng(bits)
    ids = rng.integers(0, 1 << bits, 1001, dtype=np.uint64).astype(np.uint32)
    raw = K.pack(ids, bits)
    assert len(raw) == -(-1001 * bits // 8)
    assert (K.unpack(raw, bits, 0, 1001) == ids).all()
    for a, n in ((0, 1), (1, 5), (500, 501), (1000, 1), (3, 0)):
        assert (K.unpack(raw, bits, a, n) == ids[a:a + n]).all()
    value = int.from_bytes(raw, "little")  # the layout, by definition
    assert [(value >> (i * bits)) & ((1 << bits) - 1) for i in range(50)] == ids[:50].tolist()


def test_bits_for():
    assert [K.bits_for(n) for n in (1, 2, 3, 256, 257, 50257, 65536, 65537)] == [1, 1, 2, 8, 9, 16, 16, 17]


@pytest.mark.parametrize("block", [1, 40, 100_000])
def test_files_read_back_in_id_order(spark, tmp_path, block):
    t = Tokenizer.from_file(PATH)
    texts = {9: "one two", 3: None, 4: "", 1: "x  y\n\nz" * 30, -5: "é日本 😀", 12: "a <|endoftext|> b", 7: "one two"}
    rows = [(i, x, 1) for i, x in texts.items()] + [(9, "one two", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int")
    path = str(tmp_path / "t")
    K.write_tokens(df, path, PATH, end_id=2, shards=3, block_tokens=block)
    blocks = K.read_blocks(spark, path)
    got = sorted(K.read_docs(blocks, keep_ids=True).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [-5, 1, 3, 4, 7, 9, 9, 12]
    at, every = 0, []
    for r in got:
        ids = [*t.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 2]
        raw = np.array(ids, "<u4").tobytes()
        assert (r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) == (at, len(ids), zlib.crc32(raw), raw)
        at += len(ids)
        every += ids
    assert K.read_range(spark, path, 5, 70).tolist() == every[5:75]


def test_empty_table_and_null_id(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string")
    K.write_tokens(df, str(tmp_path / "e"), PATH, end_id=2)
    assert K.read_docs(K.read_blocks(spark, str(tmp_path / "e"))).count() == 0
    df = spark.createDataFrame([(None, "a"), (0, "b")], "doc_id long, text string")
    K.write_tokens(df, str(tmp_path / "n"), PATH)
    got = K.read_docs(K.read_blocks(spark, str(tmp_path / "n"))).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens) for r in got] == [(None, 0, 1), (0, 1, 1)]

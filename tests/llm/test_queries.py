"""The registered queries over a small documents table, against brute force."""

import math
import random
import zlib
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import test_align
import test_decontaminate
import test_minhash
import test_mixing
import test_quality
import test_repeats
import test_setjoin
import tiktoken
from tokenizers import Tokenizer

from tideline.llm import bpe, quality
from tideline.llm.registry import QUERIES, RANKS, TOKENIZER


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    rnd = random.Random(31)
    syl = "th er on an re he in ed nd ha at en es of or nt é ß 日".split()
    prose = lambda n: [("".join(rnd.choices(syl, k=rnd.randint(1, 3)))) for _ in range(n)]
    texts = [prose(rnd.choice([3, 40, 90, 150])) for _ in range(40)]
    texts += [texts[i][:2] + ["Changed"] + texts[i][3:] for i in range(5)] + texts[:3]
    texts += [prose(30) + texts[7] + prose(30), prose(20) + texts[9][:30]]
    item = prose(25)
    texts += [prose(50) + item + prose(9)]
    texts = [rnd.choice([" ", "\n", "  "]).join(t) for t in texts] + [None, "", " \n", "z " * 900]
    rows = [(i * 2, t, "en", "s", None) for i, t in enumerate(texts)]
    d = str(tmp_path_factory.mktemp("sfq"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(4, " ".join(item))], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, [(r[0], r[1]) for r in rows], item


def run(spark, sf, name):
    got = {r.doc_id: r for r in QUERIES[name](spark, sf[0]).collect()}
    assert set(got) == {i for i, _ in sf[1]}
    return got


def test_op1(spark, sf):
    tik = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks=bpe.load_ranks(public_tokenizers.path(RANKS)))
    got = run(spark, sf, "op1_byte_bpe")
    for i, t in sf[1]:
        ids = tik.encode_ordinary(t or "")
        assert tuple(got[i])[1:] == (len(ids), sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                                     sha256((t or "").encode()).hexdigest())


def test_op2(spark, sf):
    got = run(spark, sf, "op2_decontaminate")
    for i, t in sf[1]:
        covered = sum(k for k, _, _ in test_decontaminate.naive_tiles(sf[2], (t or "").lower().split(), 5))
        assert got[i].kept == (2 * covered < len(sf[2])) and (got[i].matched or 0) == covered


def test_op3(spark, sf):
    t = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    got, at = run(spark, sf, "op3_token_blocks"), 0
    for i, text in sorted(sf[1]):
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        assert tuple(got[i])[1:] == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_op5(spark, sf):
    got = run(spark, sf, "op5_minhash")
    assert {i: tuple(r)[1:] for i, r in got.items()} == test_minhash.brute(sf[1], 4)


def test_op6(spark, sf):
    got = run(spark, sf, "op6_quality_rules")
    assert {i: tuple(r)[1:7] for i, r in got.items()} == {i: test_quality.brute(t) for i, t in sf[1]}
    assert {i: r.kept for i, r in got.items()} == {i: not test_quality.brute(t)[-1] and quality.compression((t or "").encode())[3]
                                                   for i, t in sf[1]}


def test_op8(spark, sf):
    got = run(spark, sf, "op8_context_mixing")
    for i, want in test_mixing.brute(sf[1]).items():
        assert tuple(got[i])[1:5] == want[:4] and math.isclose(got[i].base_score, want[4], rel_tol=1e-9)


def test_op10(spark, sf):
    got = run(spark, sf, "op10_suffix_dedup")
    assert {i: tuple(r) for i, r in got.items()} == {r[0]: r[:5] for r in test_repeats.brute(sf[1])}


def test_op11(spark, sf):
    got = run(spark, sf, "op11_ngram_join")
    assert sorted(map(tuple, got.values()), key=str) == test_setjoin.brute(sf[1])


def test_op12(spark, sf):
    got = run(spark, sf, "op12_align_tokens")
    assert sorted(map(tuple, got.values()), key=str) == sorted(test_align.brute(sf[1])[0], key=str)

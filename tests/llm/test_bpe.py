"""Byte-level BPE against tiktoken, and the exact round trip."""

import random
from hashlib import sha256

import public_tokenizers
import pytest
import tiktoken

from tideline.llm import bpe
from tideline.llm.memo import Memo

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def tik():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                             mergeable_ranks=bpe.load_ranks(PATH), special_tokens={})


def odd_texts():
    rnd = random.Random(7)
    al = list("abcdeABC  \n\t'sé日本　 😀123.,!#$<|endoftext|>\x1c\x85 ")
    return (["".join(rnd.choices(al, k=rnd.randint(0, 80))) for _ in range(400)]
            + ["".join(rnd.choices("etaoinsh", k=n)) for n in (2, 63, 64, 65, 66, 300)]
            + ["", " ", "  a", "a  b   c    ", "ab" * 700, "x" * 3000, "\n\n a", "don't we'll 'S", "a \nb"])


def test_segment_trees_agree_with_tiktoken(tik):
    m = bpe.merger(PATH)
    pieces = [p for t in odd_texts() for p in bpe.regex.findall(public_tokenizers.PATTERN, t)]
    want = [tik.encode_ordinary(p) for p in pieces]
    assert m.encode_pieces(pieces) == want
    for p, w in zip(pieces, want):
        if p.encode() not in m.ranks:
            assert m.encode_one(p.encode()) == w


def test_memo_of_any_size_gives_the_same_ids(tik):
    texts = odd_texts()
    for size in (1, 50, 10_000):
        memo = Memo(bpe.piece_encoder(PATH, public_tokenizers.PATTERN), size)
        got = [list(memoryview(x).cast("I")) for x in memo.encode_texts(texts)]
        assert got == [tik.encode_ordinary(t) for t in texts]


def test_frame_with_nulls_repeats_and_clashing_columns(spark, tik):
    texts = [None, "", "one two", "one two", "x" * 5000, *odd_texts()[:50]]
    rows = [(i, t, 1, b"x") for i, t in enumerate(texts)] + [(None, "null id", 2, None), (2, "one two", 3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, ids binary")
    got = bpe.encode_decode(df, PATH, public_tokenizers.PATTERN).collect()
    assert len(got) == len(rows)

    def want(i, t):
        ids = tik.encode_ordinary(t or "")
        return (i, len(ids), sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                sha256((t or "").encode()).hexdigest())

    key = lambda r: (r[0] is not None, r)
    assert sorted(map(tuple, got), key=key) == sorted((want(r[0], r[1]) for r in rows), key=key)
    enc = bpe.encode(df, PATH, public_tokenizers.PATTERN)
    back = {r.doc_id: bytes(r.data) for r in bpe.decode(enc, PATH).collect()}
    assert all(back[i] == (t or "").encode() for i, t, *_ in rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode_decode(df, PATH, public_tokenizers.PATTERN).collect() == []


@pytest.mark.parametrize("pattern", [r"[\s\S]+", r"\p{L}+ |\P{L}+|\p{L}+"])
def test_other_patterns_get_whole_texts(spark, pattern, tmp_path):
    """A rank file in which a letter and the space after it merge: no cut before a space is certain."""
    import base64
    ranks = {bytes([i]): i for i in range(256)} | {b" c": 257, b"e c": 258, b"e ": 259, b"th": 256}
    path = str(tmp_path / "own.tiktoken")
    with open(path, "wb") as f:
        f.write(b"\n".join(base64.b64encode(t) + b" " + str(r).encode() for t, r in ranks.items()))
    texts = ["the cat", "the cat, the cow", "e c\ne c"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lib = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: list(memoryview(bytes(r.ids)).cast("I")) for r in bpe.encode(df, path, pattern).collect()}
    assert got == {i: lib.encode_ordinary(t) for i, t in enumerate(texts)}

"""Token alignment against brute force over whole texts, odd texts, counts over shards."""

import random
from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tideline.llm import align as A

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def whole(text, lib, sp, table):
    """(A tokens, B tokens) as (id, end) over space + text, or None."""
    if not text:
        return None
    raw, sides = (" " + text).encode(), []
    pieces = [sp.id_to_piece(i) for i in sp.encode(text)]
    for ids, tokens in ((lib.encode(" " + text, add_special_tokens=False).ids, None),
                        (sp.encode(text), [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()
                                           for i, p in zip(sp.encode(text), pieces)])):
        tokens = tokens if tokens is not None else [table[i] for i in ids]
        if b"".join(tokens) != raw:
            return None
        sides.append([(i, int(e)) for i, e in zip(ids, np.cumsum([len(t) for t in tokens]))])
    return sides


def brute(rows, links="end"):
    lib, sp = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    lib.encode_special_tokens = True
    byte = A.byte_alphabet()
    table = {i: bytes(byte[c] for c in t) if all(c in byte for c in t) else t.encode() for t, i in lib.get_vocab().items()}
    docs, count = [], Counter()
    for i, t in rows:
        found = whole(t, lib, sp, table)
        if found is None:
            docs.append((i, 0, 0, [], []))
            continue
        a, b = found
        cut = sorted({e for _, e in a} & {e for _, e in b})
        groups = ";".join(",".join(str(x) for x, e in a if lo < e <= hi) + "|" + ",".join(str(x) for x, e in b if lo < e <= hi)
                          for lo, hi in zip([0, *cut], cut))
        begin = lambda s: [0, *[e for _, e in s]]
        pairs = [(x, y) for (x, e), p in zip(a, begin(a)) for (y, f), q in zip(b, begin(b))
                 if (e == f if links == "end" else p < f and q < e)]
        count.update(pairs)
        docs.append((i, len(a), len(b), groups, pairs))
    top = Counter()
    for (x, y), n in count.items():
        top[y] = max(top[y], n)
    return [(i, a, b, g.count(";") + 1 if g else 0, len(p), sum(count[q] == top[q[1]] for q in p), sum(count[q] for q in p),
             sha256(g.encode()).hexdigest() if g else "") for i, a, b, g, p in docs], {(*q, n) for q, n in count.items()}


def check(spark, rows, links="end", **kw):
    df = spark.createDataFrame([(t, i, "x", 1) for i, t in rows], "text string, doc_id long, n_a string, shard int")
    got, counts = A.align(df.repartition(3), *PATHS, links=links, **kw)
    want, pairs = brute(rows, links)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert {(r.a, r.b, r["count"]) for r in counts.collect()} == pairs


ODD = [None, "", " ", "  ", "\n", "a", " a", "a ", " a  b ", "tab\tand\nline\r\n end", "▁mark", "x ▁ y", "<|endoftext|>",
       "<s> </s> <unk> <0x0A>", "naïve café 日本語 テスト", "🙂 🙃🙂 x", "nul\x00byte", "non breaking 　wide", "é ́x",
       "don't we'll I'm", "1234567 89,000.5", "a" * 3000, "word " * 400, "....  ....", "ﬁ ①", "﻿bom", "a b"]


@pytest.mark.parametrize("links", ["end", "overlap"])
def test_odd_texts_match_brute_force(spark, links):
    check(spark, list(enumerate(ODD)), links)


def test_shards_and_repeated_rows(spark):
    rnd = random.Random(12)
    vocab = [w for t in ODD if t for w in t.split()][:30] + ["the", "thing", "unbelievable", "Größe", "x1"]
    rows = [(i, rnd.choice([" ", "  ", "\n"]).join(rnd.choices(vocab, k=rnd.randrange(40)))) for i in range(80)]
    rows += rows[:5] + [(None, "the thing"), (None, "the thing"), (7, "another text of one id")]
    check(spark, rows, shard_bytes=500)


def test_empty_table(spark):
    found, counts = A.align(spark.createDataFrame([], "doc_id long, text string"), *PATHS)
    assert found.collect() == [] and counts.collect() == []


def test_groups_break_where_both_sides_end():
    rng = np.random.default_rng(4)
    for _ in range(50):
        ends = [np.unique(np.append(rng.integers(1, 30, rng.integers(1, 20)), 30)) for _ in "ab"]
        starts = [np.append(0, e[:-1]) for e in ends]
        order, group = A.coalesce(np.concatenate(starts), np.concatenate(ends))
        assert group[-1] + 1 == len(set(ends[0].tolist()) & set(ends[1].tolist()))
        i, j = A.overlaps(starts[0], ends[0], starts[1], ends[1])
        want = [(x, y) for x in range(len(ends[0])) for y in range(len(ends[1]))
                if starts[0][x] < ends[1][y] and starts[1][y] < ends[0][x]]
        assert list(zip(i.tolist(), j.tolist())) == want

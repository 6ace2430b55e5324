"""Quality rules against a plain per-text version, and the compression bands."""

import random
import re
from collections import Counter

import pytest

from tideline.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    t = text or ""
    words = WORD.findall(t)
    win = Counter(zip(words, words[1:], words[2:]))
    marked = {j for i in range(len(words) - 2) if win[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(marked) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(marked), failed)


def texts():
    rnd = random.Random(3)
    vocab = ["the", "The", "é", "日本", "a#b", "|", "x<y>", "long" * 20, "%%", "\x1c", " "]
    prose = lambda n: "".join(rnd.choice(vocab) + rnd.choice([" ", " ", "\n", "\t", " \n\n", "\r\n"]) for _ in range(n))
    uniq = " ".join(f"w{i}" for i in range(60))
    return [None, "", " ", "\n\n", "one", "a b c a b c", "same\nsame\n same\nsame ", uniq, uniq + " " + uniq,
            uniq + " w1 w2 w3", "z " * 3000, "x" * 40_000, *[prose(rnd.randint(0, 200)) for _ in range(60)]]


def test_counts_match_brute_force(spark):
    rows = [(i, t, "kept") for i, t in enumerate(texts())] + [(None, "null id", "x"), (4, "one", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    got = Q.quality(df).collect()
    assert len(got) == len(rows)
    want = sorted(((r[0] if r[0] is not None else -1, *brute(r[1])) for r in rows))
    assert sorted((r[0] if r[0] is not None else -1, *r[1:7]) for r in got) == want
    assert all(not r.kept for r in got if r.base_failed)


def test_bands_reject_repeats_and_noise_but_keep_prose(spark):
    rnd = random.Random(5)
    syl = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()
    lex = ["".join(rnd.choices(syl, k=rnd.randint(1, 4))) for _ in range(3000)]
    prose = " ".join(rnd.choices(lex, k=2000))
    half = prose[:9000] + " " + ("lorem ipsum dolor " * 1300)
    got = {r.doc_id: r for r in Q.quality(spark.createDataFrame(
        [(0, prose), (3, half), (4, prose[:700])], "doc_id long, text string")).collect()}
    assert got[0].kept and got[4].kept
    assert not got[3].kept
    assert Q.compression(("ab " * 4000).encode())[3] is False
    assert Q.compression(random.Random(1).randbytes(9000))[3] is False
    assert Q.compression(b"") == (0.0, 0, 0, True)


@pytest.mark.parametrize("n", [0, 1])
def test_filter_keeps_columns_and_empty_tables(spark, n):
    rows = [(1, " ".join(f"word{i}x{i * i}" for i in range(80)), "a")] * n + [(2, None, "b")] * n
    df = spark.createDataFrame(rows, "doc_id long, text string, ratio string")
    kept = Q.keep_quality(df)
    assert kept.columns == df.columns and [r.doc_id for r in kept.collect()] == [1] * n
    assert Q.quality(df).count() == 2 * n

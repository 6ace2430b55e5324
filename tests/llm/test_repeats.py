"""Removal of repeated byte strings against brute force."""

import random
from hashlib import sha256

import pytest

from tideline.llm import repeats as R


def brute(rows, length=50):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        k = R.LAST if i is None else i
        for p in range(len(b) - length + 1):
            s = b[p:p + length]
            first[s] = min(first.get(s, k), k)
    res = []
    for i, t in rows:
        b = (t or "").encode()
        k = R.LAST if i is None else i
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p:p + length]] < k:
                gone[p:p + length] = b"\1" * length
        spans = sum(1 for j in range(len(b)) if gone[j] and (j == 0 or not gone[j - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        res.append((i, len(b), sum(gone), spans, sha256(kept).hexdigest(), kept))
    return sorted(res, key=str)


def corpus():
    rnd = random.Random(21)
    word = lambda: "".join(rnd.choices("etaoinsrhlé日", k=rnd.randint(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(rnd.choice([6, 9, 10, 12, 40])) for _ in range(12)]
    rows = []
    for i in range(120):
        t = prose(rnd.randint(0, 60))
        for s in rnd.sample(shared, rnd.choice([0, 0, 1, 2])):
            cut = rnd.randrange(max(1, len(s) // 3))
            p = rnd.randrange(len(t) + 1)
            t = t[:p] + s[cut:] + t[p:]
        rows.append((i * 3 - 20, t))
    rows += [(900 + i, rows[i][1]) for i in range(10)]  # exact copies
    rows += [(950, "a" * 300), (951, "a" * 49), (952, "a" * 50), (953, "ab" * 200), (954, "ba" * 60), (955, None), (956, "")]
    rows += [(960, rows[0][1]), (960, rows[3][1] + "tail"), (None, rows[5][1] * 2), (None, rows[5][1] * 2), (900, rows[0][1])]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("flush", [1 << 20, 64])
def test_matches_brute_force(spark, monkeypatch, flush):
    monkeypatch.setattr(R, "FLUSH", flush)
    monkeypatch.setattr(R, "PART_BYTES", 4000)
    rows = corpus()
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, cls int, key string")
    got = sorted((tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in R.remove_repeats(df).collect()), key=str)
    assert got == brute(rows)


def test_long_text_and_empty_table(spark):
    rnd = random.Random(3)
    long = "".join(rnd.choices("abcdefgh ", k=1_500_000))
    rows = [(1, long), (0, long[700_000:700_200] + "zz" * 30), (2, "q" * 10 + long[1_400_000:1_400_100])]
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in R.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: (0, 0), 1: (200, 1), 2: (100, 1)}
    assert R.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("flush", [64, 1000])
def test_different_texts_with_one_key_all_lose_what_an_earlier_one_has(spark, monkeypatch, flush):
    monkeypatch.setattr(R, "FLUSH", flush)
    monkeypatch.setattr(R, "SLICE", 600)
    monkeypatch.setattr(R, "PART_BYTES", 4000)
    rnd = random.Random(8)
    prose = lambda n: "".join(rnd.choices("etaoinsrhl ", k=n))
    rows = []
    for i in range(40):
        p = prose(130)
        rows += [(i, prose(70) + p), (1000 + i, p + prose(70)), (1000 + i, prose(30) + p), (None, p + prose(40)), (None, prose(60) + p)]
    for parts in (1, 4):
        rnd.shuffle(rows)
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        got = sorted((tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in R.remove_repeats(df).collect()), key=str)
        assert got == brute(rows)

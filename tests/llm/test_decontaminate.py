"""Greedy string tiling and benchmark decontamination."""

import random

import numpy as np

from tideline.llm import decontaminate as D


def naive_tiles(p, t, least):
    pm, tm, res = [False] * len(p), [False] * len(t), []
    while True:
        best = (0, 0, 0)
        for i in range(len(p)):
            for j in range(len(t)):
                k = 0
                while i + k < len(p) and j + k < len(t) and p[i + k] == t[j + k] and t[j + k] and not pm[i + k] and not tm[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        if best[0] < least:
            return res
        res.append(best)
        for x in range(best[0]):
            pm[best[1] + x] = tm[best[2] + x] = True


def test_tiles_match_the_naive_algorithm():
    rnd = random.Random(6)
    for trial in range(150):
        p = [rnd.randint(1, 60) for _ in range(rnd.randint(0, 70))]
        t = []
        for _ in range(rnd.randint(0, 5)):
            a = rnd.randint(0, len(p))
            t += p[a:a + rnd.randint(0, 60)] + [0] * rnd.randint(0, 1) + [rnd.randint(1, 60) for _ in range(rnd.randint(0, 6))]
        got, want = D.tiles(p, t, 3), naive_tiles(p, t, 3)
        assert sorted(k for k, _, _ in got) == sorted(k for k, _, _ in want)
        assert all(p[i:i + k] == t[j:j + k] and 0 not in t[j:j + k] for k, i, j in got)
        assert len({x for k, i, _ in got for x in range(i, i + k)}) == sum(k for k, _, _ in got)


def test_finds_copies_reordered_and_partial_items_but_not_clean_texts(spark):
    rnd = random.Random(9)
    words = lambda n, pre: [f"{pre}{rnd.randrange(10**6)}" for _ in range(n)]
    items = {1: words(40, "q"), 2: words(30, "r"), 3: ["short", "item"], 4: words(12, "s")}
    phrase = ["which", "of", "these", "is", "the", "right", "answer"]
    items[5], items[6] = phrase + words(60, "t"), phrase + words(60, "u")
    fill = lambda: words(200, "w")
    w = items[1]
    cases = {
        10: (fill() + w + fill(), 1), 11: (w[20:] + fill() + w[:20], 1),
        12: (w[30:] + fill()[:3] + w[20:30] + fill()[:3] + w[10:20] + fill()[:3] + w[:10], 1),
        13: ([x.upper() for x in w], 1), 14: (fill() + w[:12] + fill(), None), 15: (fill(), None),
        16: ([x for y in w for x in (y, "gap")], None), 17: (fill() + ["short", "item"], None), 18: (items[4][:7] + fill(), 4),
        19: (phrase + fill() + phrase, None), 20: (w + items[2], 1), 21: (w[:4] * 50 + w * 400, 1),
    }
    rows = [(i, "\n".join(x), 0) for i, (x, _) in cases.items()] + [(30, None, 0), (31, "", 0), (None, " ".join(w), 0), (10, " ".join(cases[10][0]), 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(i, " ".join(x), "k") for i, x in items.items()], "item_id long, text string, kept string")
    got = D.contamination(docs, bench).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i, (_, item) in cases.items():
        r = by[i]
        assert r.kept == (item is None), (i, r)
        if item:
            assert r.item_id == item and r.coverage >= 0.5
    assert by[20].n_items == 2 and by[12].n_tiles == 4 and by[12].matched == 40
    assert by[30].kept and by[31].kept and by[30].coverage == 0.0 and not by[None].kept


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    rnd = random.Random(1)
    bench = [(i, " ".join(f"b{rnd.randrange(40)}" for _ in range(20))) for i in range(30)]
    docs = [(i, " ".join(f"b{rnd.randrange(40)}" for _ in range(60)) + (" " + bench[i][1] if i % 3 == 0 else "")) for i in range(30)]
    b = spark.createDataFrame(bench + [(None, "x y z a b c"), (40, None), (3, bench[3][1])], "item_id long, text string")
    d = spark.createDataFrame(docs, "doc_id long, text string")
    want = sorted(map(tuple, D.contamination(d, b).collect()))
    assert [not r[-1] for r in want] == [i % 3 == 0 for i in range(30)]
    monkeypatch.setattr(D, "MAX_BITS", 64)
    assert sorted(map(tuple, D.contamination(d, b).collect())) == want


def test_empty_tables(spark):
    d, b = (spark.createDataFrame([], s) for s in ("doc_id long, text string", "item_id long, text string"))
    assert D.contamination(d, b).collect() == []
    one = spark.createDataFrame([(1, "a b c d e f g")], "doc_id long, text string")
    [r] = D.contamination(one, b).collect()
    assert r.kept and r.n_items == 0
    assert D.may_be(D.bitmap(b.selectExpr("item_id as seed"), 0), np.arange(5, dtype=np.uint64)).sum() == 0


def test_an_item_of_few_different_seeds_is_found(spark):
    odd = [f"x{i}" for i in range(30)]
    items = {1: ["a", "b"] * 30, 2: ["a", "b"] * 30 + odd, 3: ["a", "b"] * 40 + [f"y{i}" for i in range(20)]}
    docs = [(1, " ".join(items[1])), (2, "z " + " ".join(["a", "b"] * 25)), (3, " ".join(odd)), (4, "a b a b a c")]
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in items.items()], "item_id long, text string")
    got = {r.doc_id: r for r in D.contamination(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert got[1].n_items == 3 and got[1].coverage == 1.0 and got[1].item_id == 1
    assert got[2].n_items == 3 and not got[2].kept
    assert got[3].kept and got[4].kept

"""N-gram join against brute force: links of all kinds, hot groups, odd rows."""

import random

import numpy as np
import pytest
from test_minhash import edited, shingle_set

from tideline.llm import setjoin as S


def brute(rows, k=3, percent=90):
    """Components over rows, named by the least id of their rows."""
    sets = [shingle_set(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[find(i)] = min(d, ids.get(find(i), d))
    return sorted([(d, len(sets[i]), ids.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)], key=str)


def check(spark, rows, **kw):
    df = spark.createDataFrame([(t, i, 0, "x") for i, t in rows], "text string, doc_id long, n int, cls string")
    got = S.ngram_join(df.repartition(4), **kw)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, **kw)


def corpus(seed):
    rnd = random.Random(seed)
    fresh = lambda n: [f"w{rnd.randrange(3000)}" for _ in range(n)]
    texts = [None, "", "  \n", "one", "ONE", "one two", "a b c", "a b c", "A b\tc"]
    for _ in range(12):
        base = fresh(rnd.choice([10, 25, 80, 200]))
        texts += [edited(rnd, base, rnd.choice([0, 0, 1, 1, 2, 3])) for _ in range(rnd.choice([2, 6, 9]))]
        texts += [" ".join(base[:-i] + fresh(1)) for i in (1, 2, 4)] + [" ".join(base[:-3])]
    chain = fresh(120)  # each step is close to the last, the ends are not
    for _ in range(12):
        texts.append(" ".join(chain))
        chain = chain[2:] + fresh(2)
    texts += [" ".join(fresh(60)) for _ in range(20)]
    rnd.shuffle(texts)
    return list(enumerate(texts, start=5))


@pytest.mark.parametrize("k, percent", [(3, 90), (2, 70)])
def test_components_match_brute_force(spark, k, percent):
    check(spark, corpus(k), k=k, percent=percent)


def test_small_groups_lose_no_link(spark, monkeypatch):
    """Near copies of one text with few and many edits, in groups of a few texts, dealt over several tasks."""
    monkeypatch.setattr(S, "GROUP_TOKENS", 300)
    monkeypatch.setattr(S, "SALT_QUERIES", 7)
    monkeypatch.setattr(S, "BLOCK", 5)
    rnd = random.Random(4)
    base, passage = [f"b{i}" for i in range(150)], [f"p{i}" for i in range(60)]
    swap = lambda n: [w if rnd.random() > n / 150 else rnd.choice("xyz") for w in base]
    texts = [edited(rnd, base, rnd.choice([0, 1, 2, 3])) for _ in range(50)] + [" ".join(swap(n)) for n in (1, 2, 3, 4) * 12]
    texts += [" ".join(passage + [f"x{rnd.random()}" for _ in range(rnd.choice([3, 40]))]) for _ in range(30)]
    rnd.shuffle(texts)
    check(spark, list(enumerate(texts)))


def test_null_ids_repeats_and_differing_rows(spark):
    t = " ".join(f"w{i}" for i in range(50))
    u = " ".join(f"u{i}" for i in range(50))
    check(spark, [(3, t), (3, t), (None, t), (None, "only null ids"), (9, t + " more"), (7, "q r s t u"), (7, "other text here now"),
                  (None, u), (None, u + " more"), (None, u + " still more"), (8, None), (None, None), (None, "")])
    check(spark, [(None, u), (12, u + " more"), (None, u + " still")])


def test_long_text_and_empty_table(spark):
    assert S.ngram_join(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    long = " ".join(f"w{i}" for i in range(60000))
    check(spark, [(1, long), (2, long + " x"), (3, "x"), (4, long[: len(long) * 3 // 4])])


def test_prefixes_of_linked_sets_share_enough():
    rng = np.random.default_rng(2)
    for _ in range(300):
        n = int(rng.integers(1, 80))
        a = rng.choice(1 << 20, n, replace=False)
        b = np.union1d(a[rng.random(n) > .07], rng.choice(1 << 20, int(rng.integers(0, 4))))
        if 100 * len(np.intersect1d(a, b)) < 90 * len(np.union1d(a, b)):
            continue
        first = [np.sort(x)[:S.prefix(len(x), 90)] for x in (a, b)]
        common = len(np.intersect1d(*first))
        assert all(common >= S.spare(S.need(len(x), 90), 90) for x in (a, b))

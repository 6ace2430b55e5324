"""Near duplicates against brute force, hot buckets, odd rows."""

import random
import re

import numpy as np
import pytest

from tideline.llm import minhash as M
from tideline.llm.components import components

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingle_set(text, k):
    w = [x.lower() for x in WORD.findall((text or "").encode())]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def brute(rows, k, percent=80):
    sets = {i: shingle_set(t, k) for i, t in rows}
    comp = {i: i for i in sets}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                comp[y] = x
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def edited(rnd, words, n):
    w = list(words)
    for _ in range(n):
        w[rnd.randrange(len(w))] = f"new{rnd.random()}"
    return " ".join(w)


def corpus():
    rnd = random.Random(11)
    fresh = lambda n: [f"w{rnd.randrange(5000)}" for _ in range(n)]
    texts = [None, "", "  \n", "one", "ONE", "one two", "a b c", "a b c"]
    for _ in range(12):
        base = fresh(rnd.choice([30, 80, 200]))
        texts += [edited(rnd, base, rnd.choice([0, 0, 1, 2, 4, 8])) for _ in range(rnd.choice([2, 5, 9]))]
    chain = fresh(100)  # each step is close to the last, the ends are not
    for _ in range(10):
        texts.append(" ".join(chain))
        chain = chain[3:] + fresh(3)
    texts += [" ".join(fresh(60)) for _ in range(40)]
    rnd.shuffle(texts)
    return list(enumerate(texts, start=5))


@pytest.mark.parametrize("k", [4, 5])
def test_components_match_brute_force(spark, k):
    rows = corpus()
    df = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id long, text string, cls int, kept string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in M.near_duplicates(df, k=k).collect()}
    assert got == brute(rows, k)


def test_hot_buckets_lose_no_link(spark):
    """Many near copies of one text, many of them too far from the others, and many texts that share half of theirs."""
    rnd = random.Random(4)
    base, passage = [f"b{i}" for i in range(120)], [f"p{i}" for i in range(60)]
    texts = [edited(rnd, base, rnd.choice([1, 2, 3, 4, 6])) for _ in range(60)]
    texts += [" ".join(passage + [f"x{rnd.random()}" for _ in range(40)]) for _ in range(40)]
    texts += [edited(rnd, t.split(), 1) for t in texts[60:70]]
    rnd.shuffle(texts)
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept)
           for r in M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=4).collect()}
    assert got == brute(rows, 4)


def test_null_ids_repeats_and_differing_rows(spark):
    t = " ".join(f"w{i}" for i in range(50))
    rows = [(3, t), (3, t), (None, t), (None, "only null ids"), (9, t + " more"), (7, "q r s t u"), (7, "other text here now")]
    got = sorted((tuple(r) for r in M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=4).collect()),
                 key=str)
    assert got == sorted([(3, 47, 3, True)] * 2 + [(None, 47, 3, False), (None, 1, None, True), (9, 48, 3, False),
                                                   (7, 2, 7, True), (7, 1, 7, True)], key=str)


def test_rows_without_an_id_link_like_others(spark):
    u = [f"u{i}" for i in range(60)]
    rows = [(None, " ".join(u)), (None, " ".join(u + ["x"])), (None, "z"), (12, " ".join(u[1:]))]
    got = M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=4).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, 57, 12, False), (None, 58, 12, False), (None, 1, None, True),
                                                       (12, 56, 12, True)], key=str)


def test_one_row_of_each_group_stays(spark):
    t = " ".join(f"w{i}" for i in range(50))
    u = " ".join(f"u{i}" for i in range(50))
    rows = [(3, t, 0), (3, t, 1), (9, t + " more", 2), (3, t + " x", 3), (None, t, 4), (None, u, 5), (None, u, 6), (None, u + " x", 7),
            (5, None, 8), (5, None, 9), (6, "alone", 10), (6, "alone", 11), (7, "", 12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, key int")
    left = M.drop_near_duplicates(df, k=5)
    assert left.columns == df.columns
    got = [tuple(r) for r in left.collect()]
    assert sorted(k for _, _, k in got if k >= 8) in ([8, 9, 10, 12], [8, 9, 11, 12])
    assert [(i, x) for i, x, k in got if i == 3] in ([(3, t)], [(3, t + " x")])
    assert len([k for _, _, k in got if 5 <= k <= 7]) == 1 and not {2, 4} & {k for _, _, k in got}


def test_empty_table(spark):
    assert M.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_estimate_is_corrected_for_chance(spark):
    rng = np.random.default_rng(1)
    for share in (0.0, 0.5, 0.8, 1.0):
        est = []
        for _ in range(60):
            both = rng.integers(0, 1 << 63, 600, dtype=np.uint64)
            n = round(600 * 2 * share / (1 + share))  # shared items of two sets of 600
            a, b = both, np.concatenate([both[:n], rng.integers(0, 1 << 63, 600 - n, dtype=np.uint64)])
            m = M.minima(np.concatenate([a, b]), np.array([0, 600]))
            est.append([int(x) for x in M.packed(m).ravel()])
        cols = [f"{side}{s}" for side in "ab" for s in M.SIG]
        df = spark.createDataFrame(est, ", ".join(f"{c} long" for c in cols))
        vals = [r[0] for r in df.select(M.estimate("a", "b")).collect()]
        assert abs(sum(vals) / len(vals) - share) < 0.03 and max(abs(v - share) for v in vals) < M.slack(0.5)


def test_components_of_chains_and_hubs(spark):
    rnd = random.Random(8)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, 200 + i) for i in range(50)] + [(7, 7), (3, 2), (2, 3)]
    rnd.shuffle(edges)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 200 for i in [*range(200, 250), 500]}, 2: 2, 3: 2}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_only_texts_of_wanted_classes_reach_the_join_that_fetches_them(spark, monkeypatch):
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choices("abcdefghij", k=6))
    one = [word() for _ in range(60)]
    texts = [" ".join(one), " ".join([*one, word()]), *[" ".join(word() for _ in range(60)) for _ in range(400)]]
    df = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    seen = []
    whole = M.possible
    monkeypatch.setattr(M, "possible", lambda *a: seen.append(whole(*a)) or seen[-1])
    got = {r.doc_id: r.component_id for r in M.near_duplicates(df, k=4).collect()}
    assert got == {0: 0, 1: 0, **{i: i for i in range(2, 402)}}
    [probe] = seen
    passed = {r._id for r in probe.where("_maybe").select("_id").collect()}
    assert {0, 1} <= passed and len(passed) < 100


def test_no_table_is_broadcast_by_the_size_of_its_files(spark):
    sc, store = spark.sparkContext._jsc.sc(), spark._jsparkSession.sharedState().statusStore()

    def executions():
        sc.listenerBus().waitUntilEmpty()
        each = store.executionsList()
        return {each.apply(i).executionId(): each.apply(i).physicalPlanDescription() for i in range(each.size())}

    rnd = random.Random(7)
    base, passage = [f"b{i}" for i in range(120)], [f"p{i}" for i in range(60)]
    texts = [edited(rnd, base, rnd.choice([1, 2, 3, 4, 6])) for _ in range(60)]
    texts += [" ".join(passage + [f"x{rnd.random()}" for _ in range(40)]) for _ in range(40)]
    before = executions()
    out = M.near_duplicates(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string"), k=4)
    out.write.format("noop").mode("overwrite").save()
    tables = []
    for e, plan in executions().items():
        if e in before:
            continue
        lines = plan.split("== Initial Plan ==")[0].split("\n\n")[0].split("\n")  # the tree that ran
        names = [re.sub(r"^[\s:|+\-*]*(\(\d+\))?|\s*\(\d+\).*$", "", x).strip() for x in lines]
        for i, name in enumerate(names):
            if name == "BroadcastExchange":  # a shuffle below it, and its size is known
                below = next(x for x in names[i:] if x.startswith(("Scan", "Exchange", "ShuffleQueryStage", "AQEShuffleRead")))
                tables += [(e, below)] if below.startswith("Scan") else []
    assert tables == []

"""Kneser-Ney byte model against a direct version, and the classifier on odd rows."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F
import pytest

from tideline.llm import kneser as K
from tideline.llm.scratch import Scratch

START, END = 1, 0


def syms(t):
    return [START] * (K.ORDER - 1) + [b + 2 for b in t.encode()] + [END]


def direct(texts):
    """Modified Kneser-Ney, straight from its definition: (p of a symbol after a history)."""
    raw = {k: Counter() for k in range(1, K.ORDER + 1)}
    for t in texts:
        s = syms(t)
        for i in range(K.ORDER - 1, len(s)):
            for k in raw:
                raw[k][tuple(s[i - k + 1:i + 1])] += 1
    adj = {K.ORDER: raw[K.ORDER]}
    for k in range(K.ORDER - 1, 0, -1):
        left = Counter(g[1:] for g in raw[k + 1])
        adj[k] = {g: raw[k][g] if g[0] == START else left[g] for g in raw[k]}
    disc, tot, gam = {}, {}, {}
    for k, a in adj.items():
        d = K.discounts(dict(Counter(a.values())))
        disc[k] = lambda n, d=d: d[min(n, 3) - 1]
        tot[k], gam[k] = Counter(), defaultdict(float)
        for g, n in a.items():
            tot[k][g[:-1]] += n
            gam[k][g[:-1]] += disc[k](n)

    def p(w, h, k=K.ORDER):
        if k == 0:
            return 1 / K.SYMBOLS
        h = h[len(h) - (k - 1):]
        below = p(w, h, k - 1)
        if not tot[k][h]:
            return below
        n = adj[k].get((*h, w), 0)
        return (n - disc[k](n) if n else 0) / tot[k][h] + gam[k][h] / tot[k][h] * below

    return p


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(2)
    return ["", "a", *["".join(rnd.choices("abé c", [6, 3, 1, 2, 1], k=rnd.randint(0, 60))) for _ in range(60)]]


def test_model_matches_the_definition(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    model = K.collected(K.fit(df, Scratch(spark, "t")))
    tables = [(K.Table(a, b, 0.0), K.Table(c, d, 0.0)) for a, b, c, d in model]
    p = direct(texts)
    for t in [*texts[:12], "zzz", "abab never seen", "a" * 50]:
        s = syms(t)
        want = [math.log10(p(s[i], tuple(s[i - K.ORDER + 1:i]))) for i in range(K.ORDER - 1, len(s))]
        data = np.frombuffer(t.encode(), np.uint8)
        got = K.log_probs(tables, *K.symbols(np.array([0, len(data)]), data))
        assert np.allclose(got, want, atol=1e-4)
    h = tuple(syms(texts[5])[8:12])
    assert math.isclose(sum(p(w, h) for w in [END, *range(2, 258)]), 1, rel_tol=1e-9)


def test_table_of_long_keys():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 1 << 45, 5000))
    t = K.Table(keys[::2], np.arange(len(keys[::2]), dtype=np.float32), -1.0)
    v, found = t.get(keys)
    assert (found == (np.arange(len(keys)) % 2 == 0)).all() and (v[::2] == np.arange(len(keys[::2]))).all() and (v[1::2] == -1).all()
    assert not K.Table(np.empty(0, np.int64), np.empty(0, np.float32), 0.0).get(keys)[1].any()


def test_classifier(spark):
    rnd = random.Random(4)
    syl = "th er on an re he in ed nd ha at en es of or nt".split()
    prose = lambda: " ".join("".join(rnd.choices(syl, k=rnd.randint(1, 4))) for _ in range(120))
    rows = [(i, prose(), "en", "x") for i in range(60)]
    junk = [(100 + i, "".join(rnd.choices("#%&QZXJKV0123456789|", k=500)), "en", "x") for i in range(10)]
    odd = [(200, None, "en", "x"), (201, "", "en", "x"), (202, "short", "en", "x"), (203, "Q" * 5000, None, "x"),
           (204, "7" * 500, "xx", "x"), (None, rows[0][1], "en", "x"), (0, rows[0][1], "en", "x"), (205, "#1" * 50_000, "en", "x")]
    df = spark.createDataFrame(rows + junk + odd, "doc_id long, text string, lang string, kept string")
    trusted = spark.createDataFrame([(i,) for i in range(0, 60, 2)] + [(None,), (0,), (999,)], "doc_id long")
    got = K.classify(df, trusted, margin=1.3).collect()
    assert len(got) == len(rows) + len(junk) + len(odd)
    kept = {r.doc_id: r.kept for r in got}
    assert all(kept[i] for i in range(60)) and not any(kept[100 + i] for i in range(10))
    assert [kept[i] for i in (200, 201, 202, 203, 204, None, 205)] == [True] * 6 + [False]


def test_perplexity_threshold_and_verdict_by_the_definition(spark):
    """The whole classifier: which trusted texts are learned from, each kind's threshold, every verdict."""
    rnd = random.Random(21)
    syl = "th er on an re he in ed nd ha at en es of or nt".split()
    prose = lambda n: " ".join("".join(rnd.choices(syl, k=rnd.randint(1, 3))) for _ in range(n))
    rows = [(i, prose(rnd.choice([15, 60])), rnd.choice(["en", "de"])) for i in range(48)]
    rows += [(60 + i, "".join(rnd.choices("#%&QZ019|", k=rnd.choice([90, 260]))), "en") for i in range(6)]
    rows += [(70, None, "en"), (71, "", "de"), (72, prose(50), None), (73, prose(50), "xx")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trusted = [i for i in range(48) if i % 4]
    hashed = {r.id: (r.h, r.half) for r in spark.range(80).selectExpr("id", "xxhash64(id) AS h", "pmod(xxhash64(id, 'half'), 2) AS half").collect()}
    text = {i: (t or "") for i, t, _ in rows}
    learned = sorted((i for i in trusted if hashed[i][1] == 0), key=lambda i: (hashed[i][0], i))[:9]
    p = direct([text[i] for i in learned])

    def perplexity(t):
        s = syms(t)
        logs = [math.log(p(s[i], tuple(s[i - K.ORDER + 1:i]))) for i in range(K.ORDER - 1, len(s))]
        return math.exp(-sum(logs) / len(logs))

    ppl = {i: perplexity(t) for i, t in text.items()}
    kind = {i: (lang, len(text[i].encode()) < K.MIN_BYTES) for i, _, lang in rows}
    limit = {}
    for k in set(kind.values()):
        own = sorted(ppl[i] for i in trusted if hashed[i][1] == 1 and kind[i] == k)
        if own and k[0] is not None:
            limit[k] = own[max(0, math.ceil(0.8 * len(own)) - 1)] * 1.05
    got = {r.doc_id: r for r in K.classify(df, spark.createDataFrame([(i,) for i in trusted], "doc_id long"), quantile=0.8,
                                           margin=1.05, train_rows=9).collect()}
    assert len(got) == len(rows) and {r.kept for r in got.values()} == {True, False}
    for i, t in text.items():
        assert math.isclose(got[i].perplexity, ppl[i], rel_tol=1e-3), i
        want = limit.get(kind[i])
        assert (got[i].threshold is None) == (want is None) and (want is None or math.isclose(got[i].threshold, want, rel_tol=1e-3))
        if want is None or not t:
            assert got[i].kept
        elif abs(ppl[i] / want - 1) > 2e-3:
            assert got[i].kept == (ppl[i] <= want), i


def test_every_trusted_text_of_the_first_half_is_learned_from(spark):
    rnd = random.Random(31)
    texts = {i: "".join(rnd.choices("abcdefgh", k=rnd.randint(2, 9))) for i in range(8500)}
    df = spark.createDataFrame([(i, t, "en") for i, t in texts.items()], "doc_id long, text string, lang string")
    half = [r.id for r in spark.range(8500).where("pmod(xxhash64(id, 'half'), 2) = 0").collect()]
    assert len(half) > 4000
    p = direct([texts[i] for i in half])
    got = {r.doc_id: r.log10_prob for r in K.classify(df, spark.range(8500)).collect()}
    assert len(got) == 8500
    for i in range(0, 8500, 97):
        s = syms(texts[i])
        assert math.isclose(got[i], sum(math.log10(p(s[j], tuple(s[j - K.ORDER + 1:j]))) for j in range(K.ORDER - 1, len(s))), abs_tol=1e-4)


def test_no_trusted_text_and_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long")
    df = spark.createDataFrame([(1, "abc", "en")], "doc_id long, text string, lang string")
    [r] = K.classify(df, none).collect()
    assert r.kept and math.isclose(r.perplexity, K.SYMBOLS, rel_tol=1e-5)
    assert K.classify(df.limit(0), none).collect() == []


def test_a_long_trusted_text_does_not_use_up_the_sample(spark):
    rnd = random.Random(7)
    syl = "th er on an re he in ed nd ha at en es of or nt".split()
    prose = lambda: " ".join("".join(rnd.choices(syl, k=rnd.randint(1, 4))) for _ in range(120))
    rows = [(i, prose(), "en") for i in range(60)] + [(i, prose() * 200, "en") for i in range(500, 530)]
    junk = [(100 + i, "".join(rnd.choices("#%&QZXJKV0123456789|", k=500)), "en") for i in range(5)]
    df = spark.createDataFrame(rows + junk, "doc_id long, text string, lang string")
    trusted = spark.createDataFrame([(i,) for i, _, _ in rows], "doc_id long")
    order = spark.range(530).where("id < 60 or id >= 500").where("pmod(xxhash64(id, 'half'), 2) = 0").orderBy(F.xxhash64("id"))
    ids = [r.id for r in order.collect()]
    assert any(i >= 500 for i in ids[:-1])  # some long text has others after it
    got = {r.doc_id: r for r in K.classify(df, trusted, margin=1.3, train_bytes=100_000).collect()}
    assert not any(got[100 + i].kept for i in range(5)) and all(got[i].kept for i in range(60))
    only = spark.createDataFrame([(i,) for i in range(60)], "doc_id long")  # as if no long text were trusted
    same = {r.doc_id: r.perplexity for r in K.classify(df, only, margin=1.3, train_bytes=100_000).collect()}
    assert all(math.isclose(same[i], got[i].perplexity, rel_tol=1e-6) for i in range(60))


def test_short_texts_have_a_threshold_of_their_own(spark):
    rnd = random.Random(12)
    syl = "th er on an re he in ed nd ha at en es of or nt".split()
    prose = lambda n: " ".join("".join(rnd.choices(syl, k=rnd.randint(1, 4))) for _ in range(n))
    rows = [(i, prose(120 if i % 2 else 20), "en") for i in range(120)]
    junk = [(200 + i, "".join(rnd.choices("#%&QZXJKV0123456789|", k=100)), "en") for i in range(5)]
    df = spark.createDataFrame(rows + junk + [(300, "", "en"), (301, None, "en")], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in K.classify(df, spark.createDataFrame([(i,) for i in range(120)], "doc_id long"), margin=1.3).collect()}
    assert not any(got[200 + i].kept for i in range(5)) and all(got[i].kept for i in [*range(120), 300, 301])
    assert got[0].threshold != got[1].threshold


def test_toxic_documents_are_not_trusted(spark, monkeypatch):
    from tideline.llm import registry
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 1), (3, 0, 0), (4, 0, 1)], "doc_id long, quality int, toxic int")
    monkeypatch.setattr(registry, "load", lambda spark, sf_dir, name: labels)
    monkeypatch.setattr(registry.kneser, "classify", lambda docs, trusted: trusted)
    assert [r.doc_id for r in registry.op7_kneser_ney(spark, "").collect()] == [1]

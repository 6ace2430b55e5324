"""Context mixing: counts against brute force, the mixer against a scalar version, held-out gain."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tideline.llm import mixing as X

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def tokens(text):
    return [w.lower() for w in WORD.findall((text or "").encode())] + [None]


def brute(rows):
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    c = Counter(w for i, t in rows if not held[i] for w in tokens(t))
    n, v = sum(c.values()), len(c)
    return {i: (held[i], len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n,
                sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens(t))) for i, t in rows}


def corpus(n=150):
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(400)]
    after = {w: rnd.sample(vocab, 3) for w in vocab}
    rows = []
    for i in range(n):
        w = rnd.choice(vocab)
        text = []
        for _ in range(rnd.choice([0, 1, 30, 300, 700])):
            w = rnd.choice(after.get(w, vocab)) if rnd.random() < 0.8 else rnd.choice(vocab + [f"odd{rnd.random()}"])
            text.append(w.upper() if rnd.random() < 0.1 else w)
        rows.append((i, rnd.choice([" ", "\n", " \t"]).join(text)))
    return rows + [(n, None), (n + 1, ""), (None, "w1 w2 w1")]


def test_base_columns_and_gain(spark, monkeypatch):
    rows = corpus()
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, score int")
    got = {r.doc_id: r for r in X.score_texts(df).collect()}
    assert len(got) == len(rows)
    for i, (held, n, known, total, base) in brute(rows).items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert r.score < 0 and math.isfinite(r.score)
    out = [r for r in got.values() if r.held_out]
    assert out and sum(r.score for r in out) > sum(r.base_score for r in out)
    monkeypatch.setattr(X, "SHARD_TOKENS", 500)  # other shards and partitions, the same scores
    again = {r.doc_id: r for r in X.score_texts(df.repartition(5)).collect()}
    assert all(math.isclose(again[i].score, got[i].score, rel_tol=1e-6) for i in got)


def test_mixer_matches_a_scalar_version_and_is_a_distribution():
    rng = np.random.default_rng(3)
    guess = rng.normal(0, 2, int(X.BASE[-1])).astype(np.float32)

    def scalar(cls, at):
        w, prev, total = np.full((2 * X.DEPTH, X.N_CTX), 0.35), 0, 0.0
        grid = np.linspace(-X.CLAMP, X.CLAMP, X.MAP_SIZE)
        fine = np.tile(1 / (1 + np.exp(-grid)), (X.DEPTH, 1))
        for t, c in enumerate(cls):
            node = 1
            for d in range(X.DEPTH):
                bit = int(c) >> (X.DEPTH - 1 - d) & 1
                x = np.array([guess[a[t] + node] for a in at], float)
                g = prev * X.DEPTH + d
                dot = float(np.clip(w[g] @ x, -X.CLAMP, X.CLAMP))
                p = 1 / (1 + math.exp(-dot))
                cell = int(np.rint((dot + X.CLAMP) * (X.MAP_SIZE - 1) / (2 * X.CLAMP)))
                q = fine[d, cell]
                fin = (p + q) / 2
                total += math.log10(fin if bit else 1 - fin)
                w[g] += X.RATE * (bit - p) * x
                fine[d, cell] += X.MAP_RATE * (bit - q)
                node = 2 * node + bit
            prev = int(c > 0)
        return total

    cls = rng.integers(0, 20, 60)
    at = X.slots(X.contexts(cls, rng.integers(0, 1 << 16, 60).astype(np.uint16), np.array([0, 25])))
    got = X.mix_segments(guess, cls, at, np.array([0, 25, 40]), np.array([25, 15, 20]))
    for (a, n), g in zip([(0, 25), (25, 15), (40, 20)], got):
        assert math.isclose(g, scalar(cls[a:a + n], [y[a:a + n] for y in at]), rel_tol=1e-3)
    every = [scalar(np.array([c]), [y[:1] for y in at]) for c in range(X.CLASSES)]
    assert math.isclose(sum(10 ** e for e in every), 1, rel_tol=1e-9)


def test_empty_table_and_only_held_out(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert X.score_texts(df).collect() == []
    one = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    [r] = X.score_texts(spark.createDataFrame([(one, "a b")], "doc_id long, text string")).collect()
    assert (r.n_known, r.train_tokens, r.base_score) == (0, 0, 0.0) and math.isfinite(r.score)


def test_words_of_one_class_are_told_apart_by_context(spark, monkeypatch):
    """Words of equal counts in a fixed order: their class says nothing, the words before say all."""
    order = [f"w{i}" for i in range(256)]
    turn = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    rows = [(i, " ".join(order)) for i in range(40)]
    rows += [(1000 + turn[0], " ".join(order)), (1000 + turn[1], " ".join(random.Random(1).sample(order, 256)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    held = F.col("doc_id") >= 1000
    good, bad = sorted(X.score_texts(df, held).where("doc_id >= 1000").collect(), key=lambda r: r.doc_id != 1000 + turn[0])
    assert good.base_score == bad.base_score or math.isclose(good.base_score, bad.base_score)
    assert good.score > 0.3 * bad.score and good.score > -256 * math.log10(256) / 2
    monkeypatch.setattr(X, "HOT_CLASS", 1)  # every context dealt by parts of the code: the same counts
    monkeypatch.setattr(X, "SHARD_TOKENS", 700)
    again = {r.doc_id: r.score for r in X.score_texts(df.repartition(3), held).collect()}
    assert math.isclose(again[good.doc_id], good.score, rel_tol=1e-6)
    assert math.isclose(again[bad.doc_id], bad.score, rel_tol=1e-6)


def test_a_word_is_one_event_of_a_distribution():
    rng = np.random.default_rng(4)
    guess = rng.normal(0, 2, int(X.BASE[-1])).astype(np.float32)
    types = np.zeros(X.CLASSES, np.int64)
    types[[1, 3, 4]] = 11, 1, 300
    bits = X.rank_bits(types)
    assert bits[[0, 1, 3, 4]].tolist() == [0, 4, 0, 9]
    n = 2000
    cls = rng.choice([1, 3, 4], n)
    rank = rng.integers(0, types[cls])
    code = X.codes(cls, rank, bits)
    first = np.array([0])
    ctx, value, kind, _, _, entry, _ = X.entries(code, first, bits, 1, 4)
    count = np.bincount(entry)
    total = 0.0
    for c, r in [(c, r) for c in range(X.CLASSES) for r in range(max(1, int(types[c])))]:
        # the same text, then each word in turn, under the counts of the text
        cl, rk = np.append(cls[:12], c), np.append(rank[:12], r)
        one, val, kd, _, at, _, _ = X.entries(X.codes(cl, rk, bits), first, bits, 1, 4)
        inv, told, size, flat = X.along(np.concatenate([value, val]), np.concatenate([ctx, one]), np.concatenate([kind, kd]),
                                        np.concatenate([count, np.zeros(len(one))]), bits)
        e = inv[len(ctx):]
        start = np.cumsum(size) - size
        flat = X.whole(val, kd, bits, told[e], size[e], np.concatenate([flat[start[i]:start[i] + size[i]] for i in e]))
        lo, hi = X.reach(val, kd, bits)
        begin = np.append(np.cumsum(hi - lo) - hi, len(flat))[at]
        flat = np.concatenate([flat, np.zeros(64, np.float16)])
        more = X.slots(X.contexts(cl, np.zeros(13, np.uint16), first))
        words = (rk, bits[cl], np.maximum(types, 1)[cl], flat, begin)
        whole, but = (X.mix_segments(guess, cl, more, first, np.array([k]), words)[0] for k in (13, 12))
        total += 10 ** (whole - but)
    assert math.isclose(total, 1, rel_tol=1e-3)


def test_what_comes_back_of_whole_word_contexts_is_small(spark, monkeypatch):
    """Answers to shards: counts, each once, not a prediction for every bit of every entry."""
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    rows = [(i, " ".join(words[int(3000 * rnd.random() ** 3)] for _ in range(400))) for i in range(100)]
    seen, guesses = [], X.word_guesses

    def kept(*args):
        seen.append(guesses(*args))
        return seen[0]

    monkeypatch.setattr(X, "SHARD_TOKENS", 8000)
    monkeypatch.setattr(X, "word_guesses", kept)
    assert len(X.score_texts(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()) == 100
    sizes = [F.coalesce(F.length(c), F.lit(0)) for c, kind in seen[0].dtypes if kind == "binary"]
    total = seen[0].select(F.sum(sum(sizes, F.lit(0)))).first()[0]
    assert 0 < total < 3.5 * 100 * 401  # 7.0 as predictions


def test_counts_of_a_shared_beginning_are_sent_once():
    rng = np.random.default_rng(9)
    bits = np.zeros(X.CLASSES, np.int64)
    bits[[2, 5]] = 6, 9
    cls = rng.choice([2, 5], 4000)
    code = np.unique(X.codes(cls, rng.integers(0, 1 << bits[cls]), bits))
    ctx = np.sort(rng.integers(0, 40, len(code)).astype(np.uint64))
    count = rng.integers(0, 900, len(code))
    kind = np.zeros(len(code), np.uint8)
    inv, total, size, other = X.along(code, ctx, kind, count, bits)
    assert inv.tolist() == list(range(len(code))) and total.tolist() == count.tolist()
    order, new = X.sent(ctx, code, X.reach(code, kind, bits)[0], size)
    few, more = X.small(other[order[new]])
    back = np.empty(len(other), np.int64)
    back[order] = X.grown(few, more)[np.cumsum(new) - 1]
    assert back.tolist() == other.tolist() and new.sum() < 0.7 * len(new)
    e = 0
    for c, k, n, m in zip(ctx, code, count, size):  # each count, by hand
        for d in range(int(m)):
            shift = np.uint64(X.DEPTH + X.RANK_BITS - 1 - d)
            same = (ctx == c) & (code >> (shift + np.uint64(1)) == k >> (shift + np.uint64(1)))
            assert other[e] == count[same & (code >> shift != k >> shift)].sum()
            e += 1


def test_context_keys_differ_for_different_pairs():
    a, b = np.meshgrid(np.arange(64, dtype=np.uint64), np.arange(64, dtype=np.uint64))
    key = X.context_keys(a.ravel(), b.ravel(), 6)
    assert len(np.unique(key)) == 64 * 64 and int((key & np.uint64((1 << 52) - 1)).max()) == 0

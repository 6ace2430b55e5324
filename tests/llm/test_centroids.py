"""Centroid clustering against exact brute force, odd rows, ties."""

import math
import random
from hashlib import sha256

import numpy as np
import pytest

from tideline.llm import centroids as C


def brute(rows, k, rounds=5, dims=64, scale=256, seed=2):
    vecs = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
            and all(abs(math.floor(scale * x)) < C.component_limit(dims) for x in v)]
    order = sorted((sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in vecs if i is not None)
    cent = [v for _, v in order[:k]]
    if not cent:
        return []

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cent))

    for _ in range(rounds):
        of = [near(v)[1] for _, v in vecs]
        for j in range(len(cent)):
            own = [v for (_, v), o in zip(vecs, of) if o == j]
            if own:
                cent[j] = [sum(col) // len(own) for col in zip(*own)]
    found = [(i, *near(v)) for i, v in vecs]
    total = {j: sum(d for _, d, o in found if o == j) for j in range(len(cent))}
    return [(i, j, d, total[j], sum(total.values()), sha256(",".join(map(str, cent[j])).encode()).hexdigest())
            for i, d, j in found]


def check(spark, rows, **kw):
    df = spark.createDataFrame([(v, i, 1, 2) for i, v in rows], "embedding array<double>, vec_id long, cluster int, distance int")
    got = sorted((tuple(r) for r in C.cluster(df.repartition(3), **kw).collect()), key=str)
    assert got == sorted(brute(rows, **kw), key=str)


def test_matches_brute_force(spark):
    rnd = random.Random(5)
    hubs = [[rnd.gauss(0, 1) for _ in range(8)] for _ in range(6)]
    rows = [(i, [x + rnd.gauss(0, .3) for x in rnd.choice(hubs)]) for i in range(300)]
    check(spark, rows, k=7, dims=8)


def test_odd_rows_ties_and_repeats(spark):
    rnd = random.Random(6)
    rows = [(i, [float(rnd.randrange(-2, 3)) / 256 for _ in range(3)]) for i in range(80)]  # many equal distances
    rows += rows[:9] + [(3, [0.5, 0.5, 0.5]), (None, [0.1, 0.2, 0.3]), (None, [0.1, 0.2, 0.3])]
    rows += [(200, None), (201, []), (202, [1.0, 2.0]), (203, [1.0, 2.0, 3.0, 4.0]), (204, [1.0, None, 2.0]),
             (205, [1.0, float("nan"), 2.0]), (206, [float("inf"), 0.0, 0.0]), (207, [1e300, 0.0, 0.0]),
             (208, [1e6, -1e6, 1e6]), (209, [-1e6, 1e6, -1e6])]
    check(spark, rows, k=9, dims=3)


@pytest.mark.parametrize("rows", [[], [(None, [1.0, 2.0])], [(4, [1.0, 2.0])], [(4, [1.0, 2.0]), (5, [1.0, 2.0])]])
def test_few_rows(spark, rows):
    check(spark, rows, k=3, dims=2)


def test_bisectors_prefer_the_smaller_number():
    rng = np.random.default_rng(3)
    c, x = rng.integers(-3, 4, (12, 4)), rng.integers(-4, 5, (500, 4))
    c[7] = c[2]
    want = ((x[:, None, :] - c[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (C.Bisectors(c).nearest(x) == want).all()
    edge = C.component_limit(64) - 1
    far = np.array([[edge] * 64, [-edge] * 64], np.int64)
    assert C.Bisectors(far).nearest(far).tolist() == [0, 1]
    assert C.Bisectors(far).distance(far, np.array([1, 0])).tolist() == [64 * (2 * edge) ** 2] * 2

import math
import random

import numpy as np
import pytest

from tessera.llm import embedding_dedup as V

from .helpers import components

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, threshold):
    def usable(v):
        return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    ok = [(i, np.array(v, np.float32).astype(float), k) for i, v, k in rows if i is not None and k is not None and usable(v)]
    linked = [(a, b) for n, (a, v, k) in enumerate(ok) for b, w, m in ok[n + 1:]
              if k == m and len(v) == len(w) and v @ w / math.sqrt((v @ v) * (w @ w)) >= threshold]
    comp = components({i for i, _, _ in rows if i is not None}, linked)
    n = {i: 0 for i in comp}
    for a, b in linked:
        n[a] += 1
        n[b] += 1
    return {(i, n[i], comp[i], comp[i] == i) for i in comp}


def vectors(seed=1, groups=14, dim=12):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        centre = rng.normal(size=dim)
        for _ in range(int(rng.integers(3, 22))):
            v = centre + rng.normal(size=dim) * rng.choice([0, 0.05, 0.12, 0.2])
            rows.append([float(np.float32(x)) for x in v * rng.choice([1, 3, 1e-20, 1e18])])
    labels = [int(rng.integers(0, 2)) for _ in rows]
    return [(i * 2 + 1, v, k) for i, (v, k) in enumerate(zip(rows, labels))]


def odd(dim=12):
    return [(500_000, None, 1), (500_001, [], 1), (500_002, [0.0] * dim, 1), (500_003, [1.0] * (dim - 1) + [None], 1),
            (500_004, [1.0] * (dim - 1) + [float("nan")], 1), (500_005, [float("inf")] * dim, 1), (500_006, [1.0] * dim, None),
            (500_007, [1.0] * dim, None), (500_008, [1.0] * 5, 1), (500_009, [2.0] * 5, 1), (500_010, [-0.0] * dim, 1)]


@pytest.mark.parametrize("block", [V.BLOCK, 8])
def test_brute_force(spark, block):
    rows = vectors() + odd()
    got = {tuple(r) for r in V.embedding_dedup(spark.createDataFrame(rows, SCHEMA), block=block).collect()}
    assert got == brute(rows, 0.98)


def test_copies_and_a_hot_group(spark):
    rng = random.Random(2)
    v = [rng.gauss(0, 1) for _ in range(8)]
    rows = [(i, v, 1) for i in range(300)] + [(300 + i, [x + rng.gauss(0, 0.01) for x in v], 1) for i in range(60)]
    got = {tuple(r) for r in V.embedding_dedup(spark.createDataFrame(rows, SCHEMA), block=16).collect()}
    assert got == brute(rows, 0.98)


def test_edges(spark):
    assert V.embedding_dedup(spark.createDataFrame([], SCHEMA)).count() == 0
    schema = "vec_id bigint, embedding array<double>, label string, rep int, n int, cell int, home int"
    rows = [(None, [1.0, 0.0], "a", 0, 0, 0, 0), (4, [1.0, 0.0], "a", 0, 0, 0, 0), (4, [1.0, 0.0], "a", 0, 0, 0, 0), (9, [1e200, 1.0], "a", 0, 0, 0, 0)]
    got = sorted((tuple(r) for r in V.embedding_dedup(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert got == sorted([(None, 0, None, False), (4, 2, 4, True), (4, 2, 4, True), (9, 2, 4, False)], key=str)

import hashlib
import math
import random

import numpy as np
import pytest

from tests.llm.sqlcheck import same_as_sql
from tidewatch.llm import centroid_clusters as cc

SF = "/root/testdata/sf0.001"


def brute(rows, k, rounds):
    kept = [(i, [max(-cc.LIMIT, min(cc.LIMIT, math.floor(1024 * x))) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    cents = [v for _, v in start[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cents)) for _, v in kept]

    for _ in range(rounds):
        found = assign()
        for n in range(len(cents)):
            own = [v for (_, v), (_, c) in zip(kept, found) if c == n]
            if own:
                cents[n] = [sum(x) // len(own) for x in zip(*own)]
    found = assign()
    own = [sum(d for d, c in found if c == n) for n in range(len(cents))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return [(i, c, d, own[c], sum(own), sha[c]) for (i, _), (d, c) in zip(kept, found)]


def test_query_against_sql(spark):
    same_as_sql(spark, SF, "op12_centroid_clusters")


@pytest.mark.parametrize("scale,k", [(1.0, 8), (1000.0, 3), (0.0, 4), (0.01, 50)])
def test_odd_rows(spark, scale, k):
    rng = random.Random(k)
    rows = [(i, [rng.gauss(0, 1) * scale for _ in range(64)]) for i in range(40)]
    rows += [rows[0], rows[0], (None, rows[1][1]), (70, None), (71, []), (72, [1.0] * 63), (73, [1.0] * 65), (74, [None] * 64),
             (75, [float("nan")] + [0.0] * 63), (76, [float("inf")] + [0.0] * 63), (77, [-0.0] * 64), (78, [1e30 * scale] + [0.0] * 63)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, cluster string")
    got = [tuple(r) for r in cc.cluster(df, k=k, rounds=4).collect()]
    key = lambda r: (-1 if r[0] is None else r[0], *r[1:])
    assert sorted(got, key=key) == sorted(brute(rows, k, 4), key=key)


def test_few_and_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert cc.cluster(spark.createDataFrame([], schema)).collect() == []
    assert cc.cluster(spark.createDataFrame([(1, [0.0])], schema)).collect() == []
    one = cc.cluster(spark.createDataFrame([(None, [0.5] * 64)], schema)).collect()
    assert [(r.vec_id, r.cluster, r.distance) for r in one] == [(None, 0, 0)]


def test_planes_give_exact_dot_products():
    rng = np.random.default_rng(1)
    for low, high in ((-5, 4), (0, 1), (-cc.LIMIT, cc.LIMIT), (-1, -1)):
        v = rng.integers(low, high, (50, 64), endpoint=True)
        words = cc.planes_of(v, cc.planes_for(low, high))
        assert (cc.values_of(words) == v).all()
        c = rng.integers(-3000, 3000, 64)
        assert (cc.dots(words, cc.planes_of(c[None], 13)[:, 0]) == v @ c).all()
        assert (cc.dots(words, words) == (v * v).sum(axis=1)).all()

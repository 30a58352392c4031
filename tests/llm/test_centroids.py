import hashlib
import math
import random

import numpy as np
import pytest

from martforge.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, distance string, v int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "y", 1) for i, v in rows], SCHEMA)


def plain(rows, k=8, rounds=10, dim=64):
    """The contract in plain integers: [(vec_id, cluster, distance)], centroids."""
    kept = [(i, [math.floor(1024 * x) for x in np.array(v, np.float32).astype(float)]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: "3:" + ("" if i is None else str(i))
    order = sorted(kept, key=lambda r: (hashlib.sha256(name(r[0]).encode()).hexdigest(), r[0] is None, r[0], r[1]))
    centers = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centers))

    for _ in range(rounds):
        at = [nearest(v)[1] for _, v in kept]
        groups = [[v for (_, v), c in zip(kept, at) if c == n] for n in range(len(centers))]
        centers = [[sum(x) // len(g) for x in zip(*g)] if g else c for g, c in zip(groups, centers)]
    return [(i, nearest(v)[1], nearest(v)[0]) for i, v in kept], centers


def check(spark, rows, k=8, rounds=10, dim=64):
    got = sorted(tuple(r) for r in centroids.report(frame(spark, rows), k=k, rounds=rounds, dim=dim).collect())
    want, centers = plain(rows, k, rounds, dim)
    total = sum(d for _, _, d in want)
    assert got == sorted((i, c, d, sum(x for _, e, x in want if e == c), total,
                          hashlib.sha256(",".join(map(str, centers[c])).encode()).hexdigest()) for i, c, d in want)


def vectors(seed, n, dim, spread=0.3, groups=5):
    rng = random.Random(seed)
    heart = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(groups)]
    return [[x + rng.gauss(0, spread) for x in rng.choice(heart)] for _ in range(n)]


def test_equals_plain_integers(spark):
    check(spark, list(enumerate(vectors(1, 300, 64))))


def test_ties_repeats_and_odd_rows(spark):
    v = vectors(2, 40, 64, spread=0)  # five different vectors: ties everywhere, empty clusters
    rows = list(enumerate(v)) + [(3, v[0]), (3, v[0]), (7, None), (8, []), (9, v[0][:63]), (10, v[0] + [1.0]),
                                 (11, v[0][:63] + [None]), (12, v[0][:63] + [float("nan")]), (13, v[0][:63] + [float("-inf")])]
    check(spark, rows)


def test_fewer_vectors_than_clusters_and_none(spark):
    check(spark, list(enumerate(vectors(3, 3, 64))))
    check(spark, [(1, None)])
    check(spark, [])


def test_negative_sums_round_down(spark):
    check(spark, [(i, [-0.0015 * (i + j) for j in range(64)]) for i in range(30)], k=2)


def test_rows_without_id_are_clustered(spark):
    rows = [(None, v) for v in vectors(4, 5, 64)] + list(enumerate(vectors(5, 20, 64)))
    found = centroids.report(frame(spark, rows))
    assert found.filter("vec_id IS NULL").count() == 5
    assert sorted((r["cluster"], r["distance"]) for r in found.collect()) == sorted((c, d) for _, c, d in plain(rows)[0])


def test_too_large_components_are_named(spark):
    with pytest.raises(Exception, match="too large for exact distances in vector 1"):
        centroids.report(frame(spark, [(1, [1e30] * 64)])).collect()


def test_pivots_prune_and_never_change_the_nearest():
    rng = np.random.default_rng(6)
    v = rng.integers(-2000, 2000, (500, 64))
    near = v // 50 + rng.integers(0, 8, (500, 1)) * 700
    for data in (v, near):
        c, p = data[:8], centroids.farthest_first(data[:100], 12)
        number, best, taken = centroids.nearest(data, centroids.roots(centroids.squared(data, p)), c, p)
        exact = centroids.squared(data, c)
        assert (number == exact.argmin(axis=1)).all() and (best == exact.min(axis=1)).all()
    assert taken < 0.5 * exact.size  # of grouped data most distances are never computed


def test_roots_are_exact():
    x = np.array([0, 1, 2, 3, 4, 8, 9, (1 << 31) ** 2 - 1, (1 << 31) ** 2, (1 << 62) - 1, 1 << 62])
    assert centroids.roots(x).tolist() == [math.isqrt(int(i)) for i in x]

import numpy as np
import pytest

from helpers import smallest_reachable
from martforge.llm import embedding_dedup
from martforge.llm.embedding_dedup import ProductCode

SCHEMA = "vec_id long, embedding array<float>, label int"


def clustered(seed, dim=64, clusters=5, size=25, single=150, spread=0.09):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(clusters):
        base = rng.standard_normal(dim)
        base /= np.linalg.norm(base)
        out += [base + spread * rng.random() * v / np.linalg.norm(v) * 2 for v in rng.standard_normal((size, dim))]
    return np.array([*out, *rng.standard_normal((single, dim))], dtype=np.float32)


def brute(rows):
    ok = {}
    for i, v, label in rows:
        if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok[i] = (label, np.array(v, dtype=np.float64))
    links = []
    ids = sorted(ok)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            (la, va), (lb, vb) = ok[a], ok[b]
            if la == lb and va.size == vb.size and va @ vb / np.linalg.norm(va) / np.linalg.norm(vb) >= 0.98:
                links.append((a, b))
    every = [i for i, _, _ in rows if i is not None]
    found = smallest_reachable(every, links)
    count = {i: 0 for i in every}
    for a, b in links:
        count[a] += 1
        count[b] += 1
    return {(i, count[i], found[i], found[i] == i) for i in every}


def odd_rows():
    nan, inf = float("nan"), float("inf")
    return [(1000, None, 1), (1001, [], 1), (1002, [0.0] * 64, 1), (1003, [nan] * 64, 1), (1004, [inf] + [1.0] * 63, 1),
            (1005, [None] + [1.0] * 63, 1), (1006, [1.0] * 64, None), (1007, [1.0] * 64, 1), (1008, [2.0] * 64, 1),
            (1009, [1.0] * 64, 2), (1010, [1.0] * 3, 1), (1011, [3.0] * 3, 1), (1012, [-1.0] * 64, 1), (1013, [1.0] * 64, 1)]


@pytest.mark.parametrize("seed", [1, 2])
def test_links_match_brute_force(spark, seed):
    rows = [(i, v.tolist(), i % 2 if i % 5 else None) for i, v in enumerate(clustered(seed))] + odd_rows()
    got = embedding_dedup.groups(spark.createDataFrame(rows, SCHEMA))
    assert {tuple(r) for r in got.collect()} == brute(rows)


def test_large_filters_go_through_blocks(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 8)
    monkeypatch.setattr(embedding_dedup, "GROUP", 16)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(clustered(4, clusters=2, size=60, single=30))]
    got = embedding_dedup.groups(spark.createDataFrame(rows, SCHEMA))
    assert {tuple(r) for r in got.collect()} == brute(rows)


def test_repeats_null_ids_and_clashing_columns(spark):
    v = [1.0] * 8
    frame = spark.createDataFrame([(1, v, 0, "x", 1), (1, v, 0, "x", 1), (2, v, 0, "y", 2), (None, v, 0, "z", 3)],
                                  "vec_id long, embedding array<float>, label int, row string, id int")
    got = sorted(map(str, embedding_dedup.groups(frame).collect()))
    assert len(got) == 4
    assert sorted((r["vec_id"] or 0, r["n_links"]) for r in embedding_dedup.groups(frame).collect()) == [(0, 0), (1, 2), (1, 2), (2, 2)]
    kept = embedding_dedup.dedup(frame)
    assert kept.columns == frame.columns and sorted(r["vec_id"] or 0 for r in kept.collect()) == [0, 1]


def test_empty_table(spark):
    assert embedding_dedup.groups(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("count", [64, 3000, 200_000])
def test_list_decoding_finds_every_exceeding_filter(count):
    code = ProductCode(16, count)
    units = embedding_dedup.units_of(np.random.default_rng(0).standard_normal((20, 16)))
    turned = units @ code.turn
    scores = np.zeros((20, 1))
    for (a, b), words in zip(zip(code.cuts, code.cuts[1:]), code.codes):
        scores = (scores[:, :, None] + (turned[:, a:b] @ words.T)[:, None, :]).reshape(20, -1)
    for own, found in zip(scores, code.decode(units)):
        above = set(np.flatnonzero(own >= code.bar).tolist())
        if len(above) >= code.least:
            assert set(found.tolist()) == above
        else:
            assert set(found.tolist()) == set(np.argsort(-own, kind="stable")[:code.least].tolist())


def brute_rows(rows):
    """Rows that repeat an id are one node: links of each of its distinct vectors, counted by rows."""
    ok = [(i, label, tuple(v)) for i, v, label in rows if v is not None and label is not None and any(v)]

    def near(a, b):
        va, vb = np.array(a, np.float32).astype(float), np.array(b, np.float32).astype(float)
        return va.size == vb.size and va @ vb / np.linalg.norm(va) / np.linalg.norm(vb) >= 0.98

    links, count = [], {}
    for i, label, v in set(ok):
        mine = [j for j, other, w in ok if other == label and (w == v or near(v, w))]
        links += [(i, j) for j in mine]
        count[i] = count.get(i, 0) + len(mine) - 1
    every = {i for i, _, _ in rows}
    found = smallest_reachable(every, links)
    return {(i, count.get(i, 0), found[i], found[i] == i) for i in every}


def test_repeated_ids_with_different_vectors(spark):
    rng = np.random.default_rng(3)
    x, y = rng.standard_normal((2, 32))
    near = lambda v: (v + 0.01 * rng.standard_normal(32)).astype(np.float32).tolist()
    three = [(1, x.tolist(), 0), (1, y.tolist(), 0), (2, near(x), 0), (3, near(y), 0)]
    rows = [(i, np.array(v, np.float32).tolist(), label) for i, v, label in three]
    assert {tuple(r)[:2] for r in embedding_dedup.groups(spark.createDataFrame(rows, SCHEMA)).collect()} == {(1, 2), (2, 1), (3, 1)}
    more = rows + [(5, rows[0][1], 0), (5, None, 0), (6, rows[0][1], 0), (6, rows[1][1], 1), (7, near(y), 1), (7, rows[2][1], 0), (8, None, 1), (9, rows[1][1], None),
                   (10, near(rng.standard_normal(32)), 0), (10, near(rng.standard_normal(32)), 0)]
    got = embedding_dedup.groups(spark.createDataFrame(more, SCHEMA))
    assert got.count() == len(more) and {tuple(r) for r in got.collect()} == brute_rows(more)


@pytest.mark.parametrize("vectors", [10**4, 10**6, 10**8, 10**10])
def test_recall_of_shared_filters_by_size(vectors):
    code = ProductCode(64, vectors * embedding_dedup.LIST // embedding_dedup.MEETING)
    rng = np.random.default_rng(5)
    a = embedding_dedup.units_of(rng.standard_normal((150, 64)))
    side = rng.standard_normal((150, 64))
    side = embedding_dedup.units_of(side - (side * a).sum(axis=1, keepdims=True) * a)
    b = 0.98 * a + np.sqrt(1 - 0.98**2) * side
    shared = [np.intersect1d(x, y).size for x, y in zip(code.decode(a), code.decode(b))]
    print(vectors, np.mean(np.array(shared) > 0), np.mean(shared))
    assert np.mean(np.array(shared) > 0) >= 0.98

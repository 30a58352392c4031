import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import CLASHING, docs, near_texts, shingles, smallest_reachable
from martforge.llm import minhash


def brute(table, n=4):
    sets = {i: shingles(t, n) for i, t in table if i is not None}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    found = smallest_reachable(ids, links)
    return {(i, len(sets[i]), found[i], found[i] == i) for i in ids}


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_match_brute_force(spark, seed):
    table = [(3 * i - 20, t) for i, t in enumerate(near_texts(seed))]
    got = minhash.groups(docs(spark, table, "doc_id long, text string")).drop("digest")
    assert {tuple(r) for r in got.collect()} == brute(table)


@pytest.mark.parametrize("k", [16, 64])
def test_long_lists_go_through_blocks_without_loss(spark, monkeypatch, k):
    monkeypatch.setattr(minhash, "SHORT", 4)
    monkeypatch.setattr(minhash, "BLOCK", 7)
    monkeypatch.setattr(minhash, "BUCKET", 5)
    table = list(enumerate(near_texts(5, families=2, size=45, edits=12)))
    got = minhash.groups(docs(spark, table, "doc_id long, text string"), k=k).drop("digest")
    assert {tuple(r) for r in got.collect()} == brute(table)


def test_nulls_repeats_long_texts_and_clashing_columns(spark):
    long = " ".join(f"w{i % 4000}x{i}" for i in range(30_000))
    table = [(1, long), (2, long + " end"), (3, None), (None, long), (None, None), (4, ""), (5, "a b"), (5, "a b"), (6, "A  B"), (7, "a c")]
    frame = docs(spark, table, CLASHING)
    got = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.groups(frame).collect()}
    assert {r for r in got if r[0] is not None} == {
        (1, 29997, 1, True), (2, 29998, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 1, 5, True), (6, 1, 5, False), (7, 1, 7, True)}
    assert {r for r in got if r[0] is None} == {(None, 29997, None, True), (None, 0, None, True)}
    kept = minhash.dedup(frame)
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 0, 1, 3, 4, 5, 7]


def test_similarity_of_exactly_the_threshold_links(spark):
    # Sets of nine and nine shingles that share eight: 8 / 10.
    a = "a b c d e f g h i j k l"
    b = "a b c d e f g h i j k z"
    assert len(shingles(a) & shingles(b)) * 100 == 80 * len(shingles(a) | shingles(b))
    got = minhash.groups(docs(spark, [(1, a), (2, b), (3, a + " m n o p")])).collect()
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(1, 1), (2, 1), (3, 3)}


def test_empty_table(spark):
    assert minhash.groups(docs(spark, [])).count() == 0


def test_shared_values_relied_on_are_a_binomial_tail():
    assert minhash.shared_at_least(64) == 30 and minhash.shared_at_least(1) == 1


def edited(n, words=120, edits=4, seed=8):
    """Copies of one text with a few words of each changed: alike, and almost none linked."""
    rng, vocabulary = random.Random(seed), [f"v{i}" for i in range(50_000)]
    base = [f"b{i}" for i in range(words)]
    out = []
    for i in range(n):
        own = list(base)
        for at in rng.sample(range(words), edits):
            own[at] = rng.choice(vocabulary)
        out.append((i, " ".join(own)))
    return out


def joined_sets(spark, monkeypatch, table, n):
    """Rows of full sets that the stages of one run join: star, short lists, blocks."""
    moved = []
    whole = minhash.verified

    def counted(pairs, keys, sets, k, percent):
        rows = pairs.select(*keys, F.explode(F.array_union("lefts", "rights")).alias("cid")).distinct()
        moved.append(rows.count())
        return whole(pairs, keys, sets, k, percent)

    with monkeypatch.context() as m:
        m.setattr(minhash, "verified", counted)
        got = minhash.groups(docs(spark, table, "doc_id long, text string"), shingle=n).drop("digest").collect()
    return moved, {tuple(r) for r in got}


@pytest.mark.parametrize("n", [4, 5])
def test_sets_joined_grow_with_a_group_and_not_with_its_square(spark, monkeypatch, n):
    small, large = (joined_sets(spark, monkeypatch, edited(size), n)[0] for size in (500, 1000))
    assert sum(large) < 2.5 * sum(small)
    # Blocks hold the few members that can be linked at all.
    assert large[-1] < 1000


def test_groups_that_hardly_link_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 64)
    table = edited(260, words=60, edits=2) + [(1000 + i, t) for i, t in edited(120, words=60, edits=1, seed=9)]
    for n in (4, 5):
        assert joined_sets(spark, monkeypatch, table, n)[1] == brute(table, n)


def test_own_shingles_are_counted_exactly(spark):
    sets = {1: [1, 2, 3], 2: [2, 3, 4], 3: [9], 4: [9, 5, 6]}
    rows = [(c, np.array(v, dtype=np.int64).tobytes()) for c, v in sets.items()] + [(4, np.array([7], dtype=np.int64).tobytes())]
    frame = spark.createDataFrame(rows, "cid long, hashes binary")
    every = spark.createDataFrame([(c,) for c in sets], "cid long")
    assert {tuple(r) for r in minhash.alone(frame, every).collect()} == {(1, 1), (2, 1)}  # 4 has two sets: nothing is said of it
    assert {tuple(r) for r in minhash.alone(frame, every.filter("cid <> 2")).collect()} == {(1, 3)}

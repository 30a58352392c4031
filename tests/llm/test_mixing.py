import pytest
from helpers import CLASHING, docs, rows
from martforge.llm import mixing


def water_filled(sizes, weights=(5, 2, 1), cap=3):
    """Targets by capping and resharing until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while True:
        rest = {s: w[s] for s in names if s not in full}
        level = (total - sum(full.values())) / sum(rest.values()) if rest else 0
        over = [s for s in rest if level * w[s] > cap * sizes[s] + 1e-9]
        if not over:
            return {s: full.get(s, level * w[s]) for s in names}
        full.update({s: cap * sizes[s] for s in over})


@pytest.mark.parametrize("counts", [{"a": 900, "b": 10, "c": 5}, {"a": 1, "b": 500, "c": 3, None: 40, "é": 7, "Z": 90},
                                    {"a": 3}, {"a": 0, "b": 20}, {str(i): i * i for i in range(25)}])
def test_targets_are_the_capped_and_reshared_weights(spark, counts):
    table = docs(spark, [(i, "w " * n, None, s) for i, (s, n) in enumerate(counts.items())])
    got = {r["source"]: r["target"] for r in mixing.allocations(table, carry=True).select("row.source", "target").collect()}
    assert got == pytest.approx(water_filled(counts))


def test_taken_words_come_near_targets_and_runs_agree(spark):
    table = docs(spark, [(i, "w " * (1 + i * 7919 % 300), None, f"s{min(i % 11, 4)}") for i in range(3000)]).repartition(8)
    done = mixing.allocations(table, carry=True).selectExpr("row.source AS s", "size", "target", "taken", "copies", "doc_id")
    for r in done.groupBy("s", "target").agg({"taken": "sum", "size": "max"}).collect():
        assert abs(r["sum(taken)"] - r["target"]) <= 2 * r["max(size)"]
    assert done.filter("taken > 3 * size OR copies > 3 OR taken <> copies * size").count() == 0
    assert rows(done) == rows(mixing.allocations(table.repartition(3), carry=True).selectExpr("row.source AS s", "size", "target", "taken", "copies", "doc_id"))


def test_mix_repeats_whole_rows(spark):
    table = docs(spark, [(1, "a b", None, "x"), (1, "a b", None, "x"), (2, None, None, None), (3, "c " * 50_000, None, "y"), (None, "d", None, "x")], CLASHING)
    mixed = mixing.mix(table)
    assert mixed.columns == table.columns
    counted = mixing.allocations(table).agg({"copies": "sum"}).first()[0]
    assert mixed.count() == counted


def test_words_are_runs_without_ascii_white_space(spark):
    table = docs(spark, [(1, "a b c\x0bd\x1ce"), (2, None), (3, ""), (4, " \n")])
    assert {r["doc_id"]: r["size"] for r in mixing.allocations(table).collect()} == {1: 3, 2: 0, 3: 0, 4: 0}


def test_empty_table(spark):
    assert mixing.allocations(docs(spark, [])).count() == 0
    assert mixing.mix(docs(spark, [])).count() == 0

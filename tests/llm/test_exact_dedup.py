import hashlib
import re

from pyspark.sql import functions as F

from helpers import CLASHING, DOCS, docs, rows
from martforge.llm import exact_dedup


def brute(table):
    """doc_id -> (keep_id, group_size) by content."""
    groups = {}
    for ident, text in table:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((ident, text or ""))
    out = []
    for content, own in groups.items():
        keep = min(own, key=lambda r: (-len(r[1]), r[0] is None, r[0] or 0))[0]
        out += [(i, keep, len(own), i == keep, hashlib.sha256(content.encode()).hexdigest()) for i, _ in own]
    return sorted(out, key=str)


TABLE = [(1, "a b c"), (2, "abc"), (3, "a\tb\x0bc\n"), (4, None), (5, ""), (6, "  \r\n"), (7, "abc d"), (8, "A b c"),
         (9, " abc"), (10, "é" * 5), (11, "é é é é é"), (None, "abc "), (12, "x " * 60_000), (13, "x" * 60_000), (-3, "a  bc")]


def test_members_match_brute_force(spark):
    got = exact_dedup.members(docs(spark, TABLE, "doc_id long, text string")).select("doc_id", "keep_id", "group_size", "kept", "digest")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(TABLE)


def test_contents_are_compared_where_digests_collide(spark):
    def weak(content):
        return F.substring(F.sha2(content, 256), 1, 1)

    table = [(i, f"text {i % 37}" + " " * (i % 3)) for i in range(300)]
    got = exact_dedup.members(docs(spark, table, "doc_id long, text string"), digest=weak)
    want = [r[:4] for r in brute(table)]
    assert sorted((tuple(r) for r in got.drop("digest").collect()), key=str) == sorted(want, key=str)


def test_salts_do_not_change_the_result(spark):
    table = docs(spark, [(i, "same" if i % 3 else f"own {i}") for i in range(500)], "doc_id long, text string").repartition(16)
    assert rows(exact_dedup.members(table, salts=1)) == rows(exact_dedup.members(table, salts=7))


def test_dedup_keeps_one_row_of_each_group_with_all_columns(spark):
    table = docs(spark, [(1, "a b"), (2, "a  b"), (2, "a  b"), (3, "c"), (None, "c"), (None, "d")], CLASHING)
    kept = exact_dedup.dedup(table)
    assert kept.columns == table.columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect() if r["doc_id"]) == [(2, "a  b"), (3, "c")]
    assert kept.filter("doc_id IS NULL").count() == 1


def test_empty_table(spark):
    assert exact_dedup.members(docs(spark, [])).count() == 0
    assert exact_dedup.dedup(docs(spark, [])).columns == [c.split()[0] for c in DOCS.split(", ")]


def test_a_group_with_a_third_of_all_rows(spark):
    table = [(i, f"copy{' ' * (i % 5)} of one" if i % 3 == 0 else f"own {i}") for i in range(3000)]
    got = exact_dedup.members(docs(spark, table, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=str) == brute(table)

"""Property-based checks of the silver operators and dense ids against plain-Python models."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martforge.functions.ids import dense_index
from martforge.operators.conform import dedupe_by_key
from martforge.operators.quality import Rule, split

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

keys = st.integers(min_value=0, max_value=5)
texts = st.one_of(st.none(), st.sampled_from(["", "a", "b", "ab", "B", "12", "12.5", "-3", "3000000000", "x\n"]))
nums = st.one_of(st.none(), st.integers(min_value=-3, max_value=3))


def _least(rows):
    # nulls first, then natural order, column by column (what min(struct) does)
    return min(rows, key=lambda r: tuple((v is not None, v if v is not None else 0) for v in r))


@SETTINGS
@given(st.lists(st.tuples(keys, texts, nums), min_size=1, max_size=25))
def test_dedupe_keeps_least_row_per_key(spark, rows):
    df = spark.createDataFrame(rows, "k int, s string, n int")
    got = sorted(((r.k, r.s, r.n) for r in dedupe_by_key(df, "k").collect()), key=lambda t: t[0])
    expected = []
    for k in sorted({r[0] for r in rows}):
        s, n = _least([r[1:] for r in rows if r[0] == k])
        expected.append((k, s, n))
    assert got == expected


@SETTINGS
@given(st.lists(st.tuples(texts, texts), min_size=1, max_size=25))
def test_split_is_an_exact_partition(spark, rows):
    df = spark.createDataFrame(rows, "a string, b string")
    rules = [Rule("a", "int"), Rule("b", "pattern", r"^[ab]+$")]
    valid, rejected = split(df, rules)
    v, r = valid.collect(), rejected.collect()
    assert len(v) + len(r) == len(rows)
    for row in v:
        assert row.a is not None and row.b is not None


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 20)), st.integers(0, 1000)), min_size=1,
                max_size=40, unique_by=lambda t: t), st.integers(1, 5))
def test_dense_index_is_sorted_position(spark, rows, parts):
    df = spark.createDataFrame(rows, "g int, k int")
    order = [F.col("g").asc_nulls_first(), F.col("k").asc_nulls_first()]
    got = {(r.g, r.k): r.rid for r in dense_index(df, order, "rid", base=1, partitions=parts).collect()}
    ranked = sorted(rows, key=lambda t: (t[0] is not None, t[0] or 0, t[1]))
    assert got == {t: i + 1 for i, t in enumerate(ranked)}

"""Z-order, bucketed tables, LAG over range partitions, recursion over parents, counts in the same pass."""

import os
import random
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import pyarrow.parquet as pq
import pytest
from executed import exchanges
from plan_report import plan_text
from pyspark.sql import Window
from pyspark.sql import functions as F

from martforge.functions.lag import lag_within
from martforge.functions.zorder import zorder_key, zordered
from martforge.operators import bitmaps, calendar, facts, hierarchy, quality
from martforge.operators.hierarchy import HierarchySpec, Level
from martforge.plans import queries as Q
from martforge.plans import retail
from martforge.sources import layers as L
from martforge.sources import snapshot


# ------------------------------------------------------------------ Z-order
def test_keys_interleave_the_bits(spark):
    df = spark.createDataFrame([(a, b) for a in range(4) for b in range(4)], "a int, b long")
    got = {(r.a, r.b): r.z for r in df.select("a", "b", zorder_key({"a": 3, "b": 3}).alias("z")).collect()}
    order = sorted(got, key=got.get)
    assert order[:4] == [(0, 0), (0, 1), (1, 0), (1, 1)] and order[4:8] == [(0, 2), (0, 3), (1, 2), (1, 3)]
    assert len(set(got.values())) == 16
    with pytest.raises(ValueError):
        zorder_key({"a": 1 << 40, "b": 1})


def test_each_key_reads_a_bounded_part_of_the_files(spark, tmp_path):
    n = 24
    df = spark.range(n**3).select((F.col("id") % n).alias("a"), (F.col("id") / n % n).cast("int").alias("b"), (F.col("id") / n / n).cast("int").alias("c"))
    path = str(tmp_path / "z")
    zordered(df, ["a", "b", "c"], 64).write.parquet(path)
    files = list((tmp_path / "z").glob("*.parquet"))
    assert len(files) > 40 and spark.read.parquet(path).count() == n**3
    for k in range(3):
        for value in (0, 7, n - 1):
            hit = 0
            for f in files:
                stats = pq.ParquetFile(f).metadata.row_group(0).column(k).statistics
                hit += stats.min <= value <= stats.max
            assert hit <= len(files) / 2  # a plain sort bounds one key and reads every file for the others


def test_negative_keys_are_refused(spark):
    with pytest.raises(ValueError):
        zordered(spark.createDataFrame([(-1, 1)], "a int, b int"), ["a", "b"])


# ------------------------------------------------------------------ buckets
def test_the_bucketed_join_moves_neither_side(spark, layers):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sales, bridge = Q.bucketed_by_product(layers, 4)
        joined = facts.presummed(sales, layers.dim_date).join(bridge, "product_id")
        text = plan_text(joined)
        assert "SortMergeJoin" in text and "Exchange hashpartitioning" not in text
        whole = exchanges(facts.rollup_bucketed(sales, bridge, layers.dim_date, layers.lkp_store_geography))
        assert not [d for d, _ in whole if "product_id" in d]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# ------------------------------------------------------------------ LAG
@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_lag_within_equals_the_window(spark, partitions):
    rng = random.Random(partitions)
    rows = [(None if i % 37 == 0 else 1 if i % 3 == 0 else rng.randrange(30), rng.choice([None, *range(50)]), i, rng.choice([None, "x", "y"]))
            for i in range(600)]
    df = spark.createDataFrame(rows, "k int, t int, i int, v string")
    got = lag_within(df, ["k"], ["t", "i"], "v", "before", partitions)
    want = df.withColumn("before", F.lag("v").over(Window.partitionBy("k").orderBy(F.col("t").asc_nulls_first(), "i")))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_a_key_with_a_third_of_the_rows_spreads(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    got = lag_within(df, ["k"], ["id"], "id", "before", 12)
    most = max(n for n, in df.filter("k = 0").repartitionByRange(12, "k", "id").groupBy(F.spark_partition_id()).count().select("count").collect())
    assert most <= 3000 / 4
    assert got.filter("k = 0 AND before IS NOT NULL AND id - before <> 3").count() == 0 and got.filter("before IS NULL").count() == 2001


def test_global_lag_and_irregular_periods(spark):
    ends = spark.createDataFrame([("2024-03-31",), ("2024-01-31",), ("2024-02-29",), ("2024-02-29",), (None,), ("2025-01-01",)], "d string")
    got = [tuple(map(str, r)) for r in calendar.periods_between(ends, "d").orderBy("period_id").collect()]
    assert got == [("1", "None", "2024-01-31"), ("2", "2024-02-01", "2024-02-29"), ("3", "2024-03-01", "2024-03-31"), ("4", "2024-04-01", "2025-01-01")]


# ------------------------------------------------------------------ recursion
RAGGED = HierarchySpec((Level("a", ("a",)), Level("b", ("a", "b")), Level("c", ("a", "b", "c")), Level("d", ("a", "b", "c", "d"))), "id", "leaf")


def test_ancestors_of_a_ragged_hierarchy(spark):
    # Node 4 has no node on level c above it and hangs under b.
    dim = spark.createDataFrame([(1, "x", None, None, None, "a"), (2, "x", "y", None, None, "b"), (3, "x", "y", "z", None, "c"),
                                 (4, "x", "y", "w", "v", "d"), (5, "x", "y", "z", "u", "d"), (6, "q", None, None, None, "a")],
                                "id long, a string, b string, c string, d string, level string")
    links = sorted(map(tuple, hierarchy.parent_links(dim, RAGGED).collect()))
    assert links == [(2, 1), (3, 2), (4, 2), (5, 3)]
    up = sorted(map(tuple, hierarchy.ancestors(hierarchy.parent_links(dim, RAGGED), dim, "id").collect()))
    assert up == sorted([(i, i, 0) for i in range(1, 7)] + [(2, 1, 1), (3, 2, 1), (3, 1, 2), (4, 2, 1), (4, 1, 2), (5, 3, 1), (5, 2, 2), (5, 1, 3)])
    leaves = spark.createDataFrame([(10, "x", "y", "w", "v"), (11, "x", "y", "z", None), (12, "x", None, None, None), (13, "n", None, None, None)],
                                   "leaf int, a string, b string, c string, d string")
    assert sorted(map(tuple, hierarchy.bridge_by_ancestors(leaves, dim, RAGGED).collect())) == [(1, 10), (1, 11), (1, 12), (2, 10), (2, 11), (3, 11), (4, 10)]


def test_a_cycle_of_parents_is_an_error(spark):
    links = spark.createDataFrame([(1, 2), (2, 1)], "child long, parent long")
    with pytest.raises(Exception, match="RECURSION"):
        hierarchy.ancestors(links, spark.createDataFrame([(1,), (2,)], "id long"), "id").count()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("__links")]


# ------------------------------------------------------------------ bitmaps
def test_upper_levels_come_from_lower_ones(spark, layers):
    made = {}

    def keep(cells, name):
        made[name] = (cells, Q.kept(cells, name))
        return made[name][1]

    fact = bitmaps.rollup_fact_bitmaps(layers.sales, layers.dim_date, layers.stores, layers.products, layers.dim_geography,
                                       layers.dim_product, retail.GEOGRAPHY, retail.PRODUCT, keep)
    assert sorted(map(tuple, fact.collect())) == sorted(map(tuple, layers.fact_base().collect()))
    sizes = {name: stored.count() for name, (_, stored) in made.items()}
    assert len(sizes) == 9
    for g in range(3):
        for p in range(3):
            if (g, p) != (2, 2):
                below = sizes[f"cells_{g}_{p + 1}" if g == 2 else f"cells_{g + 1}_{p}"]
                moved = exchanges(made[f"cells_{g}_{p}"][0])
                # One exchange, of at most the cells of the level below, never of sales or stores.
                assert len(moved) == 1 and moved[0][1] <= below


# ------------------------------------------------------------------ counts
def test_counts_come_with_the_write(spark, tmp_path):
    df = spark.range(10).selectExpr("cast(id as string) as k")
    valid, rejected, seen = quality.counted_split(df.withColumn("k", F.when(F.col("k") < "3", None).otherwise(F.col("k"))), [quality.Rule("k")])
    valid.write.parquet(str(tmp_path / "v"))
    assert quality.counts_row("t", seen) == ("t", 10, 7, 3) and rejected.count() == 3


def test_snapshot_counts_without_reading_back(spark, tmp_path):
    empty = spark.createDataFrame([], "a int")
    tables = {"some": spark.range(7).toDF("a"), "none": empty}
    status = snapshot.snapshot(spark, lambda s, name: tables[name], ["some", "none"], str(tmp_path))
    assert [(r.table_name, r.row_count) for r in status.collect()] == [("some", 7), ("none", 0)]


def test_strict_rules_name_fine_measures_and_far_dates(spark):
    rows = [("1", "2", "3", "2024-01-01", "2024-01-07", amount, "1") for amount in ("1.5", "0.12345678901", None)]
    rows += [("1", "2", "3", "9999-12-27", "9999-12-31", "1", "1")]
    df = spark.createDataFrame(rows, "sales_id string, store_id string, product_id string, period_start string, period_end string, sales_amount string, sales_units string")
    valid, rejected = quality.split(df, retail.SALES_RULES_STRICT)
    assert valid.count() == 2 and {r.sales_amount for r in rejected.collect()} == {"0.12345678901", "1"}


def test_emptied_folders_go_and_others_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    L.write_by(spark.range(6).withColumn("k", F.col("id") % 3), path, ["k"])
    assert L.drop_empty_folders(spark, path, "k", [0, 1], [0]) == [1]
    assert {r.k for r in spark.read.parquet(path).select("k").distinct().collect()} == {0, 2}

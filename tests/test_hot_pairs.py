"""A store with a third of all sales in one week: same result, and few rows moved for it."""

import datetime as dt
import random

import pytest
from executed import exchanges
from pyspark.sql import functions as F

from martforge.operators import calendar, facts
from martforge.session import kept

WEEK = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def hot(spark):
    """(sales, periods, geography bridge, product bridge): 2,000 of 6,000 sales in one store and week, 20 products."""
    rng = random.Random(1)
    rows = []
    for i in range(6000):
        week = 3 if i < 2000 else rng.randrange(8)
        start = WEEK + dt.timedelta(days=7 * week)
        rows.append((i, 1 if i < 2000 else rng.randrange(40), rng.randrange(20), start, start + dt.timedelta(days=6),
                     rng.choice([1.25, 10.12345, 0.00001, 3e15]), float(rng.randrange(5))))
    sales = spark.createDataFrame(rows, "sales_id int, store_id int, product_id int, period_start date, period_end date, sales_amount double, sales_units double")
    sales, periods = kept(sales.repartition(6), "sales"), kept(calendar.period_dim_from(sales, "period_start", "period_end"), "periods")
    geo = spark.createDataFrame([(g, s) for s in range(40) for g in (1, 2 + s % 4)], "geography_id int, store_id int")
    prod = spark.createDataFrame([(h, p) for p in range(20) for h in (100, 101 + p % 3, 200 + p)], "hierarchy_id long, product_id int")
    return sales, periods, geo, prod


def test_hot_pairs_are_found_and_change_nothing(spark, hot):
    sales, periods, geo, prod = hot
    assert [(r[0], r[1]) for r in facts.hot_pairs(sales, periods, limit=1000).collect()] == [(1, 5)]
    direct = sorted(map(tuple, facts.rollup_fact_direct(sales, periods, geo, prod).collect()))
    for limit in (1000, 50, 10**9):
        assert sorted(map(tuple, facts.rollup_fact(sales, periods, geo, prod, hot_rows=limit).collect())) == direct


def test_a_hot_pair_sends_at_most_a_row_per_task_and_product(spark, hot):
    sales, periods, geo, prod = hot
    tasks = sales.rdd.getNumPartitions()
    only = sales.filter((F.col("store_id") == 1) & (F.col("period_start") == WEEK + dt.timedelta(days=21)))
    moved = exchanges(facts.presummed(only, periods))
    assert len(moved) == 1 and moved[0][1] <= tasks * 20 < only.count()
    step = [(d, n) for d, n in exchanges(facts.product_step(sales, periods, prod, hot_rows=1000)) if "store_id" in d]
    # Sales of other pairs move once; nothing else moves more rows than tasks x (products or nodes).
    assert max(n for _, n in step) <= sales.count() - only.count() and sum(n for _, n in step) < sales.count()


def test_the_sums_of_one_store_and_week_are_not_in_one_task(spark, hot):
    sales, periods, geo, prod = hot
    step = facts.product_step(sales, periods, prod, hot_rows=1000)
    pair = step.filter("store_id = 1 AND period_id = 5").withColumn("part", F.spark_partition_id())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert pair.select("part").distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_stored_folders_are_split_over_several_tasks(spark, hot, tmp_path):
    from martforge.sources import layers

    sales = hot[0]
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    try:
        layers.write_by(sales, str(tmp_path / "by_week"), ["period_start"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {d.name: len(list(d.glob("*.parquet"))) for d in (tmp_path / "by_week").iterdir() if d.is_dir()}
    hot_folder = f"period_start={WEEK + dt.timedelta(days=21)}"
    assert files[hot_folder] > 1 and sum(files.values()) < 8 * 6
    assert spark.read.parquet(str(tmp_path / "by_week")).count() == sales.count()

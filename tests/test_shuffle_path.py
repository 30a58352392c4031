"""Joins without broadcasts give the same rows, and what is broadcast has been measured."""

import pytest
from pyspark.sql import functions as F

from or_join import bridge_or_join
from martforge.functions.sizing import checked_broadcast, measured_bytes
from martforge.operators import facts, hierarchy, kpi
from martforge.plans import medallion, retail
from martforge.session import scratch_path


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k in keys:
        spark.conf.unset(k)


def test_size_is_measured_in_bytes_each_time(spark):
    path = scratch_path(spark, "grown")
    spark.range(10).withColumn("t", F.lit("x" * 10)).write.parquet(path)
    small = spark.read.parquet(path)
    bound = measured_bytes(small)
    assert checked_broadcast(small, bound) is not small
    spark.range(10).withColumn("t", F.lit("x" * 1000)).write.mode("overwrite").parquet(path)
    grown = spark.read.parquet(path)  # as many rows as before, but wider
    assert checked_broadcast(grown, bound) is grown
    assert checked_broadcast(spark.range(0), 0) is not None


def test_or_join_refuses_a_large_dimension(layers):
    with pytest.raises(ValueError, match="bytes"):
        bridge_or_join(layers.stores, layers.dim_geography, retail.GEOGRAPHY, max_bytes=1)


def test_shuffled_bridges_and_roll_up_equal_broadcast_ones(spark, layers, no_broadcast):
    g = layers
    assert _rows(hierarchy.bridge(g.stores, g.dim_geography, retail.GEOGRAPHY, max_bytes=0)) == _rows(g.lkp_store_geography)
    f0 = facts.rollup_fact(g.sales, g.dim_date, g.lkp_store_geography, g.lkp_product_hierarchy)
    assert "SortMergeJoin" in _plan(f0)
    rows = _rows(f0)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows == _rows(g.fact_base())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    k0 = kpi.rollup_kpi(g.sales, g.dim_date, g.lkp_store_geography, g.lkp_product_hierarchy, g.period_map(), g.total_stores())
    rows = _rows(k0)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows == _rows(g.kpi())


def test_one_country_shuffles_only_the_last_level(spark, layers, no_broadcast):
    one = medallion.keep(layers.stores.withColumn("store_country", F.lit("World")))
    dim = medallion.keep(hierarchy.hierarchy_dim(one, retail.GEOGRAPHY))
    made = hierarchy.bridge(one, dim, retail.GEOGRAPHY)
    plan = _plan(made)
    assert plan.count("BroadcastHashJoin") == 2 and plan.count("SortMergeJoin") == 1
    assert _rows(made) == _rows(hierarchy.bridge_by_key(one, dim, retail.GEOGRAPHY))


def test_hot_store_gives_the_same_sums(layers):
    """A store with a third of the sales: equal to the one-step form, and moved by (store, period)."""
    g = layers
    hot = g.sales.withColumn("store_id", F.when(F.col("sales_id") % 3 == 0, F.lit("1")).otherwise(F.col("store_id")))
    hot = hot.select(*[F.col(c).cast(t) for c, t in g.sales.dtypes])
    two = facts.rollup_fact(hot, g.dim_date, g.lkp_store_geography, g.lkp_product_hierarchy)
    one = facts.rollup_fact_direct(hot, g.dim_date, g.lkp_store_geography, g.lkp_product_hierarchy)
    assert _rows(two) == _rows(one.select(*two.columns))
    moved = facts.join_periods(hot, g.dim_date)
    most = moved.groupBy("store_id", "period_id").count().agg({"count": "max"}).first()[0]
    assert most < moved.count() / 20


def test_measures_are_summed_exactly_whatever_their_size(spark):
    from martforge.functions.columns import exact_measure, fits_scale

    def total(values, scale=10):
        return spark.createDataFrame([(v,) for v in values], "x double").agg(F.sum(exact_measure("x", scale)).cast("double")).first()[0]

    assert total([1.005, 1.004, 0.125, None]) == 2.134
    assert total([10.12345, 0.00001, -10.12345]) == 0.00001
    assert total([0.1] * 10) == 1.0  # a sum of doubles gives 0.9999999999999999
    assert total([4e14] * 3) == 1.2e15 and total([3e18] * 9) == 2.7e19  # beyond 2^63 in any small unit
    assert total([1.005, 1.004], 2) == 2.01  # finer digits are rounded value by value
    assert total([1.5, float("nan"), float("inf"), 1e300]) == 1.5
    rows = spark.createDataFrame([("1.25",), ("1.251",), ("x",), (None,), ("NaN",)], "x string")
    assert [r[0] for r in rows.select(fits_scale("x", 2)).collect()] == [True, False, False, True, False]

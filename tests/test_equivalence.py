"""Rewrites equal the original formulations; invariants of the star schema hold."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from or_join import bridge_or_join
from martforge.functions.ids import dense_index
from martforge.operators import facts, hierarchy, kpi
from martforge.plans import retail


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_dense_index_equals_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k"), (F.col("id") % 3).alias("g"))
    order = [F.col("g").asc_nulls_first(), F.col("k").asc_nulls_first()]
    ours = dense_index(df, order, "rid", base=0, partitions=7)
    ref = df.withColumn("rid", F.row_number().over(Window.orderBy(*order)) - 1)
    assert _rows(ours.select("g", "k", "rid")) == _rows(ref.select("g", "k", "rid"))


def test_bridge_equals_or_join(layers):
    for leaves, spec in [(layers.stores, retail.GEOGRAPHY), (layers.products, retail.PRODUCT)]:
        dim = hierarchy.hierarchy_dim(leaves, spec)
        assert _rows(hierarchy.bridge(leaves, dim, spec)) == _rows(hierarchy.bridge_by_key(leaves, dim, spec))
        assert _rows(hierarchy.bridge(leaves, dim, spec)) == _rows(bridge_or_join(leaves, dim, spec))


def test_two_step_rollup_equals_distinct_count_form(layers):
    g = layers
    two = g.fact_base()
    direct = facts.rollup_fact_direct(g.sales, g.dim_date, g.lkp_store_geography, g.lkp_product_hierarchy)
    assert _rows(two) == _rows(direct.select(*two.columns))


def test_kpi_equals_kpi_over_fact_table(layers):
    g = layers
    for years, basis, unmatched in [(-1, "iso", "keep"), (1, "calendar", "drop")]:
        made = g.kpi(years, basis, unmatched)
        staged = kpi.kpi_fact(g.fact_base(), g.period_map(years, basis), g.total_stores(), unmatched,
                              periods=g.dim_date)
        assert _rows(staged) == _rows(kpi.kpi_fact(g.fact_base(), g.period_map(years, basis),
                                                   g.total_stores(), unmatched))
        assert _rows(made) == _rows(staged.select(*made.columns))


def test_sales_add_up_across_levels(layers):
    g = layers
    fb = g.fact_base()
    lv = (fb.join(g.dim_geography.select("geography_id", F.col("level").alias("gl")), "geography_id")
          .join(g.dim_product.select("hierarchy_id", F.col("level").alias("pl")), "hierarchy_id")
          .groupBy("gl", "pl").agg(F.round(F.sum("sales"), 2).alias("s")))
    totals = {r.s for r in lv.collect()}
    assert len(totals) == 1 and lv.count() == 9


def test_one_node_per_level_and_penetration_bounds(layers):
    g = layers
    per = g.lkp_store_geography.groupBy("store_id").count()
    assert per.filter("count != 3").count() == 0
    k = g.kpi()
    bad = k.filter((F.col("store_penetration_pct") < 0) | (F.col("store_penetration_pct") > 100))
    assert bad.count() == 0
    assert g.dim_date.agg(F.max("period_id") - F.count("*")).collect()[0][0] == 0

"""Plan audit: no registered query uses a nested-loop or Cartesian join or evaluates Python per row,
and single-partition exchanges only carry partial aggregates or per-partition counts."""

import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import pytest  # noqa: E402
from plan_report import plan_text, summarise  # noqa: E402

from martforge.plans.queries import REGISTRY  # noqa: E402


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_plan_scales(spark, sf, name):
    s = summarise(plan_text(REGISTRY[name](spark, sf)))
    assert s["flags"] == [], s
    for child in s["single_partition"]:
        assert child in {"partial-agg", "HashAggregate"}, s


@pytest.mark.parametrize("name", ["total_stores", "dim_geography", "bridge_store_geography", "dim_product", "bridge_product_hierarchy"])
def test_queries_of_dimensions_build_no_sales(spark, sf, name):
    from martforge.plans import queries as Q

    g = Q.layers_of(spark, sf)
    Q.OVER_LAYERS[name](g)
    assert "sales" not in g.__dict__


def test_the_roll_up_moves_no_more_rows_than_there_are_sales(spark, layers):
    from martforge.operators import facts

    per = facts.store_sums(layers.sales, layers.dim_date)
    moved = facts.join_periods(layers.sales, layers.dim_date).count()
    assert moved <= layers.sales.count()
    step = facts.product_step(layers.sales, layers.dim_date, layers.lkp_product_hierarchy)
    text = plan_text(step)
    # One exchange, by store and period, below the join that expands products to their nodes.
    assert text.count("Exchange hashpartitioning") == 1 and "REPARTITION_BY_COL" in text
    assert per.count() <= moved


def test_lookups_prune(spark, layers):
    from martforge.plans import queries as Q

    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")  # else the filters are cut off in the text
    plan = plan_text(Q.OVER_LAYERS["kpi_lookup"](layers))
    assert "PartitionFilters: [isnotnull(period_id" in plan
    plan = plan_text(Q.OVER_LAYERS["fact_period_join"](layers))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "EqualTo(period_start," in plan and "EqualTo(period_end," in plan

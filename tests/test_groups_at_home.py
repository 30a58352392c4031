"""Roll-ups move sales, never the many rows per node; sets of stores take as much room as they have stores."""

import datetime as dt

import pytest
from executed import exchanges
from pyspark.sql import functions as F

from martforge.operators import bitmaps, calendar, facts, kpi
from martforge.plans import queries as Q
from martforge.session import kept

WEEK = dt.date(2023, 1, 2)


def _rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def star(spark):
    """(sales, periods, geography bridge, product bridge, totals): 2,000 sales of 30 products over two years."""
    rows = []
    for i in range(2000):
        start = WEEK + dt.timedelta(days=7 * (i * 37 % 110))
        rows.append((i, i * 13 % 50, i * 7 % 30, start, start + dt.timedelta(days=6), i * 0.25, float(i % 4)))
    sales = kept(spark.createDataFrame(rows, "sales_id int, store_id int, product_id int, period_start date, period_end date, "
                                             "sales_amount double, sales_units double").repartition(4), "sales")
    periods = kept(calendar.period_dim_from(sales, "period_start", "period_end"), "periods")
    geo = spark.createDataFrame([(g, s) for s in range(50) for g in (1, 2 + s % 4, 10 + s % 8)], "geography_id int, store_id int")
    prod = spark.createDataFrame([(h, p) for p in range(30) for h in (p % 3, 10 + p % 6, 100 + p)], "hierarchy_id long, product_id int")
    totals = geo.groupBy("geography_id").agg(F.count(F.lit(1)).alias("total_stores"))
    return sales, periods, geo, prod, totals


def test_kpi_moves_no_more_rows_than_sales(spark, star):
    sales, periods, geo, prod, totals = star
    made = kpi.rollup_kpi(sales, periods, geo, prod, calendar.period_map(periods), totals)
    assert max(n for _, n in exchanges(made)) <= sales.count() < made.count()
    direct = facts.rollup_fact_direct(sales, periods, geo, prod)
    assert _rows(made) == _rows(kpi.kpi_fact(direct, calendar.period_map(periods), totals).select(*made.columns))


def test_bucketed_rollup_moves_no_more_rows_than_sales(spark, star):
    sales, periods, geo, prod, _ = star
    made = facts.rollup_bucketed(sales, prod, periods, geo)
    assert max(n for _, n in exchanges(made)) <= sales.count() < made.count()
    assert _rows(made) == _rows(facts.rollup_fact_direct(sales, periods, geo, prod, with_stores=False))


@pytest.mark.parametrize("hot_rows", [10**9, 40, 0])
def test_nodes_under_several_trees_and_hot_groups(spark, star, hot_rows):
    sales, periods, geo, prod, _ = star
    mixed = prod.unionByName(spark.createDataFrame([(500, p) for p in (0, 1, 7)] + [(500, 0)], prod.schema))
    direct = _rows(facts.rollup_fact(sales, periods, geo, mixed, with_stores=False))
    assert direct == _rows(facts.rollup_fact_direct(sales, periods, geo, mixed, with_stores=False))
    assert direct == _rows(facts.rollup_fact(sales, periods, geo, mixed, with_stores=False, hot_rows=hot_rows))
    assert direct == _rows(facts.rollup_bucketed(sales, mixed, periods, geo))


def test_chains_hold_all_linked_periods(spark):
    periods = spark.createDataFrame([(i,) for i in range(6)], "period_id long")
    pmap = spark.createDataFrame([(5, 3), (3, 1), (4, 1), (2, 0)], "period_id long, period_id_ya long")
    assert _rows(kpi.chains(pmap, periods)) == [(0, 0), (1, 1), (2, 0), (3, 1), (4, 1), (5, 1)]


def test_a_cell_of_one_store_takes_one_word(spark, layers):
    made = {}

    def keep(cells, name):
        made[name] = Q.kept(cells, name)
        return made[name]

    from martforge.plans import retail

    bitmaps.rollup_fact_bitmaps(layers.sales, layers.dim_date, layers.stores, layers.products, layers.dim_geography,
                                layers.dim_product, retail.GEOGRAPHY, retail.PRODUCT, keep)
    sold = layers.sales.count()
    for cells in made.values():
        assert cells.agg(F.sum(F.size("__stores"))).first()[0] <= sold
        assert not [t for _, t in cells.dtypes if t == "binary"]

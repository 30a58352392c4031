"""What a query holds on disk at once: no rows per node are moved for large groups, and a finished step leaves no shuffle files."""

import datetime as dt
import os

import pytest
from executed import exchanges
from pyspark.sql import functions as F

from martforge.operators import calendar, facts, kpi
from martforge.session import kept

WEEK = dt.date(2023, 1, 2)


def _rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def star(spark):
    """(sales, periods, geography bridge, product bridge, totals): 3,000 sales under two departments, six categories and 30 items."""
    rows = []
    for i in range(3000):
        start = WEEK + dt.timedelta(days=7 * (i * 37 % 110))
        rows.append((i, i * 13 % 50, i * 7 % 30, start, start + dt.timedelta(days=6), i * 0.25, float(i % 4)))
    sales = kept(spark.createDataFrame(rows, "sales_id int, store_id int, product_id int, period_start date, period_end date, "
                                             "sales_amount double, sales_units double").repartition(4), "sales")
    periods = kept(calendar.period_dim_from(sales, "period_start", "period_end"), "periods")
    geo = spark.createDataFrame([(g, s) for s in range(50) for g in (1, 2 + s % 4, 10 + s % 8)], "geography_id int, store_id int")
    prod = spark.createDataFrame([(h, p) for p in range(30) for h in (p % 2, 10 + p % 6, 100 + p)], "hierarchy_id long, product_id int")
    return sales, periods, geo, prod, geo.groupBy("geography_id").agg(F.count(F.lit(1)).alias("total_stores"))


def test_groups_too_large_for_a_task_move_sales_and_not_their_nodes(star):
    sales, periods, geo, prod, _ = star
    chains = kpi.chains(calendar.period_map(periods), periods)
    # A department has up to some 55 sales in a chain, 26 on average, a category up to 30.
    parts = facts.rollup_parts(sales, periods, geo, prod, chains=chains, hot_rows=40, node_rows=15)
    made = parts[0]
    for part in parts[1:]:
        made = made.unionByName(part)
    assert len(parts) == 2 and max(n for _, n in exchanges(made)) <= sales.count() < made.count()
    direct = _rows(facts.rollup_fact_direct(sales, periods, geo, prod))
    assert direct == _rows(made.drop("__slot").select(*facts.rollup_fact_direct(sales, periods, geo, prod).columns))


@pytest.mark.parametrize("node_rows", [0, 5, 15, 10**9])
@pytest.mark.parametrize("hot_rows", [3, 10**9])
def test_wide_nodes_under_several_trees(spark, star, node_rows, hot_rows):
    sales, periods, geo, prod, _ = star
    mixed = prod.unionByName(spark.createDataFrame([(500, p) for p in (0, 1, 7, 12, 13)] + [(500, 0), (0, 2)], prod.schema))
    direct = _rows(facts.rollup_fact_direct(sales, periods, geo, mixed, with_stores=False))
    parts = facts.rollup_parts(sales, periods, geo, mixed, with_stores=False, hot_rows=hot_rows, node_rows=node_rows)
    assert direct == sorted(r for p in parts for r in _rows(p.drop("__slot")))


def test_stores_with_their_own_sets_of_nodes(star, monkeypatch):
    sales, periods, geo, prod, _ = star
    direct = _rows(facts.rollup_fact_direct(sales, periods, geo, prod))
    monkeypatch.setattr(facts, "MAX_SETS", 3)
    assert direct == _rows(facts.rollup_fact(sales, periods, geo, prod))


def _shuffle_bytes(spark):
    top = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return sum(os.path.getsize(os.path.join(d, f)) for t in top for d, _, fs in os.walk(t) for f in fs if f.startswith("shuffle_"))


def test_a_written_step_leaves_no_shuffle_files(spark):
    rows = spark.range(200_000).select((F.col("id") * 7919 % 200_003).alias("k"), F.rand(1).alias("v"))
    before = _shuffle_bytes(spark)
    back = kept(rows.repartition(5, "k"), "moved")
    assert back.count() == 200_000 and _shuffle_bytes(spark) - before < 100_000 < 200_000 * 4


def _scratch(spark):
    """Folders of scratch tables."""
    from martforge.session import app_id, ensure_checkpoint_dir

    top = os.path.join(ensure_checkpoint_dir(spark).removeprefix("file:"), "martforge", app_id(spark))
    return set(os.listdir(top)) if os.path.isdir(top) else set()


def test_storing_the_fact_by_period_moves_no_row_of_it(spark, layers, monkeypatch):
    from martforge.plans import medallion

    g = medallion.Gold(layers.stores, layers.products, layers.sales)
    g.tables()
    before, hint = _scratch(spark), type(layers.sales).hint

    def only_joins(df, name, *more):
        assert name != "rebalance"
        return hint(df, name, *more)

    monkeypatch.setattr(type(layers.sales), "hint", only_joins)
    stored = g.fct_sales
    assert len(_scratch(spark) - before) == 1  # the stored fact; what it was made of is gone
    assert _rows(stored) == _rows(g.kpi().select(*stored.columns))
    folders = {}
    for f in stored.inputFiles():
        folders.setdefault(f.rsplit("/", 1)[0], []).append(f)
    assert max(map(len, folders.values())) <= 2


def test_z_order_is_made_in_slices_that_follow_each_other(spark, layers):
    from martforge.functions.zorder import largest_of, zorder_key, zorder_slices
    from martforge.plans import queries as Q

    layers.tables()
    before, keys = _scratch(spark), ["geography_id", "hierarchy_id", "period_id"]
    whole = kept(layers.kpi(), "whole")
    largest = largest_of(whole, keys)
    slices = zorder_slices(whole, keys, largest, 5)
    ends = [s.agg(F.min(zorder_key(largest)), F.max(zorder_key(largest)), F.count(F.lit(1))).first() for s in slices]
    assert 3 <= len(slices) <= 6 and sum(e[2] for e in ends) == whole.count()
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:])) and max(e[2] for e in ends) < whole.count() / 2
    inside = _scratch(spark)
    made = Q.zordered_fact(layers, 4, slice_rows=-(-whole.count() // 5))
    assert len(_scratch(spark) - inside) == 1 and before <= inside
    assert _rows(made.select(*whole.columns)) == _rows(whole)


def test_a_refresh_in_steps_leaves_only_the_mart(spark, tmp_path, monkeypatch):
    import test_incremental as t
    from martforge.operators import hierarchy
    from martforge.plans import incremental, retail
    from martforge.sources.layers import Lake

    rng = __import__("random").Random(11)
    stores = spark.createDataFrame([(i, f"d{i % 5}", f"t{i % 2}", "c") for i in range(12)],
                                   "store_id int, store_district string, store_state string, store_country string")
    products = spark.createDataFrame([(f"p{i % 2}", f"q{i % 4}", i, f"item{i}") for i in range(9)],
                                     "department string, category string, product_id int, item string")
    geo, prod = (kept(hierarchy.bridge(x, hierarchy.hierarchy_dim(x, spec), spec), "bridge")
                 for x, spec in ((stores, retail.GEOGRAPHY), (products, retail.PRODUCT)))
    dims = incremental.Dimensions(geo, prod, kept(facts.node_totals(geo), "totals"))
    sales = [t.sale(0, rng, 0)] + [t.sale(i, rng) for i in range(1, 200)]
    late = [t.sale(500 + i, rng, w) for i, w in enumerate((3, 40, 41, 70))]
    before, lake = _scratch(spark), Lake(str(tmp_path / "mart"))
    incremental.build(t.frame(spark, sales), lake, dims)
    monkeypatch.setattr(incremental, "PERIODS_AT_ONCE", 2)
    done = incremental.refresh(t.frame(spark, late), spark.createDataFrame([(7,)], "sales_id int"), lake, dims)
    assert len(done.recomputed) > 4 and _scratch(spark) == before
    after = [r for r in sales if r[0] != 7] + late
    assert t.stored(spark, lake) == t.full(spark, after, dims, str(tmp_path / "full"))


def test_bitmap_levels_go_when_nothing_more_is_made_from_them(spark, layers):
    from martforge.operators import bitmaps
    from martforge.plans import retail
    from martforge.session import drop_kept

    layers.tables()
    alive, most, before = {}, [0], _scratch(spark)

    def keep(cells, name):
        table = kept(cells, name)
        if name.startswith("cells"):
            alive[id(table)] = table
            most[0] = max(most[0], len(alive))
        return table

    def done(cells):
        del alive[id(cells)]
        drop_kept(cells)

    fact = bitmaps.rollup_fact_bitmaps(layers.sales, layers.dim_date, layers.stores, layers.products, layers.dim_geography,
                                       layers.dim_product, retail.GEOGRAPHY, retail.PRODUCT, keep, done)
    assert most[0] == 3 and not alive
    assert _rows(fact) == _rows(layers.fact_base().select(*fact.columns)) and before <= _scratch(spark)

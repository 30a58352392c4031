"""Randomised differential test: the Spark KPI (roll-up, bridges, routes, dense ids) equals a plain
Python computation from the definitions on the same silver tables.

The data has a hot store with about a third of all sales rows, orphan keys, NULL countries,
zero and negative amounts, and several years of weeks.
"""

import collections
import datetime as dt
import random

import pytest

from martforge.operators import calendar
from martforge.plans import medallion


def _data(seed: int):
    rnd = random.Random(seed)
    countries = ["C1", "C2", None]
    stores = []
    for sid in range(1, 41):
        c = rnd.choice(countries) if sid % 7 else None
        stores.append((sid, f"S{sid}", f"A{sid}", rnd.choice(["D1", "D2", "D3"]), rnd.choice(["S1", "S2"]), c))
    products = [(rnd.choice(["Dep1", "Dep2"]), rnd.choice(["Cat1", "Cat2", "Cat3"]), pid,
                 rnd.choice([f"I{pid}", None])) for pid in range(1, 31)]
    sales = []
    start = dt.date(2019, 12, 30)  # a Monday
    for sid in range(1, 900):
        store = 1 if rnd.random() < 0.34 else rnd.randint(1, 45)       # hot store, orphans > 40
        prod = rnd.randint(1, 33)                                       # orphans > 30
        wk = start + dt.timedelta(weeks=rnd.randint(0, 160))
        amount = rnd.choice([0.0, -5.25, round(rnd.uniform(1, 500), 2)])
        sales.append((sid, store, prod, wk, wk + dt.timedelta(days=6), amount, float(rnd.randint(0, 9))))
    return stores, products, sales


STORE_SCHEMA = "store_id bigint, store_name string, store_addr string, store_district string, " \
               "store_state string, store_country string"
PRODUCT_SCHEMA = "department string, category string, product_id int, item string"
SALES_SCHEMA = "sales_id bigint, store_id bigint, product_id int, period_start date, period_end date, " \
               "sales_amount double, sales_units double"


def _nodes(row, levels):
    """Path of each level that a leaf belongs to; no null path part matches."""
    return [path for path in (tuple(row[:n]) for n in levels) if None not in path]


def _plain_kpi(stores, products, sales, geo_ids, node_ids, years, basis, unmatched):
    """The KPI by dictionaries: facts, totals, comparison weeks and percentages from their definitions."""
    first = dt.date(2019, 12, 29)
    geo = {s[0]: [geo_ids[p] for p in _nodes((s[5], s[4], s[3]), (1, 2, 3))] for s in stores}
    item = {p[2]: [node_ids[x] for x in _nodes((p[0], p[1], p[2]), (1, 2, 3))] for p in products}
    fact = collections.defaultdict(lambda: [0, 0, set()])
    for _, store, product, start, end, amount, units in sales:
        weeks, rest = divmod((end - first).days, 7)
        if rest or end - start != dt.timedelta(days=6) or end > dt.date(2023, 12, 31):
            continue
        for g in geo.get(store, []):
            for n in item.get(product, []):
                cell = fact[g, n, weeks + 1]
                cell[0] += round(amount * 100)
                cell[1] += round(units * 100)
                cell[2].add(store)
    totals = collections.Counter(g for nodes in geo.values() for g in nodes)
    starts = {k + 1: first + dt.timedelta(days=7 * k - 6) for k in range(1, (dt.date(2023, 12, 31) - first).days // 7 + 1)}
    year = (lambda d: d.year) if basis == "calendar" else (lambda d: d.isocalendar()[0])
    weeks = collections.defaultdict(list)
    for p, d in starts.items():
        weeks[year(d), d.isocalendar()[1]].append(p)
    out = []
    for (g, n, p), (amount, units, who) in fact.items():
        others = weeks.get((year(starts[p]) + years, starts[p].isocalendar()[1]), []) if p in starts else []
        for q in others or ([None] if unmatched == "keep" else []):
            then = fact.get((g, n, q))
            now, past = (amount / 100, units / 100, len(who)), (then[0] / 100, then[1] / 100, len(then[2])) if then else None
            out.append((g, n, p, *now, past, totals[g]))
    return out


@pytest.mark.parametrize("seed,years,basis,unmatched", [(1, -1, "iso", "keep"), (2, 1, "calendar", "drop"),
                                                        (3, -1, "calendar", "keep")])
def test_kpi_matches_plain_python(spark, seed, years, basis, unmatched):
    stores, products, sales = _data(seed)
    s = spark.createDataFrame(stores, STORE_SCHEMA)
    p = spark.createDataFrame(products, PRODUCT_SCHEMA)
    f = spark.createDataFrame(sales, SALES_SCHEMA)
    g = medallion.Gold(s, p, f, dim_date=calendar.period_dim(spark, "2019-12-29", "2023-12-31"), materialize=False)
    geo = {tuple(x for x in (r.store_country, r.store_state, r.store_district)[:{"country": 1, "state": 2, "district": 3}[r.level]]):
           r.geography_id for r in g.dim_geography.collect()}
    node = {(r.department, r.category, r.product_id)[:{"department": 1, "category": 2, "item": 3}[r.level]]: r.hierarchy_id
            for r in g.dim_product.collect()}
    want = _plain_kpi(stores, products, sales, geo, node, years, basis, unmatched)
    got = g.kpi(years, basis, unmatched).collect()
    assert len(got) == len(want) > 0

    def near(a, b):
        return a == b or (a is not None and b is not None and abs(a - b) <= 0.00501)

    key = lambda r: (*r[:3], r[6][:2] if r[6] else (0, 0))
    ordered = sorted(got, key=lambda r: (r.geography_id, r.hierarchy_id, r.period_id, (r.sales_ya, r.units_ya)))
    for r, (gid, nid, pid, amount, units, selling, past, total) in zip(ordered, sorted(want, key=key), strict=True):
        assert (r.geography_id, r.hierarchy_id, r.period_id, r.sales, r.units, r.stores_selling, r.total_stores) == \
            (gid, nid, pid, amount, units, selling, total)
        assert (r.sales_ya, r.units_ya, r.stores_selling_ya) == (past or (0.0, 0.0, 0))
        assert near(r.sales_growth_pct, (amount - past[0]) / past[0] * 100 if past and past[0] else None)
        assert near(r.stores_growth_pct, (selling - past[2]) / past[2] * 100 if past and past[2] else None)
        assert near(r.store_penetration_pct, selling * 100 / total)

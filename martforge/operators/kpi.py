"""Period-over-period KPI fact: growth and store penetration."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.functions.columns import growth_pct, share_pct
from martforge.functions.sizing import checked_broadcast
from martforge.operators import facts

KEYS = ("geography_id", "hierarchy_id", "period_id")


def routes(pmap: DataFrame, periods: DataFrame, unmatched: str = "keep") -> DataFrame:
    """Flat routing table: (period_id = source period, p, q, tag).

    A fact row of period x feeds (x, q) as the *current* row (tag 0) for each
    comparison period q of x, and (p, x) as the *comparison* row (tag 1) for
    each period p compared against x. ``unmatched='keep'`` adds (x, NULL) for
    periods without a comparison; ``'drop'`` leaves them out (inner join, as
    originally coded). Built from one left join of the periods to the map;
    size: a few rows per calendar period.
    """
    pairs = periods.select("period_id").join(pmap.select("period_id", "period_id_ya"), "period_id", "left")
    x, q = F.col("period_id"), F.col("period_id_ya")
    as_current = F.struct(x.alias("period_id"), x.alias("p"), q.alias("q"), F.lit(0).alias("tag"))
    as_compared = F.struct(q.alias("period_id"), x.alias("p"), q.alias("q"), F.lit(1).alias("tag"))
    out = pairs.select(F.explode(F.array(as_current, as_compared)).alias("r")).select("r.*")
    keep = F.col("q").isNotNull()
    if unmatched == "keep":
        keep = keep | (F.col("tag") == 0)
    return out.filter(keep)


def route(df: DataFrame, pmap: DataFrame, periods: DataFrame, unmatched: str = "keep", only: list[int] | None = None) -> DataFrame:
    """Send each row of ``df`` (which has ``period_id``) to its targets (``p``, ``q``, ``tag``).

    A broadcast hash join with the flat routing table (a few rows per period, and
    ``operators.calendar`` bounds the periods): a row matching several routes is
    emitted once per route, without building arrays per row.
    """
    targets = routes(pmap, periods, unmatched)
    return df.join(F.broadcast(targets if only is None else targets.filter(F.col("p").isin(only))), "period_id")


def chains(pmap: DataFrame, periods: DataFrame) -> DataFrame:
    """(period_id, __chain): periods that the map links, directly or through others, share a chain (its least period).

    Periods are few (``calendar.MAX_STEPS``), so their links are followed on the driver.
    """
    links = [(r[0], r[1]) for r in pmap.select("period_id", "period_id_ya").distinct().collect()]
    own = [r[0] for r in periods.select("period_id").distinct().collect()]
    above = {p: p for pair in links for p in pair} | {p: p for p in own}

    def top(p):
        while above[p] != p:
            above[p] = above[above[p]]
            p = above[p]
        return p

    for a, b in links:
        low, high = sorted((top(a), top(b)))
        above[high] = low
    return periods.sparkSession.createDataFrame([(p, top(p)) for p in above], f"period_id {dict(periods.dtypes)['period_id']}, __chain long")


def _comparison(fact: DataFrame, pmap: DataFrame, unmatched: str, measures: list[str], periods: DataFrame | None = None,
                groups: tuple[str, ...] = (), only: list[int] | None = None) -> DataFrame:
    """Attach the comparison period and its measures (``ya_<m>``) to every fact row.

    Equivalent to ``fact JOIN map LEFT JOIN fact AS ya ON (map.period_id_ya,
    geo, node)``, computed in one pass over the fact: every row is emitted as
    the *current* row of its own (period, comparison period) pairs and as the
    *comparison* row of the pairs that point at it, then one aggregation on
    (geo, node, period, comparison period) puts the two together. Each group
    holds at most two rows, so no key can be hot. Pass the period dimension as
    ``periods`` to read the fact once; without it the fact's own periods are
    listed first (one extra pass). ``groups``: columns that a row and its comparison
    share; a fact that lies partitioned by them is compared where it is. ``only``: the periods that are
    asked for; rows that no comparison of these needs are left where they are.
    """
    f = fact.select(*groups, "geography_id", "hierarchy_id", "period_id", *measures)
    rows = route(f, pmap, periods if periods is not None else f.select("period_id").distinct(), unmatched, only)
    is_cur, is_ya = F.col("tag") == 0, F.col("tag") == 1
    aggs = [F.max(is_cur).alias("__has_cur")]
    aggs += [F.max(F.when(is_cur, F.col(m))).alias(m) for m in measures]
    aggs += [F.max(F.when(is_ya, F.col(m))).alias(f"ya_{m}") for m in measures]
    return (rows.groupBy(*groups, "geography_id", "hierarchy_id", F.col("p").alias("period_id"),
                         F.col("q").alias("period_id_ya"))
            .agg(*aggs).filter(F.col("__has_cur")).drop("__has_cur", *groups))


def _growth_columns(j: DataFrame, digits: int | None) -> DataFrame:
    return j.select(*KEYS, "sales", "units",
                    F.coalesce(F.col("ya_sales"), F.lit(0.0)).alias("sales_ya"),
                    F.coalesce(F.col("ya_units"), F.lit(0.0)).alias("units_ya"),
                    growth_pct("sales", "ya_sales", digits).alias("sales_growth_pct"),
                    growth_pct("units", "ya_units", digits).alias("units_growth_pct"))


def kpi_fact(fact: DataFrame, pmap: DataFrame, totals: DataFrame, unmatched: str = "keep",
             digits: int | None = 2, periods: DataFrame | None = None, only: list[int] | None = None) -> DataFrame:
    """The 15-column KPI fact from a fact table.

    ``fact``: geography_id, hierarchy_id, period_id, sales, units, stores_selling.
    ``totals``: geography_id, total_stores (one row per geography node).
    ``periods``: the period dimension (optional, saves a pass over the fact).
    ``only``: the periods whose rows are wanted (optional).
    """
    return _kpi_columns(_comparison(fact, pmap, unmatched, ["sales", "units", "stores_selling"], periods, only=only),
                        totals, digits)


def _kpi_columns(j: DataFrame, totals: DataFrame, digits: int | None) -> DataFrame:
    return kpi_columns(_with_totals(j, totals), digits)


def _with_totals(j: DataFrame, totals: DataFrame) -> DataFrame:
    # Measured first: geography nodes are mostly few, and the fact should stay where it is.
    return j.join(checked_broadcast(totals.select("geography_id", "total_stores")), "geography_id", "left")


def kpi_columns(j: DataFrame, digits: int | None = 2) -> DataFrame:
    """The 15 columns, row by row, from a period's measures beside those of its comparison period (``rollup_compared``)."""
    ss_ya = F.coalesce(F.col("ya_stores_selling"), F.lit(0)).cast("bigint")
    return j.select(
        *KEYS, "sales", "units",
        F.coalesce(F.col("ya_sales"), F.lit(0.0)).alias("sales_ya"),
        F.coalesce(F.col("ya_units"), F.lit(0.0)).alias("units_ya"),
        growth_pct("sales", "ya_sales", digits).alias("sales_growth_pct"),
        growth_pct("units", "ya_units", digits).alias("units_growth_pct"),
        "stores_selling",
        ss_ya.alias("stores_selling_ya"),
        "total_stores",
        share_pct("stores_selling", "total_stores", digits).alias("store_penetration_pct"),
        share_pct(ss_ya, "total_stores", digits).alias("store_penetration_pct_ya"),
        growth_pct("stores_selling", "ya_stores_selling", digits).alias("stores_growth_pct"),
    )


def rollup_compared(sales: DataFrame, periods: DataFrame, geo_bridge: DataFrame, prod_bridge: DataFrame, pmap: DataFrame,
                    totals: DataFrame, unmatched: str = "keep", amount_scale: int = facts.AMOUNT_SCALE,
                    units_scale: int = facts.UNITS_SCALE) -> DataFrame:
    """What ``kpi_columns`` makes the KPI fact of: as many rows, without the columns that follow from others; for rows that still move."""
    parts = _parts(sales, periods, geo_bridge, prod_bridge, pmap, True, amount_scale, units_scale)
    return _with_totals(_compared(parts, pmap, unmatched, periods, True), totals).drop("period_id_ya")


def _parts(sales: DataFrame, periods: DataFrame, geo_bridge: DataFrame, prod_bridge: DataFrame, pmap: DataFrame,
           with_stores: bool, amount_scale: int, units_scale: int) -> list[DataFrame]:
    return facts.rollup_parts(sales, periods, geo_bridge, prod_bridge, with_stores=with_stores, amount_scale=amount_scale,
                              units_scale=units_scale, chains=chains(pmap, periods))


def _compared(parts: list[DataFrame], pmap: DataFrame, unmatched: str, periods: DataFrame, with_stores: bool) -> DataFrame:
    measures = ["sales", "units", *(["stores_selling"] if with_stores else [])]
    return reduce(DataFrame.unionByName, [_comparison(p, pmap, unmatched, measures, periods, ("__slot",)) for p in parts])


def rollup_fact_and_kpi(sales: DataFrame, periods: DataFrame, geo_bridge: DataFrame, prod_bridge: DataFrame, pmap: DataFrame,
                        totals: DataFrame, unmatched: str = "keep") -> tuple[DataFrame, DataFrame]:
    """(``facts.rollup_fact``, ``kpi_fact`` of it), each from the sales where their groups lie; the sales are placed once for both.

    To be written each: a task of either holds few periods, and no row of the fact is moved for its comparison.
    """
    parts = _parts(sales, periods, geo_bridge, prod_bridge, pmap, True, facts.AMOUNT_SCALE, facts.UNITS_SCALE)
    fact = reduce(DataFrame.unionByName, parts).drop("__slot")
    return fact, _kpi_columns(_compared(parts, pmap, unmatched, periods, True), totals, 2)


def rollup_kpi(sales: DataFrame, periods: DataFrame, geo_bridge: DataFrame, prod_bridge: DataFrame,
               pmap: DataFrame, totals: DataFrame | None, unmatched: str = "keep", digits: int | None = 2,
               with_stores: bool = True, amount_scale: int = facts.AMOUNT_SCALE,
               units_scale: int = facts.UNITS_SCALE) -> DataFrame:
    """KPI fact straight from sales: the roll-up by (tree, chain of compared periods), compared where its groups lie.

    With ``with_stores=False`` and ``totals=None`` it yields the growth preview.
    """
    parts = _parts(sales, periods, geo_bridge, prod_bridge, pmap, with_stores, amount_scale, units_scale)
    j = _compared(parts, pmap, unmatched, periods, with_stores)
    if not with_stores:
        return _growth_columns(j, digits)
    if totals is None:
        raise ValueError("the KPI with store measures needs node totals (geography_id, total_stores)")
    return _kpi_columns(j, totals, digits)

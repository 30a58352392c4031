"""name -> DuckDB SQL, one per registered query."""

from __future__ import annotations

from martforge.plans import oracle as o
from martforge.plans.queries import (
    DRILL_DISTRICT,
    LOOKUP_BRIDGE_NODE,
    LOOKUP_GEO,
    LOOKUP_NODE,
    LOOKUP_PERIOD,
    LOOKUP_STORE,
    TABLES,
)


def _union(parts: list[str]) -> str:
    return "\nunion all\n".join(parts)


def _with(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


SILVER_ONLY = _with(o.SILVER_CTES)
DERIVED_DIM = o.dim_date_ctes(o.FX_SALES)


def _period_map(years: int, basis: str) -> str:
    return _with(DERIVED_DIM, o.period_map_ctes(years, basis)) + "select period_id, period_id_ya from week_pairs"


DQ_SUMMARY = _union([
    f"select '{name}' as table_name, count(*) as input_rows, count(case when {valid} then 1 end) as valid_rows, "
    f"count(case when not ({valid}) then 1 end) as rejected_rows from ({o.lower_raw(src, cols)}) __t"
    for name, src, cols, valid in [
        ("stores", o.RAW_STORES, o.RAW_STORE_COLS, o.STORE_VALID),
        ("products", o.RAW_PRODUCTS, o.RAW_PRODUCT_COLS, o.PRODUCT_VALID),
        ("sales", o.RAW_SALES, o.RAW_SALES_COLS, o.SALES_VALID)]])

ORACLE: dict[str, str] = {
    # ---------------------------------------------------------- IO
    "scan_parquet": "select * from events",
    "row_counts": _union([f"select '{t}' as table_name, count(*) as row_count from {t}" for t in TABLES]),
    "layer_roundtrip": "select * from orders union all select * from orders",
    "sink_error_if_exists": ("select 1 as attempt, 'written' as status, count(*) as rows_in_target from lineitem "
                             "union all select 2, 'PATH_ALREADY_EXISTS', count(*) from lineitem"),
    "snapshot_tables": _union([f"select '{t}' as table_name, 'ok' as status, count(*) as row_count, "
                               f"cast(null as varchar) as error from {t}" for t in TABLES]),
    "snapshot_status": _union(
        [f"select '{t}' as table_name, 'ok' as status, count(*) as row_count, cast(null as varchar) as error from {t}"
         for t in ["region", "nation", "customer"]]
        + ["select 'store_info', 'failed', cast(null as bigint), 'PATH_NOT_FOUND'"]),
    "snapshot_us": "select * exclude (ts), epoch_us(ts) as ts_us from events",
    "snapshot_truncated": "select * exclude (ts), epoch_us(ts) as ts_us from events",
    "versioned_overwrite": SILVER_ONLY + "select * from silver_products",
    "view_replace": o.gold_with() + "select * from dim_geography",
    "file_inventory": _union([f"select '{t}' as table_name, '{t}.parquet' as file_name, count(*) as row_count from {t}"
                              for t in TABLES]),
    "catalog_tables": SILVER_ONLY + "select * from silver_stores",
    "insert_select": o.gold_with() + "select geography_id, cast(store_id as integer) as store_id from lkp_store_geography",
    "ctas_replace": o.kpi_sql(-1, "iso", "keep"),
    "dim_scan": o.gold_with() + "select * from dim_geography",
    # ---------------------------------------------------------- bronze / silver
    "bronze_ingest": f"select *, true as stamped from ({o.RAW_SALES}) __r",
    "bronze_stream": "select *, true as stamped from lineitem",
    "lowercase_columns": o.lower_raw(o.RAW_STORES, o.RAW_STORE_COLS),
    "dedupe_by_key": o.dedupe(o.FX_SALES, "sales_id", o.SALES_COLS),
    "conform_stores": o.conform_stores_sql(o.lower_raw(o.RAW_STORES, o.RAW_STORE_COLS)),
    "conform_products": o.conform_products_sql(o.lower_raw(o.RAW_PRODUCTS, o.RAW_PRODUCT_COLS)),
    "conform_sales": o.conform_sales_sql(o.lower_raw(o.RAW_SALES, o.RAW_SALES_COLS), True),
    "conform_products_strict": o.conform_products_sql(o.lower_raw(o.RAW_PRODUCTS, o.RAW_PRODUCT_COLS), strict=True),
    "quarantine_sales_strict": (f"select * from ({o.lower_raw(o.RAW_SALES, o.RAW_SALES_COLS)}) __q "
                                f"where not ({o.SALES_VALID} and {o.SALES_DATES_STRICT})"),
    "quarantine_stores": f"select * from ({o.lower_raw(o.RAW_STORES, o.RAW_STORE_COLS)}) __q where not ({o.STORE_VALID})",
    "quarantine_products": (f"select * from ({o.lower_raw(o.RAW_PRODUCTS, o.RAW_PRODUCT_COLS)}) __q "
                            f"where not ({o.PRODUCT_VALID})"),
    "quarantine_sales": f"select * from ({o.lower_raw(o.RAW_SALES, o.RAW_SALES_COLS)}) __q where not ({o.SALES_VALID})",
    "dq_summary": DQ_SUMMARY,
    "dq_summary_load": DQ_SUMMARY,
    # ---------------------------------------------------------- calendar
    "dim_date": _with(DERIVED_DIM) + "select * from dim_date",
    "daily_spine": ("select cast(unnest(generate_series(cast(min(cast(l_shipdate as date)) as timestamp), "
                    "cast(max(cast(l_shipdate as date)) as timestamp), interval 1 day)) as date) as date_value "
                    "from lineitem"),
    "daily_spine_by_count": ("select cast(min(cast(l_shipdate as date)) + cast(unnest(range(0, count(distinct cast(l_shipdate as date)))) "
                             "as integer) as date) as date_value from lineitem"),
    "calendar_attrs": _with(DERIVED_DIM) + """select period_id, period_start_date, period_end_date,
       cast(year(period_start_date) as integer) as year, cast(weekofyear(period_start_date) as integer) as week_num,
       cast(isoyear(period_start_date) as integer) as iso_year
from dim_date""",
    "period_ya_ref": _period_map(1, "calendar"),
    "period_ya_iso": _period_map(-1, "iso"),
    # ---------------------------------------------------------- dimensions and bridges
    "dim_product": _with(o.SILVER_CTES, o.DIM_PRODUCT_CTES) + "select * from dim_product",
    "dim_geography": _with(o.SILVER_CTES, o.DIM_GEO_CTES) + "select * from dim_geography",
    "dim_geo_level": _with(o.SILVER_CTES, o.DIM_GEO_CTES) + """select distinct
       cast(case level when 'country' then 1 when 'state' then 2 when 'district' then 3 end as integer) as level_order,
       level from dim_geography""",
    "bridge_store_geography": o.gold_with() + "select * from lkp_store_geography",
    "bridge_product_hierarchy": o.gold_with() + "select * from lkp_product_hierarchy",
    "bridge_theta_check": o.gold_with() + "select * from lkp_store_geography",
    "store_bridge_lookup": o.gold_with() + "select * from " + f"lkp_store_geography where store_id = {LOOKUP_STORE}",
    "period_lookup": _with(DERIVED_DIM) + f"select * from dim_date where period_id = {LOOKUP_PERIOD}",
    "bridge_lookup": o.gold_with() + f"select * from lkp_product_hierarchy where hierarchy_id = {LOOKUP_BRIDGE_NODE}",
    # ---------------------------------------------------------- facts
    "fact_period_join": o.gold_with() + f"""select s.*, p.period_id, p.period_start_date, p.period_end_date
from silver_sales s join dim_date p on s.period_start = p.period_start_date and s.period_end = p.period_end_date
where p.period_id = {LOOKUP_PERIOD}""",
    "fact_base": o.gold_with(o.FACT_CTE) + "select geography_id, hierarchy_id, period_id, sales, units from fact_base",
    "fact_base_stores": o.gold_with(o.FACT_CTE) + "select * from fact_base",
    "fact_base_bitmaps": o.gold_with(o.FACT_CTE) + "select * from fact_base",
    "fact_base_bucketed": o.gold_with(o.FACT_CTE) + "select geography_id, hierarchy_id, period_id, sales, units from fact_base",
    "sales_gaps": SILVER_ONLY + """select store_id, sales_id, period_start, previous_start,
       cast(period_start - previous_start as integer) as gap_days
from (select store_id, sales_id, period_start, lag(period_start) over (
          partition by store_id order by period_start nulls first, sales_id) as previous_start
      from silver_sales) s""",
    "irregular_periods": """select cast(row_number() over w as integer) as period_id,
       lag(day) over w + 1 as period_start_date, day as period_end_date
from (select distinct cast(o_orderdate as date) as day from orders where o_orderdate is not null) d window w as (order by day)""",
    "geography_ancestors": _with(o.SILVER_CTES, o.DIM_GEO_CTES).replace("with ", "with recursive ", 1).rstrip() + """,
up(node, ancestor, distance) as (
    select geography_id, geography_id, 0 from dim_geography
    union all
    select up.node, above.geography_id, up.distance + 1
    from up join dim_geography below on below.geography_id = up.ancestor
    join dim_geography above on above.store_country = below.store_country
     and ((below.level = 'district' and above.level = 'state' and above.store_state = below.store_state)
       or (below.level = 'state' and above.level = 'country')))
select * from up""",
    "bridge_by_ancestors": o.gold_with() + "select * from lkp_product_hierarchy",
    "total_stores": o.gold_with(o.FACT_CTE) + "select * from total_stores",
    # ---------------------------------------------------------- KPI
    "growth_preview": o.comparison_sql(1, "calendar", "drop", False, None),
    "fct_sales": o.kpi_sql(-1, "iso", "keep"),
    "fct_sales_incremental": o.kpi_sql(-1, "iso", "keep"),
    "kpi_zorder": f"""with fact as materialized (select * from ({o.kpi_sql(-1, 'iso', 'keep')}) __k)
select *, 'geography_id' as by from fact where geography_id = {LOOKUP_GEO}
union all select *, 'hierarchy_id' from fact where hierarchy_id = {LOOKUP_NODE}
union all select *, 'period_id' from fact where period_id = {LOOKUP_PERIOD}""",
    "fct_sales_ref": o.kpi_sql(1, "calendar", "drop"),
    "kpi_lookup": (f"select * from ({o.kpi_sql(-1, 'iso', 'keep')}) __k "
                   f"where geography_id = {LOOKUP_GEO} and hierarchy_id = {LOOKUP_NODE} and period_id = {LOOKUP_PERIOD}"),
    "sales_in_district": SILVER_ONLY + f"""select * from silver_sales
where store_id in (select store_id from silver_stores where store_district = '{DRILL_DISTRICT}')""",
    # ---------------------------------------------------------- generators
    "synthetic_fk": """with ref as (
    select n_nationkey + 1 as geo_id, r_name as state, n_name as district
    from nation join region on n_regionkey = r_regionkey),
k as (select count(*) as k from ref),
rows as (select c_custkey as store_id,
                ((((c_custkey % 2147483648) * 2654435761) % 4294967296) >> 16) % (select k from k) + 1 as geo
         from customer)
select store_id, concat('Store_', cast(store_id as varchar)) as store_name,
       concat('Address_', cast(store_id as varchar), ' Main Road') as store_addr,
       district as store_district, state as store_state, 'World' as store_country
from rows join ref on geo = geo_id""",
    "random_sample": f"""select * from ({o.FX_STORES}) __s
order by md5(concat(cast(store_id as varchar), 'seed')), store_id limit 20""",
    "expand_hierarchy": """with cats as (
    select p_type, p_brand, row_number() over (order by p_type nulls first, p_brand nulls first) as r
    from (select distinct p_type, p_brand from part) __c),
items as (
    select p_type, p_brand, unnest(generate_series(1, ((((r % 2147483648) * 2654435761) % 4294967296) >> 16) % 11 + 10)) as pos
    from cats),
numbered as (
    select p_type, p_brand, pos,
           row_number() over (order by p_type nulls first, p_brand nulls first, pos) + 9999 as item_no
    from items)
select p_type as department, p_brand as category, concat('ITM', cast(item_no as varchar)) as item_id,
       concat(upper(substr(lower(p_type), 1, 1)) || substr(lower(p_type), 2), ' ',
              substr(p_brand, 1, length(p_brand) - 1)) as item_name
from numbered""",
}

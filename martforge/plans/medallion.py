"""The bronze -> silver -> gold flow, lazily composed or materialised layer by layer."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame

from martforge.operators import calendar, facts, hierarchy, kpi
from martforge.operators.conform import ConformSpec, conform, lowercase_columns
from martforge.operators.quality import Rule, split
from martforge.plans import retail
from martforge.sources import layers
from martforge.session import kept, scratch_dropped, scratch_path


Source = DataFrame | Callable[[], DataFrame]


def silver(raw: DataFrame, rules: list[Rule], spec: ConformSpec) -> tuple[DataFrame, DataFrame]:
    """(conformed valid rows, rejected rows in raw shape with lower-cased names)."""
    valid, rejected = split(lowercase_columns(raw), rules)
    return conform(valid, spec), rejected


def silver_stores(raw: DataFrame) -> DataFrame:
    return silver(raw, retail.STORE_RULES, retail.STORE_CONFORM)[0]


def silver_products(raw: DataFrame) -> DataFrame:
    return silver(raw, retail.PRODUCT_RULES, retail.PRODUCT_CONFORM)[0]


def silver_sales(raw: DataFrame) -> DataFrame:
    return silver(raw, retail.SALES_RULES, retail.SALES_CONFORM)[0]


def keep(df: DataFrame) -> DataFrame:
    """Write ``df`` once under spark.checkpoint.dir and return the stored table."""
    return _keep(df, True)


def _keep(df: DataFrame, materialize: bool) -> DataFrame:
    # Written once as a table under spark.checkpoint.dir and read back: lineage
    # is cut, later size checks and joins read the stored rows, and the file
    # sizes give the planner real statistics.
    if not materialize:
        return df
    return kept(df, "gold")


class Gold:
    """Gold dimensions, bridges and facts over silver tables, each built on first use.

    ``stores``, ``products`` and ``sales`` are DataFrames or functions that
    give one; a function is called when its table is first needed, and its
    result written once (with ``materialize``). So whatever needs stores alone
    reads no sales. ``dim_date`` defaults to the weekly periods spanning the sales.
    """

    def __init__(self, stores: Source, products: Source, sales: Source | None = None,
                 dim_date: DataFrame | None = None, materialize: bool = True,
                 amount_scale: int = facts.AMOUNT_SCALE, units_scale: int = facts.UNITS_SCALE):
        self._sources = {"stores": stores, "products": products, "sales": sales}
        self._dim_date, self.materialize = dim_date, materialize
        self.scales = {"amount_scale": amount_scale, "units_scale": units_scale}

    def _source(self, name: str) -> DataFrame:
        source = self._sources[name]
        return _keep(source(), self.materialize) if callable(source) else source

    @cached_property
    def stores(self) -> DataFrame:
        return self._source("stores")

    @cached_property
    def products(self) -> DataFrame:
        return self._source("products")

    @cached_property
    def sales(self) -> DataFrame:
        return self._source("sales")

    @cached_property
    def dim_date(self) -> DataFrame:
        if self._dim_date is not None:
            return self._dim_date
        return _keep(calendar.period_dim_from(self.sales, "period_start", "period_end"), self.materialize)

    @cached_property
    def dim_product(self) -> DataFrame:
        return _keep(hierarchy.hierarchy_dim(self.products, retail.PRODUCT), self.materialize)

    @cached_property
    def dim_geography(self) -> DataFrame:
        return _keep(hierarchy.hierarchy_dim(self.stores, retail.GEOGRAPHY), self.materialize)

    @cached_property
    def lkp_store_geography(self) -> DataFrame:
        return _keep(hierarchy.bridge(self.stores, self.dim_geography, retail.GEOGRAPHY), self.materialize)

    @cached_property
    def lkp_product_hierarchy(self) -> DataFrame:
        return _keep(hierarchy.bridge(self.products, self.dim_product, retail.PRODUCT), self.materialize)

    def build_silver(self) -> "Gold":
        with ThreadPoolExecutor(max_workers=3) as pool:
            list(pool.map(lambda name: getattr(self, name), ("stores", "products", "sales")))
        return self

    def build(self) -> "Gold":
        """Materialise everything now. The geography chain (dimension, bridge,
        node totals) and the product chain are independent, so their jobs are
        submitted from two driver threads and run side by side."""
        chains = [("dim_geography", "lkp_store_geography", "node_totals"),
                  ("dim_product", "lkp_product_hierarchy"), ("dim_date",)]
        with ThreadPoolExecutor(max_workers=len(chains)) as pool:
            for f in [pool.submit(lambda c=c: [getattr(self, name) for name in c]) for c in chains]:
                f.result()
        return self

    def tables(self) -> None:
        """Build what the facts are made of, so that scratch tables of a fact can be told from it."""
        for name in ("sales", "dim_date", "lkp_store_geography", "lkp_product_hierarchy", "node_totals"):
            getattr(self, name)

    def fact_base(self, with_stores: bool = True) -> DataFrame:
        return facts.rollup_fact(self.sales, self.dim_date, self.lkp_store_geography,
                                 self.lkp_product_hierarchy, with_stores=with_stores, **self.scales)

    @cached_property
    def node_totals(self) -> DataFrame:
        return _keep(facts.node_totals(self.lkp_store_geography), self.materialize)

    def total_stores(self) -> DataFrame:
        return self.node_totals

    def period_map(self, years: int = -1, basis: str = "iso") -> DataFrame:
        return calendar.period_map(self.dim_date, years, basis)

    def kpi(self, years: int = -1, basis: str = "iso", unmatched: str = "keep") -> DataFrame:
        return kpi.rollup_kpi(self.sales, self.dim_date, self.lkp_store_geography, self.lkp_product_hierarchy,
                              self.period_map(years, basis), self.total_stores(), unmatched=unmatched, **self.scales)

    def compared(self, years: int = -1, basis: str = "iso", unmatched: str = "keep") -> DataFrame:
        """The rows of ``kpi`` before ``kpi.kpi_columns``: a third fewer columns, for a layout that moves them."""
        return kpi.rollup_compared(self.sales, self.dim_date, self.lkp_store_geography, self.lkp_product_hierarchy,
                                   self.period_map(years, basis), self.total_stores(), unmatched, **self.scales)

    @cached_property
    def fct_sales(self) -> DataFrame:
        """The stored KPI fact, one folder per period: a lookup reads the folder of its period."""
        spark = self.sales.sparkSession
        path = scratch_path(spark, "fct_sales")
        self.tables()
        with scratch_dropped(spark):
            fact = self.kpi()
            # A task of the roll-up holds the few periods of one chain, so its rows are written by period where they are.
            layers.write_by(fact, path, ["period_id"], gathered=True)
        return spark.read.schema(fact.schema).parquet(path).select(*fact.columns)

    def growth_preview(self, years: int = 1, basis: str = "calendar", unmatched: str = "drop") -> DataFrame:
        return kpi.rollup_kpi(self.sales, self.dim_date, self.lkp_store_geography, self.lkp_product_hierarchy,
                              self.period_map(years, basis), None, unmatched=unmatched, digits=None,
                              with_stores=False, **self.scales)

"""The whole medallion job, materialised layer by layer under one lake root.

bronze   raw tables + ingestion timestamp (write-once by default)
silver   valid rows conformed and de-duplicated; rejected rows to quarantine
gold     dim_date, dim_product, dim_geography, dim_geo_level,
         lkp_store_geography, lkp_product_hierarchy, fct_sales
Each layer is read back from storage by the next one. A rerun goes on where
the last one stopped: tables that were written to their end are kept, the
first one that is missing and all layers after it are built.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.operators import bronze, calendar, facts, hierarchy, kpi
from martforge.operators.conform import ConformSpec, conform, lowercase_columns
from martforge.operators.quality import COUNTS_SCHEMA, Rule, counted_split, counts_row
from martforge.plans import retail
from martforge.plans.medallion import Gold
from martforge.sources.layers import Lake, register_tables

RAW = {"stores": "store_info", "products": "product_info", "sales": "sales_fact"}
SPECS: dict[str, tuple[list[Rule], ConformSpec]] = {
    "stores": (retail.STORE_RULES, retail.STORE_CONFORM),
    "products": (retail.PRODUCT_RULES, retail.PRODUCT_CONFORM),
    "sales": (retail.SALES_RULES, retail.SALES_CONFORM),
}
#: Strict rules: dates that do not parse or lie outside the calendar, ids that overflow and too fine measures go to quarantine.
SPECS_STRICT: dict[str, tuple[list[Rule], ConformSpec]] = {
    **SPECS,
    "products": (retail.PRODUCT_RULES_STRICT, retail.PRODUCT_CONFORM),
    "sales": (retail.SALES_RULES_STRICT, retail.SALES_CONFORM),
}
GOLD = ("dim_date", "dim_geography", "dim_geo_level", "lkp_store_geography", "total_stores", "dim_product",
        "lkp_product_hierarchy", "fct_sales")


@dataclass
class PipelineConfig:
    # Bounds of the period dimension; by default the weeks that the sales span.
    first_end: str | None = None
    last_end: str | None = None
    years: int = -1
    basis: str = "iso"
    unmatched: str = "keep"
    bronze_mode: str = "errorifexists"
    # Quarantine by the strict rules as well.
    strict: bool = False
    # Digits after the point that measures are summed with.
    amount_scale: int = facts.AMOUNT_SCALE
    units_scale: int = facts.UNITS_SCALE
    # Keep complete tables of an earlier, failed run. A complete lake is left as it is.
    resume: bool = True
    schemas: tuple[str, str] = ("silver", "gold")
    # Optional layout of the fact table: partition folders and/or a sort inside
    # each file, so point lookups prune folders and row groups (min/max stats).
    fact_partition_by: tuple[str, ...] = ()
    fact_cluster_by: tuple[str, ...] = ()


def run_bronze(spark: SparkSession, readers: dict[str, Callable[[], DataFrame]], lake: Lake, mode: str,
               resume: bool = False) -> bool:
    """Write the raw tables; with ``resume`` only those that are not complete. Whether any was written."""
    wrote = False
    for name, read in readers.items():
        if not (resume and lake.complete(spark, "bronze", RAW[name])):
            lake.write(bronze.ingest(read()), "bronze", RAW[name], mode="overwrite" if resume else mode)
            wrote = True
    return wrote


def run_silver(spark: SparkSession, lake: Lake, resume: bool = False, strict: bool = False) -> bool:
    """Silver and quarantine are two filtered passes over each bronze table.

    Two scans of bronze cost less I/O than staging a flagged copy of it (one
    extra full write and re-read); each pass filters inside the scan stage.
    The pass that writes silver counts its input, valid and rejected rows
    (``quarantine/<name>_counts``), so the summary needs no pass of its own.
    """
    wrote = False
    for name, (rules, spec) in (SPECS_STRICT if strict else SPECS).items():
        if resume and lake.complete(spark, "silver", name) and lake.complete(spark, "quarantine", f"{name}_invalid_id"):
            continue
        valid, rejected, seen = counted_split(lowercase_columns(lake.read(spark, "bronze", RAW[name])), rules)
        lake.write(conform(valid, spec), "silver", name)
        lake.write(spark.createDataFrame([counts_row(name, seen)], COUNTS_SCHEMA), "quarantine", f"{name}_counts")
        lake.write(rejected, "quarantine", f"{name}_invalid_id")
        wrote = True
    return wrote


def run_gold(spark: SparkSession, lake: Lake, cfg: PipelineConfig) -> dict[str, str]:
    stores, products, sales = (lake.read(spark, "silver", n) for n in ("stores", "products", "sales"))
    fixed = calendar.period_dim(spark, cfg.first_end, cfg.last_end) if cfg.first_end and cfg.last_end else None
    g = Gold(stores, products, sales, fixed, materialize=False, amount_scale=cfg.amount_scale, units_scale=cfg.units_scale)
    paths: dict[str, str] = {"dim_date": lake.write(g.dim_date, "gold", "dim_date")}

    # The geography chain and the product chain are independent: their (small)
    # jobs are submitted from two driver threads. Each table is read back from
    # storage by the next step.
    def geography() -> None:
        paths["dim_geography"] = lake.write(g.dim_geography, "gold", "dim_geography")
        dim = lake.read(spark, "gold", "dim_geography")
        paths["dim_geo_level"] = lake.write(hierarchy.level_dim(dim, retail.GEOGRAPHY), "gold", "dim_geo_level")
        paths["lkp_store_geography"] = lake.write(hierarchy.bridge(stores, dim, retail.GEOGRAPHY),
                                                  "gold", "lkp_store_geography")
        paths["total_stores"] = lake.write(facts.node_totals(lake.read(spark, "gold", "lkp_store_geography")),
                                           "gold", "total_stores")

    def product() -> None:
        paths["dim_product"] = lake.write(g.dim_product, "gold", "dim_product")
        dim = lake.read(spark, "gold", "dim_product")
        paths["lkp_product_hierarchy"] = lake.write(hierarchy.bridge(products, dim, retail.PRODUCT),
                                                    "gold", "lkp_product_hierarchy")

    with ThreadPoolExecutor(max_workers=2) as pool:
        for f in [pool.submit(geography), pool.submit(product)]:
            f.result()
    gb, pb = lake.read(spark, "gold", "lkp_store_geography"), lake.read(spark, "gold", "lkp_product_hierarchy")
    dim_date = lake.read(spark, "gold", "dim_date")
    fct = kpi.rollup_kpi(sales, dim_date, gb, pb, calendar.period_map(dim_date, cfg.years, cfg.basis),
                         lake.read(spark, "gold", "total_stores"), unmatched=cfg.unmatched,
                         amount_scale=cfg.amount_scale, units_scale=cfg.units_scale)
    if cfg.fact_cluster_by:
        fct = fct.sortWithinPartitions(*cfg.fact_cluster_by)
    paths["fct_sales"] = lake.write(fct, "gold", "fct_sales", partition_by=list(cfg.fact_partition_by) or None)
    return paths


def run(spark: SparkSession, readers: dict[str, Callable[[], DataFrame]], lake: Lake,
        cfg: PipelineConfig) -> dict[str, str]:
    """bronze -> silver -> gold; registers silver.* and gold.* catalog tables over the written paths."""
    resume = cfg.resume and cfg.bronze_mode == "errorifexists"
    wrote = run_bronze(spark, readers, lake, cfg.bronze_mode, resume)
    wrote = run_silver(spark, lake, resume and not wrote, cfg.strict) or wrote
    if resume and not wrote and all(lake.complete(spark, "gold", n) for n in GOLD):
        gold_paths = {n: lake.location(spark, "gold", n) for n in GOLD}
    else:
        gold_paths = run_gold(spark, lake, cfg)
    silver_schema, gold_schema = cfg.schemas
    register_tables(spark, silver_schema, {n: lake.location(spark, "silver", n) for n in SPECS})
    register_tables(spark, gold_schema, gold_paths)
    return gold_paths


def main(argv: list[str] | None = None) -> None:
    """Run the whole job on the TESTDATA-derived raw tables and print row counts per layer table."""
    import argparse

    from martforge.session import get_session, scratch_path
    from martforge.sources import testdata as td

    ap = argparse.ArgumentParser(prog="python -m martforge.plans.pipeline")
    ap.add_argument("--sf", default="/root/testdata/sf0.01", help="TESTDATA folder")
    ap.add_argument("--root", default=None, help="lake root (default: under spark.checkpoint.dir)")
    ap.add_argument("--first-end", default=None, help="bounds of the period dimension (default: those of the sales)")
    ap.add_argument("--last-end", default=None)
    ap.add_argument("--master", default=None, help="only without spark-submit")
    args = ap.parse_args(argv)
    spark = get_session(args.master, app="martforge-pipeline")
    lake = Lake(args.root or scratch_path(spark, "lake"))
    readers = {"stores": lambda: td.raw_stores(spark, args.sf), "products": lambda: td.raw_products(spark, args.sf),
               "sales": lambda: td.raw_sales(spark, args.sf)}
    paths = run(spark, readers, lake, PipelineConfig(args.first_end, args.last_end))
    for layer, names in [("bronze", RAW.values()), ("silver", SPECS), ("quarantine", [f"{n}_invalid_id" for n in SPECS])]:
        for name in names:
            print(f"{layer:10s} {name:24s} {lake.read(spark, layer, name).count():>10}")
    for name, path in paths.items():
        print(f"{'gold':10s} {name:24s} {spark.read.parquet(path).count():>10}")
    spark.stop()


if __name__ == "__main__":
    main()

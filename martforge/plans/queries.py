"""Registered queries: name -> (spark, sf_dir) -> DataFrame, each over whole TESTDATA tables.

Inputs follow FIXTURES.md: clean retail tables derived from the star tables,
and dirty copies with injected nulls, bad keys and duplicates. Queries that
exercise sinks write under ``spark.checkpoint.dir`` and return what they read back.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.functions.lag import lag_within
from martforge.functions.zorder import largest_of, zorder_slices, zordered
from martforge.operators import bitmaps, bronze, calendar, facts, hierarchy, kpi, synth
from martforge.operators.conform import conform, dedupe_by_key, lowercase_columns
from martforge.operators.quality import COUNTS_SCHEMA, counted_split, counts_row
from martforge.operators.quality import dq_summary as dq_summary_op
from martforge.plans import incremental, medallion, retail
from martforge.session import drop_kept, kept, scratch_dropped, scratch_path, shuffles_freed
from martforge.sources import layers, snapshot
from martforge.sources import testdata as td
from martforge.streaming.ingest import ingest_available

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
#: The queries over the layers alone, for callers that have built them.
OVER_LAYERS: dict[str, Callable[[medallion.Gold], DataFrame]] = {}

# Point lookups of the original pipeline (ids as they appear there).
LOOKUP_PERIOD, LOOKUP_GEO, LOOKUP_NODE, LOOKUP_BRIDGE_NODE, LOOKUP_STORE = 284, 1, 0, 1, 14
DRILL_DISTRICT = "BUILDING"
TABLES = ["region", "nation", "supplier", "customer", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
MISSING_TABLE = "store_info"
#: Catalog schemas of the queries that register tables.
SILVER_SCHEMA, GOLD_SCHEMA = "silver", "gold"


def query(name: str):
    def wrap(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return wrap


def over_layers(name: str):
    """Register a query of the layers: the registered form builds, of the input folder, only what it needs."""
    def wrap(fn: Callable[[medallion.Gold], DataFrame]):
        OVER_LAYERS[name] = fn
        REGISTRY[name] = lambda spark, sf: fn(layers_of(spark, sf))
        return fn
    return wrap


# ------------------------------------------------------------------ shared inputs
def layers_of(spark: SparkSession, sf: str) -> medallion.Gold:
    """The silver and gold layers of an input folder; tables are built when first used and written once."""
    return medallion.Gold(lambda: medallion.silver_stores(td.stores(spark, sf)),
                          lambda: medallion.silver_products(td.products(spark, sf)),
                          lambda: medallion.silver_sales(td.sales(spark, sf)))


def _lake(spark: SparkSession) -> layers.Lake:
    return layers.Lake(scratch_path(spark, "lake"))


# ------------------------------------------------------------------ IO: scans and sinks
@query("scan_parquet")
def scan_parquet(spark, sf):
    return td.table(spark, sf, "events")


@query("row_counts")
def row_counts(spark, sf):
    parts = [td.table(spark, sf, t).agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
             for t in TABLES]
    return reduce(DataFrame.unionByName, parts)


@query("layer_roundtrip")
def layer_roundtrip(spark, sf):
    """Overwrite a bronze table, append the same batch again, read the layer back."""
    lake = _lake(spark)
    orders = td.table(spark, sf, "orders")
    lake.write(orders, "bronze", "orders", mode="overwrite")
    lake.write(orders, "bronze", "orders", mode="append")
    return lake.read(spark, "bronze", "orders")


@query("sink_error_if_exists")
def sink_error_if_exists(spark, sf):
    """Write the same table twice with error-if-exists: the second attempt must fail and leave the first."""
    path = scratch_path(spark, "once", "lineitem")
    lineitem = td.table(spark, sf, "lineitem")
    parts = []
    for attempt in (1, 2):
        status = layers.write_once(lineitem, path)
        parts.append(spark.read.parquet(path).agg(
            F.lit(attempt).alias("attempt"), F.lit(status).alias("status"),
            F.count(F.lit(1)).alias("rows_in_target")))
    return reduce(DataFrame.unionByName, parts)


def _reader(sf):
    return lambda spark, name: td.table(spark, sf, name)


@query("snapshot_tables")
def snapshot_tables(spark, sf):
    return snapshot.snapshot(spark, _reader(sf), TABLES, scratch_path(spark, "snap"))


@query("snapshot_status")
def snapshot_status(spark, sf):
    tables = ["region", MISSING_TABLE, "nation", "customer"]
    return snapshot.snapshot(spark, _reader(sf), tables, scratch_path(spark, "snap"), on_error="continue")


@query("snapshot_us")
def snapshot_us(spark, sf):
    """Zoned timestamps through a snapshot in microseconds, compared as whole microseconds."""
    def zoned(own, name):
        events = td.table(own, sf, name)
        return events.withColumn("ts", F.concat(F.col("ts").cast("string"), F.lit("Z")).cast("timestamp"))

    target = scratch_path(spark, "snap")
    snapshot.snapshot(spark, zoned, ["events"], target)
    back = spark.read.parquet(f"{target}/events.parquet")
    return back.withColumn("ts", F.unix_micros("ts")).withColumnRenamed("ts", "ts_us")


@query("snapshot_truncated")
def snapshot_truncated(spark, sf):
    """Nanosecond timestamps through a snapshot that cuts them to microseconds."""
    def fine(own, name):
        events = td.table(own, sf, name)
        micros = F.unix_micros(F.concat(F.col("ts").cast("string"), F.lit("Z")).cast("timestamp"))
        return events.withColumn("ts", micros * 1000 + F.pmod("event_id", F.lit(1000)))

    target = scratch_path(spark, "snap")
    snapshot.snapshot(spark, fine, ["events"], target, nanos={"events": ["ts"]})
    return spark.read.parquet(f"{target}/events.parquet").withColumn("ts", F.unix_micros("ts")).withColumnRenamed("ts", "ts_us")


@query("file_inventory")
def file_inventory(spark, sf):
    """The files of the given tables with their rows."""
    return layers.file_inventory({t: td.table(spark, sf, t) for t in TABLES})


@over_layers("catalog_tables")
def catalog_tables(g):
    """Write silver stores to a layer path, register silver.* external tables over the paths, read by name."""
    spark = g.stores.sparkSession
    lake = _lake(spark)
    locs = {"stores": lake.write(g.stores, "silver", "stores"),
            "products": lake.write(g.products, "silver", "products")}
    layers.register_tables(spark, SILVER_SCHEMA, locs)
    return spark.table(f"{SILVER_SCHEMA}.stores")


@over_layers("insert_select")
def insert_select(g):
    spark = g.stores.sparkSession
    layers.ensure_schema(spark, GOLD_SCHEMA)
    return layers.insert_select(spark, f"{GOLD_SCHEMA}.lkp_store_geography", "geography_id int, store_id int",
                                scratch_path(spark, "tables", "lkp_store_geography"), g.lkp_store_geography)


@over_layers("ctas_replace")
def ctas_replace(g):
    spark = g.stores.sparkSession
    layers.ensure_schema(spark, GOLD_SCHEMA)
    path = scratch_path(spark, "tables", "fct_sales")
    g.tables()
    with scratch_dropped(spark):
        return layers.replace_table(g.kpi(), f"{GOLD_SCHEMA}.fct_sales", path)


@over_layers("versioned_overwrite")
def versioned_overwrite(g):
    """A table that is replaced by one of another schema: one rename of a pointer."""
    spark, lake = g.stores.sparkSession, layers.VersionedLake(scratch_path(g.stores.sparkSession, "versions"))
    lake.write(g.stores, "silver", "leaves")
    lake.write(g.products, "silver", "leaves")
    return lake.read(spark, "silver", "leaves")


@over_layers("view_replace")
def view_replace(g):
    """A published view that gets data of another schema without a moment in which it is missing."""
    spark, where = g.stores.sparkSession, scratch_path(g.stores.sparkSession, "published")
    layers.ensure_schema(spark, GOLD_SCHEMA)
    layers.publish_view(g.dim_product, f"{GOLD_SCHEMA}.dim_published", where)
    return layers.publish_view(g.dim_geography, f"{GOLD_SCHEMA}.dim_published", where)


@over_layers("dim_scan")
def dim_scan(g):
    """Full scan of the registered gold geography dimension."""
    spark = g.stores.sparkSession
    lake = _lake(spark)
    layers.register_tables(spark, GOLD_SCHEMA, {"dim_geography": lake.write(g.dim_geography, "gold", "dim_geography")})
    return spark.table(f"{GOLD_SCHEMA}.dim_geography")


# ------------------------------------------------------------------ bronze / silver
@query("bronze_ingest")
def bronze_ingest(spark, sf):
    """Stamp raw sales, write them once to bronze, read back: ``stamped`` if the row has the one stamp of its batch."""
    path = scratch_path(spark, "bronze", "sales_fact")
    raw = td.raw_sales(spark, sf)
    if layers.write_once(bronze.ingest(raw), path) != "written":
        raise ValueError(f"{path} exists")
    back = spark.read.parquet(path)
    stamps = back.agg(F.min("ingestion_date").alias("lo"), F.max("ingestion_date").alias("hi")).first()
    one = F.lit(stamps.lo == stamps.hi) & (F.col("ingestion_date") == F.lit(stamps.lo))
    return back.select(*raw.columns, F.coalesce(one, F.lit(False)).alias("stamped"))


@query("bronze_stream")
def bronze_stream(spark, sf):
    """The bronze ingest as an incremental stream over the landing folder (here: the lineitem file)."""
    target, ckpt = scratch_path(spark, "bronze", "lineitem"), scratch_path(spark, "ckpt", "lineitem")
    schema = td.table(spark, sf, "lineitem").schema
    ingest_available(spark, sf, schema, target, ckpt, path_glob="lineitem.parquet")
    back = spark.read.parquet(target)
    return back.select(*schema.names, F.col("ingestion_date").isNotNull().alias("stamped"))


@query("lowercase_columns")
def lowercase_columns_q(spark, sf):
    return lowercase_columns(td.raw_stores(spark, sf))


@query("dedupe_by_key")
def dedupe_by_key_q(spark, sf):
    return dedupe_by_key(td.sales(spark, sf), "sales_id")


@query("conform_stores")
def conform_stores(spark, sf):
    return medallion.silver_stores(td.raw_stores(spark, sf))


@query("conform_products")
def conform_products(spark, sf):
    return medallion.silver_products(td.raw_products(spark, sf))


@query("conform_sales")
def conform_sales(spark, sf):
    return medallion.silver_sales(td.raw_sales(spark, sf))


@query("conform_products_strict")
def conform_products_strict(spark, sf):
    """Strict mode: ids whose number overflows int are quarantined instead of kept with a NULL id."""
    return medallion.silver(td.raw_products(spark, sf), retail.PRODUCT_RULES_STRICT, retail.PRODUCT_CONFORM)[0]


@query("quarantine_sales_strict")
def quarantine_sales_strict(spark, sf):
    """Strict mode: unparseable period dates are quarantined too."""
    return medallion.silver(td.raw_sales(spark, sf), retail.SALES_RULES_STRICT, retail.SALES_CONFORM)[1]


@query("quarantine_stores")
def quarantine_stores(spark, sf):
    return medallion.silver(td.raw_stores(spark, sf), retail.STORE_RULES, retail.STORE_CONFORM)[1]


@query("quarantine_products")
def quarantine_products(spark, sf):
    return medallion.silver(td.raw_products(spark, sf), retail.PRODUCT_RULES, retail.PRODUCT_CONFORM)[1]


@query("quarantine_sales")
def quarantine_sales(spark, sf):
    return medallion.silver(td.raw_sales(spark, sf), retail.SALES_RULES, retail.SALES_CONFORM)[1]


@query("dq_summary")
def dq_summary(spark, sf):
    return dq_summary_op({
        "stores": (lowercase_columns(td.raw_stores(spark, sf)), retail.STORE_RULES),
        "products": (lowercase_columns(td.raw_products(spark, sf)), retail.PRODUCT_RULES),
        "sales": (lowercase_columns(td.raw_sales(spark, sf)), retail.SALES_RULES),
    })


@query("dq_summary_load")
def dq_summary_load(spark, sf):
    """The summary of a silver load, counted by the writes themselves."""
    lake, rows = _lake(spark), []
    for name, raw, rules, spec in (("stores", td.raw_stores, retail.STORE_RULES, retail.STORE_CONFORM),
                                   ("products", td.raw_products, retail.PRODUCT_RULES, retail.PRODUCT_CONFORM),
                                   ("sales", td.raw_sales, retail.SALES_RULES, retail.SALES_CONFORM)):
        valid, _, seen = counted_split(lowercase_columns(raw(spark, sf)), rules)
        lake.write(conform(valid, spec), "silver", name)
        rows.append(counts_row(name, seen))
    return spark.createDataFrame(rows, COUNTS_SCHEMA)


# ------------------------------------------------------------------ calendar
@query("dim_date")
def dim_date(spark, sf):
    """Weekly periods spanning the sales: first end = day before the first week, last = last week end."""
    return calendar.period_dim_from(td.sales(spark, sf), "period_start", "period_end")


@query("daily_spine")
def daily_spine(spark, sf):
    return calendar.daily_spine_from(td.table(spark, sf, "lineitem"), "l_shipdate")


@query("daily_spine_by_count")
def daily_spine_by_count(spark, sf):
    """As many days from the first ship date on as there are ship dates."""
    return calendar.daily_spine_by_count(td.table(spark, sf, "lineitem"), "l_shipdate")


@query("calendar_attrs")
def calendar_attrs(spark, sf):
    dim = calendar.period_dim_from(td.sales(spark, sf), "period_start", "period_end")
    cal = calendar.calendar_attrs(dim, "calendar")
    iso = calendar.calendar_attrs(dim, "iso").select("period_id", F.col("year").alias("iso_year"))
    return cal.join(iso, "period_id")


@query("period_ya_ref")
def period_ya_ref(spark, sf):
    dim = calendar.period_dim_from(td.sales(spark, sf), "period_start", "period_end")
    return calendar.period_map(dim, years=1, basis="calendar")


@query("period_ya_iso")
def period_ya_iso(spark, sf):
    dim = calendar.period_dim_from(td.sales(spark, sf), "period_start", "period_end")
    return calendar.period_map(dim, years=-1, basis="iso")


# ------------------------------------------------------------------ dimensions and bridges
@over_layers("dim_product")
def dim_product(g):
    return hierarchy.hierarchy_dim(g.products, retail.PRODUCT)


@over_layers("dim_geography")
def dim_geography(g):
    return hierarchy.hierarchy_dim(g.stores, retail.GEOGRAPHY)


@over_layers("dim_geo_level")
def dim_geo_level(g):
    return hierarchy.level_dim(hierarchy.hierarchy_nodes(g.stores, retail.GEOGRAPHY), retail.GEOGRAPHY)


@over_layers("bridge_store_geography")
def bridge_store_geography(g):
    return hierarchy.bridge(g.stores, g.dim_geography, retail.GEOGRAPHY)


@over_layers("bridge_product_hierarchy")
def bridge_product_hierarchy(g):
    return hierarchy.bridge(g.products, g.dim_product, retail.PRODUCT)


@over_layers("bridge_theta_check")
def bridge_theta_check(g):
    """The level-dependent join in its second form (one key per level and leaf)."""
    return hierarchy.bridge_by_key(g.stores, g.dim_geography, retail.GEOGRAPHY)


@over_layers("store_bridge_lookup")
def store_bridge_lookup(g):
    return g.lkp_store_geography.filter(F.col("store_id") == LOOKUP_STORE)


@query("period_lookup")
def period_lookup(spark, sf):
    """One period of the (data-spanning) period dimension."""
    dim = calendar.period_dim_from(td.sales(spark, sf), "period_start", "period_end")
    return dim.filter(F.col("period_id") == LOOKUP_PERIOD)


@over_layers("bridge_lookup")
def bridge_lookup(g):
    return g.lkp_product_hierarchy.filter(F.col("hierarchy_id") == LOOKUP_BRIDGE_NODE)


# ------------------------------------------------------------------ facts
@over_layers("fact_period_join")
def fact_period_join(g):
    """The sales of one period: its two dates reach the scan as literals."""
    p = g.dim_date.filter(F.col("period_id") == LOOKUP_PERIOD)
    found = p.collect()  # at most one row
    start, end = (found[0].period_start_date, found[0].period_end_date) if found else (None, None)
    day = lambda d: F.lit(d).cast("date")
    return (g.sales.filter((F.col("period_start") == day(start)) & (F.col("period_end") == day(end)))
            .withColumns({"period_id": F.lit(LOOKUP_PERIOD), "period_start_date": day(start), "period_end_date": day(end)}))


@over_layers("fact_base")
def fact_base(g):
    return g.fact_base(with_stores=False)


@over_layers("fact_base_stores")
def fact_base_stores(g):
    return g.fact_base()


@over_layers("total_stores")
def total_stores(g):
    return facts.node_totals(g.lkp_store_geography)


@over_layers("fact_base_bitmaps")
def fact_base_bitmaps(g):
    """The roll-up with sets of stores as bitmaps, every level from the one below."""
    return bitmaps.rollup_fact_bitmaps(g.sales, g.dim_date, g.stores, g.products, g.dim_geography, g.dim_product,
                                       retail.GEOGRAPHY, retail.PRODUCT, kept, drop_kept)


@over_layers("fact_base_bucketed")
def fact_base_bucketed(g):
    """The roll-up from sales and product bridge that are bucketed by product: their join moves neither."""
    return facts.rollup_bucketed(*bucketed_by_product(g), g.dim_date, g.lkp_store_geography)


def bucketed_by_product(g, buckets: int = 16):
    """(sales, product bridge) as tables bucketed by product."""
    spark = g.sales.sparkSession
    layers.ensure_schema(spark, SILVER_SCHEMA)
    return [layers.write_bucketed(df, f"{SILVER_SCHEMA}.{name}_by_product", scratch_path(spark, name), ["product_id"], buckets)
            for name, df in (("sales", g.sales), ("bridge", g.lkp_product_hierarchy))]


@over_layers("sales_gaps")
def sales_gaps(g):
    """Days between a sale's week and the week of the store's sale before it."""
    found = lag_within(g.sales.select("store_id", "sales_id", "period_start"), ["store_id"], ["period_start", "sales_id"],
                       "period_start", "previous_start")
    return found.withColumn("gap_days", F.datediff("period_start", "previous_start"))


@query("irregular_periods")
def irregular_periods(spark, sf):
    """Periods that end on the dates on which orders were placed."""
    return calendar.periods_between(td.table(spark, sf, "orders"), "o_orderdate")


@over_layers("geography_ancestors")
def geography_ancestors(g):
    """Every geography node with all nodes above it."""
    links = hierarchy.parent_links(g.dim_geography, retail.GEOGRAPHY)
    return hierarchy.ancestors(links, g.dim_geography, "geography_id")


@over_layers("bridge_by_ancestors")
def bridge_by_ancestors(g):
    """The product bridge by recursion over parent links instead of one join per level."""
    return hierarchy.bridge_by_ancestors(g.products, g.dim_product, retail.PRODUCT)


# ------------------------------------------------------------------ KPI
@over_layers("fct_sales_incremental")
def fct_sales_incremental(g):
    """The KPI fact after a refresh: built without late sales, with wrong and surplus ones, then one batch puts that right."""
    spark = g.sales.sparkSession
    lake = _lake(spark)
    dims = incremental.Dimensions(g.lkp_store_geography, g.lkp_product_hierarchy, g.total_stores())
    before, changed, removed = late_batch(g.sales)
    incremental.build(before, lake, dims)
    incremental.refresh(changed, removed, lake, dims)
    return incremental.fact_of(spark, lake)


def late_batch(sales: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sales before, changed sales, removed ids) of a batch that turns the first into ``sales``; it lies in every ninth week."""
    week = F.pmod(F.floor(F.datediff("period_start", F.lit("1970-01-05").cast("date")) / 7), F.lit(9)) == 4
    kind = F.when(F.coalesce(week, F.lit(False)), F.pmod("sales_id", F.lit(5))).otherwise(F.lit(-1))
    late, wrong_amount, wrong_week, surplus = (kind == k for k in range(4))
    shift = lambda c: F.when(wrong_week, F.date_add(c, 7)).otherwise(F.col(c)).alias(c)
    before = sales.filter(~late).select(
        "sales_id", "store_id", "product_id", shift("period_start"), shift("period_end"),
        F.when(wrong_amount, F.col("sales_amount") * 2).otherwise(F.col("sales_amount")).alias("sales_amount"), "sales_units")
    extra = sales.filter(surplus).withColumn("sales_id", (-F.col("sales_id")).cast(sales.schema["sales_id"].dataType))
    return (before.unionByName(extra), sales.filter(late | wrong_amount | wrong_week), extra.select("sales_id"))


@over_layers("kpi_zorder")
def kpi_zorder(g):
    """Lookups on each one of the three keys of the KPI fact, stored in Z-order of all three."""
    fact = zordered_fact(g)
    lookups = {"geography_id": LOOKUP_GEO, "hierarchy_id": LOOKUP_NODE, "period_id": LOOKUP_PERIOD}
    found = [fact.filter(F.col(key) == value).withColumn("by", F.lit(key)) for key, value in lookups.items()]
    return reduce(DataFrame.unionByName, found)


#: Rows of the fact that are moved to their place in the Z-order at once, and that a task sorts.
ZORDER_ROWS, ZORDER_TASK_ROWS = 1 << 27, 1 << 20


def zordered_fact(g, partitions: int = 32, slice_rows: int = ZORDER_ROWS) -> DataFrame:
    """The KPI fact written in Z-order of geography, node and period: slice by slice of that order, so that only a slice's rows are under way."""
    spark, columns = g.sales.sparkSession, list(kpi.KEYS)
    path = scratch_path(spark, "fct_sales_z")
    g.tables()
    with scratch_dropped(spark):
        # Written first: the ranges are sampled from it, and the roll-up must not run again for that. Columns that
        # follow from others are made after the rows have moved.
        rows = kept(g.compared(), "compared")
        n, largest = rows.count(), largest_of(rows, columns)
        slices = zorder_slices(rows, columns, largest, -(-n // slice_rows))
        each = max(1, -(-max(partitions, -(-n // ZORDER_TASK_ROWS)) // len(slices)))
        for part in slices:
            fact = kpi.kpi_columns(zordered(part, columns, each, largest))
            with shuffles_freed(spark):
                fact.write.mode("append").option("compression", "zstd").parquet(path)
    return spark.read.schema(fact.schema).parquet(path)


@over_layers("growth_preview")
def growth_preview(g):
    """Unrounded growth, comparison map as originally coded (calendar year + 1, inner join)."""
    return g.growth_preview()


@over_layers("fct_sales")
def fct_sales_over(g):
    return g.kpi(years=-1, basis="iso", unmatched="keep")


def fct_sales(spark, sf):
    return REGISTRY["fct_sales"](spark, sf)


@over_layers("fct_sales_ref")
def fct_sales_ref(g):
    return g.kpi(years=1, basis="calendar", unmatched="drop")


@over_layers("kpi_lookup")
def kpi_lookup(g):
    """A point lookup on the stored fact: reads the folder of one period."""
    return g.fct_sales.filter((F.col("geography_id") == LOOKUP_GEO) & (F.col("hierarchy_id") == LOOKUP_NODE)
                              & (F.col("period_id") == LOOKUP_PERIOD))


@over_layers("sales_in_district")
def sales_in_district(g):
    district = g.stores.filter(F.col("store_district") == DRILL_DISTRICT).select("store_id")
    return g.sales.join(district, "store_id", "left_semi")


# ------------------------------------------------------------------ generators, re-aimed at TESTDATA
@query("synthetic_fk")
def synthetic_fk(spark, sf):
    """A store per customer key, placed at a hashed (state, district) pair of region x nation."""
    n = td.table(spark, sf, "nation")
    r = td.table(spark, sf, "region")
    ref = n.join(r, n.n_regionkey == r.r_regionkey).select(
        (F.col("n_nationkey") + 1).alias("geo_id"), F.col("r_name").alias("state"), F.col("n_name").alias("district"))
    keys = td.table(spark, sf, "customer").select("c_custkey")
    return synth.keyed_rows(keys, "c_custkey", ref, "geo_id",
                            {"store_district": "district", "store_state": "state"}, country="World")


@query("random_sample")
def random_sample(spark, sf):
    return synth.seeded_sample(td.stores(spark, sf), "store_id", 20)


@query("expand_hierarchy")
def expand_hierarchy(spark, sf):
    return synth.expand_hierarchy(td.table(spark, sf, "part"), "p_type", "p_brand")

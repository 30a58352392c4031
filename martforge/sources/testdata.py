"""Retail inputs derived from the TESTDATA star tables (see FIXTURES.md).

Geography: country = region, state = nation, district = market segment.
Product: department = part type, category = brand, item = part.
Sales: one row per line item at the week of its ship date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    # nation (25 rows) and region (5 rows) are planned as broadcast joins by size.
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)


def _week_start(ts_col: str):
    return F.trunc(F.to_date(F.col(ts_col)), "week")


def _sales_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_extendedprice", "l_quantity")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(o, li.l_orderkey == o.o_orderkey)


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _geo(spark, sf_dir).select(
        F.col("c_custkey").alias("store_id"),
        F.col("c_name").alias("store_name"),
        F.concat(F.lit("Address_"), F.col("c_custkey").cast("string")).alias("store_addr"),
        F.col("c_mktsegment").alias("store_district"),
        F.col("n_name").alias("store_state"),
        F.col("r_name").alias("store_country"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_type").alias("department"),
        F.col("p_brand").alias("category"),
        F.concat(F.lit("ITM"), F.col("p_partkey").cast("string")).alias("item_id"),
        F.col("p_name").alias("item_name"))


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    wk = _week_start("l_shipdate")
    return _sales_base(spark, sf_dir).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("sales_id"),
        F.col("o_custkey").alias("store_id"),
        F.col("l_partkey").alias("product_id"),
        wk.alias("period_start"),
        F.date_add(wk, 6).alias("period_end"),
        F.col("l_extendedprice").alias("sales_amount"),
        F.col("l_quantity").alias("sales_units"))


def _s(c):
    return F.col(c).cast("string")


def raw_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixed-case names, text ids, NULL ids and states/districts, duplicate ids."""
    k = F.col("c_custkey")
    sid = (F.when(k % 41 == 0, F.lit(None).cast("string"))
           .when(k % 43 == 0, F.concat(F.lit("BAD"), _s("c_custkey")))
           .otherwise((k - (k % 2) * F.when(k % 10 == 1, 1).otherwise(0)).cast("string")))
    return _geo(spark, sf_dir).select(
        sid.alias("Store_ID"),
        F.col("c_name").alias("Store_Name"),
        F.concat(F.lit("Address_"), _s("c_custkey")).alias("Store_Addr"),
        F.when(k % 31 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")).alias("Store_District"),
        F.when(k % 37 == 0, F.lit(None).cast("string")).otherwise(F.col("n_name")).alias("Store_State"),
        F.col("r_name").alias("Store_Country"))


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL departments/categories/ids, ids with a wrong prefix, ids that overflow int."""
    k = F.col("p_partkey")
    item = (F.when(k % 29 == 0, F.lit(None).cast("string"))
            .when(k % 23 == 0, F.concat(F.lit("XTM"), _s("p_partkey")))
            .when(k % 47 == 0, F.lit("ITM99999999999"))
            .otherwise(F.concat(F.lit("ITM"), _s("p_partkey"))))
    return table(spark, sf_dir, "part").select(
        F.when(k % 19 == 0, F.lit(None).cast("string")).otherwise(F.col("p_type")).alias("Department"),
        F.when(k % 17 == 0, F.lit(None).cast("string")).otherwise(F.col("p_brand")).alias("Category"),
        item.alias("Item_ID"),
        F.col("p_name").alias("Item_Name"))


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-text sales: NULL and text keys, unparseable dates, NULL amounts, duplicate ids."""
    ok, pk = F.col("l_orderkey"), F.col("l_partkey")
    wk = _week_start("l_shipdate")
    none = F.lit(None).cast("string")
    return _sales_base(spark, sf_dir).select(
        F.when(ok % 101 == 0, none).otherwise((ok * 10 + F.col("l_linenumber")).cast("string")).alias("Sales_ID"),
        F.when(ok % 103 == 0, F.lit("S?")).otherwise(_s("o_custkey")).alias("Store_ID"),
        F.when(pk % 97 == 0, none).otherwise(_s("l_partkey")).alias("Product_ID"),
        F.when(ok % 89 == 0, none).when(ok % 83 == 0, F.lit("garbage"))
         .otherwise(wk.cast("string")).alias("Period_Start"),
        F.date_add(wk, 6).cast("string").alias("Period_End"),
        F.when(ok % 53 == 0, none).otherwise(_s("l_extendedprice")).alias("Sales_Amount"),
        F.when(ok % 59 == 0, none).otherwise(_s("l_quantity")).alias("Sales_Units"))

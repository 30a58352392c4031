"""LAG within keys, however many rows one key holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martforge.session import kept


def lag_within(df: DataFrame, keys: list[str], order: list[str], column: str, name: str,
               partitions: int | None = None) -> DataFrame:
    """Add ``name`` = ``column`` of the row before within ``keys`` by ``order`` (nulls first), null for the first row.

    A window by key puts all rows of a key into one task. Here rows are
    range-partitioned by key and order, so a large key spreads over many
    partitions, and written once; LAG runs inside each (partition, key). Only the
    last row of each (partition, key) is carried on: a table with at most one row
    per partition and key, itself windowed by key. It supplies the first row of the next partition
    that holds the key. With ``keys`` empty it is a global LAG. The order
    must be total within a key; tied rows follow each other in any order.

    Periods of any length and with gaps are fine, as rows are compared and not dates computed.
    """
    by = [F.col(c).asc_nulls_first() for c in [*keys, *order]]
    split = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    cut = kept(split.sortWithinPartitions(*by).withColumn("__part", F.spark_partition_id())
               .withColumn("__nth", F.monotonically_increasing_id()), "lag")
    # Ranges are numbered in order, and so are rows inside one.
    here = Window.partitionBy("__part", *keys).orderBy("__nth")
    rows = cut.withColumn(name, F.lag(column).over(here)).withColumn("__first", F.row_number().over(here) == 1)
    ends = cut.withColumn("__end", F.lead("__nth").over(here).isNull())
    last = ends.groupBy("__part", *keys).agg(F.max(F.when(F.col("__end"), F.col(column))).alias("__last"))
    # One row per partition and key; with a single global key, one row per partition.
    before = last.withColumn("__before", F.lag("__last").over(Window.partitionBy(*keys).orderBy("__part"))).drop("__last")
    # Only first rows are joined: all others have their row before beside them.
    first = rows.filter("__first").drop(name)
    same = F.col("a.__part") == F.col("b.__part")
    for k in keys:
        same = same & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    filled = first.alias("a").join(before.alias("b"), same, "left").select("a.*", F.col("b.__before").alias(name))
    out = [*df.columns, name]
    return rows.filter("NOT __first").select(*out).unionByName(filled.select(*out))

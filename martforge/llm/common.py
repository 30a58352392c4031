"""Small helpers shared by the operators: tables, written intermediates, words, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martforge.session import scratch_path

#: White space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
WHITE = " \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


#: Functions that give up what a module keeps in a Python worker from one task to the next.
HELD: list[Callable[[], None]] = []


def release() -> None:
    """Start of a task that needs none of it: workers are reused by later stages, and so would be their memory."""
    for give_up in HELD:
        give_up()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under spark.checkpoint.dir and read back: its lineage is cut, its rows are fixed."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.scratch = path
    return back


def dropped(*tables: DataFrame) -> None:
    """Delete tables that ``written`` made, once everything that reads them has been written itself."""
    for df in tables:
        jvm = df.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(df.scratch)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def whole_row(docs: DataFrame) -> Column:
    """The whole input row as one struct ``row``; names may hold dots and backticks."""
    return F.struct(*[docs[f"`{c.replace('`', '``')}`"] for c in docs.columns]).alias("row")


def wrapped(docs: DataFrame, **columns: Column) -> DataFrame:
    """The whole input row as one struct ``row`` beside computed columns, so that no input name can clash."""
    return docs.select(whole_row(docs), *[c.alias(k) for k, c in columns.items()])


#: A key is hot where it holds more than one in ``HOT`` of the rows, so there are fewer than ``HOT`` hot keys.
HOT = 4096
#: Tasks over which the rows of a hot key spread.
SPREAD = 64


def spread_join(many: DataFrame, one: DataFrame, on: str | list[str], times: str, hot: int = HOT, spread: int = SPREAD) -> DataFrame:
    """``many`` joined with ``one`` by ``on``; rows of a hot key spread over ``spread`` tasks.

    ``one`` is a written table with a row per key, whose column ``times`` says how many rows of ``many`` have it.
    Only the hot keys, fewer than ``hot`` rows whatever the data, are broadcast, to salt ``many``; ``one`` repeats
    their rows once per salt. All other rows have salt 0 and join as ever.
    """
    keys = [on] if isinstance(on, str) else on
    total = one.agg(F.sum(times)).first()[0] or 0
    is_hot = F.col(times).cast("decimal(38,0)") * hot > total
    marks = one.filter(is_hot).select(*keys, F.lit(True).alias("__hot"))
    salted = (many.join(F.broadcast(marks), keys, "left")
              .withColumn("__salt", F.when(F.col("__hot"), F.pmod(F.monotonically_increasing_id(), F.lit(spread)).cast("int"))
                          .otherwise(F.lit(0))).drop("__hot"))
    each = one.withColumn("__salt", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(spread - 1))).otherwise(F.array(F.lit(0)))))
    return salted.join(each, [*keys, "__salt"]).drop("__salt")


def words(text) -> list[bytes]:
    """Words of a text (str, bytes or None) between the contract's white space, A-Z in lower case."""
    if text is None:
        return []
    # bytes.lower() and bytes.split() know ASCII only: exactly A-Z and the six characters of WHITE.
    return (text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text).lower().split()


def texts(column: pa.Array) -> Iterator[bytes | None]:
    """The raw UTF-8 of each text of an Arrow column, without decoding."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    for x in column.cast(pa.large_binary() if wide else pa.binary()):
        yield x.as_py()


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to at most ``rows`` rows, so that what a task derives from one stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply) on uint64: bijective, so it adds no collisions."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def offsets_by(counts: DataFrame, keys: list[str], part: str, count: str, name: str) -> DataFrame:
    """Sum of ``count`` over the lower ``part`` numbers of the same keys: one row per part and key, never the data."""
    before = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(name, F.coalesce(F.sum(count).over(before), F.lit(0)).cast("bigint"))


def ranked(df: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """Add ``name`` = 1, 2, ... in ``order`` within ``keys``, however many rows one key holds.

    Rows are range-partitioned by keys and order, numbered inside each
    partition and written once; a table of counts by partition and key gives
    each partition its offset. A key with a third of all rows spreads over a
    third of the partitions.
    """
    by = [F.col(k) for k in keys] + order
    cut = written(df.repartitionByRange(*by).sortWithinPartitions(*by)
                  .withColumn("__part", F.spark_partition_id())
                  .withColumn("__nth", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "ranked")
    counts = cut.groupBy("__part", *keys).agg(F.count(F.lit(1)).alias("__n"), F.min("__nth").alias("__first"))
    # Written, so that Spark sees its size before it plans the join and need not move the rows for it.
    starts = written(offsets_by(counts, keys, "__part", "__n", "__before").drop("__n"), "starts")
    return (cut.join(starts, ["__part", *keys])
            .withColumn(name, F.col("__before") + F.col("__nth") - F.col("__first") + 1)
            .drop("__part", "__nth", "__first", "__before"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable over undirected ``links``, by alternating star steps.

    Each round joins every link with its node's smallest neighbour and hooks
    the larger end to it (large star), then does the same among the smaller
    neighbours (small star); links are written each round, so lineage stays
    short and a lost executor costs one round. Only their number and the sum
    of their hashes reach the driver. Nodes without links are not in the result.
    """
    edges = written(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                    .filter("u <> v").distinct(), "links")

    def least(sym: DataFrame) -> DataFrame:
        return sym.groupBy("u").agg(F.min("v").alias("m"))

    def state(of: DataFrame) -> tuple:
        row = of.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return row[0], row[1]

    before = state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.join(least(both).withColumn("m", F.least("u", "m")), "u").filter("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())
        # u > v on every link now; each u hooks itself and its other neighbours to its smallest one.
        joined = large.join(least(large), "u")
        edges = written(joined.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
                        .unionByName(joined.select("u", F.col("m").alias("v"))).distinct(), "links")
        after = state(edges)
        if after == before:
            break
        before = after
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))

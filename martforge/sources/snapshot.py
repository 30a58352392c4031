"""Table snapshots: read each table with a caller-supplied reader, write Parquet, report status."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.operators.quality import counted_rows

STATUS_SCHEMA = "table_name string, status string, row_count bigint, error string"


Reader = Callable[[SparkSession, str], DataFrame]


def truncated_nanos(df: DataFrame, columns: list[str]) -> DataFrame:
    """Timestamps given as nanoseconds since 1970 (how finer ones reach Spark), cut down to its microseconds.

    Cut, not rounded, also before 1970: the microsecond that the instant lies in.
    """
    def micros(name: str):
        ns = F.col(name).cast("bigint")
        return F.timestamp_micros(F.floor((ns - F.pmod(ns, F.lit(1000))).cast("decimal(20,0)") / 1000).cast("bigint"))

    return df.withColumns({c: micros(c) for c in columns}) if columns else df


def snapshot(spark: SparkSession, reader: Reader, tables: list[str], target: str,
             on_error: str = "raise", compression: str = "snappy", timestamp_micros: bool = True,
             nanos: dict[str, list[str]] | None = None) -> DataFrame:
    """Copy ``tables`` to ``<target>/<table>.parquet`` (overwrite) and return one status row per table.

    The reader is any ``(session, name) -> DataFrame`` (e.g. ``spark.read.jdbc``
    with partition bounds for a database, or Parquet files); data moves executor
    to storage, never through the driver. It gets a session of its own, so the
    timestamp encoding set here reaches no other write. ``on_error='raise'``
    stops at the first failure; ``'continue'`` records it and goes on. Rows are
    counted by the write itself (an observed metric), so no table is read twice.
    ``timestamp_micros`` sets the encoding of the written timestamps. Spark's own have no finer
    digits; columns that a reader delivers as nanoseconds (``nanos``: table -> columns) are cut to microseconds.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    if timestamp_micros:
        own.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    rows = []
    for table in tables:
        path = f"{target.rstrip('/')}/{table}.parquet"
        try:
            counted, count = counted_rows(truncated_nanos(reader(own, table), (nanos or {}).get(table, [])))
            counted.write.mode("overwrite").option("compression", compression).parquet(path)
            rows.append((table, "ok", count.get["rows"], None))
        except Exception as e:  # noqa: BLE001 - isolation is the point of on_error='continue'
            if on_error == "raise":
                raise
            condition = getattr(e, "getCondition", lambda: None)() or type(e).__name__
            rows.append((table, "failed", None, condition))
    return spark.createDataFrame(rows, STATUS_SCHEMA)


def jdbc_reader(url: str, properties: dict[str, str],
                partitions: dict[str, tuple[str, int, int]] | None = None,
                num_partitions: int = 64) -> Reader:
    """A reader over a database, for :func:`snapshot`.

    Tables listed in ``partitions`` (name -> (numeric column, lower, upper)) are
    read by ``num_partitions`` parallel range queries, so no single task (and
    never the driver) holds a whole table; others are read by one query.
    """
    def read(spark: SparkSession, table: str) -> DataFrame:
        if partitions and table in partitions:
            column, lower, upper = partitions[table]
            return spark.read.jdbc(url, table, column=column, lowerBound=lower, upperBound=upper,
                                   numPartitions=num_partitions, properties=properties)
        return spark.read.jdbc(url, table, properties=properties)
    return read


def jdbc_append(df: DataFrame, url: str, table: str, properties: dict[str, str], batch_size: int = 10_000) -> None:
    """Append rows into a database table, batched per partition by each task.

    Not idempotent: a task retried after its first try had committed appends
    twice. Load into an empty staging table and insert from there in one transaction.
    """
    df.write.option("batchsize", batch_size).jdbc(url, table, mode="append", properties=properties)

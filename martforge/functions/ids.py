"""Dense, deterministic surrogate ids without a single-partition window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martforge.session import ensure_checkpoint_dir

_PID, _MID, _CNT, _OFF = "__mf_pid", "__mf_mid", "__mf_cnt", "__mf_off"


def dense_index(df: DataFrame, order: list[Column], name: str, base: int = 0,
                dtype: str = "bigint", partitions: int | None = None) -> DataFrame:
    """Add ``name`` = ``base`` + rank of each row in ``order`` (like a global row_number).

    A global ``row_number().over(Window.orderBy(...))`` moves every row into one
    task. Here rows are range-partitioned on the order, sorted inside each
    partition and numbered locally (``monotonically_increasing_id`` encodes the
    partition in its upper bits); a tiny table of per-partition counts gives
    each partition its offset. The order must be total (ties make ids
    arbitrary among the tied rows, as with row_number).

    The numbered rows are checkpointed (reliably, into spark.checkpoint.dir)
    before they are used twice: range bounds are sampled from the input, so
    two independent evaluations, or a recomputation after a lost executor,
    could otherwise split the rows differently and offsets would not match.
    """
    ensure_checkpoint_dir(df.sparkSession)
    # Without an explicit count AQE may merge adjacent ranges of a small input;
    # merged partitions stay in order and ids are taken in the merged stage.
    split = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    ranked = (split
              .sortWithinPartitions(*order)
              .withColumn(_PID, F.spark_partition_id())
              .withColumn(_MID, F.monotonically_increasing_id())
              .checkpoint(eager=True))
    counts = ranked.groupBy(_PID).agg(F.count(F.lit(1)).alias(_CNT))
    # One row per partition: the window below is over n rows, never over the data.
    offsets = counts.select(
        _PID,
        F.coalesce(F.sum(_CNT).over(Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias(_OFF))
    local = F.col(_MID) - F.shiftleft(F.col(_PID).cast("bigint"), 33)
    return (ranked.join(F.broadcast(offsets), _PID)
            .withColumn(name, (F.col(_OFF) + local + F.lit(base)).cast(dtype))
            .drop(_PID, _MID, _OFF))

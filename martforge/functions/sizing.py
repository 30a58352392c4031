"""Broadcast only what has been measured to be small, in bytes, at the time of the join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes a build side may hold in memory on the driver and on every executor.
MAX_BROADCAST_BYTES = 64 << 20
#: Bytes a row takes besides its text: row header and hash table slot.
ROW_BYTES = 48


def measured_bytes(df: DataFrame) -> int:
    """In-memory size of ``df``, measured now: text by its bytes, other columns by eight bytes each."""
    width = F.lit(ROW_BYTES)
    for f in df.schema.fields:
        own = F.octet_length(F.col(f"`{f.name}`")) if isinstance(f.dataType, (T.StringType, T.BinaryType)) else F.lit(8)
        width = width + F.coalesce(own, F.lit(0)) + F.lit(8)
    return df.agg(F.sum(width.cast("bigint"))).first()[0] or 0


def checked_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if it measures at most ``max_bytes``, else unchanged.

    Nothing is remembered: a table that has grown since the last call is
    measured again. The measure is one aggregate over ``df`` with one row out.
    """
    return F.broadcast(df) if measured_bytes(df) <= max_bytes else df

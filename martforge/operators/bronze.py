"""Bronze ingest: raw rows plus one ingestion timestamp per batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ingest(df: DataFrame, ts: Column | None = None, column: str = "ingestion_date") -> DataFrame:
    """Append the ingestion timestamp. ``current_timestamp()`` is folded once per query,
    so every row of a batch carries the same value."""
    return df.withColumn(column, F.current_timestamp() if ts is None else ts)

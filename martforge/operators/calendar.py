"""Period dimension, calendar attributes, daily spines and the period comparison map."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.functions.ids import dense_index
from martforge.functions.lag import lag_within

#: Steps a calendar may have: more means that a date in the data is wrong, and the query fails naming the bounds.
MAX_STEPS = 200_000
PERIOD_ID, PERIOD_START, PERIOD_END = "period_id", "period_start_date", "period_end_date"


def _date(value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, (dt.date, dt.datetime)):
        value = value.isoformat()[:10]
    return F.to_date(F.lit(value))


def _bounded(first: Column, last: Column, step_days: int, steps: Column) -> Column:
    """``steps`` (an array of dates), or an error if there would be more than MAX_STEPS."""
    said = F.concat(F.lit("calendar bounds too far apart: "), first.cast("string"), F.lit(" .. "), last.cast("string"))
    return F.when(F.datediff(last, first) > F.lit(MAX_STEPS * step_days), F.raise_error(said)).otherwise(steps)


def _periods(bounds: DataFrame, first_end: Column, last: Column, step_days: int) -> DataFrame:
    """posexplode a date sequence: period_id = position + 1, start = previous end + 1.

    The previous end is known arithmetically (end - step), so no window (and no
    single-partition sort) is needed; the first period has no start, as with LAG.
    """
    seq = _bounded(first_end, last, step_days, F.sequence(first_end, last, F.expr(f"INTERVAL {int(step_days)} DAYS")))
    return (bounds.select(F.posexplode(seq).alias("pos", PERIOD_END))
            .select((F.col("pos") + 1).cast("int").alias(PERIOD_ID),
                    F.when(F.col("pos") > 0, F.date_sub(F.col(PERIOD_END), step_days - 1))
                     .cast("date").alias(PERIOD_START),
                    F.col(PERIOD_END)))


def period_dim(spark: SparkSession, first_end, last, step_days: int = 7) -> DataFrame:
    """Weekly (or other step) periods ending on ``first_end``, ``first_end + step``, ... <= ``last``."""
    return _periods(spark.range(1), _date(first_end), _date(last), step_days)


def period_dim_from(df: DataFrame, start_col: str, end_col: str, step_days: int = 7) -> DataFrame:
    """Period dimension covering the data: first end = earliest start - 1 day, last = latest end.

    The bounds come from one global aggregate (partial per task, one row out),
    so the dimension grows with the calendar span, never with the row count.
    """
    bounds = df.agg(F.date_sub(F.min(start_col), 1).alias("first_end"), F.max(end_col).alias("last"))
    return _periods(bounds, F.col("first_end"), F.col("last"), step_days)


def periods_between(df: DataFrame, end_col: str) -> DataFrame:
    """Periods of any lengths from the distinct dates they end on: id by order, start = the end before + 1 (LAG).

    ``period_dim`` numbers steps of one length by arithmetic; here the dates are rows, so months,
    fiscal weeks or a calendar with gaps work. Numbers and LAG come from range partitions, not from a
    window in one task.
    """
    ends = df.select(F.to_date(end_col).alias(PERIOD_END)).filter(F.col(PERIOD_END).isNotNull()).distinct()
    numbered = dense_index(ends, [F.col(PERIOD_END).asc()], PERIOD_ID, base=1, dtype="int")
    before = lag_within(numbered, [], [PERIOD_END], PERIOD_END, "__before")
    return before.select(PERIOD_ID, F.date_add("__before", 1).alias(PERIOD_START), PERIOD_END)


def daily_spine(spark: SparkSession, start, end=None, days: int | None = None) -> DataFrame:
    """One row per day, ``start``..``end`` inclusive, or ``days`` days from ``start``.

    ``end`` defaults to today when neither ``end`` nor ``days`` is given.
    """
    s = _date(start)
    if days is not None:
        e = F.date_add(s, int(days) - 1)
    else:
        e = F.current_date() if end is None else _date(end)
    return spark.range(1).select(F.explode(_bounded(s, e, 1, F.sequence(s, e))).alias("date_value"))


def daily_spine_from(df: DataFrame, date_col: str) -> DataFrame:
    """Daily spine over the data's date range (first to last day inclusive)."""
    bounds = df.agg(F.min(F.to_date(date_col)).alias("s"), F.max(F.to_date(date_col)).alias("e"))
    # Total order as in the original calendar load (a range-partitioned sort, not a one-task sort).
    steps = _bounded(F.col("s"), F.col("e"), 1, F.sequence("s", "e"))
    return bounds.select(F.explode(steps).alias("date_value")).orderBy("date_value")


def daily_spine_by_count(df: DataFrame, date_col: str) -> DataFrame:
    """As many days as ``df`` has distinct dates, from its first one on."""
    day = F.to_date(date_col)
    bounds = df.select(day.alias("d")).distinct().agg(F.min("d").alias("s"), F.count("d").cast("int").alias("n"))
    e = F.date_add("s", F.col("n") - 1)
    return bounds.select(F.explode(_bounded(F.col("s"), e, 1, F.sequence(F.col("s"), e))).alias("date_value"))


def calendar_attrs(dim: DataFrame, basis: str = "iso") -> DataFrame:
    """Per period: year and ISO week of the period start.

    ``calendar`` = YEAR(start): mixing it with the ISO week repeats (year, week)
    keys around New Year; ``iso`` = the ISO week-numbering year, unique per week.
    """
    start = F.col(PERIOD_START)
    iso = F.expr(f"extract(YEAROFWEEK FROM {PERIOD_START})").cast("int")
    cal = F.year(start).cast("int")
    return dim.select(PERIOD_ID, PERIOD_START, F.col(PERIOD_END),
                      (cal if basis == "calendar" else iso).alias("year"),
                      F.weekofyear(start).cast("int").alias("week_num"))


def period_map(dim: DataFrame, years: int = -1, basis: str = "iso") -> DataFrame:
    """Map each period to the period with the same week number ``years`` years away.

    ``years=-1, basis='iso'`` is the real prior-year week. ``years=+1,
    basis='calendar'`` reproduces the original mapping as it was coded
    (the compared period lies one year *ahead*, and keys may repeat).
    """
    attrs = calendar_attrs(dim, basis).filter(F.col(PERIOD_START).isNotNull())
    cur = attrs.select(PERIOD_ID, F.col("year").alias("y"), F.col("week_num").alias("w"))
    cmp = attrs.select(F.col(PERIOD_ID).alias("period_id_ya"), F.col("year").alias("y2"),
                       F.col("week_num").alias("w2"))
    return (cur.join(cmp, (F.col("w") == F.col("w2")) & (F.col("y2") == F.col("y") + F.lit(years)))
            .select(PERIOD_ID, "period_id_ya"))

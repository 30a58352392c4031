"""Rule-based validation: one two-valued expression splits rows into valid and rejected."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from martforge.functions.columns import fits_scale, int_castable, matches_pattern


@dataclass(frozen=True)
class Rule:
    """A required-key test on one column.

    kind: ``not_null`` | ``int`` (present and castable to int) | ``pattern``
    (present and the regex matches) | ``date`` (present and parses as a date) |
    ``date_range`` (a date within ``pattern``, ``first..last``) | ``decimals`` (null, or a
    number that ``pattern`` digits after the point hold without rounding) |
    ``sql`` (``pattern`` holds a boolean SQL expression; NULL counts as failed).
    """

    column: str
    kind: str = "not_null"
    pattern: str | None = None

    def expr(self) -> Column:
        c = F.col(self.column)
        if self.kind == "not_null":
            return c.isNotNull()
        if self.kind == "int":
            return int_castable(c)
        if self.kind == "pattern":
            return matches_pattern(c, self.pattern)
        if self.kind == "date":
            return c.isNotNull() & F.try_to_date(c.cast("string")).isNotNull()
        if self.kind == "date_range":
            first, last = (F.to_date(F.lit(d)) for d in self.pattern.split(".."))
            return F.coalesce(F.try_to_date(c.cast("string")).between(first, last), F.lit(False))
        if self.kind == "decimals":
            return fits_scale(c, int(self.pattern))
        if self.kind == "sql":
            return F.coalesce(F.expr(self.pattern), F.lit(False))
        raise ValueError(f"unknown rule kind {self.kind!r}")


def valid_expr(rules: list[Rule]) -> Column:
    """Conjunction of the rules. Every term is two-valued, so NOT(valid) is the exact complement."""
    return reduce(lambda a, b: a & b, [r.expr() for r in rules])


def split(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """Return (valid, rejected); rejected rows keep the input shape. valid + rejected = input."""
    flag = valid_expr(rules)
    return df.filter(flag), df.filter(~flag)


def counted_rows(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` and its row count (``get["rows"]``) once an action on it has run: the count is taken in that same pass."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def counted_split(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame, Observation]:
    """``split`` whose valid side also counts: ``input_rows``, ``valid_rows`` and ``rejected_rows`` are there when it has been written."""
    ok, seen = valid_expr(rules), Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("input_rows"), F.count(F.when(ok, F.lit(1))).alias("valid_rows"),
                         F.count(F.when(~ok, F.lit(1))).alias("rejected_rows"))
    return counted.filter(ok), df.filter(~ok), seen


COUNTS_SCHEMA = "table_name string, input_rows bigint, valid_rows bigint, rejected_rows bigint"


def counts_row(name: str, seen: Observation) -> tuple:
    return name, seen.get["input_rows"], seen.get["valid_rows"], seen.get["rejected_rows"]


def dq_summary(tables: dict[str, tuple[DataFrame, list[Rule]]]) -> DataFrame:
    """One row per table: input, valid and rejected row counts, each from a single pass."""
    parts = []
    for name, (df, rules) in tables.items():
        ok = valid_expr(rules)
        parts.append(df.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("input_rows"),
            F.count(F.when(ok, F.lit(1))).alias("valid_rows"),
            F.count(F.when(~ok, F.lit(1))).alias("rejected_rows"),
        ))
    return reduce(DataFrame.unionByName, parts)

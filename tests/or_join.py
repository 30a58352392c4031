"""The literal form of the level-dependent join, to check ``hierarchy.bridge`` against."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.functions.sizing import MAX_BROADCAST_BYTES, checked_broadcast
from martforge.operators.hierarchy import HierarchySpec


def bridge_or_join(leaves: DataFrame, dim: DataFrame, spec: HierarchySpec,
                   max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """The literal OR-of-conjunctions join, to check ``bridge`` against on small inputs.

    It hashes on the top level only, so it runs with the dimension broadcast and refuses a larger one.
    """
    d = checked_broadcast(dim, max_bytes)
    if d is dim:
        raise ValueError(f"the dimension exceeds {max_bytes} bytes; use bridge()")
    d = d.alias("d")
    s = leaves.alias("s")
    branches = []
    for lvl in spec.levels:
        conj = F.col(f"d.{spec.level_col}") == F.lit(lvl.name)
        for c in lvl.match_columns:
            conj = conj & (F.col(f"d.{c}") == F.col(f"s.{c}"))
        branches.append(conj)
    cond = reduce(lambda a, b: a | b, branches)
    return d.join(s, cond).select(F.col(f"d.{spec.id_col}"), F.col(f"s.{spec.leaf_key}"))

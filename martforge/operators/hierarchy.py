"""Hierarchy dimensions (one row per node at every level), level dimensions and leaf<->node bridges."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.functions.ids import dense_index
from martforge.functions.sizing import MAX_BROADCAST_BYTES, checked_broadcast
from martforge.session import kept


@dataclass(frozen=True)
class Level:
    """One hierarchy level.

    ``columns``: path columns that are set on a node of this level (deeper ones are NULL).
    ``match``: leaf columns the bridge compares for this level (defaults to ``columns``).
    """

    name: str
    columns: tuple[str, ...]
    match: tuple[str, ...] | None = None

    @property
    def match_columns(self) -> tuple[str, ...]:
        return self.match if self.match is not None else self.columns


@dataclass(frozen=True)
class HierarchySpec:
    levels: tuple[Level, ...]        # top level first
    id_col: str
    leaf_key: str
    id_base: int = 0
    id_type: str = "bigint"
    level_col: str = "level"

    @property
    def columns(self) -> list[str]:
        out: list[str] = []
        for lvl in self.levels:
            out += [c for c in lvl.columns if c not in out]
        return out

    @property
    def match_universe(self) -> list[str]:
        out: list[str] = []
        for lvl in self.levels:
            out += [c for c in lvl.match_columns if c not in out]
        return out

    def order_of(self, level_col: Column) -> Column:
        expr = None
        for i, lvl in enumerate(self.levels, start=1):
            expr = (F.when(level_col == lvl.name, F.lit(i)) if expr is None
                    else expr.when(level_col == lvl.name, F.lit(i)))
        return expr


def _node_struct(df: DataFrame, spec: HierarchySpec, lvl: Level) -> Column:
    types = dict(df.dtypes)
    fields = [F.lit(lvl.name).alias(spec.level_col)]
    for c in spec.columns:
        fields.append(F.col(c).alias(c) if c in lvl.columns else F.lit(None).cast(types[c]).alias(c))
    return F.struct(*fields)


def hierarchy_nodes(df: DataFrame, spec: HierarchySpec) -> DataFrame:
    """Distinct nodes of every level, without ids.

    Each leaf row is exploded into its node at every level and a single
    ``distinct`` follows: one shuffle for all levels, combined map-side, so a
    top node shared by every leaf never concentrates rows in one task.
    """
    nodes = F.explode(F.array(*[_node_struct(df, spec, lvl) for lvl in spec.levels]))
    return df.select(nodes.alias("n")).select("n.*").distinct()


def hierarchy_dim(df: DataFrame, spec: HierarchySpec) -> DataFrame:
    """Dimension with a dense id ordered by the node path (NULLs first, so a parent
    precedes its children; the level order breaks remaining ties)."""
    nodes = hierarchy_nodes(df, spec).withColumn("__lvl", spec.order_of(F.col(spec.level_col)))
    order = [F.col(c).asc_nulls_first() for c in spec.columns] + [F.col("__lvl").asc()]
    ided = dense_index(nodes, order, spec.id_col, base=spec.id_base, dtype=spec.id_type)
    return ided.select(spec.id_col, *spec.columns, spec.level_col)


def level_dim(dim: DataFrame, spec: HierarchySpec) -> DataFrame:
    """(level_order, level) for the levels present in a hierarchy dimension."""
    levels = dim.select(spec.level_col).distinct()
    return levels.select(spec.order_of(F.col(spec.level_col)).cast("int").alias("level_order"),
                         F.col(spec.level_col).alias("level"))


def _leaf_keys(leaves: DataFrame, spec: HierarchySpec) -> DataFrame:
    """One row per (leaf, level) whose match columns are all present (``=`` never matches NULL)."""
    types = dict(leaves.dtypes)
    per_level = []
    for lvl in spec.levels:
        ok = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in lvl.match_columns])
        fields = [F.lit(lvl.name).alias("__level"), ok.alias("__ok")]
        for c in spec.match_universe:
            fields.append((F.col(c) if c in lvl.match_columns else F.lit(None).cast(types[c])).alias(f"__k_{c}"))
        per_level.append(F.struct(*fields))
    exploded = leaves.select(F.col(spec.leaf_key), F.explode(F.array(*per_level)).alias("n"))
    return exploded.select(spec.leaf_key, "n.*").filter(F.col("__ok")).drop("__ok")


def _node_keys(dim: DataFrame, spec: HierarchySpec) -> DataFrame:
    lvl_col = F.col(spec.level_col)
    cols = [F.col(spec.id_col), lvl_col.alias("__level")]
    for c in spec.match_universe:
        using = [lvl.name for lvl in spec.levels if c in lvl.match_columns]
        cols.append(F.when(lvl_col.isin(using), F.col(c)).alias(f"__k_{c}"))
    return dim.select(*cols)


def bridge(leaves: DataFrame, dim: DataFrame, spec: HierarchySpec,
           max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """(node id, leaf key) for every node a leaf rolls up to.

    Equivalent to the level-dependent OR join ``(level = 'a' AND a = a') OR
    (level = 'b' AND a = a' AND b = b') ...``, written as one equi-join per
    level. The nodes of the upper levels are few and their keys hot (a top node
    is shared by all leaves), so they are broadcast behind a check of their
    bytes and the leaves stay where they are; only the last level, whose key
    is as fine as the leaves, may be shuffled.
    """
    parts = []
    for i, lvl in enumerate(spec.levels):
        nodes = dim.filter(F.col(spec.level_col) == lvl.name).select(
            F.col(spec.id_col).alias("__id"), *[F.col(c).alias(f"__k_{c}") for c in lvl.match_columns])
        if i < len(spec.levels) - 1:
            nodes = checked_broadcast(nodes, max_bytes)
        own = leaves.select(spec.leaf_key, *[c for c in lvl.match_columns if c != spec.leaf_key])
        cond = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"__k_{c}") for c in lvl.match_columns])
        parts.append(own.join(nodes, cond).select(F.col("__id").alias(spec.id_col), spec.leaf_key))
    return reduce(DataFrame.unionByName, parts)


def parent_links(dim: DataFrame, spec: HierarchySpec) -> DataFrame:
    """(child, parent): every node below the top with the node one level up that has its path; ragged dimensions may skip levels.

    A parent is the nearest level above where the path is found, so a node whose level
    above is missing hangs under the next one.
    """
    found: DataFrame | None = None
    for i in range(1, len(spec.levels)):
        children = dim.filter(F.col(spec.level_col) == spec.levels[i].name)
        own = children.select(F.col(spec.id_col).alias("child"), *[F.col(c) for c in spec.levels[i - 1].columns])
        for above in range(i - 1, -1, -1):
            path = list(spec.levels[above].columns)
            nodes = dim.filter(F.col(spec.level_col) == spec.levels[above].name).select(F.col(spec.id_col).alias("parent"), *path)
            part = own.join(nodes, path).select("child", "parent")
            found = part if found is None else found.unionByName(part)
            if above:  # nodes without a parent here look one level higher
                own = own.join(nodes, path, "left_anti").select("child", *spec.levels[above - 1].columns)
    return found


#: Levels a hierarchy may have; a longer chain of parents is a cycle.
MAX_DEPTH = 64


def ancestors(links: DataFrame, nodes: DataFrame, node: str) -> DataFrame:
    """(node, ancestor, distance): every node with itself (distance 0) and all nodes above it, at any depth, by a recursive query.

    Each step joins what the last one found with the links, so a ragged or deep hierarchy needs
    no fixed number of levels. A cycle of parents ends in an error at ``MAX_DEPTH`` steps.
    """
    spark = links.sparkSession
    names = [f"__{what}_{uuid.uuid4().hex}" for what in ("links", "nodes")]
    links.createOrReplaceTempView(names[0])
    nodes.select(F.col(node).alias("node")).createOrReplaceTempView(names[1])
    # Rows of a recursion grow with the dimension; its depth is what has a bound.
    limits = {"spark.sql.cteRecursionLevelLimit": str(MAX_DEPTH), "spark.sql.cteRecursionRowLimit": "-1"}
    before = {k: spark.conf.get(k, None) for k in limits}
    for k, v in limits.items():
        spark.conf.set(k, v)
    try:
        return kept(spark.sql(f"""
            WITH RECURSIVE up(node, ancestor, distance) AS (
                SELECT node, node, 0 FROM {names[1]}
                UNION ALL
                SELECT up.node, links.parent, up.distance + 1 FROM up JOIN {names[0]} links ON links.child = up.ancestor)
            SELECT node, ancestor, distance FROM up"""), "ancestors")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
        for name in names:
            spark.catalog.dropTempView(name)


def bridge_by_ancestors(leaves: DataFrame, dim: DataFrame, spec: HierarchySpec) -> DataFrame:
    """``bridge`` by recursion: each leaf's deepest node, then all ancestors of that node.

    Leaves may hang at any level (ragged hierarchies): a leaf belongs to the deepest level whose path it has and the
    dimension knows, and to everything above that.
    """
    own, found = leaves, None
    for i in range(len(spec.levels) - 1, -1, -1):
        lvl = spec.levels[i]
        nodes = dim.filter(F.col(spec.level_col) == lvl.name).select(F.col(spec.id_col).alias("node"), *lvl.match_columns)
        part = own.join(nodes, list(lvl.match_columns)).select("node", spec.leaf_key)
        found = part if found is None else found.unionByName(part)
        own = own.join(nodes, list(lvl.match_columns), "left_anti")
    up = ancestors(parent_links(dim, spec), dim, spec.id_col)
    return found.join(up, "node").select(F.col("ancestor").alias(spec.id_col), spec.leaf_key)


def bridge_by_key(leaves: DataFrame, dim: DataFrame, spec: HierarchySpec) -> DataFrame:
    """``bridge`` in one join: leaves exploded into one key per level, joined on (level, whole path).

    Kept as a second form to check ``bridge`` against; its upper keys are hot.
    """
    keys, nodes = _leaf_keys(leaves, spec), _node_keys(dim, spec)
    cond = [keys["__level"] == nodes["__level"]]
    cond += [keys[f"__k_{c}"].eqNullSafe(nodes[f"__k_{c}"]) for c in spec.match_universe]
    return keys.join(nodes, reduce(lambda a, b: a & b, cond)).select(nodes[spec.id_col], keys[spec.leaf_key])

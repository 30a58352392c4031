"""Distinct counts that add up: sets of stores as bitmaps, merged from level to level of two hierarchies."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.functions.columns import exact_measure
from martforge.functions.ids import dense_index
from martforge.operators import facts
from martforge.operators.calendar import PERIOD_ID
from martforge.operators.hierarchy import HierarchySpec, bridge
from martforge.session import drop_kept, kept

#: Columns of a cell that add up.
_MEASURES = ("__amt", "__units")


def numbered(leaves: DataFrame, key: str, name: str = "__no", after: tuple[str, ...] = ()) -> DataFrame:
    """(key, name): dense numbers from 0 in the order of ``after`` (columns of the leaves) and the key."""
    order = [F.col(c).asc_nulls_first() for c in after]
    return dense_index(leaves.select(*after, key).distinct(), [*order, F.col(key).asc()], name).drop(*after)


def _path(prefix: str, level: int) -> list[str]:
    return [f"__{prefix}{i}" for i in range(level + 1)]


def level_ids(leaves: DataFrame, dim: DataFrame, spec: HierarchySpec, prefix: str) -> DataFrame:
    """(leaf, ``__<prefix>0`` ..): the node of every level above a leaf, null where it has none. Leaves have one row per key."""
    found = bridge(leaves, dim, spec).join(dim.select(spec.id_col, spec.level_col), spec.id_col)
    return found.groupBy(spec.leaf_key).agg(
        *[F.max(F.when(F.col(spec.level_col) == lvl.name, F.col(spec.id_col))).alias(c)
          for lvl, c in zip(spec.levels, _path(prefix, len(spec.levels) - 1))])


def _cells(words: DataFrame, keys: list[str]) -> DataFrame:
    """One row per cell: its sums and its stores as (word, bits), 64 neighbours to a word and no word without a store."""
    return words.groupBy(*keys, PERIOD_ID).agg(
        *[F.sum(m).alias(m) for m in _MEASURES], F.collect_list(F.struct("__word", "__bits")).alias("__stores"))


def _summed(rows: DataFrame, keys: list[str], bits: Column) -> DataFrame:
    return rows.groupBy(*keys, PERIOD_ID, "__word").agg(*[F.sum(m).alias(m) for m in _MEASURES], F.bit_or(bits).alias("__bits"))


def leaf_words(sales: DataFrame, stores: DataFrame, products: DataFrame, keys: list[str], store_key: str, product_key: str) -> DataFrame:
    """Stored words of the cells (``_cells``) of the lowest levels from sales (``__amt``, ``__units``, period), ``stores`` with
    nodes and ``__no``, and ``products`` with nodes.

    Every sale is read once; no level above reads it again.
    """
    sold = (sales.join(products, product_key).drop(product_key).join(stores, store_key).drop(store_key)
            .withColumn("__word", F.shiftright("__no", 6)))
    # Step by step, so that no step's shuffle files lie beside those of another.
    sold = kept(sold.select(*keys, PERIOD_ID, *_MEASURES, "__word", F.expr("shiftleft(1L, cast(__no & 63 as int))").alias("__bits")), "sold")
    words = kept(_summed(sold, keys, F.col("__bits")), "words")
    drop_kept(sold)
    return words


def merged(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Cells of a level above: those below with the same nodes, sums added and bitmaps united.

    A cell below moves once, to its cell above, which has at most as many below it as its node has children.
    """
    # The sums go with the first word of a cell.
    once = F.col("__at") == 0
    moved = cells.select(*keys, PERIOD_ID, *_MEASURES, "__stores").repartition(*keys, PERIOD_ID)
    words = moved.select(*keys, PERIOD_ID, *_MEASURES, F.posexplode("__stores").alias("__at", "__w")).select(
        *keys, PERIOD_ID, *[F.when(once, F.col(m)).alias(m) for m in _MEASURES], F.col("__w.__word").alias("__word"), F.col("__w.__bits").alias("__own"))
    return _cells(_summed(words, keys, F.col("__own")), keys)


def cell_levels(leaf: DataFrame, geography: HierarchySpec, product: HierarchySpec, keep,
                done=lambda cells: None) -> Iterator[tuple[tuple[int, int], DataFrame]]:
    """((geography level, product level), cells); each comes from a neighbour below it, and ``keep`` stores it.

    Product level by product level, the geography is climbed from the lowest; so two levels are in use
    at a time beside the one that is made. ``done`` is called with cells that no further level is made from,
    once the caller has asked for the next.
    """
    low_g, low_p = len(geography.levels) - 1, len(product.levels) - 1
    base = None
    for p in range(low_p, -1, -1):
        made = keep(leaf if base is None else merged(base, [*_path("g", low_g), *_path("p", p)]), f"cells_{low_g}_{p}")
        if base is not None:
            done(base)
        base = cells = made
        yield (low_g, p), base
        for g in range(low_g - 1, -1, -1):
            above = keep(merged(cells, [*_path("g", g), *_path("p", p)]), f"cells_{g}_{p}")
            if cells is not base:
                done(cells)
            cells = above
            yield (g, p), cells
        if cells is not base:
            done(cells)
    done(base)


def rollup_fact_bitmaps(sales: DataFrame, periods: DataFrame, stores: DataFrame, products: DataFrame, dim_geography: DataFrame,
                        dim_product: DataFrame, geography: HierarchySpec, product: HierarchySpec, keep, done=None) -> DataFrame:
    """``facts.rollup_fact`` with stores as mergeable sets: (geography_id, hierarchy_id, period_id, sales, units, stores_selling).

    ``facts.rollup_fact`` expands every store's sums to all nodes; this form aggregates
    them once and derives each level from the level below, and its cells can be
    merged further later (other levels, other periods), which counts cannot. Stores are numbered along
    the geography, so those of a node are neighbours; a cell takes 16 bytes per 64 neighbours of which one sells,
    never more than 16 per store. With ``done`` (``cell_levels``) the rows of a level are stored by ``keep`` before the
    next one is made, and the cells need not stay; without it all cells stay.
    """
    store_key, product_key = geography.leaf_key, product.leaf_key
    own = facts.join_periods(sales, periods).select(
        store_key, product_key, PERIOD_ID, exact_measure("sales_amount", facts.AMOUNT_SCALE).alias("__amt"),
        exact_measure("sales_units", facts.UNITS_SCALE).alias("__units"))
    low_g, low_p = len(geography.levels) - 1, len(product.levels) - 1
    placed = level_ids(stores, dim_geography, geography, "g")
    placed = placed.join(numbered(placed, store_key, after=tuple(_path("g", low_g))), store_key)
    keys = [*_path("g", low_g), *_path("p", low_p)]
    words = leaf_words(own, placed, level_ids(products, dim_product, product, "p"), keys, store_key, product_key)
    parts = []
    for (g, p), cells in cell_levels(_cells(words, keys), geography, product, keep, done or (lambda cells: None)):
        if not parts:
            drop_kept(words)
        node = {geography.id_col: F.col(f"__g{g}"), product.id_col: F.col(f"__p{p}")}
        count = F.aggregate("__stores", F.lit(0).cast("bigint"), lambda n, w: n + F.bit_count(w["__bits"]))
        rows = cells.filter(F.col(f"__g{g}").isNotNull() & F.col(f"__p{p}").isNotNull()).select(
            *[c.alias(name) for name, c in node.items()], PERIOD_ID, F.col("__amt").cast("double").alias("sales"),
            F.col("__units").cast("double").alias("units"), count.alias("stores_selling"))
        parts.append(keep(rows, f"rows_{g}_{p}") if done else rows)
    return reduce(DataFrame.unionByName, parts)

"""Fact roll-up over two hierarchies and a period dimension."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.functions.columns import exact_measure
from martforge.functions.sizing import checked_broadcast
from martforge.operators.calendar import PERIOD_END, PERIOD_ID, PERIOD_START
from martforge.session import kept

#: Digits after the point that measures are summed with; finer ones are rounded, see ``exact_measure``.
AMOUNT_SCALE = 10
UNITS_SCALE = 10
#: Sales of one store and period from which they are summed before they move.
HOT_ROWS = 1 << 20
#: Sales of one tree of product nodes and chain of periods from which they are not rolled up in one task.
GROUP_ROWS = 1 << 19
#: Sales a task rolls up (each becomes a cell per pair of nodes), and the fewest tasks.
TASK_ROWS = 100_000
MIN_TASKS = 8
#: Sales of a product node and chain of periods from which the node's stores are dealt over several tasks.
NODE_ROWS = 1 << 16
#: Different sets of geography nodes above a store up to which they are a table of their own, small enough to be broadcast; beyond, every sale carries its own.
MAX_SETS = 10_000


def join_periods(sales: DataFrame, periods: DataFrame, start: str = "period_start",
                 end: str = "period_end") -> DataFrame:
    """Inner equi-join of facts to the period dimension on (start, end).

    The dimension is broadcast: ``operators.calendar`` refuses more than
    ``MAX_STEPS`` periods, so its size is bounded whatever the data holds.
    """
    p = F.broadcast(periods.select(PERIOD_ID, PERIOD_START, PERIOD_END))
    return sales.join(p, (sales[start] == p[PERIOD_START]) & (sales[end] == p[PERIOD_END])) \
        .drop(PERIOD_START, PERIOD_END)


def _measured(sales: DataFrame, periods: DataFrame, store_key: str, product_key: str, amount: str, units: str,
              amount_scale: int, units_scale: int) -> DataFrame:
    return join_periods(sales, periods).select(
        store_key, product_key, PERIOD_ID, exact_measure(amount, amount_scale).alias("__amt"),
        exact_measure(units, units_scale).alias("__units"))


def _sums() -> list[Column]:
    return [F.sum("__amt").alias("__amt"), F.sum("__units").alias("__units")]


def hot_pairs(sales: DataFrame, periods: DataFrame, store_key: str = "store_id", limit: int = HOT_ROWS) -> DataFrame:
    """(store, period) with more than ``limit`` sales: one combined count over two columns, at most sales / limit rows."""
    pairs = join_periods(sales, periods).groupBy(store_key, PERIOD_ID).agg(F.count(F.lit(1)).alias("__n"))
    return pairs.filter(F.col("__n") > limit).select(store_key, PERIOD_ID)


def store_sums(sales: DataFrame, periods: DataFrame, store_key: str = "store_id", product_key: str = "product_id",
               amount: str = "sales_amount", units: str = "sales_units", amount_scale: int = AMOUNT_SCALE,
               units_scale: int = UNITS_SCALE) -> DataFrame:
    """Sales per (store, product, period), partitioned by (store, period), as exact ``__amt`` and ``__units``.

    This is the only exchange that carries sales rows. Grouping by (store,
    product, period) and later by (store, product node, period) is satisfied by
    it, so products are expanded to their nodes after it, not before.
    """
    f = _measured(sales, periods, store_key, product_key, amount, units, amount_scale, units_scale)
    return f.repartition(store_key, PERIOD_ID).groupBy(store_key, product_key, PERIOD_ID).agg(*_sums())


def presummed(sales: DataFrame, periods: DataFrame, store_key: str = "store_id", product_key: str = "product_id",
              amount: str = "sales_amount", units: str = "sales_units", amount_scale: int = AMOUNT_SCALE,
              units_scale: int = UNITS_SCALE) -> DataFrame:
    """``store_sums`` summed in the tasks that read the sales: a (store, period) sends at most a row per task and product."""
    f = _measured(sales, periods, store_key, product_key, amount, units, amount_scale, units_scale)
    return f.groupBy(store_key, product_key, PERIOD_ID).agg(*_sums())


def product_step(sales: DataFrame, periods: DataFrame, prod_bridge: DataFrame,
                 store_key: str = "store_id", product_key: str = "product_id", prod_id: str = "hierarchy_id",
                 amount: str = "sales_amount", units: str = "sales_units", amount_scale: int = AMOUNT_SCALE,
                 units_scale: int = UNITS_SCALE, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Roll-up step 1: exact sums per (store, product node, period), in place where ``store_sums`` put them.

    A store with very many sales in one period would put them all into one task
    there. Such pairs are counted first; their sales are summed before they
    move (``presummed``) and their few sums move again by node. Sales of other pairs, which
    hardly ever repeat a product, move once. The bridge is broadcast when Spark
    measures it small; otherwise both sides are shuffled by product.
    """
    measures = (store_key, product_key, amount, units, amount_scale, units_scale)

    def by_node(per: DataFrame) -> DataFrame:
        return (per.join(prod_bridge.select(prod_id, product_key), product_key)
                .groupBy(store_key, prod_id, PERIOD_ID).agg(*_sums()))

    # Written, so that counting them is one job and both branches below see the same pairs.
    hot = kept(hot_pairs(sales, periods, store_key, hot_rows), "hot_pairs")
    if hot.isEmpty():
        return by_node(store_sums(sales, periods, *measures))
    # Pairs become the two dates again, so that sales are told apart before the join with the periods.
    dates = checked_broadcast(hot.join(F.broadcast(periods), PERIOD_ID).select(
        F.col(store_key).alias("__store"), F.col(PERIOD_START).alias("__start"), F.col(PERIOD_END).alias("__end")))
    same = ((F.col(store_key) == F.col("__store")) & (F.col("period_start") == F.col("__start"))
            & (F.col("period_end") == F.col("__end")))
    few = by_node(store_sums(sales.join(dates, same, "left_anti"), periods, *measures))
    many = by_node(presummed(sales.join(dates, same, "left_semi"), periods, *measures))
    return few.unionByName(many)


def trees(bridge: DataFrame, node: str, leaf: str, name: str = "__tree") -> DataFrame:
    """(leaf, tree, nodes): the nodes of every leaf, dealt into groups such that each node is in exactly one.

    A node's group is the least node that stands beside it under any of its leaves; in a hierarchy
    whose parents are numbered before their children that is the top node. A leaf whose nodes
    lie in several groups has a row in each, so the rows of a node are always found under one group.
    """
    low = bridge.groupBy(leaf).agg(F.min(node).alias("__low"), F.collect_list(node).alias("__each"))
    each = low.select(leaf, "__low", F.explode("__each").alias("__node"))
    of_node = each.groupBy("__node").agg(F.min("__low").alias(name))
    return each.join(of_node, "__node").groupBy(leaf, name).agg(F.collect_list("__node").alias("__nodes"))


def _sets(bridge: DataFrame, leaf: str, node: str) -> DataFrame:
    """(leaf, ``__geos``): all nodes of a leaf as one sorted array."""
    return bridge.filter(F.col(leaf).isNotNull()).groupBy(leaf).agg(F.sort_array(F.collect_list(node)).alias("__geos"))


def _located(rows: DataFrame, geo_bridge: DataFrame, store_key: str, geo_id: str) -> tuple[DataFrame, DataFrame | None]:
    """(rows with the set of their store's nodes as ``__at``, the sets); with too many sets, rows carry ``__geos`` and there is no second table.

    Stores of one district have the same nodes, so a set goes by the least of its stores while rows move.
    """
    per = kept(_sets(geo_bridge, store_key, geo_id), "store_nodes")
    sets = kept(per.groupBy("__geos").agg(F.min(store_key).alias("__at")), "node_sets")
    if sets.count() > MAX_SETS:
        return rows.join(per, store_key), None
    return rows.join(per.join(F.broadcast(sets), "__geos").select(store_key, "__at"), store_key), sets


def wide_nodes(bridge: DataFrame, node: str, leaf: str, sales: int, limit: int = NODE_ROWS) -> DataFrame:
    """(node) whose share of the leaves would give it more than ``limit`` of ``sales``."""
    if sales <= limit:
        return bridge.select(node).limit(0)
    leaves = max(1, bridge.select(leaf).distinct().count())
    per = bridge.groupBy(node).agg(F.count_distinct(leaf).alias("__n"))
    return kept(per.filter(F.col("__n") * F.lit(sales / leaves) > limit).select(node), "wide_nodes")


def _nodes(bridge: DataFrame, node: str, leaf: str, wide: DataFrame) -> DataFrame:
    """``trees`` without the ``wide`` nodes; these stand in ``__wide`` of the first row of their leaves, whose tree is null if they are all it has."""
    if wide.isEmpty():
        return trees(bridge, node, leaf).withColumn("__wide", F.lit(None).cast(f"array<{dict(bridge.dtypes)[node]}>"))
    wide = checked_broadcast(wide)
    own = kept(trees(bridge.join(wide, node, "left_anti"), node, leaf), "trees")
    above = bridge.join(wide, node, "left_semi").groupBy(leaf).agg(F.collect_list(node).alias("__wide"))
    above = above.join(own.groupBy(leaf).agg(F.min("__tree").alias("__tree")), leaf, "left")
    # One file table: the joins above are over leaves, and the sales are many more.
    return kept(own.join(above, [leaf, "__tree"], "full"), "nodes")


def _placed(sales: DataFrame, periods: DataFrame, prod_bridge: DataFrame, geo_bridge: DataFrame, store_key: str, product_key: str,
            geo_id: str, prod_id: str, amount: str, units: str, chains: DataFrame | None,
            node_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """(sales with period, chain, tree, product nodes and set of store nodes, the sets); written once: they are counted and then rolled up."""
    own = join_periods(sales, periods).select(
        store_key, product_key, PERIOD_ID, F.col(amount).cast("double").alias("__amt"), F.col(units).cast("double").alias("__units"))
    groups = (periods if chains is None else chains.select("__chain").distinct()).count()
    wide = wide_nodes(prod_bridge, prod_id, product_key, sales.count() // max(1, groups), node_rows)
    found, sets = _located(own, geo_bridge, store_key, geo_id)
    found = found.join(_nodes(prod_bridge, prod_id, product_key, wide), product_key).drop(product_key)
    if chains is None:
        return kept(found.withColumn("__chain", F.col(PERIOD_ID).cast("bigint")), "placed"), sets
    return kept(found.join(F.broadcast(chains), PERIOD_ID, "left"), "placed"), sets  # a row per period


def _cells(rows: DataFrame, sets: DataFrame | None, store_key: str, geo_id: str, prod_id: str, with_stores: bool,
           digits: tuple[int, int]) -> DataFrame:
    """Sums per (``__slot``, geography node, product node, period) of sales with their nodes; ``__slot`` stays.

    ``sales`` and ``units`` are still decimals, so that cells of several slots add up exactly.
    """
    at = "__geos" if sets is None else "__at"
    exact = {m: exact_measure(m, d) for m, d in zip(("__amt", "__units"), digits)}
    per = (rows.withColumns(exact).withColumn(prod_id, F.explode("__nodes"))
           .groupBy("__slot", PERIOD_ID, prod_id, store_key, at).agg(*_sums()))
    aggs = [F.sum("__amt").alias("sales"), F.sum("__units").alias("units")]
    if with_stores:
        aggs.append(F.count(F.lit(1)).alias("stores_selling"))
    per = per if sets is None else per.join(sets, "__at")
    return per.withColumn(geo_id, F.explode("__geos")).groupBy("__slot", geo_id, prod_id, PERIOD_ID).agg(*aggs)


def _as_doubles(cells: DataFrame) -> DataFrame:
    return cells.withColumns({m: F.col(m).cast("double") for m in ("sales", "units")})


def rollup_parts(sales: DataFrame, periods: DataFrame, geo_bridge: DataFrame, prod_bridge: DataFrame,
                 store_key: str = "store_id", product_key: str = "product_id",
                 geo_id: str = "geography_id", prod_id: str = "hierarchy_id",
                 amount: str = "sales_amount", units: str = "sales_units", with_stores: bool = True,
                 amount_scale: int = AMOUNT_SCALE, units_scale: int = UNITS_SCALE, hot_rows: int = GROUP_ROWS,
                 chains: DataFrame | None = None, rows_per_task: int = TASK_ROWS, node_rows: int = NODE_ROWS) -> list[DataFrame]:
    """``rollup_fact`` in parts that share no (geography node, product node, period), each row with its task's ``__slot``.

    ``chains`` (period, ``__chain``) puts periods that are compared with each other into one group;
    without it every period is one of its own. Sales get their product nodes and store nodes and move
    to their tree of product nodes and chain; from there on all nodes, sums and counts of the group are built where it
    lies, so the many rows per node are never moved. A product node with more than ``node_rows`` sales in a chain
    (``wide_nodes``) would make its tree too large for a task, so it is taken out of the trees: its sales move once more,
    dealt by store, and its cells of all stores, few per node, add up. Groups that still have more than ``hot_rows`` sales
    form a part of their own: its sums per store and node are combined in their tasks and move.
    """
    placed, sets = _placed(sales, periods, prod_bridge, geo_bridge, store_key, product_key, geo_id, prod_id, amount, units,
                           chains, node_rows)
    return _rolled(placed, sets, store_key, geo_id, prod_id, with_stores, amount_scale, units_scale, hot_rows, rows_per_task)


def _dealt(rows: DataFrame, by: str, tasks: int, chains: int) -> DataFrame:
    """Rows in ``__slot`` tasks by chain and ``by``; a chain's tasks have numbers side by side, and none has two chains if there are enough."""
    each = max(1, tasks // chains)
    n = each * chains if tasks >= chains else tasks
    slot = F.pmod(F.col("__chain") * each + F.pmod(F.xxhash64(by), F.lit(each)), F.lit(n)).cast("int")
    return rows.withColumn("__slot", slot).repartitionById(n, "__slot")


def _wide_cells(rows: DataFrame, sets: DataFrame | None, store_key: str, geo_id: str, prod_id: str, with_stores: bool,
                digits: tuple[int, int], tasks: int, chains: int) -> DataFrame:
    """Cells of the wide nodes: sales are dealt by chain and store, so a store is counted once, and the cells of all tasks are added."""
    dealt = _dealt(rows.select(store_key, PERIOD_ID, "__amt", "__units", "__chain", "__geos" if sets is None else "__at",
                               F.col("__wide").alias("__nodes")), store_key, tasks, chains)
    cells = _cells(dealt, sets, store_key, geo_id, prod_id, with_stores, digits)
    measures = [c for c in cells.columns if c not in ("__slot", geo_id, prod_id, PERIOD_ID)]
    total = cells.groupBy(geo_id, prod_id, PERIOD_ID).agg(*[F.sum(c).alias(c) for c in measures])
    # Written: few rows, and the sales that moved for them need not lie beside those of the other part.
    return kept(_as_doubles(total.select(F.lit(0).alias("__slot"), geo_id, prod_id, PERIOD_ID, *measures)), "wide_cells")


def _rolled(placed: DataFrame, sets: DataFrame | None, store_key: str, geo_id: str, prod_id: str, with_stores: bool,
            amount_scale: int = AMOUNT_SCALE, units_scale: int = UNITS_SCALE, hot_rows: int = GROUP_ROWS,
            rows_per_task: int = TASK_ROWS) -> list[DataFrame]:
    groups, named = ["__tree", "__chain"], (store_key, geo_id, prod_id, with_stores, (amount_scale, units_scale))
    sizes = kept(placed.groupBy(*groups).agg(F.count("__nodes").alias("__n"), F.count("__wide").alias("__w")), "groups")
    seen = sizes.agg(*[F.coalesce(x, F.lit(0)).alias(c) for c, x in (
        ("n", F.sum("__n")), ("most", F.max("__n")), ("wide", F.sum("__w")), ("chains", F.count_distinct("__chain")))]).first()
    tasks = lambda n: max(MIN_TASKS, -(-n // rows_per_task))
    chains = max(1, seen["chains"])
    wide = []
    if seen["wide"]:
        wide = [_wide_cells(placed.filter(F.col("__wide").isNotNull()), sets, *named, tasks(seen["wide"]), chains)]
    placed = placed.drop("__wide").filter(F.col("__nodes").isNotNull())

    def at_home(rows: DataFrame) -> DataFrame:
        return _as_doubles(_cells(_dealt(rows, "__tree", tasks(seen["n"]), chains).drop(*groups), sets, *named))

    if seen["most"] <= hot_rows:
        return [at_home(placed), *wide]
    hot = checked_broadcast(sizes.filter(F.col("__n") > hot_rows).select(*[F.col(c).alias(f"_{c}") for c in groups]))
    same = (F.col("__tree") == F.col("___tree")) & F.col("__chain").eqNullSafe(F.col("___chain"))
    many = placed.join(hot, same, "left_semi").withColumn("__slot", F.lit(0))
    return [at_home(placed.join(hot, same, "left_anti")), _as_doubles(_cells(many, sets, *named)), *wide]


def rollup_fact(sales: DataFrame, periods: DataFrame, geo_bridge: DataFrame, prod_bridge: DataFrame,
                store_key: str = "store_id", product_key: str = "product_id",
                geo_id: str = "geography_id", prod_id: str = "hierarchy_id",
                amount: str = "sales_amount", units: str = "sales_units", with_stores: bool = True,
                amount_scale: int = AMOUNT_SCALE, units_scale: int = UNITS_SCALE, hot_rows: int = GROUP_ROWS) -> DataFrame:
    """Sales at every geography node x product node x period.

    ``rollup_parts`` by (tree of product nodes, period): sales are summed per (store,
    product node, period), then per (geo node, product node, period) and
    counted: after the first step a store appears once per group,
    so ``count(*)`` is the distinct number of selling stores (the bridge holds
    one row per node/store pair) and no distinct aggregation is needed.
    Sums are exact, so the result does not depend on the order they are combined in.
    """
    parts = rollup_parts(sales, periods, geo_bridge, prod_bridge, store_key, product_key, geo_id, prod_id, amount, units,
                         with_stores, amount_scale, units_scale, hot_rows)
    return reduce(DataFrame.unionByName, parts).drop("__slot")


def rollup_bucketed(sales: DataFrame, prod_bridge: DataFrame, periods: DataFrame, geo_bridge: DataFrame,
                    store_key: str = "store_id", product_key: str = "product_id", geo_id: str = "geography_id",
                    prod_id: str = "hierarchy_id", amount: str = "sales_amount", units: str = "sales_units") -> DataFrame:
    """``rollup_fact`` without store counts, for sales and a product bridge that are stored bucketed by product.

    Bucketed alike (``layers.write_bucketed``), matching buckets are joined where they
    are read: sales meet the nodes of their product without any exchange. They move once, to the
    least of these nodes and their period, and are rolled up there (``rollup_parts``). Where a node
    stands under several of these (the bridge is no hierarchy), the sums per (store, node, period) move instead.
    """
    f = _measured(sales, periods, store_key, product_key, amount, units, AMOUNT_SCALE, UNITS_SCALE)
    nodes = prod_bridge.groupBy(product_key).agg(F.min(prod_id).alias("__tree"), F.collect_list(prod_id).alias("__nodes"))
    shared = (nodes.select("__tree", F.explode("__nodes").alias("__node")).groupBy("__node")
              .agg(F.min("__tree").alias("low"), F.max("__tree").alias("high")).filter("low < high"))
    if kept(shared, "shared_nodes").isEmpty():
        own = join_periods(sales, periods).select(
            store_key, product_key, PERIOD_ID, F.col(PERIOD_ID).cast("bigint").alias("__chain"), F.col(amount).cast("double").alias("__amt"),
            F.col(units).cast("double").alias("__units"))
        nodes = nodes.withColumn("__wide", F.lit(None).cast(nodes.schema["__nodes"].dataType))
        found, sets = _located(own.join(nodes.hint("merge"), product_key).drop(product_key), geo_bridge, store_key, geo_id)
        return reduce(DataFrame.unionByName, _rolled(kept(found, "placed"), sets, store_key, geo_id, prod_id, False)).drop("__slot")
    per = f.groupBy(product_key, store_key, PERIOD_ID).agg(*_sums())
    by_node = (per.join(prod_bridge.select(prod_id, product_key).hint("merge"), product_key)
               .groupBy(store_key, prod_id, PERIOD_ID).agg(*_sums()))
    return (by_node.join(geo_bridge.select(geo_id, store_key), store_key).groupBy(geo_id, prod_id, PERIOD_ID)
            .agg(F.sum("__amt").cast("double").alias("sales"), F.sum("__units").cast("double").alias("units")))


def rollup_fact_direct(sales: DataFrame, periods: DataFrame, geo_bridge: DataFrame,
                       prod_bridge: DataFrame, store_key: str = "store_id",
                       product_key: str = "product_id", geo_id: str = "geography_id",
                       prod_id: str = "hierarchy_id", amount: str = "sales_amount",
                       units: str = "sales_units", with_stores: bool = True) -> DataFrame:
    """One join-and-group form with COUNT(DISTINCT store). Kept for equivalence tests of :func:`rollup_fact`."""
    joined = join_periods(sales, periods).join(geo_bridge, store_key).join(prod_bridge, product_key)
    aggs = [F.sum(exact_measure(amount, AMOUNT_SCALE)).cast("double").alias("sales"),
            F.sum(exact_measure(units, UNITS_SCALE)).cast("double").alias("units")]
    if with_stores:
        aggs.append(F.count_distinct(store_key).alias("stores_selling"))
    return joined.groupBy(geo_id, prod_id, PERIOD_ID).agg(*aggs)


def node_totals(bridge: DataFrame, node: str = "geography_id", leaf: str = "store_id",
                name: str = "total_stores") -> DataFrame:
    """Exact distinct leaves per node (Spark expands the distinct into a (node, leaf)
    shuffle first, so the top node is spread over all tasks)."""
    return bridge.groupBy(node).agg(F.count_distinct(leaf).alias(name))

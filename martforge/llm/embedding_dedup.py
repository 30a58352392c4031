"""Near-duplicate vectors by spherical-cap filters from structured random product codes.

Vectors are compared only within a label and a dimension. Directions are
turned by one random rotation, cut into blocks, and each block has a random
code of unit vectors; a filter is one codeword of every block, so ``c`` codewords in
each of ``b`` blocks make c^b filters without storing them. List-decoding a
vector finds every filter whose direction it exceeds by the threshold: partial
sums over the blocks that cannot reach it are pruned. Besides those, a vector
takes its ``LEAST`` best filters, so that none is left out. Vectors meet in
the filters they share; cosine in double precision decides, and a pair
belongs to the smallest filter both have. The number of filters grows with the
number of vectors, so that unrelated vectors rarely meet however many there are.

Two vectors at cosine 0.98 share some twenty filters of about ``LIST`` each while
filters are cut into three blocks at most (some 4 million vectors). More blocks make finer filters, so
``LIST`` and ``LEAST`` double with each further one. Measured at 64 dimensions, 300 pairs at cosine
0.98 that share a filter: all at 10^4, 10^6 and 10^8 vectors, 0.99 at 10^10; the tests repeat it and compare with brute force.

Equal vectors are one class and stand for their copies, and no pair is
written: a task returns the number of links of each class and enough links to
connect its linked classes. Filters are dealt to tasks in groups of about
``GROUP`` vectors; the pairs of a filter with more than ``BLOCK`` vectors are
dealt block by block.

Defined cases: null labels, null, empty and zero vectors, and vectors with null
or non-finite components link with nothing; rows without an id link with
nothing, have no component and are kept; rows that repeat an id are one node:
its links are those of each of its distinct vectors, counted by rows. An empty table gives no rows. Extra columns are
carried by ``dedup`` and never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import components, small_batches, wrapped, written

COSINE = 0.98
#: Filters a random vector exceeds on average, and filters every vector has at least.
LIST = 32
LEAST = 24
#: Unrelated vectors that meet in a filter, on average.
MEETING = 8
#: Codewords a block has at most; more filters take more blocks. Blocks from which lists grow.
CODEWORDS = 256
FULL = 3
GROUP = 4096
BLOCK = 1024
SEED = 7


class ProductCode:
    """``count`` filters at least, for vectors of ``dim`` components."""

    def __init__(self, dim: int, count: int, mean_list: int = LIST, least: int = LEAST, seed: int = SEED):
        blocks = max(1, min(dim, math.ceil(math.log(max(count, 2)) / math.log(CODEWORDS))))
        width = max(2, math.ceil(count ** (1 / blocks)))
        rng = np.random.default_rng([seed, dim, width])
        finer = 2 ** max(0, blocks - FULL)
        mean_list, least = mean_list * finer, least * finer
        self.turn = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        self.cuts = [round(dim * k / blocks) for k in range(blocks + 1)]
        self.codes = []
        for a, b in zip(self.cuts, self.cuts[1:]):
            code = rng.standard_normal((width, b - a))
            self.codes.append(code / np.linalg.norm(code, axis=1, keepdims=True) / math.sqrt(blocks))
        self.width, self.size = width, width**blocks
        self.least = min(least, self.size)
        # A random unit vector's product with a direction is about normal with variance 1 / dim.
        self.bar = _normal_tail(min(0.5, mean_list / self.size)) / math.sqrt(dim)

    def decode(self, units: np.ndarray) -> list[np.ndarray]:
        """Sorted filter numbers of each unit vector."""
        turned = units @ self.turn
        scores = [turned[:, a:b] @ code.T for (a, b), code in zip(zip(self.cuts, self.cuts[1:]), self.codes)]
        best = [s.max(axis=1) for s in scores]
        out = []
        for i in range(len(units)):
            own, bar = [s[i] for s in scores], self.bar
            found, value = self._exceeding(own, [b[i] for b in best], bar)
            while found.size < self.least:  # lower the bar until enough exceed it, then take the best
                bar -= 0.05
                found, value = self._exceeding(own, [b[i] for b in best], bar)
                if found.size >= self.least:
                    found = found[np.argsort(-value, kind="stable")[:self.least]]
            out.append(np.sort(found))
        return out

    def _exceeding(self, own: list[np.ndarray], best: list[float], bar: float) -> tuple[np.ndarray, np.ndarray]:
        number, value = np.zeros(1, dtype=np.int64), np.zeros(1)
        for k, scores in enumerate(own):
            rest = sum(best[k + 1:])
            here = np.flatnonzero(scores >= bar - rest - value.max()) if value.size else np.zeros(0, np.int64)
            sums = value[:, None] + scores[here][None, :]
            row, col = np.nonzero(sums + rest >= bar)
            number, value = number[row] * self.width + here[col], sums[row, col]
        return number, value


def _normal_tail(p: float) -> float:
    """z with P(Z > z) = p for a standard normal Z, by bisection."""
    low, high = 0.0, 12.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if math.erfc(middle / math.sqrt(2)) / 2 > p else (low, middle)
    return low


def units_of(vectors) -> np.ndarray:
    out = np.asarray(vectors, dtype=np.float64)
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = flat.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(flat), -1)


def classes(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(label, dim, vector, cid, node, copies): the comparable vectors, equal ones once; ``node`` is the smallest id that has one.

    ``cid`` numbers the classes as they are written: vectors of one id are classes of their own.
    """
    v = F.col(vector_col)
    whole = F.aggregate(v, F.lit(True), lambda ok, x: ok & F.coalesce(
        ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != F.lit(float("inf"))), F.lit(False)))
    nonzero = F.exists(v, lambda x: F.coalesce(x != 0, F.lit(False)))
    fit = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.coalesce((F.size(v) > 0) & whole & nonzero, F.lit(False))
    rows = vectors.filter(fit).select(F.col(label_col).alias("label"), F.size(v).alias("dim"), v.alias("vector"),
                                      F.col(id_col).cast("bigint").alias("id"))
    found = rows.groupBy("label", "dim", "vector").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("copies"))
    return written(found.withColumn("cid", F.monotonically_increasing_id()), "classes")


def filtered(made: DataFrame, count: int) -> DataFrame:
    """(label, dim, cid, filters): the filters of each class out of about ``count``."""
    types = made.schema
    names = ["label", "dim", "cid"]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[int, ProductCode] = {}
        for batch in small_batches(batches, 256):
            dims = batch.column(1).to_numpy()
            filters: list = [None] * batch.num_rows
            for dim in np.unique(dims).tolist():
                code = codes.setdefault(dim, ProductCode(dim, count)) if dim not in codes else codes[dim]
                at = np.flatnonzero(dims == dim)
                own = matrix(batch.column(3).take(pa.array(at)))
                for i, found in zip(at.tolist(), code.decode(units_of(own))):
                    filters[i] = found
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(filters, pa.list_(pa.int64()))],
                                             names=[*names, "filters"])

    schema = types["label"].dataType.simpleString()
    return made.select(*names, "vector").mapInArrow(decode, f"label {schema}, dim int, cid bigint, filters array<bigint>")


def met(group: pa.Table, pairs: list[tuple[np.ndarray, np.ndarray, int]], cosine: float) -> pa.Table:
    """Links of one task: (cid, rep, links), rep the smallest class that its linked classes here reach.

    ``pairs``: rows on either side and the filter they meet in; equal sides mean all pairs among them.
    """
    cid, copies = group["cid"].to_numpy(), group["copies"].to_numpy()
    units = units_of(matrix(group["vector"]))
    filters = [np.asarray(x) for x in group["filters"].to_pylist()]
    links, rep = np.zeros(len(cid), dtype=np.int64), np.arange(len(cid))
    a_all, b_all = [], []
    for left, right, number in pairs:
        near = units[left] @ units[right].T >= cosine
        row, col = np.nonzero(near)
        a, b = left[row], right[col]
        if left is right:
            a, b = a[a < b], b[a < b]
        if not a.size:
            continue
        # The pair is this filter's if neither shares an earlier one.
        early = [set(filters[i][filters[i] < number].tolist()) for i in range(len(cid))] if a.size > len(cid) else None
        mine = np.array([(early[i].isdisjoint(early[j]) if early else
                          not np.intersect1d(filters[i][filters[i] < number], filters[j][filters[j] < number]).size)
                         for i, j in zip(a.tolist(), b.tolist())], dtype=bool)
        a, b = a[mine], b[mine]
        np.add.at(links, a, copies[b])
        np.add.at(links, b, copies[a])
        a_all.append(a)
        b_all.append(b)
    if a_all:
        a, b = np.concatenate(a_all), np.concatenate(b_all)
        while True:  # smallest row reached over the links of this task
            before = rep.copy()
            low = np.minimum(rep[a], rep[b])
            np.minimum.at(rep, a, low)
            np.minimum.at(rep, b, low)
            rep = rep[rep]
            if (rep == before).all():
                break
    out = np.flatnonzero(links)
    return pa.Table.from_arrays([pa.array(cid[out]), pa.array(cid[rep[out]]), pa.array(links[out])], names=["cid", "rep", "links"])


def linked(made: DataFrame, cosine: float) -> DataFrame:
    """(cid, rep, links) of every task; sums of links and components of (cid, rep) give the result."""
    total = made.count()
    found = written(filtered(made, max(64, total * LIST // MEETING)), "filters")
    posted = found.select("label", "dim", "cid", F.explode("filters").alias("filter"))
    key = ["label", "dim"]
    sizes = posted.groupBy(*key, "filter").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    posted = written(posted.join(sizes, [*key, "filter"]), "meetings")
    full = made.select("cid", *key, "vector", "copies").join(found, [*key, "cid"])
    schema = "cid bigint, rep bigint, links bigint"

    def in_group(group: pa.Table) -> pa.Table:
        own = group["own"].combine_chunks()
        who = np.repeat(np.arange(len(own)), np.diff(own.offsets.to_numpy()))
        number = own.flatten().to_numpy()
        order = np.argsort(number, kind="stable")
        names, starts = np.unique(number[order], return_index=True)
        pairs = [(rows, rows, int(f)) for f, rows in zip(names, np.split(who[order], starts[1:])) if rows.size > 1]
        return met(group, pairs, cosine)

    # Shared filters by hash: about GROUP meetings a task, each vector once with all its filters there.
    meetings = posted.filter(F.col("m") <= BLOCK)
    per = meetings.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / GROUP).alias("parts"))
    small = (meetings.join(per, key).groupBy(*key, F.pmod(F.xxhash64("filter"), F.col("parts")).alias("part"), "cid")
             .agg(F.collect_list("filter").alias("own")).join(full, [*key, "cid"])
             .groupBy(*key, "part").applyInArrow(in_group, schema))

    def in_blocks(group: pa.Table) -> pa.Table:
        i, j, number = (group[c][0].as_py() for c in ("i", "j", "filter"))
        block = group["block"].to_numpy()
        left = np.flatnonzero(block == i)
        return met(group, [(left, left if i == j else np.flatnonzero(block == j), number)], cosine)

    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    large = (posted.filter(F.col("m") > BLOCK).withColumn("blocks", blocks)
             .withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select(*key, "filter", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "cid")
             .join(full, [*key, "cid"]).groupBy(*key, "filter", "i", "j").applyInArrow(in_blocks, schema))
    return small.unionByName(large)


def groups(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
           cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per input row."""
    made = classes(vectors, id_col, vector_col, label_col)
    met_in = written(linked(made, cosine), "met")
    zero = F.lit(0).cast("bigint")
    links = made.join(met_in.groupBy("cid").agg(F.sum("links").alias("more")), "cid", "left").select(
        "cid", (F.col("copies") - 1 + F.coalesce("more", zero)).alias("links"))
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).alias("label"),
                          F.col(vector_col).alias("vector"))
    full = F.col("label").isNotNull() & F.col("vector").isNotNull()
    bare = rows.filter(F.col("vec_id").isNotNull() & ~full).select("vec_id", F.lit(None).cast("bigint").alias("cid"), F.lit(None).cast("bigint").alias("node"))
    # Every row with its class (null if its vector cannot be compared); vectors move here for the last time.
    placed = written(rows.filter(F.col("vec_id").isNotNull() & full).join(made.select("label", "vector", "cid", "node"), ["label", "vector"], "left")
                     .select("vec_id", "cid", "node").unionByName(bare), "placed")
    # Ids with several vectors connect their classes, and their links add up.
    own_class = F.coalesce("cid", F.lit(-1).cast("bigint"))
    several = placed.groupBy("vec_id").agg(F.min(own_class).alias("lo"), F.max(own_class).alias("hi")).filter("lo < hi").select("vec_id")
    held = written(placed.filter("cid IS NOT NULL").join(several, "vec_id", "left_semi").distinct(), "several")
    nodes = made.select("cid", "node")
    pairs = (met_in.join(nodes, "cid").withColumnRenamed("node", "a")
             .join(nodes.select(F.col("cid").alias("rep"), F.col("node").alias("b")), "rep").select("a", "b"))
    found = components(pairs.unionByName(held.select(F.col("vec_id").alias("a"), F.col("node").alias("b"))))
    sums = held.join(links, "cid").groupBy("vec_id").agg(F.sum("links").alias("own"))
    out = (placed.join(links, "cid", "left").join(sums, "vec_id", "left")
           .join(found.withColumnRenamed("node", "at"), F.coalesce("node", "vec_id") == F.col("at"), "left")
           .select("vec_id", F.coalesce("own", "links", zero).alias("n_links"), F.coalesce("component", "node", "vec_id").alias("component_id")))
    nameless = rows.filter("vec_id IS NULL").selectExpr("vec_id", "0L AS n_links", "vec_id AS component_id")
    return (out.unionByName(nameless)
            .select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")))


def dedup(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
          cosine: float = COSINE) -> DataFrame:
    """The input rows whose vector stays, one of each group, with all their columns; rows without an id stay."""
    stay = (groups(vectors, id_col, vector_col, label_col, cosine).filter("kept AND vec_id IS NOT NULL")
            .select(F.col("vec_id").alias("id")).distinct())
    rows = wrapped(vectors, id=F.col(id_col).cast("bigint"))
    kept = rows.join(stay, "id", "left_semi").dropDuplicates(["id"])
    return kept.select("row.*").unionByName(rows.filter("id IS NULL").select("row.*"))

"""Source divergence audit by one-hot level products.

How far is each source's word distribution from every other source of its
language, and which terms make it differ from the language as a whole? Both are sums of a price
f(p, q) = floor((p - q)^2 / q) over terms, where p depends only on the source
and the term's count there (its level). So a pair of sources is priced from the table
"how many terms have level a here and level b there":

1. Tasks count terms by source and documents by language, combined in the
   task first, and send each term once with its sources; terms in at least ``LEAST_DOCS`` documents of the language are kept.
2. Indicator columns: one for each (source, count > 0) that a block of ``BLOCK``
   terms holds, one row per term. The product of the transpose with the matrix has, for two
   columns, the number of terms that are 1 in both: all joint tables of the block at
   once. It is taken in column blocks of ``COLUMNS``; counts stay far
   below 2^24, so single precision is exact. Terms are ordered by their count before they are
   cut into blocks, so that a block has few levels.
3. Block tables add up to the joint tables (``joint_tables``). The diagonal holds the level totals, and
   with those and the number of kept terms the rows and columns of level 0 follow: they
   are never stored.
4. Each cell is priced once, in both directions, in integers.

Sums are decimals of 38 digits and quotients are integer divisions, so nothing is rounded.

Defined cases: null text, language and source count as empty strings; sources
without a term are there with count 0 everywhere; a language without kept terms
prices every pair 0; a language with one source has no pairs; rows that repeat are counted as often as they are
there. An empty table gives no rows. Extra columns are never read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martforge.llm.common import release, small_batches, texts, written

#: Documents of its language that a kept term is in, at least.
LEAST_DOCS = 3
#: Probabilities are whole numbers of this part.
UNIT = 1_000_000_000
#: Ranks of the term part.
RANKS = 200
#: Terms of one block, and columns of one block of its product.
BLOCK = 256
COLUMNS = 1024
#: Terms a task holds before it passes their counts on, and joint cells.
HELD_TERMS = 1_000_000
HELD_CELLS = 1 << 20
#: Rows of one Arrow batch of terms.
ROWS = 1 << 16
#: Runs of letters: any byte beyond ASCII, and a-z once A-Z are lower-cased.
TERM = re.compile(rb"[a-z\x80-\xff]+")


def tally(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """(lang, term, docs, total, held): documents and occurrences in the language, and (source, n) of each source that has the term.

    One row with a null term for each language holds all its sources. A task sends a term once with its sources, and
    sums over tasks are taken source by source before they are put into a row.
    """
    names = ["lang", "term", "docs", "held"]
    entry = pa.struct([("source", pa.string()), ("n", pa.int64())])

    def rows_of(held: dict[str, dict[str, Counter]], in_docs: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, sources in held.items():
            number = {term: i for i, term in enumerate(in_docs[lang])}
            at = np.concatenate([np.fromiter(map(number.__getitem__, n), np.int64, len(n)) for n in sources.values()])
            count = np.concatenate([np.fromiter(n.values(), np.int64, len(n)) for n in sources.values()])
            source = np.repeat(np.arange(len(sources)), [len(n) for n in sources.values()])
            order = np.argsort(at, kind="stable")
            known = pa.array(list(sources), pa.string())
            for start in range(0, len(number), ROWS):
                end = min(start + ROWS, len(number))
                here = order[np.searchsorted(at[order], start):np.searchsorted(at[order], end)] if len(number) > ROWS else order
                ends = np.concatenate(([0], np.cumsum(np.bincount(at[here] - start, minlength=end - start))))
                entries = pa.StructArray.from_arrays([known.take(pa.array(source[here])), pa.array(count[here])], fields=list(entry))
                terms = pa.array(islice(number, start, end), pa.binary()).cast(pa.string())
                docs_of = pa.array(islice(in_docs[lang].values(), start, end), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([lang] * (end - start), pa.string()), terms, docs_of,
                                                  pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entries)], names=names)
            every = [{"source": x, "n": 0} for x in sources]
            yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([None], pa.string()), pa.array([0], pa.int64()),
                                              pa.array([every], pa.list_(entry))], names=names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        held: dict[str, dict[str, Counter]] = {}
        in_docs: dict[str, Counter] = {}
        for batch in small_batches(batches, 512):
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts(batch.column(2))):
                terms = TERM.findall(text.lower())  # bytes.lower() changes A-Z alone
                held.setdefault(lang, {}).setdefault(source, Counter()).update(terms)
                in_docs.setdefault(lang, Counter()).update(set(terms))
            if sum(len(n) for sources in held.values() for n in sources.values()) > HELD_TERMS:
                yield from rows_of(held, in_docs)
                held, in_docs = {}, {}
        yield from rows_of(held, in_docs)

    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(empty(lang_col).alias("lang"), empty(source_col).alias("source"), empty(text_col).alias("text"))
    counted = rows.mapInArrow(count, "lang string, term string, docs bigint, held array<struct<source:string,n:bigint>>")
    # One exchange: all that follows groups by language and term first. The documents of a task's term stand at its first source.
    each = counted.repartition("lang", "term").select("lang", "term", "docs", F.posexplode("held").alias("i", "h")).select(
        "lang", "term", F.when(F.col("i") == 0, F.col("docs")).otherwise(F.lit(0).cast("bigint")).alias("docs"), "h.source", "h.n")
    by_source = each.groupBy("lang", "term", "source").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))
    return by_source.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"),
                                                 F.sort_array(F.collect_list(F.struct("source", "n"))).alias("held"))


def kept_terms(counts: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, term, total, held): the terms in at least ``least_docs`` documents of their language."""
    return counts.filter(F.col("term").isNotNull() & (F.col("docs") >= least_docs)).drop("docs")


def joint_tables(kept: DataFrame, block: int = BLOCK, columns: int = COLUMNS) -> DataFrame:
    """(lang, source, n, other, m, terms): kept terms with n > 0 in source and m > 0 in other, source <= other.

    Rows with source = other are the diagonal: n = m, the terms of that level.
    """
    names = ["lang", "source", "n", "other", "m", "terms"]

    def flushed(cells: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        code, at = np.unique(np.concatenate([c for c, _ in cells]), return_inverse=True)
        return code, np.bincount(at, weights=np.concatenate([k for _, k in cells])).astype(np.int64)

    def as_rows(lang: str, known: list, cells: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        if not cells:
            return
        code, count = flushed(cells)
        sources = pa.array([s for s, _ in known], pa.string())
        levels = np.array([n for _, n in known], dtype=np.int64)
        for at in range(0, code.size, 1 << 16):
            a, b = np.divmod(code[at:at + (1 << 16)], 1 << 32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * a.size, pa.string()), sources.take(pa.array(a)), pa.array(levels[a]),
                 sources.take(pa.array(b)), pa.array(levels[b]), pa.array(count[at:at + (1 << 16)])], names=names)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang: str | None = None
        number: dict[tuple[str, int], int] = {}
        known: list[tuple[str, int]] = []
        cells: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in small_batches(batches, block):
            langs = batch.column(0).to_pylist()
            held = batch.column(1).to_pylist()
            for name in dict.fromkeys(langs):
                if name != lang:
                    yield from as_rows(lang, known, cells)
                    lang, number, known, cells = name, {}, [], []
                elif sum(c.size for c, _ in cells) > HELD_CELLS:
                    cells = [flushed(cells)]
                    if cells[0][0].size > HELD_CELLS // 2:
                        yield from as_rows(lang, known, cells)
                        number, known, cells = {}, [], []
                rows, cols = [], []
                for i, entries in enumerate(e for x, e in zip(langs, held) if x == name):
                    for e in entries:
                        own = (e["source"], e["n"])
                        if own not in number:
                            number[own] = len(known)
                            known.append(own)
                        rows.append(i)
                        cols.append(number[own])
                cells += products(np.array(rows), np.array(cols), known, columns)
        yield from as_rows(lang, known, cells)

    ordered = kept.sortWithinPartitions("lang", "total").select("lang", "held")
    made = ordered.mapInArrow(multiply, "lang string, source string, n bigint, other string, m bigint, terms bigint")
    return made.groupBy("lang", "source", "n", "other", "m").agg(F.sum("terms").alias("terms"))


def products(rows: np.ndarray, cols: np.ndarray, known: list[tuple[str, int]], columns: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Non-zero cells (first column * 2^32 + second column, terms) of X'X for the indicator matrix X with ones at (rows, cols).

    Columns are ordered by source, then level; of each pair of columns only the first order is returned.
    """
    own = np.array(sorted(set(cols.tolist()), key=known.__getitem__), dtype=np.int64)
    place = np.empty(int(own.max()) + 1, dtype=np.int64)
    place[own] = np.arange(own.size)
    ones = np.zeros((int(rows.max()) + 1, own.size), dtype=np.float32)
    ones[rows, place[cols]] = 1
    out = []
    for i in range(0, own.size, columns):
        left = ones[:, i:i + columns]
        for j in range(i, own.size, columns):
            table = left.T @ ones[:, j:j + columns]
            if i == j:
                table = np.triu(table)
            a, b = np.nonzero(table)
            out.append((own[a + i] * (1 << 32) + own[b + j], table[a, b]))
    return out


def whole(c: Column) -> Column:
    return c.cast("decimal(38,0)")


def probability(n: str, size: str) -> Column:
    """1 + floor(UNIT * (n + 1) / size), ``size`` the count of the group plus the number of kept terms."""
    return F.expr(f"1L + (cast({n} + 1 AS decimal(25,0)) * {UNIT}BD) div cast({size} AS decimal(25,0))")


def price(p: str, q: str) -> Column:
    """floor((p - q)^2 / q); p and q are at most UNIT + 1, so the square fits a long."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          least_docs: int = LEAST_DOCS, ranks: int = RANKS) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` prices every other source, part ``term`` the terms a source has more of."""
    counts = written(tally(docs, text_col, lang_col, source_col), "tally")
    kept = written(kept_terms(counts, least_docs), "kept")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("all_n"))
    own = kept.select("lang", F.explode("held").alias("h")).groupBy("lang", F.col("h.source").alias("source")).agg(F.sum("h.n").alias("n"))
    zero = F.lit(0).cast("bigint")
    # One row per source and language: what every price needs besides the counts.
    sources = counts.filter("term IS NULL").select("lang", F.explode("held.source").alias("source"))
    groups = written(sources.join(own, ["lang", "source"], "left").join(langs, "lang", "left")
                     .select("lang", "source", F.coalesce("v", zero).alias("v"), (F.coalesce("n", zero) + F.coalesce("v", zero)).alias("size"),
                             (F.coalesce("all_n", zero) + F.coalesce("v", zero)).alias("all_size")), "groups")
    out = ["lang", "source", "part", "item", "value", "rank"]
    return pair_part(kept, groups).select(*out).unionByName(term_part(kept, groups, ranks).select(*out))


def by_value() -> list[Column]:
    return [F.col("value").desc(), F.col("item").asc()]


def term_part(kept: DataFrame, groups: DataFrame, ranks: int) -> DataFrame:
    at = kept.select("lang", F.col("term").alias("item"), "total", F.explode("held").alias("h")).select("lang", "item", "total", "h.*")
    priced = (at.join(groups, ["lang", "source"]).withColumn("p", probability("n", "size")).withColumn("q", probability("total", "all_size"))
              .filter("p > q").withColumn("value", price("p", "q")))
    # Each task keeps its own first ``ranks`` of a group before the exchange (Spark's window group limit).
    first = priced.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*by_value()))).filter(F.col("rank") <= ranks)
    return first.withColumn("part", F.lit("term"))


def pair_part(kept: DataFrame, groups: DataFrame) -> DataFrame:
    joint = written(joint_tables(kept), "joint")
    one = groups.select("lang", "source", "v", "size")
    two = groups.select("lang", F.col("source").alias("other"), F.col("size").alias("other_size"))
    cells = joint.filter("source <> other").join(one, ["lang", "source"]).join(two, ["lang", "other"])
    cells = (cells.withColumn("p", probability("n", "size")).withColumn("q", probability("m", "other_size"))
             .withColumn("p0", probability("0L", "size")).withColumn("q0", probability("0L", "other_size")))

    def cell(p: str, q: str, p0: str, q0: str) -> Column:
        # What the cell adds beyond the margins, which price all its terms as if one side had none.
        return F.col("terms") * (whole(price(p, q)) - whole(price(p, q0)) - whole(price(p0, q)) + whole(price(p0, q0)))

    both = F.explode(F.array(F.struct("source", F.col("other").alias("item"), cell("p", "q", "p0", "q0").alias("value")),
                             F.struct(F.col("other").alias("source"), F.col("source").alias("item"), cell("q", "p", "q0", "p0").alias("value"))))
    inner = cells.select("lang", both.alias("x")).select("lang", "x.*")
    # Margins: every level of a source against level 0 of every other source of the language, as first and as second.
    levels = joint.filter("source = other").select("lang", "source", "n", "terms")
    # A language without kept terms has no probabilities and prices 0.
    pairs = one.join(two, "lang").filter("source <> other")
    none = pairs.filter("v = 0").select("lang", "source", F.col("other").alias("item"), whole(F.lit(0)).alias("value"))
    pairs = pairs.filter("v > 0").withColumn("q0", probability("0L", "other_size"))
    base = pairs.withColumn("p0", probability("0L", "size")).select(
        "lang", "source", F.col("other").alias("item"), (F.col("v") * whole(price("p0", "q0"))).alias("value"))
    beside = (levels.join(pairs, ["lang", "source"]).withColumn("p", probability("n", "size")).withColumn("p0", probability("0L", "size")))

    def margin(p: Column, rest: Column) -> Column:
        return F.col("terms") * (whole(p) - whole(rest))

    outer = beside.select("lang", F.explode(F.array(
        F.struct("source", F.col("other").alias("item"), margin(price("p", "q0"), price("p0", "q0")).alias("value")),
        F.struct(F.col("other").alias("source"), F.col("source").alias("item"), margin(price("q0", "p"), price("q0", "p0")).alias("value"))
    )).alias("x")).select("lang", "x.*")
    total = (inner.unionByName(outer).unionByName(base).unionByName(none).groupBy("lang", "source", "item")
             .agg(F.sum("value").cast("bigint").alias("value")))
    return total.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*by_value()))).withColumn("part", F.lit("pair"))

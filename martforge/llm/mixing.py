"""Mixing sources to target weights by systematic sampling, with DataFrame functions only.

Sources, ordered by code point with null last, weigh 5, 2, 1, repeating, and
share the words of all documents; a target stops at ``cap`` times its source's
words and the excess is reshared by weight. Every document of a source is
expected ``target / source size`` times. Along the documents of a source,
ordered by size, the prefix sum of these expectations plus one random offset
(from the seed and the source) emits a document once per integer it crosses.
Ordering by size keeps the words taken within about one document of the target.

Defined cases: a null text has size 0; sources without words get target 0 and
are not taken; ties in size go by id, and repeated rows are separate documents.
An empty table gives an empty mix. Extra columns are carried by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martforge.llm.common import WORD_PATTERN, ranked, wrapped, written

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = 20240917
#: Words counted natively: one character is left of each word.
_BIG = "decimal(38,0)"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(no_source, source_key, source_size, target) from rows of (no_source, source_key, size).

    All windows here run over one row per source. In the order of cap / weight
    the sources that stop at their cap come first, so the sums before each
    source decide whether it stops, without iterating.
    """
    per = sizes.groupBy("no_source", "source_key").agg(F.sum("size").alias("source_size"))
    every = 1
    for w in weights:
        every *= w
    by_name, by_cap = Window.orderBy("no_source", "source_key"), Window.orderBy("ratio", "no_source", "source_key")
    before, whole = by_cap.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("nth") - 1, F.lit(len(weights))) + 1).cast("int"))
    table = (per.withColumn("nth", F.row_number().over(by_name)).withColumn("w", weight.cast(_BIG))
             .withColumn("cap", F.col("source_size").cast(_BIG) * cap)
             .withColumn("ratio", (F.col("cap") * (F.lit(every) / F.col("w")).cast("bigint")).cast(_BIG))
             .withColumn("total", F.sum(F.col("source_size").cast(_BIG)).over(whole).cast(_BIG))
             .withColumn("all_w", F.sum("w").over(whole).cast(_BIG))
             .withColumn("c0", F.coalesce(F.sum("cap").over(before), F.lit(0)).cast(_BIG))
             .withColumn("w0", F.coalesce(F.sum("w").over(before), F.lit(0)).cast(_BIG))
             .withColumn("full", (F.col("w") * (F.col("total") - F.col("c0"))).cast(_BIG)
                         > (F.col("cap") * (F.col("all_w") - F.col("w0"))).cast(_BIG))
             .withColumn("c", F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(whole), F.lit(0)))
             .withColumn("rest", F.sum(F.when(~F.col("full"), F.col("w"))).over(whole)))
    shared = ((F.col("w") * (F.col("total") - F.col("c"))).cast("double") / F.col("rest").cast("double"))
    return table.select("no_source", "source_key", "source_size",
                        F.when(F.col("full"), F.col("cap").cast("double")).otherwise(shared).alias("target"))


def allocations(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: int = SEED, carry: bool = False) -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken) per document, and its whole ``row`` if ``carry``."""
    source = F.col(source_col).cast("string")
    rows = wrapped(docs, doc_id=F.col(id_col), size=n_words(F.col(text_col)), no_source=source.isNull(),
                   source_key=F.coalesce(source, F.lit("")))
    sized = written(rows.drop("row"), "sized")
    share = written(targets(sized, weights, cap), "targets")  # one row per source
    key = ["no_source", "source_key"]
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.col("no_source").cast("string"), F.lit("|"),
                                               F.col("source_key"))), 1, 4), 16, 10).cast("double") / 65536.0
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    k = F.col("nth").cast("double")
    crossed = F.floor(k * F.col("rate") + F.col("u")) - F.floor((k - 1) * F.col("rate") + F.col("u"))
    rows = (ranked(rows if carry else sized, key, [F.col("size"), F.col("doc_id")], "nth").join(share, key)
            .withColumn("rate", rate).withColumn("u", offset)
            # Rounding of a large prefix sum may not add a copy beyond the rate.
            .withColumn("copies", F.least(crossed, F.ceil("rate")).cast("bigint")))
    return rows.select(*(["row"] if carry else []), "doc_id", "size", "source_size", "target", "copies",
                       (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: each input row as often as it is taken, with its own columns."""
    rows = allocations(docs, carry=True, **options).filter("copies > 0")
    return rows.select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))).select("row.*")

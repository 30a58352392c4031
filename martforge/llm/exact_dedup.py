"""Exact de-duplication by skew-safe combining.

Texts are equal when they are identical after white space is deleted. Equal
rows are combined three times: inside each task (the map side of the first
aggregation), by digest and salt (the salt is the task, so one task sends one
row per distinct text and a group with a third of all rows spreads over
``salts`` reducers), then by digest over at most ``salts`` rows each. Every
stage groups by digest *and* content, so a digest collision never merges texts.

Defined cases: a null text is empty, and all empty texts are one group; of
equal texts the row with the most code points, then the smallest id stays (a
null id ranks last); rows repeated with the same id and text are one document:
``members`` returns each of them with the same answer, ``dedup`` keeps one.
Extra columns are carried by ``dedup`` and never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martforge.llm.common import WHITE, spread_join, wrapped, written

SALTS = 32


def normalised(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    for ch in WHITE:
        out = F.replace(out, F.lit(ch), F.lit(""))
    return out


def sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS,
           digest=sha256) -> DataFrame:
    """One row per distinct content: digest, keep_id, group_size and, only where texts collide, the content."""
    content = normalised(F.col(text_col))
    rows = docs.select(
        content.alias("content"), digest(content).alias("digest"),
        F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"),
        # Greatest: most code points, then the smallest id (bitwise not reverses the order of integers).
        F.struct(F.length(F.coalesce(F.col(text_col), F.lit(""))).alias("chars"),
                 F.bitwise_not(F.col(id_col).cast("bigint")).alias("not_id")).alias("best"))
    salted = (rows.groupBy("digest", "salt", "content")
              .agg(F.max("best").alias("best"), F.count(F.lit(1)).alias("n")))
    # By digest alone, so that the count of contents below needs no further shuffle.
    whole = (salted.drop("salt").repartition("digest").groupBy("digest", "content")
             .agg(F.max("best").alias("best"), F.sum("n").alias("group_size")))
    contents = F.count(F.lit(1)).over(Window.partitionBy("digest"))
    return whole.select("digest", F.bitwise_not("best.not_id").alias("keep_id"), "group_size",
                        F.when(contents > 1, F.col("content")).alias("content"))


def members(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS,
            digest=sha256) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, digest), one row per input row."""
    made = written(groups(docs, id_col, text_col, salts, digest), "groups")
    content = normalised(F.col(text_col))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), digest(content).alias("digest"),
                       content.alias("own"))
    alone, collided = made.filter("content IS NULL").drop("content"), made.filter("content IS NOT NULL")
    # A group may hold a third of all rows: those of large groups meet their answer in many tasks.
    out = spread_join(rows.drop("own"), alone, "digest", "group_size")
    if not collided.isEmpty():  # texts that share a digest: their rows are joined by content
        same = collided.withColumnRenamed("content", "own")
        out = out.unionByName(rows.join(same, ["digest", "own"]).drop("own"))
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                      "digest")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """The input rows that stay, one per group of equal texts, with all their columns."""
    ident = F.col(id_col).cast("bigint")
    key = ["id", "no_id", "digest"]
    stay = (members(docs, id_col, text_col, salts).filter("kept")
            .select(F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("no_id"), "digest"))
    rows = wrapped(docs, id=F.coalesce(ident, F.lit(0)), no_id=ident.isNull(),
                   digest=sha256(normalised(F.col(text_col))))
    # The join leaves equal rows together, so dropping repeats moves nothing.
    return rows.join(stay, key, "left_semi").dropDuplicates(key).select("row.*")

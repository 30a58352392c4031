"""Joins of one-sided unique keys whose frequent keys spread over tasks."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from martforge.llm.common import spread_join, written


@pytest.mark.parametrize("hot", [1, 8, 4096])
def test_spread_join_equals_a_join(spark, hot):
    many = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(-7)).otherwise(F.col("id") % 50).alias("k"), "id")
    one = written(many.groupBy("k").agg(F.count(F.lit(1)).alias("times"), F.max("id").alias("most")).filter("k <> 11"), "one")
    got = spread_join(many, one, "k", "times", hot=hot, spread=8)
    want = many.join(one, "k")
    assert got.columns == want.columns and Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


def test_rows_of_a_hot_key_spread(spark):
    many = spark.range(3000).repartition(8).select(F.when(F.col("id") % 3 == 0, F.lit(-7)).otherwise(F.col("id")).alias("k"), "id")
    one = written(many.groupBy("k").agg(F.count(F.lit(1)).alias("times")), "one")
    aqe, threshold, parts = (spark.conf.get(c) for c in SETTINGS)
    try:
        for c, v in zip(SETTINGS, ("false", "-1", "16")):
            spark.conf.set(c, v)
        per_task = [r["count"] for r in spread_join(many, one, "k", "times").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for c, v in zip(SETTINGS, (aqe, threshold, parts)):
            spark.conf.set(c, v)
    assert sum(per_task) == 3000 and max(per_task) < 600


def test_spread_join_of_empty_tables(spark):
    many = spark.range(0).select(F.col("id").alias("k"))
    one = written(many.withColumn("times", F.lit(1)), "one")
    assert spread_join(many, one, "k", "times").count() == 0


SETTINGS = ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")

"""Extra columns whose names hold dots and backticks: every operator that carries whole rows returns them."""

import pytest
from pyspark.sql import functions as F

from helpers import vocabulary
from martforge.llm import (
    centroids,
    divergence,
    embedding_dedup,
    exact_dedup,
    language_id,
    line_dedup,
    minhash,
    mixing,
    suffix_dedup,
    toxicity,
)

ODD = ["a.b", "c`d", "e f", "row.x"]


@pytest.fixture(scope="module")
def frame(spark):
    words = vocabulary(60, 3)
    rows = [(i, " ".join(words[(i * 7 + k) % 60] for k in range(30)), "x" if i % 2 else "y", f"s{i % 3}", *ODD) for i in range(60)]
    plain = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, o0 string, o1 string, o2 string, o3 string")
    return plain.toDF("doc_id", "text", "lang", "source", *ODD)


def carried(df, rows):
    first = df.first()
    return df.count() == rows and [first[c] for c in ODD] == ODD


def test_language_and_toxicity(spark, frame):
    found = language_id.detect(frame, language_id.train(frame))
    assert carried(found.select("row.*"), 60)
    labels = frame.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    assert carried(toxicity.score(frame, toxicity.train(frame, labels)).select("row.*"), 60)


def test_dedups(frame):
    assert carried(exact_dedup.dedup(frame), exact_dedup.dedup(frame).count())
    assert carried(minhash.dedup(frame), minhash.dedup(frame).count())
    assert carried(line_dedup.clean(frame).select("row.*"), 60)
    assert carried(suffix_dedup.clean(frame).select("row.*"), 60)


def test_mixing(frame):
    assert carried(mixing.mix(frame), mixing.mix(frame).count())


def test_audit_and_vectors(spark, frame):
    assert divergence.audit(frame).count() > 0
    vectors = frame.select("doc_id", F.array_repeat(F.lit(1.0), 64).alias("embedding"), F.lit(1).alias("label"), *[F.col(f"`{c.replace('`', '``')}`") for c in ODD])
    named = vectors.withColumnRenamed("doc_id", "vec_id")
    assert carried(embedding_dedup.dedup(named), 1)
    assert centroids.report(named).count() == 60

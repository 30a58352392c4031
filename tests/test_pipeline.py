"""The materialised medallion job gives the same gold tables as the lazily composed queries."""

import json
import os
import subprocess
import sys

import pytest

from martforge.plans import pipeline
from martforge.plans import queries as Q
from martforge.session import scratch_path
from martforge.sources import testdata as td
from martforge.sources.layers import Lake
from martforge.streaming.ingest import ingest_available


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_pipeline_matches_registered_queries(spark, sf):
    lake = Lake(scratch_path(spark, "lake"))
    readers = {"stores": lambda: td.stores(spark, sf), "products": lambda: td.products(spark, sf),
               "sales": lambda: td.sales(spark, sf)}
    cfg = pipeline.PipelineConfig(fact_cluster_by=("period_id", "geography_id"))
    paths = pipeline.run(spark, readers, lake, cfg)
    fct = spark.read.parquet(paths["fct_sales"])
    q = Q.REGISTRY["fct_sales"](spark, sf)
    assert _rows(fct.select(*q.columns)) == _rows(q)
    assert _rows(spark.table("gold.dim_geography")) == _rows(Q.REGISTRY["dim_geography"](spark, sf))


def test_a_failed_run_goes_on_from_its_last_written_layer(spark, sf, monkeypatch):
    lake = Lake(scratch_path(spark, "lake"))
    reads = []

    def reader(name):
        return lambda: reads.append(name) or getattr(td, name)(spark, sf)

    readers = {name: reader(name) for name in ("stores", "products", "sales")}
    whole = pipeline.run_gold
    monkeypatch.setattr(pipeline, "run_gold", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        pipeline.run(spark, readers, lake, pipeline.PipelineConfig())
    monkeypatch.setattr(pipeline, "run_gold", whole)
    paths = pipeline.run(spark, readers, lake, pipeline.PipelineConfig())
    assert sorted(reads) == ["products", "sales", "stores"] and spark.read.parquet(paths["fct_sales"]).count() > 0
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        pipeline.run(spark, readers, lake, pipeline.PipelineConfig(resume=False))


def test_pipeline_quarantine_complements_silver(spark, sf):
    lake = Lake(scratch_path(spark, "lake"))
    readers = {"stores": lambda: td.raw_stores(spark, sf), "products": lambda: td.raw_products(spark, sf),
               "sales": lambda: td.raw_sales(spark, sf)}
    pipeline.run_bronze(spark, readers, lake, "errorifexists")
    pipeline.run_silver(spark, lake)
    bronze = lake.read(spark, "bronze", "sales_fact")
    rejected = lake.read(spark, "quarantine", "sales_invalid_id")
    kept = Q.REGISTRY["conform_sales"](spark, sf)
    assert rejected.count() == Q.REGISTRY["quarantine_sales"](spark, sf).count()
    assert rejected.count() + lake.read(spark, "silver", "sales").count() <= bronze.count()
    assert lake.read(spark, "silver", "sales").count() == kept.count()
    silver = lake.read(spark, "silver", "stores").drop("ingestion_date")  # bronze stamp is carried through
    assert _rows(silver) == _rows(Q.REGISTRY["conform_stores"](spark, sf))


def test_streaming_ingest_is_incremental_and_exactly_once(spark, sf):
    src = scratch_path(spark, "landing")
    target, ckpt = scratch_path(spark, "bronze"), scratch_path(spark, "ckpt")
    region = td.table(spark, sf, "region")
    region.write.parquet(f"{src}/batch=1")
    ingest_available(spark, src, region.schema, target, ckpt)
    ingest_available(spark, src, region.schema, target, ckpt)          # nothing new: no duplicates
    assert spark.read.parquet(target).count() == 5
    region.write.parquet(f"{src}/batch=2")
    ingest_available(spark, src, region.schema, target, ckpt)
    out = spark.read.parquet(target)
    assert out.count() == 10 and out.filter("ingestion_date is null").count() == 0


def test_bench_prints_one_json_line():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_DRIVER_MEM="2g",
               BENCH_QUERIES="dim_date,total_stores")
    out = subprocess.run([sys.executable, os.path.join(root, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600, check=True).stdout.strip().splitlines()
    assert len(out) == 1
    doc = json.loads(out[0])
    assert doc["unit"] == "sec" and set(doc["queries"]) >= {"dim_date", "total_stores"}

"""Sinks and sources: error-if-exists, snapshot isolation, layer round trips, catalog, entry smoke."""

import pytest
from pyspark.errors import AnalysisException

from martforge.session import scratch_path
from martforge.sources import layers, snapshot
from martforge.sources import testdata as td


def test_write_once_refuses_second_write(spark, sf):
    p = scratch_path(spark, "t", "region")
    df = td.table(spark, sf, "region")
    assert layers.write_once(df, p) == "written"
    assert layers.write_once(df, p) == "PATH_ALREADY_EXISTS"
    assert spark.read.parquet(p).count() == df.count()


def test_snapshot_isolates_failures_or_raises(spark, sf):
    reader = lambda own, t: td.table(own, sf, t)
    st = snapshot.snapshot(spark, reader, ["region", "nope"], scratch_path(spark, "s"), on_error="continue")
    got = {r.table_name: (r.status, r.row_count, r.error) for r in st.collect()}
    assert got["region"] == ("ok", 5, None) and got["nope"][0] == "failed"
    with pytest.raises(AnalysisException):
        snapshot.snapshot(spark, reader, ["nope"], scratch_path(spark, "s"), on_error="raise")


def test_insert_overflow_fails(spark):
    layers.ensure_schema(spark, "gold")
    big = spark.createDataFrame([(1, 3_000_000_000)], "geography_id int, store_id bigint")
    with pytest.raises(Exception):
        layers.insert_select(spark, "gold.t_overflow", "geography_id int, store_id int",
                             scratch_path(spark, "o"), big)


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["geography_id", "hierarchy_id", "period_id"] and len(df.columns) == 15


def test_write_once_raises_other_errors(spark):
    twice = spark.range(3).selectExpr("id AS a", "id AS a")
    with pytest.raises(AnalysisException):
        layers.write_once(twice, scratch_path(spark, "t", "dup"))


def test_overwrite_and_replace_keep_the_old_table_when_a_job_fails(spark):
    good, bad = spark.range(5), spark.range(5).selectExpr("id + raise_error('no') AS id")
    lake = layers.Lake(scratch_path(spark, "lake"))
    lake.write(good, "silver", "t")
    with pytest.raises(Exception, match="no"):
        lake.write(bad, "silver", "t")
    assert lake.read(spark, "silver", "t").count() == 5
    lake.write(spark.range(7), "silver", "t")
    assert lake.read(spark, "silver", "t").count() == 7
    layers.ensure_schema(spark, "gold")
    where = scratch_path(spark, "versions")
    layers.replace_table(good, "gold.versions", where)
    with pytest.raises(Exception, match="no"):
        layers.replace_table(bad, "gold.versions", where)
    assert spark.table("gold.versions").count() == 5
    assert layers.replace_table(spark.range(9), "gold.versions", where).count() == 9
    spark.sql("DROP TABLE gold.versions")


def test_snapshot_codec_and_timestamp_encoding(spark):
    import glob

    import pyarrow.parquet as pq

    target = scratch_path(spark, "s")
    before = spark.conf.get("spark.sql.parquet.outputTimestampType")
    reader = lambda own, name: own.sql("SELECT TIMESTAMP '2024-01-02 03:04:05.678901' AS ts")
    snapshot.snapshot(spark, reader, ["t"], target)
    assert spark.conf.get("spark.sql.parquet.outputTimestampType") == before
    meta = pq.ParquetFile(glob.glob(f"{target.removeprefix('file:')}/t.parquet/*.parquet")[0]).metadata
    column = meta.row_group(0).column(0)
    assert (column.compression, column.physical_type) == ("SNAPPY", "INT64") and "microseconds" in str(meta.schema.column(0).logical_type)


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    from martforge import session

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class Cluster:
        conf = Conf()

        @property
        def sparkContext(self):
            raise RuntimeError

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Cluster())


def test_a_versioned_table_is_never_half_replaced(spark, monkeypatch):
    lake = layers.VersionedLake(scratch_path(spark, "versions"))
    assert not lake.complete(spark, "silver", "t")
    lake.write(spark.range(5), "silver", "t", mode="errorifexists")
    with pytest.raises(FileExistsError, match="PATH_ALREADY_EXISTS"):
        lake.write(spark.range(5), "silver", "t", mode="errorifexists")
    reading = lake.read(spark, "silver", "t")
    with pytest.raises(Exception, match="no"):  # the job fails
        lake.write(spark.range(5).selectExpr("id + raise_error('no') AS id"), "silver", "t")
    with monkeypatch.context() as m:  # the driver dies between the write and the rename
        m.setattr(layers, "_point", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            lake.write(spark.range(9), "silver", "t")
    assert lake.read(spark, "silver", "t").count() == 5
    lake.write(spark.range(7).selectExpr("id AS other", "'x' AS more"), "silver", "t", partition_by=["more"])
    assert lake.read(spark, "silver", "t").columns == ["other", "more"] and lake.read(spark, "silver", "t").count() == 7
    assert reading.count() == 5  # a read that began before goes on
    lake.write(spark.range(1).selectExpr("id AS other", "'x' AS more"), "silver", "t", mode="append", partition_by=["more"])
    assert lake.read(spark, "silver", "t").count() == 8
    assert len(lake.vacuum(spark, "silver", "t")) >= 2 and lake.read(spark, "silver", "t").count() == 8


def test_the_pipeline_runs_on_a_versioned_lake(spark, sf):
    from martforge.plans import pipeline

    lake = layers.VersionedLake(scratch_path(spark, "lake"))
    readers = {"stores": lambda: td.stores(spark, sf), "products": lambda: td.products(spark, sf), "sales": lambda: td.sales(spark, sf)}
    first = pipeline.run(spark, readers, lake, pipeline.PipelineConfig(schemas=("vsilver", "vgold")))
    assert pipeline.run(spark, readers, lake, pipeline.PipelineConfig(schemas=("vsilver", "vgold")))["fct_sales"] == first["fct_sales"]
    assert spark.table("vgold.fct_sales").count() == lake.read(spark, "gold", "fct_sales").count() > 0


def test_nanoseconds_are_cut_and_not_rounded(spark):
    df = spark.createDataFrame([(1_700_000_000_123_456_999,), (-1,), (-1000,), (None,)], "ts long")
    got = snapshot.truncated_nanos(df, ["ts"]).selectExpr("unix_micros(ts) AS us").collect()
    assert [r.us for r in got] == [1_700_000_000_123_456, -1, -1, None]

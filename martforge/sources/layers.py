"""Layer tables (bronze/silver/gold/quarantine) addressed by root + name, catalog registration, sinks."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.session import shuffles_freed


@dataclass(frozen=True)
class Lake:
    """``<root>/<layer>/<name>``; the format is a parameter (parquet here, any Spark source works)."""

    root: str
    fmt: str = "parquet"

    def path(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def location(self, spark: SparkSession, layer: str, name: str) -> str:
        """The folder that holds the table's files now."""
        return self.path(layer, name)

    def complete(self, spark: SparkSession, layer: str, name: str) -> bool:
        """Whether the table was written to its end (its committer left the success marker)."""
        fs, path = file_system(spark, f"{self.path(layer, name)}/_SUCCESS")
        return fs.exists(path)

    def read(self, spark: SparkSession, layer: str, name: str) -> DataFrame:
        return spark.read.format(self.fmt).load(self.path(layer, name))

    def write(self, df: DataFrame, layer: str, name: str, mode: str = "overwrite",
              partition_by: list[str] | None = None, options: dict[str, str] | None = None) -> str:
        """Write a table; ``overwrite`` writes beside the old table and then puts the new one in its place,
        so a failed job leaves the old table as it was."""
        path = self.path(layer, name)
        target = f"{path}__{uuid.uuid4().hex}" if mode == "overwrite" else path
        w = df.write.format(self.fmt).mode("errorifexists" if mode == "overwrite" else mode).options(**(options or {}))
        if partition_by:
            w = w.partitionBy(*partition_by)
        with shuffles_freed(df.sparkSession):
            w.save(target)
        if target != path:
            _put_in_place(df.sparkSession, target, path)
        return path


@dataclass(frozen=True)
class VersionedLake(Lake):
    """A lake whose tables are folders of versions with one pointer file.

    ``overwrite`` writes a version of its own and then replaces the pointer in
    one rename, so a reader sees the old table or the new one, never half of it or none, and a crash at
    any point leaves the old one; the new version may have another schema. Reads that have begun
    go on with the version they began with, until ``vacuum`` deletes it. ``append``
    adds to the current version.
    """

    POINTER = "_CURRENT"

    def location(self, spark: SparkSession, layer: str, name: str) -> str:
        table = self.path(layer, name)
        fs, pointer = file_system(spark, f"{table}/{self.POINTER}")
        stream = fs.open(pointer)
        try:
            version = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return f"{table}/{version}"

    def complete(self, spark: SparkSession, layer: str, name: str) -> bool:
        fs, pointer = file_system(spark, f"{self.path(layer, name)}/{self.POINTER}")
        return fs.exists(pointer)

    def read(self, spark: SparkSession, layer: str, name: str) -> DataFrame:
        return spark.read.format(self.fmt).load(self.location(spark, layer, name))

    def write(self, df: DataFrame, layer: str, name: str, mode: str = "overwrite",
              partition_by: list[str] | None = None, options: dict[str, str] | None = None) -> str:
        spark, table = df.sparkSession, self.path(layer, name)
        there = self.complete(spark, layer, name)
        if mode == "errorifexists" and there:
            raise FileExistsError(f"PATH_ALREADY_EXISTS: {table}")
        adds = mode == "append" and there
        version = f"v_{uuid.uuid4().hex}"
        target = self.location(spark, layer, name) if adds else f"{table}/{version}"
        w = df.write.format(self.fmt).mode("append" if adds else "errorifexists").options(**(options or {}))
        (w.partitionBy(*partition_by) if partition_by else w).save(target)
        if not adds:
            _point(spark, f"{table}/{self.POINTER}", version)
        return target

    def vacuum(self, spark: SparkSession, layer: str, name: str) -> list[str]:
        """Delete all versions but the current one, unfinished ones included; their names."""
        table = self.path(layer, name)
        current = self.location(spark, layer, name).rsplit("/", 1)[1]
        fs, folder = file_system(spark, table)
        old = [s.getPath() for s in fs.listStatus(folder) if s.isDirectory() and s.getPath().getName() != current]
        for path in old:
            fs.delete(path, True)
        return sorted(p.getName() for p in old)


def _point(spark: SparkSession, pointer: str, version: str) -> None:
    """Write ``version`` beside ``pointer`` and rename it over the old one: one operation of the file system."""
    jvm = spark.sparkContext._jvm
    fs, new = file_system(spark, f"{pointer}_{uuid.uuid4().hex}")
    stream = fs.create(new, False)
    stream.write(bytearray(version.encode()))
    stream.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    target = jvm.org.apache.hadoop.fs.Path(pointer)
    qualified = target.makeQualified(fs.getUri(), fs.getWorkingDirectory())
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(new.makeQualified(fs.getUri(), fs.getWorkingDirectory()), qualified, how)


def write_by(df: DataFrame, path: str, keys: list[str], fmt: str = "parquet", mode: str = "errorifexists",
             options: dict[str, str] | None = None, gathered: bool = False) -> None:
    """Write a table with one folder per value of ``keys``; its shuffle files go when it is written.

    Rows of a folder are brought together first, so that a folder gets a few
    files and not one from every task; a folder larger than AQE's advisory
    partition size is split over several tasks and files (rebalance), so none is bound to one task.
    ``gathered``: few tasks have rows of a folder already, and rows are written where they are.
    """
    rows = df if gathered else df.hint("rebalance", *keys)
    with shuffles_freed(df.sparkSession):
        rows.write.format(fmt).mode(mode).options(**{"compression": "zstd", **(options or {})}).partitionBy(*keys).save(path)


def file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _put_in_place(spark: SparkSession, made: str, path: str) -> None:
    """Rename ``made`` to ``path``; what was there is renamed first and deleted last."""
    fs, new = file_system(spark, made)
    _, target = file_system(spark, path)
    _, old = file_system(spark, f"{made}__old")
    had = fs.exists(target)
    if had and not fs.rename(target, old):
        raise OSError(f"cannot move {path}")
    if not fs.rename(new, target):
        if had:
            fs.rename(old, target)
        raise OSError(f"cannot put {made} in place of {path}")
    if had:
        fs.delete(old, True)


def write_once(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Write only if the target does not exist: 'written', or 'PATH_ALREADY_EXISTS'. Any other error is raised."""
    try:
        df.write.format(fmt).mode("errorifexists").save(path)
        return "written"
    except AnalysisException as e:
        if e.getCondition() != "PATH_ALREADY_EXISTS":
            raise
        return e.getCondition()


def write_bucketed(df: DataFrame, table: str, location: str, keys: list[str], buckets: int, fmt: str = "parquet") -> DataFrame:
    """A catalog table dealt into ``buckets`` by ``keys`` and sorted by them inside.

    Joins and groupings on ``keys`` of tables with the same bucket count read
    matching buckets together and need no exchange. The rows are dealt out once here, so
    that every bucket is one file and not one of each task.
    """
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    (df.repartition(buckets, *keys).write.format(fmt).bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", location).saveAsTable(table))
    return spark.table(table)


def drop_empty_folders(spark: SparkSession, path: str, key: str, values: list, kept: list) -> list:
    """Delete the folders of ``values`` that are not in ``kept``: an overwrite of single folders leaves the emptied ones."""
    gone = [v for v in values if v not in set(kept)]
    for value in gone:
        fs, folder = file_system(spark, f"{path}/{key}={value}")
        if fs.exists(folder):
            fs.delete(folder, True)
    return gone


def file_inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """The files behind file-based tables, with the rows each holds: (table_name, file_name, row_count)."""
    parts = [df.groupBy(F.col("_metadata.file_name").alias("file_name")).agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "file_name", "row_count") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def ensure_schema(spark: SparkSession, schema: str) -> None:
    """CREATE SCHEMA IF NOT EXISTS in the catalog's warehouse. Its tables name their own locations."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")


def register_tables(spark: SparkSession, schema: str, tables: dict[str, str], fmt: str = "parquet") -> None:
    """Idempotently create ``schema`` and (re)point external tables at their locations."""
    ensure_schema(spark, schema)
    for name, location in tables.items():
        spark.sql(f"DROP TABLE IF EXISTS {schema}.{name}")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {schema}.{name} USING {fmt} LOCATION '{location}'")


def insert_select(spark: SparkSession, table: str, columns_ddl: str, location: str, rows: DataFrame,
                  fmt: str = "parquet") -> DataFrame:
    """CREATE TABLE with fixed columns, then INSERT the rows by position.

    Store assignment casts to the declared types and fails on overflow (ANSI).
    """
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} ({columns_ddl}) USING {fmt} LOCATION '{location}'")
    rows.write.insertInto(table)
    return spark.table(table)


def publish_view(df: DataFrame, view: str, location: str, fmt: str = "parquet") -> DataFrame:
    """Create a view or point it at a new version of its data, whatever its schema, by one catalog operation.

    ``replace_table`` drops a table whose schema changes before it creates the new one; a
    view over versions has no moment without it.
    """
    spark, version = df.sparkSession, f"{location.rstrip('/')}/{uuid.uuid4().hex}"
    df.write.format(fmt).mode("errorifexists").save(version)
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {fmt}.`{version}`")
    return spark.table(view)


def replace_table(df: DataFrame, table: str, location: str, fmt: str = "parquet") -> DataFrame:
    """Create a catalog table from a DataFrame or point it at a new version of its data.

    Every version is a folder of its own under ``location``; the table is
    repointed only after the new one is written, so a failed job leaves the
    old version in the catalog.
    """
    spark, version = df.sparkSession, f"{location.rstrip('/')}/{uuid.uuid4().hex}"
    with shuffles_freed(spark):
        df.write.format(fmt).mode("errorifexists").option("compression", "zstd").save(version)
    if spark.catalog.tableExists(table) and spark.table(table).schema == df.schema:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{version}'")
        spark.catalog.refreshTable(table)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(f"CREATE TABLE {table} USING {fmt} LOCATION '{version}'")
    return spark.table(table)

"""Session construction and the shared scratch folder.

Cluster jobs read ``spark.checkpoint.dir`` from the session. Only a local
master (tests, single machine) may do without: it gets a folder of its own.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}
_SCRATCH = "martforge"
#: Spark's switch that deletes a query's shuffle files when the query ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleaning, _cleaning_lock = {}, threading.Lock()
_scopes = threading.local()


def get_session(master: str | None = None, app: str = "martforge", shuffle_partitions: int | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    """The session as submitted; master and partition count are set only if given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    merged = dict(DEFAULT_CONF)
    if shuffle_partitions:
        merged["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    merged.update(conf or {})
    for key, value in merged.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if _context(spark) is not None:
        spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - sessions without a driver-side context (Spark Connect)
        return None


def app_id(spark: SparkSession) -> str:
    sc = _context(spark)
    return sc.applicationId if sc is not None else spark.conf.get("spark.app.id", "session")


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process, so that a folder of this machine is shared by all."""
    sc = _context(spark)
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; without one, a local master gets its own and a cluster an error."""
    sc = _context(spark)
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="martforge-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def _forget_at_exit(spark: SparkSession, folder: str) -> None:
    """Have the file system delete ``folder`` when the driver ends."""
    sc = _context(spark)
    if sc is None:
        return
    path = sc._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(path):
        fs.mkdirs(path)
        fs.deleteOnExit(path)


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Shuffle files of the writes inside are deleted as each write ends, not with some later garbage collection of the driver.

    For writes whose result is read back from its files: of a job of several steps, only the step that
    runs holds shuffle files. Side by side in several threads, the last one to end restores the setting.
    """
    with _cleaning_lock:
        inside, before = _cleaning.get(app_id(spark), (0, spark.conf.get(_CLEANUP, None)))
        _cleaning[app_id(spark)] = (inside + 1, before)
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _cleaning_lock:
            inside, before = _cleaning.pop(app_id(spark))
            if inside > 1:
                _cleaning[app_id(spark)] = (inside - 1, before)
            elif before is None:
                spark.conf.unset(_CLEANUP)
            else:
                spark.conf.set(_CLEANUP, before)


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the scratch folder and read back: lineage is cut, rows are fixed, file sizes give statistics.

    The shuffle files that made it go at once (``shuffles_freed``).
    """
    path = scratch_path(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared checkpoint folder, deleted with all of this session's scratch when it ends."""
    folder = "/".join([ensure_checkpoint_dir(spark).rstrip("/"), _SCRATCH, app_id(spark)])
    _forget_at_exit(spark, folder)
    own = "/".join([folder, uuid.uuid4().hex])
    for made in getattr(_scopes, "open", [])[-1:]:
        made.append(own)
    return "/".join([own, *parts])


def drop_kept(df: DataFrame) -> None:
    """Delete the files of a ``kept`` table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        _delete(spark, folder)


def _delete(spark: SparkSession, folder: str) -> None:
    path = _context(spark)._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(_context(spark)._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch_dropped(spark: SparkSession):
    """Scratch tables that this thread makes inside are deleted at the end: for steps whose results are written elsewhere."""
    scopes = _scopes.__dict__.setdefault("open", [])
    scopes.append([])
    try:
        yield
    finally:
        for folder in scopes.pop():
            _delete(spark, folder)

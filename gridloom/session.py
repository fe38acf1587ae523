"""Session factory, storage levels, and the shared work folder."""

from __future__ import annotations

import contextlib
import tempfile
import time
import uuid
from collections.abc import Iterator

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from gridloom.functions.texts import ELAPSED_FORMAT

WORK_PREFIX = "gridloom-"
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

_local_roots: dict[str, str] = {}


def start_session(
    app_name: str = "gridloom",
    *,
    verbose_logging: bool | str = False,
    show_progress: bool = False,
    executor_memory: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build or fetch a session.

    ``verbose_logging=True`` logs at INFO, a string names the level itself.
    ``executor_memory`` (for instance ``"3g"``) is passed on when given.
    """
    builder = SparkSession.builder.appName(app_name)
    builder = builder.config("spark.ui.showConsoleProgress", str(bool(show_progress)).lower())
    if executor_memory:
        builder = builder.config("spark.executor.memory", executor_memory)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if verbose_logging:
        level = "INFO" if verbose_logging is True else verbose_logging
        spark.sparkContext.setLogLevel(level)
    return spark


def resolve_path(path: str, base_path: str | None = None) -> str:
    """Prefix a relative path with the base URI; absolute paths and URIs pass."""
    if base_path is None or path.startswith("/") or "://" in path:
        return path
    return base_path.rstrip("/") + "/" + path


def persist(df: DataFrame, *, eager: bool = False) -> DataFrame:
    """Keep two serialized copies, in memory and spilling to disk.

    Marks the storage only, as Spark does; ``eager=True`` also fills it.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK_2)
    if eager:
        kept.count()
    return kept


def elapsed_since(started: float) -> str:
    """``2m 5s`` from a ``time.time()`` to now."""
    minutes, seconds = divmod(time.time() - started, 60)
    return ELAPSED_FORMAT % (minutes, seconds)


def work_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting: executors of a cluster
    cannot see a folder of the driver's machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    application = spark.sparkContext.applicationId
    if application not in _local_roots:
        _local_roots[application] = tempfile.mkdtemp(prefix=WORK_PREFIX)
    return _local_roots[application]


def new_work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh, not yet existing folder name under the shared root."""
    return f"{work_root(spark)}/{WORK_PREFIX}{purpose}-{uuid.uuid4().hex}"


def remove_work_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder made by :func:`new_work_folder`, and nothing else."""
    inside = folder.startswith(f"{work_root(spark)}/{WORK_PREFIX}")
    if not inside or "/.." in folder:
        raise ValueError(f"not a work folder of this session: {folder}")
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(
    df: DataFrame, purpose: str, *, folder: str | None = None, batch_bytes: int | None = None
) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage in a form that outlives any executor. Unlike an RDD
    checkpoint, later plans still prune its columns and know its real size.
    Whoever names the ``folder`` can delete it when done. ``batch_bytes`` bounds
    the rows that Spark sends to a Python worker at a time while the table is
    written, which both sides hold; a row is sent whole.
    """
    spark = df.sparkSession
    folder = folder or new_work_folder(spark, purpose)
    with _sent_at_a_time(spark, batch_bytes):
        df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


@contextlib.contextmanager
def _sent_at_a_time(spark: SparkSession, batch_bytes: int | None) -> Iterator[None]:
    if batch_bytes is None:
        yield
        return
    before = spark.conf.get(BATCH_SETTING, None)
    spark.conf.set(BATCH_SETTING, str(batch_bytes))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_SETTING)
        else:
            spark.conf.set(BATCH_SETTING, before)

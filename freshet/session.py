"""Session settings and the shared folder for cut lineage and written tables."""

from __future__ import annotations

import atexit
import contextlib
import os
import uuid
import weakref
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

#: Tables written by this driver and not yet removed, by path, in the order of writing.
_WRITTEN: dict[str, SparkSession] = {}
_PATHS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, app: str = "freshet") -> SparkSession:
    """A single-machine session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("FRESHET_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder that every executor reaches: ``spark.checkpoint.dir``, or the context's own checkpoint folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return folder


def use_folder_if_unset(spark: SparkSession, folder: str) -> None:
    """For tests, the bench and local runs: ``folder`` holds written tables where the session names none.

    On a cluster a machine's own folder would be another one on each machine, so nothing is set there.
    """
    context = spark.sparkContext
    one_machine = context.master == "local" or context.master.startswith("local[")
    if one_machine and not (spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()):
        context.setCheckpointDir(folder)


def new_table_path(spark: SparkSession, name: str) -> str:
    """A path for a written table; it is removed when the driver's Python ends."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not _WRITTEN:
        atexit.register(remove_written)
    _WRITTEN[path] = spark
    return path


def remove_written() -> None:
    """Delete the tables that this driver has written, as far as their session still runs."""
    for path in list(_WRITTEN):
        _remove(path)


def _remove(path: str) -> None:
    spark = _WRITTEN.pop(path, None)
    if spark is None:
        return
    context = spark.sparkContext
    if context._jsc is None or context._jsc.sc().isStopped():
        return
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


@contextlib.contextmanager
def shuffle_files_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, an execution's shuffle files go when it ends; what goes on from ``stored`` tables needs none of them."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    For a table that several branches of a plan read: the raw rows behind it are then read once,
    and a lost executor costs a read of the table, not the work before it.
    """
    path = new_table_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _PATHS[table] = path
    return table


def released(*tables: DataFrame) -> None:
    """Delete tables of ``stored`` that nothing reads any more: what was made from them has itself been written."""
    for table in tables:
        _remove(_PATHS[table])


def stored_alone(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """Write what ``make`` gives, then delete the tables that were written on the way to it."""
    before = set(_WRITTEN)
    table = stored(make(), name)
    for path in [p for p in _WRITTEN if p not in before and p != _PATHS[table]]:
        _remove(path)
    return table

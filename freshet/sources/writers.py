"""Parquet and CSV sinks."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    mode: str = "overwrite",
    only_present: bool = False,
) -> None:
    """One distributed write. ``sort_by`` clusters rows inside each file, so that row-group
    statistics prune scans that filter on a gauge.

    ``only_present`` replaces the partitions that ``df`` has rows for and leaves all others as they
    are, so that one model can be run again. A failed job leaves the old partitions.
    """
    if only_present and (mode != "overwrite" or not partition_by):
        raise ValueError("only_present needs partitions and mode overwrite")
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    writer = df.write.mode(mode).option("partitionOverwriteMode", "dynamic" if only_present else "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_named_csv(df: DataFrame, path: str, name: str) -> None:
    """One CSV file per value of ``name``, called by it, with a header and ``NA`` for missing values.

    Each file is written by one task. Spark names its files itself, so they are renamed once all
    are complete; the driver sees names only. A missing name is an error.
    """
    spark = df.sparkSession
    spread = df.withColumn(name, F.coalesce(name, F.raise_error(F.lit(f"a row without {name}")))).repartition(name)
    parts = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    spread.write.partitionBy(name).csv(parts, header=True, nullValue="NA")
    to_path = spark._jvm.org.apache.hadoop.fs.Path
    folder = to_path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    for status in files.globStatus(to_path(f"{parts}/{name}=*/part-*")):
        source = status.getPath()
        label = unquote(source.getParent().getName().split("=", 1)[1])
        if not files.rename(source, to_path(f"{path}/{label}.csv")):
            raise FileExistsError(f"{path}/{label}.csv")
    files.delete(to_path(parts), True)

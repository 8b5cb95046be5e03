"""CSV and parquet sources. A whole directory set is one scan; there is no loop over files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from freshet.functions.text import run_fields
from freshet.operators.quality import require_schema
from freshet.sources.schemas import wide_run


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: StructType) -> DataFrame:
    """CSV files with a header and ``NA`` for missing values, under a declared schema.

    The header of every file is checked against the schema. Columns kept in partition directories
    are not part of it; Spark adds them.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.schema(schema).csv(
        paths, header=True, nullValue="NA", enforceSchema=False, mode="FAILFAST"
    )


def read_csv_and_bad_rows(
    spark: SparkSession, paths: str | Sequence[str], schema: StructType
) -> tuple[DataFrame, DataFrame]:
    """``read_csv`` for files with damaged rows: (rows that fit the schema, rows that do not).

    A bad row has a value of another type, or too few or too many fields; it comes back as
    ``file_name`` and ``record``, the text of its line, in no column of the first table. A header
    that differs from the schema is still an error. Both tables read all columns, as whether a row
    is bad must not depend on the columns that a query asks for.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    held = "__record"
    rows = spark.read.schema(StructType([*schema.fields, StructField(held, StringType())])).option("columnPruning", False).csv(
        paths,
        header=True,
        nullValue="NA",
        enforceSchema=False,
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=held,
    )
    # True of every row; Spark refuses a query that needs no column but the record.
    read = F.xxhash64(*schema.names) >= F.lit(-(1 << 63))
    good = rows.where(F.col(held).isNull() & read).drop(held)
    bad = rows.where(F.col(held).isNotNull() & read).select(F.col("_metadata.file_name").alias("file_name"), F.col(held).alias("record"))
    return good, bad


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV file, read from its first line only."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path).columns


def read_parquet(spark: SparkSession, paths: str | Sequence[str], schema: StructType | None = None) -> DataFrame:
    """Parquet files or directories, lazily; checked against ``schema`` when one is given."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    df = spark.read.parquet(*paths)
    return df if schema is None else require_schema(df, schema)


def read_model_runs(
    spark: SparkSession, directories: Sequence[str], width: int, run_name: Column | None = None
) -> DataFrame:
    """Wide model-run CSVs of all ``directories``, each row tagged from the name of its file.

    ``run_name`` replaces the file name where the name is kept elsewhere, such as in a
    partition directory.
    """
    df = read_csv(spark, directories, wide_run(width))
    fields = run_fields(F.col("_metadata.file_name") if run_name is None else run_name)
    tags = ("GCM", "ensemble_id", "experiment", "realisation", "date_range")
    values = [f"V{i}" for i in range(1, width + 1)]
    return df.select(*[fields[t].alias(t) for t in tags], "time_sum", *values)

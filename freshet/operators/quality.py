"""Checks that report as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def require_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Fail when a declared column is absent or has another type."""
    found = {f.name: f.dataType for f in df.schema.fields}
    wrong = [
        f"{f.name}: expected {f.dataType.simpleString()}, found "
        + (found[f.name].simpleString() if f.name in found else "nothing")
        for f in schema.fields
        if found.get(f.name) != f.dataType
    ]
    if wrong:
        raise TypeError("; ".join(wrong))
    return df


def schema_report(df: DataFrame, schema: StructType) -> DataFrame:
    """One row per declared column: its type, whether it matches, rows and missing values."""
    require = {f.name: f for f in schema.fields}
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in require if c in found],
    )
    lines = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(found.get(c)).alias("found_type"),
            F.lit(found.get(c) == f.dataType.simpleString()).alias("type_ok"),
            F.col("n_rows"),
            (F.col(c) if c in found else F.col("n_rows")).alias("n_missing"),
            F.lit(f.nullable).alias("may_be_missing"),
        )
        for c, f in require.items()
    ]
    report = counts.select(F.inline(F.array(*lines)))
    return report.withColumn("ok", F.col("type_ok") & (F.col("may_be_missing") | (F.col("n_missing") == 0)))


def missing_series(wanted: DataFrame, data: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Wanted series with no row at all. The data shrinks to its distinct keys before the shuffle."""
    return wanted.select(*keys).distinct().join(data.select(*keys).distinct(), list(keys), "left_anti")


def empty_segments(runs: DataFrame, rows: DataFrame, keys: Sequence[str], series: Sequence[str]) -> DataFrame:
    """Runs of a gauge that select no row of one of its series.

    A series is dense in positions 1..n, so a run is empty exactly when it starts after n.
    """
    sizes = rows.groupBy(*series).agg(F.count(F.lit(1)).alias("n_rows"))
    return runs.join(sizes, list(keys)).where(F.col("start_index") > F.col("n_rows"))


def extents(df: DataFrame, keys: Sequence[str], year: str, first: str, last: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(year).alias(first), F.max(year).alias(last))


def covered_series(models: DataFrame, observed: DataFrame, start_by: int = 1959, end_in: int = 2014) -> DataFrame:
    """Model series that reach into the observed period, start by one year and end in another."""
    model = extents(models, ["gauge", "GCM", "ensemble_id"], "year", "GCM_start_year", "GCM_end_year")
    obs = extents(observed, ["gauge"], "year", "obs_start_year", "obs_end_year")
    kept = model.where((F.col("GCM_start_year") <= start_by) & (F.col("GCM_end_year") == end_in)).join(obs, "gauge")
    return kept.where(F.col("GCM_end_year") > F.col("obs_start_year")).drop("obs_start_year", "obs_end_year")


def row_mismatches(df: DataFrame, is_observed: Column, below: int = 50) -> DataFrame:
    """Model series whose row count differs from the observed one and is below ``below``.

    Larger mismatches are kept on purpose.
    """
    counts = df.groupBy("gauge", "GCM", "ensemble_id").agg(F.count(F.lit(1)).alias("count"))
    observed = counts.where(is_observed).select("gauge", F.col("count").alias("obs_count"))
    models = counts.where(~is_observed).join(observed, "gauge", "left")
    return models.where((F.col("count") != F.col("obs_count")) & (F.col("count") < below))

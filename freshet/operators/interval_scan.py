"""Rows to the run they lie in, by one sorted pass over rows and runs together.

Writing a run out by position makes as many rows as it is long. Here a run is one row at its start, sorted in among the
rows of its series, and each row looks back at the last run begun. So that a long series is not one task, positions are
cut into stretches of ``WIDTH``; a run is copied to each stretch it reaches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Positions of a stretch.
WIDTH = 1 << 16


def assign_segments_by_scan(
    rows: DataFrame, runs: DataFrame, keys: Sequence[str], position: str = "position", width: int = WIDTH
) -> DataFrame:
    """The rows whose position lies in a run, tagged with the run's start as ``segment_id``.

    The same rows as ``series.assign_segments``, for runs of any length: what is moved is the rows, once, and a row per run
    and stretch. Runs of a series must not overlap; those that do fail. Rows and runs with a missing key or position are in
    no run; runs that end before they start hold nothing. Repeated rows stay. No runs give no rows.
    """
    here = F.col(position).cast("long")
    named = [F.col(c).alias(f"k{i}") for i, c in enumerate(keys)]
    parts = [f"k{i}" for i in range(len(keys))]
    first = [*keys, position]
    columns = [*first, *[c for c in rows.columns if c not in first]]
    own = rows.dropna(subset=first).select(
        *named,
        F.floor(here / width).alias("stretch"),
        here.alias("at"),
        F.lit(True).alias("is_row"),
        F.struct(*columns).alias("row"),
        F.lit(None).cast("struct<start: bigint, end: bigint>").alias("run"),
    )
    start, end = F.col("start_index").cast("long"), F.col("end_index").cast("long")
    reached = F.sequence(F.floor(start / width), F.floor(end / width))
    begun = (
        runs.dropna(subset=[*keys, "start_index", "end_index"])
        .where(end >= start)
        .select(*named, F.struct(start.alias("start"), end.alias("end")).alias("run"), F.explode(reached).alias("stretch"))
        .select(
            *parts,
            "stretch",
            F.greatest(F.col("run.start"), F.col("stretch") * width).alias("at"),
            F.lit(False).alias("is_row"),
            F.lit(None).cast(own.schema["row"].dataType).alias("row"),
            "run",
        )
    )
    # At one position the run comes before its rows.
    before = Window.partitionBy(*parts, "stretch").orderBy("at", "is_row").rowsBetween(Window.unboundedPreceding, -1)
    placed = own.unionByName(begun).withColumn("last", F.last("run", ignorenulls=True).over(before))
    overlap = F.raise_error(F.lit("runs of a series overlap")).cast("boolean")
    of_run = F.when(F.col("last.end") >= F.col("run.start"), overlap).otherwise(F.lit(False))
    inside = F.when(F.col("is_row"), F.col("last.end") >= F.col("at")).otherwise(of_run)
    return placed.where(inside).select("row.*", F.col("last.start").alias("segment_id"))

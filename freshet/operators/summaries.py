"""Distribution summaries and label tables. All reduce inside each task before any shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.functions.maths import label_height, label_offset
from freshet.functions.text import letter, lettered_list


def ecdf_on_grid(df: DataFrame, value: str, low: float, high: float, points: int) -> DataFrame:
    """Empirical distribution function at ``points`` equal steps from ``low`` to ``high``.

    Each value is assigned to the first grid point that is not below it, the values per grid
    point are counted, and a running sum over the ``points`` counts gives the function. NaN is left
    out; infinities lie before the first point and behind the last.
    """
    step = (high - low) / (points - 1)
    v = F.col(value)

    def at(i: Column) -> Column:
        return F.lit(low) + F.lit(step) * i

    # Bounded as a double: an infinity has no integer.
    guess = F.ceil(F.greatest(F.lit(-1.0), F.least(F.lit(points + 1.0), (v - F.lit(low)) / F.lit(step))))
    slot = F.when(v <= at(guess - 1), guess - 1).when(v > at(guess), guess + 1).otherwise(guess)
    bounded = F.greatest(F.lit(0), F.least(F.lit(points), slot)).cast("int")
    counts = df.where(v.isNotNull() & ~F.isnan(v.cast("double"))).groupBy(bounded.alias("i")).agg(F.count(F.lit(1)).alias("n"))
    grid = df.sparkSession.range(points + 1).select(F.col("id").cast("int").alias("i"))
    # points + 1 rows: the one window without keys is as small as the grid.
    w = Window.orderBy("i")
    filled = grid.join(counts, "i", "left").select("i", F.coalesce("n", F.lit(0)).alias("n"))
    total = F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    reached = F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return filled.select("i", F.try_divide(reached, total).alias("y")).where(F.col("i") < points).select(
        at(F.col("i")).alias("x"), "y"
    )


def histogram(df: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """Counts in ``bins`` equal, left-closed bins over the finite range of a column; empty bins have no row.

    NaN and infinities are in no bin and do not move the range.
    The range is found first, so ``df`` is read twice: pass a written table.
    """
    present = df.where(F.abs(F.col(value).cast("double")) < float("inf")).select(value)
    limits = present.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high"))).scalar()
    placed = present.withColumn("__l", limits).select(
        value, F.col("__l.low").alias("low"), ((F.col("__l.high") - F.col("__l.low")) / bins).alias("width")
    )
    index = F.floor(F.try_divide(F.col(value) - F.col("low"), F.col("width"))) + 1
    bounded = F.when(F.col("width") == 0, F.lit(1)).otherwise(F.least(F.lit(bins), index))
    counts = placed.groupBy(bounded.cast("int").alias("bin"), "low", "width").agg(
        F.count(F.lit(1)).alias("n")
    )
    return counts.select("bin", (F.col("low") + F.col("width") * (F.col("bin") - 1)).alias("bin_start"), "width", "n")


def share_above(value: Column, threshold: float) -> Column:
    """Aggregate: percentage of values above a threshold; NULL where one of them is NaN."""
    return F.when(F.count_if(F.isnan(value.cast("double"))) == 0, F.avg((value > threshold).cast("double")) * 100)


def label_lists(df: DataFrame, group: str, label: str) -> DataFrame:
    """Sorted distinct labels of each (small) group as one lettered sentence."""
    labels = df.select(group, label).distinct().groupBy(group).agg(F.array_sort(F.collect_list(label)).alias("__l"))
    return labels.select(group, lettered_list(F.col("__l")).alias("caption"))


def facet_labels(
    df: DataFrame, facet: str, x: str, y: str, facet_order: DataFrame, right: float = 0.0, up: float = 0.0
) -> DataFrame:
    """Where to put the letter of each panel: top of the panel and the left end of all panels.

    ``facet_order`` holds the facet and its ``row_number``. ``df`` is read twice: pass a written
    table.
    """
    panels = df.groupBy(facet).agg(F.max(y).alias("top"), F.min(y).alias("bottom"))
    placed = panels.join(facet_order, facet).withColumn("xlab", df.agg(F.min(x)).scalar())
    height = label_height(F.col("top"), F.col("bottom"))
    return placed.select(
        "row_number",
        facet,
        label_offset(F.col("xlab"), right).alias("xlab"),
        label_offset(height, up).alias("ylab"),
        F.col("bottom").alias("min_ylab"),
        F.abs(F.col("top") - F.col("bottom")).alias("range_ylab"),
        letter(F.col("row_number")).alias("label_name"),
    )


def nested(df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str], name: str) -> DataFrame:
    """Rows of a series as one ordered array of records. For calendar series only: an array holds
    at most one record per step."""
    return df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(order, *columns))).alias(name))

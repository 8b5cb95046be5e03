"""Drought flag of a yearly rain series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from freshet.functions.nulls import ratio, strict
from freshet.operators.series import Series, islands, rolling_mean

# Smoothing rows, dry line, shortest drought, wet year that ends a drought.
SMOOTHING = 3
DRY_BELOW = -0.05
SHORTEST = 7
WET_ABOVE = 0.15


def drought_flags(rain: DataFrame, keys: list[str], order: str, value: str, name: str = "drought") -> DataFrame:
    """Flag the drought rows of each series (one row per year).

    A drought is a stretch of at least seven rows whose trailing three-row mean anomaly lies
    below the line. Its end is then trimmed: from the first clearly wet row among the last three
    on, or the last row alone when the last two are both slightly wet. A series of one row has no
    flag.
    """
    series = Series(tuple(keys), (F.col(order),))
    w = series.window()
    mean = strict(F.avg, F.col(value), Window.partitionBy(*keys))
    anomaly = rain.withColumn("__a", ratio(F.col(value) - mean, mean))
    smooth = rolling_mean(anomaly, series, SMOOTHING, "__a", "__s")
    dry = smooth.withColumn("__dry", F.coalesce(F.col("__s") < DRY_BELOW, F.lit(False)))
    marked = islands(dry, series, F.col("__dry"), "__pos", "__island")
    stretch = F.count(F.lit(1)).over(Window.partitionBy(*keys, "__island"))
    held = marked.withColumn("__d", F.col("__dry") & (stretch >= SHORTEST))
    trimmed = held.withColumn("__cut", _rows_to_cut(w))
    cut = (
        (F.col("__cut") > 0)
        | (F.coalesce(F.lead("__cut", 1).over(w), F.lit(0)) > 1)
        | (F.coalesce(F.lead("__cut", 2).over(w), F.lit(0)) > 2)
    )
    rows = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    flagged = trimmed.withColumn(name, F.when(rows > 1, F.col("__d") & ~cut))
    return flagged.drop("__a", "__s", "__dry", "__pos", "__island", "__d", "__cut")


def _rows_to_cut(w: WindowSpec) -> Column:
    """On the last row of a drought: how many of its last rows are no longer drought."""
    is_last = F.col("__d") & ~F.coalesce(F.lead("__d").over(w), F.lit(False))

    def back(n: int) -> Column:
        return F.lag("__a", n).over(w) if n else F.col("__a")

    def slightly_wet(a: Column) -> Column:
        return (a > 0) & (a < WET_ABOVE)

    rows = F.lit(0)
    rows = F.when(slightly_wet(back(1)) & slightly_wet(back(0)), F.lit(1)).otherwise(rows)
    for n in range(SMOOTHING):
        rows = F.when(back(n) > WET_ABOVE, F.lit(n + 1)).otherwise(rows)
    return F.when(is_last, rows).otherwise(F.lit(0))

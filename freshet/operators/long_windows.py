"""Trailing windows whose cost per row does not grow with their length.

A sliding frame aggregates its whole window anew for every row. Here a series is cut into blocks as long as the window.
Every trailing window is then the end of one block and the beginning of the next, so it is put together from two running
aggregates: one from the front of each block, one from its back. That holds for any aggregate that can be put together from
two parts: minimum, maximum, sum, mean, whether any or every value is true.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.functions.nulls import missing
from freshet.operators.series import SPAN, Series, positions


@dataclass(frozen=True)
class Parts:
    """An aggregate over a part of a window, and how two parts are put together."""

    of: Callable[[Column], Column]
    joined: Callable[[Column, Column], Column]


def _plus(a: Column, b: Column) -> Column:
    return a + b


PARTS = {
    "min": Parts(F.min, F.least),
    "max": Parts(F.max, F.greatest),
    "sum": Parts(F.sum, _plus),
    "mean": Parts(F.sum, _plus),
    "any": Parts(F.bool_or, lambda a, b: a | b),
    "every": Parts(F.bool_and, lambda a, b: a & b),
}


def rolling_any(df: DataFrame, series: Series, rows: int, results: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Trailing windows of ``rows`` rows; ``results`` maps a name to (aggregate of ``PARTS``, column).

    NULL before the first full window and wherever a value in the window is missing (null or NaN). Each row is sorted twice
    and moved once more than its position needs, whatever the length; rows that share keys and order are taken in any
    order, so give an order without ties. A task holds a span of at least ``SPAN`` rows and two windows of one series,
    so a hot series is spread as far as its windows allow. Columns of the result replace columns of the same name.
    """
    if rows < 1:
        raise ValueError("a window has at least one row")
    unknown = {kind for kind, _ in results.values()} - set(PARTS)
    if unknown:
        raise ValueError(f"no parts for {sorted(unknown)}")
    numbered = positions(df, series, "__pos").withColumn("__pos", F.col("__pos") - 1)
    span = -(-SPAN // rows) * rows
    # A span's last block but for its first row is copied to the next span, whose windows begin there.
    late = F.col("__pos") % span > span - rows
    home = F.struct(F.floor(F.col("__pos") / span).alias("span"), F.lit(False).alias("copy"))
    away = F.struct((F.floor(F.col("__pos") / span) + 1).alias("span"), F.lit(True).alias("copy"))
    copies = F.when(late, F.array(home, away)).otherwise(F.array(home)) if rows > 1 else F.array(home)
    spread = numbered.select("*", F.inline(copies).alias("__span", "__copy"))
    block = F.floor(F.col("__pos") / rows).alias("__block")
    in_span = Window.partitionBy(*series.keys, "__span").orderBy("__pos")
    of_block = Window.partitionBy(*series.keys, "__span", block)
    front = of_block.orderBy("__pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    back = of_block.orderBy(F.desc("__pos")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts: dict[str, Column] = {}
    for i, (kind, column) in enumerate(results.values()):
        gap, value = _gap(df, column), F.col(column)
        present = F.when(gap == 0, value.cast("double") if kind == "mean" else value)
        for side, frame in (("f", front), ("b", back)):
            parts[f"__{side}{i}"] = PARTS[kind].of(present).over(frame)
            parts[f"__{side}{i}_gaps"] = F.sum(gap).over(frame)
    ran = spread.withColumns(parts)
    # A window that fills its block needs the front only: the row that ends a block.
    whole = F.col("__pos") % rows == rows - 1
    begun = {c: F.lag(c, rows - 1).over(in_span) for c in parts if c.startswith("__b")} if rows > 1 else {}
    ran = ran.withColumns(begun)
    found = {}
    for i, (name, (kind, _)) in enumerate(results.items()):
        front_part, gaps = F.col(f"__f{i}"), F.col(f"__f{i}_gaps")
        both, all_gaps = PARTS[kind].joined(F.col(f"__b{i}"), front_part), F.col(f"__b{i}_gaps") + gaps
        result = F.when(whole, F.when(gaps == 0, front_part)).when(all_gaps == 0, both)
        found[name] = F.when(F.col("__pos") >= rows - 1, result / rows if kind == "mean" else result)
    return ran.where(~F.col("__copy")).withColumns(found).drop("__pos", "__span", "__copy", *parts)


def _gap(df: DataFrame, column: str) -> Column:
    """1 for a missing value, else 0; only floating-point columns hold NaN."""
    lacks = missing(F.col(column)) if dict(df.dtypes)[column] in ("double", "float") else F.col(column).isNull()
    return lacks.cast("long")

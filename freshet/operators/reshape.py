"""Wide to long and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.functions.nulls import strict_sum_where

#: Bytes of an unlisted label that an error shows.
SHOWN_BYTES = 7


def to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str] | None, name: str, value: str) -> DataFrame:
    """One row per id and value column; NULL cells are kept. ``None`` takes every other column."""
    columns = [c for c in df.columns if c not in ids] if values is None else list(values)
    return df.unpivot(list(ids), columns, name, value)


def columns_ending(df: DataFrame, suffix: str) -> list[str]:
    return [c for c in df.columns if c.endswith(suffix)]


def name_positions(df: DataFrame, names: DataFrame, position: str, name: str) -> DataFrame:
    """Replace the labels ``V1..Vn`` in ``position`` by the ``name`` of the same position in ``names``.

    A position that ``names`` lacks is an error.
    """
    labelled = names.select(F.concat(F.lit("V"), F.col("position").cast("string")).alias(position), F.col(name))
    unknown = F.raise_error(F.concat(F.lit("no name for position "), F.col(position)))
    named = F.when(F.col(name).isNull() & F.col(position).isNotNull(), unknown).otherwise(F.col(name))
    return df.join(labelled, position, "left").withColumn(name, named).drop(position)


def to_wide(
    df: DataFrame, ids: Sequence[str], name: Column, labels: Mapping[object, str], value: Column, others: str = "error"
) -> DataFrame:
    """One column per label. Fails when ``(ids, name)`` is not unique.

    A row whose label is not listed is an error, or left out with ``others="drop"``.

    One aggregate with one shuffle; ``groupBy.pivot`` would shuffle twice and the uniqueness
    check would be a job of its own.
    """
    cells = {label: unique_cell(name == F.lit(k), value, k) for k, label in labels.items()}
    return df.groupBy(*ids).agg(*_listed_only(cells, name, labels, others))


def _listed_only(cells: dict[str, Column], name: Column, labels: Mapping[object, str], others: str) -> list[Column]:
    """The cells; the first one fails for a group with a label outside the list."""
    if others not in ("error", "drop"):
        raise ValueError(f"others is error or drop, not {others}")
    first = next(iter(cells))
    if others == "error":
        listed = F.coalesce(name.isin(*labels), F.lit(False))
        # A string in an aggregate's buffer makes it sort its rows; the label's first bytes fit a number.
        start = F.substring(name.cast("string").cast("binary"), 1, SHOWN_BYTES)
        number = F.max(F.when(~listed, F.conv(F.hex(start), 16, 10).cast("long")))
        unlisted = F.raise_error(F.concat(F.lit("a label that is not listed: "), F.decode(F.unhex(F.hex(number)), "UTF-8")))
        cells[first] = F.when(F.count_if(~listed) > 0, unlisted).otherwise(cells[first])
    return [cell.alias(label) for label, cell in cells.items()]


def unique_cell(match: Column, value: Column, label: object) -> Column:
    """Aggregate: the one value of the matching rows; fails when there are several rows."""
    repeated = F.raise_error(F.lit(f"more than one value for {label}"))
    return F.when(F.count_if(match) > 1, repeated).otherwise(F.max(F.when(match, value)))


def sum_to_wide(
    df: DataFrame, ids: Sequence[str], name: Column, labels: Mapping[object, str], value: Column, others: str = "error"
) -> DataFrame:
    """Strict sum per ``(ids, name)`` laid out with one column per label, in one shuffle; ``others`` as in ``to_wide``."""
    cells = {label: strict_sum_where(name == F.lit(k), value) for k, label in labels.items()}
    return df.groupBy(*ids).agg(*_listed_only(cells, name, labels, others))


def with_rank(df: DataFrame, column: str, levels: Sequence[str], rank: str) -> DataFrame:
    """Position of a label in a fixed level order."""
    place = F.array_position(F.array(*[F.lit(level) for level in levels]), F.col(column)).cast("int")
    return df.withColumn(rank, F.nullif(place, F.lit(0)))

"""Small column helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(column: Column) -> Column:
    """A-Z in lower case, all else untouched."""
    return F.translate(column, UPPER, LOWER)


def text_or_empty(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))


def remainder_of_id(column: Column, divisor: int) -> Column:
    """crc32 of the id written as text, modulo ``divisor``; a null id counts as empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % divisor


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns called c0, c1 and so on, so that no name clashes with one used inside, and the new names."""
    names = {c: f"c{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names

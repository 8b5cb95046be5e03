"""Exact quantiles of groups without a bound on their size.

``percentile`` holds every distinct value of a group in one task. Here a group of more than ``room`` rows is narrowed
first. A sketch of its values names splitters, one aggregate counts the rows at and between the splitters, and the ranks
asked for then lie at a splitter, whose value is known, or strictly between two of them. Such an open interval holds about
1/``CELLS`` of the rows; while it is over ``room``, it is narrowed again. The splitters only decide how much work is left:
the counts are exact, so the result is, whatever the sketch's error.

Rows are never sorted or moved by group as long as it is large. What is shuffled is a sketch and ``2 * CELLS`` counts per
task and large group, and in the end at most ``room`` rows per rank. A value that a large group repeats is counted, not
moved.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.functions.nulls import nan_to_null
from freshet.session import released, stored

#: Rows of a group, or of an open interval of it, that one task may hold.
ROOM = 100_000
CELLS = 64
#: Entries of a sketch; its error is a small part of a cell.
ACCURACY = 1_000
#: Open intervals (about 100 bytes each) are sent to all executors up to this number, and joined beyond it.
SMALL_ROWS = 100_000

_INTERVAL = ("__key", "__from", "__to")


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    results: Mapping[str, float],
    strict: bool = False,
    room: int = ROOM,
) -> DataFrame:
    """One row per group with its quantiles, linearly interpolated; ``results`` maps a name to a share from 0 to 1.

    Nulls and NaN are left out, and a group of nothing else has NULL; with ``strict`` a group that holds one has NULL.
    Infinities are values. Null keys are a group, no keys are one group, no rows give no rows. Other columns are not read,
    whatever their names. ``df`` is read once for the sizes, once for the small groups, and twice for each narrowing of
    the large ones: pass a written table.
    """
    if not results or not all(0 <= p <= 1 for p in results.values()):
        raise ValueError("name at least one quantile, with shares from 0 to 1")
    key = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keys)] or [F.lit(True).alias("all")])
    rows = df.select(key.alias("__key"), nan_to_null(F.col(value).cast("double")).alias("__v"))
    sizes = stored(
        rows.groupBy("__key").agg(F.count("__v").alias("__n"), F.count(F.lit(1)).alias("__rows")), "quantile-sizes"
    )
    large = sizes.where(F.col("__n") > room)
    shares = list(results.values())
    if large.isEmpty():
        found = _of_small(rows, shares)
    else:
        small = _of_small(rows.join(_sent_if_small(large.select("__key")), "__key", "left_anti"), shares)
        found = small.unionByName(_of_large(rows.where(F.col("__v").isNotNull()), large, shares, room))
    if strict:
        whole = sizes.select("__key", (F.col("__n") == F.col("__rows")).alias("__whole"))
        found = found.join(whole, "__key").withColumn("__q", F.when(F.col("__whole"), F.col("__q")))
    named = [F.col("__q")[i].alias(name) for i, name in enumerate(results)]
    return found.select(*[F.col(f"__key.k{i}").alias(c) for i, c in enumerate(keys)], *named)


def exact_median(df: DataFrame, keys: Sequence[str], value: str, name: str, room: int = ROOM) -> DataFrame:
    """Strict median per group, for groups without a bound."""
    return exact_quantiles(df, keys, value, {name: 0.5}, strict=True, room=room)


def _of_small(rows: DataFrame, shares: list[float]) -> DataFrame:
    """(__key, __q) of groups that a task can hold."""
    return rows.groupBy("__key").agg(F.percentile("__v", F.array(*map(F.lit, shares))).alias("__q"))


def _sent_if_small(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS else table


def _of_large(rows: DataFrame, large: DataFrame, shares: list[float], room: int) -> DataFrame:
    """(__key, __q) of large groups, by narrowing the intervals that hold the ranks asked for."""
    position = [F.lit(p) * (F.col("__n") - 1) for p in shares]
    ranks = F.array_distinct(F.array(*[f(x).cast("long") for x in position for f in (F.floor, F.ceil)]))
    unbounded = F.lit(None).cast("double")
    # A rank's interval, the rows in it, the rows of the group below it, and its value once that is known.
    asked = stored(
        large.select(
            "__key",
            F.explode(ranks).alias("__rank"),
            unbounded.alias("__from"),
            unbounded.alias("__to"),
            F.col("__n").alias("__inside"),
            F.lit(0).cast("long").alias("__below"),
            unbounded.alias("__value"),
        ),
        "quantile-ranks",
    )
    while True:
        wide = asked.where(F.col("__value").isNull() & (F.col("__inside") > room))
        if wide.isEmpty():
            break
        before, asked = asked, stored(_narrowed(rows, asked, wide, room), "quantile-ranks")
        released(before)
    known = stored(_looked_up(rows, asked), "quantile-values")
    released(asked)
    at = known.groupBy("__key").agg(F.map_from_entries(F.collect_list(F.struct("__rank", "__value"))).alias("__at"))
    placed = at.join(large.select("__key", "__n"), "__key")
    return placed.select("__key", F.array(*[_interpolated(x, F.col("__at")) for x in position]).alias("__q"))


def _interpolated(position: Column, at: Column) -> Column:
    """Between the values of the two ranks beside a position; the same formula as ``percentile``."""
    low, high = F.floor(position).cast("long"), F.ceil(position).cast("long")
    below, above = at[low], at[high]
    return F.when(below == above, below).otherwise((high - position) * below + (position - low) * above)


def _inside(rows: DataFrame, intervals: DataFrame) -> DataFrame:
    """Rows strictly inside an interval of their group, once for each such interval."""
    v = F.col("__v")
    bounded = (F.col("__from").isNull() | (v > F.col("__from"))) & (F.col("__to").isNull() | (v < F.col("__to")))
    return rows.join(_sent_if_small(intervals), "__key").where(bounded)


def _narrowed(rows: DataFrame, asked: DataFrame, wide: DataFrame, room: int) -> DataFrame:
    """``asked`` with each wide interval cut to the splitter, or the gap between two, that holds the rank."""
    intervals = wide.select(*_INTERVAL).distinct()
    grid = F.array(*[F.lit(i / CELLS) for i in range(CELLS + 1)])
    splitters = F.array_sort(F.array_distinct(F.percentile_approx("__v", grid, F.lit(ACCURACY))))
    cuts = stored(_inside(rows, intervals).groupBy(*_INTERVAL).agg(splitters.alias("__cuts")), "quantile-cuts")
    # Cell 2 i holds what equals the i-th splitter (from 1), cell 2 i + 1 what lies between it and the next one.
    reached = F.size(F.filter("__cuts", lambda s: s <= F.col("__v")))
    at_one = (reached > 0) & (F.get("__cuts", reached - 1) == F.col("__v"))
    cell = F.when(at_one, 2 * reached).otherwise(2 * reached + 1)
    counts = _inside(rows, cuts).groupBy(*_INTERVAL, cell.alias("__cell")).agg(F.count(F.lit(1)).alias("__count"))
    # At most 2 * CELLS + 3 cells an interval.
    order = Window.partitionBy(*_INTERVAL).orderBy("__cell")
    before = F.sum("__count").over(order) - F.col("__count")
    cells = counts.withColumn("__before", before).join(_renamed(cuts), _same_interval(counts, "c_"))
    i = F.floor(F.col("__cell") / 2).cast("int")
    even = F.col("__cell") % 2 == 0
    held = stored(
        cells.select(
            *[F.col(c).alias(f"c{c}") for c in _INTERVAL],
            "__count",
            "__before",
            F.when(even, F.get("c_cuts", i - 1)).alias("__found"),
            # Outside the first or last splitter the old bound stays.
            F.coalesce(F.get("c_cuts", i - 1), F.col("__from")).alias("__low"),
            F.coalesce(F.get("c_cuts", i), F.col("__to")).alias("__high"),
        ),
        "quantile-cells",
    )
    same = (
        (asked["__key"] == held["c__key"])
        & asked["__from"].eqNullSafe(held["c__from"])
        & asked["__to"].eqNullSafe(held["c__to"])
        & asked["__value"].isNull()
        & (asked["__inside"] > room)
        & (asked["__rank"] >= asked["__below"] + held["__before"])
        & (asked["__rank"] < asked["__below"] + held["__before"] + held["__count"])
    )
    cut = F.col("c__key").isNotNull()
    return asked.join(held, same, "left").select(
        "__key",
        "__rank",
        F.when(cut, F.col("__low")).otherwise(F.col("__from")).alias("__from"),
        F.when(cut, F.col("__high")).otherwise(F.col("__to")).alias("__to"),
        F.when(cut, F.col("__count")).otherwise(F.col("__inside")).alias("__inside"),
        (F.col("__below") + F.when(cut, F.col("__before")).otherwise(0)).alias("__below"),
        F.coalesce("__value", "__found").alias("__value"),
    )


def _renamed(cuts: DataFrame) -> DataFrame:
    return cuts.select(*[F.col(c).alias(f"c_{c}") for c in _INTERVAL], F.col("__cuts").alias("c_cuts"))


def _same_interval(left: DataFrame, prefix: str) -> Column:
    key, low, high = (F.col(f"{prefix}{c}") for c in _INTERVAL)
    return (left["__key"] == key) & left["__from"].eqNullSafe(low) & left["__to"].eqNullSafe(high)


def _looked_up(rows: DataFrame, asked: DataFrame) -> DataFrame:
    """(__key, __rank, __value): the ranks still open are read from the rows of their interval, at most ``room``."""
    waiting = asked.where(F.col("__value").isNull())
    intervals = waiting.select(*_INTERVAL).distinct()
    lists = _inside(rows, intervals).groupBy(*_INTERVAL).agg(F.array_sort(F.collect_list("__v")).alias("__values"))
    lists = lists.select(*[F.col(c).alias(f"c_{c}") for c in _INTERVAL], "__values")
    place = (F.col("__rank") - F.col("__below")).cast("int")
    read = waiting.join(lists, _same_interval(waiting, "c_")).select(
        "__key", "__rank", F.get("__values", place).alias("__value")
    )
    return asked.where(F.col("__value").isNotNull()).select("__key", "__rank", "__value").unionByName(read)

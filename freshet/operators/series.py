"""Operators on ordered series.

A series is a set of rows that share ``keys``, ordered by ``order``. Seasonal and yearly tables
hold at most one row per calendar step, so a window over the keys is bounded. For raw rows there
is no such bound: there ``block`` names a column that never decreases along the order. Windows then
run inside ``(keys, block)``, and one small row per block carries the state over to the next block,
so one hot series is spread over many tasks. ``in_blocks`` finds the blocks from the rows: it cuts
the series that need it, and only these, at sampled places of their order.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType
from pyspark.sql.window import WindowSpec

from freshet.functions.nulls import missing
from freshet.session import stored

# Rows per array when a run is expanded, and smallest span of a positional chunk.
SPAN = 4096

# ``in_blocks``: rows of a block, most blocks of a table, and sampled rows per block.
BLOCK_ROWS = 1 << 17
MOST_BLOCKS = 4096
PER_BLOCK = 64
# Cuts of one series are searched in two steps: the list's heads, then one list.
CUT_LIST = 64


@dataclass(frozen=True)
class Series:
    keys: tuple[str, ...]
    order: tuple[str | Column, ...]
    block: str | None = None

    @property
    def parts(self) -> list[str]:
        return [*self.keys, self.block] if self.block else list(self.keys)

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.parts).orderBy(*self.order)

    def blocks(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(self.block)

    def sort_key(self) -> Column:
        return F.struct(*self.order)


def _so_far(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _before(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, -1)


def _checked(df: DataFrame, series: Series) -> DataFrame:
    """Fail on a missing key or block: such a row belongs to no series and no block.

    The filter drops nothing. It states on both sides of the coming join what Spark would infer
    on one side only, so that the two sides can share a shuffle.
    """
    wrong = F.raise_error(F.lit("the keys and the block of a series must not be missing"))
    checked = df.withColumns({c: F.coalesce(F.col(c), wrong) for c in series.parts})
    present = F.lit(True)
    for c in series.parts:
        present = present & F.col(c).isNotNull()
    return checked.where(present)


def in_blocks(df: DataFrame, series: Series, block_rows: int | None = None, name: str = "__block") -> tuple[DataFrame, Series]:
    """The rows with a block per stretch of a long series, and the series that names it.

    The rows are written once; everything after reads the written table. A sample of at most about
    ``MOST_BLOCKS * PER_BLOCK`` keys and orders tells which series are longer than a block and where
    to cut them, so there are at most about ``MOST_BLOCKS`` cuts, which every task may hold. Cuts
    change how rows are dealt to tasks, never a result. Equal orders of one series stay together.
    A table of less than two blocks has none. A missing key is an error.
    """
    if name in df.columns:
        raise ValueError(f"the rows have a column {name}")
    whole = Series(series.keys, series.order)
    rows = stored(_checked(df, whole), "series")
    total = rows.count()
    size = max(block_rows or BLOCK_ROWS, -(-total // MOST_BLOCKS))
    if total < 2 * size:
        return rows, whole
    share = PER_BLOCK / size
    seen = rows if share >= 1 else rows.sample(share, seed=17)
    step = max(1, int(PER_BLOCK * min(1.0, 1 / share)))
    places = F.transform(F.sequence(F.lit(step), F.size("__seen") - 1, F.lit(step)), lambda i: F.get("__seen", i))
    lists = F.transform(F.sequence(F.lit(1), F.size("__cuts"), F.lit(CUT_LIST)), lambda i: F.slice("__cuts", i, CUT_LIST))
    cuts = (
        seen.groupBy(*series.keys)
        .agg(F.array_sort(F.collect_list(whole.sort_key())).alias("__seen"))
        .where(F.size("__seen") >= 2 * step)
        .select(*series.keys, F.array_distinct(places).alias("__cuts"))
        .select(*series.keys, lists.alias("__lists"))
    )
    here = whole.sort_key()
    heads = F.filter(F.transform("__lists", lambda x: x[0]), lambda cut: cut <= here)
    within = F.filter(F.element_at("__lists", F.size(heads)), lambda cut: cut <= here)
    late = F.when(F.size(heads) > 0, (F.size(heads) - 1) * CUT_LIST + F.size(within))
    dealt = rows.join(F.broadcast(stored(cuts, "cuts")), list(series.keys), "left")
    found = dealt.withColumn(name, F.coalesce(late, F.lit(0))).select(*df.columns, name)
    return found, Series(series.keys, series.order, name)


def running_totals(df: DataFrame, series: Series, totals: Mapping[str, Column]) -> DataFrame:
    """Running sums of whole-number expressions along the series.

    With blocks, the sums per block are reduced before they move, and the rows keep the layout of
    their window for the join, so the rows themselves move once.
    """
    inside = _so_far(series.window())
    if series.block is None:
        return df.withColumns({n: F.sum(e).over(inside) for n, e in totals.items()})
    df = _checked(df, series)
    sums = df.groupBy(*series.parts).agg(*[F.sum(e).alias(n) for n, e in totals.items()])
    before = _before(series.blocks())
    carried = sums.select(*series.parts, *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"__b_{n}") for n in totals])
    rows = df.withColumns({n: F.sum(e).over(inside) for n, e in totals.items()}).join(carried, series.parts)
    return rows.withColumns({n: F.col(n) + F.col(f"__b_{n}") for n in totals}).drop(*[f"__b_{n}" for n in totals])


def positions(df: DataFrame, series: Series, name: str = "position") -> DataFrame:
    """1-based row number along the series."""
    return running_totals(df, series, {name: F.lit(1).cast("long")})


def previous(df: DataFrame, series: Series, column: str, name: str) -> DataFrame:
    """Value of ``column`` in the row before, across block borders."""
    w = series.window()
    if series.block is None:
        return df.withColumn(name, F.lag(column).over(w))
    df = _checked(df, series)
    last = df.groupBy(*series.parts).agg(F.max_by(F.struct(column), series.sort_key()).alias("__last"))
    carried = last.select(*series.parts, F.lag("__last").over(series.blocks()).alias("__carry"))
    rows = df.withColumns({name: F.lag(column).over(w), "__first": F.row_number().over(w) == 1})
    rows = rows.join(carried, series.parts)
    at_border = F.when(F.col("__first"), F.col(f"__carry.{column}")).otherwise(F.col(name))
    return rows.withColumn(name, at_border).drop("__first", "__carry")


def differences(df: DataFrame, series: Series, column: str, name: str) -> DataFrame:
    """First differences; the first row of a series has none."""
    return previous(df, series, column, name).withColumn(name, F.col(column) - F.col(name))


def islands(df: DataFrame, series: Series, value: Column, position: str = "position", island: str = "island") -> DataFrame:
    """Number the stretches of equal values (NULL equals NULL) and the rows of a calendar series."""
    w = series.window()
    rows = df.withColumn("__v", value).withColumns(
        {"__p": F.lag("__v").over(w), position: F.row_number().over(w).cast("long")}
    )
    moved = (F.col(position) == 1) | ~F.col("__v").eqNullSafe(F.col("__p"))
    rows = rows.withColumn("__c", F.when(moved, 1).otherwise(0))
    return rows.withColumn(island, F.sum("__c").over(_so_far(w))).drop("__v", "__p", "__c")


def _blocked_islands(rows: DataFrame, series: Series, value: str) -> DataFrame:
    """``islands`` across blocks. Rows and block summaries need the same columns in the same
    layout, so both come from one shuffle."""
    w, blocks = series.window(), series.blocks()
    rows = _checked(rows, series).withColumns({"__p": F.lag(value).over(w), "__n": F.row_number().over(w)})
    moved = (F.col("__n") > 1) & ~F.col(value).eqNullSafe(F.col("__p"))
    rows = rows.withColumn("__c", F.when(moved, 1).otherwise(0))
    summary = rows.groupBy(*series.parts).agg(
        F.count(F.lit(1)).alias("__rows"),
        F.sum("__c").alias("__changes"),
        F.min_by(F.struct(value), series.sort_key()).alias("__head"),
        F.max_by(F.struct(value), series.sort_key()).alias("__tail"),
    )
    summary = summary.withColumn("__before", F.lag("__tail").over(blocks))
    opens = F.col("__before").isNull() | ~F.col(f"__head.{value}").eqNullSafe(F.col(f"__before.{value}"))
    summary = summary.withColumn("__opens", opens.cast("long"))
    earlier = F.coalesce(F.sum("__changes").over(_before(blocks)), F.lit(0))
    carried = summary.select(
        *series.parts,
        F.coalesce(F.sum("__rows").over(_before(blocks)), F.lit(0)).alias("__b_rows"),
        (F.sum("__opens").over(_so_far(blocks)) + earlier).alias("__b_island"),
    )
    numbered = rows.withColumn("__i", F.sum("__c").over(_so_far(w))).join(carried, series.parts)
    return numbered.withColumns(
        {"position": F.col("__n") + F.col("__b_rows"), "island": F.col("__i") + F.col("__b_island")}
    )


def run_lengths(df: DataFrame, series: Series, column: str) -> DataFrame:
    """Run-length encoding: one row per stretch, with its value, bounds and length.

    Each task first reduces its own rows, so a stretch of any length costs one row per task.
    """
    if series.block is None:
        marked = islands(df.withColumn("__v0", F.col(column)), series, F.col("__v0"))
    else:
        named = {f"__o{i}": o for i, o in enumerate(series.order)}
        order = [F.col(o).alias(n) if isinstance(o, str) else o.alias(n) for n, o in named.items()]
        narrow = df.select(*series.parts, *order, F.col(column).alias("__v0"))
        marked = _blocked_islands(narrow, Series(series.keys, tuple(named), series.block), "__v0")
    return marked.groupBy(*series.keys, F.col("island").alias("run")).agg(
        F.max("__v0").alias("value"),
        F.min("position").alias("start_index"),
        F.max("position").alias("end_index"),
        F.count(F.lit(1)).alias("length"),
    )


def present(df: DataFrame, column: str) -> Column:
    """Neither NULL nor NaN."""
    floating = isinstance(df.schema[column].dataType, DoubleType | FloatType)
    return ~missing(F.col(column)) if floating else F.col(column).isNotNull()


def valid_runs(df: DataFrame, series: Series, column: str, minimum: int = 1) -> DataFrame:
    """Stretches of consecutive non-null values with at least ``minimum`` rows."""
    flagged = df.withColumn("__valid", present(df, column))
    runs = run_lengths(flagged, series, "__valid")
    return runs.where(F.col("value") & (F.col("length") >= minimum)).select(
        *series.keys, "start_index", "end_index", "length"
    )


def longest_runs(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Longest run per series; the earliest wins a tie."""
    best = F.max_by(F.struct("start_index", "end_index", "length"), F.struct("length", -F.col("start_index")))
    return runs.groupBy(*keys).agg(best.alias("__best")).select(*keys, "__best.*")


def expand_runs(runs: DataFrame, keys: Sequence[str], carry: Sequence[str] = (), spread: bool = False) -> DataFrame:
    """One row per position of each run, in two steps so that no single array is long.

    ``spread`` moves the spans apart between the steps, so that one very long run is written out
    by many tasks.
    """
    rest = [F.col(c) for c in (*keys, *carry)]
    last = F.floor((F.col("end_index") - F.col("start_index")) / SPAN)
    numbers = F.explode(F.sequence(F.lit(0).cast("long"), last))
    spans = runs.select(*rest, "start_index", "end_index", numbers.alias("__s"))
    if spread:
        spans = spans.repartition(*keys, "start_index", "__s")
    first = F.col("start_index") + F.col("__s") * SPAN
    return spans.select(
        *rest, F.explode(F.sequence(first, F.least(F.col("end_index").cast("long"), first + (SPAN - 1)))).alias("position")
    )


def assign_segments(rows: DataFrame, runs: DataFrame, keys: Sequence[str], position: str = "position") -> DataFrame:
    """Keep the rows whose position lies in a run, tagged with the run's start as ``segment_id``.

    Runs are expanded to positions, so this is a plain equi-join on ``(keys, position)``: no row
    meets the other runs of its gauge, and a hot gauge spreads over its positions. For runs of
    calendar series, which are short.
    """
    tagged = expand_runs(runs.withColumn("segment_id", F.col("start_index").cast("long")), keys, ["segment_id"])
    return rows.join(tagged.withColumnRenamed("position", position), [*keys, position], "inner")


def own_segments(df: DataFrame, series: Series, column: str, minimum: int = 1) -> DataFrame:
    """Rows of the stretches of non-null ``column``, tagged with the position of their first row.

    The same rows as ``valid_runs`` joined back on position, in one pass. For calendar series.
    """
    marked = islands(df, series, present(df, column))
    stretch = Window.partitionBy(*series.keys, "island")
    tagged = marked.withColumns(
        {"segment_id": F.min("position").over(stretch), "__length": F.count(F.lit(1)).over(stretch)}
    )
    return tagged.where(present(df, column) & (F.col("__length") >= minimum)).drop("island", "__length")


def rolling(
    df: DataFrame, series: Series, results: Mapping[str, tuple[Callable[[Column], Column], str, int]]
) -> DataFrame:
    """Trailing windows of a fixed number of rows; NULL before the first full one and wherever a
    value in the window is missing. ``results`` maps a name to ``(aggregate, column, rows)``.

    On a blocked series the rows are cut into positional chunks, and the last rows of each chunk
    are copied to the next one.
    """
    if series.block is None:
        return df.withColumns({n: _full(f, F.col(c), series.window(), rows) for n, (f, c, rows) in results.items()})
    longest = max(rows for _, _, rows in results.values())
    span, halo = max(SPAN, longest), longest - 1
    numbered = positions(df, series, "__pos")
    chunk = F.floor((F.col("__pos") - 1) / span)
    late = (F.col("__pos") - 1) % span >= span - halo
    home = F.struct(chunk.alias("chunk"), F.lit(False).alias("copy"))
    away = F.struct((chunk + 1).alias("chunk"), F.lit(True).alias("copy"))
    copies = F.when(late, F.array(home, away)).otherwise(F.array(home))
    spread = numbered.select("*", F.inline(copies).alias("__chunk", "__copy"))
    w = Window.partitionBy(*series.keys, "__chunk").orderBy("__pos")
    windowed = spread.withColumns({n: _full(f, F.col(c), w, rows) for n, (f, c, rows) in results.items()})
    return windowed.where(~F.col("__copy")).drop("__pos", "__chunk", "__copy")


def _full(agg: Callable[[Column], Column], value: Column, window: WindowSpec, length: int) -> Column:
    trailing = window.rowsBetween(-(length - 1), Window.currentRow)
    return F.when(F.count(value).over(trailing) == length, agg(value).over(trailing))


def rolling_mean(df: DataFrame, series: Series, rows: int, column: str, name: str) -> DataFrame:
    return rolling(df, series, {name: (F.avg, column, rows)})


def centred(df: DataFrame, keys: Sequence[str], value: Column, name: str) -> DataFrame:
    """Value minus the mean of its series; missing values are left out of the mean."""
    return df.withColumn(name, value - F.avg(value).over(Window.partitionBy(*keys)))


def global_positions(df: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """1-based row number over the whole table without a single-task window.

    Rows are range-partitioned and sorted, the layout is pinned by a written table, and the row
    counts per partition (one small row each) give every partition its offset.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    pinned = stored(ranged.withColumn("__id", F.monotonically_increasing_id()), "ranged")
    pinned = pinned.withColumn("__part", F.shiftright("__id", 33))
    counts = pinned.groupBy("__part").agg(F.count(F.lit(1)).alias("__rows"))
    offsets = counts.select(
        "__part", F.coalesce(F.sum("__rows").over(_before(Window.orderBy("__part"))), F.lit(0)).alias("__offset")
    )
    within = F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return (
        pinned.join(F.broadcast(offsets), "__part")
        .withColumn(name, within + F.col("__offset"))
        .drop("__id", "__part", "__offset")
    )


def chunks(labels: DataFrame, column: str, size: int, name: str = "split") -> DataFrame:
    """Sorted distinct labels in groups of ``size``, numbered from 1."""
    ranked = global_positions(labels.select(column).distinct(), [column], "__rank")
    return ranked.select(column, F.ceil(F.col("__rank") / size).cast("int").alias(name))

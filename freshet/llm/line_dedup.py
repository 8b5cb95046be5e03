"""Line dedup by a deletion-neighbourhood join.

Two lines are copies when they are equal, or when both have at least ``min_chars`` characters and one edit (a character
put in, left out or replaced) makes them equal. A line goes when an earlier line, by (id, line number), is its copy. Equal
lines are folded first, so all later work is on distinct lines.

The deletion neighbourhood of a line is the line with any one character left out. Two distinct lines are one edit apart
exactly when one is in the other's neighbourhood, or both become equal by leaving out the same place. So per hashed
variant a minimum is enough: no pairs within a group are ever made. The hash of a variant is an exclusive-or of hashes of
(character, place), so that all variants of a line come from two running sums. Found pairs are verified by their edit
distance.

Emitting a variant per character of all text would be many times the text. Lines one edit apart share the first or the
second half of the longer one; four half-line keys per line therefore tell, without loss, which lines can have a partner
at all, and only those emit their neighbourhoods. All of it is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from freshet.llm.columns import numbered, text_or_empty
from freshet.session import stored

#: A table of at most so many narrow rows (under 100 bytes each) is sent to all executors, a larger one is shuffled.
SMALL_ROWS = 200_000
LINE = ["h1", "h2"]
PLACE = ["id", "row_key", "line_no"]


def _sent_if_small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS else df


def _blank(line: Column) -> Column:
    return F.length(F.trim(line)) == 0


def _lines(rows: DataFrame) -> DataFrame:
    """Every line that is not blank, with its place and a 128-bit name."""
    found = rows.select("id", "row_key", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return found.filter(~_blank(F.col("line"))).withColumns(
        # The second is seeded otherwise; hashed behind the line, a number would only be a function of the first.
        {"h1": F.xxhash64("line"), "h2": F.xxhash64(F.lit("second"), "line")}
    )


def _half_keys(line: Column, min_chars: int) -> Column:
    """Keys that two lines one edit apart have in common: a half of the longer line, for either length it may have."""
    size = F.length(line)
    keys = []
    for longer in (size, size + 1):
        half = F.floor((longer - 1) / 2).cast("int")
        keys.append(F.xxhash64(F.lit("first"), longer, F.left(line, half)))
        keys.append(F.xxhash64(F.lit("last"), longer, F.right(line, half)))
    return F.when(size >= min_chars, F.array(*keys)).otherwise(F.array().cast("array<long>"))


def _neighbours(candidates: DataFrame) -> DataFrame:
    """From (h1, h2, first, line) the earliest earlier neighbour of each line: (h1, h2, first, earlier)."""
    chars = candidates.select(*LINE, "first", F.posexplode(F.split("line", "")).alias("at", "char"))
    own = Window.partitionBy(*LINE)
    upto = own.orderBy("at")
    here, moved = F.xxhash64("char", "at"), F.xxhash64("char", F.col("at") - 1)
    chars = chars.select(
        *LINE,
        "first",
        "at",
        F.bit_xor(here).over(own).alias("whole"),
        F.coalesce(F.bit_xor(here).over(upto.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.bit_xor(moved).over(own).bitwiseXOR(
            F.bit_xor(moved).over(upto.rowsBetween(Window.unboundedPreceding, 0))
        ).alias("after"),
    )
    left_out = chars.select(*LINE, "first", F.col("before").bitwiseXOR(F.col("after")).alias("variant"), (F.col("at") + 1).alias("place"))
    itself = chars.filter("at = 0").select(*LINE, "first", F.col("whole").alias("variant"), F.lit(0).alias("place"))
    same, same_place = Window.partitionBy("variant"), Window.partitionBy("variant", "place")
    whole_line = F.min(F.when(F.col("place") == 0, F.col("first"))).over(same)
    longer_line = F.min(F.when(F.col("place") > 0, F.col("first"))).over(same)
    replaced = F.min("first").over(same_place)
    best = F.when(F.col("place") == 0, longer_line).otherwise(F.array_min(F.array(whole_line, replaced)))
    return (
        left_out.unionByName(itself)
        .withColumn("best", best)
        .groupBy(*LINE, "first")
        .agg(F.min("best").alias("earlier"))
        .filter("earlier < first")
    )


def near_copies(rows: DataFrame, lines: DataFrame) -> DataFrame:
    """The distinct lines (h1, h2) that an earlier line replaces by one edit."""
    keyed = lines.select(F.explode("keys").alias("key"), *LINE)
    shared = keyed.groupBy("key").count().filter("count > 1").select("key")
    able = stored(keyed.join(shared, "key", "left_semi").select(*LINE).distinct(), "lines-able")
    placed = stored(lines.join(_sent_if_small(able), LINE, "left_semi").select(*LINE, "first"), "lines-placed")
    wanted = placed.select(*LINE, "first", *[F.col(f"first.{c}").alias(f"_{c}") for c in PLACE])
    found = _lines(rows)
    texts = found.join(
        _sent_if_small(wanted),
        (found.h1 == wanted.h1) & (found.h2 == wanted.h2) & found.id.eqNullSafe(wanted._id)
        & (found.row_key == wanted._row_key) & (found.line_no == wanted._line_no),
    ).select(found.h1, found.h2, "first", "line")
    # A row that is there twice has each of its lines twice.
    texts = stored(texts.dropDuplicates(LINE), "lines-texts")
    pairs = _neighbours(texts)
    later = texts.select(*LINE, F.col("line").alias("later_line"))
    sooner = texts.select(F.col("first").alias("earlier"), F.col("line").alias("earlier_line"))
    near = F.levenshtein("later_line", "earlier_line", 1).between(0, 1)
    return stored(pairs.join(later, LINE).join(sooner, "earlier").filter(near).select(*LINE), "lines-near")


def without_repeated_lines(
    docs: DataFrame, min_chars: int = 20, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``docs`` with repeated lines left out of the text, plus ``n_lines`` and ``n_dropped``.

    Blank lines stay. Null texts count as empty: one blank line. Equal lines are copies at any length; one edit counts from
    ``min_chars`` characters on. A row that is there twice is one document and comes back twice alike; rows with one id and
    different texts are told apart by a hash of the text. A null id comes before all others. Other columns pass
    unchanged, also those named like a column used inside; columns named n_lines or n_dropped are replaced.
    """
    given = docs.drop("n_lines", "n_dropped")
    docs, names = numbered(given)
    id_column, text_column = names[id_column], names[text_column]
    key = F.xxhash64(F.col(id_column), text_or_empty(F.col(text_column)))
    rows = docs.select(F.col(id_column).alias("id"), key.alias("row_key"), text_or_empty(F.col(text_column)).alias("text"))
    lines = (
        _lines(rows)
        .groupBy(*LINE)
        .agg(F.min(F.struct(*PLACE)).alias("first"), F.first(_half_keys(F.col("line"), min_chars)).alias("keys"))
    )
    lines = stored(lines, "lines")
    dropped = near_copies(rows, lines)
    kept = (
        lines.select(*LINE, "first")
        .join(_sent_if_small(dropped), LINE, "left_anti")
        .groupBy(F.col("first.id").alias("_id"), F.col("first.row_key").alias("_row_key"))
        .agg(F.collect_list("first.line_no").alias("_kept"))
    )
    held = docs.withColumn("_key", key)
    joined = held.join(kept, held[id_column].eqNullSafe(kept["_id"]) & (held["_key"] == kept["_row_key"]), "left")
    parts = F.split(text_or_empty(F.col(text_column)), "\n")
    blanks = F.filter(F.transform(parts, lambda x, i: F.when(_blank(x), i)), lambda i: i.isNotNull())
    stay = F.array_sort(F.concat(F.coalesce("_kept", F.array().cast("array<int>")), blanks))
    return (
        joined.withColumn("_stay", stay)
        .withColumn("_parts", parts)
        .withColumn("n_lines", F.size("_parts"))
        .withColumn("n_dropped", F.size("_parts") - F.size("_stay"))
        .withColumn(text_column, F.array_join(F.transform("_stay", lambda i: F.element_at(F.col("_parts"), i + 1)), "\n"))
        .select(*[F.col(names[c]).alias(c) for c in given.columns], "n_lines", "n_dropped")
    )

"""Mixing sources to target weights by hierarchical budgeting.

Documents are leaves' members in a tree of (domain, language, source). A budget of tokens flows down: at each node it is
shared among the children by weight, and a child that cannot use its share (its documents, repeated for at most
``max_epochs``, hold fewer tokens) leaves the rest to its siblings, again by weight. A node passes on a shortage to its own
siblings only when all its children together are short, because its capacity is the sum of theirs: siblings come before
ancestors.

A leaf then takes the prefix of its token stream: epoch after epoch, each a fresh seeded order of all its documents, until
its budget is met; the document at the edge is taken up to the edge. Orders are cut in 4,096 hash bins, so that prefix sums
run over bins and only the bin at the edge is ordered by document; no leaf is ever sorted as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from freshet.llm.columns import text_or_empty
from freshet.session import stored

BINS = 4096
LEVELS = ("domain", "lang", "source")


def default_domain(source: Column) -> Column:
    """The source's name without its last digit; a stand-in for a site catalogue, which the given tables lack."""
    return F.regexp_replace(F.coalesce(source, F.lit("")), r"\d$", "")


def tokens_of(text: Column) -> Column:
    """Four bytes of text count as one token, begun ones as well; no text has none."""
    return F.floor((F.octet_length(text_or_empty(text)) + 3) / 4).cast("long")


def leaf_budgets(
    leaves: DataFrame,
    total: int | None,
    max_epochs: int,
    levels: tuple[str, ...] = LEVELS,
    weight: Column | None = None,
) -> DataFrame:
    """Adds ``budget`` to a table with one row per leaf (levels, tokens).

    ``weight`` is a leaf's target weight; a node's is the sum of its leaves'. By default it is the square root of the
    leaf's tokens. ``total`` is the budget of the root, by default the tokens of all leaves. Budgets are whole tokens,
    rounded down at each node.
    """
    weight = F.sqrt(F.col("tokens")) if weight is None else weight
    rows = leaves.withColumn("weight", weight.cast("double")).withColumn("capacity", F.col("tokens") * max_epochs)
    root = rows.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("t"), F.coalesce(F.sum("capacity"), F.lit(0)).alias("c"))
    above = root.select(F.least(F.lit(total) if total is not None else F.col("t"), F.col("c")).cast("long").alias("budget"))
    above = above.withColumn("_root", F.lit(0))
    for depth in range(1, len(levels) + 1):
        own, parent = list(levels[:depth]), [*levels[: depth - 1]]
        nodes = rows.groupBy(*own).agg(F.sum("weight").alias("weight"), F.sum("capacity").alias("capacity"))
        nodes = nodes.withColumn("_root", F.lit(0)).join(above.withColumnRenamed("budget", "given"), ["_root", *parent])
        # With children in order of capacity per weight, what is left over for a child and those after it, per unit of
        # their weight, rises while children are filled up and falls afterwards: its maximum is the common level.
        ratio = F.when(F.col("weight") > 0, F.col("capacity") / F.col("weight")).otherwise(F.lit(float("inf")))
        siblings = Window.partitionBy("_root", *parent)
        by = siblings.orderBy(ratio, *own)
        before, after = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(0, Window.unboundedFollowing)
        rest = F.col("given") - F.coalesce(F.sum("capacity").over(before), F.lit(0))
        nodes = nodes.withColumn("level", F.try_divide(rest, F.sum("weight").over(after)))
        level = F.coalesce(F.max("level").over(siblings), F.lit(0.0))
        budget = F.least(F.floor(level * F.col("weight")), "capacity")
        above = nodes.select("_root", *own, F.greatest(budget, F.lit(0)).cast("long").alias("budget"))
    return leaves.join(above.drop("_root"), list(levels))


def mixed(
    docs: DataFrame,
    total: int | None = None,
    max_epochs: int = 2,
    seed: int = 17,
    weight: Column | None = None,
    domain=default_domain,
    id_column: str = "doc_id",
) -> DataFrame:
    """The rows of ``docs`` that the mix takes, once per epoch, with ``mix_epoch``, ``mix_tokens`` and ``mix_taken``.

    ``mix_tokens`` are the document's tokens and ``mix_taken`` those within the leaf's budget: all but for the document at
    the edge. Null languages and sources count as empty names; a document without text has no tokens and is taken in the
    first epoch if its leaf takes anything before its place. Equal ids are ordered by their text's hash; columns named like
    the added ones are replaced. No rows give no rows.
    """
    epoch_of = F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1)))
    rows = docs.drop("mix_epoch", "mix_tokens", "mix_taken", "mix_leaf").withColumns(
        {
            "mix_tokens": tokens_of(F.col("text")),
            "mix_leaf": F.struct(
                domain(F.col("source")).alias("domain"),
                F.coalesce("lang", F.lit("")).alias("lang"),
                F.coalesce("source", F.lit("")).alias("source"),
            ),
        }
    )
    name = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    place = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("_epoch"), name))
    narrow = rows.select(F.col(id_column), "mix_leaf", "mix_tokens").withColumn("_epoch", epoch_of)
    binned = narrow.withColumn("bin", F.conv(F.substring(place, 1, 3), 16, 10).cast("int"))
    # One row per leaf, epoch and bin: the sums that everything else is taken from.
    bins = stored(
        binned.groupBy("mix_leaf.domain", "mix_leaf.lang", "mix_leaf.source", F.col("_epoch").alias("epoch"), "bin").agg(F.sum("mix_tokens").alias("n")),
        "mix-bins",
    )
    leaves = bins.filter("epoch = 0").groupBy(*LEVELS).agg(F.sum("n").alias("tokens"))
    budgets = stored(leaf_budgets(leaves, total, max_epochs, weight=weight), "mix-budgets")
    stream = Window.partitionBy(*LEVELS).orderBy("epoch", "bin").rowsBetween(Window.unboundedPreceding, -1)
    edges = (
        bins.withColumn("before", F.coalesce(F.sum("n").over(stream), F.lit(0)))
        .join(budgets.select(*LEVELS, "budget"), list(LEVELS))
        .filter("before < budget")
        # The last bin that begins before the budget's end holds the edge; all before it are taken whole.
        .groupBy(*LEVELS, "budget")
        .agg(F.max(F.struct("epoch", "bin", "before")).alias("edge"))
    )
    edges = stored(edges, "mix-edges")
    # One row per leaf, read from a table of known size: Spark broadcasts it when small and splits skew when not.
    held = rows.withColumns({f"_{c}": F.col(f"mix_leaf.{c}") for c in LEVELS}).join(
        edges.select(*[F.col(c).alias(f"_{c}") for c in LEVELS], F.col("budget").alias("_budget"), F.col("edge").alias("_edge")), [f"_{c}" for c in LEVELS]
    ).withColumn("_epoch", epoch_of)
    held = held.withColumn("_place", place)
    held = held.withColumn("_bin", F.conv(F.substring("_place", 1, 3), 16, 10).cast("int"))
    at = F.struct(F.col("_epoch"), F.col("_bin"))
    edge = F.struct(F.col("_edge.epoch"), F.col("_edge.bin"))
    whole = held.filter(at < edge).withColumn("mix_taken", F.col("mix_tokens"))
    inside = Window.partitionBy(*[f"_{c}" for c in LEVELS], "_epoch", "_bin").orderBy("_place", F.xxhash64("text"))
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    partly = (
        held.filter(at == edge)
        .withColumn("_from", F.col("_edge.before") + F.coalesce(F.sum("mix_tokens").over(inside), F.lit(0)))
        .filter("_from < _budget")
        .withColumn("mix_taken", F.least(F.col("mix_tokens"), F.col("_budget") - F.col("_from")))
        .drop("_from")
    )
    return (
        whole.unionByName(partly)
        .withColumn("mix_epoch", F.col("_epoch"))
        .drop("_epoch", "_budget", "_edge", "mix_leaf", "_place", "_bin", *[f"_{c}" for c in LEVELS])
    )

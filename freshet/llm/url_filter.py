"""URL verdicts by rules and, where no rule fits, by a ratio of two character language models.

The models are variable-order Markov chains over a small alphabet, one learned from the URLs that the rules accept and
one from those they reject. A character is predicted from its two predecessors with Witten-Bell smoothing towards the
shorter context; a context seen fewer than ``min_count`` times is not used at all and the chain falls back to a shorter
one. Both models are folded into one dense table of log-ratios, so its size is fixed by the alphabet
(``len(ALPHABET) + 1`` cubed), whatever the input. A URL's score is the mean log-ratio per character; the threshold is
calibrated on labelled URLs that the models have not seen. Everything is DataFrame expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from freshet.llm.columns import lower_ascii, text_or_empty
from freshet.session import stored

ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789/.-_?=&%#:~+"
SIZE = len(ALPHABET) + 1  # index 0 stands for every other character
START = "\u0000\u0000"
BINS_PER_UNIT = 1000


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith(f".{self.host}")) & path.startswith(self.path)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return lower_ascii(F.regexp_extract(text_or_empty(url), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(text_or_empty(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def longest_rule(rules: list[Rule], host: Column, path: Column) -> Column:
    """Name and verdict of the longest rule that fits, or null."""
    ordered = sorted(rules, key=lambda r: -len(r.name))
    return F.coalesce(
        *[
            F.when(r.fits(host, path), F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict")))
            for r in ordered
        ],
        F.lit(None).cast("struct<rule:string,verdict:string>"),
    )


def _grams(url: Column) -> Column:
    """Per character its cell in the dense table: two predecessors and itself as one number."""
    codes = F.transform(F.split(F.concat(F.lit(START), lower_ascii(url)), ""), lambda c: F.instr(F.lit(ALPHABET), c))
    # One-element array: the codes are computed once per URL, not once per character.
    cells = F.transform(
        F.array(codes),
        lambda own: F.transform(
            F.sequence(F.lit(3), F.length(url) + 2),
            lambda i: (F.element_at(own, i - 2) * SIZE + F.element_at(own, i - 1)) * SIZE + F.element_at(own, i),
        ),
    )
    return F.element_at(cells, 1)


def _smoothed(counts: DataFrame, n: str, least: int) -> DataFrame:
    """log P of every cell under Witten-Bell smoothing of the counts in column ``n``; counts has all cells."""

    def step(rows: DataFrame, context: str, count: str, lower: Column, name: str) -> DataFrame:
        w = Window.partitionBy(context)
        total, kinds = F.sum(count).over(w), F.sum((F.col(count) > 0).cast("long")).over(w)
        return rows.withColumn(
            name, F.when(total >= least, (F.col(count) + kinds * lower) / (total + kinds)).otherwise(lower)
        )

    last, middle = F.col("cell") % SIZE, F.floor(F.col("cell") / SIZE) % SIZE
    rows = counts.select("cell", F.col(n).alias("n3"), last.alias("c"), middle.alias("b"))
    rows = rows.withColumn("bc", F.col("b") * SIZE + F.col("c")).withColumn("ab", F.floor(F.col("cell") / SIZE))
    ones = rows.groupBy("c").agg(F.sum("n3").alias("n1"))
    ones = ones.select("c", ((F.col("n1") + 1) / (F.sum("n1").over(Window.partitionBy(F.lit(0))) + SIZE)).alias("p1"))
    twos = rows.groupBy("bc", "b", "c").agg(F.sum("n3").alias("n2")).join(ones, "c")
    twos = step(twos, "b", "n2", F.col("p1"), "p2").select("bc", "p2")
    return step(rows.join(twos, "bc"), "ab", "n3", F.col("p2"), "p3").select("cell", F.ln("p3").alias(f"log_{n}"))


def ratio_table(labelled: DataFrame, min_count: int = 4) -> DataFrame:
    """From (url, accepted) one row, one array: per cell, log P if accepted minus log P if rejected."""
    cells = labelled.select("accepted", F.explode(_grams(F.col("url"))).alias("cell")).groupBy("cell")
    seen = cells.agg(
        F.sum(F.col("accepted").cast("long")).alias("good"), F.sum((~F.col("accepted")).cast("long")).alias("bad")
    )
    grid = labelled.sparkSession.range(SIZE**3).select(F.col("id").alias("cell"))
    full = stored(grid.join(seen, "cell", "left").na.fill(0, ["good", "bad"]).select("cell", "good", "bad"), "url-cells")
    both = _smoothed(full, "good", min_count).join(_smoothed(full, "bad", min_count), "cell")
    pairs = F.array_sort(F.collect_list(F.struct("cell", (F.col("log_good") - F.col("log_bad")).alias("d"))))
    return both.agg(F.transform(pairs, lambda x: x["d"]).alias("ratios"))


def _scored(rows: DataFrame, ratios: DataFrame) -> DataFrame:
    """Adds ``score``, the mean log-ratio per character of ``url``; 0 for an empty URL.

    The table is a scalar subquery, evaluated once; the optimizer puts it into the lambda, so rows never carry it.
    """
    url = F.col("url")
    total = F.aggregate(
        _grams(url), F.lit(0.0), lambda sum_, cell: sum_ + F.element_at(F.col("ratios"), cell.cast("int") + 1)
    )
    mean = F.when(F.length(url) > 0, total / F.length(url)).otherwise(F.lit(0.0))
    return rows.withColumn("ratios", ratios.scalar()).withColumn("score", mean).drop("ratios")


def calibrated_threshold(scored: DataFrame) -> DataFrame:
    """One row: the threshold of best balanced accuracy on (score, accepted); 0 where a class is missing.

    Scores are counted in bins of 1/1000, so the search is over a bounded table. Ties go to the threshold nearest 0.
    """
    bins = scored.groupBy(F.floor(F.greatest(F.least("score", F.lit(20)), F.lit(-20)) * BINS_PER_UNIT).alias("bin")).agg(
        F.sum(F.col("accepted").cast("long")).alias("good"), F.sum((~F.col("accepted")).cast("long")).alias("bad")
    )
    w = Window.partitionBy(F.lit(0))
    below = w.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    # URLs in this bin and above are allowed.
    kept_good = 1 - F.coalesce(F.sum("good").over(below), F.lit(0)) / F.sum("good").over(w)
    cut_bad = F.coalesce(F.sum("bad").over(below), F.lit(0)) / F.sum("bad").over(w)
    return bins.withColumn("accuracy", F.try_add(kept_good, cut_bad)).agg(
        F.coalesce(
            F.when(
                (F.sum("good") > 0) & (F.sum("bad") > 0),
                F.max_by(F.col("bin") / BINS_PER_UNIT, F.struct(F.col("accuracy"), -F.abs("bin"), F.col("bin"))),
            ),
            F.lit(0.0),
        ).alias("threshold")
    )


def judged(pages: DataFrame, rules: list[Rule], id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """Each page with host, path, rule, score and verdict (allow or block).

    The verdict is the longest fitting rule's, else allow where the score reaches the threshold. URLs judged by a rule
    teach the models; those whose crc32 is divisible by 5 are set aside for the threshold. A null URL counts as
    empty: score 0. Without any labelled URL all ratios are 0, the threshold is 0 and pages without a rule are allowed.
    Repeated rows are judged alike; other columns are not read.
    """
    host, path = host_of(F.col(url_column)), path_of(F.col(url_column))
    rows = pages.select(
        F.col(id_column), text_or_empty(F.col(url_column)).alias("url"), host.alias("host"), path.alias("path")
    ).withColumn("by_rule", longest_rule(rules, F.col("host"), F.col("path")))
    known = rows.filter("by_rule is not null").select("url", (F.col("by_rule.verdict") == "allow").alias("accepted"))
    aside = F.crc32("url") % 5 == 0
    ratios = stored(ratio_table(known.filter(~aside)), "url-ratios")
    scored = _scored(known.filter(aside), ratios)
    threshold = stored(calibrated_threshold(scored), "url-threshold")
    return _scored(rows, ratios).select(
        id_column,
        "host",
        "path",
        F.col("by_rule.rule").alias("rule"),
        F.coalesce(
            F.col("by_rule.verdict"), F.when(F.col("score") >= threshold.scalar(), "allow").otherwise("block")
        ).alias("verdict"),
        "score",
    )

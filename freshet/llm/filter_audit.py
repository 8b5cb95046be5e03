"""How filters of a cleaning step interact: what each removes, in every order.

Each document gets a mask of the filters that it fails, as columns; masks are counted per part and label. One small table
per part, of at most two to the number of filters rows, then becomes a decision diagram: one level per filter, equal
subdiagrams shared, every node weighted with the counts below it. The way on which every filter is passed shows the steps
of an order. Neighbouring orders differ by a swap of two adjacent levels, which rebuilds these two levels only.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from math import factorial

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.llm.columns import text_or_empty
from freshet.session import stored

WORD = r"([^\x20\x09-\x0D]+)"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
Weight = tuple[int, int, int]
ZERO: Weight = (0, 0, 0)
STEPS = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def text_failures(text: Column, words: Column) -> dict[str, Column]:
    """Failure conditions of a text and its words, by the filter's letter."""
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * capitals > 10 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def _added(*weights: Weight) -> Weight:
    return tuple(map(sum, zip(*weights)))


class Diagram:
    """A reduced, ordered decision diagram from masks to counts (documents, good ones, toxic ones).

    A node is (passing side, failing side) and stands once per level however many ways lead to it; the last level's sides
    are weights. ``order`` names the filter of each level.
    """

    def __init__(self, counts: Mapping[int, Weight], letters: str) -> None:
        self.order = list(letters)
        self.nodes: list[list[tuple]] = [[] for _ in letters]
        self.number: list[dict[tuple, int]] = [{} for _ in letters]
        self.weights: list[dict[int, Weight]] = [{} for _ in letters]
        self.root = self._built(0, 0, counts)

    def _node(self, level: int, low: object, high: object) -> int:
        place = self.number[level].setdefault((low, high), len(self.nodes[level]))
        if place == len(self.nodes[level]):
            self.nodes[level].append((low, high))
        return place

    def _built(self, level: int, mask: int, counts: Mapping[int, Weight]) -> object:
        if level == len(self.order):
            return counts.get(mask, ZERO)
        low = self._built(level + 1, mask, counts)
        return self._node(level, low, self._built(level + 1, mask | 1 << level, counts))

    def weight(self, level: int, node: object) -> Weight:
        """All that is counted below a node."""
        if level == len(self.order):
            return node
        if node not in self.weights[level]:
            self.weights[level][node] = _added(*(self.weight(level + 1, side) for side in self.nodes[level][node]))
        return self.weights[level][node]

    def swap(self, level: int) -> None:
        """Exchange the levels ``level`` and ``level + 1``. Nodes of the upper one keep their place, so nothing above
        changes; nothing below the two does either."""
        upper, lower = self.nodes[level], self.nodes[level + 1]
        self.nodes[level], self.number[level] = [], {}
        self.nodes[level + 1], self.number[level + 1], self.weights[level + 1] = [], {}, {}
        for low, high in upper:
            (ll, lh), (hl, hh) = lower[low], lower[high]
            self.nodes[level].append((self._node(level + 1, ll, hl), self._node(level + 1, lh, hh)))
        self.number[level] = {pair: i for i, pair in enumerate(self.nodes[level])}
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> Iterator[tuple[str, Weight, Weight]]:
        """Along the way that passes every filter: (letter, kept, removed)."""
        node = self.root
        for level, letter in enumerate(self.order):
            low, high = self.nodes[level][node]
            yield letter, self.weight(level + 1, low), self.weight(level + 1, high)
            node = low


def adjacent_swaps(n: int) -> Iterator[int]:
    """The places to swap, one after the other, so that all orders of ``n`` things come up once: the largest thing walks
    through each order of the others."""
    if n < 2:
        return
    inner = adjacent_swaps(n - 1)
    down = True
    for _ in range(factorial(n - 1)):
        yield from reversed(range(n - 1)) if down else range(n - 1)
        step = next(inner, None)
        if step is not None:
            yield step + 1 if down else step
        down = not down


def order_steps(counts: Mapping[int, Weight], letters: str) -> Iterator[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of every order and step."""
    diagram = Diagram(counts, letters)
    fails = {x: sum(w[0] for m, w in counts.items() if m >> i & 1) for i, x in enumerate(letters)}
    alone = {x: counts.get(1 << i, ZERO)[0] for i, x in enumerate(letters)}
    orders = [("".join(diagram.order), list(diagram.steps()))]
    for place in adjacent_swaps(len(letters)):
        diagram.swap(place)
        orders.append(("".join(diagram.order), list(diagram.steps())))
    shapley = dict.fromkeys(letters, 0)
    for _, steps in orders:
        for letter, _, removed in steps:
            shapley[letter] += removed[0]
    for order, steps in orders:
        for i, (x, kept, removed) in enumerate(steps, 1):
            yield order, i, kept[0], removed[0], fails[x] - removed[0], alone[x], removed[1], removed[2], shapley[x]


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents per part and failure mask; bit i of the mask is the i-th of ABCDE.

    A null text is empty, a null lang the empty part. E compares whole texts by SHA-256; a null id is smaller than none
    and none is smaller than it, and rows with one id do not fail by each other. A document is good (toxic) when any of
    its labels says 1; a null label says nothing. Other columns are not read.

    Rows that agree in all that counts are added up before they move, and so are copies per part and label: a text that a
    third of the rows share is a row per part and label when its first id is sought.
    """
    text = text_or_empty(F.col("text"))
    base = docs.select(
        F.col("doc_id").cast("long").alias("id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        text.alias("text"),
        F.regexp_extract_all(text, F.lit(WORD), 1).alias("words"),
    )
    bits = text_failures(F.col("text"), F.col("words")).values()
    mask = sum((F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(bits)), F.lit(0))
    rows = base.select("id", "part", F.sha2("text", 256).alias("name"), mask.alias("mask"))
    rows = rows.groupBy("id", "part", "name", "mask").agg(F.count(F.lit(1)).alias("n"))
    marks = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("good"),
        F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic"),
    )
    marked = rows.join(marks, "id", "left").fillna(0, ["good", "toxic"])
    copies = stored(
        marked.groupBy("name", "mask", "part", "good", "toxic").agg(
            F.sum("n").alias("n"),
            F.min("id").alias("first"),
            F.min_by("n", "id").alias("n_first"),
            F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("unnamed"),
        ),
        "audit-copies",
    )
    firsts = copies.groupBy("name").agg(F.min("first").alias("least"))
    found = copies.join(firsts, "name")
    stays = F.col("unnamed") + F.when(F.col("first") == F.col("least"), F.col("n_first")).otherwise(0)
    sides = F.array(
        F.struct(F.col("mask"), stays.alias("n")),
        F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - stays).alias("n")),
    )
    return (
        found.select("part", "good", "toxic", F.inline(sides).alias("mask", "n"))
        .groupBy("part", "mask")
        .agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))
        .filter("n > 0")
    )


def audited(counts: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """One row per part, order of the filters and step, from (part, mask, n, good, toxic); zeros included.

    A part's table has at most two to the number of filters rows, so that it fits one task. No rows give no parts.
    """

    def steps(rows: pd.DataFrame) -> pd.DataFrame:
        found = {r.mask: (int(r.n), int(r.good), int(r.toxic)) for r in rows.itertuples()}
        part = rows["part"].iloc[0]
        names = [c.split(" ")[0] for c in STEPS.split(", ")]
        return pd.DataFrame([(part, *row) for row in order_steps(found, letters)], columns=names)

    return counts.groupBy("part").applyInPandas(steps, STEPS)

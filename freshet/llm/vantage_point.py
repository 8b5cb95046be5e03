"""Nearest neighbours by a vantage-point tree per shard.

Rows are dealt to shards of a bounded size by a hash of their id, each shard gets one tree, and the trees are written to
the shared folder. The queries go to every shard in blocks of a bounded size; each (shard, block) pair is one task's
work and yields the block's best ``k`` of that shard; a last step ranks ``k`` rows per shard and query.

A node splits its rows in two equal halves by their distance from a vantage point and knows the least and the greatest
distance in each half. By the triangle inequality no row of a half is nearer to a query than the gap between the
query's own distance and that range. A half is skipped when ``factor`` times the gap exceeds the k-th best distance so
far: with factor one the search is exact, larger factors skip more. Halves are cut by rank, so equal vectors split as
well as any others.
"""

from __future__ import annotations

import io
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from freshet.session import stored

LEAF = 64


class Tree:
    """Vectors in tree order; nodes as parallel arrays in the order of a walk: first, last, vantage point, ranges."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, nodes: np.ndarray, ranges: np.ndarray) -> None:
        self.ids, self.vectors, self.nodes, self.ranges = ids, vectors, nodes, ranges
        self.squares = np.einsum("ij,ij->i", vectors, vectors)

    @classmethod
    def built(cls, ids: np.ndarray, vectors: np.ndarray) -> "Tree":
        order = np.argsort(ids, kind="stable")
        nodes: list[list[int]] = []
        ranges: list[list[float]] = []
        waiting = [(0, len(ids), -1, 0)]
        while waiting:
            first, last, parent, side = waiting.pop()
            number = len(nodes)
            nodes.append([first, last, -1, -1, -1])
            ranges.append([0.0, 0.0, 0.0, 0.0])
            if parent >= 0:
                nodes[parent][2 + side] = number
            if last - first <= LEAF:
                continue
            own = order[first:last]
            # The row farthest from the middle sees the others at widely differing distances.
            middle = vectors[own].mean(axis=0)
            point = own[np.argmax(((vectors[own] - middle) ** 2).sum(axis=1))]
            gaps = np.sqrt(((vectors[own] - vectors[point]) ** 2).sum(axis=1))
            by_gap = np.argsort(gaps, kind="stable")
            order[first:last], gaps = own[by_gap], gaps[by_gap]
            half = (last - first) // 2
            nodes[number][4] = point
            ranges[number] = [gaps[0], gaps[half - 1], gaps[half], gaps[-1]]
            waiting += [(first, first + half, number, 0), (first + half, last, number, 1)]
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        table = np.array(nodes, np.int64).reshape(-1, 5)
        inner = table[:, 4] >= 0
        table[inner, 4] = place[table[inner, 4]]
        return cls(ids[order], vectors[order], table, np.array(ranges).reshape(-1, 4))

    def dumped(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, ids=self.ids, vectors=self.vectors.astype(np.float64), nodes=self.nodes, ranges=self.ranges)
        return out.getvalue()

    @classmethod
    def loaded(cls, data: bytes) -> "Tree":
        with np.load(io.BytesIO(data)) as z:
            return cls(z["ids"], z["vectors"], z["nodes"], z["ranges"])

    def nearest(self, own: np.ndarray, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of each query's best ``k`` other rows, ties to smaller ids; missing ones are -1, inf."""
        best = np.full((len(queries), k), np.inf)
        names = np.full((len(queries), k), -1, np.int64)
        squares = np.einsum("ij,ij->i", queries, queries)

        def leaf(node: int, active: np.ndarray) -> None:
            first, last = self.nodes[node, :2]
            rows = self.vectors[first:last]
            rough = squares[active, None] + self.squares[first:last] - 2 * queries[active] @ rows.T
            slack = 1e-9 * (squares[active, None] + self.squares[first:last])
            near = (rough - slack <= best[active, -1:] ** 2) & (self.ids[first:last] != own[active, None])
            for at in np.flatnonzero(near.any(axis=1)):
                q, cols = active[at], np.flatnonzero(near[at])
                # Summed from the first component to the last, as the definition says.
                exact = np.sqrt(np.cumsum((rows[cols] - queries[q]) ** 2, axis=1)[:, -1])
                d, i = np.append(best[q], exact), np.append(names[q], self.ids[first + cols])
                top = np.lexsort((i, d))[:k]
                best[q], names[q] = d[top], i[top]

        def visit(node: int, active: np.ndarray) -> None:
            _, _, left, right, point = self.nodes[node]
            if point < 0:
                leaf(node, active)
                return
            gap = np.sqrt(((queries[active] - self.vectors[point]) ** 2).sum(axis=1))
            low_l, high_l, low_r, high_r = self.ranges[node]
            bound = {
                left: np.maximum(np.maximum(low_l - gap, gap - high_l), 0),
                right: np.maximum(np.maximum(low_r - gap, gap - high_r), 0),
            }
            nearer_left = bound[left] <= bound[right]
            for first, second, mine in ((left, right, nearer_left), (right, left, ~nearer_left)):
                for child in (first, second):
                    reach = best[active, -1] * (1 + 1e-12) + 1e-12
                    ask = active[mine & (factor * bound[child] <= reach)]
                    if len(ask):
                        visit(child, ask)

        if len(self.ids) and len(queries):
            visit(0, np.arange(len(queries)))
        return names, best


def usable(vector: Column) -> Column:
    """Not null, not empty, no null or non-finite component, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64)


def trees(rows: DataFrame, shards: int) -> DataFrame:
    """(shard, tree) from (id, vector); written to the shared folder."""

    def build(group: pd.DataFrame) -> pd.DataFrame:
        tree = Tree.built(group["id"].to_numpy(np.int64), _matrix(group["vector"]))
        return pd.DataFrame({"shard": [group["shard"].iloc[0]], "tree": [tree.dumped()]})

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    return stored(dealt.groupBy("shard").applyInPandas(build, "shard int, tree binary"), "trees")


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    factor: float = 1.0,
    shard_rows: int = 20_000,
    block_queries: int = 4_096,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """The ``k`` nearest other rows of each query row: (query_id, rank, vec_id, score), score the Euclidean distance.

    Vectors that are not :func:`usable` take no part on either side, nor do rows without an id; vectors of several
    lengths are an error. A repeated id counts once per row as a candidate, never for its own query; a query row that is
    there twice is asked once. Equal distances go
    to the smaller id. Fewer than ``k`` candidates give fewer rows; none, or no query, gives no rows.
    """
    rows = (
        vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vector"),
                       is_query.alias("asks"))
        .filter(F.col("id").isNotNull() & usable(F.col("vector")))
    )
    n, asking = rows.agg(F.count("*"), F.count_if("asks")).first()
    shards, blocks = max(1, math.ceil(n / shard_rows)), max(1, math.ceil(asking / block_queries))
    index = trees(rows.select("id", "vector"), shards)
    # Equal query rows are one query; rows with one id and different vectors are told apart by a hash of the vector.
    asked = rows.filter("asks").withColumn("name", F.xxhash64("vector")).dropDuplicates(["id", "name"])
    asked = asked.select("id", "name", "vector", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int").alias("block"))
    asked = asked.select("*", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    index = index.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))

    def search(tree: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if tree.empty or queries.empty:
            return pd.DataFrame({"query_id": [], "name": [], "vec_id": [], "score": []})
        own = queries["id"].to_numpy(np.int64)
        names, gaps = Tree.loaded(tree["tree"].iloc[0]).nearest(own, _matrix(queries["vector"]), k, factor)
        found = np.isfinite(gaps)
        hits = found.sum(axis=1)
        name = np.repeat(queries["name"].to_numpy(np.int64), hits)
        return pd.DataFrame({"query_id": np.repeat(own, hits), "name": name, "vec_id": names[found], "score": gaps[found]})

    partial = (
        index.groupBy("shard", "block")
        .cogroup(asked.groupBy("shard", "block"))
        .applyInPandas(search, "query_id long, name long, vec_id long, score double")
    )
    best = Window.partitionBy("query_id", "name").orderBy("score", "vec_id")
    return (
        partial.withColumn("rank", F.row_number().over(best).cast("int"))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )

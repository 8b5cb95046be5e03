"""Jaccard join of word shingles over a count-vector R-tree.

Texts with equal shingle sets are one node, so copies cost nothing further. Shingles are hashed into groups, two to four
shingles to a group from ``GROUPS`` groups on, so that the counts of a long text tell as much as those of a short one; a
node's counts per group are a point. Two sets share at most the sum over groups of the lesser count, and a similarity of
0.8 needs an overlap of 4/9 of both sizes together: an R-tree over the points, bounding a box by the minima with its upper
corner, leaves only pairs that may be similar. These are verified on the whole sets. The number of groups is a power of
two by the set's size; similar sets have the same or neighbouring ones, and adding up neighbours halves a point's width.

What brings points together is the prefix rule: under one order of all shingles, sets as similar as this share one of their
first ``n - ceil(0.8 n) + 1``. The order is rarest first by a count sketch of fixed size, then by hash; any order is
exact, this one keeps common passages out of the prefixes. Sets with a common prefix shingle form a bucket, and buckets
are worked off in two rounds. Round one gives a node at most two partners, the bucket's first and its predecessor by size
in most of its buckets, and verifies what the points leave of these. Round two takes the buckets that still hold several
components and joins them over R-trees; boxes that lie in one component are skipped. Buckets of more than ``BLOCK``
members are cut in blocks, and pairs of blocks are separate work.

No pairs leave a task in round two. Nodes are dealt to tiles of about ``TILE`` shingles by the largest bucket they are in,
so near copies lie in few tiles; the R-trees name the pairs of tiles that hold surviving pairs, each such pair of tiles
meets once with its whole sets, and its task emits only links that join two components: fewer than it has members.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from freshet.llm.columns import numbered, text_or_empty
from freshet.llm.components import components
from freshet.llm.shingles import slices, sort_within
from freshet.session import released, shuffle_files_removed, stored, stored_alone

GROUPS = 64
#: Cells of the sketch, by the low 16 bits of a hash.
SKETCH = 1 << 16
BLOCK = 4_096
LEAF = 32
#: Shingles of a tile (8 bytes each); a longer text is a tile or the most of one.
TILE = 1 << 17
#: Node ids of candidates (8 bytes each) are sent to all executors up to this number, and shuffled beyond it.
SMALL_ROWS = 1_000_000
SIGNED = np.int64


def _sketch(rows: DataFrame) -> np.ndarray:
    """How many texts hold a shingle of each hash bucket; 65,536 numbers whatever the input."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SKETCH, np.int64)
        for _, _, hashes in slices(batches):
            total += np.bincount((hashes & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
        held = np.flatnonzero(total)
        yield pa.record_batch([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    found = rows.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    table = np.zeros(SKETCH, np.int64)
    for bucket, n in found.collect():
        table[bucket] = n
    return table


def _points(rows: DataFrame, sketch: np.ndarray) -> DataFrame:
    """(id, unnamed, n, sig, vec, keys) per row: size, digest and group counts of the shingle set, and its prefix."""

    rank = np.argsort(np.argsort(sketch, kind="stable"), kind="stable").astype(np.uint64)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, owner, hashes in slices(batches):
            count = piece.num_rows
            n = np.bincount(owner, minlength=count)
            ends = np.cumsum(n)
            width = widths(n)
            before = np.append(0, np.cumsum(width))
            shift = (64 - np.log2(width).astype(np.int64)).astype(np.uint64)
            groups = before[owner] + (hashes >> shift[owner]).astype(np.int64)
            counts = np.bincount(groups, minlength=before[-1])
            vec = [packed(counts[i:j]) for i, j in zip(before, before[1:])]
            signed = hashes.view(SIGNED)
            sig = [hashlib.blake2b(signed[e - m : e].tobytes(), digest_size=16).digest() for e, m in zip(ends, n)]
            prefix = n - (4 * n + 4) // 5 + (n > 0)
            # The cell's rank in place of its number: the order is by this, and no two shingles become one.
            ordered = (rank[(hashes & np.uint64(SKETCH - 1)).astype(np.int64)] << np.uint64(48)) | (hashes >> np.uint64(16))
            sort_within(ordered, n)
            first = np.arange(len(owner)) - np.repeat(ends - n, n) < prefix[owner]
            keys = pa.ListArray.from_arrays(
                pa.array(np.append(0, np.cumsum(prefix)), pa.int32()), pa.array(ordered.view(SIGNED)[first])
            )
            columns = [piece["id"], piece["unnamed"], pa.array(n), pa.array(sig), pa.array(vec, pa.binary()), keys]
            yield pa.record_batch(columns, names=["id", "unnamed", "n", "sig", "vec", "keys"])

    return rows.mapInArrow(make, "id long, unnamed boolean, n long, sig binary, vec binary, keys array<long>")


def widths(n: np.ndarray) -> np.ndarray:
    """How many groups a set of n shingles has."""
    half = np.log2(np.maximum(n, 2)).astype(np.int64) - 1
    return np.maximum(GROUPS, 1 << half)


def packed(counts: np.ndarray) -> bytes:
    """Counts in a byte each; where one does not fit, all are 255, which bounds any overlap."""
    return (counts if counts.max(initial=0) <= 255 else np.full(len(counts), 255)).astype(np.uint8).tobytes()


def folded(points: np.ndarray, width: int) -> np.ndarray:
    """Points with neighbouring groups added up until there are ``width``."""
    while points.shape[-1] > width:
        points = points[..., ::2].astype(np.uint16) + points[..., 1::2]
    return points


def _bounded(pairs: DataFrame, points: DataFrame) -> DataFrame:
    """Pairs (a, b) whose overlap, bounded by summed minima, may reach 4/9 of both sizes."""

    def keep(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            able = np.zeros(len(f), bool)
            for i, (a, b, both) in enumerate(zip(f["vec_a"], f["vec_b"], (f["n_a"] + f["n_b"]).tolist())):
                x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
                width = min(len(x), len(y))
                able[i] = 9 * int(np.minimum(folded(x, width), folded(y, width)).sum(dtype=np.int64)) >= 4 * both
            yield f.loc[able, ["a", "b"]]

    own = points.select("node", "n", "vec")
    a, b = (own.select(*[F.col(c).alias(x if c == "node" else f"{c}_{x}") for c in own.columns]) for x in "ab")
    return pairs.join(a, "a").join(b, "b").mapInPandas(keep, "a long, b long")


def _sets(nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """(id, shingles) of every row whose id is in ``nodes`` (id, distinct): its whole set, 8 bytes a shingle, sorted."""
    if nodes.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS:
        nodes = F.broadcast(nodes)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, owner, hashes in slices(batches):
            bounds = np.searchsorted(owner, np.arange(piece.num_rows + 1))
            held = [hashes[i:j].tobytes() for i, j in zip(bounds, bounds[1:])]
            yield pa.record_batch([piece["id"], pa.array(held, pa.binary())], names=["id", "shingles"])

    return rows.join(nodes, "id", "left_semi").mapInArrow(sets, "id long, shingles binary").filter("length(shingles) > 0")


def similar(common: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether 100 * intersection >= 80 * union, by the intersection and the sum of both sizes."""
    return 100 * common >= 80 * (sizes - common)


def _verified(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar by their whole shingle sets, as a written table; at most two pairs a node."""
    return stored_alone(lambda: _on_whole_sets(pairs, rows), "near-links")


def _on_whole_sets(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    def keep(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            able = np.zeros(len(f), bool)
            for i, (a, b) in enumerate(zip(f["set_a"], f["set_b"])):
                x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                able[i] = similar(len(np.intersect1d(x, y, assume_unique=True)), len(x) + len(y))
            yield f.loc[able, ["a", "b"]]

    nodes = stored(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "near-nodes")
    held = stored(_sets(nodes, rows), "near-sets")
    a, b = (held.select(F.col("id").alias(x), F.col("shingles").alias(f"set_{x}")) for x in "ab")
    return pairs.join(a, "a").join(b, "b").mapInPandas(keep, "a long, b long").distinct()


def _by_work(step: Callable[[pd.DataFrame], pd.DataFrame]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Frames sorted by ``work`` go to ``step`` in whole works; of the last one the rest may be in the next frame."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            last = frame["work"] == frame["work"].iloc[-1] if len(frame) else np.zeros(0, bool)
            rest = frame[last]
            yield step(frame[~last])
        if rest is not None:
            yield step(rest)

    return run


def _works(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
    work = frame["work"].to_numpy()
    edges = [0, *(np.flatnonzero(work[1:] != work[:-1]) + 1).tolist(), len(work)]
    return (frame.iloc[i:j] for i, j in zip(edges, edges[1:]) if i < j)


class Tree:
    """An R-tree over count vectors: boxes by their upper corner, least size and, where there is only one, component."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, parts: np.ndarray, rows: np.ndarray) -> None:
        self.points, self.sizes, self.parts, self.rows = points, sizes, parts, rows
        self.root = self._node(np.arange(len(points)))

    def _node(self, own: np.ndarray) -> tuple:
        points, parts = self.points[own], self.parts[own]
        part = parts[0] if (parts == parts[0]).all() else -1
        children = []
        if len(own) > LEAF:
            low, high = points.min(axis=0), points.max(axis=0)
            axis = int(np.argmax(high - low))
            order = np.argsort(points[:, axis], kind="stable")
            half = len(own) // 2
            children = [self._node(own[order[:half]]), self._node(own[order[half:]])]
        return points.max(axis=0), int(self.sizes[own].min()), part, children, own

    def pairs(self, other: "Tree") -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows of this tree and of the other that may be similar and lie in different components."""
        waiting = [(self.root, other.root)]
        while waiting:
            x, y = waiting.pop()
            if x[2] == y[2] != -1 or 9 * int(np.minimum(x[0], y[0]).sum(dtype=np.int64)) < 4 * (x[1] + y[1]):
                continue
            if x[3] or y[3]:
                waiting += [(a, b) for a in x[3] or [x] for b in y[3] or [y]]
                continue
            most = np.minimum(self.points[x[4]][:, None], other.points[y[4]]).sum(axis=2, dtype=np.int32)
            able = 9 * most >= 4 * (self.sizes[x[4]][:, None] + other.sizes[y[4]])
            able &= self.parts[x[4]][:, None] != other.parts[y[4]]
            i, j = np.nonzero(able)
            if len(i):
                yield x[4][i], y[4][j]


def _leaf_pairs(sizes: np.ndarray, parts: np.ndarray, vec: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows i < j that may be similar and lie in different components; few rows, as of one leaf."""
    able = (parts[:, None] != parts) & (5 * np.minimum(sizes[:, None], sizes) >= 4 * np.maximum(sizes[:, None], sizes))
    found = []
    for i, j in zip(*np.nonzero(np.triu(able))):
        x, y = np.frombuffer(vec[i], np.uint8), np.frombuffer(vec[j], np.uint8)
        width = min(len(x), len(y))
        most = int(np.minimum(folded(x, width), folded(y, width)).sum(dtype=np.int64))
        if 9 * most >= 4 * int(sizes[i] + sizes[j]):
            found.append((i, j))
    found = np.array(found, np.int64).reshape(-1, 2)
    return found[:, 0], found[:, 1]


def _work_pairs(tiles: np.ndarray, sizes: np.ndarray, parts: np.ndarray, block: np.ndarray, vec: np.ndarray) -> np.ndarray:
    """Pairs of tiles (a row each, the lesser first) between which one (bucket, block, block) leaves pairs."""
    if (parts == parts[0]).all():
        return np.zeros((0, 2), np.int64)

    def of(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return np.unique(np.sort(np.stack([tiles[i], tiles[j]], axis=1), axis=1), axis=0)

    if len(tiles) <= LEAF:
        return of(*_leaf_pairs(sizes, parts, vec))
    width = np.fromiter(map(len, vec), np.int64, len(vec))
    trees: dict[tuple, Tree | None] = {}

    def tree(side: int, own: int, to: int) -> Tree | None:
        if (side, own, to) not in trees:
            rows = np.flatnonzero((block == side) & (width == own))
            points = np.frombuffer(b"".join(vec[rows]), np.uint8).reshape(len(rows), -1) if len(rows) else None
            trees[side, own, to] = Tree(folded(points, to), sizes[rows], parts[rows], rows) if len(rows) else None
        return trees[side, own, to]

    low, high = int(block.min()), int(block.max())
    found = [np.zeros((0, 2), np.int64)]
    for w in np.unique(width).tolist():
        # Equal widths, and those of which one is double the other.
        for v, u in {(w, w), (w, 2 * w)} | ({(2 * w, w)} if low < high else set()):
            x, y = tree(low, v, w), tree(high, u, w)
            if x and y:
                found += [of(x.rows[i], y.rows[j]) for i, j in x.pairs(y)]
    return np.unique(np.concatenate(found), axis=0)


def tile_links(nodes: np.ndarray, parts: np.ndarray, tiles: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that join two components, between two tiles or within one; whole sets (distinct values) tell."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    ends = np.cumsum(sizes)
    _, own = np.unique(np.concatenate(sets), return_inverse=True)
    place = [own[e - n : e] for e, n in zip(ends.tolist(), sizes.tolist())]
    held = np.zeros(own.max() + 1, np.int64)
    alone = len(np.unique(tiles)) == 1
    root, found = parts.copy(), []
    for i in range(len(sets) - 1):
        able = (root != root[i]) & (5 * np.minimum(sizes, sizes[i]) >= 4 * np.maximum(sizes, sizes[i]))
        able[: i + 1] = False
        if not alone:
            able &= tiles != tiles[i]
        others = np.flatnonzero(able)
        if not len(others):
            continue
        held[place[i]] = 1
        starts = np.append(0, np.cumsum(sizes[others])[:-1])
        common = np.add.reduceat(held[np.concatenate([place[j] for j in others])], starts)
        held[place[i]] = 0
        for j in others[similar(common, sizes[others] + sizes[i])].tolist():
            if root[j] != root[i]:
                root[root == root[j]] = root[i]
                found.append((int(nodes[i]), int(nodes[j])))
    return found


def _round_two(buckets: DataFrame, points: DataFrame, found: DataFrame, rows: DataFrame) -> DataFrame:
    """Links (a, b) from buckets of several components."""
    member = (
        buckets.select("key", "node", "n", "members", "place")
        .join(found.select("node", "component"), "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    mixed = member.groupBy("key").agg(
        F.min("component").alias("lo"),
        F.max("component").alias("hi"),
        F.count("*").alias("k"),
        F.min("n").alias("least"),
        F.max("n").alias("most"),
        F.bit_xor(F.xxhash64("node")).alias("x"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"),
    )
    mixed = mixed.filter("lo < hi and (k > 2 or 5 * least >= 4 * most)")
    # Buckets with the same members, as the shingles of one passage make them, are the same work.
    mixed = mixed.groupBy("lo", "hi", "k", "x", "y").agg(F.min("key").alias("key"))
    member = stored(member.join(mixed.select("key"), "key", "left_semi"), "near-mixed")
    tiles = stored(_tiles(member), "near-tiles")
    pairs = stored(_tile_pairs(member, points, tiles), "near-pairs")
    released(member)
    asked = pairs.select(F.explode(F.array("a", "b")).alias("tile")).distinct()
    tiles = stored(tiles.join(asked, "tile", "left_semi"), "near-tiles")
    nodes = tiles.select(F.col("node").alias("id"))
    held = stored(_sets(nodes, rows).join(tiles.withColumnRenamed("node", "id"), "id"), "near-sets")
    works = pairs.select(F.xxhash64("a", "b").alias("work"), F.explode(F.array_distinct(F.array("a", "b"))).alias("tile"))

    def links_of(frame: pd.DataFrame) -> pd.DataFrame:
        found = []
        for one in _works(frame):
            sets = [np.frombuffer(b, np.uint64) for b in one["shingles"]]
            found += tile_links(*(one[c].to_numpy() for c in ("id", "component", "tile")), sets)
        return pd.DataFrame(np.array(found, np.int64).reshape(-1, 2), columns=["a", "b"])

    dealt = works.join(held, "tile").select("work", "tile", "id", "component", "shingles")
    # A pair of tiles is bounded; sorting puts it side by side.
    return dealt.repartition("work").sortWithinPartitions("work").mapInPandas(_by_work(links_of), "a long, b long").distinct()


def _tiles(member: DataFrame) -> DataFrame:
    """(node, component, tile): the largest bucket a node is in, cut by a hash of the node where it is more than a tile."""
    home = member.groupBy("node").agg(
        F.max(F.struct("members", "key")).alias("home"), F.max("n").alias("n"), F.max("component").alias("component")
    ).select("node", "component", "n", F.col("home.key").alias("home"))
    parts = home.groupBy("home").agg(F.ceil(F.sum("n") / TILE).alias("parts"))
    part = F.pmod(F.xxhash64("node", F.lit(2)), "parts")
    return home.join(parts, "home").select("node", "component", F.xxhash64("home", part).alias("tile"))


def _tile_pairs(member: DataFrame, points: DataFrame, tiles: DataFrame) -> DataFrame:
    """Distinct pairs of tiles (a, b) that some bucket's R-trees leave, the lesser first."""
    member = member.join(points.select("node", "n", "vec"), ["node", "n"]).join(tiles.select("node", "tile"), "node")
    member = member.withColumn("block", F.floor((F.col("place") - 1) / BLOCK).cast("int"))
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    dealt = member.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))).select(
        F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("work"),
        "tile", "n", "vec", "component", "block",
    )

    def pairs_of(frame: pd.DataFrame) -> pd.DataFrame:
        found = [
            _work_pairs(*(one[c].to_numpy() for c in ("tile", "n", "component", "block", "vec"))) for one in _works(frame)
        ]
        pairs = np.unique(np.concatenate([np.zeros((0, 2), np.int64), *found]), axis=0)
        return pd.DataFrame(pairs, columns=["a", "b"])

    # A bucket's work is bounded by two blocks; sorting puts it side by side.
    return dealt.repartition("work").sortWithinPartitions("work").mapInPandas(_by_work(pairs_of), "a long, b long").distinct()


def jaccard_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Each row's (id, n_shingles, component_id): the size of its set and the smallest id reachable by links.

    Null, empty and wordless texts have no shingles and are linked with nothing. Rows with one id are one document: a
    link of either counts for both. Rows without an id are documents by their texts, linked like others; they come last,
    so ``component_id`` is null only where no row of the component has an id. Other columns are not read; no rows give no
    rows.
    """
    found = _keyed_groups(docs, id_column, text_column)
    if not _has_null_id(docs, id_column):
        return found.select(F.col("id").alias(id_column), "n_shingles", F.col("component").alias("component_id"))
    found = stored(found, "near-groups")
    named = found.filter("not unnamed").groupBy("component").agg(F.min("id").alias("component_id"))
    return found.join(named, "component", "left").select(
        F.when(~F.col("unnamed"), F.col("id")).alias(id_column), "n_shingles", "component_id"
    )


def _has_null_id(docs: DataFrame, id_column: str) -> bool:
    return not docs.filter(F.col(id_column).isNull()).select(id_column).limit(1).isEmpty()


def _key(id_column: str, text_column: str) -> Column:
    """A row's id, or a hash of its text where it has none."""
    return F.coalesce(F.col(id_column).cast("long"), F.xxhash64(F.lit("no id"), text_or_empty(F.col(text_column))))


def _keyed_groups(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, unnamed, n_shingles, component) of each row, by the keys of ``_key``; ``unnamed`` rows have no id."""
    with shuffle_files_removed(docs.sparkSession):
        return _grouped(docs, id_column, text_column)


def _grouped(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    rows = docs.select(
        _key(id_column, text_column).alias("id"),
        F.col(id_column).isNull().alias("unnamed"),
        text_or_empty(F.col(text_column)).alias("text"),
    )
    table = stored(_points(rows, _sketch(rows)), "near-points")
    sets = table.filter("n > 0")
    least = F.min(F.struct("id", "n", "vec"))
    points = stored(
        sets.groupBy("sig").agg(least.alias("p")).select("sig", F.col("p.id").alias("node"), "p.n", "p.vec"), "near-reps"
    )
    prefixes = sets.groupBy("sig").agg(F.min(F.struct("id", "n", "keys")).alias("p"))
    keyed = prefixes.select(F.explode("p.keys").alias("key"), F.col("p.id").alias("node"), F.col("p.n").alias("n"))
    by_size = Window.partitionBy("key").orderBy("n", "node")
    buckets = stored(
        keyed.select(
            "key", "node", "n",
            F.count("*").over(Window.partitionBy("key")).alias("members"),
            F.row_number().over(by_size).alias("place"),
            F.first(F.struct("node", "n")).over(by_size).alias("head"),
            F.lag(F.struct("node", "n")).over(by_size).alias("before"),
        ).filter("members > 1"),
        "near-buckets",
    )
    near = buckets.select(F.posexplode(F.array("head", "before")).alias("kind", "x"), "node", "n")
    near = near.filter("x.node <> node and 5 * x.n >= 4 * n")  # x is not the larger one
    near = near.groupBy("node", "kind", F.col("x.node").alias("x")).agg(F.count("*").alias("k"))
    near = near.groupBy("node", "kind").agg(F.max(F.struct("k", "x")).alias("x"))
    near = near.select(F.least("x.x", "node").alias("a"), F.greatest("x.x", "node").alias("b")).distinct()
    near = stored(_bounded(near, points), "near-pairs")
    links = _verified(near, rows)
    released(near)
    # One id in several sets is one document.
    several = sets.join(points.select("sig", "node"), "sig").filter("id <> node").select(F.col("id").alias("a"), F.col("node").alias("b"))
    repeated = sets.groupBy("id").agg(F.count_distinct("sig").alias("k")).filter("k > 1").select(F.col("id").alias("a"))
    links = stored(links.unionByName(several.join(repeated, "a", "left_semi")), "near-links")
    first = stored_alone(lambda: components(links), "near-components")
    more = stored_alone(lambda: _round_two(buckets, points, first, rows), "near-links")
    released(buckets, first)
    found = stored_alone(lambda: components(links.unionByName(more)), "near-components")
    released(links, more)
    of_sig = points.join(found, "node", "left").select("sig", F.coalesce("component", "node").alias("component"))
    return (
        table.select("id", "unnamed", "n", "sig")
        .join(of_sig, "sig", "left")
        .select(
            "id",
            "unnamed",
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component"),
        )
    )


def first_of_each_group(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component; a row without an id only where none has one."""
    groups = _keyed_groups(docs, id_column, text_column)
    if not _has_null_id(docs, id_column):
        return docs.join(groups.filter("component = id").select(F.col("id").alias(id_column)).distinct(), id_column, "left_semi")
    first = groups.groupBy("component").agg(F.min(F.struct("unnamed", "id")).alias("first")).select("first.*")
    held, names = numbered(docs)
    own, text = names[id_column], names[text_column]
    keyed = held.withColumn("_key", _key(own, text)).withColumn("_unnamed", F.col(own).isNull())
    kept = keyed.join(first, (keyed["_key"] == first["id"]) & (keyed["_unnamed"] == first["unnamed"]), "left_semi")
    return kept.select(*[F.col(names[c]).alias(c) for c in docs.columns])

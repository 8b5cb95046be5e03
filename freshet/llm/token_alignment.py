"""Alignment of two tokenizers' tokens by the bytes that they cover.

Tokenizer A is a byte-level BPE over space+text, B a SentencePiece model over text, to which it adds a space. Places where
tokens of both end cut the tokens into groups; the two tokens that end at such a place are linked.

A byte range of a document yields a fragment: the tokens of both that end in it, split at its common ends into an open
prefix (up to and with the first common end, whose group may have begun earlier), closed groups, and an open suffix. A
range without a common end is all prefix. Two neighbouring fragments compose: the left suffix and the right prefix are one
group when the right one has a common end, else they stay open. This is associative, so fragments of a very long document
are made by many tasks and composed in a tree over Spark tasks; only open ends travel, closed groups stay where they
were found. A document of at most ``chunk_chars`` characters is one fragment.

A chunk reads a little text on both sides of its range, to the nearest place where neither tokenizer joins characters
(a space between two others); tokens belong to the chunk in which they end. A document without such places, or a model
that joins characters across them or rewrites its text, gives one fragment per document.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from freshet.llm.columns import text_or_empty
from freshet.llm.tokens import SPACE, ByteBpe, Pieces, byte_bpe, pieces_of
from freshet.session import stored

SLICE = 64
#: Pairs whose counts every task holds: at most so many, 12 bytes each. All others are joined.
COMMON_PAIRS = 1 << 18
BUFFERED_PAIRS = 1 << 20
ROWS = 512
PARTS = (
    "row long, doc_id long, chunk int, piece int, bad boolean, n_a long, n_b long, n_groups long, "
    "groups string, sha string, pairs binary, times binary"
)
END_NAMES = ["pre_a", "pre_a_end", "pre_b", "pre_b_end", "suf_a", "suf_a_end", "suf_b", "suf_b_end"]
PART_NAMES = [c.split(" ")[0] for c in PARTS.split(", ")]
FRAGMENTS = ", ".join([PARTS, "has_cut boolean", *(f"{c} binary" for c in END_NAMES)])


@dataclass(frozen=True)
class Tokens:
    """Ids of both tokenizers with the byte offsets at which they end."""

    a: np.ndarray
    a_end: np.ndarray
    b: np.ndarray
    b_end: np.ndarray

    def __add__(self, more: Tokens) -> Tokens:
        pairs = zip(self.columns(), more.columns())
        return Tokens(*(np.concatenate(p) for p in pairs))

    def columns(self) -> tuple[np.ndarray, ...]:
        return self.a, self.a_end, self.b, self.b_end

    def after(self, offset: int) -> Tokens:
        i, j = np.searchsorted(self.a_end, offset, "right"), np.searchsorted(self.b_end, offset, "right")
        return Tokens(self.a[i:], self.a_end[i:], self.b[j:], self.b_end[j:])

    def until(self, offset: int) -> Tokens:
        i, j = np.searchsorted(self.a_end, offset, "right"), np.searchsorted(self.b_end, offset, "right")
        return Tokens(self.a[:i], self.a_end[:i], self.b[:j], self.b_end[:j])

    def common(self) -> np.ndarray:
        """Offsets at which tokens of both end."""
        return self.a_end[np.isin(self.a_end, self.b_end, assume_unique=True, kind="sort")] if len(self.a) else self.a_end


NONE = Tokens(*(np.zeros(0, np.int64) for _ in range(4)))


@dataclass(frozen=True)
class Fragment:
    """``closed`` holds whole groups only. Without a common end (``cut`` false) all tokens are ``prefix``."""

    prefix: Tokens
    closed: tuple[Tokens, ...]
    suffix: Tokens
    cut: bool

    def __add__(self, right: Fragment) -> Fragment:
        if not right.cut:
            if not self.cut:
                return Fragment(self.prefix + right.prefix, (), NONE, False)
            return Fragment(self.prefix, self.closed, self.suffix + right.prefix, True)
        if not self.cut:
            return Fragment(self.prefix + right.prefix, right.closed, right.suffix, True)
        return Fragment(self.prefix, (*self.closed, self.suffix + right.prefix, *right.closed), right.suffix, True)


def fragment(tokens: Tokens, starts: bool) -> Fragment:
    """The fragment of a byte range; at the start of a document its first group is closed, the prefix empty."""
    ends = tokens.common()
    if not len(ends):
        return Fragment(NONE, (), tokens, True) if starts else Fragment(tokens, (), NONE, False)
    if starts:
        return Fragment(NONE, (tokens.until(ends[-1]),), tokens.after(ends[-1]), True)
    closed = tokens.after(ends[0]).until(ends[-1])
    return Fragment(tokens.until(ends[0]), (closed,) if len(closed.a) else (), tokens.after(ends[-1]), True)


class Aligner:
    """Both tokenizers of a worker, their tokens' bytes, and their ids as decimal text."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self.a: ByteBpe = byte_bpe(path_a, plain=True)
        self.b: Pieces = pieces_of(path_b)
        self.a_size = np.array([len(x) for x in self.a.bytes_of])
        self.b_size = np.array([len(x) for x in self.b.bytes_of])
        n, m = len(self.a_size), len(self.b_size)
        self.n_b = m
        self.pair = np.dtype("<u4" if n * m <= 1 << 32 else "<u8")
        ends = [[f"{i}{mark}" for i in range(size)] for size, mark in ((n, ","), (n, "|"), (m, ","), (m, ";"))]
        self.text = [x for some in ends for x in some]
        self.first = (0, n, 2 * n, 2 * n + m)

    def tokens(self, texts: list[str], starts: list[bool]) -> list[Tokens | None]:
        """Of each text the tokens, ends counted from its own first byte; a text that starts a document gets a space.

        None where the text is empty or B's pieces do not spell it.
        """
        spelled = [" " + t if s else t for t, s in zip(texts, starts)]
        in_a = self.a.encode(spelled)
        if plainly_normalised(self.b):
            normal = [t.replace(" ", SPACE) for t in spelled]
        else:
            normal = [self.b.normaliser(t)[0] for t in texts]
        in_b = self.b.plain.encode(normal, num_threads=1)
        found: list[Tokens | None] = []
        for text, spell, packed, b in zip(texts, spelled, in_a, in_b):
            if not text or b"".join(map(self.b.bytes_of.__getitem__, b)) != spell.encode():
                found.append(None)
                continue
            a, b = np.frombuffer(packed, self.a.kind).astype(np.int64), np.array(b, np.int64)
            found.append(Tokens(a, np.cumsum(self.a_size[a]), b, np.cumsum(self.b_size[b])))
        return found

    def spelled(self, t: Tokens, common: np.ndarray) -> str:
        """The groups of tokens that end together, as ``a1,a2|b1;a3|b2,b3`` and a last ``;``."""
        a_group, b_group = np.searchsorted(common, t.a_end), np.searchsorted(common, t.b_end)
        a_before, b_before = np.searchsorted(t.a_end, common, "right"), np.searchsorted(t.b_end, common, "right")
        codes = np.empty(len(t.a) + len(t.b), np.int64)
        closes_a, closes_b = common[a_group] == t.a_end, common[b_group] == t.b_end
        place_a = np.arange(len(t.a)) + np.concatenate([[0], b_before])[a_group]
        place_b = np.arange(len(t.b)) + a_before[b_group]
        codes[place_a] = t.a + np.where(closes_a, self.first[1], self.first[0])
        codes[place_b] = t.b + np.where(closes_b, self.first[3], self.first[2])
        return "".join(map(self.text.__getitem__, codes.tolist()))

    def links(self, t: Tokens, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The linked id pairs as one number each, and how often each occurs."""
        pairs = t.a[np.searchsorted(t.a_end, common)] * self.n_b + t.b[np.searchsorted(t.b_end, common)]
        return np.unique(pairs, return_counts=True)


def plainly_normalised(b: Pieces) -> bool:
    """Whether the model only puts a space before the text and marks spaces."""
    spec = b.normaliser.spec
    return not b.normaliser.trie and not spec.remove_extra_whitespaces and spec.add_dummy_prefix and spec.escape_whitespaces


@functools.lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


class _Parts:
    """Rows of PARTS as batches."""

    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), *[pa.int64()] * 3, pa.string(), pa.string(), *[pa.binary()] * 2]

    def __init__(self) -> None:
        self.rows: list[tuple] = []

    def put(self, both: Aligner, place: tuple, t: Tokens, whole: bool) -> None:
        """The closed groups ``t`` at (row, doc_id, chunk, piece); a whole document's text of groups is hashed at once."""
        if not len(t.a):
            self.rows.append((*place, False, 0, 0, 0, "", "", b"", b""))
            return
        common = t.common()
        text = both.spelled(t, common)
        pairs, times = both.links(t, common)
        sha = hashlib.sha256(text[:-1].encode()).hexdigest() if whole else ""
        packed = (pairs.astype(both.pair).tobytes(), times.astype("<u4").tobytes())
        self.rows.append((*place, False, len(t.a), len(t.b), int(times.sum()), "" if whole else text, sha, *packed))

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [()] * len(PART_NAMES)
        self.rows = []
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, self.kinds)], names=PART_NAMES)

    def batch_with(self, cut: list, ends: list[list]) -> pa.RecordBatch:
        """The rows with their open ends: one list per row, None for a row without."""
        done = self.batch()
        columns = list(zip(*(e or [None] * len(END_NAMES) for e in ends)))
        more = [pa.array(cut, pa.bool_()), *(pa.array(c, pa.binary()) for c in columns)]
        return pa.record_batch([*done.columns, *more], names=[*PART_NAMES, "has_cut", *END_NAMES])


def _short_parts(texts: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """PARTS of the documents that are one fragment."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, parts = aligner(path_a, path_b), _Parts()
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                some = batch.slice(at, SLICE)
                found = both.tokens(some["text"].to_pylist(), [True] * some.num_rows)
                for key, tokens in zip(some["id"].to_pylist(), found):
                    parts.put(both, (row, key, 0, 0), NONE if tokens is None else tokens, True)
                    row += 1
                yield parts.batch()

    return texts.mapInArrow(align, PARTS)


# A space that neither tokenizer joins with what stands before it, nor with a space after it.
CUT = re.compile(r"(?<=\S) (?=\S)")


def _ranges(text: str, chunk_chars: int) -> Iterator[tuple[int, int, int, int]]:
    """(begin, end, from, to) in characters: a chunk's range and the text it needs, from one safe place to another.

    A range ends wherever the count says, inside a word too. Where the text has no safe place for long, the ranges that
    one stretch covers are one range.
    """
    begin, opened = 0, 0
    while begin < len(text):
        end = min(begin + chunk_chars, len(text))
        cut = CUT.search(text, end) if end < len(text) else None
        to = cut.start() if cut else len(text)
        if to - end > chunk_chars:
            end = to
        yield begin, end, opened, to
        if end < len(text):
            back = max(opened, end - chunk_chars)
            places = [m.start() for m in CUT.finditer(text, back, min(end + 2, len(text)))]
            places = [p for p in places if p <= end]
            opened = places[-1] if places else opened
        begin = end


def _chunked(texts: DataFrame, chunk_chars: int) -> DataFrame:
    """One row per byte range of a long document, with the text that it needs.

    ``lead`` is the byte offset of that text in space+text; tokens that end after ``keep_from`` up to ``keep_to`` are the
    range's own.
    """
    names = ["row", "doc_id", "chunk", "lead", "keep_from", "keep_to", "text"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string()]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = (TaskContext.get().partitionId() << 36) + (1 << 35)
        for batch in batches:
            for key, text in zip(batch["id"].to_pylist(), batch["text"].to_pylist()):
                lead, keep, before = 1, 0, 0
                for chunk, (begin, end, opened, to) in enumerate(_ranges(text, chunk_chars)):
                    lead += len(text[before:opened].encode())
                    before = opened
                    # The added space is the first byte of the first range.
                    upto = max(keep, 1) + len(text[begin:end].encode())
                    out = [row, key, chunk, lead if chunk else 0, keep, upto, text[opened:to]]
                    yield pa.record_batch([pa.array([v], k) for v, k in zip(out, kinds)], names=names)
                    keep = upto
                row += 1

    schema = "row long, doc_id long, chunk int, lead long, keep_from long, keep_to long, text string"
    return texts.mapInArrow(split, schema).repartition("row", "chunk")


def _packed(f: Fragment) -> list[bytes]:
    return [c.astype("<i8").tobytes() for c in (*f.prefix.columns(), *f.suffix.columns())]


def _unpacked(row: dict) -> Fragment:
    columns = [np.frombuffer(row[c], "<i8") for c in END_NAMES]
    return Fragment(Tokens(*columns[:4]), (), Tokens(*columns[4:]), row["has_cut"])


def _fragment_rows(chunks: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per range: its closed groups as in PARTS, and its open ends."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, parts = aligner(path_a, path_b), _Parts()
        for batch in batches:
            for r in batch.to_pylist():
                place, starts = (r["row"], r["doc_id"], r["chunk"], 0), r["chunk"] == 0
                tokens = both.tokens([r["text"]], [starts])[0]
                if tokens is None:
                    parts.rows.append((*place, True, 0, 0, 0, "", "", b"", b""))
                    found = Fragment(NONE, (), NONE, True)
                else:
                    lead = r["lead"]
                    tokens = Tokens(tokens.a, tokens.a_end + lead, tokens.b, tokens.b_end + lead)
                    found = fragment(tokens.after(r["keep_from"]).until(r["keep_to"]), starts)
                    parts.put(both, place, found.closed[0] if found.closed else NONE, False)
                yield parts.batch_with([found.cut], [_packed(found)])

    return chunks.mapInArrow(align, FRAGMENTS)


def _composed(ends: DataFrame, span: int, path_a: str, path_b: str) -> DataFrame:
    """The fragments of every ``span`` neighbouring ranges composed into one.

    Returns its open ends, named by its first range, and a row for each group that a seam closed. Such a row is named by
    the range right of the seam, with ``piece`` -1: it comes before that range's closed groups.
    """

    def compose(rows: pa.Table) -> pa.Table:
        both, parts = aligner(path_a, path_b), _Parts()
        frames = sorted(rows.to_pylist(), key=lambda r: r["chunk"])
        whole = _unpacked(frames[0])
        for r in frames[1:]:
            whole = whole + _unpacked(r)
            for seam in whole.closed:
                parts.put(both, (r["row"], r["doc_id"], r["chunk"], -1), seam, False)
            whole = Fragment(whole.prefix, (), whole.suffix, whole.cut)
        seams = len(parts.rows)
        parts.put(both, (frames[0]["row"], frames[0]["doc_id"], frames[0]["chunk"], 0), NONE, False)
        batch = parts.batch_with([None] * seams + [whole.cut], [None] * seams + [_packed(whole)])
        return pa.Table.from_batches([batch])

    needed = ends.filter("has_cut is not null").select("row", "doc_id", "chunk", "has_cut", *END_NAMES)
    return needed.groupBy("row", F.floor(F.col("chunk") / span).alias("span")).applyInArrow(compose, FRAGMENTS)


def _long_parts(texts: DataFrame, path_a: str, path_b: str, chunk_chars: int, fan_in: int) -> DataFrame:
    """PARTS of long documents: closed groups of their ranges, and groups closed where fragments were composed."""
    found = [stored(_fragment_rows(_chunked(texts, chunk_chars), path_a, path_b), "align-fragments")]
    most = found[0].agg(F.max("chunk")).first()[0] or 0
    span = 1
    while span <= most:
        span *= fan_in
        found.append(stored(_composed(found[-1], span, path_a, path_b), "align-composed"))
    parts = found[0].select(*PART_NAMES)
    for more in found[1:]:
        parts = parts.unionByName(more.select(*PART_NAMES))
    # One range that its pieces do not spell leaves the whole document without tokens.
    spelt = found[0].groupBy("row").agg(F.max("bad").alias("spoilt"))
    return parts.join(spelt, "row")


def _hashes(parts: DataFrame) -> DataFrame:
    """(row, sha) of the long documents: their parts' text hashed in order, a part at a time."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, sha, held = None, None, ""

        def out() -> pa.RecordBatch:
            sha.update(held[:-1].encode())
            columns = [pa.array([row], pa.int64()), pa.array([sha.hexdigest() if held else ""], pa.string())]
            return pa.record_batch(columns, names=["row", "sha"])

        for batch in batches:
            for number, text in zip(batch["row"].to_pylist(), batch["groups"].to_pylist()):
                if number != row:
                    if row is not None:
                        yield out()
                    row, sha, held = number, hashlib.sha256(), ""
                if text:
                    sha.update(held.encode())
                    held = text
        if row is not None:
            yield out()

    ordered = parts.repartition("row").sortWithinPartitions("row", "chunk", "piece")
    return ordered.select("row", "groups").mapInArrow(digest, "row long, sha string")


def _pair_counts(parts: DataFrame, kind: np.dtype, n_b: int) -> DataFrame:
    """(pair, n, best) over all links; ``best`` says that no pair with the same B id has more. Added up in the tasks first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, times, held = [], [], 0

        def out() -> pa.RecordBatch:
            found, place = np.unique(np.concatenate(pairs), return_inverse=True)
            sums = np.zeros(len(found), np.int64)
            np.add.at(sums, place, np.concatenate(times))
            pairs.clear()
            times.clear()
            return pa.record_batch([pa.array(found.astype(np.int64)), pa.array(sums)], names=["pair", "n"])

        for batch in batches:
            for p, t in zip(batch["pairs"], batch["times"]):
                pairs.append(np.frombuffer(p.as_buffer(), kind))
                times.append(np.frombuffer(t.as_buffer(), "<u4"))
                held += len(pairs[-1])
                if held > BUFFERED_PAIRS:
                    yield out()
                    held = 0
        if pairs:
            yield out()

    counted = parts.select("pairs", "times").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    # At most as many pairs share a B id as A has ids.
    most = F.max("n").over(Window.partitionBy(F.col("pair") % n_b))
    return counted.withColumn("best", F.col("n") == most)


def _common(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The most frequent pairs in ascending order, their counts and whether they are best; never more than ``most``."""
    step = F.floor(F.log2("n") * 8).cast("int")
    sizes = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("step")).collect()
    total, least = 0, None
    for r in sizes:
        total += r["n"]
        if total > most:
            break
        least = r["step"]
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    table = counts.filter(step >= least).toArrow().sort_by("pair")
    return tuple(table[c].to_numpy() for c in ("pair", "n", "best"))


def _scores(parts: DataFrame, counts: DataFrame, kind: np.dtype, common_pairs: int) -> DataFrame:
    """(row, n_best, count_sum): frequent pairs are looked up in a table of bounded size, all others joined."""
    spark = parts.sparkSession
    known = spark.sparkContext.broadcast(_common(counts, common_pairs))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, number, best = known.value
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                some = batch.slice(at, ROWS)
                pairs = np.frombuffer(b"".join(some["pairs"].to_pylist()), kind).astype(np.int64)
                times = np.frombuffer(b"".join(some["times"].to_pylist()), "<u4").astype(np.int64)
                lengths = np.array([len(p) for p in some["pairs"].to_pylist()]) // kind.itemsize
                edges = np.concatenate([[0], np.cumsum(lengths)])
                place = np.searchsorted(common, pairs)
                there = np.zeros(len(pairs), bool)
                inside = place < len(common)
                there[inside] = common[place[inside]] == pairs[inside]
                held = times * there
                place[~there] = 0
                rest = np.concatenate([[0], np.cumsum(~there)])[edges].astype(np.int32)

                def per_row(values: np.ndarray) -> np.ndarray:
                    return np.diff(np.concatenate([[0], np.cumsum(values)])[edges])

                columns = [
                    some["row"],
                    pa.array(per_row(held * best[place] if len(common) else held)),
                    pa.array(per_row(held * number[place] if len(common) else held)),
                    pa.ListArray.from_arrays(pa.array(rest), pa.array(pairs[~there])),
                    pa.ListArray.from_arrays(pa.array(rest), pa.array(times[~there])),
                ]
                yield pa.record_batch(columns, names=["row", "n_best", "count_sum", "pairs", "times"])

    schema = "row long, n_best long, count_sum long, pairs array<long>, times array<long>"
    seen = stored(parts.select("row", "pairs", "times").mapInArrow(look_up, schema), "align-scores")
    zipped = F.inline(F.arrays_zip("pairs", "times")).alias("pair", "times")
    rare = seen.filter(F.size("pairs") > 0).select("row", zipped).join(counts, "pair")
    found = rare.groupBy("row").agg(
        F.sum(F.col("times") * F.col("best").cast("long")).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")
    )
    both = seen.select("row", "n_best", "count_sum").unionByName(found)
    return both.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def aligned(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    chunk_chars: int = 1 << 16,
    fan_in: int = 16,
    common_pairs: int = COMMON_PAIRS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``n_best`` counts links whose pair is its B id's most frequent in all documents, ``count_sum`` adds up the pairs' counts.
    A text that is null, empty or not spelled by B's pieces has no tokens: zeros and an empty string. A null id stays null;
    rows that are there twice are two documents, both counted. Other columns are not read, whatever their names. No rows
    give no rows.

    A document of any length is hashed by one task, in order and a range at a time, as SHA-256 asks.
    """
    both = aligner(path_a, path_b)
    texts = docs.select(F.col(id_column).cast("long").alias("id"), text_or_empty(F.col(text_column)).alias("text"))
    splits = both.b.cuts and plainly_normalised(both.b)
    short = texts.filter(F.length("text") <= chunk_chars) if splits else texts
    parts = stored(_short_parts(short, path_a, path_b), "align-parts")
    per_doc = parts.select("row", "doc_id", "n_a", "n_b", "n_groups", "sha")
    linked = parts.select("row", "pairs", "times")
    if splits:
        long = _long_parts(texts.filter(F.length("text") > chunk_chars), path_a, path_b, chunk_chars, fan_in)
        counted = [F.coalesce(F.sum(F.when(~F.col("spoilt"), F.col(c))), F.lit(0)).alias(c) for c in ("n_a", "n_b", "n_groups")]
        sums = long.groupBy("row").agg(F.max("doc_id").alias("doc_id"), *counted)
        hashes = _hashes(long.filter("not spoilt"))
        per_doc = per_doc.unionByName(sums.join(hashes, "row", "left").fillna("", ["sha"]))
        linked = linked.unionByName(long.filter("not spoilt").select("row", "pairs", "times"))
    counts = stored(_pair_counts(linked, both.pair, both.n_b), "align-counts")
    scores = _scores(linked, counts, both.pair, common_pairs)
    return per_doc.join(scores, "row", "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        F.col("n_groups").alias("n_links"),
        F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"),
        F.col("sha").alias("groups_sha256"),
    )

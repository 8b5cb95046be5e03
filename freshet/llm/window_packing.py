"""Packing of token ids into sequences of a fixed length, online and in bounded space.

Each task keeps a fixed number of open windows. What is longer than a window is cut into full ones; the rest goes into the
open window that it fills best. When it fits in none, the fullest is emitted: padded if at most ``max_pad`` ids are missing,
else filled up with the first ids in hand. What is left open at the end of a task is packed again, largest first, by the
tasks of a merge tree, whose last one strings the remainder together and cuts it at the window's length; its end
becomes sequences whose lengths are powers of two, which need no padding.

A task holds its open windows and one batch of texts; a merge task holds the windows of ``fan_in`` tasks. Every round is a
written table, so a lost executor repeats its own tasks only.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm.columns import text_or_empty
from freshet.llm.tokens import byte_bpe
from freshet.session import stored

SCHEMA = (
    "doc_id long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, part long, closed boolean"
)
ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("part", pa.int64()),
        ("closed", pa.bool_()),
    ]
)
SLICE = 64
# A sequence's number is its round, its task and a counter, in bits from the left.
ROUND_BIT, PART_BIT = 54, 30
MOST_ROWS, MOST_BYTES = 4_000, 4 << 20


@dataclass(frozen=True)
class Piece:
    """``ids`` is packed; ``start`` counts the ids of its document before it."""

    doc: int | None
    start: int
    ids: bytes
    doc_tokens: int

    def cut(self, at: int, width: int) -> tuple[Piece, Piece]:
        head, tail = self.ids[: at * width], self.ids[at * width :]
        return Piece(self.doc, self.start, head, self.doc_tokens), Piece(self.doc, self.start + at, tail, self.doc_tokens)


@dataclass
class Packer:
    """At most ``most_open`` windows of ``length`` ids; sequences come out of ``add`` and ``close``."""

    length: int
    most_open: int
    max_pad: int
    width: int
    free: list[tuple[int, int]] = field(default_factory=list)
    held: dict[int, list[Piece]] = field(default_factory=dict)
    opened: int = 0

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        while len(piece.ids) // self.width > self.length:
            head, piece = piece.cut(self.length, self.width)
            yield [head]
        while True:
            size = len(piece.ids) // self.width
            at = bisect_left(self.free, (size, -1))
            if at < len(self.free):
                room, slot = self.free.pop(at)
            elif len(self.free) < self.most_open:
                room, slot = self.length, self.opened
                self.held[slot] = []
                self.opened += 1
            else:
                room, slot = self.free.pop(0)
                if room <= self.max_pad:
                    yield self.held.pop(slot)
                    continue
                head, piece = piece.cut(room, self.width)
                yield [*self.held.pop(slot), head]
                continue
            self.held[slot].append(piece)
            if room == size:
                yield self.held.pop(slot)
            else:
                insort(self.free, (room - size, slot))
            return

    def leftovers(self) -> Iterator[list[Piece]]:
        """The windows still open, the fullest first."""
        for _, slot in self.free:
            yield self.held[slot]

    def close(self) -> Iterator[list[Piece]]:
        """The open windows: nearly full ones as they are, the others strung together, the end in powers of two."""
        now: list[Piece] = []
        room = self.length
        loose = [p for f, slot in self.free if f > self.max_pad for p in self.held[slot]]
        yield from (self.held[slot] for f, slot in self.free if f <= self.max_pad)
        rest = sum(len(p.ids) for p in loose) // self.width
        for piece in loose:
            while piece.ids:
                if not now:
                    room = self.length if rest >= self.length else 1 << rest.bit_length() - 1
                take = min(room, len(piece.ids) // self.width)
                head, piece = piece.cut(take, self.width)
                now.append(head)
                room, rest = room - take, rest - take
                if not room:
                    yield now
                    now = []


class _Rows:
    """Numbers sequences and turns them into batches."""

    def __init__(self, first: int, part: int, width: int) -> None:
        self.next, self.part, self.width, self.rows, self.bytes = first, part, width, [], 0

    def put(self, sequence: list[Piece], closed: bool) -> None:
        offset = 0
        for p in sequence:
            ids = np.frombuffer(p.ids, f"<u{self.width}")
            crc = zlib.crc32(ids.astype("<u4").tobytes())
            self.rows.append((p.doc, p.start, len(ids), p.ids, crc, p.doc_tokens, self.next, offset, self.part, closed))
            offset += len(ids)
            self.bytes += len(p.ids)
        self.next += 1

    def full(self) -> bool:
        return len(self.rows) >= MOST_ROWS or self.bytes >= MOST_BYTES

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [()] * len(ARROW)
        self.rows, self.bytes = [], 0
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, ARROW)], schema=ARROW)


def packed(
    docs: DataFrame,
    tokenizer: str,
    end_id: int | None = 1,
    length: int = 2048,
    open_windows: int = 128,
    max_pad: int = 8,
    fan_in: int = 16,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (packed, two bytes an id where the vocabulary allows), ids_crc32 (of the
    ids as unsigned 32-bit integers), doc_tokens, sequence_id, offset.

    ``length`` should be a power of two. At most ``max_pad`` ids of a sequence are padding. A null text is empty: only
    ``end_id``, or no piece without one. A null id stays null; rows that are there twice are two documents. Other columns
    are not read, whatever their names. No rows give no pieces.
    """
    kind = _kind(tokenizer)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encoder = None
        packer, rows = Packer(length, open_windows, max_pad, kind.itemsize), _Rows(part << PART_BIT, part, kind.itemsize)
        for batch in batches:
            encoder = encoder or byte_bpe(tokenizer)
            tail = b"" if end_id is None else np.array([end_id], kind).tobytes()
            for at in range(0, batch.num_rows, SLICE):
                some = batch.slice(at, SLICE)
                for key, ids in zip(some["id"].to_pylist(), encoder.encode(some["text"].to_pylist())):
                    ids += tail
                    if ids:
                        for sequence in packer.add(Piece(key, 0, ids, len(ids) // kind.itemsize)):
                            rows.put(sequence, True)
                    if rows.full():
                        yield rows.batch()
        for sequence in packer.leftovers():
            rows.put(sequence, False)
            if rows.full():
                yield rows.batch()
        yield rows.batch()

    texts = docs.select(F.col(id_column).cast("long").alias("id"), text_or_empty(F.col(text_column)).alias("text"))
    rounds = [stored(texts.mapInArrow(pack, SCHEMA), "packed")]
    number = 0
    while True:
        number += 1
        highest = rounds[-1].filter("not closed").agg(F.max("part")).first()[0]
        if highest is None:
            break
        last = highest < fan_in
        merge = _merging(number, last, length, open_windows, max_pad, kind.itemsize)
        bucket = F.floor(F.col("part") / fan_in).alias("bucket")
        merged = rounds[-1].filter("not closed").groupBy(bucket).applyInArrow(merge, SCHEMA)
        rounds.append(stored(merged, "packed"))
        if last:
            break
    found = rounds[0]
    for more in rounds[1:]:
        found = found.unionByName(more)
    return found.filter("closed").drop("part", "closed")


def _kind(tokenizer: str) -> np.dtype:
    return byte_bpe(tokenizer).kind


def _merging(number: int, last: bool, length: int, most_open: int, max_pad: int, width: int):
    """One bucket of open windows packed again, largest piece first; the last bucket leaves nothing open."""

    def merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        items = table.select(["doc_id", "start", "ids", "doc_tokens", "length", "sequence_id", "offset"]).to_pylist()
        items.sort(key=lambda r: (-r["length"], r["sequence_id"], r["offset"]))
        packer = Packer(length, most_open, max_pad, width)
        rows = _Rows((number << ROUND_BIT) + (bucket << PART_BIT), bucket, width)
        for r in items:
            for sequence in packer.add(Piece(r["doc_id"], r["start"], r["ids"], r["doc_tokens"])):
                rows.put(sequence, True)
        for sequence in packer.close() if last else packer.leftovers():
            rows.put(sequence, last)
        return pa.Table.from_batches([rows.batch()])

    return merge

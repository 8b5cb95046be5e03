"""Token ids as length-delimited binary records, with an offset index for shuffled reads.

A shard file is a run of records: payload length (8 bytes), masked checksum of these 8 bytes (4), payload, masked checksum
of the payload (4); all little-endian. A payload is the document's id (8), the bytes per token (1) and the token ids. A
document without an id has 0 for it and the highest bit of the byte after it set. The
checksum is CRC-32, rotated right by 15 bits plus a constant, so that a checksum over data that holds checksums stays
sound. Beside each shard stands an index: the 8-byte offset of every record.

Shards follow ascending document ids. A task writes its shard under a name of its own and reports it as a row; the
written table of these rows, the manifest, says which files count. What a lost or repeated task left behind is in no
manifest. The folder may be on any file system that pyarrow can open.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from freshet.llm.columns import text_or_empty
from freshet.llm.tokens import ByteBpe, byte_bpe
from freshet.session import new_table_path, stored

MASK_DELTA = 0xA282EAD8  # fixed value of the masked-checksum format
HEAD = "<qB"
NO_ID = 0x80
MANIFEST = "shard int, file string, n_docs long, n_tokens long, n_bytes long"
SLICE = 64


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def framed(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join([length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload))])


def unframed(source) -> bytes | None:
    """The next payload of an open shard, None at its end; a record that does not match its checksums is an error."""
    head = source.read(12)
    if not head:
        return None
    if len(head) < 12 or struct.unpack("<I", head[8:])[0] != masked(head[:8]):
        raise ValueError("a record's length is damaged")
    (size,) = struct.unpack("<Q", head[:8])
    body = source.read(size + 4)
    if len(body) < size + 4 or struct.unpack("<I", body[size:])[0] != masked(body[:size]):
        raise ValueError("a record's payload is damaged")
    return body[:size]


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    if folder.startswith("file:"):
        folder = "/" + folder[len("file:") :].lstrip("/")
    if "://" not in folder:
        return fs.LocalFileSystem(), folder
    return fs.FileSystem.from_uri(folder)


def write_records(
    docs: DataFrame,
    tokenizer: str,
    end_id: int | None = 2,
    folder: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> tuple[str, DataFrame]:
    """Encode every text, append ``end_id``, write shards in ascending id order: (folder, manifest).

    A null text is encoded as empty: only the end id. Rows with a null id come first, by a hash of the text, so that many
    of them are many shards. Equal ids are neighbours, in no fixed order. No rows give a manifest without rows. Other columns are not read.
    """
    spark = docs.sparkSession
    folder = folder or new_table_path(spark, "records")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        encoder: ByteBpe | None = None
        system = out = index = None
        offset = n_docs = n_tokens = 0
        name = f"shard-{shard:06d}-{uuid.uuid4().hex}"
        for batch in batches:
            if not batch.num_rows:
                continue
            if encoder is None:
                encoder = byte_bpe(tokenizer)
                tail = b"" if end_id is None else np.array([end_id], encoder.kind).tobytes()
                system, path = _opened(folder)
                system.create_dir(path, recursive=True)
                out = system.open_output_stream(f"{path}/{name}.rec")
                index = system.open_output_stream(f"{path}/{name}.idx")
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                for key, ids in zip(part["id"].to_pylist(), encoder.encode(part["text"].to_pylist())):
                    width = encoder.kind.itemsize
                    head = struct.pack(HEAD, key, width) if key is not None else struct.pack(HEAD, 0, width | NO_ID)
                    record = framed(head + ids + tail)
                    out.write(record)
                    index.write(struct.pack("<Q", offset))
                    offset += len(record)
                    n_docs += 1
                    n_tokens += len(ids + tail) // encoder.kind.itemsize
        if encoder is not None:
            out.close()
            index.close()
            row = [[shard], [name], [n_docs], [n_tokens], [offset]]
            kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            names = ["shard", "file", "n_docs", "n_tokens", "n_bytes"]
            yield pa.record_batch([pa.array(v, k) for v, k in zip(row, kinds)], names=names)

    rows = docs.select(
        F.col(id_column).cast("long").alias("id"), text_or_empty(F.col(text_column)).alias("text")
    )
    place = ["id", F.when(F.col("id").isNull(), F.xxhash64("text"))]
    ordered = rows.repartitionByRange(*place).sortWithinPartitions(*place)
    return folder, stored(ordered.mapInArrow(write, MANIFEST), "manifest")


def read_payloads(folder: str, name: str, n_docs: int, seed: int | None = None) -> Iterator[tuple[int | None, np.ndarray]]:
    """Document ids and token ids of one shard in written order, or by its index in an order drawn from ``seed``."""
    system, path = _opened(folder)
    with system.open_input_stream(f"{path}/{name}.idx") as f:
        offsets = np.frombuffer(f.read(), "<u8")
    if len(offsets) != n_docs:
        raise ValueError(f"{name}: {len(offsets)} records, the manifest says {n_docs}")
    with system.open_input_file(f"{path}/{name}.rec") if seed is not None else system.open_input_stream(
        f"{path}/{name}.rec", buffer_size=1 << 20
    ) as source:
        if seed is not None:
            offsets = np.random.default_rng(seed).permutation(offsets)
        for offset in offsets:
            if seed is not None:
                source.seek(int(offset))
            payload = unframed(source)
            if payload is None:
                raise ValueError(f"{name} ends early")
            key, width = struct.unpack_from(HEAD, payload)
            key = None if width & NO_ID else key
            yield key, np.frombuffer(payload, f"<u{width & ~NO_ID}", offset=struct.calcsize(HEAD))


def read_records(folder: str, manifest: DataFrame, seed: int | None = None, digests: bool = False) -> DataFrame:
    """The written documents: (doc_id, start, n_tokens, ids), or with ``digests`` ids_crc32 in place of ids.

    ``start`` counts the ids of all documents before this one in written order; it is null in a shuffled read. The
    checksum is over the ids as unsigned 32-bit little-endian integers.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def out() -> pa.RecordBatch:
            keys, starts, sizes, last = zip(*rows)
            kind = pa.int64() if digests else pa.list_(pa.int64())
            arrays = [pa.array(keys, pa.int64()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())]
            batch = pa.record_batch([*arrays, pa.array(last, kind)], names=["doc_id", "start", "n_tokens", "last"])
            rows.clear()
            return batch

        for batch in batches:
            for shard in batch.to_pylist():
                start, held = shard["base"], 0
                own_seed = None if seed is None else hash((seed, shard["shard"])) & 0x7FFFFFFF
                for key, ids in read_payloads(folder, shard["file"], shard["n_docs"], own_seed):
                    last = zlib.crc32(ids.astype("<u4").tobytes()) if digests else ids
                    rows.append((key, start if seed is None else None, len(ids), last))
                    start, held = start + len(ids), held + len(ids)
                    if len(rows) >= 10_000 or not digests and held > 1 << 20:
                        yield out()
                        held = 0
                if rows:
                    yield out()

    count = max(1, manifest.count())
    kind = "long" if digests else "array<long>"
    return (
        shards.repartitionByRange(count, "shard")
        .mapInArrow(read, f"doc_id long, start long, n_tokens long, last {kind}")
        .withColumnRenamed("last", "ids_crc32" if digests else "ids")
    )


def encoded_and_read_back(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write all documents, read the files, and return the digest columns."""
    folder, manifest = write_records(docs, tokenizer, end_id)
    return read_records(folder, manifest, digests=True)

"""SentencePiece encoding that keeps the source of every piece, and decoding.

See :mod:`freshet.llm.tokens`: the text is normalised by longest prefixes through the model's compiled character map,
which records where each normalised byte came from; the pieces of the normalised text are then projected to byte spans of
the original text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm.columns import text_or_empty
from freshet.llm.tokens import pieces_of

SLICE = 64


def encoded(docs: DataFrame, model: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row (id, ids, begins, ends, decoded): token ids, byte spans in the text, and what the ids decode to.

    A null text counts as empty and has no ids. Null ids stay null, repeated rows are encoded each, other columns are not
    read, no rows give no rows. The spans are in UTF-8 bytes; a piece that stands for no source byte, such as the space
    that the model puts before a text, has an empty span.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                found = pieces.encode(part["text"].to_pylist())
                lists = [pa.array([x[i] for x in found], pa.list_(pa.int64())) for i in range(3)]
                decoded = pa.array([pieces.library.decode(x[0].tolist()) for x in found], pa.string())
                yield pa.record_batch([part["id"], *lists, decoded], names=["id", "ids", "begins", "ends", "decoded"])

    rows = docs.select(F.col(id_column).alias("id"), text_or_empty(F.col(text_column)).alias("text"))
    kind = dict(rows.dtypes)["id"]
    schema = f"id {kind}, ids array<long>, begins array<long>, ends array<long>, decoded string"
    return rows.mapInArrow(encode, schema).withColumnRenamed("id", id_column)


def digests(docs: DataFrame, model: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: n_tokens, ids_sha256, decoded_sha256, and n_spanned, the bytes of the text that the spans cover.

    The same encoding as :func:`encoded`, reduced where it is made, so ids do not travel. Cases as there.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                rows = []
                for ids, begins, ends in pieces.encode(part["text"].to_pylist()):
                    numbers = ids.tolist()
                    joined = hashlib.sha256(pieces.joined(numbers).encode()).hexdigest()
                    decoded = hashlib.sha256(pieces.library.decode(numbers).encode()).hexdigest()
                    rows.append((len(numbers), joined, decoded, int((ends - begins).sum())))
                kinds = (pa.int64(), pa.string(), pa.string(), pa.int64())
                columns = [pa.array(v, k) for v, k in zip(zip(*rows), kinds)]
                names = ["id", "n_tokens", "ids_sha256", "decoded_sha256", "n_spanned"]
                yield pa.record_batch([part["id"], *columns], names=names)

    rows = docs.select(F.col(id_column).alias("id"), text_or_empty(F.col(text_column)).alias("text"))
    kind = dict(rows.dtypes)["id"]
    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, n_spanned long"
    return rows.mapInArrow(digest, schema).withColumnRenamed("id", id_column)

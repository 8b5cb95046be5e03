"""Exact dedup by a tree-merge of sorted digest runs.

Every input partition first folds its own rows into one *run*: its distinct digests in ascending order, each with the
identifier that stays, the number of rows and the run's number. Runs then meet in rounds of a ``fan_in``-nomial tree.
In round ``r`` the runs whose numbers agree after dividing by ``fan_in ** (r + 1)`` exchange: each of the
``fan_in ** (r + 1)`` members of such a family takes the slice of the digest space that is its own, so the work of a
round is spread over as many slots as there are runs, and no slot ever holds more than about one run's share. A slot
receives sorted pieces, Spark's external sort merges them, and one streaming pass folds equal neighbours. After the last
round every digest is one entry, which names the runs it came from; it goes back to those runs by ``(run, digest)``.

A digest of a third of all rows is thus one entry per run from the first step on; no key is ever hot. "Verified" means
that entries are folded only where the 64-bit sort key, the whole 256-bit digest and the byte length agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.llm.columns import lower_ascii, text_or_empty
from freshet.session import stored

RUN = "run int, sort_key long, digest binary, n_bytes long, keep_id long, n long, ids array<long>"
#: Stands for no id among identifiers: loses against every other.
NO_ID = {"largest": -(1 << 63), "smallest": (1 << 63) - 1}
ENTRY = "sort_key long, digest binary, n_bytes long, keep_id long, n long, runs array<int>"


def _best(keep: str, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return (np.maximum if keep == "largest" else np.minimum).reduceat(values, starts)


def _lists(values: pa.ListArray, starts: np.ndarray) -> pa.ListArray:
    """The lists of each stretch of rows, strung together; a stretch is whole, so only offsets change."""
    offsets = values.offsets.to_numpy()
    return pa.ListArray.from_arrays(pa.array(np.append(offsets[starts], offsets[-1]), pa.int32()), values.values)


def _fold(table: pa.Table, keep: str, listed: str) -> pa.Table:
    """Equal neighbours become one row."""
    table = table.combine_chunks()
    key, size = table["sort_key"].to_numpy(), table["n_bytes"].to_numpy()
    digest = np.array(table["digest"].to_pylist(), dtype=object)
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (size[1:] != size[:-1]) | (digest[1:] != digest[:-1])
    starts = np.flatnonzero(new)
    lists = table[listed].combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    return pa.table(
        {
            "sort_key": pa.array(key[starts]),
            "digest": table["digest"].take(pa.array(starts)),
            "n_bytes": pa.array(size[starts]),
            "keep_id": pa.array(_best(keep, table["keep_id"].to_numpy(), starts)),
            "n": pa.array(np.add.reduceat(table["n"].to_numpy(), starts)),
            listed: _lists(lists, starts),
        }
    )


def _schema(listed: str, kind: pa.DataType) -> pa.Schema:
    longs = {name: pa.int64() for name in ("sort_key", "n_bytes", "keep_id", "n")}
    kinds = longs | {"digest": pa.binary(), listed: pa.list_(kind)}
    return pa.schema([(name, kinds[name]) for name in ("sort_key", "digest", "n_bytes", "keep_id", "n", listed)])


def _folded(batches: Iterator[pa.RecordBatch], keep: str, listed: str, schema: pa.Schema) -> Iterator[pa.Table]:
    """Fold a sorted stream; the last row of each batch waits for the next batch."""
    waiting: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch]).select(schema.names).cast(schema)
        table = _fold(pa.concat_tables([waiting, table]) if waiting is not None else table, keep, listed)
        waiting = table.slice(table.num_rows - 1)
        if table.num_rows > 1:
            yield table.slice(0, table.num_rows - 1)
    if waiting is not None:
        yield waiting


def _runs(keep: str):
    schema = _schema("ids", pa.int64())

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        for table in _folded(batches, keep, "ids", schema):
            run = pa.array(np.full(table.num_rows, number, np.int32))
            yield from table.add_column(0, "run", run).combine_chunks().to_batches()

    return make


def _merge(keep: str):
    schema = _schema("runs", pa.int32())

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _folded(batches, keep, "runs", schema):
            yield from table.combine_chunks().to_batches()

    return merge


def sorted_runs(rows: DataFrame, keep: str = "largest") -> DataFrame:
    """One sorted run per partition of ``rows`` (id, digest, n_bytes), written to the shared folder."""
    entries = rows.select(
        F.conv(F.substring(F.hex("digest"), 1, 15), 16, 10).cast("long").alias("sort_key"),
        "digest",
        "n_bytes",
        F.coalesce("id", F.lit(NO_ID[keep])).alias("keep_id"),
        F.lit(1).cast("long").alias("n"),
        F.array("id").alias("ids"),
    )
    return stored(entries.sortWithinPartitions("sort_key", "digest", "n_bytes").mapInArrow(_runs(keep), RUN), "runs")


def merged_runs(runs: DataFrame, keep: str = "largest", fan_in: int = 8) -> DataFrame:
    """One entry per distinct digest, with the best identifier, the number of rows and the runs that hold it."""
    count = (runs.agg(F.max("run")).first()[0] or 0) + 1
    entries = runs.select(
        "run", "sort_key", "digest", "n_bytes", "keep_id", "n", F.array("run").alias("runs")
    )
    slots, family = F.col("run"), 1
    while family < count:
        family *= fan_in
        # The slot that owns this slice of the digest space within the family of the entry's first run.
        slice_of = F.expr(f"cast((sort_key * {family}D) / {16**15}D as int)")
        slots = F.col("family") * family + F.least(slice_of, F.lit(family - 1))
        entries = (
            entries.withColumn("family", F.floor(F.element_at("runs", 1) / family).cast("int"))
            .withColumn("slot", slots.cast("int"))
            .repartition(count, "slot")
            .sortWithinPartitions("slot", "sort_key", "digest", "n_bytes")
            .mapInArrow(_merge(keep), ENTRY)
        )
    return entries.select("digest", "n_bytes", "keep_id", "n", "runs")


def exact_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    normalise=lower_ascii,
    keep: str = "largest",
    fan_in: int = 8,
) -> DataFrame:
    """Each row with the identifier that stays for its text: (id, keep_id, group_size, kept, text_sha256).

    Null texts count as empty, so all empty and null texts are one group. A row without an id counts in its group but
    never gives the identifier that stays; its ``kept`` is null, and so is ``keep_id`` where no row of the group has an
    id. (The least long stands for no id while runs are merged; with ``keep="smallest"`` the largest.) A repeated id is a
    row of its own: it counts in ``group_size``, and each of its rows that holds the kept text is kept.
    Columns other than the two named are not read, whatever their names. No rows give no rows.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep is largest or smallest, not {keep}")
    text: Column = normalise(text_or_empty(F.col(text_column)))
    rows = docs.select(
        F.col(id_column).cast("long").alias("id"),
        text.alias("text"),
    ).select("id", F.unhex(F.sha2("text", 256)).alias("digest"), F.octet_length("text").cast("long").alias("n_bytes"))
    none = NO_ID[keep]
    runs = sorted_runs(rows, keep)
    found = merged_runs(runs, keep, fan_in).select(F.explode("runs").alias("run"), "digest", "n_bytes", "keep_id", "n")
    return (
        runs.select("run", "digest", "n_bytes", "ids")
        .join(found, ["run", "digest", "n_bytes"])
        .select(
            F.explode("ids").alias(id_column),
            F.when(F.col("keep_id") != none, F.col("keep_id")).alias("keep_id"),
            F.col("n").alias("group_size"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )
        .select(id_column, "keep_id", "group_size", (F.col(id_column) == F.col("keep_id")).alias("kept"), "text_sha256")
    )

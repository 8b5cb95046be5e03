"""Toxicity by compression distance under two zstandard dictionaries.

One dictionary is trained on windows of toxic text, one on windows of ordinary text. A window is one word with the spaces
around it, two bytes per character (zstandard finds no match worth its header in shorter input). Each window is
compressed under both; the pair of lengths is a cell of a fixed 64 x 64 table, and labelled documents calibrate how much
likelier each cell is in toxic text. A document's distance is the mean over its windows, so a text of any length is scored
whole; the threshold is the one of best F1 on labelled documents that trained no dictionary.

What counts as toxic text in toxic documents is what sets them apart: words whose document frequency there is at least
``LIFT`` times that in ordinary ones. Fitting takes at most ``max_labelled`` labelled documents, drawn by a hash of their
id: those with crc32 mod 5 of 1 or 2 train the dictionaries, 3 or 4 calibrate, 0 are held out.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.llm.columns import remainder_of_id, text_or_empty
from freshet.session import stored

LIFT = 4.0
LEAST_DOCUMENTS = 5
LEAST_SHARE = 0.01
TOXIC_WINDOWS, ORDINARY_WINDOWS = 4_000, 5_000
SIDE = 64
REMEMBERED = 100_000
SLICE = 256
WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class Model:
    """Two dictionaries, the table of log-ratios by pair of lengths, and the logistic scale of the distance."""

    toxic: bytes
    ordinary: bytes
    ratios: bytes
    slope: float
    threshold: float


def _window(word: str) -> bytes:
    return f" {word} ".encode("utf-16-le", "surrogatepass")


def _trained(words: list[tuple[str, int]], most: int) -> bytes:
    """A dictionary of the words' windows, by how often they occur; their plain text where there are too few to train."""
    samples = [_window(w) for w, n in words for _ in range(min(n, most))]
    distinct = [_window(w) for w, _ in words]
    size = min(max(2 * sum(map(len, distinct)) + 2_000, 4_096), 1 << 16)
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(reversed(distinct))[-size:]


class Lengths(dict):
    """Word to its cell: the lengths of its window under both dictionaries, remembered."""

    def __init__(self, toxic: bytes, ordinary: bytes) -> None:
        super().__init__()
        plain = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        self.toxic, self.ordinary = (
            zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d), **plain)
            for d in (toxic, ordinary)
        )

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        window = _window(word)
        a, b = (min(len(c.compress(window)), SIDE - 1) for c in (self.toxic, self.ordinary))
        self[word] = a * SIDE + b
        return self[word]

    def cells(self, text: str) -> np.ndarray:
        """The cell of every window of the text; a text without words has one, that of the empty word."""
        return np.array(list(map(self.__getitem__, WORD.findall(text.lower()) or [""])), np.int64)


@functools.lru_cache(maxsize=2)
def _lengths(toxic: bytes, ordinary: bytes) -> Lengths:
    return Lengths(toxic, ordinary)


def _distance(rows: DataFrame, toxic: bytes, ordinary: bytes, ratios: bytes, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` of each row as they are, and its distance; a null text counts as empty."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, table = _lengths(toxic, ordinary), np.frombuffer(ratios)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                found = [table[lengths.cells(t or "")].mean() for t in part[text].to_pylist()]
                yield pa.record_batch([*(part[c] for c in keep), pa.array(found, pa.float64())], names=[*keep, "distance"])

    kept = rows.select(*keep).schema
    return rows.mapInArrow(score, T.StructType([*kept.fields, T.StructField("distance", T.DoubleType())]))


def _best_threshold(distance: np.ndarray, toxic: np.ndarray) -> float:
    """Midway between the two neighbours where F1 is best; a single score is its own threshold."""
    order = np.argsort(-distance, kind="stable")
    d, y = distance[order], toxic[order]
    last = np.append(d[1:] != d[:-1], True)
    hits = np.cumsum(y)
    f1 = np.where(last, 2 * hits / (np.arange(1, len(d) + 1) + y.sum()), -1)
    at = int(np.argmax(f1))
    return float((d[at] + d[at + 1]) / 2 if at + 1 < len(d) else d[at])


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = 12_000) -> Model | None:
    """The model of (id, text) and (id, toxic); None where a class has no row to learn from.

    Null labels are passed over; a repeated label row counts again.
    """
    fold = remainder_of_id(F.col("id"), 5)
    known = labels.filter("toxic is not null and id is not null").filter(fold != 0)
    drawn = known.orderBy(F.xxhash64("id"), "id").limit(max_labelled)
    sample = stored(
        docs.join(F.broadcast(drawn), "id").select(
            "id", "text", (F.col("toxic") == 1).alias("toxic"), (fold <= 2).alias("trains")
        ),
        "toxicity-sample",
    )
    training, aside = sample.filter("trains").repartition(12), sample.filter("not trains").repartition(12)
    counts = {r["toxic"]: r["count"] for r in training.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return None
    words = training.select("toxic", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(?U)(\w+)")))).alias("word"))
    seen = words.groupBy("word").agg(F.count_if("toxic").alias("t"), F.count_if(~F.col("toxic")).alias("o"))
    lift = ((F.col("t") + 0.5) / (counts[True] + 1)) / ((F.col("o") + 0.5) / (counts[False] + 1))
    least = max(LEAST_DOCUMENTS, LEAST_SHARE * counts[True])
    set_apart = seen.filter((F.col("t") >= least) & (lift >= LIFT)).orderBy(lift.desc(), "word").limit(TOXIC_WINDOWS)
    common = seen.filter("o > 0").orderBy(F.desc("o"), "word").limit(ORDINARY_WINDOWS)
    toxic = _trained([(r["word"], r["t"]) for r in set_apart.collect()], 50)
    ordinary = _trained([(r["word"], r["o"]) for r in common.collect()], 20)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lengths, table = _lengths(toxic, ordinary), np.zeros((2, SIDE * SIDE), np.int64)
        for frame in frames:
            for text, label in zip(frame["text"], frame["toxic"]):
                table[int(label)] += np.bincount(lengths.cells(text), minlength=SIDE * SIDE)
        label, cell = np.nonzero(table)
        yield pd.DataFrame({"label": label, "cell": cell, "n": table[label, cell]})

    table = np.zeros((2, SIDE * SIDE))
    for r in aside.mapInPandas(count, "label int, cell int, n long").groupBy("label", "cell").agg(F.sum("n")).collect():
        table[r[0], r[1]] = r[2]
    if not table.sum(axis=1).all():
        return None
    log_ratio = np.log((table[1] + 1) / (table[1].sum() + 50)) - np.log((table[0] + 1) / (table[0].sum() + 50))
    ratios = np.clip(np.where(table.sum(axis=0) > 0, log_ratio, 0), 0, 3).tobytes()
    # At most max_labelled pairs of numbers.
    pairs = _distance(aside, toxic, ordinary, ratios, ["toxic"]).toPandas()
    distance, label = pairs["distance"].to_numpy(), pairs["toxic"].to_numpy(bool)
    threshold = _best_threshold(distance, label)
    spread = abs(distance[label].mean() - threshold)
    return Model(toxic, ordinary, ratios, 4 / spread if spread > 0 else 1.0, threshold)


def _score(distance: Column, model: Model) -> Column:
    power = F.greatest(F.least(model.slope * (distance - model.threshold), F.lit(50)), F.lit(-50))
    return 1 / (1 + F.exp(-power))


def _model(docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, label: Column | str) -> tuple[DataFrame, Model | None]:
    rows = docs.select(F.col(id_column).alias("id"), text_or_empty(F.col(text_column)).alias("text"))
    known = labels.select(F.col(id_column).alias("id"), F.col(label).alias("toxic") if isinstance(label, str) else label.alias("toxic"))
    return rows, fit(rows, known)


def with_scores(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label: Column | str = "toxic"
) -> DataFrame:
    """``docs`` with its own score in each row, whatever its id; a column named score is replaced."""
    columns = [c for c in docs.columns if c != "score"]
    _, model = _model(docs, labels, id_column, text_column, label)
    if model is None:
        return docs.select(*columns, F.lit(0.0).alias("score"))
    # Numbered names, so that no column can be called like the distance.
    own = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)])
    text = own.columns[columns.index(text_column)]
    found = _distance(own, model.toxic, model.ordinary, model.ratios, own.columns, text)
    return found.select(*[F.col(x).alias(c) for x, c in zip(own.columns, columns)], _score(F.col("distance"), model).alias("score"))


def scored(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label: Column | str = "toxic"
) -> DataFrame:
    """Each document's score: (id, held_out, score, predicted).

    Null texts count as empty; empty texts are scored like any other, by the window of the empty word. Where a class has no
    labelled row every score is 0. Repeated rows are scored each; other columns are not read.
    """
    rows, model = _model(docs, labels, id_column, text_column, label)
    if model is None:
        found = rows.select("id", F.lit(0.0).alias("score"))
    else:
        distance = _distance(rows, model.toxic, model.ordinary, model.ratios, ["id"])
        found = distance.select("id", _score(F.col("distance"), model).alias("score"))
    return found.select(
        F.col("id").alias(id_column),
        (remainder_of_id(F.col("id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )

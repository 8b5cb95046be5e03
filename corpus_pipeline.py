"""A training-data pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written and read again before the next one.
All but the last return the columns of ``documents``. Toxic documents go; lines that an earlier line repeats go, and with
them documents of which no line is left; one document of each group of near duplicates stays; the mix takes documents by
their sources' weights, some twice; the last stage encodes what is there.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm import jaccard_join, line_dedup, piece_encoding, source_mixing, toxicity
from freshet.session import released, stored_alone

#: No stage but the mix can be said in SQL; tests hold every stage against plain code.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose toxicity reaches one half."""
    found = toxicity.with_scores(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return found.filter("score < 0.5").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without repeated lines, and without documents that were nothing but such; n_chars follows the text."""
    found = line_dedup.without_repeated_lines(docs)
    # Blank lines stay and may be several; a line of spaces is blank.
    emptied = (F.col("n_dropped") > 0) & (F.length(F.trim(F.translate("text", "\n", " "))) == 0)
    changed = F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return found.filter(~emptied).withColumn("n_chars", changed.cast("long")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest id."""
    return jaccard_join.first_of_each_group(docs).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as there are, small sources up to twice; whole documents, also at the edge of a leaf's budget."""
    return source_mixing.mixed(docs).select(*docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Subword ids of every document, their byte spans as lengths covered, and digests of ids and decoded text."""
    return piece_encoding.digests(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram jaccard join", drop_near_duplicates),
    ("source mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = before = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs, last = stored_alone(lambda: stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}"), docs
        if last is not before:
            released(last)
    return STAGES[-1][1](spark, docs, sf_dir)

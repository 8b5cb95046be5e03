"""The registered query of each operator, with production parameters, and its SQL twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from freshet.llm import (
    attention_scores,
    exact_dedup,
    filter_audit,
    jaccard_join,
    line_dedup,
    piece_encoding,
    source_mixing,
    token_alignment,
    token_records,
    toxicity,
    url_filter,
    vantage_point,
    window_packing,
)
from freshet.llm.columns import remainder_of_id

def tokenizer_file(name: str) -> str:
    """Where the installed package of public tokenizers keeps a file."""
    return public_tokenizers.path(name)


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    LLM_QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, learned from the labels of four fifths of the ids."""
    return toxicity.scored(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query
def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that a mix of as many tokens as there are takes, with weights by the square root of each leaf's."""
    mix = source_mixing.mixed(_table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "source", "lang", "mix_epoch", "mix_tokens", "mix_taken")


@_query
def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's SentencePiece ids and what they decode to, as digests."""
    return piece_encoding.digests(_table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


@_query
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the texts that are equal when A-Z is lower-cased, the row with the largest doc_id stays."""
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


# DuckDB's lower() folds more than A-Z, so the letters are translated.
LLM_ORACLES["op4_exact_dedup"] = """
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h
  FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
FROM t
"""


URL_RULES = [
    url_filter.Rule("allow", "com", "/"),
    url_filter.Rule("block", "example.com", "/en/"),
    url_filter.Rule("allow", "www.example.com", "/en/"),
    url_filter.Rule("block", "net", "/es/"),
    url_filter.Rule("block", "net", "/fr/"),
]


@_query
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's host, path, fitting rule and verdict; two character models decide where no rule fits."""
    return url_filter.judged(_table(spark, sf_dir, "pages"), URL_RULES)


@_query
def op6_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids written as framed records in ascending doc_id order, and read back."""
    documents = _table(spark, sf_dir, "documents")
    return token_records.encoded_and_read_back(spark, documents, tokenizer_file("byte_bpe_50k.json"))


@_query
def op7_vantage_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest neighbours of every hundredth vector, searched exactly (factor one)."""
    vectors = _table(spark, sf_dir, "embeddings")
    return vantage_point.nearest(vectors, F.col("vec_id") % 100 == 0)


# The same search by brute force: 1 % of the rows against all rows.
LLM_ORACLES["op7_vantage_point"] = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), d AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         sqrt(list_sum(list_transform(list_zip(q.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INTEGER AS rank FROM d
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@_query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that an earlier line repeats exactly or but for one edit."""
    found = line_dedup.without_repeated_lines(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("text_sha256"))


LLM_ORACLES["op8_line_dedup"] = """
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS n
  FROM documents
), f AS (
  SELECT line, min(doc_id * 1000000 + n) AS first, length(line) AS size FROM l WHERE trim(line, ' ') <> '' GROUP BY line
), k AS (
  SELECT line, first, size, unnest([size, size + 1]) AS longer FROM f WHERE size >= 20
), h AS (
  SELECT *, 'first' AS half, left(line, (longer - 1) // 2) AS part FROM k
  UNION ALL SELECT *, 'last', right(line, (longer - 1) // 2) FROM k
), near AS (
  SELECT DISTINCT b.line
  FROM h a JOIN h b ON a.longer = b.longer AND a.half = b.half AND a.part = b.part AND a.first < b.first
  WHERE (a.size = b.size AND len(list_filter(range(1, a.size + 1), lambda i: a.line[i] <> b.line[i])) = 1)
     OR (a.size = b.size + 1 AND len(list_filter(range(1, a.size + 1), lambda i: left(a.line, i - 1) || a.line[i + 1:] = b.line)) > 0)
     OR (b.size = a.size + 1 AND len(list_filter(range(1, b.size + 1), lambda i: left(b.line, i - 1) || b.line[i + 1:] = a.line)) > 0)
), kept AS (
  SELECT l.doc_id, l.n, l.line,
         trim(l.line, ' ') = '' OR (f.first = l.doc_id * 1000000 + l.n AND near.line IS NULL) AS stays
  FROM l LEFT JOIN f ON l.line = f.line LEFT JOIN near ON l.line = near.line
)
SELECT doc_id, count(*)::INTEGER AS n_lines, count_if(NOT stays)::INTEGER AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (stays), '')) AS text_sha256
FROM kept GROUP BY doc_id
"""


@_query
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's number of five-word shingles and the component of its links at a similarity of 0.8."""
    return jaccard_join.jaccard_groups(_table(spark, sf_dir, "documents"))


@_query
def op9_attention_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probability under a word unigram model and under a trained self-attention model."""
    trains = remainder_of_id(F.col("doc_id"), 7) != 2
    found = attention_scores.scored(_table(spark, sf_dir, "documents"), trains, tokenizer_file("piece_bpe_32k.model"))
    return found.withColumn("held_out", remainder_of_id(F.col("doc_id"), 7) == 2)


@_query
def op11_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids in pieces, packed into sequences of at most 2048."""
    found = window_packing.packed(_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), end_id=1)
    return found.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@_query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from each language's documents, in all 120 orders."""
    counts = filter_audit.mask_counts(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return filter_audit.audited(counts)


LLM_ORACLES["op12_filter_audit"] = r"""
WITH t AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), l AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         len(words) < 100 AS a, 100 * len(list_distinct(words)) < 80 * len(words) AS b,
         100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) AS c,
         regexp_matches(text, '[#$%&*|]') AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e
  FROM t LEFT JOIN l USING (doc_id)
), w AS (
  SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS mask,
         count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
  FROM m GROUP BY ALL
), x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (
  SELECT p.f || q.f || r.f || s.f || u.f AS filter_order, [p.bit, q.bit, r.bit, s.bit, u.bit] AS bits
  FROM x p, x q, x r, x s, x u WHERE p.bit + q.bit + r.bit + s.bit + u.bit = 31 AND p.bit | q.bit | r.bit | s.bit | u.bit = 31
), k AS (
  SELECT filter_order, unnest(range(1, 6)) AS step, unnest(bits) AS bit,
         unnest([0, bits[1], bits[1] + bits[2], bits[1] + bits[2] + bits[3], 31 - bits[5]]) AS gone
  FROM o
), r AS (
  SELECT part, filter_order, step, bit,
         sum(n) FILTER (mask & gone = 0 AND mask & bit = 0) AS kept,
         sum(n) FILTER (mask & gone = 0 AND mask & bit > 0) AS removed,
         sum(n) FILTER (mask & gone > 0 AND mask & bit > 0) AS redundant,
         sum(n) FILTER (mask = bit) AS unique_fails,
         sum(good) FILTER (mask & gone = 0 AND mask & bit > 0) AS good_lost,
         sum(toxic) FILTER (mask & gone = 0 AND mask & bit > 0) AS toxic_lost
  FROM w, k GROUP BY ALL
)
SELECT part, filter_order, step::INTEGER AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       (coalesce(sum(removed) OVER (PARTITION BY part, bit), 0))::BIGINT AS shapley
FROM r
"""


@_query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's groups and links between the tokens of a byte-level and of a SentencePiece tokenizer."""
    paths = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
    return token_alignment.aligned(_table(spark, sf_dir, "documents"), *paths)


LLM_QUERIES["pipeline"] = corpus_pipeline.run

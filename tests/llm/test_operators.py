"""Each operator on small awkward tables: nulls, empty and long texts, ties, repeats, empty tables, clashing columns."""

import hashlib
import math
import random
import tempfile
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from freshet.llm import (
    attention_scores,
    components,
    exact_dedup,
    jaccard_join,
    line_dedup,
    piece_encoding,
    source_mixing,
    token_records,
    toxicity,
    url_filter,
    vantage_point,
)
from freshet.llm.queries import LLM_ORACLES, LLM_QUERIES, URL_RULES
from freshet.llm.tokens import ByteBpe, Pieces
from freshet.session import stored
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"
PIECES = public_tokenizers.path("piece_bpe_32k.model")
BPE = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, line string, n long, budget long"
RNG = random.Random(3)
WORDS = ["the", "of", "Und", "éau", "tion", "idiot", "zebra", "42", "…"]
LONG = " ".join(RNG.choice(WORDS) for _ in range(30_000))
BASE = [RNG.choice(WORDS) + str(RNG.randint(0, 9)) for _ in range(60)]
NEAR = [*BASE[:58], "other", "end"]
TEXTS = [None, "", "", " \t", "one", LONG, " ".join(BASE), " ".join(NEAR), " ".join(BASE).encode().upper().decode(), "a\n\nb\nthe same long line here\nthe same long line hero",
         "the same long line here", "ünï ▁ code\u00a0 x", "\x00nul", " ".join(BASE)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if i % 5 == 0 else "en", None if i % 7 == 0 else f"s{i % 3}", 1, 99, "x", 5, 6) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[6]], SCHEMA).repartition(3)


@pytest.mark.parametrize("key", sorted(LLM_ORACLES))
def test_query_agrees_with_sql(spark, key):
    assert compare(LLM_QUERIES[key](spark, SF), connect(SF), LLM_ORACLES[key]) == []


def test_exact_groups(docs):
    got = {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_groups(docs).collect()}
    assert {(6, 13, 4, False), (13, 13, 4, True), (8, 13, 4, False), (0, 2, 3, False), (2, 2, 3, True)} <= got
    smallest = exact_dedup.exact_groups(docs, keep="smallest", fan_in=2).filter("doc_id = 13").first()
    assert smallest["keep_id"] == 6 and exact_dedup.exact_groups(docs.limit(0)).count() == 0


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_jaccard_groups(spark, docs):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_groups(docs).collect()}
    assert all(got[i][0] == len(shingles(t)) for i, t in enumerate(TEXTS))
    assert got[6] == got[13] == (56, 6) and got[7][1] == 6 and got[8][1] == 6 and got[0] == (0, 0) and got[2] == (0, 2)
    assert jaccard_join.jaccard_groups(docs.limit(0)).count() == 0
    kept = jaccard_join.first_of_each_group(docs)
    assert kept.columns == docs.columns and kept.filter("doc_id in (7, 8, 13)").count() == 0


def test_jaccard_groups_of_many_near_copies(spark):
    rng = random.Random(5)
    base = [str(rng.random()) for _ in range(80)]
    texts = [" ".join([*base[: 80 - i % 6], *(f"x{i}" for _ in range(i % 3))]) for i in range(300)]
    texts += [" ".join(base[20:40] + [str(rng.random()) for _ in range(60)]) for _ in range(50)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_groups(df).collect()}
    assert got == {i: find(i) for i in range(len(texts))}


def test_tile_links_join_what_is_similar():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 60, 90, dtype=np.uint64)
    # Similarities lie on both sides of 0.8, and some sets are equal.
    sets = [np.unique(np.append(base[: 90 - i % 17], rng.integers(0, 1 << 60, i % 9, dtype=np.uint64))) for i in range(120)]
    sets += [sets[3], rng.integers(0, 1 << 60, 1, dtype=np.uint64)]
    nodes, parts = np.arange(len(sets)) * 10, np.arange(len(sets)) // 2
    held = [set(x.tolist()) for x in sets]
    for tiles in (np.zeros(len(sets), int), rng.integers(0, 2, len(sets))):
        asked = [
            (i, j) for i in range(len(sets)) for j in range(i)
            if (tiles.max() == 0 or tiles[i] != tiles[j]) and 100 * len(held[i] & held[j]) >= 80 * len(held[i] | held[j])
        ]
        found = [(a // 10, b // 10) for a, b in jaccard_join.tile_links(nodes, parts, tiles, sets)]
        assert {tuple(sorted(p, reverse=True)) for p in found} <= set(asked)

        def groups(links):
            part = parts.copy()
            for i, j in links:
                part[part == part[i]] = part[j]
            return [[k for k in range(len(sets)) if part[k] == part[i]] for i in range(len(sets))]

        assert groups(found) == groups(asked)
        assert len(found) == len(set(parts.tolist())) - len({tuple(g) for g in groups(asked)})


def test_components_of_a_path(spark):
    links = spark.range(40).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {tuple(r) for r in components.components(links).collect()} == {(i, 0) for i in range(41)}


def test_line_dedup(docs):
    got = {r["doc_id"]: r for r in line_dedup.without_repeated_lines(docs).collect()}
    assert got[9]["text"] == "a\n\nb\nthe same long line here" and (got[9]["n_lines"], got[9]["n_dropped"]) == (5, 1)
    assert got[10]["text"] == "" and got[10]["n_dropped"] == 1 and got[0]["n_lines"] == 1 and got[5]["text"] == LONG
    assert got[6]["text"] == TEXTS[6] and got[13]["text"] == ""
    assert line_dedup.without_repeated_lines(docs.limit(0)).count() == 0


def test_line_dedup_against_brute_force(spark):
    rng = random.Random(8)
    lines = ["".join(rng.choice("ab cé") for _ in range(rng.randint(0, 30))) for _ in range(40)]
    for _ in range(150):
        x = rng.choice(lines)
        at = rng.randint(0, len(x))
        lines.append(rng.choice([x[:at] + x[at + 1 :], x[:at] + "d" + x[at:], x[:at] + "d" + x[at + 1 :], x]))
    df = spark.createDataFrame([(i, "\n".join(lines[i * 5 : i * 5 + 5])) for i in range(38)], "doc_id long, text string")

    def one_edit(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) <= 1
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    want = {}
    for i in range(38):
        keep = []
        for k, x in enumerate(lines[i * 5 : i * 5 + 5]):
            copy = any(y == x or (min(len(x), len(y)) >= 20 and one_edit(x, y)) for y in lines[: i * 5 + k])
            if not x.strip(" ") or not copy:
                keep.append(x)
        want[i] = "\n".join(keep)
    assert {r["doc_id"]: r["text"] for r in line_dedup.without_repeated_lines(df).collect()} == want


def test_pieces_and_records(docs):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for r in piece_encoding.encoded(docs, PIECES).collect():
        text = TEXTS[r["doc_id"]] or ""
        assert r["ids"] == library.encode(text) and r["decoded"] == library.decode(r["ids"])
        assert b"".join(text.encode()[a:b] for a, b in zip(r["begins"], r["ends"])) == text.encode()
    tokenizer = Tokenizer.from_file(BPE)
    folder, manifest = token_records.write_records(docs, BPE)
    for seed in (None, 4):
        rows = token_records.read_records(folder, manifest, seed).collect()
        assert sorted(r["doc_id"] for r in rows) == sorted([*range(len(TEXTS)), 6])
        for r in rows:
            assert r["ids"] == [*tokenizer.encode(TEXTS[r["doc_id"]] or "", add_special_tokens=False).ids, 2]
    start = 0
    for r in token_records.read_records(folder, manifest, digests=True).orderBy("start").collect():
        assert r["start"] == start
        start += r["n_tokens"]
    assert token_records.encoded_and_read_back(docs.sparkSession, docs.limit(0), BPE).count() == 0


def test_a_damaged_record_is_found(tmp_path):
    import io

    whole = token_records.framed(b"payload")
    assert token_records.unframed(io.BytesIO(whole)) == b"payload" and token_records.unframed(io.BytesIO(b"")) is None
    for at in (0, 9, 14, len(whole) - 1):
        broken = bytearray(whole)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            token_records.unframed(io.BytesIO(bytes(broken)))


def test_memos_agree_with_the_libraries():
    rng = random.Random(1)
    parts = ["a", "B", " ", "  ", "\n", "\t", "é", "▁", "'s", "1", "<|endoftext|>", "\u00a0", "日本", "\r\n", " the", "\x1c"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(3_000)]
    bpe, pieces = ByteBpe(BPE), Pieces(PIECES)
    want = [x.ids for x in bpe.library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, bpe.kind).tolist() for x in bpe.encode(texts)] == want
    assert [x[0].tolist() for x in pieces.encode(texts)] == pieces.library.encode(texts)


def test_vectors(spark):
    rng = np.random.default_rng(2)
    vectors = [*rng.normal(size=(500, 8)).tolist(), *[[1.0] * 8] * 150]
    rows = [*enumerate(vectors), (900, None), (1000, [0.0] * 8), (1100, [float("nan")] * 8), (1200, [None] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = vantage_point.nearest(df, F.col("vec_id") % 100 == 0, shard_rows=200, block_queries=3).collect()
    found = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in got}
    data = np.array(vectors)
    for q in range(0, len(data), 100):
        d = np.sqrt(((data - data[q]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((np.arange(len(d)), d)) if i != q][:10]
        assert [found[q, k + 1][0] for k in range(10)] == order
    assert len(found) == 70 and vantage_point.nearest(df.limit(0), F.lit(True)).count() == 0


def test_urls(spark):
    urls = [None, "", "no scheme", "http://A.com", "HTTP://www.Example.com/en/x?q#f", "x://example.com/en/", "http://a.net/fr/1", "http://notexample.com/en/"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("score", F.lit("mine"))
    got = [tuple(r)[1:5] for r in url_filter.judged(df, URL_RULES).orderBy("page_id").collect()]
    assert got[0][:3] == ("", "", None) and got[3][:3] == ("a.com", "", None)
    assert got[4] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert got[5] == ("example.com", "/en/", "example.com/en/", "block") and got[6][2:] == ("net/fr/", "block")
    assert got[7][2:] == ("com/", "allow") and url_filter.judged(df.limit(0), URL_RULES).count() == 0


def test_toxicity_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    r = toxicity.scored(docs, labels).join(labels, "doc_id").filter("held_out").toPandas()
    hits, wrong = ((r.predicted == 1) & (r.toxic == x) for x in (1, 0))
    assert hits.sum() >= 0.5 * r.toxic.sum() and wrong.sum() <= 0.05 * len(r)


def test_toxicity_without_labels(docs):
    labels = docs.select("doc_id", F.lit(None).cast("int").alias("toxic"))
    assert {r["score"] for r in toxicity.scored(docs, labels).collect()} == {0.0}


def test_mixing(spark, docs):
    mix = source_mixing.mixed(docs, total=4_000)
    assert mix.agg(F.sum("mix_taken")).first()[0] in range(3_990, 4_001) and set(docs.columns) <= set(mix.columns)
    assert source_mixing.mixed(docs.limit(0)).count() == 0
    leaves = spark.createDataFrame([("d", "a", "1", 100), ("d", "a", "2", 10), ("d", "b", "3", 1000), ("e", "a", "4", 1000)], "domain string, lang string, source string, tokens long")
    got = {r["source"]: r["budget"] for r in source_mixing.leaf_budgets(leaves, 800, 1, weight=F.lit(1.0)).collect()}
    # d has three of four parts: 600; a of d has two of three parts, but holds 110; b takes the rest before e does.
    assert got == {"1": 100, "2": 10, "3": 490, "4": 200}


def test_attention_scores(spark, docs):
    trains = F.crc32(F.col("doc_id").cast("string")) % 7 != 2
    rows = attention_scores.scored(docs, trains, PIECES).collect()
    seen = [(t or "").encode().lower().split() + [b""] for i, t in [*enumerate(TEXTS), (6, TEXTS[6])] if zlib.crc32(str(i).encode()) % 7 != 2]
    counts = {}
    for words in seen:
        for w in words:
            counts[w] = counts.get(w, 0) + 1
    total, kinds = sum(counts.values()), len(counts)
    for r in rows:
        words = (TEXTS[r["doc_id"]] or "").encode().lower().split() + [b""]
        base = sum(math.log10((counts.get(w, 0) + 1) / (total + kinds + 1)) for w in words)
        assert r["n_tokens"] == len(words) and r["train_tokens"] == total and math.isclose(r["base_score"], base)
        assert r["n_known"] == sum(w in counts for w in words) and r["score"] < 0
    assert len(rows) == len(TEXTS) + 1 and attention_scores.scored(docs.limit(0), trains, PIECES).count() == 0


def test_attention_probabilities_add_up_and_gradients_fit():
    rng = np.random.default_rng(0)
    lines = [rng.integers(3, 50, n).astype(np.int32) for n in (1, 30, 200)]
    classes = attention_scores.class_table(lines, 60)
    net = attention_scores.trained(lines, classes, steps=3)
    inputs, targets, _ = attention_scores.windows(lines)
    assert (targets >= 0).sum() == sum(map(len, lines))
    seen = classes[inputs]
    each = [attention_scores.class_log_probability(net, seen, np.full_like(targets, c)) for c in range(attention_scores.CLASSES)]
    assert np.allclose(np.exp(each).sum(axis=0), 1, atol=1e-4)
    wanted = np.where(targets >= 0, classes[targets], -1)
    net = {k: v.astype(np.float64) for k, v in net.items()}
    grads = attention_scores._gradients(net, seen, wanted)

    def loss():
        p = attention_scores.class_log_probability(net, seen, np.maximum(wanted, 0))
        return -p[wanted >= 0].mean()

    for name in ("query", "embed", "back", "pairs"):
        at = np.unravel_index(np.argmax(abs(grads[name])), grads[name].shape)
        net[name][at] += 1e-2
        up = loss()
        net[name][at] -= 2e-2
        assert math.isclose((up - loss()) / 2e-2, grads[name][at], rel_tol=0.05)
        net[name][at] += 1e-2


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF), "test-stage")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and docs.count() > 50
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = {(r["doc_id"], hashlib.sha256(library.decode(library.encode(r["text"] or "")).encode()).hexdigest()) for r in docs.collect()}
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {(r["doc_id"], r["decoded_sha256"]) for r in last} == texts and len(last) == docs.count()


@pytest.mark.parametrize("split", [False, True])
def test_tree_pairs_lose_no_similar_pair(split):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 900, dtype=np.uint64) * np.uint64(2)
    sets = []
    for size in rng.integers(60, 900, 150):
        own = np.unique(np.append(base[:size], rng.integers(0, 1 << 63, size // 12, dtype=np.uint64)))
        sets.append(own)
    sets.sort(key=len)
    sizes = np.array([len(s) for s in sets])
    widths = jaccard_join.widths(sizes)
    vec = np.empty(len(sets), object)
    for i, (s, w) in enumerate(zip(sets, widths.tolist())):
        cell = (s >> np.uint64(64 - int(np.log2(w)))).astype(np.int64)
        vec[i] = jaccard_join.packed(np.bincount(cell, minlength=w))
    parts = np.arange(len(sets)) // 3
    block = np.arange(len(sets)) // 75 * split
    assert len(set(widths.tolist())) > 2
    found = {tuple(sorted(p)) for p in jaccard_join._work_pairs(np.arange(len(sets)), sizes, parts, block, vec).tolist()}
    assert all(parts[a] != parts[b] for a, b in found)
    for b in range(len(sets)):
        for a in range(b):
            common = len(np.intersect1d(sets[a], sets[b]))
            similar = 100 * common >= 80 * (sizes[a] + sizes[b] - common)
            if similar and parts[a] != parts[b] and (not split or block[a] != block[b]):
                assert (a, b) in found


def test_a_count_beyond_a_byte_bounds_any_overlap():
    assert jaccard_join.packed(np.array([3, 255])) == bytes([3, 255])
    assert jaccard_join.packed(np.array([0, 256, 1])) == bytes([255] * 3)
    assert jaccard_join.folded(np.full(4, 255, np.uint8), 1).tolist() == [1020]


def test_copies_with_several_blank_lines_are_emptied(spark):
    text = "a first paragraph of text\n\nand a second one here\n \n\nthe end of it"
    rows = [(i, text, "en", "s", len(text)) for i in range(40)] + [(40, "\n\n", "en", "s", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.drop_repeated_lines(spark, docs, SF).collect()
    assert sorted((r["doc_id"], r["text"]) for r in left) == [(0, text), (40, "\n\n")]


def test_rows_without_an_id(spark):
    long, other = " ".join(BASE), " ".join(f"other{i}" for i in range(50))
    rows = [(None, long), (3, long.encode().upper().decode()), (2, long), (None, other), (None, other), (None, None), (None, ""), (7, ""), (None, "so alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    exact = sorted(map(tuple, exact_dedup.exact_groups(docs).select("doc_id", "keep_id", "group_size", "kept").collect()), key=key)
    assert exact == sorted(
        [(None, 3, 3, None), (3, 3, 3, True), (2, 3, 3, False), (None, None, 2, None), (None, None, 2, None),
         (None, 7, 3, None), (None, 7, 3, None), (7, 7, 3, True), (None, None, 1, None)], key=key)
    smallest = exact_dedup.exact_groups(docs, keep="smallest").filter("doc_id is null").select("keep_id", "group_size").collect()
    assert sorted(map(tuple, smallest), key=key) == sorted([(2, 3), (None, 2), (None, 2), (7, 3), (7, 3), (None, 1)], key=key)
    near = sorted(map(tuple, jaccard_join.jaccard_groups(docs).collect()), key=key)
    assert near == sorted(
        [(None, 56, 2), (3, 56, 2), (2, 56, 2), (None, 46, None), (None, 46, None), (None, 0, None), (None, 0, None),
         (7, 0, 7), (None, 1, None)], key=key)
    kept = jaccard_join.first_of_each_group(docs)
    assert {tuple(r) for r in kept.collect()} == {(2, long), (None, other), (None, None), (None, ""), (7, ""), (None, "so alone")}
    folder, manifest = token_records.write_records(docs, BPE)
    back = token_records.read_records(folder, manifest).orderBy("start").collect()
    coder = Tokenizer.from_file(BPE)
    want = sorted([(i, [*coder.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in rows], key=str)
    assert sorted([(r["doc_id"], r["ids"]) for r in back], key=str) == want and [r["doc_id"] for r in back] == [None] * 6 + [2, 3, 7]


def test_training_goes_through_every_window(spark):
    # Classes 50 to 249 stand in one window each: weights of a class that training never meets stay as they were drawn.
    rng = np.random.default_rng(1)
    lines = rng.integers(3, 50, (40_000, attention_scores.STRIDE)).astype(np.uint16)
    lines[np.arange(200) * 199, 10] = np.arange(50, 250)
    training = spark.createDataFrame([(bytearray(x.tobytes()),) for x in lines], "ids binary").coalesce(1)
    classes = np.arange(attention_scores.CLASSES)
    net = begun = attention_scores.started(attention_scores._class_pairs([x.astype(np.int32) for x in lines], classes))
    for turn in range(attention_scores.ROUNDS):
        net = attention_scores._averaged(training, net, classes, turn)
    assert (net["embed"][50:250] != begun["embed"][50:250]).any(axis=1).all()


def test_words_move_in_lists(spark, monkeypatch):
    rng = random.Random(5)
    texts = [" ".join(f"W{rng.randrange(3_000)}" for _ in range(200)) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    held, real = [], attention_scores.stored
    monkeypatch.setattr(attention_scores, "stored", lambda df, name: held.append(real(df, name)) or held[-1])
    monkeypatch.setattr(attention_scores, "released", lambda *tables: None)
    monkeypatch.setattr(attention_scores, "CHUNK_BYTES", 10_000)  # two chunks a partition, five buckets
    rows = attention_scores.scored(docs, F.col("doc_id") % 2 == 0, PIECES).collect()
    assert max(t.count() for t in held) <= 40 + 8 * 5
    counts = Counter(w for t in texts[::2] for w in [*t.lower().split(), ""])
    under = sum(counts.values()) + len(counts) + 1
    for r in rows:
        words = [*texts[r["doc_id"]].lower().split(), ""]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (201, sum(w in counts for w in words), 20 * 201)
        assert math.isclose(r["base_score"], sum(math.log10((counts[w] + 1) / under) for w in words))


def test_texts_are_cut_into_chunks_whole():
    sizes = [3, 9, 0, 1, 20, 2, 0, 10, 5, 5, 1]
    texts = [chr(97 + i) * n for i, n in enumerate(sizes)]
    batches = [pa.record_batch({"text": pa.array(texts[i : i + 3], pa.string())}) for i in range(0, len(texts), 3)]
    found = [t["text"].to_pylist() for t in attention_scores._cut(iter(batches), 10)]
    assert [x for part in found for x in part] == texts and all(len(part) == 1 or len("".join(part)) <= 10 for part in found)


def test_toxic_rows_go_by_their_own_score(spark):
    bad, good = "zorgish blatter vile scum", "a calm walk along the river today"
    rows = [(i, bad if i % 2 else good, 1 << 60) for i in range(400)] + [(None, bad, 1), (None, good, (1 << 60) + 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    folder = f"{tempfile.mkdtemp(prefix='run-', dir='/tmp')}"
    docs.filter("doc_id is not null").select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic")).write.parquet(f"{folder}/labels.parquet")
    left = corpus_pipeline.drop_toxic(spark, docs, folder).collect()
    assert len(left) == 201 and {r["text"] for r in left} == {good}
    assert [r["n_chars"] for r in left if r["doc_id"] is None] == [(1 << 60) + 1]


def test_classes_come_from_all_training_texts(spark, monkeypatch):
    rng = random.Random(11)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    words = sorted({w for i in range(300, 30_000) if (w := library.id_to_piece(i))[0] == "▁" and w[1:].isascii() and w[1:].isalpha() and w.islower()})
    texts = [" ".join(x for w in words[i : i + 2] for x in (w[1:], rng.choice(["the", "of", "and"]))) for i in range(4_000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    held, real = [], attention_scores.fit
    monkeypatch.setattr(attention_scores, "fit", lambda *a: held.append(real(*a)) or held[0])
    scores = attention_scores.scored(docs, F.col("doc_id") >= 0, PIECES).toPandas()
    lines = [np.array([*(x for w in t.split() for x in library.encode(w)), attention_scores.END]) for t in texts]
    assert (held[0].classes == attention_scores.class_table(lines, library.get_piece_size())).all()
    # A trained model tells more than the classes' pair counts it started from.
    start = attention_scores.started(attention_scores._class_pairs(lines, held[0].classes))
    before = attention_scores.log10_probability(attention_scores.Weights(held[0].classes, held[0].shares, start), lines)
    assert scores["score"].mean() > before.mean() and np.isfinite(scores["score"]).all()


def test_attention_equals_a_plain_loop_and_a_large_batch_holds_no_more_than_a_part():
    rng = np.random.default_rng(4)
    net = {k: v.astype(np.float64) * 3 for k, v in attention_scores.started(rng.integers(0, 9, 256 * 256)).items() if "pairs" not in k}
    seen = rng.integers(0, 256, (3, attention_scores.WINDOW))
    got = attention_scores.attended(net, seen)[0].reshape(3, attention_scores.STRIDE, -1)
    ahead = attention_scores.WINDOW - attention_scores.STRIDE
    for w, window in enumerate(seen):
        x = net["embed"][window] + net["place"]
        q, k, v = (x @ net[name] for name in ("query", "key", "value"))
        for i in range(ahead, attention_scores.WINDOW):
            share = np.exp(np.minimum(q[i] @ k[: i + 1].T, 40))
            assert np.allclose(got[w, i - ahead], share @ v[: i + 1] / share.sum() @ net["back"] + x[i])
    net = attention_scores.started(rng.integers(0, 9, 256 * 256))
    seen = rng.integers(0, 256, (4_000, attention_scores.WINDOW))
    wanted = rng.integers(-1, 256, (4_000, attention_scores.STRIDE))
    # Gradients are means over known targets, however the batch is divided.
    known = [(part >= 0).sum() for part in (wanted[:1_000], wanted[1_000:])]
    parts = [attention_scores._gradients(net, *x) for x in ((seen[:1_000], wanted[:1_000]), (seen[1_000:], wanted[1_000:]))]
    tracemalloc.start()
    whole = attention_scores._gradients(net, seen, wanted)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert all(np.allclose(whole[n], np.average([p[n] for p in parts], axis=0, weights=known), atol=1e-5) for n in net)
    assert peak < 24_000_000

"""Packing, filter audit and cross-tokenizer alignment against plain code, on awkward rows."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from freshet.llm import filter_audit, token_alignment, window_packing
from freshet.llm.queries import LLM_ORACLES, LLM_QUERIES
from freshet.llm.tokens import ByteBpe, byte_bpe
from freshet.llm.window_packing import Packer, Piece

SF = "/root/testdata/sf0.001"
PIECES = public_tokenizers.path("piece_bpe_32k.model")
BPE = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, id long, part string, row long, n long, mask long"
RNG = random.Random(8)
WORDS = ["the", "of", "Und", "éau", "tion", "idiot", "zebra", "42", "…", "'s", "don't", "a\n\nb", "  x", "漢字かな", "𝔘"]
LONG = " ".join(RNG.choice(WORDS) for _ in range(9_000))
TEXTS = [None, "", "", " \t", "one", LONG, "ABC DEF $", LONG[:5_000], "no" * 4_000, "ünï ▁ code  x", "\x00nul <|endoftext|> <s> <0x41>",
         "one", "\n" * 700, LONG + " ▁", "word " * 120, "x", " ".join(f"w{i}" for i in range(150)), "\U000E0001 tag"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, [None, "en", "de", ""][i % 4], 1, "p", 2, 3, 4) for i, t in enumerate(TEXTS)]
    more = [rows[4], (None, "one", "en", 1, "p", 2, 3, 4), (None, LONG, None, 1, "p", 2, 3, 4)]
    return spark.createDataFrame([*rows, *more], SCHEMA).repartition(3)


def test_both_byte_encoders_agree_on_every_common_character():
    encoder = ByteBpe(BPE)
    chars = [c for c in map(chr, [*range(0xD800), *range(0xE000, 0x11000)]) if not encoder.OTHER.search(c)]
    texts = [f"a{c}b 1{c}2 .{c}, {c} {c}{c}\n{c}'s{c} 's{c}t {c}" for c in chars]
    want = encoder.whole(texts)
    assert encoder.fast and len(chars) > 30_000 and all(map(encoder.common, texts))
    assert [i for i, (a, b) in enumerate(zip(encoder.encode(texts), want)) if a != b] == []


def test_packer_places_best_and_emits_the_fullest():
    packer = Packer(length=8, most_open=2, max_pad=1, width=2)
    add = lambda n: [[len(p.ids) // 2 for p in s] for s in packer.add(Piece(1, 0, b"ab" * n, n))]
    assert add(5) == [] and add(4) == [] and add(3) == [[5, 3]]
    assert add(7) == [] and add(6) == [[7]]  # one id of padding
    assert add(5) == [[6, 2]]  # none fits, the fullest takes what it lacks; the rest, three, joins the four
    assert sorted(f for f, _ in packer.free) == [1]
    assert [[len(p.ids) // 2 for p in s] for s in packer.close()] == [[4, 3]]
    assert add(20)[:2] == [[8], [8]]


@pytest.mark.parametrize("settings", [{}, {"length": 64, "open_windows": 3, "max_pad": 2, "fan_in": 2}, {"end_id": None}])
def test_packing_holds_every_id_once(docs, settings):
    length, end = settings.get("length", 2048), settings.get("end_id", 1)
    rows = window_packing.packed(docs, BPE, **settings).collect()
    library = Tokenizer.from_file(BPE)
    kind = byte_bpe(BPE).kind
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r["ids"], kind)
        assert len(ids) == r["length"] > 0 and zlib.crc32(ids.astype("<u4").tobytes()) == r["ids_crc32"]
        by_doc[r["doc_id"]].append((r["start"], ids.tolist(), r["doc_tokens"]))
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    tail = [] if end is None else [end]
    for i, t in enumerate(TEXTS):
        want = library.encode(t or "", add_special_tokens=False).ids + tail
        got = sorted(by_doc[i])
        copies = 2 if i == 4 else 1
        assert sum(len(x[1]) for x in got) == copies * len(want) and all(x[2] == len(want) for x in got)
        if copies == 1:
            assert [n for x in got for n in x[1]] == want and [x[0] for x in got] == list(itertools.accumulate([0, *(len(x[1]) for x in got)]))[:-1]
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= length
        padding += 0 if at & (at - 1) == 0 else length - at
    assert padding <= settings.get("max_pad", 8) * len(by_sequence)
    assert window_packing.packed(docs.limit(0), BPE).count() == 0


def test_packing_of_a_table_has_little_padding(spark):
    found = LLM_QUERIES["op11_window_packing"](spark, SF)
    sizes = [r["n"] for r in found.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()]
    padding = sum(0 if n & (n - 1) == 0 else 2048 - n for n in sizes)
    documents = spark.read.parquet(f"{SF}/documents.parquet").count()
    cut = found.groupBy("doc_id").count().filter("count > 1").count()
    assert padding <= 0.002 * sum(sizes) and cut < documents / 2 and found.select("doc_id").distinct().count() == documents


def fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return (len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            bool(re.search(r"[#$%&*|]", text)))


def test_audit_is_every_order_applied(spark, docs):
    labels = [(4, 1, None), (5, 0, 1), (11, 1, 1), (11, 0, 0), (None, 1, 1), (99, 1, 1), (8, 1, 0), (16, 1, 0)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {tuple(r)[:3]: tuple(r)[3:] for r in filter_audit.audited(filter_audit.mask_counts(docs, marks)).collect()}
    rows = [(r["doc_id"], r["text"] or "", r["lang"] or "") for r in docs.collect()]
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t] = min(i, least.get(t, i))
    good, toxic = {4, 11, 8, 16}, {5, 11}
    parts = {p for _, _, p in rows}
    orders = ["".join(o) for o in itertools.permutations("ABCDE")]
    assert set(got) == {(p, o, s) for p in parts for o in orders for s in range(1, 6)}
    for p in parts:
        masks = [(i, {x for x, f in zip("ABCDE", (*fails(t), i is not None and i > least[t])) if f}) for i, t, q in rows if q == p]
        removed_by = Counter()
        for o in orders:
            left = masks
            for s, x in enumerate(o, 1):
                gone = [i for i, m in left if x in m]
                left = [(i, m) for i, m in left if x not in m]
                removed_by[x] += len(gone)
                want = (len(left), len(gone), sum(x in m for _, m in masks) - len(gone), sum(m == {x} for _, m in masks),
                        sum(i in good for i in gone), sum(i in toxic for i in gone))
                assert got[p, o, s][:6] == want, (p, o, s)
        assert all(got[p, o, s][6] == removed_by[o[s - 1]] for o in orders for s in range(1, 6))
    assert filter_audit.audited(filter_audit.mask_counts(docs.limit(0), marks)).count() == 0
    assert filter_audit.mask_counts(docs, marks.limit(0)).agg(F.sum("n")).first()[0] == len(rows)


def test_diagram_shares_nodes_and_swaps_levels():
    counts = {m: (1, 0, 0) for m in range(32)}
    diagram = filter_audit.Diagram(counts, "ABCDE")
    assert [len(x) for x in diagram.nodes] == [1] * 5
    counts = {m: (m * m, m, 1) for m in range(32)}
    diagram = filter_audit.Diagram(counts, "ABCDE")
    orders = {"ABCDE"}
    for place in filter_audit.adjacent_swaps(5):
        above, below = diagram.nodes[:place], diagram.nodes[place + 2 :]
        diagram.swap(place)
        assert diagram.nodes[:place] == above and diagram.nodes[place + 2 :] == below
        orders.add("".join(diagram.order))
    assert len(orders) == 120
    fresh = {m: sum(1 << "ABCDE".index(x) for i, x in enumerate(diagram.order) if m >> i & 1) for m in range(32)}
    assert list(diagram.steps()) == list(filter_audit.Diagram({m: counts[fresh[m]] for m in range(32)}, "".join(diagram.order)).steps())


@pytest.fixture(scope="module")
def plain():
    """Groups of a text by the two libraries, and nothing of ours."""
    a, b = Tokenizer.from_file(BPE), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letter = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(sorted(set(range(256)) - set(shown)))}

    def groups(text):
        if not text:
            return []
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_a = [bytes(letter[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        spelled = (" " + text).encode()
        if b"".join(bytes_a) != spelled or b"".join(bytes_b) != spelled:
            return []
        ends_a = list(itertools.accumulate(map(len, bytes_a)))
        ends_b = list(itertools.accumulate(map(len, bytes_b)))
        common, found, i, j = sorted(set(ends_a) & set(ends_b)), [], 0, 0
        for end in common:
            k, m = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
            found.append((ids_a[i:k], ids_b[j:m]))
            i, j = k, m
        return found

    return groups


@pytest.mark.parametrize("settings", [{}, {"chunk_chars": 40, "fan_in": 3, "common_pairs": 5}, {"chunk_chars": 997, "common_pairs": 0}])
def test_alignment_is_that_of_the_libraries(docs, plain, settings):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    groups = {t: plain(t) for _, t in rows}
    counts = Counter((a[-1], b[-1]) for _, t in rows for a, b in groups[t])
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    want = []
    for i, t in rows:
        found = groups[t]
        links = [(a[-1], b[-1]) for a, b in found]
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in found)
        want.append((i, sum(len(a) for a, _ in found), sum(len(b) for _, b in found), len(found), len(links),
                     sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
                     hashlib.sha256(text.encode()).hexdigest() if found else ""))
    got = [tuple(r) for r in token_alignment.aligned(docs, BPE, PIECES, **settings).collect()]
    key = lambda r: (r[0] is None, r)
    assert sorted(got, key=lambda r: str(key(r))) == sorted(want, key=lambda r: str(key(r)))
    assert any(r[1] == 0 and len(t or "") > 0 for r, (_, t) in zip(want, rows)) and sum(r[1] > 5_000 for r in want) >= 2


def test_alignment_of_no_rows(docs):
    assert token_alignment.aligned(docs.limit(0), BPE, PIECES).count() == 0


def test_fragments_compose_in_any_grouping():
    both = token_alignment.aligner(BPE, PIECES)
    tokens = both.tokens([LONG[:3_000]], [True])[0]
    cuts = sorted(random.Random(1).sample(range(1, int(tokens.a_end[-1])), 60))
    ranges = [tokens.after(a).until(b) for a, b in zip([0, *cuts], [*cuts, int(tokens.a_end[-1])])]
    parts = [token_alignment.fragment(t, i == 0) for i, t in enumerate(ranges)]
    def joined(f):
        assert not len(f.prefix.a) and not len(f.suffix.a)
        return "".join(both.spelled(t, t.common()) for t in f.closed)
    want = both.spelled(tokens, tokens.common())
    assert any(len(p.prefix.a) for p in parts) and any(not p.cut for p in parts)
    for seed in range(5):
        left, rng = list(parts), random.Random(seed)
        while len(left) > 1:
            i = rng.randrange(len(left) - 1)
            left[i : i + 2] = [left[i] + left[i + 1]]
        assert joined(left[0]) == want


def test_words_of_one_polynomial_hash_are_told_apart(spark):
    from freshet.llm import jaccard_join

    morse = "a"
    while len(morse) < 2048:
        morse += morse.translate(str.maketrans("ab", "ba"))
    other = morse.translate(str.maketrans("ab", "ba"))
    texts = [" ".join([w] * 1) for w in (morse, other)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r["component_id"] for r in jaccard_join.jaccard_groups(df).collect()) == [0, 1]


def test_clashing_names_and_repeated_queries(spark):
    from freshet.llm import jaccard_join, line_dedup, vantage_point

    names = ["doc_id", "text", "_key", "_kept", "_id", "_row_key", "_stay", "_parts", "_unnamed", "c0", "c1", "n_lines"]
    rows = [(i, t, *[f"v{k}" for k in range(len(names) - 2)]) for i, t in ((1, "one line\nsame"), (2, "same\ntwo"), (None, "three four"))]
    df = spark.createDataFrame(rows, ", ".join(f"{n} {'long' if n == 'doc_id' else 'string'}" for n in names))
    found = line_dedup.without_repeated_lines(df)
    assert found.columns == [*names[:-1], "n_lines", "n_dropped"]
    got = {r["doc_id"]: r for r in found.collect()}
    assert got[2]["text"] == "two" and got[1]["_key"] == "v0" and got[1]["_kept"] == "v1" and got[1]["c1"] == "v8"
    kept = jaccard_join.first_of_each_group(df)
    assert kept.columns == names and {r["_key"] for r in kept.collect()} == {"v0"} and kept.count() == 3
    vectors = [(i, [float(i), 1.0]) for i in range(30)] + [(0, [0.0, 1.0]), (0, [29.0, 1.0])]
    near = vantage_point.nearest(spark.createDataFrame(vectors, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, k=3)
    got = sorted((r["rank"], r["vec_id"]) for r in near.collect())
    assert got == [(1, 1), (1, 29), (2, 2), (2, 28), (3, 3), (3, 27)]

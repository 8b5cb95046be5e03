import random
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from freshet.operators import series as S

SCHEMA = "k string, t long, block long, x double, s string"


def frame(spark, rows):
    rows = list(rows)
    random.Random(7).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def random_rows(seed, hot=400, keys=12, per_block=7):
    """One hot key with most of the rows, several small keys, gaps and missing values."""
    rng, rows = random.Random(seed), []
    for k in range(keys):
        t = 0
        for _ in range(hot if k == 0 else rng.randint(1, 25)):
            t += rng.choice([1, 1, 1, 2, 40])
            x = None if rng.random() < 0.25 else float(rng.randint(0, 3))
            s = rng.choice(["a", "a", "b", None])
            rows.append((f"k{k}", t, t // per_block, x, s))
    return rows


def by_key(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r[0], r[1])):
        out.setdefault(r[0], []).append(r)
    return out


MODES = {"plain": S.Series(("k",), ("t",)), "blocked": S.Series(("k",), ("t",), "block")}


@pytest.fixture(params=list(MODES))
def series(request):
    return MODES[request.param]


@pytest.fixture(params=[1, 2])
def rows(request):
    return random_rows(request.param)


def test_positions(spark, series, rows):
    got = {(r.k, r.t): r.position for r in S.positions(frame(spark, rows), series).collect()}
    assert got == {(k, r[1]): i + 1 for k, g in by_key(rows).items() for i, r in enumerate(g)}


def test_differences(spark, series, rows):
    got = {(r.k, r.t): r.d for r in S.differences(frame(spark, rows), series, "x", "d").collect()}
    want = {}
    for k, g in by_key(rows).items():
        for i, r in enumerate(g):
            before = g[i - 1][3] if i else None
            want[(k, r[1])] = None if r[3] is None or before is None else r[3] - before
    assert got == want


def runs_by_hand(rows, column, wanted):
    out = []
    for k, g in by_key(rows).items():
        at = 1
        for number, (value, part) in enumerate(groupby(r[column] for r in g), 1):
            n = len(list(part))
            out.append((k, number, value, at, at + n - 1, n))
            at += n
    return sorted(o for o in out if wanted(o)) if wanted else out


def test_run_lengths(spark, series, rows):
    got = [tuple(r) for r in S.run_lengths(frame(spark, rows), series, "s").collect()]
    assert sorted(got, key=str) == sorted(runs_by_hand(rows, 4, None), key=str)


def valid_by_hand(rows, minimum):
    flagged = [(*r[:3], r[3] is not None, r[4]) for r in rows]
    return sorted((o[0], *o[3:]) for o in runs_by_hand(flagged, 3, lambda o: o[2] and o[5] >= minimum))


@pytest.mark.parametrize("minimum", [1, 3])
def test_valid_runs(spark, series, rows, minimum):
    got = sorted(tuple(r) for r in S.valid_runs(frame(spark, rows), series, "x", minimum).collect())
    assert got == valid_by_hand(rows, minimum)
    assert all(length == end - start + 1 for _, start, end, length in got)


def test_longest_runs_take_the_earliest(spark):
    rows = [("k", i, 0, x, None) for i, x in enumerate([1.0, 1.0, None, 1.0, 1.0])]
    runs = S.valid_runs(frame(spark, rows), MODES["plain"], "x")
    assert tuple(S.longest_runs(runs, ["k"]).first()) == ("k", 1, 2, 2)


def test_small_runs(spark):
    rows = [("k", i, i, x, None) for i, x in enumerate([None, 1.0, 2.0, None, 3.0])]
    for s in MODES.values():
        assert sorted(tuple(r) for r in S.valid_runs(frame(spark, rows), s, "x").collect()) == [
            ("k", 2, 3, 2),
            ("k", 5, 5, 1),
        ]
        assert [tuple(r) for r in S.valid_runs(frame(spark, rows), s, "x", 2).collect()] == [("k", 2, 3, 2)]


def test_run_lengths_decode_to_the_rows(spark, series, rows):
    df = frame(spark, rows)
    decoded = S.expand_runs(S.run_lengths(df, series, "s"), ["k"], ["value"])
    got = sorted(((r.k, r.position, r.value) for r in decoded.collect()), key=str)
    want = sorted(((k, i + 1, r[4]) for k, g in by_key(rows).items() for i, r in enumerate(g)), key=str)
    assert got == want


def test_long_runs_expand_in_spans(spark, monkeypatch):
    monkeypatch.setattr(S, "SPAN", 8)
    runs = spark.createDataFrame([("k", 3, 40), ("k", 41, 41), ("j", 1, 8), ("j", 9, 24)], "k string, start_index long, end_index long")
    got = sorted((r.k, r.position) for r in S.expand_runs(runs, ["k"], spread=True).collect())
    assert got == [("j", i) for i in range(1, 25)] + [("k", i) for i in range(3, 42)]


@pytest.mark.parametrize("n", [1, 3, 5])
def test_rolling(spark, series, rows, n, monkeypatch):
    monkeypatch.setattr(S, "SPAN", 6)
    df = S.rolling(frame(spark, rows), series, {"m": (F.avg, "x", n), "top": (F.max, "x", n)})
    got = {(r.k, r.t): (r.m, r.top) for r in df.collect()}
    assert len(got) == len(rows)
    for k, g in by_key(rows).items():
        for i, r in enumerate(g):
            window = [q[3] for q in g[max(0, i - n + 1) : i + 1]]
            mean, top = got[(k, r[1])]
            if len(window) < n or None in window:
                assert mean is None and top is None
            else:
                assert mean == pytest.approx(sum(window) / n) and top == max(window)


def test_rolling_fixtures(spark):
    def means(values):
        rows = [("k", i, 0, x, None) for i, x in enumerate(values)]
        got = S.rolling_mean(frame(spark, rows), MODES["plain"], 3, "x", "m").orderBy("t").collect()
        return [r.m for r in got]

    assert means([1.0, 2.0, 3.0, 4.0]) == [None, None, 2.0, 3.0]
    assert means([1.0, None, 3.0, 4.0, 5.0]) == [None, None, None, None, 4.0]


def test_own_segments_match_runs_joined_on_position(spark, rows):
    df, s = frame(spark, rows), MODES["plain"]
    one_pass = S.own_segments(df, s, "x", 2).select("k", "t", "position", "segment_id")
    joined = S.assign_segments(S.positions(df, s), S.valid_runs(df, s, "x", 2), ["k"])
    assert sorted(map(tuple, one_pass.collect())) == sorted(
        map(tuple, joined.select("k", "t", "position", "segment_id").collect())
    )


def test_centred_ignores_missing(spark):
    rows = [("k", i, 0, x, None) for i, x in enumerate([1.0, None, 3.0])]
    got = S.centred(frame(spark, rows), ["k"], F.col("x"), "c").orderBy("t").collect()
    assert [r.c for r in got] == [-1.0, None, 1.0]


def test_chunks_of_seven(spark):
    labels = spark.createDataFrame([(f"g{i:02d}",) for i in range(15)] * 2, "gauge string").repartition(4)
    got = {r.gauge: r.split for r in S.chunks(labels, "gauge", 7).collect()}
    assert got == {f"g{i:02d}": i // 7 + 1 for i in range(15)}


def test_global_positions(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(6)
    rows = S.global_positions(df, ["v"]).collect()
    assert {r.v: r.position for r in rows} == {i: i + 1 for i in range(1000)}


def test_a_missing_block_is_an_error(spark):
    df = spark.createDataFrame([("k", 1, None, 1.0, "a"), ("k", 2, 1, 1.0, "a")], SCHEMA)
    with pytest.raises(Exception, match="must not be missing"):
        S.positions(df, MODES["blocked"]).collect()


def test_nan_counts_as_missing(spark):
    rows = [("k", i, i, x, None) for i, x in enumerate([1.0, float("nan"), 2.0, 3.0])]
    for s in MODES.values():
        got = sorted(tuple(r) for r in S.valid_runs(frame(spark, rows), s, "x").collect())
        assert got == [("k", 1, 1, 1), ("k", 3, 4, 2)]
    assert sorted(r.t for r in S.own_segments(frame(spark, rows), MODES["plain"], "x", 2).collect()) == [2, 3]

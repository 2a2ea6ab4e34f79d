"""Blocked scans and the skew join against plain loops, with blocks far smaller than the data."""

import random

import pytest

from docfold.operators import progress, segment
from docfold.operators.skew import skew_join

SCHEMA = "collection string, offset bigint, op string, bytes bigint"


def ops(seed, n):
    rng = random.Random(seed)
    out, offset = [], 0
    for _ in range(n):
        offset += rng.choice([1, 1, 1, 2, 40])
        kind = rng.choice(["set", "set", "delete"])
        out.append((rng.choice("aaab"), offset, kind, 0 if kind == "delete" else rng.randint(1, 60)))
    return out


def by_part(rows):
    parts = {}
    for r in rows:
        parts.setdefault(r[0], []).append(r)
    return parts


@pytest.mark.parametrize("width", [3, 16, 1000])
@pytest.mark.parametrize("seed", range(2))
def test_runs(spark, seed, width):
    rows = ops(seed, 150)
    expected = set()
    for part, seq in by_part(rows).items():
        run, start = -1, None
        groups = []
        for r in seq:
            if r[2] != start:
                run, start = run + 1, r[2]
                groups.append([])
            groups[-1].append(r)
        expected |= {(part, i, g[0][2], len(g), g[0][1], g[-1][1]) for i, g in enumerate(groups)}
    got = segment.runs(spark.createDataFrame(rows, SCHEMA), width=width)
    assert {tuple(r) for r in got.select("collection", "run", "op", "n", "first_offset", "last_offset").collect()} == expected


def greedy(rows, cap, size):
    out = {}
    for part, seq in by_part(rows).items():
        fill = have = batch = 0
        for r in seq:
            out[part, r[1]] = batch
            fill, have = fill + r[3], have + 1
            if fill >= cap or (size and have >= size):
                fill, have, batch = 0, 0, batch + 1
    return out


@pytest.mark.parametrize("cap,size", [(100, None), (100, 4), (10_000, None), (10_000, 7), (1, None)])
@pytest.mark.parametrize("width", [2, 9, 5000])
def test_batches_by_bytes(spark, cap, size, width, monkeypatch):
    monkeypatch.setattr(segment, "_GROUP_BLOCKS", 3)
    rows = ops(cap + width, 120)
    got = segment.batches_by_bytes(spark.createDataFrame(rows, SCHEMA), cap, size=size, width=width)
    assert {(r.collection, r.offset): r.batch for r in got.collect()} == greedy(rows, cap, size)


@pytest.mark.parametrize("width", [4, 1000])
def test_batches_by_count(spark, width):
    rows = ops(5, 150)
    got = segment.batches_by_count(spark.createDataFrame(rows, SCHEMA), 6, width=width)
    assert {(r.collection, r.offset): r.batch for r in got.collect()} == greedy(rows, 1 << 60, 6)
    with pytest.raises(ValueError):
        segment.batches_by_count(got, 0)


def test_skew_join_keeps_every_row(spark):
    rng = random.Random(1)
    left = [("hot" if rng.random() < 0.5 else f"k{rng.randrange(30)}", n) for n in range(600)] + [(None, -1)]
    right = [("hot", "H")] + [(f"k{i}", f"v{i}") for i in range(0, 30, 2)]
    table = dict(right)
    df, other = spark.createDataFrame(left, "k string, n bigint"), spark.createDataFrame(right, "k string, v string")
    for parts in (1, 7, 90, 5_000):
        got = skew_join(df, other, ["k"], "left", spread=["n"], parts=parts)
        assert sorted((r.k or "", r.n, r.v or "") for r in got.collect()) == sorted((k or "", n, table.get(k) or "") for k, n in left)
        inner = skew_join(df, other, ["k"], "inner", spread=["n"], parts=parts)
        assert inner.count() == sum(k in table for k, _ in left)


@pytest.mark.parametrize("steps", [4, 50])
def test_percentiles_are_nearest_rank(spark, steps):
    rng = random.Random(3)
    rows = [(g, float(rng.choice([rng.randrange(20), rng.random() * 1000]))) for g in "aab" for _ in range(173)]
    got = progress.latency_stats(spark.createDataFrame(rows, "g string, v double"), "v", ["g"], (0.5, 0.95, 0.99), steps)
    for r in got.collect():
        values = sorted(v for g, v in rows if g == r.g)
        n = len(values)
        assert (r.p50, r.p95, r.p99) == tuple(values[max(0, -(-int(p * 100) * n // 100) - 1)] for p in (0.5, 0.95, 0.99))
        assert r.mean == pytest.approx(sum(values) / n) and r.samples == n
    one = progress.latency_stats(spark.createDataFrame([(5.0,)], "v double"), "v").first()
    assert (one.p95, one.p99, one.mean) == (5.0, 5.0, 5.0)


def test_safe_offsets(spark):
    acks = spark.createDataFrame([("t", 0, 0, True), ("t", 0, 1, False), ("t", 0, 2, True), ("u", 0, 5, True), ("u", 1, 9, False)],
                                 "topic string, partition int, offset bigint, acked boolean")
    current = spark.createDataFrame([("t", 0, 3), ("u", 0, 7), ("u", 1, 10), ("w", 2, 44)], "topic string, partition int, offset bigint")
    got = {(r.topic, r.partition): r.safe_offset for r in progress.safe_offsets(acks, current).collect()}
    assert got == {("t", 0): 1, ("u", 0): 6, ("u", 1): 9, ("w", 2): 44}


def test_counters_and_latency(spark):
    parts = spark.createDataFrame([("a", 3, 1, 0, 0, 10.0, 2), ("a", 1, 0, 2, 1, 999.0, 0), ("b", 0, 0, 0, 0, 7.0, 0)],
                                  "p string, written int, failed int, retries int, queue int, mean double, n int")
    total = progress.counters(parts).first()
    assert (total.written, total.failed, total.retries, total.queue) == (4, 1, 2, 1)
    got = {r.p: r.mean_ms for r in progress.weighted_latency(parts, "mean", "n", ["p"]).collect()}
    assert got == {"a": 10.0, "b": 0.0}
    assert progress.weighted_latency(parts.limit(0), "mean", "n").first().mean_ms == 0.0


def test_stall_clock_starts_at_the_first_unanswered_failure(spark):
    rows = [("ok", 10, False), ("ok", 20, True), ("bad", 5, True), ("bad", 30, False), ("bad", 90, False), ("never", 60, False), ("fine", 1, True)]
    df = spark.createDataFrame(rows, "k string, at bigint, ok boolean")
    got = {r.k: (r.failing_since, r.stalled) for r in progress.stalled(df, 100, 50, ["k"]).collect()}
    assert got == {"ok": (None, False), "bad": (30, True), "never": (60, False), "fine": (None, False)}
    assert not any(r.stalled for r in progress.stalled(df, 10_000, -1, ["k"]).collect())

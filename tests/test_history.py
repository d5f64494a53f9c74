from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from triangulum.operators import scd2, skew
from triangulum.operators.quality import expect, expect_or_drop, expectation_report

SCHEMA = "k string, seq int, value double, event_id int"


def by_hand(rows, track=True):
    """Expected versions of (k, seq, value, event_id) rows."""
    best = {}
    for k, s, v, e in rows:
        if (k, s) not in best or e > best[(k, s)][1]:
            best[(k, s)] = (v, e)
    out = []
    for k in sorted({k for k, _ in best}):
        kept = []
        for s in sorted(s for kk, s in best if kk == k):
            v = best[(k, s)][0]
            if not track or not kept or kept[-1][1] != v:
                kept.append((s, v))
        # compare with the previous event, not the previous kept version
        if track:
            events = sorted((s, best[(kk, s)][0]) for kk, s in best if kk == k)
            kept = [ev for i, ev in enumerate(events) if i == 0 or events[i - 1][1] != ev[1]]
        out += [(k, s, v, kept[i + 1][0] if i + 1 < len(kept) else None) for i, (s, v) in enumerate(kept)]
    return sorted(out, key=lambda r: (r[0], r[1]))


def versions(df):
    rows = df.select("k", "start_at", "value", "end_at").collect()
    return sorted([tuple(r) for r in rows], key=lambda r: (r[0], r[1]))


def sample(n=400, seed=3):
    rng = random.Random(seed)
    keys = ["hot"] * 6 + ["a", "b", "c"]
    return [(rng.choice(keys), rng.randrange(150), rng.choice([1.0, 2.0, None]), i) for i in range(n)]


@pytest.mark.parametrize("max_rows", [10_000, 9, 2])
@pytest.mark.parametrize("track", [("value",), None])
def test_versions_match_by_hand_also_when_hot_keys_are_sliced(spark, max_rows, track):
    rows = sample()
    df = spark.createDataFrame(rows, SCHEMA)
    got = scd2.scd2_batch(df, ["k"], "seq", track, "event_id", max_rows=max_rows)
    assert versions(got) == by_hand(rows, track is not None)


def test_small_cases(spark):
    rows = [
        ("late", 3, 5.0, 0), ("late", 1, 4.0, 1), ("late", 2, 4.0, 2),  # out of order, unchanged value
        ("tie", 1, 1.0, 3), ("tie", 1, 2.0, 4),  # equal sequence: highest event wins
        ("one", 9, 7.0, 5),
    ]
    got = versions(scd2.scd2_batch(spark.createDataFrame(rows, SCHEMA), ["k"], "seq", ["value"], "event_id"))
    assert got == [("late", 1, 4.0, 3), ("late", 3, 5.0, None), ("one", 9, 7.0, None), ("tie", 1, 2.0, None)]


def test_intervals_tile_and_exactly_one_is_open(spark):
    df = scd2.scd2_batch(spark.createDataFrame(sample(seed=8), SCHEMA), ["k"], "seq", ["value"], "event_id")
    open_rows = df.groupBy("k").agg(F.count_if(F.col("end_at").isNull()).alias("n"))
    assert {r.n for r in open_rows.collect()} == {1}
    ends = {(r.k, r.end_at) for r in df.collect() if r.end_at is not None}
    starts = {(r.k, r.start_at) for r in df.collect()}
    assert ends <= starts


def test_current_equals_latest(spark):
    df = spark.createDataFrame(sample(seed=5), SCHEMA)
    current = scd2.current_versions(scd2.scd2_batch(df, ["k"], "seq", None, "event_id"))
    latest = scd2.scd1_latest(df, ["k"], "seq", "event_id")
    cols = ["k", "seq", "value", "event_id"]
    assert sorted(map(tuple, current.select(*cols).collect()), key=str) == sorted(
        map(tuple, latest.select(*cols).collect()), key=str
    )


def test_neighbours_with_null_values_and_string_order(spark):
    rows = [("h", f"{i:03d}", None if i % 4 == 0 else i) for i in range(60)] + [("x", "000", 1)]
    df = spark.createDataFrame(rows, "k string, o string, v int")
    cols = {"before": (F.col("v"), -1), "after": (F.col("v"), 1)}
    plain = skew.with_neighbours(df, ["k"], "o", cols).collect()
    sliced = skew.with_neighbours(df, ["k"], "o", cols, skew.find_hot(df, ["k"], 7), 7).collect()
    assert sorted(map(str, plain)) == sorted(map(str, sliced))


def test_hot_keys_are_really_cut(spark):
    df = spark.createDataFrame([("h", i) for i in range(1000)] + [("c", 1)], "k string, o int")
    hot = skew.hot_keys(df, ["k"], 100)
    assert [r.k for r in hot.collect()] == ["h"]
    sizes = skew.slice_hot_keys(df, ["k"], "o", 100, hot).groupBy("k", "_slice").count().collect()
    assert len(sizes) >= 9 and max(r["count"] for r in sizes) < 250


def test_expectations(spark):
    df = spark.createDataFrame([(1, 1.0, "a"), (2, -1.0, "a"), (3, None, "a"), (4, 5.0, "b")], "id int, v double, p string")
    rules = {"positive": "v >= 0", "known": F.col("p").isin("a")}
    assert [r.id for r in expect_or_drop(df, rules).collect()] == [1]
    report = {(r.rule, r.action): (r.passed, r.failed) for r in expectation_report(df, rules, {"small": "id < 3"}).collect()}
    assert report == {("positive", "drop"): (2, 2), ("known", "drop"): (3, 1), ("small", "warn"): (2, 2)}
    assert expect(df, rules).count() == 4

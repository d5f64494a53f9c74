from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from triangulum.operators import scd2
from triangulum.session import scratch_path
from triangulum.sources.snapshots import Snapshots
from triangulum.streaming import stores
from triangulum.streaming.flows import HistoryTable, stream_scan
from triangulum.streaming.stores import PartialTable, partial_stream

EVENTS = "k string, v double, at timestamp"


def events(spark, n, keys, seed=1):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    rows = [(f"k{rng.randrange(keys)}", float(rng.randrange(3)), start + timedelta(minutes=i)) for i in range(n)]
    return spark.createDataFrame(rows, EVENTS)


def as_rows(df):
    return sorted(tuple(map(str, r)) for r in df.select("k", "v", "start_at", "end_at").collect())


@pytest.mark.parametrize("literal_depth", [0, 12])
def test_buckets_split_on_their_own(spark, monkeypatch, literal_depth):
    monkeypatch.setattr(stores, "LITERAL_DEPTH", literal_depth)
    table = HistoryTable(spark, scratch_path(spark, "grow"), ["k"], "at", ["v"], buckets=2, bucket_rows=40)
    feed = events(spark, 400, 200).cache()
    for turn in range(2):
        table.merge(feed.filter(F.pmod(F.xxhash64("at"), F.lit(2)) == turn))
    want = scd2.scd2_batch(feed, ["k"], "at", ["v"])
    assert as_rows(table.history()) == as_rows(want)
    depths = table.depths()
    assert len(depths) >= 8 and len(set(depths.values())) >= 1
    assert sum(2.0**-d for d in depths.values()) == 1.0  # the buckets cover every hash once
    # one more key writes one row to one bucket and leaves the others' versions alone
    before = table._manifest()
    table.merge(spark.createDataFrame([("new", 1.0, datetime(2025, 1, 1))], EVENTS))
    after = table._manifest()
    assert sum(before.buckets.get(n) != b for n, b in after.buckets.items()) == 1
    assert spark.read.parquet(f"{table.path}/data/version={after.version}").count() == 1
    table.compact()
    table.vacuum()
    assert as_rows(table.history()) == as_rows(want.unionByName(table.history().filter("k = 'new'")))


def test_a_key_that_fills_a_bucket_is_not_split_for_ever(spark):
    table = HistoryTable(spark, scratch_path(spark, "hot"), ["k"], "at", ["v"], buckets=1, bucket_rows=10)
    feed = events(spark, 120, 1)
    for turn in range(2):
        table.merge(feed.filter(F.pmod(F.xxhash64("at"), F.lit(2)) == turn))
    assert as_rows(table.history()) == as_rows(scd2.scd2_batch(feed, ["k"], "at", ["v"]))
    assert len(table.depths()) == 1
    table.merge(feed.filter("false"))  # an empty batch writes nothing
    with pytest.raises(ValueError, match="power of two"):
        HistoryTable(spark, table.path, ["k"], "at", buckets=3)
    with pytest.raises(ValueError, match="nothing"):
        HistoryTable(spark, scratch_path(spark, "none"), ["k"], "at").history()


SALES = "k string, x double"


def partial_table(spark, path):
    partials = {"total": ("sum", "x"), "n": ("count", "x"), "low": ("min", "x"), "high": ("max", "x")}
    return PartialTable(spark, path, {"k": "k", "kind": F.upper("k")}, partials, buckets=8)


def partial_rows(df):
    return {r.k: (None if r.total is None else float(r.total), r.n, r.low, r.high, r._rows) for r in df.collect()}


def test_partials_of_files_seen_once(spark):
    base = scratch_path(spark, "partials")
    table = partial_table(spark, f"{base}/state")
    rows = [("a", 1.5), ("a", None), (None, 2.0), ("b", -3.0), ("c", 0.1)]
    spark.createDataFrame(rows, SALES).write.parquet(f"{base}/in")
    partial_stream(stream_scan(spark, f"{base}/in", SALES), table, f"{base}/cp")
    spark.createDataFrame([("a", 4.0), ("d", None)], SALES).write.mode("append").parquet(f"{base}/in")
    partial_stream(stream_scan(spark, f"{base}/in", SALES), table, f"{base}/cp")
    want = {
        "a": (5.5, 2, 1.5, 4.0, 3), None: (2.0, 1, 2.0, 2.0, 1), "b": (-3.0, 1, -3.0, -3.0, 1),
        "c": (0.1, 1, 0.1, 0.1, 1), "d": (None, 0, None, None, 1),
    }
    assert partial_rows(table.rows()) == want
    # the second update wrote its two keys and no others
    assert spark.read.parquet(f"{table.path}/data/version=1").count() == 2
    # a batch that comes again, as after a failure between commit and checkpoint, is passed over
    newest = table._manifest().marks[f"{base}/cp"]
    assert not table.merge(spark.createDataFrame([("a", 9.0)], SALES), f"{base}/cp", newest)
    assert partial_rows(table.rows()) == want
    # nothing new: nothing written
    partial_stream(stream_scan(spark, f"{base}/in", SALES), table, f"{base}/cp")
    assert list(table._versions("data")) and max(table._versions("data")) == 1


def test_an_update_reads_only_the_buckets_of_its_keys(spark):
    table = partial_table(spark, scratch_path(spark, "touch"))
    many = spark.range(4_000).selectExpr("concat('k', id) AS k", "1.0D AS x")
    table.merge(many, "s", 0)
    one = table.partials_of(spark.createDataFrame([("k7", 1.0)], SALES))
    touched = table._touched(one, table._manifest())
    assert len(touched) == 1
    read = table._known(one, touched).inputFiles()
    assert read and all(f"bucket={touched[0].name}/" in f for f in read)


def test_publications(spark):
    published = Snapshots(spark, scratch_path(spark, "pub"))
    with pytest.raises(ValueError, match="nothing"):
        published.paths()
    a, b = spark.range(3), spark.range(5)
    assert published.publish({"a": a, "b": b}) == 0
    pinned = published.read("a")
    with pytest.raises(PySparkException):
        published.publish({"a": b, "b": b.withColumn("id", F.raise_error(F.lit("stop")).cast("long"))})
    assert published.numbers() == [0] and published.read("a").count() == 3
    assert published.publish({"a": b}) == 1
    assert (published.read("a").count(), published.read("b").count(), pinned.count()) == (5, 5, 3)
    assert published.read("a", 0).count() == 3
    with pytest.raises(ValueError, match="publication 7"):
        published.read("a", 7)
    with pytest.raises(ValueError, match="another writer"):
        published._swap(1, {})
    published.vacuum()
    assert published.numbers() == [1] and published.read("b").count() == 5
    with pytest.raises(ValueError):
        published.read("a", 0)

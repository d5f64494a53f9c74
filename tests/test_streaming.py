from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from triangulum.operators import scd2
from triangulum.plans import medallion
from triangulum.session import scratch_path
from triangulum.streaming.flows import HistoryTable, bronze_stream, scd2_stream, stream_scan

KEYS = ["province", "ref_date", "indicator_name"]


def events(n=300, seed=1):
    rng = random.Random(seed)
    names = ["hpi_index"] * 3 + ["unemployment_rate", "other"]
    start = datetime(2024, 1, 1)
    return [
        (rng.choice(["P0", "P1"]), rng.choice(["2024-01", "2024-02"]), rng.choice(names), rng.choice([1.0, 2.0, 3.0, None]), start + timedelta(minutes=i))
        for i in range(n)
    ]


def frame(spark, rows):
    return spark.createDataFrame(rows, "province string, ref_date string, indicator_name string, value double, ingested_at timestamp")


def as_rows(df):
    return sorted(tuple(map(str, r)) for r in df.select(*KEYS, "value", "start_at", "end_at").collect())


@pytest.mark.parametrize("order", ["reverse", "shuffled"])
def test_any_batch_split_gives_the_batch_history(spark, order):
    rows = events(160)
    parts = [rows[i : i + 80] for i in range(0, len(rows), 80)]
    if order == "reverse":
        parts.reverse()
    elif order == "shuffled":
        mixed = rows[:]
        random.Random(9).shuffle(mixed)
        parts = [mixed[i::3] for i in range(3)]
    table = HistoryTable(spark, scratch_path(spark, "hist"), KEYS, "ingested_at", ["value"], buckets=4)
    for part in parts:
        table.merge(frame(spark, part))
    table.merge(frame(spark, parts[-1]))  # a batch run twice changes nothing
    want = scd2.scd2_batch(frame(spark, rows), KEYS, "ingested_at", ["value"])
    assert as_rows(table.history()) == as_rows(want)
    assert table.current().count() == want.filter("end_at IS NULL").count()


def test_stream_through_bronze_and_history(spark):
    base = scratch_path(spark, "flow")
    rows = events(120, seed=2)
    for i in range(0, 120, 40):
        frame(spark, rows[i : i + 40]).coalesce(1).write.mode("append").parquet(f"{base}/landing")
    schema = frame(spark, rows[:1]).schema

    def bronze():
        return bronze_stream(
            stream_scan(spark, f"{base}/landing", schema, 1), f"{base}/bronze", f"{base}/cp1",
            medallion.macro_rules(), {"small": "value < 3"},
        )

    query = bronze()
    kept = [r for r in rows if r[3] is not None and r[2] != "other"]
    assert spark.read.parquet(f"{base}/bronze").count() == len(kept)
    seen = [p["observedMetrics"]["expectations"] for p in query.recentProgress if p.get("observedMetrics")]
    assert sum(m["failed_small"] for m in seen) == sum(r[3] >= 3 for r in kept)
    table = HistoryTable(spark, f"{base}/hist", KEYS, "ingested_at", ["value"], buckets=4)
    batches = []
    scd2_stream(stream_scan(spark, f"{base}/bronze", schema, 1), table, f"{base}/cp2", batches.append)
    assert len(batches) >= 2
    assert as_rows(table.history()) == as_rows(scd2.scd2_batch(frame(spark, kept), KEYS, "ingested_at", ["value"]))
    # a second run sees only what is new
    late = [("P0", "2024-01", "hpi_index", 9.0, datetime(2023, 12, 31))]
    frame(spark, late).write.mode("append").parquet(f"{base}/landing")
    bronze()
    scd2_stream(stream_scan(spark, f"{base}/bronze", schema), table, f"{base}/cp2")
    want = scd2.scd2_batch(frame(spark, kept + late), KEYS, "ingested_at", ["value"])
    assert as_rows(table.history()) == as_rows(want)


def test_restart_with_a_new_checkpoint_keeps_everything(spark):
    base = scratch_path(spark, "restart")
    rows = [r for r in events(60, seed=3)]
    table = HistoryTable(spark, f"{base}/hist", KEYS, "ingested_at", ["value"], buckets=4)
    for turn, part in enumerate((rows[:40], rows[40:])):
        frame(spark, part).write.parquet(f"{base}/in{turn}")
        schema = frame(spark, part).schema
        scd2_stream(stream_scan(spark, f"{base}/in{turn}", schema), table, f"{base}/cp{turn}")
    want = as_rows(scd2.scd2_batch(frame(spark, rows), KEYS, "ingested_at", ["value"]))
    assert as_rows(table.history()) == want
    table.compact()
    table.vacuum()
    assert as_rows(table.history()) == want
    assert list(table._versions("data")) == list(table._versions("manifest"))


def test_a_merge_rewrites_only_the_keys_of_its_batch(spark):
    table = HistoryTable(spark, scratch_path(spark, "few"), KEYS, "ingested_at", ["value"], buckets=4)
    columns = ["province", "'2024-01' AS ref_date", "'hpi_index' AS indicator_name", "1.0D AS value"]
    many = spark.range(20_000).selectExpr("IF(id = 7, NULL, concat('P', id)) AS province").selectExpr(
        *columns, "timestamp'2024-01-01' AS ingested_at"
    )
    table.merge(many)
    table.merge(many.limit(500).withColumns({"value": F.lit(2.0), "ingested_at": F.lit(datetime(2024, 1, 2))}))
    assert spark.read.parquet(f"{table.path}/data/version=1").count() == 1_000
    assert table.history().count() == 20_500
    assert table.current().count() == 20_000
    assert table.history().filter("province IS NULL").count() == 2
    with pytest.raises(ValueError, match="buckets"):
        HistoryTable(spark, table.path, KEYS, "ingested_at", ["value"], buckets=8).history()


def test_full_update(spark):
    base = scratch_path(spark, "update")
    claims = [("Homeowners", "Ontario", f"2020-0{m}-05", 10.0 * m, 20.0, "Fire") for m in (1, 1, 2, 3)] + [("Bad", "Ontario", "2020-01-01", 1.0, 1.0, "Fire")]
    spark.createDataFrame(claims, "product_line string, region string, loss_date string, claim_amount double, monthly_prem_exposure double, claim_type string").write.parquet(f"{base}/claims")
    reserves = [("Homeowners__Ontario", "Homeowners", "Ontario", "2020-01-01", f"2020-0{k + 1}-01", k, 10.0 * k, 20.0 * k, 10.0 * k) for k in (1, 2)]
    spark.createDataFrame(reserves, "segment_id string, product_line string, region string, accident_month string, development_month string, dev_lag int, cumulative_paid double, cumulative_incurred double, case_reserve double").write.parquet(f"{base}/reserves")
    macro = [("Ontario", f"2020-0{m}", "hpi_index", 100.0 + m, datetime(2024, 1, m)) for m in (1, 2)]
    frame(spark, macro).write.parquet(f"{base}/macro")
    landing = {n: f"{base}/{n}" for n in ("claims", "reserves", "macro")}
    out = medallion.run_update(spark, landing, f"{base}/out", {"Ontario": "Ontario"}, buckets=2)
    monthly = spark.read.parquet(out["gold_claims_monthly"])
    assert {r.month: r.claims_count for r in monthly.collect()} == {date(2020, 1, 1): 2, date(2020, 2, 1): 1, date(2020, 3, 1): 1}
    tri = spark.read.parquet(out["gold_reserve_triangle"]).orderBy("dev_lag").collect()
    assert [(r.cumulative_paid, r.incremental_paid) for r in tri] == [(10.0, 10.0), (20.0, 10.0)]
    # a revision and a new claim arrive
    frame(spark, [("Ontario", "2020-01", "hpi_index", 50.5, datetime(2024, 2, 1))]).write.mode("append").parquet(f"{base}/macro")
    spark.createDataFrame(claims[:1], monthly.sparkSession.read.parquet(f"{base}/claims").schema).write.mode("append").parquet(f"{base}/claims")
    out = medallion.run_update(spark, landing, f"{base}/out", {"Ontario": "Ontario"}, buckets=2)
    macro_out = spark.read.parquet(out["gold_macro_features"]).orderBy("month").collect()
    assert [r.hpi_index for r in macro_out] == [50.5, 102.0]
    assert spark.read.parquet(out["gold_claims_monthly"]).agg(F.sum("claims_count")).first()[0] == 5
    fresh = medallion.run_update(spark, landing, f"{base}/out", {"Ontario": "Ontario"}, refresh="full2", buckets=2)
    assert spark.read.parquet(fresh["gold_claims_monthly"]).agg(F.sum("claims_count")).first()[0] == 5

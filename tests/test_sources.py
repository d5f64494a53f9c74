from __future__ import annotations

import math
import uuid

import pytest
from pyspark.sql import functions as F

from triangulum.session import materialize, scratch_path
from triangulum.sources import generators, notes, statistics, tables

CONTROL = "product_line string, region string, loss_date string, n_claims int, mu_ln double, sigma_ln double, loss_ratio double"


def control(spark):
    rows = [("Homeowners", "R", "2020-01-01", 25_000, 8.0, 0.5, 0.6), ("Personal_Auto", "R", "2020-01-01", 3, 8.0, 0.5, 0.7), ("Homeowners", "S", "2020-02-01", 0, 8.0, 0.5, 0.6)]
    return spark.createDataFrame(rows, CONTROL)


def test_claims_are_independent_of_chunking(spark):
    a = generators.explode_claims(control(spark), chunk=10_000)
    b = generators.explode_claims(control(spark).repartition(5), chunk=777)
    assert a.count() == 25_003
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert a.select("claim_id").distinct().count() == 25_003


def test_claims_distribution(spark):
    df = generators.explode_claims(control(spark)).filter("product_line = 'Homeowners'")
    row = df.agg(
        F.avg(F.ln("claim_amount")).alias("mu"),
        F.stddev(F.ln("claim_amount")).alias("sd"),
        F.min(F.col("claim_amount") / F.col("monthly_prem_exposure")).alias("lo"),
        F.max(F.col("claim_amount") / F.col("monthly_prem_exposure")).alias("hi"),
    ).first()
    assert row.mu == pytest.approx(8.0, abs=0.02) and row.sd == pytest.approx(0.5, abs=0.02)
    assert row.lo == pytest.approx(0.6 / 1.15, abs=0.01) and row.hi == pytest.approx(0.6 / 0.85, abs=0.01)
    shares = {r.claim_type: r["count"] / 25_000 for r in df.groupBy("claim_type").count().collect()}
    assert set(shares) == set(generators.CLAIM_TYPES["Homeowners"])
    assert all(abs(s - 0.25) < 0.02 for s in shares.values())


def test_reserve_generator(spark):
    rows = [("Homeowners", "R", "Homeowners__R", "2019-03-01", 36, 1e6, 0.025, 10.0, 1.1, 36)]
    df = generators.explode_reserves(
        spark.createDataFrame(
            rows,
            "product_line string, region string, segment_id string, accident_month string, max_lag int, ultimate double, inflation_rate double, scale double, shape double, line_max_lag int",
        )
    )
    got = df.orderBy("dev_lag").collect()
    assert [r.dev_lag for r in got] == list(range(1, 37))
    assert got[0].op == "INSERT" and got[1].op == "UPDATE" and got[0].development_month == "2019-04-01"
    assert all(r.case_reserve >= 0 and r.cumulative_paid <= 1e6 for r in got)


def test_weibull_pattern_is_one_past_the_last_lag(spark):
    p = spark.createDataFrame([("L", 10.0, 1.1, 3)], "product_line string, scale double, shape double, max_lag int")
    got = [r.paid_share for r in generators.weibull_pattern(p, 5).orderBy("dev_lag").collect()]
    assert got[0] == pytest.approx(1 - math.exp(-(0.1**1.1)), abs=1e-6) and got[3:] == [1.0, 1.0] and got == sorted(got)


def test_replicate(spark):
    df = generators.replicate(spark.createDataFrame([("a",), ("b",)], "segment_id string"), 3)
    assert sorted(r.segment_id for r in df.collect()) == [f"{k}_r00{i}" for k in "ab" for i in range(3)]


def test_statistics_csv(spark):
    path = scratch_path(spark, "csv")
    lines = [
        "GEO,REF_DATE,VALUE,UOM,Sex",
        "Ontario,2020-01,5.0,Percent,Both", "Ontario,2020-01,7.0,Percent,Both",  # duplicate: mean
        "Ontario,2020-02,x,Percent,Both", "Quebec,2020-01,F,Percent,Both",  # suppressed
        "Quebec,2020-02,4.5,Persons,Both", "Quebec,2020-02,9.9,Percent,Men", "Canada,2020-01,1.0,Percent,Both",
    ]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    raw = statistics.read_statistics_csv(spark, path)
    rows = statistics.parse_statistics(raw, "t", "unemployment_rate", "b", [("Sex", "Both"), ("Absent", "z")])
    got = sorted((r.province, r.ref_date, r.value, r.unit) for r in rows.collect())
    assert got == [("Ontario", "2020-01", 6.0, "Percent"), ("Quebec", "2020-02", 4.5, "Percent")]
    prof = statistics.indicator_profile(statistics.combine_indicators([rows, rows])).first()
    assert (prof.rows, prof.provinces, prof.first_date, prof.last_date) == (4, 2, "2020-01", "2020-02")
    with pytest.raises(ValueError):
        statistics.parse_statistics(raw.drop("GEO"), "t", "i", "b")


def test_landing_append_and_describe(spark):
    name = f"landing_{uuid.uuid4().hex[:8]}"
    try:
        assert tables.ensure_landing(spark, name) and not tables.ensure_landing(spark, name)
        rows = spark.createDataFrame(
            [("s", "Ontario", "2020-01", "hpi_index", 1.0, "Index")],
            "source_table string, province string, ref_date string, indicator_name string, value double, unit string",
        )
        tables.append_batch(rows, name, "b1")
        tables.append_batch(rows, name, "b2")
        got = tables.scan(spark, name)
        assert sorted(r.batch_id for r in got.collect()) == ["b1", "b2"]
        done = tables.describe_tables(spark, {name: ("it's raw", {"value": "the 'value'", "absent": "-"}), "no_such_table": ("x", {})})
        assert done == {name: 1}
        assert [r.comment for r in spark.sql(f"DESCRIBE {name}").collect() if r.col_name == "value"] == ["the 'value'"]
        assert name in [r.tableName for r in tables.list_tables(spark, "landing_*").collect()]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_overwrite_replaces_the_schema_and_export(spark):
    path = scratch_path(spark, "over")
    tables.overwrite(spark.range(3), path)
    tables.overwrite(spark.range(2).withColumn("x", F.lit("a")), path)
    assert tables.scan(spark, path).columns == ["id", "x"] and tables.scan(spark, path).count() == 2
    tables.export_csv(tables.scan(spark, path), path + "-csv")
    assert spark.read.option("header", True).csv(path + "-csv").count() == 2


def test_materialize_keeps_rows(spark):
    df = spark.range(10).withColumn("a", F.array(F.lit(1.5)))
    assert sorted(map(str, materialize(df).collect())) == sorted(map(str, df.collect()))


@pytest.mark.parametrize(
    "sql",
    ["DROP TABLE t", "WITH x AS (SELECT 1) INSERT INTO t SELECT * FROM x", "SELECT 1; SELECT 2", "/* SELECT */ DELETE FROM t", ""],
)
def test_guard_rejects(spark, sql):
    with pytest.raises(ValueError):
        tables.query_readonly(spark, sql)


def test_guard_accepts(spark):
    tables.register_views({"nums": spark.range(100)})
    assert tables.query_readonly(spark, "SELECT * FROM nums").count() == 50
    assert tables.query_readonly(spark, "with a as (select 'drop; it' AS s) select * from a").first().s == "drop; it"


def test_guard_reads_registered_views_only(spark):
    path = scratch_path(spark, "hidden")
    spark.range(3).write.parquet(path)
    tables.register_views({"nums": spark.range(100)})
    name = f"stored_{uuid.uuid4().hex[:8]}"
    spark.range(2).write.saveAsTable(name)
    try:
        for sql in (
            f"SELECT * FROM parquet.`{path}`",
            f"SELECT id FROM nums WHERE id IN (SELECT id FROM parquet.`{path}`)",
            f"SELECT (SELECT max(id) FROM parquet.`{path}`) AS m FROM nums",
            f"WITH a AS (SELECT * FROM parquet.`{path}`) SELECT * FROM a",
            f"SELECT * FROM nums UNION ALL SELECT * FROM {name}",
            f"WITH {name} AS (SELECT * FROM {name}) SELECT * FROM {name}",
            f"SELECT * FROM nums JOIN (WITH b AS (SELECT 1 AS id) SELECT * FROM b) USING (id) JOIN b USING (id)",
            "SELECT * FROM range(5)",
            "SELECT `reflect`('java.lang.System', 'getenv', 'HOME') AS x FROM nums",
        ):
            with pytest.raises(ValueError):
                tables.query_readonly(spark, sql)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    nested = "WITH a AS (SELECT id FROM NUMS), b AS (SELECT * FROM a WHERE id IN (SELECT id FROM nums)) SELECT * FROM b JOIN a USING (id)"
    assert tables.query_readonly(spark, nested, 200).count() == 100


def test_notes(spark):
    path = scratch_path(spark, "notes")
    rows = [(f"S{i % 2}", f"n{i}", "me", "", None, f"2024-01-{i + 1:02d} 00:00:00") for i in range(28)]
    df = spark.createDataFrame(rows, "segment_id string, note string, analyst string, scenario_type string, adjustment_pct double, at string")
    notes.annotate(spark, path, df.withColumn("created_at", F.to_timestamp("at")).drop("at"))
    notes.annotate(spark, path, spark.createDataFrame([("S0", "late")], "segment_id string, note string"))
    got = spark.read.parquet(path)
    first = notes.recent_annotations(got).first()
    assert (first.note, first.approval_status, first.scenario_type) == ("late", "Draft", None)
    assert notes.recent_annotations(got).count() == 20
    assert [r.note for r in notes.recent_annotations(got, "S1", 2).collect()] == ["n27", "n25"]
    assert {r.segment_id: r["count"] for r in notes.recent_per_segment(got, 3).groupBy("segment_id").count().collect()} == {"S0": 3, "S1": 3}

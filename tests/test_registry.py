from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from compare import compare, duck
from triangulum.plans import registry

SF = "/root/testdata/sf0.001"
# a cross-section; tests/run_checks.py compares every query
NAMES = (
    "feature_table", "scd2_macro", "macro_features", "point_in_time_join", "reserve_triangle", "ibnr_by_accident",
    "scenario_ibnr", "mct_capital", "claim_quantiles", "explode_claims", "score_scenarios", "growth_by_month",
)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_check_sql(spark, con, name):
    assert compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) == []


def test_entry_and_contract(spark):
    assert entry.entry(spark).count() == 5
    assert set(entry.oracle_sql()) <= set(entry.queries()) >= set(registry.QUERIES)


@pytest.mark.parametrize("query", ["sketch_quantiles", "medallion_update", "delta_monthly", "full_refresh"])
def test_claims_are_joined_once(spark, monkeypatch, query):
    """Every landing and every pass over the claims reads them written; before, each computed them again."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(line):
        seen.add(1)
        return line

    rows = [
        (line, "ASIA", f"199{5 + k % 3}-0{1 + k % 9}-11", float(k % 50), 10.0 + k % 7, "R")
        for k in range(120) for line in ("AUTOMOBILE", "BUILDING")
    ]
    names = "product_line string, region string, loss_date string, claim_amount double, monthly_prem_exposure double, claim_type string"
    claims = spark.createDataFrame(rows, names).withColumn("product_line", counted.asNondeterministic()("product_line"))
    monkeypatch.setattr(registry.adapters, "claims_events", lambda s, d: claims)
    found = registry.queries()[query](spark, "/root/testdata/sf0.001")
    assert not found.isEmpty()
    assert seen.value == len(rows)


def test_dealt_parts_hold_every_row_once(spark):
    rows = [(k % 40 or None, str(k % 7)) for k in range(200)] + [(None, None)] * 5
    feed = spark.createDataFrame(rows, "a long, b string")
    parts = registry._dealt(feed, 3)
    assert all(part.count() for part in parts)
    assert Counter(tuple(r) for part in parts for r in part.collect()) == Counter(rows)

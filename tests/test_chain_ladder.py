from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from triangulum.operators import chain_ladder as cl
from triangulum.operators import gold
from triangulum.plans import reserving

SCHEMA = "product_line string, accident_month string, dev_lag int, cumulative_paid double"


def model(spark, rows):
    return reserving.fit(spark.createDataFrame(rows, SCHEMA))


THREE = [
    ("L", "2020-01-01", 1, 100.0), ("L", "2020-01-01", 2, 150.0), ("L", "2020-01-01", 3, 165.0),
    ("L", "2020-02-01", 1, 200.0), ("L", "2020-02-01", 2, 320.0),
    ("L", "2020-03-01", 1, 120.0),
]


def test_three_by_three(spark):
    m = model(spark, THREE)
    f = {r.dev_lag: r for r in m.factors.collect()}
    f1 = 470 / 300
    sigma2 = 100 * (1.5 - f1) ** 2 + 200 * (1.6 - f1) ** 2
    assert f[1].ldf == pytest.approx(f1)
    assert f[1].mack_sigma == pytest.approx(math.sqrt(sigma2))
    assert f[1].ldf_se == pytest.approx(math.sqrt(sigma2 / 300))
    # one pair only: factor 1, no spread
    assert (f[2].ldf, f[2].mack_sigma, f[2].ldf_se, f[2].n_pairs) == (1.0, 0.0, 0.0, 1)
    acc = {r.accident_month: r for r in m.by_accident.collect()}
    assert acc["2020-01-01"].ibnr == 0.0 and acc["2020-01-01"].cdf == 1.0
    assert acc["2020-03-01"].ultimate == pytest.approx(120 * f1)
    assert m.totals.first().total_ibnr == pytest.approx(120 * f1 - 120)
    res = {(r.accident_month, r.dev_lag_from): r.residual for r in m.residuals.collect()}
    assert res[("2020-01-01", 1)] == pytest.approx((150 - f1 * 100) / math.sqrt(f1 * 100))
    assert len(res) == 3


def test_decreasing_cumulative_floors_ibnr(spark):
    rows = [("L", f"2020-0{i}-01", k, v) for i, vs in enumerate([(100, 80), (50, 45), (60,)], 1) for k, v in enumerate(map(float, vs), 1)]
    m = model(spark, rows)
    assert m.factors.first().ldf < 1
    assert all(r.ibnr == 0.0 for r in m.by_accident.collect())


def test_hole_is_not_bridged_and_zero_is_not_used(spark):
    rows = [
        ("L", "2020-01-01", 1, 10.0), ("L", "2020-01-01", 3, 30.0),  # lag 2 missing here
        ("L", "2020-02-01", 1, 0.0), ("L", "2020-02-01", 2, 5.0), ("L", "2020-02-01", 3, 9.0),
    ]
    pairs = cl.adjacent_pairs(spark.createDataFrame(rows, SCHEMA))
    got = {(r.accident_month, r.dev_lag): (r.next_lag, r.next_paid, r.usable) for r in pairs.collect()}
    assert got == {
        ("2020-01-01", 1): (2, None, False),
        ("2020-02-01", 1): (2, 5.0, False),
        ("2020-02-01", 2): (3, 9.0, True),
    }


def test_incremental_sums_back_to_cumulative(spark):
    df = gold.with_incrementals(
        spark.createDataFrame(THREE, SCHEMA), ["product_line"], {"inc": "cumulative_paid"}
    )
    for r in df.groupBy("accident_month").agg(F.sum("inc").alias("s"), F.max("cumulative_paid").alias("c")).collect():
        assert r.s == pytest.approx(r.c)


def test_scenario_factors(spark):
    rows = [(line, k, 1.5, 0.0, 0.1, 5) for line in ("Personal_Auto", "Homeowners") for k in (6, 12, 24, 30)]
    factors = spark.createDataFrame(rows, "product_line string, dev_lag int, ldf double, mack_sigma double, ldf_se double, n_pairs long")
    got = {}
    for r in cl.scenario_ldfs(factors).collect():
        got.setdefault((r.scenario, r.product_line), {})[r.dev_lag] = r.scenario_ldf / r.ldf
    auto, home = "Personal_Auto", "Homeowners"
    assert set(got[("baseline", auto)].values()) == {1.0}
    # late: lags >= 15; the multiplier acts once on the cumulative tail
    late = got[("adverse_development", home)]
    assert late[6] == late[12] == 1.0 and late[24] * late[30] == pytest.approx(1.2)
    assert set(got[("judicial_inflation", home)].values()) == {1.0}
    tail = got[("judicial_inflation", auto)]
    assert tail[12] == 1.0 and tail[24] * tail[30] == pytest.approx(1.3)
    assert math.prod(got[("pandemic_tail", home)].values()) == pytest.approx(1.1)
    assert got[("superimposed_inflation", auto)][6] == pytest.approx(1.03**0.25)


def test_simple_and_weighted_ratios_differ(spark):
    m = model(spark, THREE)
    simple = {r.dev_lag: r.avg_link_ratio for r in cl.simple_link_ratios(m.pairs).collect()}
    assert simple == {1: 1.55, 2: 1.1}

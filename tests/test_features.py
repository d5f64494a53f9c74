from __future__ import annotations

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from triangulum.operators import features, forecast, gold, reports

PANEL = "segment_id string, month date, claims_count long"


def panel(spark, values, segment="A__X"):
    rows = [(segment, date(2020 + (i // 12), i % 12 + 1, 1), v) for i, v in enumerate(values) if v is not None]
    return spark.createDataFrame(rows, PANEL)


def test_claims_monthly(spark):
    rows = [("A", "X", "2020-01-05", 10.0, 20.0), ("A", "X", "2020-01-31", 30.0, 20.0), ("A", "X", "2020-02-01", 5.0, 0.0)]
    df = spark.createDataFrame(rows, "product_line string, region string, loss_date string, claim_amount double, monthly_prem_exposure double")
    got = {r.month: r for r in gold.claims_monthly(df).collect()}
    jan, feb = got[date(2020, 1, 1)], got[date(2020, 2, 1)]
    assert (jan.segment_id, jan.claims_count, jan.total_incurred, jan.avg_severity, jan.loss_ratio) == ("A__X", 2, 40.0, 20.0, 1.0)
    assert feb.loss_ratio == 0.0


def test_short_segments(spark):
    one = gold.rolling_features(panel(spark, [5])).first()
    assert (one.rolling_3m_mean, one.rolling_3m_std, one.mom_change_pct, one.yoy_change_pct) == (5.0, None, 0.0, 0.0)
    two = gold.rolling_features(panel(spark, [4, 6])).orderBy("month").collect()[1]
    assert (two.rolling_12m_mean, two.mom_change_pct) == (5.0, 50.0)
    assert two.rolling_3m_std == pytest.approx(2**0.5)


def test_zero_previous_count_and_missing_month(spark):
    got = gold.rolling_features(panel(spark, [0, 3, None, 6])).orderBy("month").collect()
    assert [r.mom_change_pct for r in got] == [0.0, 0.0, 100.0]  # row-based: the gap is skipped
    assert got[2].rolling_3m_mean == 3.0


def test_pandas_twins_agree(spark):
    df = panel(spark, [5, 0, 7, 9, 4, 4, 8, 1, 2, 3, 9, 12, 15, 7]).unionByName(panel(spark, [3], "B__Y"))
    cols = ["segment_id", "month", "rolling_3m_mean", "rolling_6m_mean", "rolling_12m_mean", "rolling_3m_std", "mom_change_pct", "yoy_change_pct"]

    def rows(x):
        return [[v if isinstance(v, (str, date)) or v is None else round(v, 9) for v in r] for r in x.select(*cols).orderBy(*cols[:2]).collect()]

    native = rows(gold.rolling_features(df))
    assert rows(forecast.rolling_features_pandas(df)) == native
    assert rows(forecast.rolling_features_pandas(df, bridge=True)) == native
    a, b = (f(df).filter("segment_id = 'A__X'").first() for f in (features.ols_trend, forecast.ols_trend_pandas))
    assert list(a)[1:] == pytest.approx(list(b)[1:])


def test_fill_hold_and_future(spark):
    rows = [("A__X", date(2020, m, 1), 1, v) for m, v in enumerate([None, 2.0, None, 5.0, None], 1)]
    df = spark.createDataFrame(rows, PANEL + ", x double")
    filled = features.fill_regressors(df, ["x"])
    assert [r.x for r in filled.orderBy("month").collect()] == [2.0, 2.0, 2.0, 5.0, 5.0]
    assert features.hold_regressors(filled, ["x"]).first().x == 4.0
    months = [(r.month, r.month_offset) for r in features.future_months(df, 2).orderBy("month").collect()]
    assert months == [(date(2020, 6, 1), 1), (date(2020, 7, 1), 2)]


def asof(obs, feats):
    out = []
    for i, k, t in obs:
        hits = [f for f in feats if f[0] == k and f[1] <= t]
        out.append((i, max(hits, key=lambda f: f[1])[2] if hits else None))
    return sorted(out)


@pytest.mark.parametrize("max_rows", [None, 5])
@pytest.mark.parametrize("bucket", ["month", "day"])
def test_point_in_time_join_against_brute_force(spark, max_rows, bucket):
    rng = random.Random(4)

    def ts():
        return datetime(2021, rng.randint(1, 12), rng.randint(1, 28), rng.randint(0, 23))

    feats = list({(k, t): (k, t, i) for i, (k, t) in enumerate((rng.choice("abc"), ts()) for _ in range(60))}.values())
    obs = [(i, rng.choice("aaaabcd"), ts()) for i in range(200)]
    obs += [(1000, feats[0][0], feats[0][1]), (1001, "a", datetime(2019, 1, 1)), (1002, "b", datetime(2023, 6, 1))]
    odf = spark.createDataFrame(obs, "i int, k string, t timestamp")
    fdf = spark.createDataFrame(feats, "k string, ft timestamp, v int")
    got = features.point_in_time_join(odf, fdf, "k", "t", "ft", ["v"], bucket, max_rows)
    rows = got.collect()
    assert sorted((r.i, r.v) for r in rows) == asof(obs, feats)
    assert all(r.ft is None or r.ft <= r.t for r in rows)


def test_macro_features(spark):
    rows = [
        ("Ontario", "2020-01", "hpi_index", 100.0), ("Ontario", "2020-02", "hpi_index", 110.0),
        ("Ontario", "2020-02", "unemployment_rate", 5.0), ("Canada", "2020-01", "hpi_index", 1.0),
    ]
    df = spark.createDataFrame(rows, "province string, ref_date string, indicator_name string, value double")
    got = gold.macro_features(df, {"Ontario": "Ontario"}).orderBy("month").collect()
    assert [(r.region, r.hpi_growth, r.unemployment_rate) for r in got] == [("Ontario", None, None), ("Ontario", pytest.approx(10.0), 5.0)]


def test_month_range_needs_both_ends(spark):
    df = panel(spark, [1, 2, 3])
    assert reports.month_between(df, "2020-02-01").count() == 3
    assert reports.month_between(df, "2020-02-01", "2020-02-01").count() == 1


def test_merge_defaults_order(spark):
    req = spark.createDataFrame([("a", 1.0, None), ("b", None, None)], "k string, x double, y double")
    fit = spark.createDataFrame([("a", 5.0), ("b", 6.0)], "k string, x double")
    got = {r.k: (r.x, r.y) for r in reports.merge_defaults(req, fit, ["k"], {"x": 9.0, "y": 7.0}).collect()}
    assert got == {"a": (1.0, 7.0), "b": (6.0, 7.0)}


def test_mct_defaults(spark):
    res = spark.createDataFrame([("Personal_Auto", 100.0, 1.0), ("New", 10.0, 1.0)], "product_line string, outstanding_reserves double, total_incurred double")
    prem = spark.createDataFrame([("Personal_Auto", 50.0), ("Other", 30.0)], "product_line string, annual_earned_premium double")
    lines = reports.mct_lines(res, prem)
    got = {r.product_line: (r.reserve_charge, r.premium_charge) for r in lines.collect()}
    assert got == {"Personal_Auto": (5.0, 6.0), "New": (1.0, 0.0)}
    cap = reports.mct_capital(lines, prem).first()
    assert cap.capital_required == pytest.approx((36 + 36 + 36) ** 0.5)
    assert cap.capital_available == pytest.approx(28.0)


def test_validation_uses_latest_lag(spark):
    tri = spark.createDataFrame(
        [("A__X", "A", "X", "2020-01-01", k, 1.0 * k, 2.0 * k, 1.0) for k in (1, 2)],
        "segment_id string, product_line string, region string, accident_month string, dev_lag int, cumulative_paid double, cumulative_incurred double, case_reserve double",
    )
    got = reports.reserve_validation(tri, panel(spark, [0, 3])).collect()
    assert [(r.dev_lag, r.reserve_adequacy_ratio) for r in got] == [(2, None)]


def test_feature_table_columns(spark):
    df = panel(spark, [4, 8]).withColumns({"loss_ratio": F.lit(0.5), "earned_premium": F.col("claims_count") * 1.0})
    got = features.feature_table(gold.rolling_features(df)).orderBy("month").collect()
    assert [r.normalized_premium for r in got] == [pytest.approx(4 / 6), pytest.approx(8 / 6)]
    assert (got[0].is_q1, got[0].is_winter, got[0].loss_ratio_trend_3m, got[0].coeff_variation_3m) == (1, 1, 0.0, None)

from __future__ import annotations

import math
from datetime import date

import numpy as np
import pandas as pd

from triangulum.operators import forecast as fc
from triangulum.operators import reports


def series(n, seed=0, noise=3.0, slope=0.5):
    rng = np.random.default_rng(seed)
    t = np.arange(n)
    return 200 + slope * t + 40 * np.sin(2 * np.pi * t / 12) + rng.normal(0, noise, n)


def frame(y, **cols):
    months = pd.date_range("2015-01-01", periods=len(y), freq="MS").date
    return pd.DataFrame({"segment_id": "A__X", "month": months, "claims_count": y, **cols})


def garch_path(n, alpha, beta, seed=0):
    rng = np.random.default_rng(seed)
    h, out = 1.0, []
    for _ in range(n):
        e = math.sqrt(h) * rng.normal()
        out.append(e)
        h = (1 - alpha - beta) + alpha * e * e + beta * h
    return np.array(out)


def test_arch_report(spark):
    rows = [("A__X", "forecast", 0.04, 0.2, 0.5)] * 2 + [("B__Y", "forecast", 0.5, None, None), ("C__Z", "forecast", None, None, None), ("A__X", "actual", 0.04, 0.2, 0.5)]
    df = spark.createDataFrame(rows, "segment_id string, record_type string, arch_lm_pvalue double, garch_alpha double, garch_beta double")
    s = reports.arch_summary(df)
    assert s.count() == 3
    c = reports.arch_counts(s).first()
    assert (c.significant_segments, c.tested_segments, c.fitted_segments) == (1, 2, 1)


def test_seasonal_naive(spark):
    y = [float(i % 12 + i // 12) for i in range(36)]
    df = spark.createDataFrame([("A__X", date(2020 + i // 12, i % 12 + 1, 1), int(v)) for i, v in enumerate(y)], "segment_id string, month date, claims_count long")
    out = fc.seasonal_naive(df, 14).filter("record_type = 'forecast'").orderBy("month").collect()
    assert [r.forecast_mean for r in out] == y[24:] + y[24:26]
    assert out[0].forecast_lo95 == out[0].forecast_mean  # differences are constant

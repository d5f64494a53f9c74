from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from triangulum.operators import regression
from triangulum.operators import simulate as sim

PANEL = "segment_id string, month date, claims_count long, x double"


def panel(spark, segments=3, months=60, seed=4):
    rng = random.Random(seed)
    rows = []
    for s in range(segments):
        for m in range(months):
            x = rng.gauss(5, 1)
            rows.append((f"s{s}", f"{2015 + m // 12}-{m % 12 + 1:02d}-01", int(100 + 10 * x + rng.gauss(0, 4 + 3 * (m % 5))), x))
    rows += [("short", "2015-01-01", 3, 1.0), ("flat", "2015-01-01", 3, 1.0)]
    rows += [("flat", f"{2016 + m // 12}-{m % 12 + 1:02d}-01", 3, 1.0) for m in range(40)]
    frame = spark.createDataFrame(rows, "segment_id string, month string, claims_count long, x double")
    return rows, frame.withColumn("month", F.col("month").cast("date"))


def series(rows):
    found = {}
    for s, _, y, x in rows:
        found.setdefault(s, []).append((float(y), x))
    return {s: np.array(v) for s, v in found.items()}


def test_arch_lm_equals_least_squares(spark):
    rows, df = panel(spark)
    got = {r.segment_id: r for r in regression.arch_lm(df).collect()}
    for s, v in series(rows).items():
        e = (v[12:, 0] - v[:-12, 0]) ** 2
        if s in ("short", "flat"):
            assert got[s].p_value is None and got[s].r2 is None
            continue
        y, lagged = e[4:], np.column_stack([np.ones(len(e) - 4), *[e[4 - k : -k] for k in range(1, 5)]])
        fitted = lagged @ np.linalg.lstsq(lagged, y, rcond=None)[0]
        r2 = 1 - ((y - fitted) ** 2).sum() / ((y - y.mean()) ** 2).sum()
        assert got[s].n == len(y) and got[s].r2 == pytest.approx(r2, abs=1e-9)
        lm = len(y) * r2
        assert got[s].p_value == pytest.approx(math.exp(-lm / 2) * (1 + lm / 2), abs=1e-9)
    with pytest.raises(ValueError):
        regression.arch_lm(df, lags=3)
    assert regression.arch_lm(df.filter("false")).count() == 0


def test_origins_equal_refitting(spark):
    rows, df = panel(spark)
    got = {(r.segment_id, str(r.month), r.model): r.error for r in regression.holdout_origins(df, "x").collect()}
    months = {s: [m for t, m, *_ in rows if t == s] for s in {r[0] for r in rows}}
    for s, v in series(rows).items():
        if s in ("short", "flat"):
            continue
        for t in range(len(v) - 12, len(v)):
            d, dx = v[12 : t + 1, 0] - v[: t - 11, 0], v[12 : t + 1, 1] - v[: t - 11, 1]
            slope, constant = np.polyfit(dx[:-1], d[:-1], 1)
            assert got[s, months[s][t], "seasonal"] == pytest.approx(d[-1])
            assert got[s, months[s][t], "regressor"] == pytest.approx(d[-1] - constant - slope * dx[-1], abs=1e-6)
    # a regressor that never changes leaves the mean difference, here zero
    assert {e for (s, _, _), e in got.items() if s == "flat"} == {0.0}
    assert not any(s == "short" for s, _, _ in got)


def test_models_are_compared(spark):
    _, df = panel(spark)
    found = {(r.segment_id, r.model): r for r in regression.holdout_models(regression.holdout_origins(df, "x")).collect()}
    a, b = found["s0", "seasonal"], found["s0", "regressor"]
    assert (a.origins, b.origins) == (12, 12)
    assert b.rmse < a.rmse and b.best and not a.best
    assert a.bic - a.aic == pytest.approx(math.log(12) - 2)
    assert found["flat", "seasonal"].aic is None and found["flat", "seasonal"].best and found["flat", "regressor"].best


def test_strict_scoring_refuses_what_it_would_clamp(spark):
    cols = {f"mean_ibnr_{x}_M": 10.0 for x in sim.SCORER_LINES} | {f"cv_{x}": 0.2 for x in sim.SCORER_LINES}
    req = spark.range(1).select(
        F.lit("a").alias("request_id"), F.lit("baseline").alias("scenario"), F.lit(10).cast("bigint").alias("n_replications"),
        *[F.lit(v).alias(c) for c, v in cols.items()], F.lit(1.0).alias("ldf_multiplier"), F.lit(0.0).alias("inflation_adj"),
    )
    assert sim.scorer_draws(req).count() == 1_000
    with pytest.raises(PySparkException, match="out of bounds"):
        sim.score_scenarios(req, strict=True).collect()

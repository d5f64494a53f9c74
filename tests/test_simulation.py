from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from triangulum.operators import chain_ladder as cl
from triangulum.operators import portfolio
from triangulum.operators import simulate as sim
from triangulum.plans import reserving


@pytest.fixture(scope="module")
def model(spark):
    """Two lines, ten accident periods, noisy but regular development."""
    rng = np.random.default_rng(0)
    rows = []
    for line in ("Personal_Auto", "Homeowners"):
        for a in range(10):
            paid = 1e6
            for k in range(1, 11 - a):
                rows.append((line, f"2020-{a + 1:02d}-01", k, paid))
                paid *= 1 + 1.0 / k**2 * rng.uniform(0.85, 1.15)
    df = spark.createDataFrame(rows, "product_line string, accident_month string, dev_lag int, cumulative_paid double")
    return reserving.fit(df)


def draws(model, scenarios=cl.SCENARIOS[:1], n=20_000, per_task=5_000, tail_lag=4):
    factors = cl.scenario_ldfs(model.factors, scenarios, tail_lag=tail_lag)
    return sim.reserve_draws(sim.reserve_parameters(model.triangle, factors), n, per_task=per_task)


def test_draws_do_not_depend_on_partitions(spark, model):
    factors = cl.scenario_ldfs(model.factors, cl.SCENARIOS[:2])
    params = sim.reserve_parameters(model.triangle, factors)

    def values(p):
        rows = sim.reserve_draws(p, 300, per_task=100).orderBy("scenario", "product_line", "task").collect()
        return [(r.scenario, r.product_line, r.task, r.draws) for r in rows]

    assert values(params) == values(params.repartition(7))


def test_mean_is_near_the_deterministic_ibnr(model):
    best = {r.product_line: r.total_ibnr for r in model.totals.collect()}
    for r in sim.line_metrics(draws(model)).collect():
        assert r.mean_M * 1e6 == pytest.approx(best[r.product_line], rel=0.02)


def test_task_metrics_and_scenarios(model):
    tasks = reserving.simulate_tasks(model, cl.SCENARIOS, 4_000, per_task=2_000, tail_lag=4).collect()
    assert len(tasks) == 2 * len(cl.SCENARIOS)
    for t in tasks:
        assert t.best_estimate_M < t.var_75_M < t.var_90_M < t.var_95_M < t.var_99_M < t.var_995_M <= t.max_ibnr_M
        assert t.cvar_99_M >= t.var_99_M and t.n_replications == 2_000


def test_comparison_against_baseline(model):
    got = {r.scenario: r for r in reserving.compare_scenarios(reserving.simulate_tasks(model, cl.SCENARIOS, 2_000, per_task=1_000, tail_lag=4)).collect()}
    assert got["baseline"].var_995_vs_baseline == 0.0
    assert all(got[s].var_995_vs_baseline > 0 for s in got if s != "baseline")


def test_judicial_scenario_leaves_other_lines_unchanged(model):
    rows = {(r.scenario, r.product_line): r.mean_M for r in sim.line_metrics(draws(model, cl.SCENARIOS[:3], 2_000)).collect()}
    assert rows[("judicial_inflation", "Homeowners")] == rows[("baseline", "Homeowners")]
    assert rows[("judicial_inflation", "Personal_Auto")] > rows[("baseline", "Personal_Auto")]


def test_fully_developed_lines_have_no_reserve(spark):
    df = spark.createDataFrame([("L", "2020-01-01", k, 100.0 * k) for k in (1, 2)], "product_line string, accident_month string, dev_lag int, cumulative_paid double")
    assert set(draws(reserving.fit(df), n=50, per_task=50).first().draws) == {0.0}


def test_scorer_against_numpy(spark):
    req = spark.createDataFrame([("a", "baseline", 10, 1.0, 0.0), ("b", "adverse_development", 4_000, 1.0, 0.0)], "request_id string, scenario string, n_replications long, ldf_multiplier double, inflation_adj double")
    req = req.withColumns({c: F.lit(v) for c, v in sim.SCORER_DEFAULTS.items() if c not in req.columns})
    got = {r.request_id: r for r in sim.score_scenarios(req).collect()}
    assert got["a"].n_replications_used == 1_000  # clamped from 10
    assert got["a"].best_estimate_M == pytest.approx(140, rel=0.02)
    assert got["b"].best_estimate_M == pytest.approx(140 * 1.2, rel=0.02)
    xs = np.array([r.ibnr_M for r in sim.scorer_draws(req).filter("request_id = 'b'").collect()])
    assert len(xs) == 4_000
    assert got["b"].var_99_M == pytest.approx(np.percentile(xs, 99), abs=6e-4)
    assert got["b"].cvar_99_M == pytest.approx(xs[xs >= np.percentile(xs, 99)].mean(), abs=6e-4)


def base(spark):
    return spark.createDataFrame(
        [([10.0, 20.0, 15.0], [0.3, 0.2, 0.25], [1.0, 0.4, 0.3, 0.4, 1.0, 0.5, 0.3, 0.5, 1.0])],
        "means array<double>, cvs array<double>, corr array<double>",
    )


def test_cvs_fall_back_and_clip(spark):
    cvs = spark.createDataFrame([("Homeowners", 2.0)], "product_line string, cv double")
    row = portfolio.segment_cvs(cvs).first()
    assert row.property_cv == 0.60 and row.auto_cv == pytest.approx(0.29)
    assert row.liability_cv == 0.60


def test_nearest_correlation_is_usable():
    bad = np.array([[1, 0.9, -0.9], [0.9, 1, 0.9], [-0.9, 0.9, 1]])
    assert np.linalg.eigvalsh(bad)[0] < 0
    usable = portfolio.nearest_correlation(bad)
    assert np.allclose(np.diag(usable), 1) and np.abs(usable - np.eye(3)).max() <= 0.99
    # the unit diagonal is restored last, so the repair narrows the gap and need not close it
    assert np.linalg.eigvalsh(bad)[0] < np.linalg.eigvalsh(usable)[0]

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from triangulum.operators import quantiles as q
from triangulum.operators import simulate as sim
from triangulum.operators import sketches


def test_draw_table_0_to_99(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("x"))
    got = {r.prob: r.quantile for r in q.quantiles(df, [], "x", [0.0, 0.5, 0.99, 0.995, 1.0]).collect()}
    assert got == {0.0: 0.0, 0.5: 49.5, 0.99: pytest.approx(98.01), 0.995: pytest.approx(98.505), 1.0: 99.0}
    row = q.cvar(df, [], "x", 0.99).first()
    assert (row["var"], row["cvar"]) == (pytest.approx(98.01), 99.0)


def test_exact_on_skewed_groups_with_small_brackets(spark):
    rng = np.random.default_rng(1)
    groups = {
        "hot": np.round(rng.lognormal(3, 1, 30_000), 3),
        "tied": np.repeat([1.0, 2.0, 2.0, 5.0], 5_000),
        "tiny": np.array([4.0, 1.0]),
        "single": np.array([7.5]),
    }
    rows = [(g, float(x)) for g, xs in groups.items() for x in xs]
    df = spark.createDataFrame(rows, "g string, x double").repartition(8).cache()
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99, 0.995, 1.0]
    # accuracy 100: the 4*accuracy rule makes hot and tied go through brackets
    got = {(r.g, r.prob): r.quantile for r in q.quantiles(df, ["g"], "x", probs, accuracy=100).collect()}
    for g, xs in groups.items():
        for p in probs:
            assert got[(g, p)] == pytest.approx(np.percentile(xs, p * 100), rel=1e-12), (g, p)
    tails = {r.g: r.cvar for r in q.cvar(df, ["g"], "x", 0.95).collect()}
    for g, xs in groups.items():
        assert tails[g] == pytest.approx(xs[xs >= np.percentile(xs, 95)].mean())


def test_brackets_are_refined(spark):
    rng = np.random.default_rng(5)
    groups = {
        "wide": 10.0 ** rng.uniform(-200, 200, 20_000) * rng.choice([-1, 1], 20_000),
        "tied": np.repeat([1.0, 2.0, 3.0], [9_000, 2_000, 9_000]),
        "heap": np.concatenate([np.full(15_000, 7.0), rng.normal(7, 1, 5_000)]),
        "tiny": np.array([4.0, 1.0]),
    }
    df = spark.createDataFrame([(g, float(x)) for g, xs in groups.items() for x in xs], "g string, x double").cache()
    probs = [0.0, 0.25, 0.5, 0.501, 0.99, 1.0]
    # accuracy 10: brackets of 60 % of their group; accuracy 10,000: the whole groups are tallied
    for accuracy in (10, 10_000):
        got = {(r.g, r.prob): r.quantile for r in q.quantiles(df, ["g"], "x", probs, accuracy, most=64).collect()}
        for g, xs in groups.items():
            for p in probs:
                assert got[(g, p)] == pytest.approx(np.percentile(xs, p * 100), rel=1e-9), (accuracy, g, p)
    with pytest.raises(ValueError, match="at least"):
        q.quantiles(df, ["g"], "x", probs, 10, most=8).collect()


def test_a_refined_bracket_has_few_values(spark):
    tallied = spark.range(50_000).selectExpr("0 AS g", "0.3D AS prob", "50000L AS _n", "double(id) AS _v", "1L AS _c")
    left = q._refined(tallied, ["g", "prob"], 100)
    assert left.filter("_v IS NOT NULL").count() <= 100
    # what lies below the bracket is one row, what lies above is gone
    assert left.filter("_v IS NULL").first()._c == left.agg(F.min("_v")).first()[0]


def test_sketches_merge_and_keep_their_bound(spark):
    rng = np.random.default_rng(6)
    rows = [("a", m, float(x)) for m in range(12) for x in rng.lognormal(0, 3, 2_000)] + [("b", 0, 5.0), ("b", 1, None), ("c", 0, None)]
    df = spark.createDataFrame(rows, "g string, m int, x double").cache()
    monthly = df.groupBy("g", "m").agg(sketches.sketch(F.col("x")).alias("s"))
    est = sketches.merged_quantiles(monthly.filter("m < 6"), ["g"], "s", [0.01, 0.5, 0.99]).cache()
    assert {(r.g, r["values"]) for r in est.collect()} == {("a", 12_000), ("b", 1)}
    off = sketches.measured(df.filter("m < 6"), ["g"], "x", est.select("g", "prob", "estimate")).collect()
    assert len(off) == 6 and all(r.rank_error <= 2 * sketches.rank_error() for r in off)
    assert 0.0 < sketches.rank_error(800) < sketches.rank_error(400) < 0.02
    wrong = est.select("g", "prob", (F.col("estimate") * 50).alias("estimate")).filter("g = 'a' AND prob = 0.5")
    assert sketches.measured(df, ["g"], "x", wrong).first().rank_error > 0.3


def test_nulls_are_ignored(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "x double")
    assert q.quantiles(df, [], "x", [0.5]).first().quantile == 2.0


def test_task_metrics_agree_with_numpy(spark):
    draws = np.random.default_rng(2).gamma(3, 2, 5_000)
    blocks = spark.createDataFrame([("s", 0, draws.tolist())], "scenario string, task int, draws array<double>")
    row = sim.task_metrics(sim.explode_draws(blocks, "ibnr_M", 5_000)).first()
    assert row.best_estimate_M == pytest.approx(draws.mean())
    assert row.var_995_M == pytest.approx(np.percentile(draws, 99.5))
    assert row.cvar_99_M == pytest.approx(draws[draws >= np.percentile(draws, 99)].mean())
    assert row.reserve_risk_capital_M == pytest.approx(np.percentile(draws, 99.5) - draws.mean())
    assert row.max_ibnr_M == draws.max() and row.n_replications == 5_000
    assert row.std_M == pytest.approx(draws.std())

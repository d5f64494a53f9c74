"""Headline timings: python bench.py prints one JSON line.

Reads $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS].  Every query
runs to a noop sink; the best of two runs counts.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from triangulum.operators import chain_ladder as cl
from triangulum.operators import forecast, gold
from triangulum.operators import features
from triangulum.operators import simulate as sim
from triangulum.plans import registry
from triangulum.session import local_session, materialize
from triangulum.sources import generators

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))

# registered queries, read from the parquet tables
PLAIN = (
    "claims_monthly",
    "rolling_features",
    "feature_table",
    "reserve_triangle",
    "development_factors",
    "ibnr_by_line",
    "scd2_macro",
    "point_in_time_join",
    "claim_quantiles",
    "explode_claims",
    "regional_summary",
    "mct_capital",
    "score_scenarios",
)
RESERVE_REPLICATIONS = 400_000


def sink(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(make: Callable[[], DataFrame], runs: int = 2) -> float:
    best = float("inf")
    for _ in range(runs):
        start = time.perf_counter()
        sink(make())
        best = min(best, time.perf_counter() - start)
    return round(best, 3)


def simulations(spark: SparkSession) -> dict[str, Callable[[], DataFrame]]:
    """Simulation and panel operators at the published sizes, fed from written tables."""
    model = registry._model(spark, SF_DIR)
    factors = cl.scenario_ldfs(
        model.factors, cl.SCENARIOS, auto_lines=registry.AUTO, tail_lag=registry.QUARTER_TAIL_LAG
    )
    reserve = materialize(sim.reserve_parameters(model.triangle, factors))
    monthly = registry._written_monthly(spark, SF_DIR)
    panel = monthly.select("segment_id", "month", "claims_count")
    large = materialize(generators.replicate(panel, 1_000, digits=4).repartition(32, "segment_id"))
    per_scenario = RESERVE_REPLICATIONS // len(cl.SCENARIOS)
    return {
        "reserve_draws_400k": lambda: sim.task_metrics(
            sim.total_draws(sim.reserve_draws(reserve, per_scenario, per_task=20_000), 20_000)
        ),
        "rolling_x1000_native": lambda: gold.rolling_features(large),
        "rolling_x1000_pandas": lambda: forecast.rolling_features_pandas(large),
        "ols_x1000_native": lambda: features.ols_trend(large),
        "ols_x1000_pandas": lambda: forecast.ols_trend_pandas(large),
    }


def main() -> None:
    spark = local_session(CPUS, "triangulum-bench")
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    times = {name: timed(lambda n=name: queries[n](spark, SF_DIR)) for name in PLAIN}
    times.update({name: timed(make) for name, make in simulations(spark).items()})
    rates = {
        "reserve_replications_per_s": round(RESERVE_REPLICATIONS / times["reserve_draws_400k"]),
    }
    print(
        json.dumps(
            {
                "metric": "total seconds over headline queries (best of 2 runs each)",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "rates": rates,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

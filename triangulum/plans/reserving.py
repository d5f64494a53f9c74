"""Chain ladder to simulated reserve distribution, scenarios, outlook and run-off."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators import chain_ladder as cl
from ..operators import simulate as sim
from ..operators.reports import mean_of_task_metrics
from ..session import materialize


@dataclass(frozen=True)
class ChainLadder:
    """The deterministic reserving tables of one triangle."""

    triangle: DataFrame
    pairs: DataFrame
    factors: DataFrame
    by_accident: DataFrame
    totals: DataFrame
    residuals: DataFrame
    volatility: DataFrame


def fit(reserves: DataFrame, by: Sequence[str] = cl.LINE) -> ChainLadder:
    # every branch below starts from the triangle, so the claims are read once for it
    tri = materialize(cl.line_triangle(reserves, by), "triangle")
    pairs = cl.adjacent_pairs(tri, by)
    factors = cl.development_factors(pairs, by)
    by_accident = cl.ibnr_by_accident(tri, factors, by)
    totals = cl.ibnr_total(by_accident, by)
    residuals = cl.pearson_residuals(pairs, factors, by)
    return ChainLadder(
        tri, pairs, factors, by_accident, totals, residuals, cl.ldf_volatility(factors, totals, residuals, by)
    )


def simulate_tasks(
    model: ChainLadder,
    scenarios: Sequence[cl.Scenario],
    n: int,
    seed: int = 42,
    per_task: int = sim.PER_TASK,
    auto_lines: Sequence[str] = cl.AUTO_LINES,
    tail_lag: int = cl.TAIL_LAG,
    by: Sequence[str] = cl.LINE,
) -> DataFrame:
    """Per-task metrics of the total reserve for each scenario."""
    factors = cl.scenario_ldfs(model.factors, scenarios, by, auto_lines, tail_lag)
    blocks = sim.reserve_draws(
        sim.reserve_parameters(model.triangle, factors, by), n, seed, per_task, by
    )
    return sim.task_metrics(sim.total_draws(blocks, per_task))


def compare_scenarios(tasks: DataFrame) -> DataFrame:
    """Scenario metrics (means over tasks) and the change of VaR 99.5 against the baseline."""
    return sim.scenario_comparison(mean_of_task_metrics(tasks, ["scenario"], sim.TASK_METRICS))



"""Reserve and surplus simulation as distributed blocks of draws.

A simulation is a parameter table unrolled into (parameter row, task) rows, spread
over the cluster and mapped to one array of draws per row.  A task's draws depend
only on (seed, names, task), so a retry or another partition count gives the same
numbers.  No parameters pass through the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.randoms import normal
from ..functions.scalars import fixed
from .chain_ladder import LINE, latest_diagonal
from .quantiles import quantiles, sorted_quantile, tail_mean

DRAWS = T.ArrayType(T.DoubleType(), False)
PER_TASK = 100_000
PROCESS_CV = 0.10


def task_rows(params: DataFrame, n: int, per_task: int = PER_TASK) -> DataFrame:
    """One row per (parameter row, task) with its number of draws, spread by hash.

    The partition count is explicit: the rows are tiny, so adaptive execution would
    otherwise merge the whole simulation into one task.
    """
    tasks = -(-n // per_task)
    parts = 4 * int(params.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = params.withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1)))).withColumn(
        "n_draws", F.least(F.lit(per_task), F.lit(n) - F.col("task") * per_task).cast("int")
    )
    return spread.repartition(min(parts, 10_000), *[c for c in ("scenario", "task") if c in spread.columns])


def block_rng(seed: int, *names: str | int) -> np.random.Generator:
    """Generator named by its parts, independent of partitioning and worker."""
    words = [zlib.crc32(str(n).encode()) for n in names]
    return np.random.Generator(np.random.Philox(np.random.SeedSequence([seed, *words])))


def explode_draws(blocks: DataFrame, value: str, per_task: int = PER_TASK) -> DataFrame:
    """Blocks to one row per draw; ``rep`` numbers the draws across tasks."""
    keep = [c for c in blocks.columns if c != "draws"]
    return blocks.select(*keep, F.posexplode("draws").alias("_pos", value)).select(
        *keep, (F.col("task").cast("bigint") * per_task + F.col("_pos")).alias("rep"), value
    )


# --- reserve distribution -------------------------------------------------------


def reserve_parameters(tri: DataFrame, factors: DataFrame, by: Sequence[str] = LINE) -> DataFrame:
    """One row per (scenario, group): its factors and its accident periods as arrays.

    Both arrays are bounded by the calendar (lags, accident periods).
    """
    curve = factors.groupBy("scenario", *by).agg(
        F.array_sort(F.collect_list(F.struct("dev_lag", "scenario_ldf", "ldf_se"))).alias("_f")
    )
    latest = latest_diagonal(tri, [*by, "accident_month"]).filter("cumulative_paid > 0")
    periods = latest.groupBy(*by).agg(
        F.array_sort(
            F.collect_list(F.struct("accident_month", F.col("dev_lag").alias("lag"), "cumulative_paid"))
        ).alias("_a")
    )
    return curve.join(periods, list(by)).select(
        "scenario",
        *by,
        F.col("_f.dev_lag").alias("lags"),
        F.col("_f.scenario_ldf").alias("ldfs"),
        F.col("_f.ldf_se").alias("errors"),
        F.col("_a.lag").alias("period_lags"),
        F.col("_a.cumulative_paid").alias("period_paid"),
    )


def mack_draws(rng: np.random.Generator, ldfs: np.ndarray, errors: np.ndarray, n: int) -> np.ndarray:
    """(n, lags) perturbed factors: normal around each factor, floored at 1."""
    return np.maximum(1.0, ldfs + rng.standard_normal((n, len(ldfs))) * errors)


def _reserve_block(
    rng: np.random.Generator,
    lags: np.ndarray,
    ldfs: np.ndarray,
    errors: np.ndarray,
    period_lags: np.ndarray,
    period_paid: np.ndarray,
    n: int,
    process_cv: float,
    step: int = 10_000,
) -> np.ndarray:
    shape = 1.0 / process_cv**2
    # periods that still develop, grouped by the factor their projection starts at
    first = np.searchsorted(lags, period_lags, side="left")
    groups = [(j, period_paid[first == j]) for j in np.unique(first) if j < len(lags)]
    out = np.zeros(n)
    for start in range(0, n, step):
        m = min(step, n - start)
        f = mack_draws(rng, ldfs, errors, m)
        to_ultimate = np.cumprod(f[:, ::-1], axis=1)[:, ::-1]
        for j, paid in groups:
            noise = rng.standard_gamma(shape, size=(m, len(paid))) @ (paid / shape)
            out[start : start + m] += np.maximum(to_ultimate[:, j] - 1.0, 0.0) * noise
    return out


def reserve_draws(
    params: DataFrame,
    n: int,
    seed: int = 42,
    per_task: int = PER_TASK,
    by: Sequence[str] = LINE,
    process_cv: float = PROCESS_CV,
) -> DataFrame:
    """IBNR draws per (scenario, group, task): factor error by Mack, gamma process noise.

    All scenarios use the same random numbers, so their differences carry no
    sampling noise and a scenario that leaves a group's factors alone leaves its
    draws alone.
    """
    by = list(by)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                group = [getattr(row, c) for c in by]
                draws = _reserve_block(
                    block_rng(seed, *group, row.task),
                    *(np.asarray(getattr(row, c), dtype=float) for c in
                      ("lags", "ldfs", "errors", "period_lags", "period_paid")),
                    row.n_draws,
                    process_cv,
                )
                yield pd.DataFrame(
                    [[row.scenario, *group, row.task, draws]],
                    columns=["scenario", *by, "task", "draws"],
                )

    schema = T.StructType(
        [T.StructField("scenario", T.StringType())]
        + [T.StructField(c, params.schema[c].dataType) for c in by]
        + [T.StructField("task", T.IntegerType()), T.StructField("draws", DRAWS)]
    )
    return task_rows(params, n, per_task).mapInPandas(run, schema)


def total_draws(blocks: DataFrame, per_task: int = PER_TASK) -> DataFrame:
    """Sum over the groups per (scenario, task, rep), in millions.

    All groups of a (scenario, task) sit in one map task (see ``task_rows``), so the
    map-side combine already adds them up before the shuffle.
    """
    return (
        explode_draws(blocks.select("scenario", "task", "draws"), "ibnr", per_task)
        .groupBy("scenario", "task", "rep")
        .agg((F.sum("ibnr") / 1e6).alias("ibnr_M"))
    )


def _metric_columns(values: Column, mean: Column, peak: Column, names: dict[str, float]) -> dict[str, Column]:
    out = {n: sorted_quantile(values, p) for n, p in names.items()}
    out["cvar_99_M"] = tail_mean(values, 0.99)
    out["best_estimate_M"] = mean
    out["max_ibnr_M"] = peak
    return out


# Report names of the risk percentiles.
METRIC_PROBS = {"var_75_M": 0.75, "var_90_M": 0.90, "var_95_M": 0.95, "var_99_M": 0.99, "var_995_M": 0.995}
TASK_METRICS = (
    "best_estimate_M",
    *METRIC_PROBS,
    "cvar_99_M",
    "reserve_risk_capital_M",
    "max_ibnr_M",
    "std_M",
)


def task_metrics(
    draws: DataFrame,
    by: Sequence[str] = ("scenario", "task"),
    value: str = "ibnr_M",
    probs: dict[str, float] | None = None,
) -> DataFrame:
    """Risk metrics per group of draws; a group must be bounded (one task's draws).

    Quantiles and the tail mean come from one sorted array, so draws are read once.
    """
    grouped = draws.groupBy(*by).agg(
        F.count("*").alias("n_replications"),
        F.avg(value).alias("_mean"),
        F.max(value).alias("_max"),
        F.stddev_pop(value).alias("std_M"),
        F.sort_array(F.collect_list(value)).alias("_v"),
    )
    columns = _metric_columns(F.col("_v"), F.col("_mean"), F.col("_max"), probs or METRIC_PROBS)
    return (
        grouped.withColumns(columns)
        .withColumn("reserve_risk_capital_M", F.col("var_995_M") - F.col("best_estimate_M"))
        .drop("_mean", "_max", "_v")
    )


def line_metrics(blocks: DataFrame, by: Sequence[str] = LINE) -> DataFrame:
    """Mean and VaR 99.5 per (scenario, group), averaged over tasks."""
    v = F.sort_array("draws")
    per_task = blocks.select(
        "scenario",
        *by,
        (F.aggregate("draws", F.lit(0.0), lambda a, x: a + x) / F.size("draws") / 1e6).alias("mean_M"),
        (sorted_quantile(v, 0.995) / 1e6).alias("var_995_M"),
    )
    return per_task.groupBy("scenario", *by).agg(
        F.avg("mean_M").alias("mean_M"), F.avg("var_995_M").alias("var_995_M")
    )


def scenario_comparison(per_scenario: DataFrame, baseline: str = "baseline") -> DataFrame:
    """Add the percentage change of VaR 99.5 against the baseline scenario."""
    base = F.max(F.when(F.col("scenario") == baseline, F.col("var_995_M")))
    ref = per_scenario.agg(base.alias("_b")).scalar()
    return per_scenario.withColumn(
        "var_995_vs_baseline",
        F.when(ref > 0, (F.col("var_995_M") / ref - 1.0) * 100).otherwise(F.lit(0.0)),
    )


# --- scenario scorer --------------------------------------------------------------

# Line order, correlation of the four lines, and default parameters.
SCORER_LINES = ("personal_auto", "commercial_auto", "homeowners", "commercial_property")
SCORER_CORRELATION = (
    (1.0, 0.5, 0.3, 0.2),
    (0.5, 1.0, 0.2, 0.3),
    (0.3, 0.2, 1.0, 0.4),
    (0.2, 0.3, 0.4, 1.0),
)
SCORER_DEFAULTS = {
    "mean_ibnr_personal_auto_M": 50.0,
    "mean_ibnr_commercial_auto_M": 30.0,
    "mean_ibnr_homeowners_M": 40.0,
    "mean_ibnr_commercial_property_M": 20.0,
    "cv_personal_auto": 0.15,
    "cv_commercial_auto": 0.18,
    "cv_homeowners": 0.12,
    "cv_commercial_property": 0.20,
    "ldf_multiplier": 1.0,
    "inflation_adj": 0.0,
}
MIN_REPLICATIONS, MAX_REPLICATIONS = 1_000, 500_000


def scenario_shock(line: str) -> tuple[Column, Column]:
    """(mean multiplier, CV multiplier) of one line under the row's scenario."""
    auto = line in ("personal_auto", "commercial_auto")
    scenario, ldf, infl = F.col("scenario"), F.col("ldf_multiplier"), F.col("inflation_adj")
    mean = (
        F.when(scenario == "adverse_development", F.when(ldf > 1.0, ldf).otherwise(F.lit(1.2)))
        .when(scenario == "judicial_inflation", F.lit(1.3 if auto else 1.0))
        .when(scenario == "pandemic_tail", F.lit(1.1))
        .when(scenario == "superimposed_inflation", F.lit(1.0) + F.when(infl > 0, infl).otherwise(F.lit(0.03)))
        .otherwise(F.lit(1.0))
    )
    cv = (
        F.when(scenario == "adverse_development", F.lit(1.15))
        .when(scenario == "judicial_inflation", F.lit(1.1 if auto else 1.0))
        .when(scenario == "pandemic_tail", F.lit(1.2))
        .otherwise(F.lit(1.0))
    )
    return mean, cv


def scorer_draws(requests: DataFrame, seed: int = 42, chunk: int = 10_000, strict: bool = False) -> DataFrame:
    """Correlated lognormal totals per request (request_id, scenario, n_replications,
    means, CVs, ldf_multiplier, inflation_adj).  Columns only: the draws are counter-based,
    and every request sees the same ones.  Requests outside the bounds of replications get the
    nearest bound, seen in n_replications_used; with ``strict`` they fail.
    """
    n = F.greatest(F.lit(MIN_REPLICATIONS), F.least(F.col("n_replications"), F.lit(MAX_REPLICATIONS)))
    if strict:
        message = F.concat(F.lit("replications out of bounds in request "), F.col("request_id").cast("string"))
        n = F.when(n == F.col("n_replications"), n).otherwise(F.raise_error(message).cast("bigint"))
    exprs = {"n_replications_used": n.cast("bigint")}
    for line in SCORER_LINES:
        mean_mult, cv_mult = scenario_shock(line)
        cv = F.col(f"cv_{line}") * cv_mult
        s2 = F.ln(F.lit(1.0) + cv * cv)
        exprs[f"_mu_{line}"] = F.ln(F.col(f"mean_ibnr_{line}_M") * mean_mult) - s2 / 2
        exprs[f"_sd_{line}"] = F.sqrt(s2)
    params = requests.select("request_id", "scenario", *[e.alias(c) for c, e in exprs.items()])
    parts = 4 * int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = params.withColumn(
        "_chunk",
        F.explode(F.sequence(F.lit(0), F.floor((F.col("n_replications_used") - 1) / chunk).cast("int"))),
    ).repartition(parts, "request_id", "_chunk")
    first = F.col("_chunk").cast("bigint") * chunk
    last = F.least(first + (chunk - 1), F.col("n_replications_used") - 1)
    reps = chunks.withColumn("rep", F.explode(F.sequence(first, last)))
    lower = np.linalg.cholesky(np.array(SCORER_CORRELATION))
    reps = reps.withColumns({f"_z{j}": normal(str(seed), "rep", j + 1) for j in range(len(SCORER_LINES))})
    total = F.lit(0.0)
    for i, line in enumerate(SCORER_LINES):
        z = F.lit(0.0)
        for j in range(i + 1):
            z = z + F.col(f"_z{j}") * F.lit(float(lower[i, j]))
        total = total + F.exp(F.col(f"_mu_{line}") + F.col(f"_sd_{line}") * z)
    return reps.select("request_id", "scenario", "n_replications_used", "rep", total.alias("ibnr_M"))


SCORER_METRICS = (
    "best_estimate_M",
    "var_95_M",
    "var_99_M",
    "var_995_M",
    "cvar_99_M",
    "reserve_risk_capital_M",
    "max_ibnr_M",
)


def score_scenarios(requests: DataFrame, seed: int = 42, strict: bool = False) -> DataFrame:
    """A table of requests in, one row of metrics per request out (3 digits)."""
    metrics = task_metrics(scorer_draws(requests, seed, strict=strict), ("request_id", "scenario", "n_replications_used"))
    return metrics.select(
        "request_id", *[fixed(m, 3).alias(m) for m in SCORER_METRICS], "n_replications_used", "scenario"
    )


# --- run-off ----------------------------------------------------------------------


def ruin_probability(paths: DataFrame, by: Sequence[str] = ("scenario", "month"), value: str = "surplus") -> DataFrame:
    return paths.groupBy(*by).agg(F.avg((F.col(value) < 0).cast("double")).alias("ruin_probability"))

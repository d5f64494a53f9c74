"""Chain-ladder factors, Mack uncertainty, IBNR, residuals and scenario factors.

All inputs are aggregated triangles: per group at most (accident periods x lags)
cells, so the windows below are bounded by the calendar, not by claim volume.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import fixed, safe_ratio
from .gold import triangle

LINE = ("product_line",)


def line_triangle(reserves: DataFrame, by: Sequence[str] = LINE) -> DataFrame:
    """Cumulative paid per (by, accident_month, dev_lag)."""
    return triangle(reserves, by, ("cumulative_paid",))


def triangle_pivot(tri: DataFrame, lags: Sequence[int], by: Sequence[str] = LINE) -> DataFrame:
    """Accident x lag matrix with a fixed lag list; a lag outside the list fails the query."""
    outside = F.raise_error(F.concat(F.lit("lag outside the list: "), F.col("dev_lag"))).cast("double")
    paid = F.when(F.col("dev_lag").isin(*lags), F.col("cumulative_paid")).otherwise(outside)
    wide = tri.withColumn("cumulative_paid", paid).groupBy(*by, "accident_month").pivot("dev_lag", list(lags)).agg(F.sum("cumulative_paid"))
    return wide.select(*by, "accident_month", *[F.col(str(k)).alias(f"lag_{k}") for k in lags])


def adjacent_pairs(tri: DataFrame, by: Sequence[str] = LINE) -> DataFrame:
    """Every cell with a later lag in its group, and the value at that next lag.

    ``usable`` marks pairs with both values present and a positive first one.
    The next lag is the next one seen anywhere in the group, so a hole in one
    accident period is not bridged.
    """
    later = Window.partitionBy(*by).orderBy("dev_lag").rangeBetween(1, Window.unboundedFollowing)
    row = Window.partitionBy(*by, "accident_month").orderBy("dev_lag")
    return (
        tri.withColumns(
            {
                "next_lag": F.min("dev_lag").over(later),
                "_lead_lag": F.lead("dev_lag").over(row),
                "_lead": F.lead("cumulative_paid").over(row),
            }
        )
        .filter("next_lag IS NOT NULL")
        .withColumn("next_paid", F.when(F.col("_lead_lag") == F.col("next_lag"), F.col("_lead")))
        .withColumn(
            "usable", F.coalesce(F.col("next_paid").isNotNull() & (F.col("cumulative_paid") > 0), F.lit(False))
        )
        .drop("_lead_lag", "_lead")
    )


def development_factors(pairs: DataFrame, by: Sequence[str] = LINE) -> DataFrame:
    """Volume-weighted factor, Mack sigma and factor standard error per (by, dev_lag).

    Fewer than two usable pairs: factor 1, sigma and error 0.  The factor is a
    window value so the second pass shares the first one's shuffle.
    """
    w = Window.partitionBy(*by, "dev_lag")

    def usable(c: Column) -> Column:
        return F.when(F.col("usable"), c)

    paid, nxt = F.col("cumulative_paid"), F.col("next_paid")
    fitted = pairs.withColumns(
        {"_c": usable(paid), "_n": usable(nxt)}
    ).withColumn("_f", F.sum("_n").over(w) / F.sum("_c").over(w))
    enough = F.col("n_pairs") >= 2
    return (
        fitted.groupBy(*by, "dev_lag")
        .agg(
            F.count("_c").alias("n_pairs"),
            F.sum("_c").alias("_volume"),
            F.first("_f").alias("_factor"),
            F.sum(F.col("_c") * F.pow(F.col("_n") / F.col("_c") - F.col("_f"), F.lit(2.0))).alias("_dev"),
        )
        .withColumn(
            "_var",
            F.when(enough, F.col("_dev") / F.greatest(F.col("n_pairs") - 1, F.lit(1))).otherwise(F.lit(0.0)),
        )
        .select(
            *by,
            "dev_lag",
            F.when(enough, F.col("_factor")).otherwise(F.lit(1.0)).alias("ldf"),
            F.sqrt("_var").alias("mack_sigma"),
            F.when(enough, F.sqrt(F.col("_var") / F.greatest(F.col("_volume"), F.lit(1.0))))
            .otherwise(F.lit(0.0))
            .alias("ldf_se"),
            "n_pairs",
        )
    )


def simple_link_ratios(pairs: DataFrame, by: Sequence[str] = LINE) -> DataFrame:
    """Mean of the individual ratios per lag (not volume-weighted), 3 digits."""
    return (
        pairs.filter("usable")
        .groupBy(*by, "dev_lag", "next_lag")
        .agg(fixed(F.avg(F.col("next_paid") / F.col("cumulative_paid")), 3).alias("avg_link_ratio"))
    )


def latest_diagonal(tri: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The row with the largest lag per key: an aggregate, so combined map-side."""
    rest = [c for c in tri.columns if c not in keys]
    return tri.groupBy(*keys).agg(F.max_by(F.struct(*rest), "dev_lag").alias("_r")).select(*keys, "_r.*")


def cdf_to_ultimate(factors: DataFrame, by: Sequence[str] = LINE, factor: str = "ldf") -> DataFrame:
    """Product of the factors from each lag to the last."""
    w = (
        Window.partitionBy(*by)
        .orderBy("dev_lag")
        .rowsBetween(Window.currentRow, Window.unboundedFollowing)
    )
    return factors.select(*by, "dev_lag", F.product(factor).over(w).alias("cdf"))


def ibnr_by_accident(tri: DataFrame, factors: DataFrame, by: Sequence[str] = LINE) -> DataFrame:
    """Latest paid, factor to ultimate, ultimate and IBNR (floored at 0) per accident period."""
    latest = latest_diagonal(tri, [*by, "accident_month"])
    cdf = cdf_to_ultimate(factors, by)
    return (
        latest.join(cdf, [*by, "dev_lag"], "left")
        .withColumn("cdf", F.coalesce("cdf", F.lit(1.0)))
        .select(
            *by,
            "accident_month",
            F.col("dev_lag").alias("latest_lag"),
            F.col("cumulative_paid").alias("latest_paid"),
            "cdf",
            (F.col("cumulative_paid") * F.col("cdf")).alias("ultimate"),
            F.greatest(F.col("cumulative_paid") * (F.col("cdf") - 1.0), F.lit(0.0)).alias("ibnr"),
        )
    )


def ibnr_total(by_accident: DataFrame, by: Sequence[str] = LINE) -> DataFrame:
    return by_accident.groupBy(*by).agg(
        F.sum("latest_paid").alias("latest_paid"),
        F.sum("ultimate").alias("ultimate"),
        F.sum("ibnr").alias("total_ibnr"),
    )


def with_fitted(pairs: DataFrame, factors: DataFrame, by: Sequence[str] = LINE) -> DataFrame:
    """Attach the factor of its (by, lag) to every usable pair: fitted = f * C."""
    return (
        pairs.filter("usable")
        .join(factors.select(*by, "dev_lag", "ldf"), [*by, "dev_lag"])
        .withColumn("fitted", F.col("ldf") * F.col("cumulative_paid"))
    )


def pearson_residuals(pairs: DataFrame, factors: DataFrame, by: Sequence[str] = LINE) -> DataFrame:
    return (
        with_fitted(pairs, factors, by)
        .filter("fitted > 0")
        .select(
            *by,
            "accident_month",
            F.col("dev_lag").alias("dev_lag_from"),
            F.col("next_lag").alias("dev_lag_to"),
            F.col("next_paid").alias("observed"),
            "fitted",
            F.col("cumulative_paid").alias("c_from"),
            ((F.col("next_paid") - F.col("fitted")) / F.sqrt("fitted")).alias("residual"),
            F.col("ldf").alias("f_k"),
        )
    )


def ldf_volatility(
    factors: DataFrame, totals: DataFrame, residuals: DataFrame, by: Sequence[str] = LINE
) -> DataFrame:
    """Factor spread, IBNR in millions and residual moments (population std), 4 digits."""
    spread = factors.groupBy(*by).agg(
        F.avg("ldf").alias("_avg"), F.stddev_pop("ldf").alias("_std"), F.count("*").alias("n_factors")
    )
    moments = residuals.groupBy(*by).agg(
        F.avg("residual").alias("_rm"), F.stddev_pop("residual").alias("_rs"), F.count("*").alias("n_residuals")
    )
    return (
        spread.join(totals, list(by))
        .join(moments, list(by))
        .select(
            *by,
            fixed("_avg", 4).alias("avg_ldf"),
            fixed("_std", 4).alias("std_ldf"),
            fixed(safe_ratio("_std", "_avg", 0.15), 4).alias("cv"),
            fixed(F.col("total_ibnr") / 1e6, 4).alias("ibnr_M"),
            "n_factors",
            fixed("_rm", 4).alias("mean_residual"),
            fixed("_rs", 4).alias("std_residual"),
            "n_residuals",
        )
    )


@dataclass(frozen=True)
class Scenario:
    """A factor adjustment; ``rule`` names which lags the multiplier is spread over."""

    scenario: str
    label: str
    rule: str = "none"
    ldf_multiplier: float = 1.0
    inflation_adj: float = 0.0


# The reserve deterioration scenarios.
SCENARIOS = (
    Scenario("baseline", "Baseline"),
    Scenario("adverse_development", "Adverse Development (+20% tail uplift)", "late", 1.2),
    Scenario("judicial_inflation", "Judicial Inflation (+30% Auto tail)", "auto_tail", 1.30),
    Scenario("pandemic_tail", "Pandemic Tail (+10% all lines)", "all", 1.1),
    Scenario("superimposed_inflation", "Superimposed Inflation (CPI+3%/yr)", "inflation", 1.0, 0.03),
)
AUTO_LINES = ("Personal_Auto", "Commercial_Auto")
TAIL_LAG = 24


def evolution_scenarios(months: int = 12, step: float = 0.005, apply_multiplier: bool = True) -> tuple[Scenario, ...]:
    """Monthly outlook: the multiplier grows by ``step`` a month, spread over all lags."""
    rule = "all" if apply_multiplier else "none"
    return tuple(Scenario(f"month_{i:02d}", f"Month {i}", rule, 1.0 + step * i) for i in range(1, months + 1))


def scenario_array(scenarios: Sequence[Scenario]) -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(s.scenario).alias("scenario"),
                F.lit(s.rule).alias("rule"),
                F.lit(float(s.ldf_multiplier)).alias("ldf_multiplier"),
                F.lit(float(s.inflation_adj)).alias("inflation_adj"),
            )
            for s in scenarios
        ]
    )


def scenario_ldfs(
    factors: DataFrame,
    scenarios: Sequence[Scenario] = SCENARIOS,
    by: Sequence[str] = LINE,
    auto_lines: Sequence[str] = AUTO_LINES,
    tail_lag: int = TAIL_LAG,
) -> DataFrame:
    """Factors per scenario.  Multipliers act on the cumulative tail: each of the n
    affected lags gets m^(1/n); calendar inflation gets (1 + r)^(3/12) at every lag.
    """
    w = Window.partitionBy("scenario", *by)
    rule = F.col("rule")
    hit = (
        F.when(rule == "late", F.col("dev_lag") >= F.max("dev_lag").over(w) * 0.5)
        .when(rule == "auto_tail", F.col(by[0]).isin(*auto_lines) & (F.col("dev_lag") >= tail_lag))
        .when(rule == "all", F.lit(True))
        .otherwise(F.lit(False))
    )
    n_hit = F.sum(F.col("_hit").cast("int")).over(w)
    return (
        factors.select("*", F.inline(scenario_array(scenarios)))
        .withColumn("_hit", hit)
        .withColumn(
            "scenario_ldf",
            F.col("ldf")
            * F.when(F.col("_hit"), F.pow("ldf_multiplier", F.lit(1.0) / n_hit)).otherwise(F.lit(1.0))
            * F.when(rule == "inflation", F.pow(F.lit(1.0) + F.col("inflation_adj"), F.lit(0.25))).otherwise(
                F.lit(1.0)
            ),
        )
        .drop("_hit", "rule", "ldf_multiplier", "inflation_adj")
    )

"""Monthly claims, development triangle, rolling features, macro features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import first_of_month, fixed, growth_pct, map_lookup, pct_change, safe_ratio, segment_key

# The indicators the macro flow accepts.
INDICATORS = ("unemployment_rate", "hpi_index", "housing_starts")


def claims_monthly(claims: DataFrame) -> DataFrame:
    """Claim events to one row per (segment, month).

    One shuffle of partially aggregated rows; a hot segment is combined map-side.
    Money sums are rounded to cents, so the table does not depend on the order in
    which doubles were added.
    """
    return (
        claims.groupBy(
            segment_key("product_line", "region").alias("segment_id"),
            "product_line",
            "region",
            first_of_month("loss_date").alias("month"),
        )
        .agg(
            F.count("*").alias("claims_count"),
            fixed(F.sum("claim_amount"), 2).alias("total_incurred"),
            F.count("claim_amount").alias("_n"),
            fixed(F.sum("monthly_prem_exposure"), 2).alias("earned_premium"),
        )
        .select(
            "segment_id",
            "product_line",
            "region",
            "month",
            "claims_count",
            "total_incurred",
            safe_ratio("total_incurred", "_n").alias("avg_severity"),
            "earned_premium",
            safe_ratio("total_incurred", "earned_premium", 0.0).alias("loss_ratio"),
        )
    )


def claim_keys() -> dict[str, Column | str]:
    """The keys of the monthly table over claim events."""
    return {
        "segment_id": segment_key("product_line", "region"),
        "product_line": "product_line",
        "region": "region",
        "month": first_of_month("loss_date"),
    }


# The monthly table as mergeable partials of claim events.
CLAIM_PARTIALS = {
    "claim_sum": ("sum", "claim_amount"),
    "claim_n": ("count", "claim_amount"),
    "premium_sum": ("sum", "monthly_prem_exposure"),
    "smallest_claim": ("min", "claim_amount"),
    "largest_claim": ("max", "claim_amount"),
}


def monthly_of_partials(partials: DataFrame) -> DataFrame:
    """The monthly claims table from its partials, equal to ``claims_monthly`` of all events."""
    total, premium = (fixed(F.col(c).cast("double"), 2) for c in ("claim_sum", "premium_sum"))
    named = partials.withColumns({"total_incurred": total, "earned_premium": premium})
    return named.select(
        "segment_id",
        "product_line",
        "region",
        "month",
        F.col("_rows").alias("claims_count"),
        "total_incurred",
        safe_ratio("total_incurred", "claim_n").alias("avg_severity"),
        "earned_premium",
        safe_ratio("total_incurred", "earned_premium", 0.0).alias("loss_ratio"),
    )


MEASURES = ("cumulative_paid", "cumulative_incurred", "case_reserve")


def triangle(
    reserves: DataFrame,
    by: Sequence[str] = ("segment_id", "product_line", "region"),
    measures: Sequence[str] = MEASURES,
) -> DataFrame:
    """Sum the measures per (by, accident_month, dev_lag), to cents."""
    return reserves.groupBy(*by, "accident_month", "dev_lag").agg(
        *[fixed(F.sum(m), 2).alias(m) for m in measures]
    )


def with_incrementals(
    tri: DataFrame,
    keys: Sequence[str] = ("segment_id",),
    measures: Mapping[str, str] | None = None,
) -> DataFrame:
    """Cumulative at a lag minus cumulative at the lag before (the first lag keeps its value).

    The window holds one accident period: at most the maximum lag in rows.
    """
    measures = measures or {
        "incremental_paid": "cumulative_paid",
        "incremental_incurred": "cumulative_incurred",
    }
    w = Window.partitionBy(*keys, "accident_month").orderBy("dev_lag")
    return tri.withColumns(
        {n: F.col(c) - F.coalesce(F.lag(c).over(w), F.lit(0.0)) for n, c in measures.items()}
    )


def reserve_triangle(current_reserves: DataFrame) -> DataFrame:
    """Triangle of current versions with incremental columns."""
    return with_incrementals(triangle(current_reserves))


def rolling_features(monthly: DataFrame, value: str = "claims_count") -> DataFrame:
    """3/6/12-row means, 3-row sample std, change against 1 and 12 rows back.

    Frames count rows, so a missing month is skipped, not filled.  All windows
    share one ordering: one shuffle, one sort; a segment is bounded by its months.
    """
    w = Window.partitionBy("segment_id").orderBy("month")

    def frame(n: int):
        return w.rowsBetween(1 - n, 0)

    return monthly.withColumns(
        {
            "rolling_3m_mean": F.avg(value).over(frame(3)),
            "rolling_6m_mean": F.avg(value).over(frame(6)),
            "rolling_12m_mean": F.avg(value).over(frame(12)),
            "rolling_3m_std": F.stddev_samp(value).over(frame(3)),
            "mom_change_pct": pct_change(value, F.lag(value, 1).over(w)),
            "yoy_change_pct": pct_change(value, F.lag(value, 12).over(w)),
        }
    )


def pivot_indicators(
    current: DataFrame,
    keys: Sequence[str] = ("province", "ref_date"),
    indicators: Sequence[str] = INDICATORS,
) -> DataFrame:
    """Long to wide with a fixed value list, so no extra job looks for the values."""
    return current.groupBy(*keys).pivot("indicator_name", list(indicators)).agg(F.first("value"))


def macro_features(
    current: DataFrame,
    province_map: Mapping[str, str],
    month: Column | None = None,
    indicators: Sequence[str] = INDICATORS,
    growth_of: str = "hpi_index",
) -> DataFrame:
    """Current indicator rows to one wide row per (region, month).

    Provinces outside ``province_map`` are dropped before the pivot.  ``month``
    defaults to the first day of a 'YYYY-MM' ref_date.
    """
    month = month if month is not None else F.to_date(F.concat("ref_date", F.lit("-01")))
    known = current.withColumn("region", map_lookup("province", province_map)).filter("region IS NOT NULL")
    wide = pivot_indicators(known, ("province", "region", "ref_date"), indicators).withColumn("month", month)
    w = Window.partitionBy("province").orderBy("month")
    return wide.select(
        "region",
        "month",
        *indicators,
        growth_pct(growth_of, F.lag(growth_of).over(w)).alias("hpi_growth"),
    )

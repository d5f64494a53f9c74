"""Claim-frequency forecasts per segment: seasonal-naive with moment-based volatility, in columns."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import fixed
from .features import future_months
from .quantiles import correlation

SEASON = 12
HOLDOUT = 12
MAX_HORIZON = 24
# The regressors of the frequency model.
REGRESSORS = ("unemployment_rate", "hpi_growth", "rolling_3m_mean", "coeff_variation_3m", "mom_change_pct")
# The columns of the forecast table after segment and month.
FORECAST_COLUMNS = (
    "record_type claims_count forecast_mean forecast_lo95 forecast_hi95 aic mape mape_baseline mape_sarimax "
    "exog_vars cond_volatility arch_lm_pvalue garch_alpha garch_beta method"
).split()


def clamp_horizon(horizon: int) -> int:
    return max(1, min(int(horizon), MAX_HORIZON))


# --- native ---------------------------------------------------------------------


def seasonal_naive(panel: DataFrame, horizon: int = 12) -> DataFrame:
    """Actual rows and forecasts equal to the value 12 rows earlier, in the forecast schema.

    Band: 1.96 population std of the seasonal differences.  Volatility per actual row
    is that std; alpha is the ARCH(1) moment estimate (lag-1 correlation of squared
    differences, when positive) and its p-value the chi-square(2) tail of n * r^2.
    """
    horizon = clamp_horizon(horizon)
    w = Window.partitionBy("segment_id").orderBy("month")
    rows = panel.select("segment_id", "month", F.col("claims_count").cast("double").alias("y"))
    diffs = (
        rows.withColumn("_d", F.col("y") - F.lag("y", SEASON).over(w))
        .withColumn("_d2", F.col("_d") * F.col("_d"))
        .withColumn("_l2", F.lag("_d2").over(w))
        .withColumn("_rn", F.row_number().over(Window.partitionBy("segment_id").orderBy(F.col("month").desc())))
    )
    ape = F.abs(F.col("_d")) / F.greatest(F.col("y"), F.lit(1.0)) * 100
    stats = diffs.groupBy("segment_id").agg(
        F.stddev_pop("_d").alias("_sd"),
        F.avg(F.when(F.col("_rn") <= HOLDOUT, ape)).alias("_mape"),
        F.count("_l2").alias("_m"),
        correlation("_d2", "_l2").alias("_r"),
    )
    stats = stats.select(
        "segment_id",
        "_sd",
        "_mape",
        F.exp(-F.col("_m") * F.col("_r") * F.col("_r") / 2).alias("_p"),
        F.when(F.col("_r") > 0, F.col("_r")).alias("_alpha"),
    )
    none = F.lit(None).cast("double")

    def shaped(df: DataFrame, **cols) -> DataFrame:
        values = {
            "claims_count": none,
            "forecast_mean": none,
            "forecast_lo95": none,
            "forecast_hi95": none,
            "aic": none,
            "mape": none,
            "mape_baseline": none,
            "mape_sarimax": none,
            "exog_vars": F.lit(None).cast("string"),
            "cond_volatility": F.col("_sd"),
            "arch_lm_pvalue": F.col("_p"),
            "garch_alpha": F.col("_alpha"),
            "garch_beta": F.when(F.col("_alpha").isNotNull(), F.lit(0.0)),
            "method": F.lit("seasonal_naive"),
        }
        values.update(cols)
        return df.select(
            "segment_id", "month", *[values[c].alias(c) for c in FORECAST_COLUMNS]
        )

    actual = shaped(
        diffs.select("segment_id", "month", "y").join(stats, "segment_id"),
        record_type=F.lit("actual"),
        claims_count=F.col("y"),
    )
    # the h-th month repeats the row 12 (24, ...) rows before it
    ahead = future_months(panel, horizon).withColumn(
        "_rn", F.lit(SEASON) - F.pmod(F.col("month_offset") - 1, F.lit(SEASON))
    )
    last = diffs.select("segment_id", "_rn", F.col("y").alias("_f"))
    forecast = shaped(
        ahead.join(last, ["segment_id", "_rn"], "left").join(stats, "segment_id"),
        record_type=F.lit("forecast"),
        forecast_mean=F.col("_f"),
        forecast_lo95=F.col("_f") - 1.96 * F.col("_sd"),
        forecast_hi95=F.col("_f") + 1.96 * F.col("_sd"),
        mape=F.col("_mape"),
        mape_baseline=F.col("_mape"),
    )
    return actual.unionByName(forecast)


# --- grouped map ------------------------------------------------------------------


def forecast_horizon(forecast: DataFrame) -> DataFrame:
    """Forecast rows numbered 1..h per segment, rounded to one digit."""
    w = Window.partitionBy("segment_id").orderBy("month")
    return forecast.filter(F.col("record_type") == "forecast").select(
        "segment_id",
        F.row_number().over(w).alias("month_offset"),
        *[fixed(c, 1).alias(c) for c in ("forecast_mean", "forecast_lo95", "forecast_hi95")],
    )


# --- pandas twins of native operators -----------------------------------------------


def rolling_features_pandas(monthly: DataFrame, bridge: bool = False) -> DataFrame:
    """Grouped-map twin of ``rolling_features``; ``bridge`` passes through pandas-on-Spark."""
    schema = T.StructType(
        [
            *monthly.schema.fields,
            *[
                T.StructField(c, T.DoubleType())
                for c in (
                    "rolling_3m_mean",
                    "rolling_6m_mean",
                    "rolling_12m_mean",
                    "rolling_3m_std",
                    "mom_change_pct",
                    "yoy_change_pct",
                )
            ],
        ]
    )

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.iloc[np.argsort(pdf["month"].to_numpy(), kind="stable")]
        x = pdf["claims_count"].to_numpy(dtype=float)
        upto = np.arange(1, len(x) + 1)
        sums = np.concatenate(([0.0], np.cumsum(x)))

        def mean(k: int) -> np.ndarray:
            start = np.maximum(upto - k, 0)
            return (sums[upto] - sums[start]) / (upto - start)

        def before(k: int) -> np.ndarray:
            return np.concatenate((np.full(min(k, len(x)), np.nan), x[: max(len(x) - k, 0)]))

        def change(k: int) -> np.ndarray:
            b = before(k)
            usable = ~np.isnan(b) & (b != 0)
            return np.where(usable, (x - b) / np.where(usable, b, 1.0) * 100, 0.0)

        centre, n = mean(3), np.minimum(upto, 3)
        spread = sum(np.nan_to_num((v - centre) ** 2) for v in (x, before(1), before(2)))
        return pdf.assign(
            rolling_3m_mean=centre,
            rolling_6m_mean=mean(6),
            rolling_12m_mean=mean(12),
            rolling_3m_std=np.where(n > 1, np.sqrt(spread / np.maximum(n - 1, 1)), np.nan),
            mom_change_pct=change(1),
            yoy_change_pct=change(12),
        )

    if bridge:
        mapped = monthly.pandas_api().to_spark().groupBy("segment_id").applyInPandas(run, schema)
        return mapped.pandas_api().to_spark()
    return monthly.groupBy("segment_id").applyInPandas(run, schema)


def ols_trend_pandas(monthly: DataFrame) -> DataFrame:
    """Grouped-map twin of ``ols_trend``."""
    schema = "segment_id string, slope double, intercept double, r_squared double, annualized_growth_pct double"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort(pdf["month"].to_numpy(), kind="stable")
        y = pdf["claims_count"].to_numpy(dtype=float)[order]
        t = np.arange(len(y), dtype=float)
        slope = intercept = r2 = None
        if len(y) > 1:
            tc, yc = t - t.mean(), y - y.mean()
            slope = float(tc @ yc / (tc @ tc))
            intercept = float(y.mean() - slope * t.mean())
            ss = float(yc @ yc)
            r2 = 1.0 if ss == 0 else float((tc @ yc) ** 2 / ((tc @ tc) * ss))
        growth = None if slope is None else (slope * 12 / y.mean() * 100 if y.mean() > 0 else 0.0)
        return pd.DataFrame([[pdf["segment_id"].iloc[0], slope, intercept, r2, growth]], columns=schema_names)

    schema_names = [p.split()[0] for p in schema.split(", ")]
    return monthly.select("segment_id", "month", "claims_count").groupBy("segment_id").applyInPandas(run, schema)

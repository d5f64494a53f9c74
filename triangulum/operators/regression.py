"""Regressions of many groups at once: one aggregate of products, then small systems solved in columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEASON, ORIGINS, ARCH_LAGS = 12, 12, 4


def _total(parts: Sequence[Column]) -> Column:
    return reduce(Column.__add__, parts)


def gram(df: DataFrame, by: Sequence[str], y: str, xs: Sequence[str]) -> DataFrame:
    """n and the centred sums of products c_i_j (i <= j) of ``xs`` and ``y`` (the last index) per group.

    Rows with a null take no part.  The means come first, so that the products lose no digits
    to large values; both aggregates combine before their shuffle.
    """
    names = [*xs, y]
    whole = df.filter(reduce(Column.__and__, [F.col(c).isNotNull() for c in names]))
    means = whole.groupBy(*by).agg(*[F.avg(c).alias(f"_m{i}") for i, c in enumerate(names)])
    centred = whole.join(means, list(by)).select(
        *by, *[(F.col(c) - F.col(f"_m{i}")).alias(f"_c{i}") for i, c in enumerate(names)]
    )
    products = [
        F.sum(F.col(f"_c{i}") * F.col(f"_c{j}")).alias(f"c_{i}_{j}") for i in range(len(names)) for j in range(i, len(names))
    ]
    return centred.groupBy(*by).agg(F.count("*").alias("n"), *products)


def explained(grams: DataFrame, k: int) -> DataFrame:
    """R2 of the regression on ``k`` regressors and a constant, by Cholesky factors written as columns.

    Null where the regressors are linearly dependent or y does not vary.
    """
    out = grams
    for j in range(k):
        pivot = F.col(f"c_{j}_{j}") - _total([F.lit(0.0), *[F.col(f"l_{j}_{p}") * F.col(f"l_{j}_{p}") for p in range(j)]])
        out = out.withColumn(f"l_{j}_{j}", F.when(pivot > F.col(f"c_{j}_{j}") * 1e-12, F.sqrt(pivot)))
        below = {}
        for i in range(j + 1, k + 1):  # row k is y: its factors are the projections on the regressors
            inner = _total([F.lit(0.0), *[F.col(f"l_{i}_{p}") * F.col(f"l_{j}_{p}") for p in range(j)]])
            below[f"l_{i}_{j}"] = (F.col(f"c_{j}_{i}") - inner) / F.col(f"l_{j}_{j}")
        out = out.withColumns(below)
    square = _total([F.col(f"l_{k}_{p}") * F.col(f"l_{k}_{p}") for p in range(k)])
    return out.withColumn("r2", F.when(F.col(f"c_{k}_{k}") > 0, square / F.col(f"c_{k}_{k}")))


def seasonal_differences(panel: DataFrame, value: str = "claims_count", season: int = SEASON) -> DataFrame:
    """segment_id, month, y and d, the change against ``season`` rows before (null in the first ones)."""
    w = Window.partitionBy("segment_id").orderBy("month")
    y = F.col(value).cast("double")
    return panel.select("segment_id", "month", y.alias("y"), (y - F.lag(y, season).over(w)).alias("d"))


def arch_lm(panel: DataFrame, value: str = "claims_count", lags: int = ARCH_LAGS) -> DataFrame:
    """Lagrange multiplier test for ARCH effects per segment: n, r2, lm = n * r2 and its chi-square p-value.

    The squared seasonal differences are regressed on their ``lags`` (an even number) values
    before, all segments in one aggregate.  Segments without two more rows than coefficients,
    or whose squares do not vary, have nulls.
    """
    if lags % 2:
        raise ValueError("the chi-square tail is written for an even number of lags")
    w = Window.partitionBy("segment_id").orderBy("month")
    squares = seasonal_differences(panel, value).withColumn("e", F.col("d") * F.col("d"))
    names = [f"e{k}" for k in range(1, lags + 1)]
    lagged = squares.withColumns({n: F.lag("e", k).over(w) for k, n in enumerate(names, 1)})
    found = explained(gram(lagged, ["segment_id"], "e", names), lags)
    enough = F.col("n") >= lags + 3
    r2 = F.when(enough, F.col("r2"))
    half = F.col("lm") / 2
    terms, term = [], F.lit(1.0)
    for i in range(lags // 2):  # tail of chi-square with an even number of degrees of freedom
        term = term * half / i if i else term
        terms.append(term)
    rows = found.select("segment_id", "n", r2.alias("r2")).withColumn("lm", F.col("n") * F.col("r2"))
    rows = rows.withColumn("p_value", F.exp(-half) * _total(terms))
    return panel.select("segment_id").distinct().join(rows, "segment_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def holdout_origins(panel: DataFrame, regressor: str, value: str = "claims_count", origins: int = ORIGINS) -> DataFrame:
    """segment_id, month, model, actual, predicted and error at each of the last ``origins`` rows of a segment.

    Model ``seasonal`` repeats the value 12 rows before; model ``regressor`` adds a + b * dx, the
    line of seasonal differences on those of the regressor, fitted to the rows before the origin
    only.  Running sums give every origin's line in one window pass, without refitting.  Without
    two earlier values of dx that differ, the line is the mean difference.
    """
    w = Window.partitionBy("segment_id").orderBy("month")
    back = Window.partitionBy("segment_id").orderBy(F.col("month").desc())
    y, x = F.col(value).cast("double"), F.col(regressor).cast("double")
    rows = panel.select(
        "segment_id", "month", y.alias("y"),
        (y - F.lag(y, SEASON).over(w)).alias("d"), (x - F.lag(x, SEASON).over(w)).alias("dx"),
        F.row_number().over(back).alias("_back"),
    )
    both = F.col("d").isNotNull() & F.col("dx").isNotNull()
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    sums = {"_n": F.lit(1.0), "_sd": F.col("d"), "_sx": F.col("dx"), "_sxd": F.col("dx") * F.col("d"), "_sxx": F.col("dx") * F.col("dx")}
    rows = rows.withColumns({n: F.sum(F.when(both, c)).over(earlier) for n, c in sums.items()})
    spread = F.col("_n") * F.col("_sxx") - F.col("_sx") * F.col("_sx")
    slope = (F.col("_n") * F.col("_sxd") - F.col("_sx") * F.col("_sd")) / spread
    slope = F.when(spread > 1e-9 * F.col("_n") * F.col("_sxx"), slope).otherwise(F.lit(0.0))
    rows = rows.filter((F.col("_back") <= origins) & both & (F.col("_n") >= 1)).withColumn("_b", slope)
    step = F.col("_sd") / F.col("_n") + F.col("_b") * (F.col("dx") - F.col("_sx") / F.col("_n"))
    before = F.col("y") - F.col("d")
    models = F.array(
        F.struct(F.lit("seasonal").alias("model"), before.alias("predicted")),
        F.struct(F.lit("regressor").alias("model"), (before + step).alias("predicted")),
    )
    scored = rows.select("segment_id", "month", F.col("y").alias("actual"), F.inline(models))
    return scored.withColumn("error", F.col("actual") - F.col("predicted"))


# Fitted coefficients of each model.
COEFFICIENTS = {"seasonal": 0, "regressor": 2}


def holdout_models(origins: DataFrame) -> DataFrame:
    """Per segment and model: origins, mape, rmse, aic, bic, and whether it is the segment's best by rmse.

    aic and bic count the coefficients and the variance; errors that are all zero have none.
    Models of equal rmse are both best.
    """
    n, sse = F.col("origins"), F.col("_sse")
    k = reduce(lambda c, m: c.when(F.col("model") == m, F.lit(COEFFICIENTS[m] + 1)), COEFFICIENTS, F)
    scored = origins.groupBy("segment_id", "model").agg(
        F.count("*").alias("origins"),
        (F.avg(F.abs("error") / F.greatest("actual", F.lit(1.0))) * 100).alias("mape"),
        F.sqrt(F.avg(F.col("error") * F.col("error"))).alias("rmse"),
        F.sum(F.col("error") * F.col("error")).alias("_sse"),
    )
    fit = F.when(sse > 0, n * F.ln(sse / n))
    scored = scored.withColumns({"aic": fit + 2 * k, "bic": fit + k * F.ln(n)}).drop("_sse")
    return scored.withColumn("best", F.col("rmse") == F.min("rmse").over(Window.partitionBy("segment_id")))

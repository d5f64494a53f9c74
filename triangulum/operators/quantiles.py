"""Exact quantiles and tail means: distributed for any size, in one group for bounded ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .skew import bounded_broadcast

# The percentile sets of the reserve and surplus reports.
RISK_PROBS = (0.75, 0.90, 0.95, 0.99, 0.995)
BAND_PROBS = (0.05, 0.25, 0.50, 0.75, 0.95)
# Distinct values that one task may sort, and the bins of a refinement.
BRACKET_VALUES, BINS = 200_000, 64


def _position() -> Column:
    return F.col("prob") * (F.col("_n") - 1)


def _at_ranks(what: str) -> list[Column]:
    """The least ``what`` whose running count passes the rank below the position, and the next rank."""
    rank = F.floor(_position())
    return [
        F.min(F.when(F.col("_cum") > rank, F.col(what))).alias("_lo"),
        F.min(F.when(F.col("_cum") > F.least(rank + 1, F.col("_n") - 1), F.col(what))).alias("_hi"),
    ]


def _refined(tallied: DataFrame, by: Sequence[str], most: int) -> DataFrame:
    """The tallies (by, _n, _v, _c) with every bracket narrowed until it has at most ``most`` values.

    A bracket with more is cut at quantiles of its distinct values, the counts of its bins
    are summed, and the bins that hold neither wanted rank are dropped or, below them, folded
    into the row without a value.  At most two bins of about a 64th of the values stay
    whatever their distribution, so rounds grow with the logarithm of the bracket.
    """
    if most < BINS:
        raise ValueError(f"most must be at least {BINS}")
    edges = [i / BINS for i in range(1, BINS)]
    while True:
        tallied = materialize(tallied, "brackets")
        large = tallied.groupBy(*by).agg(F.count("_v").alias("_values"), F.percentile_approx("_v", edges, 1_000).alias("_edges"))
        large = materialize(large.filter(F.col("_values") > most).select(*by, "_edges"), "edges")
        if large.isEmpty():
            return tallied
        binned = tallied.join(bounded_broadcast(large), list(by), "left")
        below = F.size(F.filter("_edges", lambda e: e < F.col("_v")))
        binned = binned.withColumn("_bin", F.when(F.col("_v").isNotNull() & F.col("_edges").isNotNull(), below))
        counts = binned.filter("_edges IS NOT NULL").groupBy(*by, "_n", "_bin").agg(F.sum("_c").alias("_c"))
        w = Window.partitionBy(*by).orderBy(F.col("_bin").asc_nulls_first())
        wanted = counts.withColumn("_cum", F.sum("_c").over(w)).groupBy(*by, "_n").agg(*_at_ranks("_bin")).drop("_n")
        kept = binned.join(bounded_broadcast(materialize(wanted, "bins")), list(by), "left")
        kept = kept.filter("_edges IS NULL OR _bin IS NULL OR _bin <= _hi")
        kept = kept.withColumn("_v", F.when(F.col("_bin").isNull() | (F.col("_bin") >= F.col("_lo")), F.col("_v")))
        tallied = kept.groupBy(*by, "_n", "_v").agg(F.sum("_c").alias("_c"))


def quantiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    probs: Sequence[float] = RISK_PROBS,
    accuracy: int = 10_000,
    most: int = BRACKET_VALUES,
) -> DataFrame:
    """Exact linear-interpolated quantiles, one row per (by, prob).

    The built-in exact percentile holds every distinct value of a group in one
    buffer.  Here a mergeable sketch first brackets each wanted rank; one more
    pass counts the values below the bracket and tallies those inside.  A bracket
    holds about ``6 / accuracy`` of its group (all of it below 4*accuracy rows).
    Brackets that may have more than ``most`` distinct values are refined by
    histograms, so that no task sorts more, whatever the size of a group.
    """
    keys = list(by) or ["_all"]
    if not by:
        df = df.withColumn("_all", F.lit(0))
    data = df.select(*keys, F.col(value).cast("double").alias("_v")).filter("_v IS NOT NULL")
    pad = 2.0 / accuracy
    grid = [x for p in probs for x in (max(p - pad, 0.0), min(p + pad, 1.0))]
    # The sketch is read twice below, so it is written once.
    sketch = materialize(
        data.groupBy(*keys).agg(
            F.count("*").alias("_n"),
            F.percentile_approx("_v", grid, accuracy).alias("_grid"),
        )
    )
    whole = F.col("_n") < 4 * accuracy
    brackets = sketch.select(
        *keys,
        "_n",
        F.array(
            *[
                F.struct(
                    F.lit(float(p)).alias("prob"),
                    F.when(~whole, F.col("_grid")[2 * i]).alias("lo"),
                    F.when(~whole, F.col("_grid")[2 * i + 1]).alias("hi"),
                )
                for i, p in enumerate(probs)
            ]
        ).alias("_b"),
    )
    v = F.col("_v")
    tallied = (
        data.join(bounded_broadcast(brackets), keys)
        .select(*keys, "_n", "_v", F.inline("_b"))
        .filter(F.col("hi").isNull() | (v <= F.col("hi")))
        # below the bracket only the count matters: those rows share the NULL value
        .withColumn("_v", F.when(F.col("lo").isNull() | (v >= F.col("lo")), v))
        .groupBy(*keys, "prob", "_n", "_v")
        .agg(F.count("*").alias("_c"))
    )
    largest = sketch.agg(F.max("_n")).first()[0] or 0
    if min(largest, max(4 * accuracy, largest * 6 / accuracy)) > most:
        tallied = _refined(tallied, [*keys, "prob"], most)
    w = Window.partitionBy(*keys, "prob").orderBy(F.col("_v").asc_nulls_first())
    position = _position()
    rank = F.floor(position)
    picked = (
        tallied.withColumn("_cum", F.sum("_c").over(w)).groupBy(*keys, "prob", "_n").agg(*_at_ranks("_v"))
    )
    return picked.select(
        *by,
        "prob",
        (F.col("_lo") + (position - rank) * (F.col("_hi") - F.col("_lo"))).alias("quantile"),
    )


def cvar(df: DataFrame, by: Sequence[str], value: str, prob: float = 0.99) -> DataFrame:
    """Mean of the values at or above the exact ``prob`` quantile."""
    keys = list(by) or ["_all"]
    q = quantiles(df, by, value, [prob])
    if not by:
        df, q = df.withColumn("_all", F.lit(0)), q.withColumn("_all", F.lit(0))
    at = bounded_broadcast(materialize(q.select(*keys, F.col("quantile").alias("_q"))))
    return (
        df.join(at, keys)
        .groupBy(*keys)
        .agg(
            F.first("_q").alias("var"),
            F.avg(F.when(F.col(value) >= F.col("_q"), F.col(value))).alias("cvar"),
        )
        .select(*by, "var", "cvar")
    )


def correlation(a: str, b: str) -> Column:
    """Pearson correlation over complete pairs; NULL when one side does not vary.

    The built-in ``corr`` divides by zero there and fails under ANSI mode.
    """
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    va, vb = (F.var_pop(F.when(both, F.col(c))) for c in (a, b))
    return F.when((va > 0) & (vb > 0), F.covar_pop(a, b) / F.sqrt(va * vb))


def sorted_quantile(values: Column, prob: float) -> Column:
    """Linear-interpolated quantile of a sorted array column."""
    position = F.lit(float(prob)) * (F.size(values) - 1)
    low = F.floor(position).cast("int")
    lo = F.element_at(values, low + 1)
    hi = F.element_at(values, F.least(low + 2, F.size(values)))
    return lo + (position - low) * (hi - lo)


def tail_mean(values: Column, prob: float) -> Column:
    """Mean of the elements at or above the ``prob`` quantile of a sorted array.

    The tail starts at the quantile's first occurrence, or right after the rank it was
    interpolated from; only the tail is folded.
    """
    low = F.floor(F.lit(float(prob)) * (F.size(values) - 1)).cast("int")
    found = F.array_position(values, sorted_quantile(values, prob)).cast("int")
    tail = F.slice(values, F.when(found > 0, found).otherwise(low + 2), F.size(values))
    return F.aggregate(tail, F.lit(0.0), lambda a, x: a + x) / F.size(tail)

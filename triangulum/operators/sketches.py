"""Stored quantile sketches: one per key, merged over any set of keys, with their rank error measured.

A sketch has a bounded size whatever number of values it has seen, so a table of sketches
per month answers quantiles over any range of months without the values.  The exact
counterpart is ``quantiles.quantiles``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .skew import bounded_broadcast

# Values that the lowest level of a sketch keeps; error and size follow from it.
SKETCH_K = 400


def sketch(value: Column, k: int = SKETCH_K) -> Column:
    """Aggregate: the sketch of the values, nulls passed over."""
    return F.kll_sketch_agg_double(value.cast("double"), F.lit(k))


def merged(sketches: Column | str, k: int = SKETCH_K) -> Column:
    """Aggregate: the sketch of all values that the sketches have seen."""
    return F.kll_merge_agg_double(sketches, F.lit(k))


def rank_error(k: int = SKETCH_K) -> float:
    """Distance in rank, as a share of the values, that one estimate keeps to with probability 0.99."""
    # The published fit of the sketch's error.
    return 2.296 / k**0.9021


def merged_quantiles(table: DataFrame, by: Sequence[str], column: str, probs: Sequence[float], k: int = SKETCH_K) -> DataFrame:
    """by, prob, values (seen) and estimate, from the sketches of each group; groups without a value give no row."""
    one = table.groupBy(*by).agg(merged(F.col(column), k).alias("_sketch"))
    seen = one.withColumn("values", F.kll_sketch_get_n_double("_sketch")).filter("values > 0")
    rows = F.array(*[
        F.struct(F.lit(float(p)).alias("prob"), F.kll_sketch_get_quantile_double("_sketch", F.lit(float(p))).alias("estimate"))
        for p in probs
    ])
    return seen.select(*by, "values", F.inline(rows))


def measured(df: DataFrame, by: Sequence[str], value: str, estimates: DataFrame) -> DataFrame:
    """``estimates`` (by, prob, estimate) with rank_error: how far the estimate is from its rank in ``df``.

    An estimate covers the ranks of all rows equal to it; the error is 0 when the wanted one
    is among them.  Rows are counted where they lie, one count per estimate is shuffled.
    """
    v = F.col(value).cast("double")
    rows = df.filter(v.isNotNull()).select(*by, v.alias("_v")).join(bounded_broadcast(estimates), list(by))
    counts = rows.groupBy(*by, "prob", "estimate").agg(
        F.count("*").alias("_n"), F.count_if(F.col("_v") < F.col("estimate")).alias("_below"),
        F.count_if(F.col("_v") <= F.col("estimate")).alias("_up_to"),
    )
    off = F.greatest(F.col("_below") / F.col("_n") - F.col("prob"), F.col("prob") - F.col("_up_to") / F.col("_n"), F.lit(0.0))
    return counts.select(*by, "prob", "estimate", off.alias("rank_error"))

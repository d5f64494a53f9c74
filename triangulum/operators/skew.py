"""Neighbour look-ups (lag/lead) that stay balanced when one key is hot.

A plain ``lag`` over ``partitionBy(key)`` sends a whole key to one task.  Here
the few keys with more than ``max_rows`` rows are cut into consecutive slices of
their order column; each slice is windowed on its own and only one edge row per
slice crosses over.  The result equals the plain window.

Size bounds: at most ``rows / max_rows`` keys can be hot, and their slices
number at most ``2 * rows / max_rows``; only those two tables are broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

MAX_ROWS_PER_TASK = 5_000_000
SAMPLES_PER_SLICE = 64
BROADCAST_ROWS = 200_000


def hot_keys(df: DataFrame, keys: Sequence[str], max_rows: int) -> DataFrame:
    """Keys holding more than ``max_rows`` rows, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > max_rows)


def find_hot(df: DataFrame, keys: Sequence[str], max_rows: int | None) -> DataFrame | None:
    """The hot keys as a written table, or None when there are none.

    Counts the key columns only (map-side combined), so ``df`` should be the plain
    input: an upper bound of what later steps keep is good enough.  None for
    ``max_rows`` says the caller knows every key is small, and skips the count.
    """
    if max_rows is None:
        return None
    hot = materialize(hot_keys(df, keys, max_rows), "hot")
    return None if hot.isEmpty() else hot


def bounded_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast ``df`` only after counting that it is small; else leave the join to Spark."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def slice_hot_keys(
    df: DataFrame, keys: Sequence[str], order: str, max_rows: int, hot: DataFrame
) -> DataFrame:
    """Add ``_slice`` (0 for ordinary keys) and ``_hot``.

    Slice borders are order values of a hashed row sample, so any orderable type
    works and a retried task picks the same borders.
    """
    wanted = F.ceil(F.col("_n") / F.lit(max_rows)) * F.lit(SAMPLES_PER_SLICE)
    borders = (
        df.select(*keys, order)
        .join(F.broadcast(hot), list(keys))
        .filter(F.pmod(F.xxhash64(*keys, order), F.col("_n")) < wanted)
        .groupBy(*keys)
        .agg(
            F.array_sort(F.collect_set(order)).alias("_sample"),
            F.max(F.ceil(F.col("_n") / F.lit(max_rows))).alias("_parts"),
        )
        .select(
            *keys,
            F.transform(
                F.sequence(F.lit(1), F.greatest(F.col("_parts") - 1, F.lit(1))),
                lambda i: F.get(
                    F.col("_sample"),
                    F.floor(F.size("_sample") * i / F.col("_parts")).cast("int"),
                ),
            ).alias("_borders"),
        )
    )
    return (
        df.join(bounded_broadcast(borders), list(keys), "left")
        .withColumns(
            {
                "_hot": F.col("_borders").isNotNull(),
                "_slice": F.coalesce(
                    F.size(F.filter("_borders", lambda b: b <= F.col(order))), F.lit(0)
                ),
            }
        )
        .drop("_borders")
    )


def with_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    columns: dict[str, tuple[Column, int]],
    hot: DataFrame | None = None,
    max_rows: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """Add ``{name: (value, step)}``: the value one row back (step -1) or ahead (+1).

    (keys, order) must be unique.  ``hot`` comes from ``find_hot``; without hot keys
    one plain window does it.
    """
    if hot is None:
        w = Window.partitionBy(*keys).orderBy(order)
        return df.withColumns({n: F.lag(v, -s).over(w) for n, (v, s) in columns.items()})

    sliced = slice_hot_keys(df, keys, order, max_rows, hot)
    within = Window.partitionBy(*keys, "_slice").orderBy(order)
    # wrap the value so a NULL value differs from "no neighbour in this slice"
    out = sliced.withColumns(
        {f"_in_{n}": F.lag(F.struct(v.alias("v")), -s).over(within) for n, (v, s) in columns.items()}
    )
    across = Window.partitionBy(*keys).orderBy("_slice")
    ends = (
        sliced.filter("_hot")
        .groupBy(*keys, "_slice")
        .agg(
            *[
                (F.max_by if s < 0 else F.min_by)(F.struct(v.alias("v")), F.col(order)).alias(f"_end_{n}")
                for n, (v, s) in columns.items()
            ]
        )
        .select(
            *keys,
            "_slice",
            *[F.lag(f"_end_{n}", -s).over(across).alias(f"_edge_{n}") for n, (_, s) in columns.items()],
        )
    )
    out = out.join(bounded_broadcast(ends), [*keys, "_slice"], "left")
    return out.select(
        *df.columns,
        *[F.coalesce(f"_in_{n}", f"_edge_{n}")["v"].alias(n) for n in columns],
    )

"""Change events to type-2 history and to latest rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .skew import MAX_ROWS_PER_TASK, find_hot, with_neighbours

START, END = "start_at", "end_at"


def last_event(df: DataFrame, keys: Sequence[str], sequence_by: str, tie_break: str | None = None) -> DataFrame:
    """One row per (keys, sequence): of equal sequences the highest tie-break wins, or
    the greatest row when there is none, so every run keeps the same one.

    The aggregate combines on the map side: a hot key does not travel whole.
    """
    rest = [c for c in df.columns if c not in (*keys, sequence_by)]
    if not rest:
        return df.distinct()
    row = F.struct(*rest)
    kept = F.max_by(row, tie_break) if tie_break else F.max(row)
    return (
        df.groupBy(*keys, sequence_by)
        .agg(kept.alias("_row"))
        .select(*[F.col(c) if c in (*keys, sequence_by) else F.col(f"_row.{c}") for c in df.columns])
    )


def mark_versions(
    df: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    track_columns: Sequence[str] | None,
    hot: DataFrame | None = None,
    max_rows: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """Add ``is_version``: false where no tracked column differs from the row before it.

    With ``track_columns`` None every event is a version.
    """
    if track_columns is None:
        return df.withColumn("is_version", F.lit(True))
    tracked = F.struct(*track_columns)
    marked = with_neighbours(df, keys, sequence_by, {"_before": (tracked, -1)}, hot, max_rows)
    return marked.withColumn("is_version", ~F.col("_before").eqNullSafe(tracked)).drop("_before")


def close_versions(
    marked: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    columns: Sequence[str] | None = None,
    hot: DataFrame | None = None,
    max_rows: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """Interval ends for rows already marked by ``mark_versions``."""
    kept = marked.filter("is_version").drop("is_version")
    closed = with_neighbours(kept, keys, sequence_by, {END: (F.col(sequence_by), 1)}, hot, max_rows)
    wanted = list(columns) if columns is not None else kept.columns
    return closed.select(*wanted, F.col(sequence_by).alias(START), END)


def scd2_batch(
    events: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    track_columns: Sequence[str] | None = None,
    tie_break: str | None = None,
    columns: Sequence[str] | None = None,
    max_rows: int | None = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """Versions per key ordered by ``sequence_by``: [start_at, end_at), the last one open.

    Keys with more than ``max_rows`` events are windowed in slices; None skips the
    count for keys known to be small.
    """
    hot = find_hot(events, keys, max_rows)
    limit = max_rows or MAX_ROWS_PER_TASK
    rows = last_event(events, keys, sequence_by, tie_break)
    rows = mark_versions(rows, keys, sequence_by, track_columns, hot, limit)
    return close_versions(rows, keys, sequence_by, columns, hot, limit)


def current_versions(history: DataFrame) -> DataFrame:
    return history.filter(F.col(END).isNull()).drop(START, END)


def scd1_latest(
    events: DataFrame, keys: Sequence[str], sequence_by: str | Column, tie_break: str | None = None
) -> DataFrame:
    """Latest row per key without building the history (map-side combined).

    Of equal sequences the highest tie-break wins, or the greatest row when there is none.
    """
    seq = F.col(sequence_by) if isinstance(sequence_by, str) else sequence_by
    rest = [c for c in events.columns if c not in keys]
    order = F.struct(seq, F.col(tie_break) if tie_break else F.struct(*rest))
    return (
        events.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), order).alias("_row"))
        .select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in events.columns])
    )

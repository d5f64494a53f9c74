"""Streaming bronze tables and incremental type-2 history."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.quality import expect, expect_or_drop
from ..operators.scd2 import END, START, close_versions, last_event, mark_versions
from ..operators.skew import MAX_ROWS_PER_TASK, find_hot
from .stores import BUCKET_ROWS, KeyedStore


def stream_scan(
    spark: SparkSession, path: str, schema: T.StructType | str, max_files: int | None = None
) -> DataFrame:
    """Append-only stream over the parquet files of a landing folder."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def bronze_stream(
    source: DataFrame,
    target: str,
    checkpoint: str,
    drop_rules: Mapping[str, Column | str],
    warn_rules: Mapping[str, Column | str] | None = None,
) -> StreamingQuery:
    """Append rows that pass the drop rules; stops once all available input is read.

    Warn-only failures are observed per batch and appear in the query progress.
    A full refresh is the same call with a new target and a new checkpoint.
    """
    rows = expect_or_drop(source, drop_rules)
    if warn_rules:
        rows = expect(rows, warn_rules)
    query = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
    query.awaitTermination()
    return query


class HistoryTable(KeyedStore):
    """Type-2 history in parquet: the events and versions of every key, in extendible-hash buckets.

    A merge writes the whole history of the keys in its batch, and of no others, as a
    version of its own; readers take every key from its newest version.  Versions are
    numbered by the table, not by the stream, so streams may restart with new checkpoints
    and several may feed one table, one after the other.  Events are a set: merging a batch
    again changes nothing.  All events are kept, also those that are no version: a late
    event can turn them into one.  Buckets split as they fill, each on its own; ``compact``
    folds versions and ``vacuum`` removes files that no reader needs any more.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        sequence_by: str,
        track_columns: Sequence[str] | None = None,
        tie_break: str | None = None,
        buckets: int = 64,
        bucket_rows: int = BUCKET_ROWS,
    ) -> None:
        super().__init__(spark, path, keys, buckets, bucket_rows)
        self.sequence_by, self.track_columns, self.tie_break = sequence_by, track_columns, tie_break

    def merge(self, batch: DataFrame) -> None:
        """Fold a batch of change events into the history; one writer at a time."""
        incoming = last_event(batch, self.keys, self.sequence_by, self.tie_break).persist()
        marked = None
        try:
            manifest = self._manifest()
            touched = self._touched(incoming, manifest)
            if not touched:
                return
            known = self._known(incoming, touched)
            events = incoming
            if known is not None:
                known = known.drop("is_version", START, END)
                events = last_event(known.unionByName(incoming), self.keys, self.sequence_by, self.tie_break)
            hot = find_hot(events, self.keys, MAX_ROWS_PER_TASK)
            marked = mark_versions(events, self.keys, self.sequence_by, self.track_columns, hot).persist()
            versions = close_versions(marked, self.keys, self.sequence_by, hot=hot).withColumn(
                "is_version", F.lit(True)
            )
            rows = versions.unionByName(marked.filter(~F.col("is_version")), allowMissingColumns=True)
            self._append(rows, manifest)
        finally:
            incoming.unpersist()
            if marked is not None:
                marked.unpersist()

    def history(self) -> DataFrame:
        """All versions with their intervals."""
        return self.rows().filter("is_version").drop("is_version")

    def current(self) -> DataFrame:
        return self.history().filter(F.col(END).isNull()).drop(START, END)


def scd2_stream(
    source: DataFrame,
    table: HistoryTable,
    checkpoint: str,
    after: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Merge every available micro-batch into the history table.

    Events are ordered by their sequence column, never by arrival, so late and
    re-ordered input gives the same history.  ``after`` runs once per batch, e.g. to
    recompute the tables derived from the history.
    """

    def fold(batch: DataFrame, batch_id: int) -> None:
        table.merge(batch)
        if after is not None:
            after(batch_id)

    query = (
        source.writeStream.foreachBatch(fold)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query

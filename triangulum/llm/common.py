"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, scratch_path

__all__ = ["blocks_of", "few_files", "materialize", "read", "rows_of", "scratch_path", "text_of", "with_row_number"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Rows that a task may write of tables of keys, marks and sketches.
FILE_ROWS = 50_000


def few_files(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of ``rows`` rows at most, in as many partitions as these and the cores ask for, if it has more.

    A small table is else written as a file from every shuffle partition, and each file costs a task and
    several calls to the file system.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // FILE_ROWS)))


def text_of(column: str = "text") -> Column:
    """The text, a null one as the empty string."""
    return F.coalesce(F.col(column), F.lit(""))


def with_row_number(df: DataFrame, name: str = "_row") -> DataFrame:
    """A unique number per row, the same in every retry of a task that reads files.

    It only breaks ties between rows that are equal in everything an operator looks at.
    """
    return df.withColumn(name, F.monotonically_increasing_id())


def rows_of(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches cut small, so that a task holds few results beside its input."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def blocks_of(batches: Iterator[pa.RecordBatch], column: str, most: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut where the strings of ``column`` reach ``most`` bytes; a longer one is a block of its own."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy().astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            end = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(at, end - at)
            at = end

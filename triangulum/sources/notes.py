"""Analyst notes: an append-only table and its latest entries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

NOTE_SCHEMA = T.StructType(
    [
        T.StructField("segment_id", T.StringType(), False),
        T.StructField("note", T.StringType()),
        T.StructField("analyst", T.StringType()),
        T.StructField("scenario_type", T.StringType()),
        T.StructField("adjustment_pct", T.DecimalType(10, 2)),
        T.StructField("approval_status", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)


def annotate(spark: SparkSession, target: str, notes: DataFrame) -> None:
    """Append notes; status defaults to Draft and the time to now, empty type to NULL."""
    missing = [f for f in NOTE_SCHEMA.fields if f.name not in notes.columns]
    full = notes.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
    full.select(
        "segment_id",
        "note",
        "analyst",
        F.nullif(F.col("scenario_type"), F.lit("")).alias("scenario_type"),
        F.col("adjustment_pct").cast("decimal(10,2)").alias("adjustment_pct"),
        F.coalesce(F.nullif(F.col("approval_status"), F.lit("")), F.lit("Draft")).alias("approval_status"),
        F.coalesce("created_at", F.current_timestamp()).alias("created_at"),
    ).write.mode("append").parquet(target)


def recent_annotations(
    notes: DataFrame, segment_id: str | None = None, limit: int = 20, tie_break: str | None = None
) -> DataFrame:
    """Newest notes, of one segment or of all together (a top-k, no full sort)."""
    df = notes if segment_id is None else notes.filter(F.col("segment_id") == segment_id)
    order = [F.col("created_at").desc()] + ([F.col(tie_break).desc()] if tie_break else [])
    return df.orderBy(*order).limit(limit)


def recent_per_segment(notes: DataFrame, limit: int = 20, tie_break: str | None = None) -> DataFrame:
    """Newest notes of every segment.

    The rank filter is applied per map task first, so a hot segment ships at most
    ``limit`` rows per task.
    """
    order = [F.col("created_at").desc()] + ([F.col(tie_break).desc()] if tie_break else [])
    w = Window.partitionBy("segment_id").orderBy(*order)
    return notes.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= limit).drop("_rn")

"""Table reads, writes, catalog calls and guarded SQL."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Landing schema of the macro flow.
MACRO_RAW_SCHEMA = T.StructType(
    [
        T.StructField("source_table", T.StringType(), False),
        T.StructField("province", T.StringType(), False),
        T.StructField("ref_date", T.StringType(), False),
        T.StructField("indicator_name", T.StringType(), False),
        T.StructField("value", T.DoubleType(), True),
        T.StructField("unit", T.StringType(), True),
        T.StructField("ingested_at", T.StringType(), False),
        T.StructField("batch_id", T.StringType(), False),
    ]
)


def scan(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table, or a parquet path when the name holds a slash."""
    return spark.read.parquet(name_or_path) if "/" in name_or_path else spark.table(name_or_path)


def overwrite(df: DataFrame, target: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the target, schema included."""
    writer = df.write.mode("overwrite").partitionBy(*partition_by)
    writer.parquet(target) if "/" in target else writer.format("parquet").saveAsTable(target)


def append_batch(df: DataFrame, target: str, batch_id: str) -> None:
    """Append rows tagged with their batch and ingestion time."""
    tagged = df.withColumns(
        {"ingested_at": F.current_timestamp().cast("string"), "batch_id": F.lit(batch_id)}
    )
    if "/" in target:
        tagged.write.mode("append").parquet(target)
    else:
        # by name: the table's column order decides
        columns = df.sparkSession.table(target).columns
        tagged.select(*columns).write.mode("append").format("parquet").saveAsTable(target)


def ensure_landing(spark: SparkSession, name: str, schema: T.StructType = MACRO_RAW_SCHEMA) -> bool:
    """Create an empty table when absent; True when it was created."""
    if spark.catalog.tableExists(name):
        return False
    spark.createDataFrame([], schema).write.format("parquet").saveAsTable(name)
    return True


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def describe_tables(spark: SparkSession, comments: Mapping[str, tuple[str, Mapping[str, str]]]) -> dict[str, int]:
    """Set table and column comments; absent tables and columns are skipped.

    Returns the number of column comments set per table that exists.
    """
    done: dict[str, int] = {}
    for name, (table_comment, columns) in comments.items():
        if not spark.catalog.tableExists(name):
            continue
        spark.sql(f"COMMENT ON TABLE {name} IS {_quoted(table_comment)}")
        present = set(spark.table(name).columns)
        known = {c: t for c, t in columns.items() if c in present}
        for column, text in known.items():
            spark.sql(f"ALTER TABLE {name} ALTER COLUMN `{column}` COMMENT {_quoted(text)}")
        done[name] = len(known)
    return done


def list_tables(spark: SparkSession, pattern: str = "*", schema: str | None = None) -> DataFrame:
    where = f" IN {schema}" if schema else ""
    return spark.sql(f"SHOW TABLES{where} LIKE {_quoted(pattern)}")


def register_views(frames: Mapping[str, DataFrame]) -> None:
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


_LITERALS = re.compile(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|--[^\n]*|/\*.*?\*/", re.S)
_WRITES = re.compile(
    r"\b(insert|update|delete|merge|create|drop|alter|truncate|replace\s+table|load|set|use|cache|refresh|call|grant|revoke)\b",
    re.I,
)


_CALLS = re.compile(r"\b(?:try_)?(?:reflect|java_method)\(", re.I)


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _check_relations(spark: SparkSession, plan, known: frozenset[str]) -> None:
    """Raise unless every relation of a parsed plan is a view of this session or a name that WITH gives there."""
    kind = plan.getClass().getSimpleName()
    if kind == "UnresolvedWith":
        for relation in _items(plan.cteRelations()):
            _check_relations(spark, relation._2(), known)
            known |= {relation._1().lower()}
        below = [plan.child()]
    else:
        below = [*_items(plan.children()), *_items(plan.subqueries())]
    if kind == "UnresolvedRelation":
        parts = _items(plan.multipartIdentifier())
        if len(parts) != 1 or parts[0].lower() not in known:
            raise ValueError(f"not a registered view: {'.'.join(parts)}")
    elif "TableValuedFunction" in kind or kind.endswith(("Command", "Statement")):
        raise ValueError(f"not allowed in a query: {kind}")
    for child in below:
        _check_relations(spark, child, known)


def query_readonly(spark: SparkSession, sql: str, limit: int = 50) -> DataFrame:
    """First rows of one SELECT (or WITH ... SELECT) over the registered views.

    The parsed plan may read temporary views and names given by WITH, in their scope, and
    nothing else: files, catalog tables, table functions and calls into Java are refused.
    """
    bare = _LITERALS.sub(" ", sql).strip()
    if not re.match(r"(select|with)\b", bare, re.I) or ";" in bare or _WRITES.search(bare):
        raise ValueError("only a single SELECT query is allowed")
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    if _CALLS.search(plan.toString()):
        raise ValueError("calls into Java are not allowed")
    views = frozenset(t.name.lower() for t in spark.catalog.listTables() if t.isTemporary)
    _check_relations(spark, plan, views)
    return spark.sql(sql).limit(limit)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)

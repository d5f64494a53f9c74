"""The three medallion flows, as batch plans and as one streaming update."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from ..operators import features, gold
from ..operators.quality import expect_or_drop
from ..operators.scd2 import current_versions, scd2_batch
from ..operators.skew import MAX_ROWS_PER_TASK
from ..sources.snapshots import Snapshots
from ..streaming.flows import HistoryTable, bronze_stream, scd2_stream, stream_scan
from ..streaming.stores import PartialTable, partial_stream

# Lines of business and the row rules of the three bronze tables.
PRODUCT_LINES = ("Personal_Auto", "Commercial_Auto", "Homeowners", "Commercial_Property")
RESERVE_KEYS = ("segment_id", "accident_month", "dev_lag")
RESERVE_COLUMNS = (
    "segment_id",
    "product_line",
    "region",
    "accident_month",
    "development_month",
    "dev_lag",
    "cumulative_paid",
    "cumulative_incurred",
    "case_reserve",
)
MACRO_KEYS = ("province", "ref_date", "indicator_name")
RESERVE_WARNINGS = {"valid_dev_lag": "dev_lag BETWEEN 1 AND 120"}


def _one_of(column: str, values: Sequence[str]) -> str:
    quoted = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"{column} IN ({quoted})"


def reserve_rules(lines: Sequence[str] = PRODUCT_LINES) -> dict[str, str]:
    return {
        "valid_paid": "cumulative_paid >= 0",
        "valid_incurred": "cumulative_incurred >= 0",
        "valid_reserve": "case_reserve >= 0",
        "valid_product": _one_of("product_line", lines),
    }


def claims_rules(lines: Sequence[str] = PRODUCT_LINES) -> dict[str, str]:
    return {"valid_amount": "claim_amount >= 0", "valid_product": _one_of("product_line", lines)}


def macro_rules(indicators: Sequence[str] = gold.INDICATORS) -> dict[str, str]:
    return {"valid_value": "value IS NOT NULL", "valid_indicator": _one_of("indicator_name", indicators)}


def gold_claims(raw: DataFrame, lines: Sequence[str] = PRODUCT_LINES) -> DataFrame:
    return gold.claims_monthly(expect_or_drop(raw, claims_rules(lines)))


def segment_features(monthly: DataFrame) -> DataFrame:
    return features.feature_table(gold.rolling_features(monthly))


def silver_reserves(
    raw: DataFrame, lines: Sequence[str] = PRODUCT_LINES, max_rows: int | None = MAX_ROWS_PER_TASK
) -> DataFrame:
    """Type-2 reserve history.  A key is one triangle cell, so its rows are its revisions."""
    return scd2_batch(
        expect_or_drop(raw, reserve_rules(lines)),
        RESERVE_KEYS,
        "development_month",
        columns=RESERVE_COLUMNS,
        max_rows=max_rows,
    )


def gold_triangle(raw: DataFrame, lines: Sequence[str] = PRODUCT_LINES) -> DataFrame:
    return gold.reserve_triangle(current_versions(silver_reserves(raw, lines)))


def silver_macro(raw: DataFrame, indicators: Sequence[str] = gold.INDICATORS, track=("value",)) -> DataFrame:
    return scd2_batch(expect_or_drop(raw, macro_rules(indicators)), MACRO_KEYS, "ingested_at", track)


def gold_macro(raw: DataFrame, province_map: Mapping[str, str], month: Column | None = None) -> DataFrame:
    return gold.macro_features(current_versions(silver_macro(raw)), province_map, month)


def claims_partials(spark: SparkSession, path: str, buckets: int = 16) -> PartialTable:
    return PartialTable(spark, path, gold.claim_keys(), gold.CLAIM_PARTIALS, buckets=buckets)


def histories(spark: SparkSession, base: str, buckets: int = 64) -> dict[str, HistoryTable]:
    """The history tables of one refresh."""
    return {
        "reserves": HistoryTable(
            spark, f"{base}/silver_reserves", RESERVE_KEYS, "development_month", buckets=buckets
        ),
        "macro": HistoryTable(spark, f"{base}/silver_macro", MACRO_KEYS, "ingested_at", ("value",), buckets=buckets),
    }


def run_update(
    spark: SparkSession,
    landing: Mapping[str, DataFrame | str],
    out: str,
    province_map: Mapping[str, str],
    lines: Sequence[str] = PRODUCT_LINES,
    month: Column | None = None,
    refresh: str = "current",
    buckets: int = 64,
) -> dict[str, str]:
    """Landing folders (claims, reserves, macro) to bronze, silver and gold tables.

    Every call reads only input it has not seen: histories and the partials of the monthly
    claims take the new files' keys alone.  What is derived from the monthly table and from
    current versions, both bounded by segments and months, is computed again.  The gold
    tables of a call are published at once (``Snapshots``), and the paths returned stay
    readable until a vacuum.  Another ``refresh`` name is a full refresh: new targets and
    new checkpoints next to the old ones.  Folding versions is left to ``maintain``.
    """
    base = f"{out.rstrip('/')}/{refresh}"
    state = f"{base}/_checkpoints"
    rules = {"claims": claims_rules(lines), "reserves": reserve_rules(lines), "macro": macro_rules()}
    paths = {name: f"{base}/bronze_{name}" for name in rules}
    for name, rule in rules.items():
        schema = spark.read.parquet(str(landing[name])).schema
        bronze_stream(
            stream_scan(spark, str(landing[name]), schema),
            paths[name],
            f"{state}/bronze_{name}",
            rule,
            RESERVE_WARNINGS if name == "reserves" else None,
        )
    history = histories(spark, base, buckets)
    for name, table in history.items():
        schema = spark.read.parquet(paths[name]).schema
        scd2_stream(stream_scan(spark, paths[name], schema), table, f"{state}/silver_{name}")
    partials = claims_partials(spark, f"{base}/claims_partials", min(buckets, 16))
    schema = spark.read.parquet(paths["claims"]).schema
    partial_stream(stream_scan(spark, paths["claims"], schema), partials, f"{state}/claims_partials")
    monthly = gold.monthly_of_partials(partials.rows())
    published = Snapshots(spark, f"{base}/gold")
    published.publish(
        {
            "gold_claims_monthly": monthly,
            "silver_rolling_features": gold.rolling_features(monthly),
            "features_segment_monthly": segment_features(monthly),
            "gold_reserve_triangle": gold.reserve_triangle(history["reserves"].current()),
            "gold_macro_features": gold.macro_features(history["macro"].current(), province_map, month),
        }
    )
    return published.paths()


def maintain(spark: SparkSession, out: str, refresh: str = "current", buckets: int = 64, keep: int = 2) -> None:
    """Fold versions and remove what no reader needs; between updates, with no reader of old publications at work."""
    base = f"{out.rstrip('/')}/{refresh}"
    for table in (*histories(spark, base, buckets).values(), claims_partials(spark, f"{base}/claims_partials", min(buckets, 16))):
        table.compact()
        table.vacuum()
    Snapshots(spark, f"{base}/gold").vacuum(keep)

"""The given star-schema tables read as claims, reserves, macro and observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import fixed, segment_key

PROVINCES = 13

# Event types read as macro indicators; other types pass unchanged.
INDICATOR_OF_EVENT = {
    "view": "unemployment_rate",
    "click": "hpi_index",
    "purchase": "housing_starts",
}
# The provinces that stand for a sales region; the rest are outside.
REGION_OF_PROVINCE = {
    "P0": "AFRICA",
    "P1": "AMERICA",
    "P2": "ASIA",
    "P3": "EUROPE",
    "P4": "MIDDLE EAST",
}


# The columns read, so opening a table needs no look at its files.
SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _order_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """o_orderkey, o_orderdate, product_line, region."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    buyers = (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", F.col("c_mktsegment").alias("product_line"), F.col("r_name").alias("region"))
    )
    # Joined to line items next, fact to fact: both sides are shuffled and sorted.  Left
    # to its size guess the planner may broadcast the line items, and the join then runs
    # in as few tasks as the orders have files.
    return (
        orders.join(buyers, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", F.to_date("o_orderdate").alias("order_date"), "product_line", "region")
        .hint("merge")
    )


def claims_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_claims_events: one row per line item, money rounded to cents."""
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"
    )
    price = F.col("l_extendedprice")
    return items.join(
        _order_segments(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey")
    ).select(
        "product_line",
        "region",
        F.col("order_date").cast("string").alias("loss_date"),
        fixed(price * (F.lit(1.0) - F.col("l_discount")), 2).alias("claim_amount"),
        fixed(price * (F.lit(1.0) + F.col("l_tax")), 2).alias("monthly_prem_exposure"),
        F.col("l_returnflag").alias("claim_type"),
    )


def _quarter(d: Column) -> Column:
    return F.year(d) * 4 + F.quarter(d)


def reserve_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items, paid and incurred per segment, accident quarter and lag.

    Every line item counts: its accident quarter is that of the earlier of order and ship
    date, its lag the quarters to the later one, plus one.
    """
    items = (
        table(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_extendedprice", "l_discount", "l_shipdate")
        .withColumn("ship_date", F.to_date("l_shipdate"))
    )
    price = F.col("l_extendedprice")
    first, last = F.least("order_date", "ship_date"), F.greatest("order_date", "ship_date")
    return (
        items.join(_order_segments(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            "product_line",
            "region",
            F.trunc(first, "quarter").alias("accident"),
            (_quarter(last) - _quarter(first) + 1).alias("lag"),
            fixed(price, 2).alias("incurred"),
            fixed(price * (F.lit(1.0) - F.col("l_discount")), 2).alias("paid"),
        )
        .groupBy("product_line", "region", "accident", "lag")
        .agg(F.count("*").alias("n_items"), F.sum("paid").alias("paid"), F.sum("incurred").alias("incurred"))
    )


def reserve_development(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_reserve_development: quarterly lags, densified up to the latest quarter seen.

    Only the cells, whose number the calendar and the segments bound, go through the windows.
    """
    cells = reserve_cells(spark, sf_dir).drop("n_items")
    periods = Window.partitionBy("product_line", "region", "accident").orderBy("lag")
    seen = Window.partitionBy()
    start = _quarter(F.col("accident"))
    # A cell's running sums hold until the next cell; the first one also covers the empty lags before it.
    spans = cells.withColumns(
        {
            "paid": F.sum("paid").over(periods),
            "incurred": F.sum("incurred").over(periods),
            "_from": F.when(F.row_number().over(periods) == 1, F.lit(1)).otherwise(F.col("lag")),
            "_next": F.lead("lag").over(periods),
            "_valuation": F.max(start + F.col("lag")).over(seen),
        }
    )
    until = F.coalesce(F.col("_next"), F.col("_valuation") - start + 1) - 1
    reached = F.col("dev_lag") >= F.col("lag")
    dense = spans.withColumn("dev_lag", F.explode(F.sequence("_from", until))).withColumns(
        {m: F.when(reached, F.col(m)).otherwise(F.lit(0.0)) for m in ("paid", "incurred")}
    )
    return dense.select(
        segment_key("product_line", "region").alias("segment_id"),
        "product_line",
        "region",
        F.col("accident").cast("string").alias("accident_month"),
        F.add_months("accident", F.col("dev_lag") * 3).cast("string").alias("development_month"),
        "dev_lag",
        fixed("paid", 2).alias("cumulative_paid"),
        fixed("incurred", 2).alias("cumulative_incurred"),
    ).withColumns(
        {
            "case_reserve": fixed(F.col("cumulative_incurred") - F.col("cumulative_paid"), 2),
            "op": F.when(F.col("dev_lag") == 1, "INSERT").otherwise("UPDATE"),
        }
    )


def macro_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_macro_indicators, daily: several events per key are genuine revisions."""
    ref_date = F.to_date("ts").cast("string")
    known = F.coalesce(*[F.when(F.col("event_type") == k, v) for k, v in INDICATOR_OF_EVENT.items()])
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("P"), (F.col("user_id") % PROVINCES).cast("string")).alias("province"),
        ref_date.alias("ref_date"),
        F.coalesce(known, F.col("event_type")).alias("indicator_name"),
        "value",
        F.col("ts").alias("ingested_at"),
        ref_date.alias("batch_id"),
    )


def claims_month_of_ref_date() -> Column:
    """Daily ref dates of January 2024 laid onto consecutive months from 1996-01."""
    return F.add_months(
        F.lit("1996-01-01").cast("date"), F.datediff(F.to_date("ref_date"), F.lit("2024-01-01").cast("date"))
    )


def observations(spark: SparkSession, sf_dir: str, segments: DataFrame) -> DataFrame:
    """One observation per event, spread over the alphabetical segments.

    ``segments`` holds the distinct segment_id values of the panel.
    """
    ranked = segments.agg(F.array_sort(F.collect_set("segment_id")).alias("_all")).scalar()
    start = F.add_months(F.lit("1996-02-01").cast("date"), (F.col("event_id") % 48).cast("int"))
    events = table(spark, sf_dir, "events")
    return events.select(
        F.col("event_id").alias("observation_id"),
        F.element_at(ranked, (F.col("user_id") % F.size(ranked) + 1).cast("int")).alias("segment_id"),
        F.date_add(start, F.dayofmonth("ts") - 1).cast("timestamp").alias("obs_ts"),
        F.col("value").alias("target_loss_ratio"),
    )

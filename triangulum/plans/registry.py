"""Every registered query: its Spark plan over the given tables and its column spec.

A spec lists the output columns in order; ``name:2`` rounds a double to 2 digits,
``:i`` makes a bigint, ``:d`` a date, ``:t`` a timestamp, plain names stay as they are.
The same spec shapes the check SQL in ``checks``, so both sides agree on names,
types and rounding.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars as sc
from ..operators import chain_ladder as cl
from ..operators import features, forecast, gold, portfolio, quantiles, regression, reports, scd2, sketches
from ..operators import simulate as sim
from ..operators.quality import expect_or_drop, expectation_report
from ..session import materialize, scratch_path
from ..sources import adapters, generators, notes, statistics, tables
from ..sources.snapshots import Snapshots
from ..streaming.flows import HistoryTable, bronze_stream, scd2_stream, stream_scan
from ..streaming.stores import PartialTable, partial_stream
from . import medallion, reserving

# The market segments of the test tables in the roles of the lines.
LINES = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
VALID_LINES = ("AUTOMOBILE", "BUILDING", "HOUSEHOLD", "MACHINERY")
AUTO = ("AUTOMOBILE", "MACHINERY")
QUARTER_TAIL_LAG = 8
HOLDOUT_REGRESSOR = "unemployment_rate"
SEGMENT_OF = {"HOUSEHOLD": "Property", "BUILDING": "Property", "AUTOMOBILE": "Auto", "MACHINERY": "Auto"}
WEIGHTS = {"HOUSEHOLD": 18500.0, "BUILDING": 5200.0, "AUTOMOBILE": 26000.0, "MACHINERY": 10500.0}
CV_DEFAULTS = {"HOUSEHOLD": 0.35, "BUILDING": 0.42, "AUTOMOBILE": 0.28, "MACHINERY": 0.30}
SCORER_LINE = {
    "AUTOMOBILE": "personal_auto",
    "MACHINERY": "commercial_auto",
    "HOUSEHOLD": "homeowners",
    "BUILDING": "commercial_property",
}
RESERVE_FACTORS = {"AUTOMOBILE": 0.05, "MACHINERY": 0.10, "HOUSEHOLD": 0.10, "BUILDING": 0.10}
PREMIUM_FACTORS = {"AUTOMOBILE": 0.12, "MACHINERY": 0.18, "HOUSEHOLD": 0.15}
# Lags of the report matrix: the quarters of the seven years 1995 to 2001; more fail the query.
DIAGONAL_LAGS = tuple(range(1, 29))


CASTS = {"i": "BIGINT", "d": "DATE", "t": "TIMESTAMP_NTZ"}


def tidy(df: DataFrame, spec: str) -> DataFrame:
    """Project to the spec's columns, types and rounding."""
    out = []
    for item in spec.split():
        name, _, kind = item.partition(":")
        if kind in CASTS:
            out.append(f"CAST({name} AS {CASTS[kind]}) AS {name}")
        elif kind:
            out.append(f"{sc.fixed_sql(f'CAST({name} AS DOUBLE)', int(kind))} + 0.0D AS {name}")
        else:
            out.append(name)
    return df.selectExpr(*out)


# --- shared inputs -----------------------------------------------------------------


def _monthly(s: SparkSession, d: str) -> DataFrame:
    return gold.claims_monthly(adapters.claims_events(s, d))


def _written_monthly(s: SparkSession, d: str) -> DataFrame:
    """The monthly table written once, for plans that read it on several branches."""
    return materialize(_monthly(s, d), "monthly")


def _reserves(s: SparkSession, d: str) -> DataFrame:
    return adapters.reserve_development(s, d)


def _model(s: SparkSession, d: str) -> reserving.ChainLadder:
    return reserving.fit(_reserves(s, d))


def _bronze_macro(s: SparkSession, d: str) -> DataFrame:
    return expect_or_drop(adapters.macro_indicators(s, d), medallion.macro_rules())


def _macro_wide(s: SparkSession, d: str) -> DataFrame:
    latest = scd2.scd1_latest(_bronze_macro(s, d), medallion.MACRO_KEYS, "ingested_at")
    return gold.macro_features(latest, adapters.REGION_OF_PROVINCE, adapters.claims_month_of_ref_date())


def _features(s: SparkSession, d: str) -> DataFrame:
    return medallion.segment_features(_monthly(s, d))


def _dealt(feed: DataFrame, parts: int) -> list[DataFrame]:
    """The rows of a feed, written once, dealt to parts by a hash of all columns."""
    once = materialize(feed, "feed")
    part = F.pmod(F.xxhash64(*feed.columns), F.lit(parts))
    return [once.filter(part == turn) for turn in range(parts)]


def _panel(s: SparkSession, d: str) -> DataFrame:
    """Claims with macro and feature columns: the forecast input."""
    monthly = _written_monthly(s, d)
    macro = features.join_macro(monthly, _macro_wide(s, d))
    return features.join_features(macro, medallion.segment_features(monthly))


def _naive(s: SparkSession, d: str) -> DataFrame:
    return forecast.seasonal_naive(_written_monthly(s, d))


def _notes(s: SparkSession, d: str) -> DataFrame:
    """Events as analyst notes."""
    return adapters.table(s, d, "events").select(
        "event_id",
        F.concat(F.lit("S"), (F.col("user_id") % 25).cast("string")).alias("segment_id"),
        F.col("event_type").alias("note"),
        F.concat(F.lit("analyst_"), F.col("user_id").cast("string")).alias("analyst"),
        F.col("ts").alias("created_at"),
    )


def _cvs_of(forecasts: DataFrame) -> DataFrame:
    return reports.cv_by_line(forecasts, F.split("segment_id", "__", 2)[0])


def _line_cvs(s: SparkSession, d: str) -> DataFrame:
    return _cvs_of(_naive(s, d))


def _calibrated(s: SparkSession, d: str) -> DataFrame:
    panel = _written_monthly(s, d)
    naive = forecast.seasonal_naive(panel)
    row = portfolio.calibrate_portfolio(panel, _cvs_of(naive), SEGMENT_OF, CV_DEFAULTS)
    return materialize(row, "portfolio")


def _fitted_parameters(s: SparkSession, d: str) -> DataFrame:
    """One row with the scorer's mean and CV columns, from the chain ladder."""
    vol = _model(s, d).volatility
    cols = []
    for line, role in SCORER_LINE.items():
        mine = F.col("product_line") == line
        cols.append(F.max(F.when(mine, F.col("ibnr_M"))).alias(f"mean_ibnr_{role}_M"))
        cols.append(F.max(F.when(mine, F.col("cv"))).alias(f"cv_{role}"))
    return materialize(vol.agg(*cols).withColumn("portfolio", F.lit("all")), "fitted")


def _requests(s: SparkSession, d: str) -> DataFrame:
    """One scoring request per scenario; one asks for its own CV, one for too few draws."""
    entries = [
        ("r1", "baseline", 5000, None, 1.0, 0.0),
        ("r2", "adverse_development", 5000, None, 1.2, 0.0),
        ("r3", "judicial_inflation", 5000, 0.25, 1.0, 0.0),
        ("r4", "pandemic_tail", 10, None, 1.1, 0.0),
        ("r5", "superimposed_inflation", 5000, None, 1.0, 0.05),
    ]
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("request_id"),
                F.lit(name).alias("scenario"),
                F.lit(n).cast("bigint").alias("n_replications"),
                F.lit(cv).cast("double").alias("cv_homeowners"),
                F.lit(ldf).alias("ldf_multiplier"),
                F.lit(infl).alias("inflation_adj"),
            )
            for i, name, n, cv, ldf, infl in entries
        ]
    )
    fitted = _fitted_parameters(s, d)
    asked = fitted.select("portfolio", F.inline(rows))
    return reports.merge_defaults(asked, fitted, ["portfolio"], sim.SCORER_DEFAULTS)


def _scores(s: SparkSession, d: str) -> DataFrame:
    return materialize(sim.score_scenarios(_requests(s, d)), "scores")


# --- queries -----------------------------------------------------------------------


def q_quality_report(s: SparkSession, d: str) -> DataFrame:
    parts = [
        ("claims", adapters.claims_events(s, d), medallion.claims_rules(VALID_LINES), None),
        ("reserves", _reserves(s, d), medallion.reserve_rules(VALID_LINES), {"valid_dev_lag": "dev_lag BETWEEN 1 AND 12"}),
        ("macro", adapters.macro_indicators(s, d), medallion.macro_rules(), None),
    ]
    reports_ = [
        expectation_report(df, drop, warn).select(F.lit(n).alias("source"), "*") for n, df, drop, warn in parts
    ]
    return reports_[0].unionByName(reports_[1]).unionByName(reports_[2])


def q_scd2_stream(s: SparkSession, d: str) -> DataFrame:
    """The macro feed landed as files, streamed in small batches into bronze and history."""
    base = scratch_path(s, "macro")
    landing = adapters.macro_indicators(s, d)
    # several files, events dealt out by hash: every batch holds early and late events
    landing.repartition(6, "ingested_at").write.parquet(f"{base}/landing")
    bronze_stream(
        stream_scan(s, f"{base}/landing", landing.schema, max_files=2),
        f"{base}/bronze",
        f"{base}/cp_bronze",
        medallion.macro_rules(),
    )
    table = HistoryTable(s, f"{base}/history", medallion.MACRO_KEYS, "ingested_at", ("value",), buckets=8)
    scd2_stream(stream_scan(s, f"{base}/bronze", landing.schema, max_files=4), table, f"{base}/cp_history")
    return table.history()


def _reserve_revisions(s: SparkSession, d: str) -> DataFrame:
    """Every cell as first booked and, a quarter later, restated from incurred to paid."""
    booked = _reserves(s, d)
    later = F.add_months(F.col("development_month").cast("date"), 3).cast("string")
    restated = F.array(
        F.struct(F.col("development_month").alias("at"), F.col("cumulative_incurred").alias("amount")),
        F.struct(later.alias("at"), F.col("cumulative_paid").alias("amount")),
    )
    return booked.withColumn("_r", F.explode(restated)).withColumns(
        {
            "development_month": F.col("_r.at"),
            "cumulative_incurred": F.col("_r.amount"),
            "case_reserve": sc.fixed(F.col("_r.amount") - F.col("cumulative_paid"), 2),
        }
    ).drop("_r")


def q_scd2_restart(s: SparkSession, d: str) -> DataFrame:
    """The macro feed in two landings, each streamed with a checkpoint of its own into one history."""
    base = scratch_path(s, "restart")
    feed = _bronze_macro(s, d)
    table = HistoryTable(s, f"{base}/history", medallion.MACRO_KEYS, "ingested_at", ("value",), buckets=8)
    for turn in (0, 1):
        # dealt out by hash: the second landing holds events before and after those of the first
        part = feed.filter(F.pmod(F.xxhash64("ingested_at"), F.lit(2)) == turn)
        part.write.parquet(f"{base}/landing{turn}")
        scd2_stream(stream_scan(s, f"{base}/landing{turn}", feed.schema), table, f"{base}/cp{turn}")
    table.compact()
    table.vacuum()
    return table.history()


def q_scd2_growing(s: SparkSession, d: str) -> DataFrame:
    """The macro feed in batches into a history that starts with two buckets and splits them as they fill."""
    base = scratch_path(s, "growing")
    feed = materialize(_bronze_macro(s, d), "feed")
    room = max(1, feed.count() // 12)
    table = HistoryTable(
        s, f"{base}/history", medallion.MACRO_KEYS, "ingested_at", ("value",), buckets=2, bucket_rows=room
    )
    for turn in range(3):
        table.merge(feed.filter(F.pmod(F.xxhash64("ingested_at"), F.lit(3)) == turn))
    return table.history()


def q_delta_monthly(s: SparkSession, d: str) -> DataFrame:
    """Claims landed in three parts; after each the new files' partials are added to the monthly state."""
    base = scratch_path(s, "delta")
    claims = expect_or_drop(adapters.claims_events(s, d), medallion.claims_rules(VALID_LINES))
    table = medallion.claims_partials(s, f"{base}/state", buckets=4)
    for part in _dealt(claims, 3):
        part.write.mode("append").parquet(f"{base}/landing")
        partial_stream(stream_scan(s, f"{base}/landing", claims.schema), table, f"{base}/cp")
    return gold.monthly_of_partials(table.rows()).join(
        table.rows().select("segment_id", "month", "smallest_claim", "largest_claim"), ["segment_id", "month"]
    )


SKETCH_SPANS = {"all": "true", "1995-1996": "month BETWEEN '1995-01' AND '1996-12'"}


def q_sketch_quantiles(s: SparkSession, d: str) -> DataFrame:
    """Claim sizes sketched per line and month in three landings, merged over two spans of months.

    The estimates are measured against all claims of their span; beside the exact quantile
    stands whether the rank error kept to twice its bound, which it misses once in ten million.
    """
    base = scratch_path(s, "sketches")
    # Written once: the landings and every pass over a span read the joined rows again.
    claims = materialize(adapters.claims_events(s, d).withColumn("month", F.substring("loss_date", 1, 7)), "claims")
    table = PartialTable(
        s, f"{base}/state", {"product_line": "product_line", "month": "month"}, {"sizes": ("sketch", "claim_amount")}, buckets=4
    )
    for turn in range(3):
        part = F.pmod(F.xxhash64(*claims.columns), F.lit(3)) == turn
        claims.filter(part).write.mode("append").parquet(f"{base}/landing")
        partial_stream(stream_scan(s, f"{base}/landing", claims.schema), table, f"{base}/cp")
    out = []
    for span, months in SKETCH_SPANS.items():
        found = materialize(
            sketches.merged_quantiles(table.rows().filter(months), ["product_line"], "sizes", quantiles.BAND_PROBS), "estimates"
        )
        rows = claims.filter(months)
        off = sketches.measured(rows, ["product_line"], "claim_amount", found.select("product_line", "prob", "estimate"))
        off = off.withColumn("within_bound", F.col("rank_error") <= 2 * sketches.rank_error())
        exact = quantiles.quantiles(rows, ["product_line"], "claim_amount", quantiles.BAND_PROBS, accuracy=1_000)
        one = found.select("product_line", "prob", "values").join(off.select("product_line", "prob", "within_bound"), ["product_line", "prob"])
        out.append(one.join(exact, ["product_line", "prob"]).withColumn("span", F.lit(span)))
    return out[0].unionByName(out[1])


def q_snapshot_publish(s: SparkSession, d: str) -> DataFrame:
    """Two publications and a failed one between them: the first by its number beside the newest."""
    published = Snapshots(s, scratch_path(s, "published"))
    monthly = _monthly(s, d)
    summary, breakdown = reports.regional_summary(monthly), reports.regional_product_breakdown(monthly)
    first = published.publish({"summary": summary.limit(0), "breakdown": breakdown})
    try:
        published.publish({"summary": summary, "breakdown": breakdown.withColumn("total_claims", F.raise_error(F.lit("stop")))})
    except PySparkException:  # the second output fails; the first must not be seen
        pass
    kept = published.read("summary").count()
    published.publish({"summary": summary})
    pinned = published.read("summary", first).count()
    newest = published.read("summary").withColumns({"seen_after_failure": F.lit(kept), "seen_pinned": F.lit(pinned)})
    lines = published.read("breakdown").groupBy("region").agg(F.count("*").alias("product_lines"))
    return newest.join(lines, "region")


def q_full_refresh(s: SparkSession, d: str) -> DataFrame:
    """An update of part of the feeds, then a full refresh of all beside it; the monthly tables of both."""
    base = scratch_path(s, "refresh")
    feeds = {"claims": adapters.claims_events, "reserves": _reserves, "macro": adapters.macro_indicators}
    landing = {name: f"{base}/{name}" for name in feeds}

    def update(refresh: str) -> DataFrame:
        out = medallion.run_update(
            s, landing, f"{base}/out", adapters.REGION_OF_PROVINCE, VALID_LINES,
            adapters.claims_month_of_ref_date(), refresh, buckets=4,
        )
        return tables.scan(s, out["gold_claims_monthly"]).withColumn("refresh", F.lit(refresh))

    claims = materialize(adapters.claims_events(s, d), "feed")
    for name, read in feeds.items():
        feed = claims.filter(F.col("product_line") != VALID_LINES[0]) if name == "claims" else read(s, d)
        feed.write.parquet(landing[name])
    before = update("current")
    claims.filter(F.col("product_line") == VALID_LINES[0]).write.mode("append").parquet(landing["claims"])
    return before.unionByName(update("full"))


def q_bronze_stream(s: SparkSession, d: str) -> DataFrame:
    base = scratch_path(s, "bronze")
    landing = adapters.macro_indicators(s, d)
    landing.repartition(4, "ingested_at").write.parquet(f"{base}/landing")
    bronze_stream(
        stream_scan(s, f"{base}/landing", landing.schema, max_files=2),
        f"{base}/bronze",
        f"{base}/cp",
        medallion.macro_rules(),
        {"small_value": "value < 50"},
    )
    return s.read.schema(landing.schema).parquet(f"{base}/bronze")


def q_point_in_time(s: SparkSession, d: str) -> DataFrame:
    monthly = _written_monthly(s, d)
    table = medallion.segment_features(monthly)
    cols = ["rolling_3m_mean", "rolling_12m_mean", "coeff_variation_3m", "loss_ratio_trend_3m", "month_of_year"]
    obs = adapters.observations(s, d, monthly.select("segment_id").distinct())
    # one feature row per segment and month
    return features.point_in_time_join(obs, table, "segment_id", "obs_ts", "month_ts", cols, max_rows=None)


def q_readonly_sql(s: SparkSession, d: str) -> DataFrame:
    tables.register_views({"gold_claims_monthly": _monthly(s, d)})
    return tables.query_readonly(
        s,
        "WITH t AS (SELECT product_line, region, SUM(claims_count) AS n FROM gold_claims_monthly"
        " GROUP BY product_line, region) SELECT product_line, region, n AS total_claims FROM t"
        " ORDER BY total_claims DESC, product_line, region",
        20,
    )


def q_statistics(s: SparkSession, d: str) -> DataFrame:
    return statistics.parse_statistics(
        _raw_statistics(s, d),
        "14-10-0287",
        "unemployment_rate",
        "b1",
        [("Type", "view"), ("Absent column", "x")],
        geographies=tuple(f"P{i}" for i in range(10)),
    )


def _raw_statistics(s: SparkSession, d: str) -> DataFrame:
    """Events as a raw statistics table: text values, some suppressed."""
    e = adapters.table(s, d, "events")
    value = F.when(F.col("value") < 2, "x").when(F.col("value") > 40, "F")
    return e.select(
        F.concat(F.lit("P"), (F.col("user_id") % 13).cast("string")).alias("GEO"),
        F.date_format("ts", "yyyy-MM-dd").alias("REF_DATE"),
        F.coalesce(value, F.col("value").cast("string")).alias("VALUE"),
        F.when(F.col("value") > 25, "Index").otherwise("Percent").alias("UOM"),
        F.col("event_type").alias("Type"),
    )


def q_indicator_profile(s: SparkSession, d: str) -> DataFrame:
    return statistics.indicator_profile(adapters.macro_indicators(s, d))


def q_overwrite(s: SparkSession, d: str) -> DataFrame:
    """A table written twice, the second time with other columns, and read back."""
    path = scratch_path(s, "overwrite")
    tables.overwrite(_macro_wide(s, d), path)
    tables.overwrite(reports.regional_summary(_monthly(s, d)), path)
    return tables.scan(s, path)


def q_append(s: SparkSession, d: str) -> DataFrame:
    """The macro feed appended in two batches and read back."""
    path = scratch_path(s, "append")
    feed = adapters.macro_indicators(s, d).drop("ingested_at", "batch_id")
    early = F.col("ref_date") < "2024-01-15"
    tables.append_batch(feed.filter(early), path, "b1")
    tables.append_batch(feed.filter(~early), path, "b2")
    return tables.scan(s, path).filter("ingested_at IS NOT NULL")


def q_csv(s: SparkSession, d: str) -> DataFrame:
    """The regional summary as CSV, read back with its header."""
    path = scratch_path(s, "csv")
    summary = reports.regional_summary(_monthly(s, d))
    tables.export_csv(summary, path)
    return s.read.option("header", True).schema(summary.schema).csv(path)


def q_medallion_update(s: SparkSession, d: str) -> DataFrame:
    """All feeds landed in three parts with an update after each; the segment triangle it ends with."""
    base = scratch_path(s, "update")
    feeds = {"claims": adapters.claims_events, "reserves": _reserves, "macro": adapters.macro_indicators}
    landing = {name: f"{base}/{name}" for name in feeds}
    parts = {name: _dealt(read(s, d), 3) for name, read in feeds.items()}
    out = {}
    for turn in range(3):
        for name, feed in parts.items():
            feed[turn].write.mode("append").parquet(landing[name])
        out = medallion.run_update(
            s, landing, f"{base}/out", adapters.REGION_OF_PROVINCE, VALID_LINES,
            adapters.claims_month_of_ref_date(), buckets=4,
        )
    return tables.scan(s, out["gold_claims_monthly"]).join(
        tables.scan(s, out["gold_reserve_triangle"])
        .groupBy("segment_id")
        .agg(F.count("*").alias("cells"), F.sum("incremental_paid").alias("paid")),
        "segment_id",
    )


def _claims_control(s: SparkSession, d: str) -> DataFrame:
    """Control rows from the monthly panel: as many claims as were seen, spread .5."""
    m = _monthly(s, d)
    s2 = F.ln(F.lit(1.0) + F.lit(0.25))
    return m.select(
        "product_line",
        "region",
        F.col("month").cast("string").alias("loss_date"),
        F.col("claims_count").cast("int").alias("n_claims"),
        (F.ln("avg_severity") - s2 / 2).alias("mu_ln"),
        F.sqrt(s2).alias("sigma_ln"),
        "loss_ratio",
    )


def q_explode_claims(s: SparkSession, d: str) -> DataFrame:
    types = {"AUTOMOBILE": ("A", "B", "C"), "BUILDING": ("D", "E"), "FURNITURE": ("F",),
             "HOUSEHOLD": ("G", "H", "I", "J"), "MACHINERY": ("K", "L")}
    # a small chunk so that the chunking itself is exercised
    return generators.explode_claims(_claims_control(s, d), claim_types=types, chunk=16)


def _development(s: SparkSession, d: str) -> DataFrame:
    """Weibull parameters per line from the mean reporting lag of its triangle."""
    tri = cl.line_triangle(_reserves(s, d))
    first = gold.with_incrementals(tri, ["product_line"], {"inc": "cumulative_paid"})
    return first.groupBy("product_line").agg(
        sc.fixed(F.sum(F.col("inc") * F.col("dev_lag")) / F.sum("inc"), 3).alias("scale"),
        F.lit(1.2).alias("shape"),
        F.max("dev_lag").alias("max_lag"),
    )


def q_weibull_pattern(s: SparkSession, d: str) -> DataFrame:
    return generators.weibull_pattern(_development(s, d), 20)


def q_explode_reserves(s: SparkSession, d: str) -> DataFrame:
    latest = cl.latest_diagonal(
        gold.triangle(_reserves(s, d)), ["segment_id", "product_line", "region", "accident_month"]
    )
    control = latest.join(_development(s, d), "product_line").select(
        "product_line",
        "region",
        "segment_id",
        "accident_month",
        F.col("dev_lag").alias("max_lag"),
        sc.fixed("cumulative_incurred", 2).alias("ultimate"),
        F.lit(0.03).alias("inflation_rate"),
        "scale",
        "shape",
        F.col("max_lag").alias("line_max_lag"),
    )
    return generators.explode_reserves(control, base_year=1995)


def q_seasonal_panel(s: SparkSession, d: str) -> DataFrame:
    segs = _monthly(s, d).groupBy("segment_id", "product_line", "region").agg(
        sc.fixed(F.avg("claims_count"), 4).alias("base")
    )
    return generators.seasonal_panel(segs, months=84)


def q_wide_select(s: SparkSession, d: str) -> DataFrame:
    m = _monthly(s, d).select("segment_id", "month", "claims_count")
    return sc.wide_select(m, {f"col_{i}": F.col("claims_count") * F.lit(float(i)) for i in range(600)})


def q_money_labels(s: SparkSession, d: str) -> DataFrame:
    r = reports.regional_summary(_monthly(s, d))
    incurred_m = F.col("total_incurred") / 1e6
    return r.select(
        "region",
        sc.display_name("region").alias("label"),
        sc.money_label(incurred_m).alias("incurred_label"),
        sc.money_label(incurred_m * 100).alias("scaled_label"),
    )


def q_split_segments(s: SparkSession, d: str) -> DataFrame:
    line, region = sc.split_segment("segment_id")
    return _monthly(s, d).select("segment_id").distinct().select(
        "segment_id", line.alias("product_line"), region.alias("region")
    )


def q_task_quantile_means(s: SparkSession, d: str) -> DataFrame:
    """Per claim type (as task) exact quantiles, averaged per line."""
    claims = adapters.claims_events(s, d).withColumn("ibnr_M", F.col("claim_amount") / 1e3)
    q = quantiles.quantiles(claims, ["product_line", "claim_type"], "ibnr_M", (0.95, 0.99))
    return reports.mean_of_task_metrics(q, ["product_line", "prob"], ["quantile"])


def q_ruin(s: SparkSession, d: str) -> DataFrame:
    """Share of segments whose month ends with incurred above 93 % of premium."""
    m = _monthly(s, d).withColumn("surplus", F.col("earned_premium") * 0.93 - F.col("total_incurred"))
    return sim.ruin_probability(m, ("month",))


def q_combined_risk(s: SparkSession, d: str) -> DataFrame:
    risk = materialize(
        reports.ldf_volatility_risk(
            _model(s, d).volatility, reports.outstanding_reserves(gold.triangle(_reserves(s, d)))
        )
    )
    return reports.combined_reserve_risk(risk, _scores(s, d).filter("scenario = 'baseline'"), "reserve_risk_capital_M")


def q_mct_capital(s: SparkSession, d: str) -> DataFrame:
    premium = materialize(reports.annual_premium(_monthly(s, d)), "premium")
    reserves = reports.outstanding_reserves(gold.triangle(_reserves(s, d)))
    return reports.mct_capital(reports.mct_lines(reserves, premium, RESERVE_FACTORS, PREMIUM_FACTORS), premium)


def q_reserve_reconciliation(s: SparkSession, d: str) -> DataFrame:
    """Line items in the triangle's cells, and incurred and paid on the latest diagonal, per line."""
    counted = adapters.reserve_cells(s, d).groupBy("product_line").agg(F.sum("n_items").alias("n_items"))
    diagonal = cl.latest_diagonal(
        gold.triangle(_reserves(s, d)), ["segment_id", "product_line", "region", "accident_month"]
    )
    return (
        diagonal.groupBy("product_line")
        .agg(F.sum("cumulative_incurred").alias("incurred"), F.sum("cumulative_paid").alias("paid"))
        .join(counted, "product_line")
    )


def q_scenario_ibnr(s: SparkSession, d: str) -> DataFrame:
    """Deterministic IBNR of each line under each scenario's factors."""
    model = _model(s, d)
    by = ["scenario", "product_line"]
    factors = cl.scenario_ldfs(model.factors, cl.SCENARIOS, auto_lines=AUTO, tail_lag=QUARTER_TAIL_LAG)
    cdf = cl.cdf_to_ultimate(factors, by, "scenario_ldf")
    latest = cl.latest_diagonal(model.triangle, ["product_line", "accident_month"])
    return (
        latest.join(cdf, ["product_line", "dev_lag"])
        .groupBy(*by)
        .agg(F.sum(F.greatest(F.col("cumulative_paid") * (F.col("cdf") - 1.0), F.lit(0.0))).alias("ibnr"))
    )


def q_hold(s: SparkSession, d: str) -> DataFrame:
    cols = list(forecast.REGRESSORS)
    return features.hold_regressors(features.fill_regressors(_panel(s, d), cols), cols)


def q_holdout(s: SparkSession, d: str) -> DataFrame:
    """Seasonal-naive value against the actual over each segment's last 12 rows."""
    w = Window.partitionBy("segment_id").orderBy("month")
    back = Window.partitionBy("segment_id").orderBy(F.col("month").desc())
    scored = (
        _monthly(s, d)
        .withColumns({"predicted": F.lag("claims_count", 12).over(w), "_rn": F.row_number().over(back)})
        .filter("_rn <= 12 AND predicted IS NOT NULL")
    )
    return forecast_errors(scored)


def q_insample(s: SparkSession, d: str) -> DataFrame:
    """Seasonal-naive value against the actual over every row that has one, per segment and overall."""
    w = Window.partitionBy("segment_id").orderBy("month")
    scored = _monthly(s, d).withColumn("predicted", F.lag("claims_count", 12).over(w)).filter("predicted IS NOT NULL")
    both = scored.withColumn("segment_id", F.explode(F.array("segment_id", F.lit("all"))))
    return forecast_errors(both)


def forecast_errors(scored: DataFrame) -> DataFrame:
    return reports.holdout_errors(scored, "claims_count", "predicted")


def q_lognormal(s: SparkSession, d: str) -> DataFrame:
    scores = _scores(s, d).select("request_id", "best_estimate_M", "var_99_M", "var_995_M")
    return reports.lognormal_fit(scores, "best_estimate_M", "var_99_M")


def q_density(s: SparkSession, d: str) -> DataFrame:
    return reports.density_grid(q_lognormal(s, d), "best_estimate_M", "var_995_M", 1_000)


def q_evolution_ibnr(s: SparkSession, d: str) -> DataFrame:
    """Deterministic IBNR of the baseline and of each month of the outlook, with the change against the baseline."""
    model = _model(s, d)
    runs = (cl.SCENARIOS[0], *cl.evolution_scenarios())
    factors = cl.scenario_ldfs(model.factors, runs, auto_lines=AUTO, tail_lag=QUARTER_TAIL_LAG)
    cdf = cl.cdf_to_ultimate(factors, ["scenario", "product_line"], "scenario_ldf")
    latest = cl.latest_diagonal(model.triangle, ["product_line", "accident_month"])
    ibnr = F.sum(F.greatest(F.col("cumulative_paid") * (F.col("cdf") - 1.0), F.lit(0.0)))
    total = latest.join(cdf, ["product_line", "dev_lag"]).groupBy("scenario").agg(ibnr.alias("ibnr"))
    base = F.max(F.when(F.col("scenario") == runs[0].scenario, F.col("ibnr"))).over(Window.partitionBy())
    month = F.when(F.col("scenario") == runs[0].scenario, F.lit(0)).otherwise(F.substring("scenario", 7, 2).cast("int"))
    # one row per scenario, 13 in all: the window without a partition is bounded
    return total.select(month.alias("month_idx"), "ibnr", (F.col("ibnr") / base * 100 - 100).alias("ibnr_vs_baseline"))


def _origins(s: SparkSession, d: str) -> DataFrame:
    panel = features.fill_regressors(_panel(s, d), [HOLDOUT_REGRESSOR])
    return regression.holdout_origins(panel, HOLDOUT_REGRESSOR)


def q_calibrated(s: SparkSession, d: str) -> DataFrame:
    names = ("property", "auto", "liability")
    pairs = {"corr_prop_auto": 1, "corr_prop_liab": 2, "corr_auto_liab": 5}
    return _calibrated(s, d).select(
        *[F.get("means", F.lit(i)).alias(f"{n}_mean_M") for i, n in enumerate(names)],
        *[F.get("cvs", F.lit(i)).alias(f"{n}_cv") for i, n in enumerate(names)],
        *[F.get("corr", F.lit(i)).alias(n) for n, i in pairs.items()],
    )


Query = Callable[[SparkSession, str], DataFrame]

SEG = "segment_id product_line region"
FORECAST_SPEC = (
    "segment_id month:d record_type claims_count:6 forecast_mean:6 forecast_lo95:6 forecast_hi95:6 aic:6 mape:6 "
    "mape_baseline:6 mape_sarimax:6 exog_vars cond_volatility:6 arch_lm_pvalue:6 garch_alpha:6 garch_beta:6 method"
)
MONTHLY_SPEC = SEG + " month:d claims_count:i total_incurred:2 avg_severity:4 earned_premium:2 loss_ratio:6"
ROLLING_SPEC = MONTHLY_SPEC + (
    " rolling_3m_mean:6 rolling_6m_mean:6 rolling_12m_mean:6 rolling_3m_std:6 mom_change_pct:6 yoy_change_pct:6"
)
MACRO_SPEC = "province ref_date indicator_name value:4 ingested_at:t batch_id"
SUMMARY_SPEC = "total_claims:i avg_monthly_claims:1 total_incurred:2 avg_severity:2 total_premium:2"
SCORE_SPEC = (
    "request_id best_estimate_M:3 var_95_M:3 var_99_M:3 var_995_M:3 cvar_99_M:3 "
    "reserve_risk_capital_M:3 max_ibnr_M:3 n_replications_used:i scenario"
)
TRIANGLE_SPEC = (
    SEG + " accident_month dev_lag:i cumulative_paid:2 cumulative_incurred:2 case_reserve:2"
)

# name -> (column spec, plan)
QUERIES: dict[str, tuple[str, Query]] = {
    # sources and generators
    "claims_events": (
        "product_line region loss_date claim_amount:2 monthly_prem_exposure:2 claim_type",
        adapters.claims_events,
    ),
    "reserve_events": (
        TRIANGLE_SPEC + " development_month op", adapters.reserve_development
    ),
    "macro_events": (MACRO_SPEC, adapters.macro_indicators),
    "statistics_indicators": (
        "source_table province ref_date indicator_name value:6 unit batch_id", q_statistics
    ),
    "indicator_profile": ("indicator_name rows:i provinces:i first_date last_date", q_indicator_profile),
    "explode_claims": (
        "product_line region loss_date claim_amount:2 monthly_prem_exposure:2 claim_type", q_explode_claims
    ),
    "weibull_pattern": ("product_line dev_lag:i paid_share:6", q_weibull_pattern),
    "explode_reserves": (
        SEG + " accident_month development_month dev_lag:i cumulative_paid:2 cumulative_incurred:2 case_reserve:2 op",
        q_explode_reserves,
    ),
    "seasonal_panel": (
        SEG + " month:d claims_count:i total_incurred:2 avg_severity:2 earned_premium:2 loss_ratio:4",
        q_seasonal_panel,
    ),
    "replicate": (
        "segment_id month:d claims_count:i",
        lambda s, d: generators.replicate(_monthly(s, d).select("segment_id", "month", "claims_count"), 5),
    ),
    "recent_annotations": (
        "event_id:i segment_id note analyst created_at:t",
        lambda s, d: notes.recent_annotations(_notes(s, d), tie_break="event_id"),
    ),
    "recent_annotations_by_segment": (
        "event_id:i segment_id note analyst created_at:t",
        lambda s, d: notes.recent_per_segment(_notes(s, d), tie_break="event_id"),
    ),
    "readonly_sql": ("product_line region total_claims:i", q_readonly_sql),
    # quality and change data
    "bronze_claims": (
        "product_line region loss_date claim_amount:2 monthly_prem_exposure:2 claim_type",
        lambda s, d: expect_or_drop(adapters.claims_events(s, d), medallion.claims_rules(VALID_LINES)),
    ),
    "bronze_macro": (MACRO_SPEC, _bronze_macro),
    "quality_report": ("source rule action passed:i failed:i", q_quality_report),
    "bronze_stream": (MACRO_SPEC, q_bronze_stream),
    "scd2_macro": (
        MACRO_SPEC + " start_at:t end_at:t",
        lambda s, d: medallion.silver_macro(adapters.macro_indicators(s, d)),
    ),
    "scd2_macro_every_event": (
        MACRO_SPEC + " start_at:t end_at:t",
        lambda s, d: medallion.silver_macro(adapters.macro_indicators(s, d), track=None),
    ),
    "scd2_stream": (MACRO_SPEC + " start_at:t end_at:t", q_scd2_stream),
    "scd2_restart": (MACRO_SPEC + " start_at:t end_at:t", q_scd2_restart),
    "scd2_growing": (MACRO_SPEC + " start_at:t end_at:t", q_scd2_growing),
    "delta_monthly": (
        SEG + " month:d claims_count:i total_incurred:2 avg_severity:2 earned_premium:2 loss_ratio:6 smallest_claim:2"
        " largest_claim:2",
        q_delta_monthly,
    ),
    "reserve_history": (
        SEG + " accident_month development_month dev_lag:i cumulative_paid:2 cumulative_incurred:2 case_reserve:2"
        " start_at end_at",
        lambda s, d: medallion.silver_reserves(_reserve_revisions(s, d), VALID_LINES),
    ),
    "current_macro": (
        MACRO_SPEC,
        lambda s, d: scd2.current_versions(medallion.silver_macro(adapters.macro_indicators(s, d))),
    ),
    "latest_macro": (
        MACRO_SPEC,
        lambda s, d: scd2.scd1_latest(_bronze_macro(s, d), medallion.MACRO_KEYS, "ingested_at"),
    ),
    # gold tables
    "claims_monthly": (MONTHLY_SPEC, _monthly),
    "gold_claims": (MONTHLY_SPEC, lambda s, d: medallion.gold_claims(adapters.claims_events(s, d), VALID_LINES)),
    "claims_between": (
        MONTHLY_SPEC, lambda s, d: reports.month_between(_monthly(s, d), "1997-01-01", "1998-12-01")
    ),
    "split_segments": (SEG, q_split_segments),
    "rolling_features": (ROLLING_SPEC, lambda s, d: gold.rolling_features(_monthly(s, d))),
    "rolling_features_pandas": (ROLLING_SPEC, lambda s, d: forecast.rolling_features_pandas(_monthly(s, d))),
    "rolling_features_bridge": (
        ROLLING_SPEC, lambda s, d: forecast.rolling_features_pandas(_monthly(s, d), bridge=True)
    ),
    "feature_table": (
        ROLLING_SPEC + " month_ts:t avg_loss_ratio:6 total_premium:2 month_of_year:i quarter:i is_q1:i is_winter:i "
        "coeff_variation_3m:6 loss_ratio_trend_3m:6 normalized_premium:6",
        _features,
    ),
    "reserve_triangle": (
        TRIANGLE_SPEC + " incremental_paid:2 incremental_incurred:2",
        lambda s, d: medallion.gold_triangle(_reserves(s, d), LINES),
    ),
    "pivot_indicators": (
        "province ref_date unemployment_rate:4 hpi_index:4 housing_starts:4",
        lambda s, d: gold.pivot_indicators(
            scd2.scd1_latest(_bronze_macro(s, d), medallion.MACRO_KEYS, "ingested_at")
        ),
    ),
    "macro_features": (
        "region month:d unemployment_rate:4 hpi_index:4 hpi_growth:4 housing_starts:4", _macro_wide
    ),
    "wide_select": (
        "segment_id month:d claims_count:i " + " ".join(f"col_{i}:2" for i in range(600)), q_wide_select
    ),
    # joins
    "join_macro": (
        SEG + " month:d claims_count:i unemployment_rate:4 hpi_index:4 hpi_growth:4 housing_starts:4",
        lambda s, d: features.join_macro(_monthly(s, d), _macro_wide(s, d)),
    ),
    "join_features": (
        SEG + " month:d claims_count:i hpi_index:4 rolling_3m_mean:6 rolling_6m_mean:6 coeff_variation_3m:6 "
        "mom_change_pct:6 normalized_premium:6",
        _panel,
    ),
    "fill_regressors": (
        "segment_id month:d unemployment_rate:4 hpi_growth:4 rolling_3m_mean:6 coeff_variation_3m:6 mom_change_pct:6",
        lambda s, d: features.fill_regressors(_panel(s, d), forecast.REGRESSORS),
    ),
    "hold_regressors": (
        "segment_id unemployment_rate:4 hpi_growth:4 rolling_3m_mean:6 coeff_variation_3m:6 mom_change_pct:6",
        q_hold,
    ),
    "future_months": (
        "segment_id month:d month_offset:i", lambda s, d: features.future_months(_monthly(s, d), 12)
    ),
    "point_in_time_join": (
        "observation_id:i segment_id obs_ts:t target_loss_ratio:4 month_ts:t rolling_3m_mean:6 rolling_12m_mean:6 "
        "coeff_variation_3m:6 loss_ratio_trend_3m:6 month_of_year:i",
        q_point_in_time,
    ),
    "reserve_validation": (
        "segment_id month:d cumulative_incurred:2 cumulative_paid:2 case_reserve:2 claims_count:i "
        "reserve_adequacy_ratio:4 dev_lag:i",
        lambda s, d: reports.reserve_validation(gold.triangle(_reserves(s, d)), _monthly(s, d)),
    ),
    "avg_adequacy": (
        "avg_adequacy:2",
        lambda s, d: reports.reserve_validation(gold.triangle(_reserves(s, d)), _monthly(s, d)).agg(
            F.avg("reserve_adequacy_ratio").alias("avg_adequacy")
        ),
    ),
    "merge_defaults": (
        "request_id scenario n_replications:i " + " ".join(f"{c}:4" for c in sim.SCORER_DEFAULTS), _requests
    ),
    # reports
    "overwrite": ("region " + SUMMARY_SPEC, q_overwrite),
    "append_batch": ("province ref_date indicator_name value:4 batch_id", q_append),
    "export_csv": ("region " + SUMMARY_SPEC, q_csv),
    "medallion_update": ("segment_id month:d claims_count:i total_incurred:2 cells:i paid:2", q_medallion_update),
    "snapshot_publish": (
        "region " + SUMMARY_SPEC + " seen_after_failure:i seen_pinned:i product_lines:i", q_snapshot_publish
    ),
    "full_refresh": ("refresh segment_id month:d claims_count:i total_incurred:2 earned_premium:2", q_full_refresh),
    "regional_summary": ("region " + SUMMARY_SPEC, lambda s, d: reports.regional_summary(_monthly(s, d))),
    "regional_summary_range": (
        "region " + SUMMARY_SPEC,
        lambda s, d: reports.regional_summary(_monthly(s, d), "1996-01-01", "1999-06-01"),
    ),
    "regional_product_breakdown": (
        "region product_line " + SUMMARY_SPEC, lambda s, d: reports.regional_product_breakdown(_monthly(s, d))
    ),
    "product_region_matrix": (
        "region " + " ".join(f"{x}:i" for x in LINES),
        lambda s, d: reports.product_region_matrix(reports.regional_product_breakdown(_monthly(s, d)), LINES),
    ),
    "segment_stats": (
        "segment_id first_month:d last_month:d num_months:i avg_monthly_claims:1 stddev_claims:1 min_claims:i max_claims:i",
        lambda s, d: reports.segment_stats(_monthly(s, d)),
    ),
    "outstanding_reserves": (
        "product_line outstanding_reserves:2 total_incurred:2",
        lambda s, d: reports.outstanding_reserves(gold.triangle(_reserves(s, d))),
    ),
    "annual_premium": ("product_line annual_earned_premium:2", lambda s, d: reports.annual_premium(_monthly(s, d))),
    "trailing_mean": (
        "line trailing_mean:4 annualized_M:6",
        lambda s, d: reports.trailing_mean(_monthly(s, d), "claims_count"),
    ),
    "global_mean": ("mean_premium_M:6", lambda s, d: reports.global_mean(_monthly(s, d))),
    "global_mean_by_segment": (
        "mean_premium_M:6", lambda s, d: reports.global_mean(_monthly(s, d), "segment_mean")
    ),
    "table_profile": (
        "row_count:i segment_count:i min_months:i max_months:i", lambda s, d: reports.table_profile(_monthly(s, d))
    ),
    "ols_trend": (
        "segment_id slope:6 intercept:6 r_squared:6 annualized_growth_pct:4",
        lambda s, d: features.ols_trend(_monthly(s, d)),
    ),
    "ols_trend_pandas": (
        "segment_id slope:6 intercept:6 r_squared:6 annualized_growth_pct:4",
        lambda s, d: forecast.ols_trend_pandas(_monthly(s, d)),
    ),
    "top_growth": (
        "segment_id slope:6 annualized_growth_pct:4",
        lambda s, d: features.ols_trend(_monthly(s, d))
        .orderBy(F.col("annualized_growth_pct").desc(), "segment_id")
        .limit(10),
    ),
    "money_labels": ("region label incurred_label scaled_label", q_money_labels),
    "claim_quantiles": (
        "product_line prob:3 quantile:4",
        lambda s, d: quantiles.quantiles(
            adapters.claims_events(s, d), ["product_line"], "claim_amount",
            (*quantiles.BAND_PROBS, *quantiles.RISK_PROBS[1:2], *quantiles.RISK_PROBS[3:], 0.999), accuracy=1_000,
        ),
    ),
    "claim_quantiles_overall": (
        "prob:3 quantile:4",
        lambda s, d: quantiles.quantiles(adapters.claims_events(s, d), [], "claim_amount", accuracy=1_000),
    ),
    # brackets of more than 1,024 values are refined: 6 % of all rows here
    "refined_quantiles": (
        "prob:3 quantile:4",
        lambda s, d: quantiles.quantiles(
            adapters.claims_events(s, d), [], "claim_amount", quantiles.BAND_PROBS, accuracy=100, most=1_024
        ),
    ),
    "sketch_quantiles": ("product_line span prob:3 values:i quantile:4 within_bound", q_sketch_quantiles),
    "claim_cvar": (
        "region var:4 cvar:4", lambda s, d: quantiles.cvar(adapters.claims_events(s, d), ["region"], "claim_amount")
    ),
    "task_quantile_means": ("product_line prob:3 quantile:6", q_task_quantile_means),
    "ruin_probability": ("month:d ruin_probability:6", q_ruin),
    "mct_lines": (
        "product_line line_of_business outstanding_reserves:2 reserve_factor:2 reserve_charge:2 "
        "annual_earned_premium:2 premium_factor:2 premium_charge:2",
        lambda s, d: reports.mct_lines(
            reports.outstanding_reserves(gold.triangle(_reserves(s, d))),
            reports.annual_premium(_monthly(s, d)), RESERVE_FACTORS, PREMIUM_FACTORS,
        ),
    ),
    "mct_capital": (
        "reserve_charge:2 premium_charge:2 undiversified:2 capital_required:2 capital_available:2 "
        "diversification_credit:2 mct_ratio_pct:6",
        q_mct_capital,
    ),
    # chain ladder
    "reserve_reconciliation": ("product_line n_items:i incurred:2 paid:2", q_reserve_reconciliation),
    "triangle_pivot": (
        "product_line accident_month " + " ".join(f"lag_{k}:2" for k in DIAGONAL_LAGS),
        lambda s, d: cl.triangle_pivot(cl.line_triangle(_reserves(s, d)), DIAGONAL_LAGS),
    ),
    "line_incrementals": (
        "product_line accident_month dev_lag:i cumulative_paid:2 incremental_paid:2",
        lambda s, d: gold.with_incrementals(
            cl.line_triangle(_reserves(s, d)), ["product_line"], {"incremental_paid": "cumulative_paid"}
        ),
    ),
    "latest_diagonal": (
        "product_line accident_month dev_lag:i cumulative_paid:2",
        lambda s, d: cl.latest_diagonal(cl.line_triangle(_reserves(s, d)), ["product_line", "accident_month"]),
    ),
    "adjacent_pairs": (
        "product_line accident_month dev_lag:i next_lag:i cumulative_paid:2 next_paid:2 usable",
        lambda s, d: _model(s, d).pairs,
    ),
    "development_factors": (
        "product_line dev_lag:i ldf:6 mack_sigma:4 ldf_se:6 n_pairs:i", lambda s, d: _model(s, d).factors
    ),
    "segment_development_factors": (
        "segment_id dev_lag:i ldf:6 mack_sigma:4 ldf_se:6 n_pairs:i",
        lambda s, d: reserving.fit(_reserves(s, d), ["segment_id"]).factors,
    ),
    "simple_link_ratios": (
        "product_line dev_lag:i next_lag:i avg_link_ratio:3", lambda s, d: cl.simple_link_ratios(_model(s, d).pairs)
    ),
    "cdf_to_ultimate": ("product_line dev_lag:i cdf:6", lambda s, d: cl.cdf_to_ultimate(_model(s, d).factors)),
    "ibnr_by_accident": (
        "product_line accident_month latest_lag:i latest_paid:2 cdf:6 ultimate:2 ibnr:2",
        lambda s, d: _model(s, d).by_accident,
    ),
    "ibnr_by_line": ("product_line latest_paid:2 ultimate:2 total_ibnr:2", lambda s, d: _model(s, d).totals),
    "pearson_residuals": (
        "product_line accident_month dev_lag_from:i dev_lag_to:i observed:2 fitted:2 c_from:2 residual:4 f_k:6",
        lambda s, d: _model(s, d).residuals,
    ),
    "ldf_volatility": (
        "product_line avg_ldf:4 std_ldf:4 cv:4 ibnr_M:4 n_factors:i mean_residual:4 std_residual:4 n_residuals:i",
        lambda s, d: _model(s, d).volatility,
    ),
    "ldf_volatility_risk": (
        "product_line avg_ldf:4 std_ldf:4 n_factors:i outstanding_reserves:2 reserve_risk_M:6",
        lambda s, d: reports.ldf_volatility_risk(
            _model(s, d).volatility, reports.outstanding_reserves(gold.triangle(_reserves(s, d)))
        ),
    ),
    "snapped_cvs": ("product_line cv:4 snapped_cv:2", lambda s, d: reports.snapped_cvs(_model(s, d).volatility)),
    "preset_grid": (
        "product_line base_cv:4 preset severity scenario ldf_multiplier:4 cv_multiplier:4 inflation_adj:4 line_cv:2",
        lambda s, d: reports.preset_grid(_model(s, d).volatility),
    ),
    "scenario_ldfs": (
        "scenario product_line dev_lag:i ldf:6 scenario_ldf:6",
        lambda s, d: cl.scenario_ldfs(
            _model(s, d).factors, cl.SCENARIOS, auto_lines=AUTO, tail_lag=QUARTER_TAIL_LAG
        ),
    ),
    "scenario_ibnr": ("scenario product_line ibnr:2", q_scenario_ibnr),
    "evolution_ibnr": ("month_idx:i ibnr:2 ibnr_vs_baseline:6", q_evolution_ibnr),
    # scorer and what is built on it
    "score_scenarios": (SCORE_SPEC, _scores),
    "scenario_delta": (
        "request_id best_estimate_M:3 var_95_M:3 var_99_M:3 var_995_M:3 cvar_99_M:3 delta_best_estimate_M:3 "
        "delta_var_95_M:3 delta_var_99_M:3 delta_var_995_M:3 delta_cvar_99_M:3 var_995_lift_pct:4",
        lambda s, d: reports.scenario_delta(_scores(s, d).drop("scenario"), "request_id", "r1"),
    ),
    "scenario_ranking": (
        "scenario var_995_M:3 var_995_vs_baseline:4",
        lambda s, d: sim.scenario_comparison(_scores(s, d)).orderBy(F.col("var_995_M").desc()),
    ),
    "bootstrap_summary": (
        "best_estimate:4 var_99:4 var_995:4 cvar_99:4 reserve_risk_capital:4 max_ibnr:4",
        lambda s, d: reports.bootstrap_summary(_scores(s, d)),
    ),
    "mack_normal_metrics": (
        "request_id best_estimate_M:3 mack_var_99_M:4 mack_var_995_M:4 mack_cvar_99_M:4",
        lambda s, d: reports.mack_normal_metrics(_scores(s, d), "best_estimate_M"),
    ),
    "lognormal_fit": ("request_id best_estimate_M:3 var_99_M:3 mu:6 sigma:6", q_lognormal),
    "density_grid": ("request_id i:i x:4 pdf:6", q_density),
    "combined_reserve_risk": ("reserve_risk_capital_M:3 ldf_risk_M:6 combined_risk_M:4", q_combined_risk),
    # forecasts
    "arch_lm": (
        "segment_id n:i r2:6 lm:4 p_value:6", lambda s, d: regression.arch_lm(_written_monthly(s, d))
    ),
    "holdout_origins": ("segment_id month:d model actual:6 predicted:6 error:6", _origins),
    "holdout_models": (
        "segment_id model origins:i mape:6 rmse:6 aic:4 bic:4 best",
        lambda s, d: regression.holdout_models(materialize(_origins(s, d), "origins")),
    ),
    "seasonal_naive": (FORECAST_SPEC, _naive),
    "forecast_metrics": (
        "avg_mape:6 avg_mape_baseline:6 avg_mape_sarimax:6 garch_seg_count:i",
        lambda s, d: reports.forecast_metrics(_naive(s, d)),
    ),
    "forecast_horizon": (
        "segment_id month_offset:i forecast_mean:1 forecast_lo95:1 forecast_hi95:1",
        lambda s, d: forecast.forecast_horizon(forecast.seasonal_naive(_monthly(s, d), 18)),
    ),
    "forecast_panel": (
        "segment_id mean_forecast:6 mean_half_width:6 width_start:6 width_end:6 ci_widens",
        lambda s, d: reports.forecast_panel(_naive(s, d)),
    ),
    "segment_list": ("segment_id", lambda s, d: reports.segment_list(_naive(s, d))),
    "segment_forecast": (
        "month:d record_type claims_count:6 forecast_mean:6 forecast_lo95:6 forecast_hi95:6",
        lambda s, d: reports.segment_forecast(_naive(s, d), "BUILDING__ASIA"),
    ),
    "segment_volatility": (
        "month:d record_type cond_volatility:6 arch_lm_pvalue:6 garch_alpha:6 garch_beta:6",
        lambda s, d: reports.segment_volatility(_naive(s, d), "BUILDING__ASIA"),
    ),
    "forecast_by_line": (
        "product_line month:d forecast_mean:4", lambda s, d: reports.forecast_by_line(_naive(s, d))
    ),
    "forecast_by_region": (
        "region month:d forecast_mean:4 share_pct:6", lambda s, d: reports.forecast_by_region(_naive(s, d))
    ),
    "top_region_shares": (
        "region share_pct:6",
        lambda s, d: portfolio.top_shares(reports.forecast_by_region(_naive(s, d)), 3),
    ),
    "insample_errors": ("segment_id mape:6 rmse:6", q_insample),
    "holdout_errors": ("segment_id mape:6 rmse:6", q_holdout),
    "arch_summary": (
        "segment_id arch_lm_pvalue:6 garch_alpha:6 garch_beta:6 persistence:6 significant",
        lambda s, d: reports.arch_summary(_naive(s, d)),
    ),
    "arch_counts": (
        "significant_segments:i tested_segments:i fitted_segments:i",
        lambda s, d: reports.arch_counts(reports.arch_summary(_naive(s, d))),
    ),
    "cv_by_line": ("product_line cv:6", _line_cvs),
    # portfolio calibration
    "growth_by_month": (
        "month:d property_growth:6 auto_growth:6 liability_growth:6",
        lambda s, d: portfolio.growth_by_month(_naive(s, d), SEGMENT_OF, WEIGHTS),
    ),
    "segment_means": (
        "property_mean_M:2 auto_mean_M:2 liability_mean_M:2",
        lambda s, d: portfolio.segment_means(_monthly(s, d), SEGMENT_OF),
    ),
    "log_corr_matrix": (
        "corr_prop_auto:6 corr_prop_liab:6 corr_auto_liab:6",
        lambda s, d: portfolio.log_corr_matrix(_monthly(s, d), SEGMENT_OF),
    ),
    "freq_sev_moments": (
        "mc_segment freq_lambda:1 freq_k:2 sev_mu:4 sev_sigma:4",
        lambda s, d: portfolio.freq_sev_moments(_monthly(s, d), SEGMENT_OF),
    ),
    "segment_cvs": (
        "property_cv:6 auto_cv:6 liability_cv:6",
        lambda s, d: portfolio.segment_cvs(_line_cvs(s, d), CV_DEFAULTS, SEGMENT_OF),
    ),
    "calibrated_portfolio": (
        "property_mean_M:2 auto_mean_M:2 liability_mean_M:2 property_cv:6 auto_cv:6 liability_cv:6 "
        "corr_prop_auto:6 corr_prop_liab:6 corr_auto_liab:6",
        q_calibrated,
    ),
}


def _run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    spec, plan = QUERIES[name]
    return tidy(plan(spark, sf_dir), spec)


def queries() -> dict[str, Query]:
    return {name: partial(_run, name) for name in QUERIES}

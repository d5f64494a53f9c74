"""Check SQL: for each relational query the same answer in plain SQL over the given tables."""

from __future__ import annotations

import math
import re

import numpy as np

from ..functions.randoms import COUNTER_MULT, FINAL_MULT, KEY_MULT, STREAM_STEP, WORD
from ..operators import chain_ladder as cl
from ..operators import reports
from ..operators import simulate as sim
from ..sources import adapters, generators
from . import registry as reg


def rnd(expr: str, digits: int) -> str:
    s = float(10**digits)
    return f"(round(({expr}) * {s:.1f}) / {s:.1f})"


def shaped(core: str, spec: str) -> str:
    """Outer projection by the registry's column spec."""
    out = []
    for item in spec.split():
        name, _, kind = item.partition(":")
        if kind == "i":
            out.append(f"CAST({name} AS BIGINT) AS {name}")
        elif kind == "d":
            out.append(f"CAST({name} AS DATE) AS {name}")
        elif kind == "t":
            out.append(f"CAST({name} AS TIMESTAMP) AS {name}")
        elif kind:
            out.append(f"{rnd(f'CAST({name} AS DOUBLE)', int(kind))} + 0.0 AS {name}")
        else:
            out.append(name)
    return f"SELECT {', '.join(out)} FROM ({core})"


def values_list(xs) -> str:
    return ", ".join(f"'{x}'" for x in xs)


def case_map(col: str, mapping: dict, default: str = "NULL") -> str:
    lit = [f"WHEN {col} = '{k}' THEN {v!r}" for k, v in mapping.items()]
    return f"CASE {' '.join(lit)} ELSE {default} END"


# --- counter-based random columns ------------------------------------------------


def key32(seed: int, *cols: str) -> str:
    parts = " || ':' || ".join(["'" + str(seed) + "'", *[f"CAST({c} AS VARCHAR)" for c in cols]])
    return f"CAST('0x' || substr(md5({parts}), 1, 8) AS BIGINT)"


def uniform(key: str, counter: str, stream: int) -> str:
    word = (
        f"((CAST({key} AS BIGINT) * {KEY_MULT} + CAST({counter} AS BIGINT) * {COUNTER_MULT}"
        f" + {(stream * STREAM_STEP) % WORD}) & {WORD - 1})"
    )

    def scramble(x: str) -> str:
        return f"((xor({x} >> 16, {x}) * {FINAL_MULT}) & {WORD - 1})"

    x = scramble(scramble(word))
    return f"((xor({x} >> 16, {x}) + 0.5) / {float(WORD):.1f})"


def normal(key: str, counter: str, stream: int) -> str:
    u, v = uniform(key, counter, 2 * stream), uniform(key, counter, 2 * stream + 1)
    return f"(sqrt(-2.0 * ln(CAST({u} AS DOUBLE))) * cos({2 * math.pi!r} * CAST({v} AS DOUBLE)))"


# --- shared tables -----------------------------------------------------------------

PAID = rnd("l_extendedprice * (1.0 - l_discount)", 2)
REGRESSOR_COLUMNS = ("unemployment_rate", "hpi_growth", "rolling_3m_mean", "coeff_variation_3m", "mom_change_pct")


def _latest(table: str, keys: str) -> str:
    return (
        f"SELECT * EXCLUDE (rn_) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY dev_lag DESC) AS rn_"
        f" FROM {table}) WHERE rn_ = 1"
    )


def _pairs(table: str, by: str) -> str:
    """Cells with a later lag in their group, the value at that lag and whether both are usable."""
    return f"""
        SELECT t.{by}, t.accident_month, t.dev_lag, g.next_lag, t.cumulative_paid, n.cumulative_paid AS next_paid,
               coalesce(n.cumulative_paid IS NOT NULL AND t.cumulative_paid > 0, false) AS usable
        FROM {table} t
        JOIN (SELECT {by}, dev_lag, lead(dev_lag) OVER (PARTITION BY {by} ORDER BY dev_lag) AS next_lag
              FROM (SELECT DISTINCT {by}, dev_lag FROM {table})) g
          ON t.{by} = g.{by} AND t.dev_lag = g.dev_lag AND g.next_lag IS NOT NULL
        LEFT JOIN {table} n
          ON n.{by} = t.{by} AND n.accident_month = t.accident_month AND n.dev_lag = g.next_lag"""


def _factors(pairs: str, by: str) -> str:
    return f"""
        SELECT a.{by}, a.dev_lag, CASE WHEN a.n >= 2 THEN a.f ELSE 1.0 END AS ldf,
               CASE WHEN a.n >= 2 THEN sqrt(b.v / (a.n - 1)) ELSE 0.0 END AS mack_sigma,
               CASE WHEN a.n >= 2 THEN sqrt(b.v / (a.n - 1) / greatest(a.c, 1.0)) ELSE 0.0 END AS ldf_se,
               a.n AS n_pairs
        FROM (SELECT {by}, dev_lag, count(*) FILTER (usable) AS n, sum(cumulative_paid) FILTER (usable) AS c,
                     sum(next_paid) FILTER (usable) / sum(cumulative_paid) FILTER (usable) AS f
              FROM {pairs} GROUP BY ALL) a
        LEFT JOIN (SELECT p.{by}, p.dev_lag,
                          sum(p.cumulative_paid * (p.next_paid / p.cumulative_paid - q.f) ** 2) AS v
                   FROM {pairs} p
                   JOIN (SELECT {by}, dev_lag, sum(next_paid) / sum(cumulative_paid) AS f
                         FROM {pairs} WHERE usable GROUP BY ALL) q
                     ON p.{by} = q.{by} AND p.dev_lag = q.dev_lag
                   WHERE p.usable GROUP BY ALL) b
          ON a.{by} = b.{by} AND a.dev_lag = b.dev_lag"""


def _rule_case(column: str, table: dict[str, str], default: str) -> str:
    return "CASE " + " ".join(f"WHEN {column} = '{k}' THEN {v}" for k, v in table.items()) + f" ELSE {default} END"


CTES: dict[str, str] = {
    "segs": """
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date, c_mktsegment AS product_line, r_name AS region
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "claims": f"""
        SELECT product_line, region, CAST(order_date AS VARCHAR) AS loss_date, order_date,
               {PAID} AS claim_amount, {rnd("l_extendedprice * (1.0 + l_tax)", 2)} AS monthly_prem_exposure,
               l_returnflag AS claim_type
        FROM lineitem JOIN segs ON l_orderkey = o_orderkey""",
    "monthly": f"""
        SELECT segment_id, product_line, region, month, claims_count, total_incurred,
               total_incurred / claims_count AS avg_severity, earned_premium,
               CASE WHEN earned_premium > 0 THEN total_incurred / earned_premium ELSE 0.0 END AS loss_ratio
        FROM (SELECT product_line || '__' || region AS segment_id, product_line, region,
                     CAST(date_trunc('month', order_date) AS DATE) AS month, count(*) AS claims_count,
                     {rnd('sum(claim_amount)', 2)} AS total_incurred,
                     {rnd('sum(monthly_prem_exposure)', 2)} AS earned_premium
              FROM claims GROUP BY 1, 2, 3, 4)""",
    "panel": "SELECT * FROM monthly",
    "items": """
        SELECT product_line, region, l_extendedprice, l_discount,
               least(order_date, CAST(l_shipdate AS DATE)) AS d0, greatest(order_date, CAST(l_shipdate AS DATE)) AS d1
        FROM lineitem JOIN segs ON l_orderkey = o_orderkey""",
    "cells": """
        SELECT product_line, region, CAST(date_trunc('quarter', d0) AS DATE) AS accident,
               datediff('quarter', d0, d1) + 1 AS dev_lag,
               sum(round(l_extendedprice * 100.0) / 100.0) AS incurred,
               sum(round(l_extendedprice * (1.0 - l_discount) * 100.0) / 100.0) AS paid
        FROM items GROUP BY 1, 2, 3, 4""",
    "valuation": "SELECT max(d1) AS v FROM items",
    "reserves": f"""
        SELECT a.product_line || '__' || a.region AS segment_id, a.product_line, a.region,
               CAST(a.accident AS VARCHAR) AS accident_month,
               CAST(CAST(a.accident + to_months(CAST(a.lag * 3 AS INTEGER)) AS DATE) AS VARCHAR) AS development_month,
               a.lag AS dev_lag, a.cp AS cumulative_paid, a.ci AS cumulative_incurred,
               {rnd('a.ci - a.cp', 2)} AS case_reserve,
               CASE WHEN a.lag = 1 THEN 'INSERT' ELSE 'UPDATE' END AS op
        FROM (SELECT g.product_line, g.region, g.accident, g.lag,
                     {rnd('sum(coalesce(c.paid, 0.0)) OVER w', 2)} AS cp,
                     {rnd('sum(coalesce(c.incurred, 0.0)) OVER w', 2)} AS ci
              FROM (SELECT product_line, region, accident,
                           unnest(range(1, datediff('quarter', accident, v) + 2)) AS lag
                    FROM (SELECT DISTINCT product_line, region, accident FROM cells), valuation) g
              LEFT JOIN cells c ON c.product_line = g.product_line AND c.region = g.region
                   AND c.accident = g.accident AND c.dev_lag = g.lag
              WINDOW w AS (PARTITION BY g.product_line, g.region, g.accident ORDER BY g.lag
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) a""",
    "line_tri": f"""
        SELECT product_line, accident_month, dev_lag, {rnd('sum(cumulative_paid)', 2)} AS cumulative_paid
        FROM reserves GROUP BY ALL""",
    "pairs": _pairs("line_tri", "product_line"),
    "factors": _factors("pairs", "product_line"),
    "seg_pairs": _pairs("reserves", "segment_id"),
    "cdfs": """
        SELECT product_line, dev_lag, product(ldf) OVER (PARTITION BY product_line ORDER BY dev_lag
               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS cdf FROM factors""",
    "latest_line": _latest("line_tri", "product_line, accident_month"),
    "ibnr": """
        SELECT l.product_line, l.accident_month, l.dev_lag AS latest_lag, l.cumulative_paid AS latest_paid,
               coalesce(c.cdf, 1.0) AS cdf, l.cumulative_paid * coalesce(c.cdf, 1.0) AS ultimate,
               greatest(l.cumulative_paid * (coalesce(c.cdf, 1.0) - 1.0), 0.0) AS ibnr
        FROM latest_line l LEFT JOIN cdfs c ON l.product_line = c.product_line AND l.dev_lag = c.dev_lag""",
    "resid": """
        SELECT p.product_line, p.accident_month, p.dev_lag AS dev_lag_from, p.next_lag AS dev_lag_to,
               p.next_paid AS observed, f.ldf * p.cumulative_paid AS fitted, p.cumulative_paid AS c_from,
               (p.next_paid - f.ldf * p.cumulative_paid) / sqrt(f.ldf * p.cumulative_paid) AS residual, f.ldf AS f_k
        FROM pairs p JOIN factors f ON p.product_line = f.product_line AND p.dev_lag = f.dev_lag
        WHERE p.usable AND f.ldf * p.cumulative_paid > 0""",
    "vol": f"""
        SELECT a.product_line, {rnd('a.m', 4)} AS avg_ldf, {rnd('a.s', 4)} AS std_ldf,
               {rnd('CASE WHEN a.m > 0 THEN a.s / a.m ELSE 0.15 END', 4)} AS cv, {rnd('b.i / 1e6', 4)} AS ibnr_M,
               a.n AS n_factors, {rnd('c.m', 4)} AS mean_residual, {rnd('c.s', 4)} AS std_residual,
               c.n AS n_residuals
        FROM (SELECT product_line, avg(ldf) AS m, stddev_pop(ldf) AS s, count(*) AS n FROM factors GROUP BY 1) a
        JOIN (SELECT product_line, sum(ibnr) AS i FROM ibnr GROUP BY 1) b USING (product_line)
        JOIN (SELECT product_line, avg(residual) AS m, stddev_pop(residual) AS s, count(*) AS n
              FROM resid GROUP BY 1) c USING (product_line)""",
    "latest_seg": _latest("reserves", "segment_id, accident_month"),
    "outstanding": f"""
        SELECT product_line, {rnd('sum(case_reserve)', 2)} AS outstanding_reserves,
               {rnd('sum(cumulative_incurred)', 2)} AS total_incurred
        FROM latest_seg GROUP BY 1""",
    "premium": f"""
        SELECT product_line, {rnd('avg(p) * 12', 2)} AS annual_earned_premium
        FROM (SELECT product_line, month, sum(earned_premium) AS p FROM panel
              WHERE month >= (SELECT max(month) - INTERVAL 11 MONTH FROM panel) GROUP BY 1, 2) GROUP BY 1""",
    "rolling": """
        SELECT *, avg(claims_count) OVER (w ROWS 2 PRECEDING) AS rolling_3m_mean,
               avg(claims_count) OVER (w ROWS 5 PRECEDING) AS rolling_6m_mean,
               avg(claims_count) OVER (w ROWS 11 PRECEDING) AS rolling_12m_mean,
               stddev_samp(claims_count) OVER (w ROWS 2 PRECEDING) AS rolling_3m_std,
               CASE WHEN lag(claims_count) OVER w <> 0 THEN (claims_count - lag(claims_count) OVER w)
                    / CAST(lag(claims_count) OVER w AS DOUBLE) * 100 ELSE 0.0 END AS mom_change_pct,
               CASE WHEN lag(claims_count, 12) OVER w <> 0 THEN (claims_count - lag(claims_count, 12) OVER w)
                    / CAST(lag(claims_count, 12) OVER w AS DOUBLE) * 100 ELSE 0.0 END AS yoy_change_pct
        FROM monthly WINDOW w AS (PARTITION BY segment_id ORDER BY month)""",
    "feats": """
        SELECT *, CAST(month AS TIMESTAMP) AS month_ts, loss_ratio AS avg_loss_ratio,
               earned_premium AS total_premium, month(month) AS month_of_year, quarter(month) AS quarter,
               CAST(quarter(month) = 1 AS INT) AS is_q1, CAST(month(month) IN (12, 1, 2) AS INT) AS is_winter,
               CASE WHEN rolling_3m_mean > 0 THEN rolling_3m_std / rolling_3m_mean ELSE 0.0 END AS coeff_variation_3m,
               coalesce(loss_ratio - lag(loss_ratio, 3) OVER (PARTITION BY segment_id ORDER BY month), 0.0)
                   AS loss_ratio_trend_3m,
               CASE WHEN avg(earned_premium) OVER (PARTITION BY segment_id) <> 0
                    THEN earned_premium / avg(earned_premium) OVER (PARTITION BY segment_id) ELSE 1.0 END
                   AS normalized_premium
        FROM rolling""",
    "macro": f"""
        SELECT 'P' || CAST(user_id % {adapters.PROVINCES} AS VARCHAR) AS province,
               CAST(CAST(ts AS DATE) AS VARCHAR) AS ref_date,
               {case_map('event_type', adapters.INDICATOR_OF_EVENT, 'event_type')} AS indicator_name,
               value, ts AS ingested_at, CAST(CAST(ts AS DATE) AS VARCHAR) AS batch_id
        FROM events""",
    "bronze": """
        SELECT * FROM macro WHERE value IS NOT NULL
          AND indicator_name IN ('unemployment_rate', 'hpi_index', 'housing_starts')""",
    "history": """
        SELECT *, ingested_at AS start_at, lead(ingested_at) OVER k AS end_at
        FROM (SELECT *, lag(value) OVER k2 AS before, row_number() OVER k2 AS rn
              FROM bronze WINDOW k2 AS (PARTITION BY province, ref_date, indicator_name ORDER BY ingested_at))
        WHERE rn = 1 OR before <> value
        WINDOW k AS (PARTITION BY province, ref_date, indicator_name ORDER BY ingested_at)""",
    "latest_macro": """
        SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY province, ref_date, indicator_name
               ORDER BY ingested_at DESC) AS rn FROM bronze) WHERE rn = 1""",
    "pivoted": """
        SELECT province, ref_date,
               max(value) FILTER (indicator_name = 'unemployment_rate') AS unemployment_rate,
               max(value) FILTER (indicator_name = 'hpi_index') AS hpi_index,
               max(value) FILTER (indicator_name = 'housing_starts') AS housing_starts
        FROM latest_macro GROUP BY 1, 2""",
    "wide": f"""
        SELECT region, month, unemployment_rate, hpi_index, housing_starts,
               CASE WHEN lag(hpi_index) OVER w > 0
                    THEN (hpi_index - lag(hpi_index) OVER w) / lag(hpi_index) OVER w * 100.0 END AS hpi_growth
        FROM (SELECT *, {case_map('province', adapters.REGION_OF_PROVINCE)} AS region,
                     CAST(DATE '1996-01-01' + to_months(CAST(CAST(ref_date AS DATE) - DATE '2024-01-01' AS INTEGER))
                          AS DATE) AS month FROM pivoted)
        WHERE region IS NOT NULL
        WINDOW w AS (PARTITION BY province ORDER BY month)""",
    "joined": """
        SELECT p.*, w.unemployment_rate, w.hpi_index, w.hpi_growth, w.housing_starts,
               f.rolling_3m_mean, f.rolling_6m_mean, f.coeff_variation_3m, f.mom_change_pct, f.normalized_premium
        FROM panel p LEFT JOIN wide w ON p.region = w.region AND p.month = w.month
        LEFT JOIN feats f ON p.segment_id = f.segment_id AND p.month = f.month""",
    "filled": f"""
        SELECT segment_id, month, {', '.join(
            f"coalesce(last_value({c} IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
            f"first_value({c} IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}"
            for c in REGRESSOR_COLUMNS)}
        FROM joined WINDOW w AS (PARTITION BY segment_id ORDER BY month)""",
    "diffs": """
        SELECT segment_id, month, y, d, d * d AS d2,
               lag(d * d) OVER (PARTITION BY segment_id ORDER BY month) AS l2,
               row_number() OVER (PARTITION BY segment_id ORDER BY month DESC) AS back
        FROM (SELECT segment_id, month, CAST(claims_count AS DOUBLE) AS y,
                     CAST(claims_count - lag(claims_count, 12) OVER (PARTITION BY segment_id ORDER BY month) AS DOUBLE) AS d
              FROM panel)""",
    "stats": """
        SELECT segment_id, sd, mape, exp(-m * r * r / 2) AS p, CASE WHEN r > 0 THEN r END AS alpha
        FROM (SELECT segment_id, stddev_pop(d) AS sd,
                     avg(abs(d) / greatest(y, 1.0) * 100) FILTER (back <= 12) AS mape, count(l2) AS m,
                     CASE WHEN stddev_pop(d2) FILTER (l2 IS NOT NULL) > 0 AND stddev_pop(l2) > 0 THEN corr(d2, l2) END AS r
              FROM diffs GROUP BY 1)""",
    "future": """
        SELECT segment_id, h AS month_offset, CAST(m + to_months(CAST(h AS INTEGER)) AS DATE) AS month
        FROM (SELECT segment_id, max(month) AS m, unnest(range(1, 19)) AS h FROM panel GROUP BY 1)""",
    "naive18": """
        SELECT f.segment_id, f.month_offset, f.month, d.y AS forecast_mean, d.y - 1.96 * s.sd AS forecast_lo95,
               d.y + 1.96 * s.sd AS forecast_hi95, s.mape
        FROM future f JOIN stats s ON f.segment_id = s.segment_id
        LEFT JOIN diffs d ON d.segment_id = f.segment_id AND d.back = 12 - (f.month_offset - 1) % 12""",
    "naive": """
        SELECT r.*, s.sd AS cond_volatility, s.p AS arch_lm_pvalue, s.alpha AS garch_alpha,
               CASE WHEN s.alpha IS NOT NULL THEN 0.0 END AS garch_beta, NULL::DOUBLE AS aic,
               NULL::DOUBLE AS mape_sarimax, NULL::VARCHAR AS exog_vars, 'seasonal_naive' AS method
        FROM (SELECT segment_id, month, 'actual' AS record_type, y AS claims_count, NULL::DOUBLE AS forecast_mean,
                     NULL::DOUBLE AS forecast_lo95, NULL::DOUBLE AS forecast_hi95, NULL::DOUBLE AS mape,
                     NULL::DOUBLE AS mape_baseline FROM diffs
              UNION ALL
              SELECT segment_id, month, 'forecast', NULL, forecast_mean, forecast_lo95, forecast_hi95, mape, mape
              FROM naive18 WHERE month_offset <= 12) r
        JOIN stats s ON r.segment_id = s.segment_id""",
    "ols": """
        SELECT segment_id, regr_slope(y, t) AS slope, regr_intercept(y, t) AS intercept, regr_r2(y, t) AS r_squared,
               CASE WHEN avg(y) > 0 THEN regr_slope(y, t) * 12 / avg(y) * 100 ELSE 0.0 END AS annualized_growth_pct
        FROM (SELECT segment_id, CAST(claims_count AS DOUBLE) AS y,
                     CAST(row_number() OVER (PARTITION BY segment_id ORDER BY month) - 1 AS DOUBLE) AS t FROM panel)
        GROUP BY 1""",
    "scen": f"""
        SELECT * FROM (VALUES {', '.join(
            f"('{s.scenario}', '{s.rule}', {float(s.ldf_multiplier)!r}::DOUBLE, {float(s.inflation_adj)!r}::DOUBLE)"
            for s in cl.SCENARIOS)}) t(scenario, rule, m, r)""",
    "scen_ldf": f"""
        SELECT scenario, product_line, dev_lag, ldf,
               ldf * CASE WHEN hit THEN pow(m, 1.0 / sum(CAST(hit AS INT)) OVER (PARTITION BY scenario, product_line))
                          ELSE 1.0 END
                   * CASE WHEN rule = 'inflation' THEN pow(1.0 + r, 0.25) ELSE 1.0 END AS scenario_ldf
        FROM (SELECT s.*, f.product_line, f.dev_lag, f.ldf,
                     CASE rule WHEN 'late' THEN f.dev_lag >= max(f.dev_lag) OVER (PARTITION BY scenario, product_line) * 0.5
                               WHEN 'auto_tail' THEN product_line IN ({values_list(reg.AUTO)})
                                    AND f.dev_lag >= {reg.QUARTER_TAIL_LAG}
                               WHEN 'all' THEN true ELSE false END AS hit
              FROM factors f, scen s)""",
    "fitted": "SELECT " + ", ".join(
        f"max(ibnr_M) FILTER (product_line = '{line}') AS mean_ibnr_{role}_M, "
        f"max(cv) FILTER (product_line = '{line}') AS cv_{role}"
        for line, role in reg.SCORER_LINE.items()
    ) + " FROM vol",
    "requests": "SELECT request_id, scenario, n_replications, "
    + ", ".join(
        f"coalesce({'a.cv_homeowners, ' if c == 'cv_homeowners' else ''}f.{c}, {v!r}::DOUBLE) AS {c}"
        for c, v in sim.SCORER_DEFAULTS.items() if c not in ("ldf_multiplier", "inflation_adj")
    )
    + """, ldf_multiplier, inflation_adj
        FROM (VALUES ('r1', 'baseline', 5000, NULL, 1.0::DOUBLE, 0.0::DOUBLE),
                     ('r2', 'adverse_development', 5000, NULL, 1.2, 0.0),
                     ('r3', 'judicial_inflation', 5000, 0.25, 1.0, 0.0),
                     ('r4', 'pandemic_tail', 10, NULL, 1.1, 0.0),
                     ('r5', 'superimposed_inflation', 5000, NULL, 1.0, 0.05))
             a(request_id, scenario, n_replications, cv_homeowners, ldf_multiplier, inflation_adj), fitted f""",
    "shocked": "SELECT request_id, scenario, greatest(1000, least(n_replications, 500000)) AS n_used, "
    + ", ".join(
        f"""mean_ibnr_{x}_M * CASE scenario
                WHEN 'adverse_development' THEN CASE WHEN ldf_multiplier > 1.0 THEN ldf_multiplier ELSE 1.2 END
                WHEN 'judicial_inflation' THEN {'1.3' if x.endswith('auto') else '1.0'}
                WHEN 'pandemic_tail' THEN 1.1
                WHEN 'superimposed_inflation' THEN 1.0 + CASE WHEN inflation_adj > 0 THEN inflation_adj ELSE 0.03 END
                ELSE 1.0 END AS mean_{x},
            cv_{x} * CASE scenario WHEN 'adverse_development' THEN 1.15
                WHEN 'judicial_inflation' THEN {'1.1' if x.endswith('auto') else '1.0'}
                WHEN 'pandemic_tail' THEN 1.2 ELSE 1.0 END AS c_{x}"""
        for x in sim.SCORER_LINES
    ) + " FROM requests",
    "normals": "SELECT rep, " + ", ".join(f"{normal('42', 'rep', j + 1)} AS z{j}" for j in range(4))
    + " FROM (SELECT unnest(range(0, 5000)) AS rep)",
}

_LOWER = np.linalg.cholesky(np.array(sim.SCORER_CORRELATION))


def _scorer_total() -> str:
    terms = []
    for i, x in enumerate(sim.SCORER_LINES):
        z = " + ".join(f"z{j} * {float(_LOWER[i, j])!r}" for j in range(i + 1))
        s2 = f"ln(1.0 + c_{x} * c_{x})"
        terms.append(f"exp(ln(mean_{x}) - {s2} / 2 + sqrt({s2}) * ({z}))")
    return " + ".join(terms)


CTES["draws"] = (
    f"SELECT request_id, scenario, n_used, {_scorer_total()} AS x FROM shocked JOIN normals ON rep < n_used"
)
CTES["scores"] = f"""
        SELECT d.request_id, d.scenario, d.n_used AS n_replications_used, {rnd('avg(x)', 3)} AS best_estimate_M,
               {rnd('quantile_cont(x, 0.95)', 3)} AS var_95_M, {rnd('any_value(q99)', 3)} AS var_99_M,
               {rnd('quantile_cont(x, 0.995)', 3)} AS var_995_M, {rnd('avg(x) FILTER (x >= q99)', 3)} AS cvar_99_M,
               {rnd('quantile_cont(x, 0.995) - avg(x)', 3)} AS reserve_risk_capital_M,
               {rnd('max(x)', 3)} AS max_ibnr_M
        FROM draws d JOIN (SELECT request_id, quantile_cont(x, 0.99) AS q99 FROM draws GROUP BY 1) q
          ON d.request_id = q.request_id
        GROUP BY 1, 2, 3"""
CTES["lognormal"] = f"""
        SELECT *, ln(best_estimate_M) - sigma * sigma / 2 AS mu
        FROM (SELECT *, CASE WHEN disc > 0 AND {reports.Z99} - sqrt(greatest(disc, 0.0)) > 0
                             THEN {reports.Z99} - sqrt(greatest(disc, 0.0)) ELSE 0.30 END AS sigma
              FROM (SELECT request_id, best_estimate_M, var_99_M, var_995_M,
                           {reports.Z99 * reports.Z99!r} - 2.0 * ln(var_99_M / best_estimate_M) AS disc
                    FROM scores WHERE best_estimate_M > 0 AND var_99_M > best_estimate_M))"""
CTES["seg_month"] = f"""
        SELECT {case_map('product_line', reg.SEGMENT_OF)} AS seg, month, sum(total_incurred) AS inc,
               CAST(sum(claims_count) AS DOUBLE) AS n
        FROM panel WHERE product_line IN ({values_list(reg.SEGMENT_OF)}) GROUP BY 1, 2"""
CTES["line_cv"] = """
        SELECT split_part(segment_id, '__', 1) AS product_line,
               avg(cond_volatility) / greatest(avg(claims_count), 1.0) AS cv
        FROM naive WHERE record_type = 'actual' AND cond_volatility IS NOT NULL GROUP BY 1"""
CTES["dev_params"] = f"""
        SELECT product_line, {rnd('sum(inc * dev_lag) / sum(inc)', 3)} AS scale, 1.2 AS shape, max(dev_lag) AS max_lag
        FROM (SELECT *, cumulative_paid - coalesce(lag(cumulative_paid) OVER (PARTITION BY product_line, accident_month
                     ORDER BY dev_lag), 0.0) AS inc FROM line_tri) GROUP BY 1"""

_SUMMARY = (
    f"sum(claims_count) AS total_claims, {rnd('avg(claims_count)', 1)} AS avg_monthly_claims,"
    f" {rnd('sum(total_incurred)', 2)} AS total_incurred, {rnd('avg(avg_severity)', 2)} AS avg_severity,"
    f" {rnd('sum(earned_premium)', 2)} AS total_premium"
)


def _money_label(x: str) -> str:
    return (
        f"CASE WHEN abs({x}) >= 1000 THEN '$' || printf('%.1f', {rnd(f'({x}) / 1000', 1)}) || 'B' "
        f"ELSE '$' || printf('%.1f', {rnd(x, 1)}) || 'M' END"
    )


def _rule_counts(source: str, table: str, rules: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{source}' AS source, '{n}' AS rule, '{a}' AS action, count(*) FILTER ({p}) AS passed, "
        f"count(*) - count(*) FILTER ({p}) AS failed FROM {table}"
        for n, a, p in rules
    )


_VALID = f"product_line IN ({values_list(reg.VALID_LINES)})"


def _pit() -> str:
    return f"""
        SELECT o.*, f.month_ts, f.rolling_3m_mean, f.rolling_12m_mean, f.coeff_variation_3m, f.loss_ratio_trend_3m,
               f.month_of_year
        FROM (SELECT event_id AS observation_id, s.segment_id,
                     CAST(CAST(DATE '1996-02-01' + to_months(CAST(event_id % 48 AS INTEGER)) AS DATE)
                          + CAST(day(ts) - 1 AS INTEGER) AS TIMESTAMP) AS obs_ts, value AS target_loss_ratio
              FROM events JOIN (SELECT segment_id, row_number() OVER (ORDER BY segment_id) AS i
                                FROM (SELECT DISTINCT segment_id FROM monthly)) s ON s.i = user_id %
                     (SELECT count(DISTINCT segment_id) FROM monthly) + 1) o
        ASOF LEFT JOIN feats f ON o.segment_id = f.segment_id AND o.obs_ts >= f.month_ts"""


def _explode_claims() -> str:
    k = "k"
    types = {"AUTOMOBILE": "['A','B','C']", "BUILDING": "['D','E']", "FURNITURE": "['F']",
             "HOUSEHOLD": "['G','H','I','J']", "MACHINERY": "['K','L']"}
    return f"""
        SELECT product_line, region, loss_date, claim_amount,
               {rnd(f"claim_amount / loss_ratio * (0.85 + {uniform(k, 'i', 5)} * 0.30)", 2)} AS monthly_prem_exposure,
               types[CAST(floor({uniform(k, 'i', 6)} * len(types)) AS INT) + 1] AS claim_type
        FROM (SELECT *, {rnd(f"exp(mu + sd * {normal(k, 'i', 1)})", 2)} AS claim_amount,
                     {_rule_case('product_line', types, 'NULL')} AS types
              FROM (SELECT product_line, region, CAST(month AS VARCHAR) AS loss_date, loss_ratio,
                           {key32(42, 'product_line', 'region', 'month')} AS k,
                           ln(avg_severity) - ln(1.25) / 2 AS mu, sqrt(ln(1.25)) AS sd,
                           unnest(range(1, claims_count + 1)) AS i FROM monthly))"""


def _weibull(lag: str, max_lag: str = "max_lag") -> str:
    inside = rnd(f"1.0 - exp(-pow({lag} / scale, shape))", 6)
    return f"CASE WHEN {lag} <= {max_lag} THEN {inside} ELSE 1.0 END"


def _explode_reserves() -> str:
    return f"""
        SELECT *, {rnd('greatest(0.0, cumulative_incurred - cumulative_paid)', 2)} AS case_reserve
        FROM (SELECT segment_id, product_line, region, accident_month, dev_lag,
                     CAST(CAST(CAST(accident_month AS DATE) + to_months(CAST(dev_lag AS INTEGER)) AS DATE) AS VARCHAR)
                         AS development_month,
                     {rnd(f"ultimate * least(({_weibull('dev_lag')}) * (0.85 + {uniform('k', 'dev_lag', 1)} * 0.30) * infl, 1.0)", 2)}
                         AS cumulative_paid,
                     {rnd(f"ultimate * (0.95 + {uniform('k', 'dev_lag', 2)} * 0.10) * infl", 2)} AS cumulative_incurred,
                     CASE WHEN dev_lag = 1 THEN 'INSERT' ELSE 'UPDATE' END AS op
              FROM (SELECT *, pow(1.03, year(CAST(accident_month AS DATE)) + dev_lag / 12.0::DOUBLE - 1995.0) AS infl
                    FROM (SELECT l.segment_id, l.product_line, l.region, l.accident_month,
                                 {rnd('l.cumulative_incurred', 2)} AS ultimate, p.scale, p.shape, p.max_lag,
                                 {key32(2024, 'l.segment_id', 'l.accident_month')} AS k,
                                 unnest(range(1, l.dev_lag + 1)) AS dev_lag
                          FROM latest_seg l JOIN dev_params p ON l.product_line = p.product_line)))"""


def _seasonal_panel() -> str:
    season = "CASE month(month) " + " ".join(
        f"WHEN {m + 1} THEN {f}" for m, f in enumerate(generators.SEASONALITY)
    ) + " END"
    return f"""
        SELECT segment_id, product_line, region, month, round(c) AS claims_count, {rnd('c * sev', 2)} AS total_incurred,
               {rnd('sev', 2)} AS avg_severity, {rnd('c * sev / u', 2)} AS earned_premium,
               {rnd('CASE WHEN c * sev / u > 0 THEN c * sev / (c * sev / u) END', 4)} AS loss_ratio
        FROM (SELECT *, greatest(base * (1.0 + 0.003 * i) * CAST({season} AS DOUBLE) * (1.0 + 0.08 * {normal('k', 'i', 1)}), 0.0) AS c,
                     5000.0 + {uniform('k', 'i', 4)} * 7000.0 AS sev, 0.55 + {uniform('k', 'i', 5)} * 0.25 AS u
              FROM (SELECT *, CAST(DATE '2019-01-01' + to_months(CAST(i AS INTEGER)) AS DATE) AS month
                    FROM (SELECT segment_id, product_line, region, {rnd('avg(claims_count)', 4)} AS base,
                                 {key32(42, 'segment_id')} AS k, unnest(range(0, 84)) AS i
                          FROM monthly GROUP BY 1, 2, 3)))"""


def _arch_lm(lags: int = 4) -> str:
    """The normal equations of the lagged squares by a self-join on the row number, solved by the same factors."""
    names = [f"x{k}" for k in range(lags)] + ["y"]
    pairs = [(i, j) for i in range(lags + 1) for j in range(i, lags + 1)]
    steps = ["SELECT * FROM (SELECT segment_id, count(*) AS n, " + ", ".join(
        f"sum(({names[i]} - m{i}) * ({names[j]} - m{j})) AS c_{i}_{j}" for i, j in pairs
    ) + " FROM (SELECT *, " + ", ".join(
        f"avg({c}) OVER (PARTITION BY segment_id) AS m{i}" for i, c in enumerate(names)
    ) + " FROM lagged) GROUP BY segment_id)"]
    for j in range(lags):
        inner = " ".join(f"- l_{j}_{p} * l_{j}_{p}" for p in range(j))
        steps.append(f"SELECT *, CASE WHEN c_{j}_{j} {inner} > c_{j}_{j} * 1e-12 THEN sqrt(c_{j}_{j} {inner}) END AS l_{j}_{j} FROM ({steps[-1]})")
        below = ", ".join(
            f"(c_{j}_{i} {' '.join(f'- l_{i}_{p} * l_{j}_{p}' for p in range(j))}) / l_{j}_{j} AS l_{i}_{j}"
            for i in range(j + 1, lags + 1)
        )
        steps.append(f"SELECT *, {below} FROM ({steps[-1]})")
    square = " + ".join(f"l_{lags}_{p} * l_{lags}_{p}" for p in range(lags))
    joins = " ".join(
        f"JOIN e AS e{k + 1} ON e{k + 1}.segment_id = e.segment_id AND e{k + 1}.i = e.i - {k + 1}" for k in range(lags)
    )
    return f"""
        WITH e AS (SELECT segment_id, d2 AS e, row_number() OVER (PARTITION BY segment_id ORDER BY month) AS i FROM diffs),
        lagged AS (SELECT e.segment_id, e.e AS y, {', '.join(f'e{k + 1}.e AS x{k}' for k in range(lags))} FROM e {joins}
                   WHERE e.e IS NOT NULL AND {' AND '.join(f'e{k + 1}.e IS NOT NULL' for k in range(lags))}),
        solved AS (SELECT *, CASE WHEN n >= {lags + 3} AND c_{lags}_{lags} > 0 THEN ({square}) / c_{lags}_{lags} END AS r2
                   FROM ({steps[-1]}))
        SELECT segment_id, coalesce(n, 0) AS n, r2, n * r2 AS lm, exp(-n * r2 / 2) * (1.0 + n * r2 / 2) AS p_value
        FROM (SELECT DISTINCT segment_id FROM panel) LEFT JOIN solved USING (segment_id)"""


def _origins() -> str:
    """Each origin's line fitted by a join with all rows before it."""
    return f"""
        WITH x AS (SELECT p.segment_id, p.month, CAST(p.claims_count AS DOUBLE) AS y, f.{reg.HOLDOUT_REGRESSOR} AS x
                   FROM panel p JOIN filled f ON p.segment_id = f.segment_id AND p.month = f.month),
        z AS (SELECT *, y - lag(y, 12) OVER w AS d, x - lag(x, 12) OVER w AS dx,
                     row_number() OVER (PARTITION BY segment_id ORDER BY month DESC) AS back
              FROM x WINDOW w AS (PARTITION BY segment_id ORDER BY month)),
        line AS (SELECT o.segment_id, o.month, avg(b.d) AS md, avg(b.dx) AS mx, count(*) AS n,
                        CASE WHEN count(*) * sum(b.dx * b.dx) - sum(b.dx) * sum(b.dx) > 1e-9 * count(*) * sum(b.dx * b.dx)
                             THEN (count(*) * sum(b.dx * b.d) - sum(b.dx) * sum(b.d))
                                  / (count(*) * sum(b.dx * b.dx) - sum(b.dx) * sum(b.dx)) ELSE 0.0 END AS slope
                 FROM z o JOIN z b ON o.segment_id = b.segment_id AND b.month < o.month
                 WHERE o.back <= 12 AND o.d IS NOT NULL AND o.dx IS NOT NULL AND b.d IS NOT NULL AND b.dx IS NOT NULL
                 GROUP BY 1, 2),
        scored AS (SELECT z.*, y - d AS seasonal, y - d + md + slope * (dx - mx) AS regressor
                 FROM z JOIN line USING (segment_id, month))
        SELECT segment_id, month, 'seasonal' AS model, y AS actual, seasonal AS predicted, y - seasonal AS error FROM scored
        UNION ALL
        SELECT segment_id, month, 'regressor', y, regressor, y - regressor FROM scored"""


def _growth() -> str:
    prop = [x for x, s in reg.SEGMENT_OF.items() if s == "Property"]
    auto = [x for x, s in reg.SEGMENT_OF.items() if s == "Auto"]

    def blend(lines: list[str]) -> str:
        total = sum(reg.WEIGHTS[x] for x in lines)
        inner = " + ".join(
            f"{reg.WEIGHTS[x]} * coalesce(max(g) FILTER (product_line = '{x}'), 1.0)" for x in lines
        )
        return f"({inner}) / {total}"

    return f"""
        SELECT *, (property_growth + auto_growth) / 2 AS liability_growth
        FROM (SELECT month, {blend(prop)} AS property_growth, {blend(auto)} AS auto_growth
              FROM (SELECT f.product_line, f.month,
                           least(greatest(f.v / greatest(coalesce(b.b, 1.0), 1e-6), 0.5), 2.0) AS g
                    FROM (SELECT split_part(segment_id, '__', 1) AS product_line, month, sum(forecast_mean) AS v
                          FROM naive WHERE record_type = 'forecast' GROUP BY 1, 2) f
                    LEFT JOIN (SELECT product_line, avg(v) AS b
                               FROM (SELECT product_line, month, sum(claims_count) AS v, row_number() OVER
                                            (PARTITION BY product_line ORDER BY month DESC) AS rn
                                     FROM panel GROUP BY 1, 2) WHERE rn <= 12 GROUP BY 1) b
                      ON f.product_line = b.product_line) GROUP BY 1)"""


def _segment_means() -> str:
    def mean(seg: str) -> str:
        return rnd(
            f"(SELECT avg(inc) * 12 / 1e6 FROM (SELECT inc FROM seg_month WHERE seg = '{seg}' ORDER BY month DESC LIMIT 12))", 2
        )

    return f"""
        SELECT *, {rnd('(property_mean_M + auto_mean_M) * 0.5', 2)} AS liability_mean_M
        FROM (SELECT {mean('Property')} AS property_mean_M, {mean('Auto')} AS auto_mean_M)"""


def _segment_cvs() -> str:
    def line(x: str) -> str:
        return f"coalesce(max(cv) FILTER (product_line = '{x}'), {reg.CV_DEFAULTS[x]})"

    p = f"({line('HOUSEHOLD')} + {line('BUILDING')}) / 2.0"
    a = f"({line('AUTOMOBILE')} + {line('MACHINERY')}) / 2.0"

    def clip(x: str) -> str:
        return f"least(greatest({x}, 0.15), 0.60)"

    return f"""SELECT {clip('p')} AS property_cv, {clip('a')} AS auto_cv, {clip('(p + a) * 0.5')} AS liability_cv
               FROM (SELECT {p} AS p, {a} AS a FROM line_cv)"""


def _moments() -> str:
    sev = "inc / greatest(n, 1)"
    log = f"CASE WHEN {sev} > 0 THEN ln({sev}) END"
    return f"""
        WITH m AS (SELECT seg AS mc_segment, {rnd('avg(n)', 1)} AS freq_lambda,
                          {rnd('avg(n) * avg(n) / greatest(var_pop(n) - avg(n), 1e-6)', 2)} AS freq_k,
                          {rnd(f'avg({log})', 4)} AS sev_mu, {rnd(f'stddev_pop({log})', 4)} AS sev_sigma
                   FROM seg_month GROUP BY 1)
        SELECT * FROM m UNION ALL
        SELECT 'Liability', {rnd('avg(freq_lambda)', 1)}, {rnd('avg(freq_k)', 2)}, {rnd('avg(sev_mu)', 4)},
               {rnd('avg(sev_sigma)', 4)} FROM m"""


# a month that one side lacks is no pair; greatest alone would turn it into 1
_LOG_CORR = """
        SELECT corr(p, a) AS corr_prop_auto, corr(p, l) AS corr_prop_liab, corr(a, l) AS corr_auto_liab
        FROM (SELECT CASE WHEN p IS NOT NULL THEN ln(greatest(p, 1.0)) END AS p,
                     CASE WHEN a IS NOT NULL THEN ln(greatest(a, 1.0)) END AS a,
                     CASE WHEN p + a IS NOT NULL THEN ln(greatest((p + a) * 0.5, 1.0)) END AS l
              FROM (SELECT month, sum(inc) FILTER (seg = 'Property') AS p, sum(inc) FILTER (seg = 'Auto') AS a
                    FROM seg_month GROUP BY 1))"""


def _preset_grid() -> str:
    rows = ", ".join(
        f"('{n}', '{sev}', '{rule}', least({ldf}::DOUBLE * {m}::DOUBLE, {reports.MAX_LDF}::DOUBLE),"
        f" least({c}::DOUBLE * {m}::DOUBLE, {reports.MAX_CV}::DOUBLE), {infl}::DOUBLE * {m}::DOUBLE)"
        for n, ldf, infl, c, rule in reports.PRESETS
        for sev, m in reports.SEVERITIES
    )
    return f"""
        SELECT v.product_line, v.cv AS base_cv, p.*, least({rnd('v.cv * p.cv_multiplier', 2)}, 1.0) AS line_cv
        FROM vol v, (VALUES {rows}) p(preset, severity, scenario, ldf_multiplier, cv_multiplier, inflation_adj)"""


def _mct_lines() -> str:
    rf = case_map("o.product_line", reg.RESERVE_FACTORS, str(reports.DEFAULT_RESERVE_FACTOR))
    pf = case_map("o.product_line", reg.PREMIUM_FACTORS, str(reports.DEFAULT_PREMIUM_FACTOR))
    return f"""
        SELECT *, outstanding_reserves * reserve_factor AS reserve_charge,
               annual_earned_premium * premium_factor AS premium_charge
        FROM (SELECT o.product_line, replace(o.product_line, '_', ' ') AS line_of_business, o.outstanding_reserves,
                     CAST({rf} AS DOUBLE) AS reserve_factor,
                     coalesce(p.annual_earned_premium, 0.0) AS annual_earned_premium,
                     CAST({pf} AS DOUBLE) AS premium_factor
              FROM outstanding o LEFT JOIN premium p ON o.product_line = p.product_line)"""


def _mct_capital() -> str:
    return f"""
        SELECT *, undiversified - capital_required AS diversification_credit,
               CASE WHEN capital_required > 0 THEN capital_available * 100 / capital_required ELSE 0.0 END AS mct_ratio_pct
        FROM (SELECT r AS reserve_charge, p AS premium_charge, r + p AS undiversified,
                     sqrt(r * r + p * p + 2 * {reports.DIVERSIFICATION} * r * p) AS capital_required,
                     (SELECT sum(annual_earned_premium) FROM premium) * {reports.CAPITAL_SHARE} AS capital_available
              FROM (SELECT sum(reserve_charge) AS r, sum(premium_charge) AS p FROM ({_mct_lines()})))"""


def _quantile_rows(group: str, table: str, column: str, probs) -> str:
    keys = f"{group}, " if group else ""
    by = f" GROUP BY {group}" if group else ""
    return " UNION ALL ".join(
        f"SELECT {keys}{p}::DOUBLE AS prob, quantile_cont({column}, {p}) AS quantile FROM {table}{by}" for p in probs
    )


def _delta() -> str:
    cols = ", ".join(f"s.{m}, s.{m} - b.{m} AS delta_{m}" for m in reports.DELTA_METRICS)
    return f"""SELECT s.request_id, {cols}, (s.var_995_M / greatest(b.var_995_M, 0.01) - 1) * 100 AS var_995_lift_pct
               FROM scores s, (SELECT * FROM scores WHERE request_id = 'r1') b"""


_NOTES = """(SELECT event_id, 'S' || CAST(user_id % 25 AS VARCHAR) AS segment_id, event_type AS note,
             'analyst_' || CAST(user_id AS VARCHAR) AS analyst, ts AS created_at FROM events)"""
_STATS_RAW = """(SELECT 'P' || CAST(user_id % 13 AS VARCHAR) AS geo, CAST(CAST(ts AS DATE) AS VARCHAR) AS ref_date,
             CASE WHEN value < 2 OR value > 40 THEN NULL ELSE value END AS value,
             CASE WHEN value > 25 THEN 'Index' ELSE 'Percent' END AS uom, event_type FROM events)"""
_GEOS = values_list(f"P{i}" for i in range(10))

BODIES: dict[str, str] = {
    "claims_events": "SELECT * FROM claims",
    "reserve_events": "SELECT * FROM reserves",
    "macro_events": "SELECT * FROM macro",
    "statistics_indicators": f"""
        SELECT '14-10-0287' AS source_table, geo AS province, ref_date, 'unemployment_rate' AS indicator_name,
               avg(value) AS value, (SELECT uom FROM {_STATS_RAW} WHERE geo IN ({_GEOS}) GROUP BY uom
                                     ORDER BY count(*) DESC, uom LIMIT 1) AS unit, 'b1' AS batch_id
        FROM {_STATS_RAW} WHERE geo IN ({_GEOS}) AND event_type = 'view'
        GROUP BY geo, ref_date HAVING avg(value) IS NOT NULL""",
    "indicator_profile": """
        SELECT indicator_name, count(*) AS rows, count(DISTINCT province) AS provinces, min(ref_date) AS first_date,
               max(ref_date) AS last_date FROM macro GROUP BY 1""",
    "explode_claims": _explode_claims(),
    "weibull_pattern": f"""
        SELECT product_line, dev_lag, {_weibull('dev_lag')} AS paid_share
        FROM (SELECT *, unnest(range(1, 21)) AS dev_lag FROM dev_params)""",
    "explode_reserves": _explode_reserves(),
    "seasonal_panel": _seasonal_panel(),
    "replicate": """
        SELECT segment_id || '_r' || lpad(CAST(k AS VARCHAR), 3, '0') AS segment_id, month, claims_count
        FROM monthly, (SELECT unnest(range(0, 5)) AS k)""",
    "recent_annotations": f"SELECT * FROM {_NOTES} ORDER BY created_at DESC, event_id DESC LIMIT 20",
    "recent_annotations_by_segment": f"""
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY segment_id ORDER BY created_at DESC, event_id DESC) AS rn
                       FROM {_NOTES}) WHERE rn <= 20""",
    "readonly_sql": """
        SELECT product_line, region, sum(claims_count) AS total_claims FROM monthly GROUP BY 1, 2
        ORDER BY total_claims DESC, product_line, region LIMIT 20""",
    "bronze_claims": f"SELECT * FROM claims WHERE claim_amount >= 0 AND {_VALID}",
    "bronze_macro": "SELECT * FROM bronze",
    "quality_report": " UNION ALL ".join(
        [
            _rule_counts("claims", "claims", [
                ("valid_amount", "drop", "claim_amount >= 0"), ("valid_product", "drop", _VALID)]),
            _rule_counts("reserves", "reserves", [
                ("valid_paid", "drop", "cumulative_paid >= 0"), ("valid_incurred", "drop", "cumulative_incurred >= 0"),
                ("valid_reserve", "drop", "case_reserve >= 0"), ("valid_product", "drop", _VALID),
                ("valid_dev_lag", "warn", "dev_lag BETWEEN 1 AND 12")]),
            _rule_counts("macro", "macro", [
                ("valid_value", "drop", "value IS NOT NULL"),
                ("valid_indicator", "drop", "indicator_name IN ('unemployment_rate', 'hpi_index', 'housing_starts')")]),
        ]
    ),
    "bronze_stream": "SELECT * FROM bronze",
    "scd2_macro": "SELECT * FROM history",
    "scd2_macro_every_event": """
        SELECT *, ingested_at AS start_at, lead(ingested_at) OVER (PARTITION BY province, ref_date, indicator_name
               ORDER BY ingested_at) AS end_at FROM bronze""",
    "scd2_stream": "SELECT * FROM history",
    "scd2_restart": "SELECT * FROM history",
    "scd2_growing": "SELECT * FROM history",
    "delta_monthly": f"""
        SELECT * FROM (SELECT * FROM monthly WHERE {_VALID})
        JOIN (SELECT product_line || '__' || region AS segment_id, CAST(date_trunc('month', order_date) AS DATE) AS month,
                     min(claim_amount) AS smallest_claim, max(claim_amount) AS largest_claim
              FROM claims GROUP BY 1, 2) USING (segment_id, month)""",
    "snapshot_publish": f"""
        SELECT region, {_SUMMARY}, 0 AS seen_after_failure, 0 AS seen_pinned,
               count(DISTINCT product_line) AS product_lines FROM monthly GROUP BY 1""",
    "full_refresh": f"""
        SELECT 'full' AS refresh, * FROM monthly WHERE {_VALID}
        UNION ALL
        SELECT 'current', * FROM monthly WHERE {_VALID} AND product_line <> '{reg.VALID_LINES[0]}'""",
    "reserve_history": f"""
        SELECT *, development_month AS start_at,
               lead(development_month) OVER (PARTITION BY segment_id, accident_month, dev_lag
                                             ORDER BY development_month) AS end_at
        FROM (SELECT segment_id, product_line, region, accident_month, dev_lag, development_month, cumulative_paid,
                     cumulative_incurred, case_reserve FROM reserves
              UNION ALL
              SELECT segment_id, product_line, region, accident_month, dev_lag,
                     CAST(CAST(CAST(development_month AS DATE) + INTERVAL 3 MONTH AS DATE) AS VARCHAR),
                     cumulative_paid, cumulative_paid, 0.0 FROM reserves)
        WHERE cumulative_paid >= 0 AND cumulative_incurred >= 0 AND case_reserve >= 0
              AND product_line IN ({values_list(reg.VALID_LINES)})""",
    "reserve_reconciliation": """
        SELECT c_mktsegment AS product_line, count(*) AS n_items,
               sum(round(l_extendedprice * 100.0) / 100.0) AS incurred,
               sum(round(l_extendedprice * (1.0 - l_discount) * 100.0) / 100.0) AS paid
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        GROUP BY 1""",
    "current_macro": "SELECT * FROM history WHERE end_at IS NULL",
    "latest_macro": "SELECT * FROM latest_macro",
    "claims_monthly": "SELECT * FROM monthly",
    "gold_claims": f"SELECT * FROM monthly WHERE {_VALID}",
    "claims_between": "SELECT * FROM monthly WHERE month BETWEEN DATE '1997-01-01' AND DATE '1998-12-01'",
    "split_segments": "SELECT DISTINCT segment_id, product_line, region FROM monthly",
    "rolling_features": "SELECT * FROM rolling",
    "rolling_features_pandas": "SELECT * FROM rolling",
    "rolling_features_bridge": "SELECT * FROM rolling",
    "feature_table": "SELECT * FROM feats",
    "reserve_triangle": """
        SELECT *, cumulative_paid - coalesce(lag(cumulative_paid) OVER w, 0.0) AS incremental_paid,
               cumulative_incurred - coalesce(lag(cumulative_incurred) OVER w, 0.0) AS incremental_incurred
        FROM reserves WHERE cumulative_paid >= 0 AND cumulative_incurred >= 0 AND case_reserve >= 0
        WINDOW w AS (PARTITION BY segment_id, accident_month ORDER BY dev_lag)""",
    "pivot_indicators": "SELECT * FROM pivoted",
    "macro_features": "SELECT * FROM wide",
    "wide_select": "SELECT segment_id, month, claims_count, "
    + ", ".join(f"claims_count * {i}.0 AS col_{i}" for i in range(600)) + " FROM monthly",
    "join_macro": "SELECT * FROM joined",
    "join_features": "SELECT * FROM joined",
    "fill_regressors": "SELECT * FROM filled",
    "hold_regressors": f"""
        SELECT segment_id, {', '.join(f'avg({c}) AS {c}' for c in REGRESSOR_COLUMNS)}
        FROM (SELECT *, row_number() OVER (PARTITION BY segment_id ORDER BY month DESC) AS rn FROM filled)
        WHERE rn <= 3 GROUP BY 1""",
    "future_months": "SELECT * FROM future WHERE month_offset <= 12",
    "point_in_time_join": _pit(),
    "reserve_validation": """
        SELECT l.segment_id, m.month, l.cumulative_incurred, l.cumulative_paid, l.case_reserve, m.claims_count,
               CASE WHEN m.claims_count > 0 THEN l.cumulative_incurred / m.claims_count END AS reserve_adequacy_ratio,
               l.dev_lag
        FROM latest_seg l JOIN monthly m ON l.segment_id = m.segment_id AND CAST(l.accident_month AS DATE) = m.month""",
    "avg_adequacy": """
        SELECT avg(CASE WHEN m.claims_count > 0 THEN l.cumulative_incurred / m.claims_count END) AS avg_adequacy
        FROM latest_seg l JOIN monthly m ON l.segment_id = m.segment_id AND CAST(l.accident_month AS DATE) = m.month""",
    "merge_defaults": "SELECT * FROM requests",
    "overwrite": f"SELECT region, {_SUMMARY} FROM monthly GROUP BY 1",
    "append_batch": """
        SELECT province, ref_date, indicator_name, value,
               CASE WHEN ref_date < '2024-01-15' THEN 'b1' ELSE 'b2' END AS batch_id FROM macro""",
    "export_csv": f"SELECT region, {_SUMMARY} FROM monthly GROUP BY 1",
    "medallion_update": f"""
        SELECT * FROM (SELECT segment_id, month, claims_count, total_incurred FROM monthly WHERE {_VALID})
        JOIN (SELECT segment_id, count(*) AS cells, sum(paid) AS paid
              FROM (SELECT segment_id, cumulative_paid - coalesce(lag(cumulative_paid) OVER (
                               PARTITION BY segment_id, accident_month ORDER BY dev_lag), 0.0) AS paid FROM reserves)
              GROUP BY 1) USING (segment_id)""",
    "regional_summary": f"SELECT region, {_SUMMARY} FROM monthly GROUP BY 1",
    "regional_summary_range": f"""
        SELECT region, {_SUMMARY} FROM monthly WHERE month BETWEEN DATE '1996-01-01' AND DATE '1999-06-01' GROUP BY 1""",
    "regional_product_breakdown": f"SELECT region, product_line, {_SUMMARY} FROM monthly GROUP BY 1, 2",
    "product_region_matrix": "SELECT region, " + ", ".join(
        f"coalesce(sum(claims_count) FILTER (product_line = '{x}'), 0) AS {x}" for x in reg.LINES
    ) + " FROM monthly GROUP BY 1",
    "segment_stats": f"""
        SELECT segment_id, min(month) AS first_month, max(month) AS last_month, count(*) AS num_months,
               {rnd('avg(claims_count)', 1)} AS avg_monthly_claims, {rnd('stddev_samp(claims_count)', 1)} AS stddev_claims,
               min(claims_count) AS min_claims, max(claims_count) AS max_claims FROM monthly GROUP BY 1""",
    "outstanding_reserves": "SELECT * FROM outstanding",
    "annual_premium": "SELECT * FROM premium",
    "trailing_mean": """
        SELECT product_line AS line, avg(v) AS trailing_mean, avg(v) * 12 / 1e6 AS annualized_M
        FROM (SELECT product_line, month, sum(claims_count) AS v,
                     row_number() OVER (PARTITION BY product_line ORDER BY month DESC) AS rn
              FROM panel GROUP BY 1, 2) WHERE rn <= 12 GROUP BY 1""",
    "global_mean": """
        SELECT avg(p) / 1e6 AS mean_premium_M FROM (SELECT month, sum(earned_premium) AS p FROM panel GROUP BY 1)""",
    "global_mean_by_segment": "SELECT avg(earned_premium) / 1e6 AS mean_premium_M FROM panel",
    "table_profile": """
        SELECT sum(n) AS row_count, count(*) AS segment_count, min(n) AS min_months, max(n) AS max_months
        FROM (SELECT segment_id, count(*) AS n FROM monthly GROUP BY 1)""",
    "ols_trend": "SELECT * FROM ols",
    "ols_trend_pandas": "SELECT * FROM ols",
    "top_growth": "SELECT * FROM ols ORDER BY annualized_growth_pct DESC, segment_id LIMIT 10",
    "money_labels": f"""
        SELECT region, replace(region, '_', ' ') AS label, {_money_label('x')} AS incurred_label,
               {_money_label('x * 100')} AS scaled_label
        FROM (SELECT region, {rnd('sum(total_incurred)', 2)} / 1e6 AS x FROM monthly GROUP BY 1)""",
    "claim_quantiles": _quantile_rows(
        "product_line", "claims", "claim_amount", (0.05, 0.25, 0.5, 0.75, 0.95, 0.9, 0.99, 0.995, 0.999)
    ),
    "claim_quantiles_overall": _quantile_rows("", "claims", "claim_amount", (0.75, 0.9, 0.95, 0.99, 0.995)),
    "refined_quantiles": _quantile_rows("", "claims", "claim_amount", (0.05, 0.25, 0.5, 0.75, 0.95)),
    "sketch_quantiles": " UNION ALL ".join(
        f"""SELECT product_line, '{span}' AS span, {p}::DOUBLE AS prob, count(claim_amount) AS "values",
                   quantile_cont(claim_amount, {p}) AS quantile, true AS within_bound
            FROM (SELECT *, substr(loss_date, 1, 7) AS month FROM claims) WHERE {months} GROUP BY 1"""
        for span, months in reg.SKETCH_SPANS.items() for p in (0.05, 0.25, 0.5, 0.75, 0.95)
    ),
    "claim_cvar": """
        SELECT c.region, any_value(q) AS var, avg(claim_amount) FILTER (claim_amount >= q) AS cvar
        FROM claims c JOIN (SELECT region, quantile_cont(claim_amount, 0.99) AS q FROM claims GROUP BY 1) t
          ON c.region = t.region GROUP BY 1""",
    "task_quantile_means": "SELECT product_line, prob, avg(quantile) AS quantile FROM ("
    + _quantile_rows("product_line, claim_type", "claims", "claim_amount / 1e3", (0.95, 0.99)) + ") GROUP BY 1, 2",
    "ruin_probability": """
        SELECT month, avg(CASE WHEN earned_premium * 0.93 - total_incurred < 0 THEN 1.0 ELSE 0.0 END) AS ruin_probability
        FROM monthly GROUP BY 1""",
    "mct_lines": _mct_lines(),
    "mct_capital": _mct_capital(),
    "triangle_pivot": "SELECT product_line, accident_month, " + ", ".join(
        f"sum(cumulative_paid) FILTER (dev_lag = {k}) AS lag_{k}" for k in reg.DIAGONAL_LAGS
    ) + " FROM line_tri GROUP BY 1, 2",
    "line_incrementals": """
        SELECT *, cumulative_paid - coalesce(lag(cumulative_paid) OVER (PARTITION BY product_line, accident_month
               ORDER BY dev_lag), 0.0) AS incremental_paid FROM line_tri""",
    "latest_diagonal": "SELECT * FROM latest_line",
    "adjacent_pairs": "SELECT * FROM pairs",
    "development_factors": "SELECT * FROM factors",
    "segment_development_factors": _factors("seg_pairs", "segment_id"),
    "simple_link_ratios": f"""
        SELECT product_line, dev_lag, next_lag, {rnd('avg(next_paid / cumulative_paid)', 3)} AS avg_link_ratio
        FROM pairs WHERE usable GROUP BY 1, 2, 3""",
    "cdf_to_ultimate": "SELECT * FROM cdfs",
    "ibnr_by_accident": "SELECT * FROM ibnr",
    "ibnr_by_line": """
        SELECT product_line, sum(latest_paid) AS latest_paid, sum(ultimate) AS ultimate, sum(ibnr) AS total_ibnr
        FROM ibnr GROUP BY 1""",
    "pearson_residuals": "SELECT * FROM resid",
    "ldf_volatility": "SELECT * FROM vol",
    "ldf_volatility_risk": """
        SELECT v.product_line, avg_ldf, std_ldf, n_factors, outstanding_reserves,
               std_ldf * outstanding_reserves / 1e6 AS reserve_risk_M
        FROM vol v JOIN outstanding o ON v.product_line = o.product_line""",
    "snapped_cvs": f"""
        SELECT product_line, cv, least(greatest({rnd('round(cv / 0.05) * 0.05', 2)}, 0.05), 1.0) AS snapped_cv FROM vol""",
    "preset_grid": _preset_grid(),
    "scenario_ldfs": "SELECT * FROM scen_ldf",
    "scenario_ibnr": """
        SELECT c.scenario, c.product_line, sum(greatest(l.cumulative_paid * (c.cdf - 1.0), 0.0)) AS ibnr
        FROM latest_line l
        JOIN (SELECT scenario, product_line, dev_lag, product(scenario_ldf) OVER (PARTITION BY scenario, product_line
                     ORDER BY dev_lag ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS cdf FROM scen_ldf) c
          ON l.product_line = c.product_line AND l.dev_lag = c.dev_lag GROUP BY 1, 2""",
    "evolution_ibnr": """
        SELECT month_idx, ibnr, ibnr / max(ibnr) FILTER (month_idx = 0) OVER () * 100 - 100 AS ibnr_vs_baseline
        FROM (SELECT c.month_idx, sum(greatest(l.cumulative_paid * (c.cdf - 1.0), 0.0)) AS ibnr
              FROM latest_line l
              JOIN (SELECT month_idx, product_line, dev_lag, product(ldf * pow(1.0 + 0.005 * month_idx, 1.0 / lags)) OVER (
                               PARTITION BY month_idx, product_line ORDER BY dev_lag
                               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS cdf
                    FROM (SELECT *, count(*) OVER (PARTITION BY product_line) AS lags FROM factors),
                         (SELECT unnest(range(0, 13)) AS month_idx)) c
                ON l.product_line = c.product_line AND l.dev_lag = c.dev_lag
              GROUP BY 1)""",
    "score_scenarios": "SELECT * FROM scores",
    "scenario_delta": _delta(),
    "scenario_ranking": """
        SELECT s.scenario, s.var_995_M, (s.var_995_M / b.var_995_M - 1.0) * 100 AS var_995_vs_baseline
        FROM scores s, (SELECT var_995_M FROM scores WHERE scenario = 'baseline') b""",
    "bootstrap_summary": """
        SELECT avg(best_estimate_M) AS best_estimate, avg(var_99_M) AS var_99, avg(var_995_M) AS var_995,
               avg(cvar_99_M) AS cvar_99, avg(reserve_risk_capital_M) AS reserve_risk_capital,
               max(max_ibnr_M) AS max_ibnr FROM scores""",
    "mack_normal_metrics": "SELECT request_id, best_estimate_M, " + ", ".join(
        f"best_estimate_M + {k} * (best_estimate_M * 0.15) AS {n}" for n, k in reports.MACK_MULTIPLES.items()
    ) + " FROM scores",
    "lognormal_fit": "SELECT * FROM lognormal",
    "density_grid": f"""
        SELECT request_id, i, x, exp(-((ln(x) - mu) / sigma) * ((ln(x) - mu) / sigma) / 2)
               / (x * sigma * {math.sqrt(2 * math.pi)!r}) AS pdf
        FROM (SELECT *, lo + (hi - lo) * i / 999.0 AS x
              FROM (SELECT *, greatest(0.1, best_estimate_M - 6 * (var_995_M - best_estimate_M)) AS lo,
                           var_995_M + 4 * (var_995_M - best_estimate_M) AS hi, unnest(range(0, 1000)) AS i
                    FROM lognormal))""",
    "combined_reserve_risk": f"""
        SELECT a AS reserve_risk_capital_M, b AS ldf_risk_M,
               sqrt(a * a + b * b + 2 * {reports.DIVERSIFICATION} * a * b) AS combined_risk_M
        FROM (SELECT (SELECT reserve_risk_capital_M FROM scores WHERE scenario = 'baseline') AS a,
                     (SELECT sum(std_ldf * outstanding_reserves / 1e6) FROM vol v JOIN outstanding o
                      ON v.product_line = o.product_line) AS b)""",
    "seasonal_naive": "SELECT * FROM naive",
    "forecast_metrics": """
        SELECT avg(mape) AS avg_mape, avg(mape_baseline) AS avg_mape_baseline, avg(mape_sarimax) AS avg_mape_sarimax,
               count(DISTINCT CASE WHEN garch_alpha IS NOT NULL THEN segment_id END) AS garch_seg_count
        FROM naive WHERE record_type = 'forecast'""",
    "forecast_horizon": f"""
        SELECT segment_id, month_offset, {rnd('forecast_mean', 1)} AS forecast_mean,
               {rnd('forecast_lo95', 1)} AS forecast_lo95, {rnd('forecast_hi95', 1)} AS forecast_hi95 FROM naive18""",
    "forecast_panel": """
        SELECT segment_id, avg(forecast_mean) AS mean_forecast, avg(forecast_hi95 - forecast_lo95) / 2 AS mean_half_width,
               arg_min(forecast_hi95 - forecast_lo95, month) AS width_start,
               arg_max(forecast_hi95 - forecast_lo95, month) AS width_end,
               arg_max(forecast_hi95 - forecast_lo95, month) > arg_min(forecast_hi95 - forecast_lo95, month) * 1.5 AS ci_widens
        FROM naive WHERE record_type = 'forecast' GROUP BY 1""",
    "segment_list": "SELECT DISTINCT segment_id FROM naive",
    "segment_forecast": "SELECT * FROM naive WHERE segment_id = 'BUILDING__ASIA'",
    "segment_volatility": "SELECT * FROM naive WHERE segment_id = 'BUILDING__ASIA' AND cond_volatility IS NOT NULL",
    "forecast_by_line": """
        SELECT split_part(segment_id, '__', 1) AS product_line, month, sum(forecast_mean) AS forecast_mean
        FROM naive WHERE record_type = 'forecast' GROUP BY 1, 2""",
    "forecast_by_region": """
        SELECT *, forecast_mean / sum(forecast_mean) OVER (PARTITION BY month) * 100 AS share_pct
        FROM (SELECT split_part(segment_id, '__', 2) AS region, month, sum(forecast_mean) AS forecast_mean
              FROM naive WHERE record_type = 'forecast' GROUP BY 1, 2)""",
    "top_region_shares": """
        SELECT region, 100 * v / sum(v) OVER () AS share_pct
        FROM (SELECT split_part(segment_id, '__', 2) AS region, sum(forecast_mean) AS v FROM naive
              WHERE record_type = 'forecast' AND month = (SELECT max(month) FROM naive) GROUP BY 1)
        ORDER BY share_pct DESC, region LIMIT 3""",
    "insample_errors": """
        SELECT segment_id, avg(abs(d) / greatest(y, 1.0)) * 100 AS mape, sqrt(avg(d * d)) AS rmse
        FROM (SELECT segment_id, y, d FROM diffs UNION ALL SELECT 'all', y, d FROM diffs) WHERE d IS NOT NULL GROUP BY 1""",
    "arch_lm": _arch_lm(),
    "holdout_origins": _origins(),
    "holdout_models": f"""
        SELECT *, rmse = min(rmse) OVER (PARTITION BY segment_id) AS best
        FROM (SELECT segment_id, model, n AS origins, mape, sqrt(sse / n) AS rmse,
                     CASE WHEN sse > 0 THEN n * ln(sse / n) END + 2 * k AS aic,
                     CASE WHEN sse > 0 THEN n * ln(sse / n) END + k * ln(n) AS bic
              FROM (SELECT segment_id, model, count(*) AS n, avg(abs(error) / greatest(actual, 1.0)) * 100 AS mape,
                           sum(error * error) AS sse, CASE model WHEN 'seasonal' THEN 1 ELSE 3 END AS k
                    FROM ({_origins()}) GROUP BY 1, 2))""",
    "holdout_errors": """
        SELECT segment_id, avg(abs(y - p) / greatest(y, 1.0)) * 100 AS mape, sqrt(avg((y - p) * (y - p))) AS rmse
        FROM (SELECT segment_id, y, y - d AS p FROM diffs WHERE back <= 12 AND d IS NOT NULL) GROUP BY 1""",
    "arch_summary": """
        SELECT DISTINCT segment_id, arch_lm_pvalue, garch_alpha, garch_beta, garch_alpha + garch_beta AS persistence,
               coalesce(arch_lm_pvalue < 0.10, false) AS significant FROM naive WHERE record_type = 'forecast'""",
    "arch_counts": """
        SELECT count(*) FILTER (p < 0.10) AS significant_segments, count(p) AS tested_segments,
               count(alpha) AS fitted_segments FROM stats""",
    "cv_by_line": "SELECT * FROM line_cv",
    "growth_by_month": _growth(),
    "segment_means": _segment_means(),
    "log_corr_matrix": _LOG_CORR,
    # the fitted matrix is positive definite here, so only the clip of the repair acts
    "calibrated_portfolio": f"""
        SELECT m.*, c.*, {', '.join(f'least(greatest(k.{x}, -0.99), 0.99) AS {x}'
                                    for x in ('corr_prop_auto', 'corr_prop_liab', 'corr_auto_liab'))}
        FROM ({_segment_means()}) m, ({_segment_cvs()}) c, ({_LOG_CORR}) k""",
    "freq_sev_moments": _moments(),
    "segment_cvs": _segment_cvs(),
}


def _needed(text: str, found: dict[str, None]) -> None:
    for name, body in CTES.items():
        if name not in found and re.search(rf"(\bFROM|\bJOIN|,)\s+{name}\b", text):
            _needed(body, found)
            found[name] = None


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, body in BODIES.items():
        found: dict[str, None] = {}
        _needed(body, found)
        ordered = [n for n in CTES if n in found]
        with_ = ("WITH " + ", ".join(f"{n} AS ({CTES[n]})" for n in ordered) + " ") if ordered else ""
        out[name] = with_ + shaped(body, reg.QUERIES[name][0])
    return out

"""Registered queries of the daily KPI workload (S2, A4-A18, W2-W4, W6, F6-F12, F15,
K1-K5, T2, S8), each with its DuckDB oracle."""

from __future__ import annotations

import datetime as _dt
import os
import uuid

from pyspark.sql import functions as F

from .. import thresholds as T
from ..operators import kpi as K
from ..session import work_dir
from ..sources import bindings as B
from ..sources.rollup import DailyRollup
from ..sources.tables import read_table
from . import reports as Rp
from .registry import query

RUN = T.EVENTS_RUN_DATE
QRUN = T.CLAIMS_RUN_DATE


def _d(days: int, base: _dt.date = RUN) -> str:
    return f"DATE '{base - _dt.timedelta(days=days)}'"


# --------------------------------------------------------------------------- SQL helpers (oracle side)

def var_sql(today: str, base: str) -> str:
    return (f"(CAST(100.0 AS DOUBLE) * (CAST({today} AS DOUBLE) - CAST({base} AS DOUBLE)) "
            f"/ NULLIF(CAST({base} AS DOUBLE), 0.0))")


def pct_sql(num: str, den: str) -> str:
    return f"round(CAST(100.0 AS DOUBLE) * CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0.0), 1)"


def trend_sql(v: str, band: float = T.TREND_STABLE_BAND_PCT) -> str:
    return (f"CASE WHEN {v} IS NULL THEN NULL WHEN abs({v}) < {band} THEN 'stable' "
            f"WHEN {v} > 0 THEN 'up' ELSE 'down' END")


def level_sql(v: str) -> str:
    return (f"CASE WHEN {v} IS NULL THEN NULL WHEN abs({v}) >= {T.ANOMALY_CRIT_PCT} THEN 'critical' "
            f"WHEN abs({v}) >= {T.ANOMALY_WARN_PCT} THEN 'warning' ELSE 'normal' END")


def label_sql(v: str) -> str:
    lv = level_sql(v)
    return (f"CASE WHEN ({lv}) IS NULL THEN NULL WHEN ({lv}) = 'normal' THEN '{T.LABEL_NORMAL}' "
            f"WHEN ({lv}) = 'critical' AND {v} < 0 THEN '{T.LABEL_CRITICAL_DROP}' "
            f"WHEN ({lv}) = 'critical' THEN '{T.LABEL_CRITICAL_HIGH}' "
            f"WHEN {v} < 0 THEN '{T.LABEL_BELOW_AVERAGE}' ELSE '{T.LABEL_ABOVE_AVERAGE}' END")


def grade_sql(v: str) -> str:
    whens = " ".join(f"WHEN {v} >= {m} THEN '{g}'" for m, g in T.COMPLETENESS_GRADES)
    return f"CASE {whens} ELSE '{T.COMPLETENESS_FLOOR_GRADE}' END"


COMPARE_SQL = f"""
cmp AS (
  SELECT section, product, metric, today, yesterday, avg_7d, avg_30d,
    round({var_sql('today', 'yesterday')}, 1) AS var_yesterday_pct, {trend_sql(var_sql('today', 'yesterday'))} AS trend_yesterday,
    round({var_sql('today', 'avg_7d')}, 1) AS var_7d_pct, {trend_sql(var_sql('today', 'avg_7d'))} AS trend_7d,
    round({var_sql('today', 'avg_30d')}, 1) AS var_30d_pct, {trend_sql(var_sql('today', 'avg_30d'))} AS trend_30d,
    {level_sql(var_sql('today', 'avg_7d'))} AS level, {label_sql(var_sql('today', 'avg_7d'))} AS label
  FROM (
    SELECT section, product, metric,
      COALESCE(MAX(CASE WHEN report_date = {_d(0)} THEN value END), 0) AS today,
      MAX(CASE WHEN report_date = {_d(1)} THEN value END) AS yesterday,
      AVG(CASE WHEN report_date >= {_d(7)} AND report_date < {_d(0)} THEN value END) AS avg_7d,
      AVG(CASE WHEN report_date >= {_d(30)} AND report_date < {_d(0)} THEN value END) AS avg_30d
    FROM expected_series FULL JOIN (SELECT * FROM daily_metric WHERE report_date >= {_d(30)} AND report_date <= {_d(0)}) d
      USING (section, product, metric)
    GROUP BY section, product, metric) a)"""

CMP_COLS = ("section, product, metric, today, yesterday, avg_7d, avg_30d, var_yesterday_pct, trend_yesterday, "
            "var_7d_pct, trend_7d, var_30d_pct, trend_30d")
ANOM_COLS = "section, product, metric, today, avg_7d, var_7d_pct, level, label"


def _daily(spark, d):
    return B.daily_metric(spark, d)


def _recent_daily(spark, d):
    """The daily series restricted (at the scan) to the comparison window of the run date."""
    return B.daily_metric(spark, d, start=RUN - _dt.timedelta(days=T.ROLLING_LONG_DAYS), end=RUN)


def _status(spark, d):
    return K.source_status(B.feed_events(spark, d), B.expected_sources(spark, d), RUN)


def _stages(spark, d):
    return K.account_stages(B.account_flags(spark, d))


def _anomalies(spark, d):
    return Rp.kpi_anomalies(_recent_daily(spark, d), RUN, B.expected_series(spark))


# --------------------------------------------------------------------------- sources

@query("source_feed_scan", sql="SELECT * FROM feed_status")
def source_feed_scan(spark, d):
    return _status(spark, d)


@query("records_received_total", sql="SELECT CAST(SUM(records) AS BIGINT) AS total_records FROM feed_status")
def records_received_total(spark, d):
    return Rp.records_received(_status(spark, d))


@query("availability_summary", sql="""
SELECT COUNT(*) FILTER (WHERE available) AS sources_available, COUNT(*) AS sources_expected,
  CASE WHEN COUNT(*) FILTER (WHERE available) = COUNT(*) THEN 'All Systems Operational' ELSE 'Degraded' END
    AS overall_status
FROM feed_status""")
def availability_summary(spark, d):
    return K.availability(_status(spark, d))


# --------------------------------------------------------------------------- windows (W2-W4) and F6-F10

@query("rolling_avg_7d", sql="SELECT report_date, section, product, metric, value, avg_7d FROM series")
def rolling_avg_7d(spark, d):
    return K.rolling_avg(_daily(spark, d), 7)


@query("rolling_avg_30d", sql="SELECT report_date, section, product, metric, value, avg_30d FROM series")
def rolling_avg_30d(spark, d):
    return K.rolling_avg(_daily(spark, d), 30)


@query("prev_day_value", sql="SELECT report_date, section, product, metric, value, yesterday FROM series")
def prev_day_value(spark, d):
    return K.prev_day_value(_daily(spark, d))


def _series(spark, d):
    return K.series_with_baselines(_daily(spark, d))


@query("variance_pct", sql=f"""
SELECT report_date, metric, value, avg_7d, round({var_sql('value', 'avg_7d')}, 1) AS var_7d_pct FROM series""")
def variance_pct(spark, d):
    from ..functions.scalar import variance_pct as vp
    return _series(spark, d).select("report_date", "metric", "value", "avg_7d",
                                    vp("value", "avg_7d").alias("var_7d_pct"))


@query("delta_abs_pct", sql=f"""
SELECT report_date, metric, value, yesterday, value - yesterday AS delta_abs,
  round({var_sql('value', 'yesterday')}, 1) AS delta_pct FROM series""")
def delta_abs_pct(spark, d):
    from ..functions.scalar import delta_abs, variance_pct as vp
    return _series(spark, d).select("report_date", "metric", "value", "yesterday",
                                    delta_abs("value", "yesterday").alias("delta_abs"),
                                    vp("value", "yesterday").alias("delta_pct"))


@query("trend_direction", sql=f"SELECT report_date, metric, {trend_sql(var_sql('value', 'avg_7d'))} AS trend FROM series")
def trend_direction(spark, d):
    from ..functions.scalar import trend_direction as td, variance_raw
    return _series(spark, d).select("report_date", "metric", td(variance_raw("value", "avg_7d")).alias("trend"))


@query("anomaly_level", sql=f"SELECT report_date, metric, {level_sql(var_sql('value', 'avg_7d'))} AS level FROM series")
def anomaly_level(spark, d):
    from ..functions.scalar import anomaly_level as al, variance_raw
    return _series(spark, d).select("report_date", "metric", al(variance_raw("value", "avg_7d")).alias("level"))


@query("anomaly_label", sql=f"SELECT report_date, metric, {label_sql(var_sql('value', 'avg_7d'))} AS label FROM series")
def anomaly_label(spark, d):
    from ..functions.scalar import anomaly_label as lb, anomaly_level as al, variance_raw
    v = variance_raw("value", "avg_7d")
    return _series(spark, d).select("report_date", "metric", lb(al(v), v).alias("label"))


# --------------------------------------------------------------------------- K1-K3, A18, T2

@query("kpi_comparison", sql=f"WITH {COMPARE_SQL} SELECT {CMP_COLS} FROM cmp")
def kpi_comparison(spark, d):
    return Rp.kpi_comparison(_recent_daily(spark, d), RUN, B.expected_series(spark)).select(*[c.strip() for c in CMP_COLS.split(",")])


@query("kpi_comparison_rollup", sql=f"WITH {COMPARE_SQL} SELECT {CMP_COLS} FROM cmp")
def kpi_comparison_rollup(spark, d):
    """K1 from daily rollups: a tenth of the events arrives late, and the report reads the days of its window only."""
    events = read_table(spark, d, "events", "event_id", "ts", "user_id", "event_type")
    late = F.col("event_id") % 10 == 0
    root = work_dir(spark, f"rollup-{uuid.uuid4().hex[:8]}")
    DailyRollup(root, lambda days: B.daily_counts(events.where(~late & B.on_days("ts", days)))).refresh(spark, events.where(~late))
    rollup = DailyRollup(root, lambda days: B.daily_counts(events.where(B.on_days("ts", days))))
    rollup.refresh(spark, events.where(late))
    daily = rollup.read(spark, RUN - _dt.timedelta(days=T.ROLLING_LONG_DAYS), RUN)
    return Rp.kpi_comparison(daily, RUN, B.expected_series(spark)).select(*[c.strip() for c in CMP_COLS.split(",")])


@query("kpi_anomalies", sql=f"WITH {COMPARE_SQL} SELECT {ANOM_COLS} FROM cmp")
def kpi_anomalies(spark, d):
    return _anomalies(spark, d)


@query("health_rollup", sql=f"""
WITH {COMPARE_SQL}
SELECT section, COUNT(*) AS products, COUNT(*) FILTER (WHERE c > 0) AS critical_products,
  CAST(SUM(c) AS BIGINT) AS critical_metrics, CAST(SUM(w) AS BIGINT) AS warning_metrics,
  CASE COUNT(*) FILTER (WHERE c > 0) WHEN 0 THEN 'Healthy' WHEN 1 THEN '1 Anomaly'
    ELSE CAST(COUNT(*) FILTER (WHERE c > 0) AS VARCHAR) || ' Anomalies' END AS status
FROM (SELECT section, product, COUNT(*) FILTER (WHERE level = 'critical') AS c, COUNT(*) FILTER (WHERE level = 'warning') AS w
      FROM cmp GROUP BY section, product) p GROUP BY section""")
def health_rollup(spark, d):
    return Rp.health_rollup(_anomalies(spark, d))


@query("executive_summary", sql=f"""
WITH {COMPARE_SQL}
SELECT (SELECT COUNT(*) FILTER (WHERE available) FROM feed_status) AS sources_available,
  (SELECT COUNT(*) FROM feed_status) AS sources_expected,
  (SELECT CAST(COALESCE(SUM(records), 0) AS BIGINT) FROM feed_status) AS total_records,
  (SELECT COUNT(*) FILTER (WHERE level IN ('warning', 'critical')) FROM cmp) AS anomalies,
  (SELECT COUNT(*) FROM quotes WHERE quoted_on = DATE '{QRUN}' AND status = 'Quotes Sent') AS quotes_sent,
  CASE WHEN (SELECT COUNT(*) FILTER (WHERE available) FROM feed_status) = (SELECT COUNT(*) FROM feed_status)
       THEN 'All Systems Operational' ELSE 'Degraded' END AS overall_status""")
def executive_summary(spark, d):
    return Rp.executive_summary(_status(spark, d), _anomalies(spark, d), B.quotes(spark, d, QRUN, QRUN), QRUN)


@query("action_items", sql=f"""
WITH {COMPARE_SQL}
SELECT 'High' AS priority, 1 AS priority_rank, CAST(NULL AS VARCHAR) AS product, source AS subject,
  'Source data delayed - no records received' AS issue, CAST(NULL AS DOUBLE) AS variance_pct,
  CAST(NULL AS DOUBLE) AS gap
FROM feed_status WHERE NOT available
UNION ALL
SELECT CASE WHEN level = 'critical' THEN 'High' WHEN today < avg_7d THEN 'Medium' ELSE 'Low' END,
  CASE WHEN level = 'critical' THEN 1 WHEN today < avg_7d THEN 2 ELSE 3 END, product, metric,
  metric || CASE WHEN var_7d_pct < 0 THEN ' below 7-day average' ELSE ' above 7-day average' END,
  var_7d_pct, round(today - avg_7d, 1)
FROM cmp WHERE level IN ('critical', 'warning')""")
def action_items(spark, d):
    return Rp.action_items(_anomalies(spark, d), _status(spark, d))


# --------------------------------------------------------------------------- account funnel

FUNNEL_SQL = """
funnel AS (
  SELECT product, COUNT(*) AS total_accounts, COUNT(*) FILTER (WHERE qualified) AS eligible_accounts,
    COUNT(*) FILTER (WHERE target) AS target_accounts, COUNT(*) FILTER (WHERE prospect) AS prospects,
    COUNT(*) - COUNT(*) FILTER (WHERE prospect) AS rejection_count
  FROM stages GROUP BY product)"""


@query("funnel_counts", sql=f"WITH {FUNNEL_SQL} SELECT * FROM funnel")
def funnel_counts(spark, d):
    return K.funnel(_stages(spark, d))


@query("funnel_stage_pct", sql=f"""
WITH {FUNNEL_SQL}
SELECT product, {pct_sql('eligible_accounts', 'total_accounts')} AS eligible_pct,
  {pct_sql('target_accounts', 'total_accounts')} AS target_pct,
  {pct_sql('rejection_count', 'total_accounts')} AS rejection_pct,
  {pct_sql('prospects', 'total_accounts')} AS prospect_pct FROM funnel""")
def funnel_stage_pct(spark, d):
    return K.stage_pct(K.funnel(_stages(spark, d)))


@query("funnel_all_products", sql="""
SELECT COUNT(DISTINCT account_id) AS total_accounts,
  COUNT(DISTINCT CASE WHEN qualified THEN account_id END) AS eligible_accounts,
  COUNT(*) FILTER (WHERE prospect) AS prospects FROM stages""")
def funnel_all_products(spark, d):
    return K.funnel_total(_stages(spark, d))


_FIELDS_SQL = " UNION ALL ".join(
    f"SELECT product, '{label}' AS field, COUNT(*) FILTER (WHERE {cond}) AS present, COUNT(*) AS total "
    f"FROM stages GROUP BY product"
    for label, cond in (("Valid Business Identifier (D&B Number)", "dnb_number IS NOT NULL"),
                        ("Company Type Classification", "company_type IS NOT NULL"),
                        ("Annual Revenue Information", "revenue IS NOT NULL"),
                        ("Underwriting Risk Exclusions Check", "NOT risk_excluded")))


@query("field_completeness", sql=f"""
SELECT product, field, present, total, {pct_sql('present', 'total')} AS completeness_pct, total - present AS missing,
  {grade_sql('CAST(100.0 AS DOUBLE) * present / total')} AS grade
FROM ({_FIELDS_SQL}) f""")
def field_completeness(spark, d):
    return K.field_completeness(_stages(spark, d))


@query("completeness_grade", sql=f"""
SELECT product, field, {grade_sql('CAST(100.0 AS DOUBLE) * present / total')} AS grade FROM ({_FIELDS_SQL}) f""")
def completeness_grade(spark, d):
    return K.field_completeness(_stages(spark, d)).select("product", "field", "grade")


@query("account_qualification", sql="""
SELECT account_id, product, CAST(completeness AS DOUBLE) AS completeness, qualified FROM stages""")
def account_qualification(spark, d):
    return _stages(spark, d).select("account_id", "product", "completeness", "qualified")


_REASONS = ", ".join(f"'{r}'" for r in T.REJECTION_REASONS)
_EXCL = T.EXCLUSION_REASONS


@query("rejection_breakdown", sql=f"""
SELECT g.product, g.rejection_reason, CAST(COALESCE(c.accounts, 0) AS BIGINT) AS accounts,
  {pct_sql('COALESCE(c.accounts, 0)', 'g.total_accounts')} AS pct_of_total
FROM (SELECT product, total_accounts, unnest([{_REASONS}]) AS rejection_reason
      FROM (SELECT product, COUNT(*) AS total_accounts FROM stages GROUP BY product) t) g
LEFT JOIN (SELECT product, rejection_reason, COUNT(*) AS accounts FROM stages
           WHERE rejection_reason IS NOT NULL GROUP BY 1, 2) c
  ON g.product = c.product AND g.rejection_reason = c.rejection_reason""")
def rejection_breakdown(spark, d):
    return K.rejections(_stages(spark, d))


_CRIT_NAMES = list(T.CRITERIA)


def _crit_sql() -> str:
    parts = []
    for i, name in enumerate(_CRIT_NAMES):
        parts.append(f"SELECT product, '{name}' AS criterion, COUNT(*) FILTER (WHERE c{i}) AS matching, "
                     f"COUNT(*) AS qualified, false AS is_all FROM stages WHERE qualified GROUP BY product")
    parts.append("SELECT product, 'All Criteria Met (Final Targets)', COUNT(*) FILTER (WHERE target), COUNT(*), true "
                 "FROM stages WHERE qualified GROUP BY product")
    return " UNION ALL ".join(parts)


def _match_grade_sql(v: str) -> str:
    return (f"CASE WHEN is_all THEN '{T.MATCH_ALL_LABEL}' WHEN {v} >= {T.MATCH_EXCELLENT_PCT} THEN 'Excellent' "
            f"WHEN {v} >= {T.MATCH_ON_TARGET_PCT} THEN 'On Target' ELSE 'Below Target' END")


@query("criteria_match", sql=f"""
SELECT product, criterion, matching, qualified, {pct_sql('matching', 'qualified')} AS match_pct,
  qualified - matching AS excluded,
  {_match_grade_sql('CAST(100.0 AS DOUBLE) * matching / qualified')} AS performance
FROM ({_crit_sql()}) c""")
def criteria_match(spark, d):
    return K.criteria_match(_stages(spark, d))


@query("match_grade", sql=f"""
SELECT product, criterion, {_match_grade_sql('CAST(100.0 AS DOUBLE) * matching / qualified')} AS performance
FROM ({_crit_sql()}) c""")
def match_grade(spark, d):
    return K.criteria_match(_stages(spark, d)).select("product", "criterion", "performance")


_EXCL_SQL = " UNION ALL ".join(
    f"SELECT product, '{r}' AS exclusion_reason FROM stages WHERE qualified AND NOT c{i}" for i, r in enumerate(_EXCL))


@query("exclusion_breakdown", sql=f"""
SELECT g.product, g.exclusion_reason, CAST(COALESCE(c.accounts, 0) AS BIGINT) AS accounts,
  {pct_sql('COALESCE(c.accounts, 0)', 'g.qualified')} AS pct_of_qualified
FROM (SELECT product, qualified, unnest([{", ".join(f"'{r}'" for r in _EXCL)}]) AS exclusion_reason
      FROM (SELECT product, COUNT(*) AS qualified FROM stages WHERE qualified GROUP BY product) t) g
LEFT JOIN (SELECT product, exclusion_reason, COUNT(*) AS accounts FROM ({_EXCL_SQL}) x GROUP BY 1, 2) c
  ON g.product = c.product AND g.exclusion_reason = c.exclusion_reason""")
def exclusion_breakdown(spark, d):
    return K.exclusions(_stages(spark, d))


@query("conversion_rates", sql=f"""
WITH {FUNNEL_SQL}
SELECT product, {pct_sql('eligible_accounts', 'total_accounts')} AS qualification_rate,
  {pct_sql('target_accounts', 'eligible_accounts')} AS targeting_precision,
  {pct_sql('target_accounts', 'total_accounts')} AS target_conversion FROM funnel""")
def conversion_rates(spark, d):
    return K.conversions(K.funnel(_stages(spark, d)))


@query("share_of_total", sql=f"""
WITH {FUNNEL_SQL}, long AS (
  SELECT 'target_accounts' AS metric, product, target_accounts AS value FROM funnel
  UNION ALL SELECT 'prospects', product, prospects FROM funnel
  UNION ALL SELECT 'rejection_count', product, rejection_count FROM funnel)
SELECT metric, product, CAST(value AS BIGINT) AS value,
  {pct_sql('value', 'SUM(value) OVER (PARTITION BY metric)')} AS share_pct FROM long""")
def share_of_total(spark, d):
    return K.share(K.funnel(_stages(spark, d)))


@query("funnel_with_averages", sql=f"""
WITH df AS (
  SELECT q.report_date, q.product, COUNT(*) AS total_accounts, COUNT(*) FILTER (WHERE s.qualified) AS eligible_accounts,
    COUNT(*) FILTER (WHERE s.target) AS target_accounts, COUNT(*) FILTER (WHERE s.prospect) AS prospects
  FROM (SELECT DISTINCT quoted_on AS report_date, product, account_id FROM quotes
        WHERE quoted_on >= {_d(30, QRUN)} AND quoted_on <= {_d(0, QRUN)}) q
  JOIN stages s ON s.account_id = q.account_id AND s.product = q.product
  GROUP BY q.report_date, q.product)
SELECT product,
  MAX(CASE WHEN report_date = {_d(0, QRUN)} THEN total_accounts END) AS total_accounts,
  MAX(CASE WHEN report_date = {_d(0, QRUN)} THEN eligible_accounts END) AS eligible_accounts,
  MAX(CASE WHEN report_date = {_d(0, QRUN)} THEN target_accounts END) AS target_accounts,
  MAX(CASE WHEN report_date = {_d(0, QRUN)} THEN prospects END) AS prospects,
  AVG(CASE WHEN report_date >= {_d(7, QRUN)} AND report_date < {_d(0, QRUN)} THEN prospects END) AS prospects_avg_7d,
  AVG(CASE WHEN report_date >= {_d(30, QRUN)} AND report_date < {_d(0, QRUN)} THEN prospects END) AS prospects_avg_30d
FROM df GROUP BY product""")
def funnel_with_averages(spark, d):
    window_start = QRUN - _dt.timedelta(days=T.ROLLING_LONG_DAYS)
    return Rp.funnel_with_averages(B.quotes(spark, d, window_start, QRUN), _stages(spark, d), QRUN)


# --------------------------------------------------------------------------- quotes

@query("quote_status_counts", sql="SELECT product, status, COUNT(*) AS quotes FROM quotes GROUP BY 1, 2")
def quote_status_counts(spark, d):
    return K.quote_status(B.quotes(spark, d))


_MASK_SQL = "CASE product WHEN 'Crime' THEN 1 WHEN 'EPL' THEN 2 WHEN 'Fiduciary' THEN 4 ELSE 0 END"
_COMBO_SQL = "CASE m " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in K.COMBO_BY_MASK.items()) + " END"
BASKET_SQL = f"""
baskets AS (
  SELECT account_id, quote_month, status, n, {_COMBO_SQL.replace('CASE m', 'CASE bm')} AS combo FROM (
    SELECT *, bit_or(m) OVER (PARTITION BY account_id, quote_month) AS bm FROM (
      SELECT account_id, CAST(date_trunc('month', quoted_on) AS DATE) AS quote_month, status, COUNT(*) AS n,
        bit_or({_MASK_SQL}) AS m
      FROM quotes GROUP BY 1, 2, 3) a) b)"""


@query("product_combo_volume", sql=f"""
SELECT combo, COUNT(account_id) AS accounts
FROM (SELECT unnest(['Crime', 'EPL', 'Fid', 'C+E', 'C+F', 'E+F', 'All 3']) AS combo,
        unnest([['Crime'], ['EPL'], ['Fiduciary'], ['Crime', 'EPL'], ['Crime', 'Fiduciary'], ['EPL', 'Fiduciary'], ['Crime', 'EPL', 'Fiduciary']]) AS held) g
LEFT JOIN (SELECT account_id, list_sort(list(DISTINCT product)) AS held FROM quotes
           WHERE quoted_on >= DATE '{QRUN - _dt.timedelta(days=T.ROLLING_LONG_DAYS)}' AND quoted_on <= DATE '{QRUN}' GROUP BY account_id) a USING (held)
GROUP BY combo""")
def product_combo_volume(spark, d):
    """A14 over the report month (the run date and the days of the long average before it)."""
    start = QRUN - _dt.timedelta(days=T.ROLLING_LONG_DAYS)
    return K.combo_volume(B.quotes(spark, d, start, QRUN), start, QRUN)


@query("status_combo_matrix", sql=f"""
WITH {BASKET_SQL}
SELECT status, {", ".join(f"CAST(SUM(n) FILTER (WHERE combo = '{c}') AS BIGINT) AS {K.PIVOT_NAMES[c]}"
                          for c in T.PRODUCT_COMBOS)}
FROM baskets GROUP BY status""")
def status_combo_matrix(spark, d):
    return K.status_matrix(B.quotes(spark, d))


_PERIOD = QRUN - _dt.timedelta(days=T.ROLLING_LONG_DAYS)
_IN_PERIOD = f"quoted_on >= DATE '{_PERIOD}' AND quoted_on <= DATE '{QRUN}'"


@query("status_combo_period", sql=f"""
WITH {BASKET_SQL.replace("FROM quotes", f"FROM quotes WHERE {_IN_PERIOD}")}
SELECT status, {", ".join(f"CAST(SUM(n) FILTER (WHERE combo = '{c}') AS BIGINT) AS {K.PIVOT_NAMES[c]}"
                          for c in T.PRODUCT_COMBOS)}
FROM baskets GROUP BY status""")
def status_combo_period(spark, d):
    """A15 for the report month: the period reaches the scan."""
    return K.status_matrix(B.quotes(spark, d, _PERIOD, QRUN))


@query("combo_volume_period", sql=f"""
WITH held AS (SELECT account_id, quoted_on >= DATE '{_PERIOD}' AS now, list_sort(list(DISTINCT product)) AS p FROM quotes
              WHERE quoted_on > DATE '{_PERIOD}' - INTERVAL {T.ROLLING_LONG_DAYS + 2} DAY AND quoted_on <= DATE '{QRUN}' GROUP BY 1, 2),
names AS (SELECT unnest(['Crime', 'EPL', 'Fid', 'C+E', 'C+F', 'E+F', 'All 3']) AS combo,
  unnest([['Crime'], ['EPL'], ['Fiduciary'], ['Crime', 'EPL'], ['Crime', 'Fiduciary'], ['EPL', 'Fiduciary'], ['Crime', 'EPL', 'Fiduciary']]) AS p),
vol AS (SELECT combo, COUNT(*) FILTER (WHERE now) AS accounts, COUNT(*) FILTER (WHERE NOT now) AS prev_accounts FROM names LEFT JOIN held USING (p) GROUP BY combo)
SELECT combo, accounts, prev_accounts, accounts - prev_accounts AS delta_abs, round({var_sql('accounts', 'prev_accounts')}, 1) AS delta_pct FROM vol""")
def combo_volume_period(spark, d):
    """K5 for the report month against the days before it."""
    return Rp.combo_volume_period(B.quotes(spark, d, _PERIOD - (QRUN - _PERIOD) - _dt.timedelta(days=1), QRUN), _PERIOD, QRUN)


@query("aging_alert", sql=f"""
SELECT quote_id, account_id, product, CAST(date_diff('day', quoted_on, DATE '{QRUN}') AS INTEGER) AS days_waiting
FROM quotes WHERE status = 'Waiting Pickup' AND quoted_on <= DATE '{QRUN}'
  AND date_diff('day', quoted_on, DATE '{QRUN}') > {T.AGING_ALERT_DAYS}""")
def aging_alert(spark, d):
    return K.aging_alerts(B.quotes(spark, d), QRUN)


@query("combo_volume_trend", sql=f"""
WITH {BASKET_SQL}, vol AS (
  SELECT quote_month, combo, COUNT(*) AS accounts
  FROM (SELECT DISTINCT account_id, quote_month, combo FROM baskets) x GROUP BY 1, 2),
t AS (
  SELECT *, MAX(accounts) OVER (PARTITION BY combo ORDER BY year(quote_month) * 12 + month(quote_month)
                                RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS prev_accounts FROM vol)
SELECT quote_month, combo, accounts, prev_accounts, accounts - prev_accounts AS delta_abs,
  round({var_sql('accounts', 'prev_accounts')}, 1) AS delta_pct FROM t""")
def combo_volume_trend(spark, d):
    return Rp.combo_volume_trend(B.quotes(spark, d))


# --------------------------------------------------------------------------- S8 sink

@query("report_tables_sink", sql=f"WITH {COMPARE_SQL} SELECT {ANOM_COLS}, DATE '{RUN}' AS report_date FROM cmp")
def report_tables_sink(spark, d):
    """Store the day's anomaly table by report date, twice (a rerun replaces the day), read back."""
    import uuid

    from ..sources.sinks import write_report
    out = work_dir(spark, f"reports-{uuid.uuid4().hex[:8]}")
    table = _anomalies(spark, d)
    write_report(table, out, "kpi_anomalies", RUN)
    path = write_report(table, out, "kpi_anomalies", RUN)
    return spark.read.parquet(path)


# --------------------------------------------------------------------------- streaming form of S2

@query("source_feed_stream", sql="""
SELECT CAST(ts AS DATE) AS report_date, event_type AS source, COUNT(*) AS records, MAX(ts) AS last_refresh
FROM events GROUP BY 1, 2""")
def source_feed_stream(spark, d):
    """S2 as Structured Streaming: feed files processed incrementally (availableNow), daily counts
    per source and micro-batch, idempotent foreachBatch sink; read back the sums."""
    import uuid

    from ..streaming.feeds import read_feed_counts, run_feed_counts
    base = work_dir(spark, f"feeds-{uuid.uuid4().hex[:8]}")
    run_feed_counts(spark, d, os.path.join(base, "out"), os.path.join(base, "checkpoint"))
    return read_feed_counts(spark, os.path.join(base, "out"))

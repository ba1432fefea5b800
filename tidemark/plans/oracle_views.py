"""The fixture views written as DuckDB SQL, for the oracle side of every check.

Each entry is one CTE body over the pre-registered base tables; ``with_views``
prefixes a query with exactly the CTEs it uses (and their dependencies).
These mirror ``sources.bindings`` expression by expression.
"""

from __future__ import annotations

import re

from .. import thresholds as T
from ..sources.bindings import CLAIMANT_COLUMNS, claimant_types

_SQL_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE"}

CLAIMS_RUN_INT = int(T.CLAIMS_RUN_DATE.strftime("%Y%m%d"))


def _claimant_select() -> str:
    mapped = {
        "claimant_key": "o.o_orderkey",
        "claim_number": "CAST(CAST(floor(o.o_orderkey / 4.0) AS BIGINT) AS VARCHAR)",
        "claimant_number": "CAST(o.o_orderkey % 4 + 1 AS BIGINT)",
        "originating_business_unit": "n.n_name",
        "salvage_status": "CASE WHEN o.o_orderkey % 97 <> 0 THEN substr('CFWNCOX', CAST(o.o_orderkey % 7 + 1 AS INTEGER), 1) END",
        "subrogation_status": "substr('CFWNCFWNO', CAST(o.o_custkey % 9 + 1 AS INTEGER), 1)",
        "tp_deductible_status": "substr('NCFWR', CAST(o.o_custkey % 5 + 1 AS INTEGER), 1)",
        "recovery_date_closed": ("CASE WHEN o.o_orderkey % 3 = 0 THEN 0 WHEN o.o_orderkey % 3 = 1 THEN NULL "
                                 "ELSE CAST(strftime(o.o_orderdate, '%Y%m%d') AS INTEGER) END"),
        "recovery_status": "CASE WHEN o.o_orderstatus = 'F' THEN 'C' WHEN o.o_orderstatus = 'O' THEN 'O' END",
        "claimant_reserve_curr": "o.o_totalprice",
        "claimant_type": "o.o_orderpriority",
        "claimant_name": "c.c_name",
    }
    types = claimant_types()
    parts = []
    for name in CLAIMANT_COLUMNS:
        expr = mapped.get(name, "NULL")
        parts.append(f"CAST({expr} AS {_SQL_TYPES[types[name]]}) AS {name}")
    return ",\n    ".join(parts)


VIEWS: dict[str, str] = {
    "order_units": """
  SELECT o.*, c.c_name, n.n_name
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "claimant": f"""
  SELECT {_claimant_select()}
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "claim_stage_consol": """
  SELECT u.n_name AS business_unit,
    CAST(CAST(floor(l.l_orderkey / 4.0) AS BIGINT) AS VARCHAR) AS claim_number,
    CAST(l.l_orderkey % 4 + 1 AS BIGINT) AS claimant_number,
    CAST(strftime(l.l_shipdate, '%Y%m%d') AS INTEGER) AS transaction_date,
    CAST(l.l_linenumber + 4 AS VARCHAR) AS transaction_code,
    CASE WHEN l.l_partkey % 50 <> 0 THEN CAST(strftime(l.l_shipdate, '%Y%m%d') AS INTEGER) END AS accounting_dt,
    l.l_partkey * 1000 + l.l_suppkey AS voucher_number
  FROM lineitem l JOIN order_units u ON l.l_orderkey = u.o_orderkey""",
    "wt_check_claim_iot": """
  SELECT n_name AS originating_business_unit,
    CAST(CAST(floor(o_orderkey / 4.0) AS BIGINT) AS VARCHAR) AS claim_number,
    CAST(o_orderkey % 4 + 1 AS BIGINT) AS claimant_number
  FROM order_units WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""",
    "business_unit_xref": """
  SELECT n_name AS business_unit, CASE WHEN n_regionkey <> 0 THEN 'Y' ELSE 'N' END AS recovery_date_closed_rqd
  FROM nation""",
    # queue claimants (enabled BU), each once
    "qc": """
  SELECT claimant.* FROM claimant
  SEMI JOIN (SELECT * FROM wt_check_claim_iot WHERE originating_business_unit IN (
               SELECT business_unit FROM business_unit_xref WHERE recovery_date_closed_rqd = 'Y')) queued
  USING (originating_business_unit, claim_number, claimant_number)""",
    "csc_latest": """
  SELECT business_unit, claim_number, claimant_number,
    first(transaction_date ORDER BY accounting_dt DESC NULLS FIRST, voucher_number DESC NULLS FIRST, transaction_date DESC) AS transaction_date
  FROM claim_stage_consol WHERE transaction_code IN ('7', '8', '11') GROUP BY 1, 2, 3""",
    "csc_max": """
  SELECT business_unit, claim_number, claimant_number, MAX(transaction_date) AS max_transaction_date
  FROM claim_stage_consol GROUP BY business_unit, claim_number, claimant_number""",
    # One row a queue claimant: how many of its three statuses are closed or open (a missing one is neither), and its transactions.
    "decided": """
  SELECT qc.*, closing.transaction_date AS closed_on, newest.max_transaction_date AS last_on,
    len(list_filter([salvage_status, subrogation_status, tp_deductible_status], lambda x: x IN ('C', 'F', 'W', 'N'))) AS n_closed,
    len(list_filter([salvage_status, subrogation_status, tp_deductible_status], lambda x: x NOT IN ('C', 'F', 'W', 'N'))) AS n_open
  FROM qc
  LEFT JOIN (SELECT business_unit AS originating_business_unit, * EXCLUDE (business_unit) FROM csc_latest) closing
    USING (originating_business_unit, claim_number, claimant_number)
  LEFT JOIN (SELECT business_unit AS originating_business_unit, * EXCLUDE (business_unit) FROM csc_max) newest
    USING (originating_business_unit, claim_number, claimant_number)""",
    "changes": f"""
  SELECT claimant_key, claim_number, claimant_number, originating_business_unit,
    CAST(IF(update_type = 'C', closed_on, 0) AS INTEGER) AS recovery_date_closed,
    IF(update_type = 'C', 'C', IF(recovery_status = 'C', 'R', 'O')) AS recovery_status,
    CAST(IFNULL(last_on, {CLAIMS_RUN_INT}) AS INTEGER) AS valid_from_date, update_type
  FROM (SELECT *, CASE WHEN n_closed = 3 AND IFNULL(recovery_date_closed, 0) = 0 AND closed_on IS NOT NULL THEN 'C'
                       WHEN n_open > 0 AND (recovery_date_closed <> 0 OR recovery_status = 'C') THEN 'R' END AS update_type
        FROM decided) d
  WHERE update_type IS NOT NULL""",
    "close_set": "SELECT * FROM changes WHERE update_type = 'C'",
    "reopen_set": "SELECT * FROM changes WHERE update_type = 'R'",
    # --- KPI ---
    "account_flags": """
  SELECT c_custkey AS account_id, p.product,
    CASE WHEN c_custkey % 40 <> 0 THEN c_custkey END AS dnb_number,
    CASE WHEN c_custkey % 31 <> 0 THEN c_mktsegment END AS company_type,
    CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS revenue,
    (c_custkey % 12 = 0) AS risk_excluded,
    c_nationkey AS industry_code,
    c_custkey % 20 AS employees,
    CASE WHEN c_custkey % 10 = 0 THEN 'public' ELSE 'private' END AS ownership,
    (c_custkey % 17 = 0) AS email_opt_out
  FROM customer, (SELECT unnest(['Crime', 'EPL', 'Fiduciary']) AS product) p""",
    "daily_metric": """
  SELECT report_date, CASE product WHEN 'Crime' THEN 'Crime' ELSE 'Liability' END AS section, product, metric, value
  FROM (SELECT CAST(ts AS DATE) AS report_date, ['Crime', 'EPL', 'Fiduciary'][CAST(user_id % 3 + 1 AS INTEGER)] AS product,
          event_type AS metric, COUNT(*) AS value
        FROM events GROUP BY 1, 2, 3) x""",
    "expected_series": """
  SELECT CASE product WHEN 'Crime' THEN 'Crime' ELSE 'Liability' END AS section, product, metric
  FROM (SELECT unnest(['Crime', 'EPL', 'Fiduciary']) AS product) p,
    (SELECT unnest(['view', 'signup', 'error', 'click', 'purchase']) AS metric) m""",
    "quotes": """
  SELECT o_orderkey AS quote_id, o_custkey AS account_id,
    CASE o_orderkey % 3 WHEN 0 THEN 'Crime' WHEN 1 THEN 'EPL' ELSE 'Fiduciary' END AS product,
    CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '5') THEN 'Quotes Sent'
         WHEN substr(o_orderpriority, 1, 1) = '2' THEN 'Waiting Pickup'
         WHEN substr(o_orderpriority, 1, 1) = '3' THEN 'Failed' ELSE 'Opt-Out' END AS status,
    CAST(o_orderdate AS DATE) AS quoted_on
  FROM orders""",
    # --- lineage ---
    "lineage_edges": """
  SELECT 'T' || CAST(p_partkey AS VARCHAR) AS src, 'T' || CAST(CAST(floor(p_partkey / 2.0) AS BIGINT) AS VARCHAR) AS dst,
    p_size, p_partkey AS query_id FROM part WHERE p_partkey > 0
  UNION ALL
  SELECT 'T' || CAST(p_partkey AS VARCHAR), 'T' || CAST(CAST(floor(p_partkey / 3.0) AS BIGINT) AS VARCHAR),
    p_size, p_partkey FROM part WHERE p_partkey > 0""",
    "column_edges_raw": """
  SELECT e.query_id, e.src, 'c' || CAST(i AS VARCHAR) AS src_col, e.dst,
    'c' || CAST((i - 1 + e.p_size % 3) % 3 + 1 AS VARCHAR) AS dst_col
  FROM lineage_edges e, (SELECT unnest([1, 2, 3]) AS i) ii""",
    "dq_results": """
  SELECT 'T' || CAST(user_id AS VARCHAR) AS object, event_type AS test,
    CASE WHEN value > 200 THEN 'fail' ELSE 'pass' END AS status, value AS score, ts, event_id
  FROM events""",
    "object_meta": """
  SELECT 'T' || CAST(p_partkey AS VARCHAR) AS object,
    CASE p_partkey % 3 WHEN 0 THEN 'table' WHEN 1 THEN 'view' ELSE 'procedure' END AS kind,
    p_brand AS owner FROM part""",
    "call_log": """
  SELECT p_partkey AS query_id, CASE WHEN p_partkey >= 4 THEN CAST(floor(p_partkey / 4.0) AS BIGINT) END AS parent_query_id,
    ['select', 'insert', 'merge'][CAST(p_size % 3 + 1 AS INTEGER)] AS role FROM part WHERE p_partkey > 0""",
    "query_log": """
  SELECT conv_id * 100 + turn AS query_id, CASE WHEN turn > 0 THEN conv_id * 100 END AS parent_query_id,
    role, conv_id FROM conversations""",
}


def _deps(name: str) -> list[str]:
    body = VIEWS[name]
    return [v for v in VIEWS if v != name and re.search(rf"\b{v}\b", body)]


def with_views(sql: str, *extra: str) -> str:
    """Prefix ``sql`` with the CTEs it references (dependency order)."""
    order: list[str] = []

    def visit(v: str) -> None:
        if v in order:
            return
        for d in _deps(v):
            visit(d)
        order.append(v)

    for v in VIEWS:
        if re.search(rf"\b{v}\b", sql) or v in extra:
            visit(v)
    if not order:
        return sql
    ctes = ",\n".join(f"{v} AS ({VIEWS[v]}\n)" for v in order)
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes},\n{body[len('WITH RECURSIVE '):]}"
    if body.upper().startswith("WITH "):
        body = body[5:]
        return f"WITH {ctes},\n{body}"
    return f"WITH {ctes}\n{body}"


def _stages_sql() -> str:
    industry = " ".join(f"WHEN product = '{p}' THEN industry_code IN ({', '.join(map(str, r['industries']))})"
                        for p, r in T.PRODUCT_RULES.items())
    rmin = " ".join(f"WHEN product = '{p}' THEN {r['revenue_min']}" for p, r in T.PRODUCT_RULES.items())
    rmax = " ".join(f"WHEN product = '{p}' THEN {r['revenue_max']}" for p, r in T.PRODUCT_RULES.items())
    reasons = T.REJECTION_REASONS
    return f"""
  SELECT *, qualified AND c0 AND c1 AND c2 AND c3 AS target,
    qualified AND c0 AND c1 AND c2 AND c3 AND NOT email_opt_out AS prospect,
    CASE WHEN NOT qualified THEN CASE WHEN dnb_number IS NULL THEN '{reasons[0]}'
      WHEN company_type IS NULL THEN '{reasons[1]}' WHEN revenue IS NULL THEN '{reasons[2]}'
      WHEN risk_excluded THEN '{reasons[3]}' ELSE '{reasons[4]}' END END AS rejection_reason
  FROM (SELECT *, completeness >= {T.QUALIFICATION_THRESHOLD} AS qualified FROM (SELECT *,
    CAST((CASE WHEN dnb_number IS NOT NULL THEN 1 ELSE 0 END) + (CASE WHEN company_type IS NOT NULL THEN 1 ELSE 0 END)
     + (CASE WHEN revenue IS NOT NULL THEN 1 ELSE 0 END) + (CASE WHEN NOT risk_excluded THEN 1 ELSE 0 END) AS DOUBLE)
      / 4.0 AS completeness,
    COALESCE(CASE {industry} END, false) AS c0,
    COALESCE(revenue >= CASE {rmin} END AND revenue <= CASE {rmax} END, false) AS c1,
    COALESCE(employees > {T.MIN_EMPLOYEES}, false) AS c2,
    COALESCE(ownership = 'private', false) AS c3
  FROM account_flags) s0) s"""


VIEWS["stages"] = _stages_sql()
VIEWS["feed_status"] = f"""
  SELECT e.source, COALESCE(t.records, 0) > 0 AS available, CAST(COALESCE(t.records, 0) AS BIGINT) AS records,
    t.last_refresh
  FROM (SELECT unnest(['view', 'signup', 'error', 'click', 'purchase', 'partner_feed']) AS source) e
  LEFT JOIN (SELECT event_type AS source, COUNT(*) AS records, MAX(ts) AS last_refresh FROM events
             WHERE ts >= TIMESTAMP '{T.EVENTS_RUN_DATE} 00:00:00'
               AND ts < TIMESTAMP '{T.EVENTS_RUN_DATE} 00:00:00' + INTERVAL 1 DAY
             GROUP BY event_type) t ON e.source = t.source"""
VIEWS["series"] = """
  SELECT report_date, section, product, metric, value,
    MAX(value) OVER (PARTITION BY product, metric ORDER BY date_diff('day', DATE '1970-01-01', report_date)
                     RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS yesterday,
    AVG(value) OVER (PARTITION BY product, metric ORDER BY date_diff('day', DATE '1970-01-01', report_date)
                     RANGE BETWEEN 7 PRECEDING AND 1 PRECEDING) AS avg_7d,
    AVG(value) OVER (PARTITION BY product, metric ORDER BY date_diff('day', DATE '1970-01-01', report_date)
                     RANGE BETWEEN 30 PRECEDING AND 1 PRECEDING) AS avg_30d
  FROM daily_metric"""

VIEWS["flat"] = """
  SELECT query_id, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(query_id AS BIGINT)) AS ts,
    src, src_col, dst, dst_col FROM column_edges_raw"""
VIEWS["latest_dq"] = """
  SELECT object, test, status, score, ts FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY object, test ORDER BY ts DESC, event_id DESC) AS rn
    FROM dq_results) x WHERE rn = 1"""
VIEWS["node_health"] = f"""
  SELECT *, CASE WHEN pass_ratio >= {T.HEALTH_GREEN} THEN 'green' WHEN pass_ratio >= {T.HEALTH_YELLOW} THEN 'yellow'
    ELSE 'red' END AS health FROM (
    SELECT object, COUNT(*) AS tests, COUNT(*) FILTER (WHERE status = 'fail') AS failing_tests,
      AVG(CASE WHEN status = 'pass' THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END) AS pass_ratio,
      MAX(ts) AS last_checked
    FROM latest_dq GROUP BY object) h"""
# The facts each text shape must yield, stated for the shape and not extracted from the text.
VIEWS["facts"] = """
  SELECT query_id, kind, unnest(items) AS fact FROM (
    SELECT p_partkey AS query_id, unnest(['join', 'filter', 'case']) AS kind, unnest([
      CASE p_partkey % 6 WHEN 0 THEN ['a.c1 = b.c1'] WHEN 1 THEN ['a.c1 = b.c2'] WHEN 2 THEN ['a.c1 = b.c1', 'b.c2 = c.c2'] WHEN 3 THEN ['USING (c1)']
        WHEN 4 THEN ['t.c1 = s.c1 AND s.c2 IN (SELECT c2 FROM T' || CAST(p_partkey AS VARCHAR) || ' WHERE c3 = ' || CAST(p_size AS VARCHAR) || ')']
        ELSE ['a.c1 = T' || CAST(CAST(floor(p_partkey / 2.0) AS BIGINT) AS VARCHAR) || '.c1'] END,
      CASE p_partkey % 6 WHEN 0 THEN ['a.c3 >= ' || CAST(p_size AS VARCHAR) || ' AND b.c2 IS NOT NULL']
        WHEN 1 THEN ['a.c3 < ' || CAST(p_size AS VARCHAR)] WHEN 2 THEN ['c.c3 = ' || CAST(p_size AS VARCHAR)]
        WHEN 3 THEN ['c3 < ' || CAST(p_size AS VARCHAR), 's.c1 <> '' WHERE '' ' || chr(10) || ' AND b.c1 > 0']
        WHEN 4 THEN ['c3 = ' || CAST(p_size AS VARCHAR)] ELSE [] END,
      CASE p_partkey % 6 WHEN 0 THEN ['CASE WHEN a.c2 > ' || CAST(p_size AS VARCHAR) || ' THEN ''big'' ELSE ''small'' END']
        WHEN 3 THEN ['CASE s.c3 WHEN ''END'' THEN 1 ELSE 2 END',
          'CASE WHEN s.c2 > ' || CAST(p_size AS VARCHAR) || ' THEN CASE s.c3 WHEN ''END'' THEN 1 ELSE 2 END ELSE 0 END'] ELSE [] END]) AS items
    FROM part WHERE p_partkey > 0) x"""
VIEWS["facts_by_query"] = """
  SELECT query_id,
    array_to_string(list_sort(list(fact) FILTER (WHERE kind = 'join')), '; ') AS join_logic,
    array_to_string(list_sort(list(fact) FILTER (WHERE kind = 'filter')), '; ') AS filter_logic,
    array_to_string(list_sort(list(fact) FILTER (WHERE kind = 'case')), '; ') AS case_logic
  FROM facts GROUP BY query_id"""

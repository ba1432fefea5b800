"""Constants of the three workloads.

Two kinds live here.  *Fixed values* must equal the source job's values for
results to match (status codes, transaction codes, the history column list,
report labels).  *Inferred* values come from reading rendered report numbers
and are parameters: every function that uses one takes it as an argument
with the value below as the default.
"""

from __future__ import annotations

import datetime as _dt

# ---------------------------------------------------------------------------
# Fixed values (must match the source job exactly)
# ---------------------------------------------------------------------------

# Status values that count as "closed" for salvage / subrogation / TP deductible.
CLOSED_STATUSES = ("C", "F", "W", "N")

# Transaction codes that close a recovery (compared as strings).
RECOVERY_TXN_CODES = ("7", "8", "11")

# Business-unit flag value meaning "recovery date closed required".
BU_ENABLED_FLAG = "Y"

# Status / update-type literals written by the job.
STATUS_CLOSED = "C"
STATUS_REOPENED = "R"
STATUS_OPEN = "O"
UPDATE_CLOSE = "C"
UPDATE_REOPEN = "R"
OPEN_DATE = 0

# Error contract of the job.
FATAL_ERROR_CODE = -20039
FATAL_ERROR_MESSAGE = "WHEN OTHERS: Fatal Errors have occurred during processing. EXECUTION STOPPED"
ERROR_TEXT_LIMIT = 200

# The history table column list, in the job's insert order (82 columns).
HISTORY_COLUMNS = (
    "claimant_key", "claim_number", "claimant_number", "originating_business_unit",
    "claimant_id", "claimant_name", "claimant_status", "condition_injury_damage",
    "current_coverage_code", "current_geo_code", "current_product", "driver_pilot",
    "driver_pilot_age", "last_activity_date", "license_vin_number", "litigation_indicator",
    "make_model_vehicle", "plant_division", "policy_holder_reference", "policy_segment",
    "product_type", "salvage_status", "subrogation_status", "tp_deductible_status",
    "type_of_claim", "usi_claim_no_reformat", "usi_claimant_no_reformat",
    "usi_policy_no_reformat", "date_opened", "date_closed", "bep_opened", "bep_closed",
    "policy_coverage_key", "certificate_number", "date_of_insurance", "commodity",
    "commodity_code", "conveyance", "conveyance_code", "departure_point",
    "departure_point_code", "destination", "destination_code", "departure_date",
    "arrival_date", "vessel_name", "flag", "carrier_line", "current_local_line_of_business",
    "insrd_ticketed_by_police", "insrd_drvng_under_the_inflnce", "road_condition",
    "claimant_client_data01", "claimant_client_data02", "claimant_client_data03",
    "claimant_client_data04", "claimant_client_date01", "claimant_client_date02",
    "mcsi_upd_date", "compensation_rate", "days_worked", "dependant", "waiting_period",
    "certificate_number_1", "certificate_number_2", "claimant_reference",
    "claimant_reserve_curr", "responsible_adjuster", "claimant_type", "age_at_claim",
    "valid_from_date", "sequence_number", "expense_status", "expense_date_opened",
    "expense_date_closed", "recovery_status", "recovery_date_closed", "bep_opened_first",
    "overall_status", "overall_date_closed", "overall_bep_closed", "genius_risk_code",
)

# Anomaly labels shown in the reports.
LABEL_NORMAL = "Normal"
LABEL_CRITICAL_DROP = "Critical Drop"
LABEL_CRITICAL_HIGH = "High"
LABEL_BELOW_AVERAGE = "Below Average"
LABEL_ABOVE_AVERAGE = "Above Average"

# Quote statuses shown in the executive brief, in display order.
QUOTE_STATUSES = ("Quotes Sent", "Waiting Pickup", "Failed", "Opt-Out")

# Products of the prospect funnel, and the seven product combinations in display order.
PRODUCTS = ("Crime", "EPL", "Fiduciary")
PRODUCT_COMBOS = ("Crime", "EPL", "Fid", "C+E", "C+F", "E+F", "All 3")

# Rejection reasons (first match wins) and exclusion reasons of the single-product report.
REJECTION_REASONS = (
    "Missing Business Identifier",
    "Company Type Not Available",
    "Revenue Data Missing",
    "Failed Risk Exclusion Screening",
    "Other Data Quality Issues",
)
EXCLUSION_REASONS = (
    "Industry Not in Appetite",
    "Revenue Outside Target Range",
    "Single Employee Business",
    "Public Company",
)

# Row labels of the completeness and criteria tables, in their order.
COMPLETENESS_FIELDS = ("Valid Business Identifier (D&B Number)", "Company Type Classification",
                       "Annual Revenue Information", "Underwriting Risk Exclusions Check")
CRITERIA = ("Industry Classification Match", "Revenue Within Appetite Range",
            "Business Size (Employees > 1)", "Private Company Status")

# ---------------------------------------------------------------------------
# Inferred values (parameters; defaults read off the rendered reports)
# ---------------------------------------------------------------------------

ANOMALY_WARN_PCT = 15.0
ANOMALY_CRIT_PCT = 30.0
TREND_STABLE_BAND_PCT = 1.25
QUALIFICATION_THRESHOLD = 0.90
ROLLING_SHORT_DAYS = 7
ROLLING_LONG_DAYS = 30
AGING_ALERT_DAYS = 3

# Completeness grades: (minimum percent, grade), checked top-down; below the last -> "Poor".
COMPLETENESS_GRADES = ((99.0, "Excellent"), (95.0, "Good"), (90.0, "Acceptable"))
COMPLETENESS_FLOOR_GRADE = "Poor"

# Criteria match grades: >= excellent -> "Excellent", >= on_target -> "On Target", else "Below Target".
MATCH_EXCELLENT_PCT = 92.0
MATCH_ON_TARGET_PCT = 70.0
MATCH_ALL_LABEL = "Within Range"

# Node health: pass ratio >= green -> green, >= yellow -> yellow, else red.
HEALTH_GREEN = 0.95
HEALTH_YELLOW = 0.80

# Freshness: age in hours <= fresh -> fresh, <= late -> late, else stale.
FRESH_HOURS = 24.0
LATE_HOURS = 72.0

# Per-product targeting appetite: revenue range (inclusive) and industry (nation key) list.
PRODUCT_RULES = {
    "Crime": {"revenue_min": 1000.0, "revenue_max": 9000.0, "industries": tuple(range(0, 20))},
    "EPL": {"revenue_min": 2000.0, "revenue_max": 9500.0, "industries": tuple(range(5, 25))},
    "Fiduciary": {"revenue_min": 500.0, "revenue_max": 6000.0, "industries": tuple(range(0, 25, 2))},
}
MIN_EMPLOYEES = 1

# Report run dates of the test fixtures.
CLAIMS_RUN_DATE = _dt.date(2001, 8, 1)
EVENTS_RUN_DATE = _dt.date(2024, 1, 30)

#: Hashes kept for each node to estimate how many nodes it leads to (relative error about 1 / sqrt).
REACH_SKETCH_SIZE = 256

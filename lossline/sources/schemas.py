"""Declared schemas of the raw tables and of the stream sinks."""

from __future__ import annotations

RAW_SCHEMAS = {
    "policyholders": (
        "policyholder_id BIGINT, first_name STRING, last_name STRING, date_of_birth DATE, "
        "gender STRING, state_code STRING, city STRING, occupation STRING, registration_date DATE"
    ),
    "policies": (
        "policy_id BIGINT, policyholder_id BIGINT, policy_number STRING, coverage_type STRING, "
        "effective_date DATE, expiration_date DATE, annual_premium DECIMAL(14,2), "
        "deductible DECIMAL(14,2), coverage_limit DECIMAL(16,2), status STRING"
    ),
    "claims": (
        "claim_id BIGINT, policy_id BIGINT, claim_number STRING, accident_date DATE, "
        "report_date DATE, close_date DATE, claim_status STRING, cause_of_loss STRING, "
        "initial_reserve DECIMAL(16,2), current_reserve DECIMAL(16,2)"
    ),
    "claim_payments": (
        "payment_id BIGINT, claim_id BIGINT, payment_date DATE, payment_amount DECIMAL(16,2), "
        "payment_type STRING, cumulative_paid DECIMAL(16,2)"
    ),
    "coverages": "coverage_type STRING, coverage_category STRING, description STRING",
}

WINDOW_SUMMARY_SCHEMA = (
    "window_start TIMESTAMP, window_end TIMESTAMP, coverage_type STRING, claim_count BIGINT, "
    "total_amount_mxn DOUBLE, avg_amount_mxn DOUBLE, min_amount_mxn DOUBLE, max_amount_mxn DOUBLE"
)
PANE_SUMMARY_SCHEMA = WINDOW_SUMMARY_SCHEMA + ", pane_timing STRING, firing_id STRING"
LATE_ARRIVAL_SCHEMA = (
    "claim_id STRING, original_timestamp TIMESTAMP, arrival_timestamp TIMESTAMP, "
    "lateness_seconds BIGINT, raw_data STRING, processing_timestamp TIMESTAMP"
)
DEAD_LETTER_SCHEMA = (
    "raw_data STRING, error_reason STRING, error_type STRING, processing_timestamp TIMESTAMP"
)

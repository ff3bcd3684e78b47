"""Staging: typed, trimmed, deduplicated copies of the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lossline.functions.columns import clean_lower, clean_upper


def stg_policyholders(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("policyholder_id").isNotNull()).select(
        F.col("policyholder_id").cast("bigint"),
        F.trim("first_name").alias("first_name"),
        F.trim("last_name").alias("last_name"),
        F.col("date_of_birth").cast("date"),
        clean_upper("gender").alias("gender"),
        clean_upper("state_code").alias("state_code"),
        F.coalesce(F.trim("city"), F.lit("unknown")).alias("city"),
        F.coalesce(clean_lower("occupation"), F.lit("unknown")).alias("occupation"),
        F.col("registration_date").cast("date"),
    )


def stg_policies(raw: DataFrame) -> DataFrame:
    start, end = F.col("effective_date").cast("date"), F.col("expiration_date").cast("date")
    return raw.filter(F.col("policy_id").isNotNull() & (start < end)).select(
        F.col("policy_id").cast("bigint"),
        F.col("policyholder_id").cast("bigint"),
        F.trim("policy_number").alias("policy_number"),
        clean_lower("coverage_type").alias("coverage_type"),
        start.alias("effective_date"),
        end.alias("expiration_date"),
        F.col("annual_premium").cast("decimal(14,2)"),
        F.col("deductible").cast("decimal(14,2)"),
        F.col("coverage_limit").cast("decimal(16,2)"),
        clean_lower("status").alias("status"),
        F.datediff(end, start).alias("policy_term_days"),
    )


def earliest_report(raw: DataFrame) -> DataFrame:
    """One row per claim: the earliest report, undated reports last, ties by the other columns.

    The least struct per claim is an aggregate, so copies are thinned out before the shuffle
    and a claim with very many copies costs no task more than one row per map partition.
    """
    rest = [c for c in raw.columns if c not in ("claim_id", "report_date")]
    first = F.min(F.struct(F.col("report_date").isNull().alias("undated"), "report_date", *rest))
    kept = raw.filter(F.col("claim_id").isNotNull()).groupBy("claim_id").agg(first.alias("first"))
    return kept.select("claim_id", "first.report_date", *[f"first.{c}" for c in rest])


def stg_claims(raw: DataFrame) -> DataFrame:
    accident, report = F.col("accident_date").cast("date"), F.col("report_date").cast("date")
    return earliest_report(raw).select(
        F.col("claim_id").cast("bigint"),
        F.col("policy_id").cast("bigint"),
        F.trim("claim_number").alias("claim_number"),
        accident.alias("accident_date"),
        report.alias("report_date"),
        F.col("close_date").cast("date"),
        clean_lower("claim_status").alias("claim_status"),
        F.coalesce(clean_lower("cause_of_loss"), F.lit("not_specified")).alias("cause_of_loss"),
        F.col("initial_reserve").cast("decimal(16,2)"),
        F.col("current_reserve").cast("decimal(16,2)"),
        F.datediff(report, accident).alias("report_delay_days"),
        F.year(accident).alias("accident_year"),
        F.quarter(accident).alias("accident_quarter"),
    )


def stg_claim_payments(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("payment_id").isNotNull()).select(
        F.col("payment_id").cast("bigint"),
        F.col("claim_id").cast("bigint"),
        F.col("payment_date").cast("date"),
        F.col("payment_amount").cast("decimal(16,2)"),
        clean_lower("payment_type").alias("payment_type"),
        F.col("cumulative_paid").cast("decimal(16,2)"),
    )


def stg_coverages(raw: DataFrame) -> DataFrame:
    return raw.select(
        clean_lower("coverage_type").alias("coverage_type"),
        clean_lower("coverage_category").alias("coverage_category"),
        F.trim("description").alias("description"),
    )

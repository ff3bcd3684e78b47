"""Marts: the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from lossline.config import Config
from lossline.functions.columns import completed_years, date_key, flag


def calendar_span_of(claims: DataFrame, payments: DataFrame, cfg: Config) -> DataFrame:
    """The configured calendar, and as many whole years more as accident and payment dates need."""
    days = claims.select(F.col("accident_date").alias("day")).union(payments.select("payment_date"))
    return days.agg(
        F.least(F.make_date(F.year(F.min("day")), F.lit(1), F.lit(1)), F.lit(cfg.spine_start)).alias("first_day"),
        F.greatest(F.make_date(F.year(F.max("day")), F.lit(12), F.lit(31)), F.lit(cfg.spine_end)).alias("last_day"),
    )


def dim_date(span: DataFrame) -> DataFrame:
    """One row per day of the span (columns first_day, last_day)."""
    day = F.col("full_date")
    month_end = day == F.last_day(day)
    weekday = F.dayofweek(day) - 1  # 0 = Sunday
    return span.select(F.explode(F.sequence("first_day", "last_day")).alias("full_date")).select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("iso_week"),
        weekday.isin(0, 6).alias("is_weekend"),
        month_end.alias("is_month_end"),
        (month_end & (F.month(day) % 3 == 0)).alias("is_quarter_end"),
        (month_end & (F.month(day) == 12)).alias("is_year_end"),
        F.year(day).alias("fiscal_year"),
        F.quarter(day).alias("fiscal_quarter"),
        F.concat(F.year(day).cast("string"), F.lit("-Q"), F.quarter(day).cast("string")).alias("year_quarter_label"),
    )


def dim_policyholder(policyholders: DataFrame, cfg: Config) -> DataFrame:
    return policyholders.select(
        "policyholder_id",
        "first_name",
        "last_name",
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        "date_of_birth",
        completed_years("date_of_birth", "registration_date").alias("age_at_registration"),
        completed_years("date_of_birth", F.lit(cfg.valuation_date)).alias("current_age"),
        "gender",
        "state_code",
        "city",
        "occupation",
        "registration_date",
    )


def dim_policy(policies: DataFrame, coverages: DataFrame, cfg: Config) -> DataFrame:
    valuation = F.lit(cfg.valuation_date)
    in_force = (
        (F.col("status") == "active") & (F.col("effective_date") <= valuation) & (F.col("expiration_date") > valuation)
    )
    cover = coverages.withColumnRenamed("description", "coverage_description")
    return policies.join(cover, "coverage_type", "left").select(
        "policy_id",
        "policyholder_id",
        "policy_number",
        "coverage_type",
        "coverage_category",
        "coverage_description",
        "effective_date",
        "expiration_date",
        "policy_term_days",
        "annual_premium",
        "deductible",
        "coverage_limit",
        "status",
        F.year("effective_date").alias("policy_year"),
        flag(in_force).alias("is_currently_active"),
    )


def dim_coverage(coverages: DataFrame) -> DataFrame:
    """Numbered coverages. The table is a short code list, so one sort in one task is enough."""
    key = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("coverage_type"))
    return coverages.select(key.alias("coverage_key"), "coverage_type", "coverage_category", "description")


def payment_summary(payments: DataFrame) -> DataFrame:
    """Paid amounts per claim, split by payment type."""

    def of_type(kind: str):
        return F.sum(F.when(F.col("payment_type") == kind, F.col("payment_amount")))

    return payments.groupBy("claim_id").agg(
        of_type("indemnity").alias("total_indemnity"),
        of_type("expense").alias("total_expense"),
        of_type("recovery").alias("total_recovery"),
        F.sum("payment_amount").alias("total_paid"),
        F.count("*").alias("payment_count"),
        F.min("payment_date").alias("first_payment_date"),
        F.max("payment_date").alias("last_payment_date"),
    )


def fct_claims(enriched: DataFrame, payments: DataFrame) -> DataFrame:
    """One row per claim with reserves, paid amounts and incurred."""
    amounts = ["total_indemnity", "total_expense", "total_recovery", "total_paid"]
    zero = F.lit(0).cast("decimal(26,2)")
    joined = enriched.join(payment_summary(payments), "claim_id", "left").withColumns(
        {**{c: F.coalesce(c, zero) for c in amounts}, "payment_count": F.coalesce("payment_count", F.lit(0))}
    )
    return joined.select(
        "claim_id",
        "policy_id",
        "policyholder_id",
        "claim_number",
        date_key("accident_date").alias("accident_date_key"),
        date_key("report_date").alias("report_date_key"),
        "accident_date",
        "report_date",
        "close_date",
        "claim_status",
        "cause_of_loss",
        "coverage_type",
        "coverage_category",
        "accident_year",
        "accident_quarter",
        "report_delay_days",
        "development_months_at_valuation",
        "is_large_loss",
        "annual_premium",
        "deductible",
        "coverage_limit",
        "initial_reserve",
        "current_reserve",
        *amounts,
        "payment_count",
        "first_payment_date",
        "last_payment_date",
        (F.col("total_paid") + F.col("current_reserve")).alias("incurred_amount"),
        F.col("total_paid").alias("net_paid"),
    )


def fct_claim_payments(cumulative: DataFrame) -> DataFrame:
    """One row per payment with date keys and development period."""
    return cumulative.select(
        "payment_id",
        "claim_id",
        date_key("payment_date").alias("payment_date_key"),
        date_key("accident_date").alias("accident_date_key"),
        "payment_date",
        "accident_date",
        "development_year",
        "development_months",
        "accident_year",
        "payment_amount",
        "payment_type",
        "cumulative_paid",
        "payment_rank",
        "coverage_type",
        "claim_status",
    )

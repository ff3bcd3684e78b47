"""Intermediate models: claims in policy context, payment development, exposure."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lossline.config import Config
from lossline.functions.columns import flag, month_distance, prorated_money
from lossline.functions.ordering import keyed_running_parts

PAYMENT_ORDER = ["payment_date", "payment_id", "payment_amount"]


def int_claims_enriched(claims: DataFrame, policies: DataFrame, coverages: DataFrame, cfg: Config) -> DataFrame:
    policy = policies.select(
        "policy_id",
        "policyholder_id",
        "policy_number",
        "coverage_type",
        F.col("effective_date").alias("policy_effective_date"),
        F.col("expiration_date").alias("policy_expiration_date"),
        "annual_premium",
        "deductible",
        "coverage_limit",
        F.col("status").alias("policy_status"),
    )
    cover = coverages.withColumnRenamed("description", "coverage_description")
    months = month_distance("accident_date", F.lit(cfg.valuation_date))
    large = flag(F.col("initial_reserve") > cfg.large_loss_threshold)
    return (
        claims.join(policy, "policy_id")
        .join(cover, "coverage_type", "left")
        .withColumns({"development_months_at_valuation": months, "is_large_loss": large})
    )


def payment_development(payments: DataFrame, claims: DataFrame, policies: DataFrame) -> DataFrame:
    """Payments of known claims with their accident year and development period.

    Carries no running totals, so the reports that need none pay for no window.
    """
    context = claims.join(policies.select("policy_id", "coverage_type"), "policy_id").select(
        "claim_id", "accident_date", "accident_year", "coverage_type", "claim_status"
    )
    paid = [c for c in payments.columns if c != "claim_id"]
    return payments.join(context, "claim_id").select(
        "claim_id",
        *paid,
        "accident_date",
        "accident_year",
        "coverage_type",
        "claim_status",
        (F.year("payment_date") - F.col("accident_year")).alias("development_year"),
        month_distance("accident_date", "payment_date").alias("development_months"),
    )


def int_claim_payments_cumulative(
    payments: DataFrame, claims: DataFrame, policies: DataFrame
) -> DataFrame:
    """Running paid total and payment number per claim, recomputed from the payments.

    The running total needs payment columns only, so it is taken before the join, which finds the payments dealt out by
    claim already; a claim with very many payments is cut by day (see functions.ordering).
    """
    short, long = keyed_running_parts(
        payments.drop("cumulative_paid"),
        "claim_id",
        PAYMENT_ORDER,
        "payment_amount",
        "cumulative_paid",
        "payment_rank",
    )
    return payment_development(short, claims, policies).unionByName(payment_development(long, claims, policies))


def int_policy_exposure(policies: DataFrame, cfg: Config) -> DataFrame:
    """Exposure of policies in force, clipped to the observation window."""
    start, end = F.col("exposure_start"), F.col("exposure_end")
    days = F.datediff(end, start)
    term = F.datediff("expiration_date", "effective_date")
    return (
        policies.filter(F.col("status") != "cancelled")
        .select(
            "policy_id",
            "policyholder_id",
            "policy_number",
            "coverage_type",
            "effective_date",
            "expiration_date",
            "annual_premium",
            "status",
            F.greatest("effective_date", F.lit(cfg.observation_start)).alias("exposure_start"),
            F.least("expiration_date", F.lit(cfg.valuation_date)).alias("exposure_end"),
        )
        .filter(end > start)
        .withColumns(
            {
                "exposure_days": days,
                "exposure_years": days.cast("double") / 365.25,
                "earned_premium": prorated_money(F.col("annual_premium"), days, term),
                "exposure_year": F.year("exposure_start"),
            }
        )
    )

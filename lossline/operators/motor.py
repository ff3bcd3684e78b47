"""Motor third-party liability data set (frequency and severity tables) in warehouse shape."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from lossline.functions.columns import ratio
from lossline.functions.ordering import ord_running_sum

# Fixed values of the mapping.
START = date(2020, 1, 1)
ACCIDENT = date(2020, 6, 15)
REPORT = date(2020, 6, 20)
COVERAGE, CATEGORY = "auto", "property_casualty"
AREA_STATES = {"A": "CDMX", "B": "JAL", "C": "NL", "D": "GTO", "E": "PUE"}
OTHER_STATE = "MEX"
TRAIN_YEAR, TEST_YEAR = 2020, 2024

CHUNK = 100_000


def _days() -> Column:
    """The year-fraction in whole days, halves to the even day."""
    return F.rint(F.col("Exposure").cast("double") * 365).cast("int")


def _premium() -> Column:
    return (500 + F.col("BonusMalus") * 5).cast("decimal(14,2)")


def _number(prefix: str, key: Column) -> Column:
    """At least six digits; longer ids stay whole."""
    digits = key.cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(digits) < 6, F.lpad(digits, 6, "0")).otherwise(digits))


def _policy_columns() -> dict[str, Column]:
    key = F.col("IDpol").cast("bigint")
    return {
        "policy_id": key,
        "policyholder_id": key,
        "policy_number": _number("POL-", key),
        "coverage_type": F.lit(COVERAGE),
        "effective_date": F.lit(START),
        "expiration_date": F.date_add(F.lit(START), _days()),
        "annual_premium": _premium(),
        "status": F.lit("active"),
    }


def _exact(years: Column) -> Column:
    """A year-fraction as a decimal, so that a sum does not depend on row order."""
    return years.cast("decimal(28,18)")


def _select(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return df.select(*[c.alias(n) for n, c in columns.items()])


def split_year(key: Column) -> Column:
    """A fifth of the policies, by a hash any engine can compute, form the test year."""
    bucket = F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 8), 16, 10).cast("bigint") % 5
    return F.when(bucket == 0, TEST_YEAR).otherwise(TRAIN_YEAR)


def fremtpl_policies(frequency: DataFrame) -> DataFrame:
    return _select(
        frequency,
        _policy_columns()
        | {
            "coverage_category": F.lit(CATEGORY),
            "coverage_description": F.lit("Motor third-party liability"),
            "policy_term_days": _days(),
            "deductible": (F.col("VehPower") * 100).cast("decimal(14,2)"),
            "coverage_limit": (F.col("VehPower") * 10000).cast("decimal(16,2)"),
            "policy_year": split_year(F.col("IDpol")),
            "is_currently_active": F.lit(True),
        },
    )


def fremtpl_policyholders(frequency: DataFrame) -> DataFrame:
    key = F.col("IDpol").cast("bigint")
    state = F.lit(OTHER_STATE)
    for area, name in AREA_STATES.items():
        state = F.when(F.col("Area") == area, name).otherwise(state)
    age = F.col("DrivAge").cast("int")
    return _select(
        frequency,
        {
            "policyholder_id": key,
            "first_name": F.lit("Policyholder"),
            "last_name": key.cast("string"),
            "full_name": F.concat(F.lit("Policyholder "), key.cast("string")),
            "date_of_birth": F.add_months(F.lit(START), -12 * age),
            "age_at_registration": age,
            "current_age": age,
            "gender": F.when(key % 2 == 0, "M").otherwise("F"),
            "state_code": state,
            "city": F.col("Region"),
            "occupation": F.lit("conductor"),
            "registration_date": F.lit(START),
        },
    )


def fremtpl_claims(frequency: DataFrame, severity: DataFrame, ranges: int | None = None) -> DataFrame:
    """One row per severity record of a policy with claims, numbered by policy and falling amount."""
    insured = frequency.filter(F.col("ClaimNb") > 0).select(F.col("IDpol").cast("bigint").alias("policy_id"))
    records = (
        severity.groupBy(F.col("IDpol").cast("bigint").alias("policy_id"), "ClaimAmount")
        .agg(F.count("*").alias("copies"))
        .join(insured, "policy_id")
        .withColumn("falling", -F.col("ClaimAmount").cast("double"))
    )
    through = ord_running_sum(records, ["policy_id", "falling"], "copies", "through", ranges=ranges)
    # Equal records were counted; give each copy its number again, a bounded chunk at a time.
    chunks = through.withColumn(
        "chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(copies - 1) div {CHUNK}")))
    ).repartition("policy_id", "falling", "chunk")
    here = F.least(F.lit(CHUNK), F.col("copies") - F.col("chunk") * CHUNK).cast("int")
    numbered = chunks.withColumn("copy", F.explode(F.sequence(F.lit(1), here))).withColumn(
        "claim_id", F.col("through") - F.col("copies") + F.col("chunk") * CHUNK + F.col("copy")
    )
    amount = F.col("ClaimAmount").cast("decimal(16,2)")
    return _select(
        numbered,
        {
            "claim_id": F.col("claim_id"),
            "policy_id": F.col("policy_id"),
            "policyholder_id": F.col("policy_id"),
            "claim_number": _number("CLM-", F.col("claim_id")),
            "accident_date": F.lit(ACCIDENT),
            "report_date": F.lit(REPORT),
            "status": F.lit("closed"),
            "total_paid": amount,
            "incurred_amount": amount,
            "total_reserved": F.lit(0).cast("decimal(16,2)"),
            "coverage_type": F.lit(COVERAGE),
        },
    )


def fremtpl_exposure(frequency: DataFrame) -> DataFrame:
    years = F.col("Exposure")
    return _select(
        frequency,
        _policy_columns()
        | {
            "exposure_start": F.lit(START),
            "exposure_end": F.date_add(F.lit(START), _days()),
            "exposure_days": _days(),
            "exposure_years": years.cast("double"),
            "earned_premium": (_premium() * years.cast("double")).cast("decimal(14,2)"),
            "exposure_year": F.lit(START.year),
        },
    )


def fremtpl_frequency(frequency: DataFrame, severity: DataFrame) -> DataFrame:
    """The portfolio in one row. Severity is summed per policy before it meets the policies."""
    cost = severity.groupBy("IDpol").agg(F.sum("ClaimAmount").alias("cost"))
    total = frequency.join(cost, "IDpol", "left").agg(
        F.count("*").alias("policy_count"),
        F.sum(_exact(F.col("Exposure"))).cast("double").alias("exposure_years"),
        F.sum((_premium() * F.col("Exposure").cast("double")).cast("decimal(18,3)")).alias("earned_premium"),
        F.sum("ClaimNb").alias("claim_count"),
        F.coalesce(F.sum("cost").cast("decimal(38,2)"), F.lit(0).cast("decimal(38,2)")).alias("total_paid"),
    )
    paid, claims, years = F.col("total_paid"), F.col("claim_count"), F.col("exposure_years")
    return total.select(
        F.lit(START.year).alias("year"),
        F.lit(COVERAGE).alias("coverage_type"),
        "policy_count",
        "exposure_years",
        "earned_premium",
        "claim_count",
        "total_paid",
        F.coalesce(ratio(paid, claims), F.lit(0.0)).alias("avg_severity"),
        paid.alias("total_incurred"),
        ratio(claims, years).alias("claim_frequency"),
        ratio(paid, years).alias("pure_premium"),
        ratio(paid, F.col("earned_premium")).alias("loss_ratio"),
    )


def fremtpl_coverage(frequency: DataFrame) -> DataFrame:
    """The single coverage of the data set, present as soon as there is a policy."""
    return frequency.agg(F.count("*").alias("n")).filter("n > 0").select(
        F.lit(1).alias("coverage_key"),
        F.lit(COVERAGE).alias("coverage_type"),
        F.lit(CATEGORY).alias("coverage_category"),
        F.lit("Motor TPL").alias("description"),
    )


def fremtpl_summary(policies: DataFrame, exposure: DataFrame, claims: DataFrame) -> DataFrame:
    """Portfolio figures in one row, from three independent aggregates of one row each."""
    book = policies.agg(
        F.count("*").alias("n_policies"),
        F.round(F.sum("annual_premium").cast("double") / F.count("annual_premium"), 2).alias("avg_premium"),
        F.count_if(F.col("policy_year") <= 2023).alias("train_policies"),
        F.count_if(F.col("policy_year") > 2023).alias("test_policies"),
    )
    years = exposure.join(policies.select("policy_id"), "policy_id", "left_semi").agg(
        F.sum(_exact(F.col("exposure_years"))).cast("double").alias("years")
    )
    loss = claims.agg(
        F.countDistinct("policy_id").alias("policies_with_claims"),
        F.count("*").alias("total_claims"),
        F.sum("total_paid").alias("paid"),
    )
    # Three rows with different columns; the greatest value per column puts them into one.
    rows = book.unionByName(years, allowMissingColumns=True).unionByName(loss, allowMissingColumns=True)
    return rows.agg(*[F.max(c).alias(c) for c in rows.columns]).select(
        "n_policies",
        F.round("years", 1).alias("total_exposure"),
        "policies_with_claims",
        "total_claims",
        "avg_premium",
        F.round(ratio(F.col("paid"), F.col("years")), 2).alias("portfolio_pure_premium"),
        "train_policies",
        "test_policies",
    )

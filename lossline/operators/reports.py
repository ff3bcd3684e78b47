"""Actuarial reports: development triangle, link ratios, ultimates, frequency."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window, functions as F

from lossline.functions.columns import mean_of, ratio


def triangle_long(payments: DataFrame) -> DataFrame:
    """Cumulative paid by accident year and development year (not negative), long form.

    The window runs over one row per (accident year, development year) only.
    """
    by_cell = (
        payments.filter(F.col("development_year") >= 0)
        .groupBy("accident_year", "development_year")
        .agg(F.sum("payment_amount").alias("incremental_paid"))
    )
    so_far = Window.partitionBy("accident_year").orderBy("development_year").rowsBetween(Window.unboundedPreceding, 0)
    return by_cell.withColumn("cumulative_paid", F.sum("incremental_paid").over(so_far))


def rpt_loss_triangle(payments: DataFrame, max_dev: int = 5) -> DataFrame:
    """The triangle, one column per development year; cells without payments stay null.

    claim_count counts every claim paid in the accident year, also one paid only before it.
    Payments are read once: they are summed per claim and development year first, which
    reuses the partitioning of the join by claim, and one row of each claim carries its count.
    """
    per_claim = payments.groupBy("claim_id", "accident_year", "development_year").agg(
        F.sum("payment_amount").alias("paid")
    )
    first = F.row_number().over(Window.partitionBy("claim_id").orderBy("development_year")) == 1
    by_cell = (
        per_claim.withColumn("claims", first.cast("bigint"))
        .groupBy("accident_year", "development_year")
        .agg(F.sum("paid").alias("paid"), F.sum("claims").alias("claims"))
    )
    dev = F.col("development_year")
    so_far = Window.partitionBy("accident_year").orderBy(dev).rowsBetween(Window.unboundedPreceding, 0)
    cumulative = F.sum(F.when(dev >= 0, F.col("paid"))).over(so_far)
    return (
        by_cell.withColumn("cumulative", F.when(dev >= 0, cumulative))
        .groupBy("accident_year")
        .agg(
            *[F.max(F.when(dev == d, F.col("cumulative"))).alias(f"dev_year_{d}") for d in range(max_dev + 1)],
            F.max("cumulative").alias("latest_cumulative"),
            F.sum("claims").alias("claim_count"),
        )
        .filter(F.col("latest_cumulative").isNotNull())
    )


def triangle_as_of(payments: DataFrame, valuations: DataFrame, max_dev: int = 5) -> DataFrame:
    """The triangle as it was known at each valuation date (one column as_of).

    Every payment counts at its first valuation date; what is known later is a running sum over valuations. A date finds
    its valuation in the calendar of payment and valuation days, so payments meet one row each, however many valuations
    there are. Beyond that only cells of the result are made. Payments after the last valuation take no part.
    """
    daily = (
        payments.filter(F.col("development_year") >= 0)
        .groupBy("accident_year", "development_year", "payment_date")
        .agg(F.sum("payment_amount").alias("paid"))
    )
    dates = valuations.select("as_of").filter(F.col("as_of").isNotNull()).distinct()
    # One row per day of the calendar: bounded, whatever the payments.
    numbered = dates.withColumn("_nr", F.row_number().over(Window.orderBy("as_of")))
    days = daily.select(F.col("payment_date").alias("_day")).distinct().withColumn("_nr", F.lit(None).cast("int"))
    calendar = days.unionByName(numbered.select(F.col("as_of").alias("_day"), "_nr"))
    ahead = Window.orderBy("_day").rangeBetween(Window.currentRow, Window.unboundedFollowing)
    first = calendar.withColumn("_first", F.min("_nr").over(ahead)).filter(F.col("_first").isNotNull()).select("_day", "_first").distinct()
    added = (
        daily.join(first, daily.payment_date == first["_day"])
        .groupBy("accident_year", "development_year", F.col("_first").alias("_nr"))
        .agg(F.sum("paid").alias("paid"))
    )
    cell = ["accident_year", "development_year"]
    last = numbered.agg(F.max("_nr").alias("_last"))
    begun = added.groupBy(*cell).agg(F.min("_nr").alias("_begun")).crossJoin(F.broadcast(last))  # one row
    cells = begun.select(*cell, F.explode(F.sequence("_begun", "_last")).alias("_nr"))
    by_time = Window.partitionBy(*cell).orderBy("_nr").rowsBetween(Window.unboundedPreceding, 0)
    by_dev = Window.partitionBy("_nr", "accident_year").orderBy("development_year").rowsBetween(Window.unboundedPreceding, 0)
    devs = list(range(max_dev + 1))
    dev = F.col("development_year")
    return (
        cells.join(added, [*cell, "_nr"], "left")
        .withColumn("known", F.sum("paid").over(by_time))
        .withColumn("cumulative", F.sum("known").over(by_dev))
        .groupBy("_nr", "accident_year")
        .agg(*[F.max(F.when(dev == d, F.col("cumulative"))).alias(f"dev_year_{d}") for d in devs])
        .join(numbered, "_nr")
        .select("as_of", "accident_year", *[f"dev_year_{d}" for d in devs])
    )


def _development_pairs(long: DataFrame) -> DataFrame:
    """Adjacent cells of one accident year where both amounts are positive."""
    later = long.select(
        "accident_year",
        (F.col("development_year") - 1).alias("development_year"),
        F.col("cumulative_paid").alias("next_paid"),
    )
    return long.join(later, ["accident_year", "development_year"]).filter(
        (F.col("cumulative_paid") > 0) & (F.col("next_paid") > 0)
    )


def bi_link_ratios(long: DataFrame) -> DataFrame:
    """Age-to-age factors from development year d to d + 1."""
    factor = F.col("next_paid").cast("double") / F.col("cumulative_paid").cast("double")
    return _development_pairs(long).select(
        "accident_year",
        F.col("development_year").alias("from_dev"),
        (F.col("development_year") + 1).alias("to_dev"),
        F.round(factor, 4).alias("link_ratio"),
    )


def weighted_factors(long: DataFrame) -> DataFrame:
    """Volume-weighted age-to-age factor per development year, not rounded."""
    return (
        _development_pairs(long)
        .groupBy(F.col("development_year").alias("from_dev"))
        .agg(F.sum("next_paid").alias("later"), F.sum("cumulative_paid").alias("earlier"))
        .select("from_dev", (F.col("later").cast("double") / F.col("earlier").cast("double")).alias("factor"))
    )


def bi_weighted_factors(long: DataFrame) -> DataFrame:
    return weighted_factors(long).select("from_dev", F.round("factor", 4).alias("weighted_factor"))


def chain_ladder_ultimate(long: DataFrame) -> DataFrame:
    """Ultimate per accident year: latest paid times the factors still to come.

    The table has one row per development year, so the product runs over a few rows.
    """
    onward = Window.partitionBy(F.lit(0)).orderBy(F.col("from_dev").desc()).rowsBetween(Window.unboundedPreceding, 0)
    to_ultimate = weighted_factors(long).select(
        F.col("from_dev").alias("latest_dev"), F.exp(F.sum(F.log("factor")).over(onward)).alias("factor_to_ultimate")
    )
    latest = long.groupBy("accident_year").agg(
        F.max("development_year").alias("latest_dev"),
        F.max_by("cumulative_paid", "development_year").alias("latest_paid"),
    )
    factor = F.coalesce("factor_to_ultimate", F.lit(1.0))
    return latest.join(to_ultimate, "latest_dev", "left").select(
        "accident_year",
        "latest_dev",
        "latest_paid",
        factor.alias("factor_to_ultimate"),
        (F.col("latest_paid").cast("double") * factor).alias("ultimate"),
    )


def ibnr(ultimate: DataFrame, claims: DataFrame) -> DataFrame:
    """Ultimate less paid and case reserve, per accident year."""
    known = claims.groupBy("accident_year").agg(
        F.sum("total_paid").alias("paid"), F.sum("current_reserve").alias("case_reserve")
    )
    incurred = F.col("paid").cast("double") + F.col("case_reserve").cast("double")
    return ultimate.join(known, "accident_year").select(
        "accident_year", "ultimate", "paid", "case_reserve", (F.col("ultimate") - incurred).alias("ibnr")
    )


def rpt_claim_frequency(claims: DataFrame, exposure: DataFrame) -> DataFrame:
    """Frequency, pure premium and loss ratio by year and coverage.

    Exposure is summed in days and divided once, so the result does not depend on row order.
    """
    loss = claims.groupBy(F.col("accident_year").alias("year"), "coverage_type").agg(
        F.count("*").alias("claim_count"),
        F.sum("total_paid").alias("total_paid"),
        F.sum("incurred_amount").alias("total_incurred"),
    )
    base = exposure.groupBy(F.col("exposure_year").alias("year"), "coverage_type").agg(
        F.count("*").alias("policy_count"),
        (F.sum("exposure_days").cast("double") / 365.25).alias("exposure_years"),
        F.sum("earned_premium").alias("earned_premium"),
    )
    zero = F.lit(0).cast("decimal(38,2)")
    rows = loss.join(base, ["year", "coverage_type"], "full").select(
        "year",
        "coverage_type",
        F.coalesce("policy_count", F.lit(0)).alias("policy_count"),
        F.coalesce("exposure_years", F.lit(0.0)).alias("exposure_years"),
        F.coalesce(F.col("earned_premium").cast("decimal(38,2)"), zero).alias("earned_premium"),
        F.coalesce("claim_count", F.lit(0)).alias("claim_count"),
        F.coalesce(F.col("total_paid").cast("decimal(38,2)"), zero).alias("total_paid"),
        F.coalesce(mean_of(F.col("total_paid"), F.col("claim_count")), F.lit(0.0)).alias("avg_severity"),
        F.coalesce(F.col("total_incurred").cast("decimal(38,2)"), zero).alias("total_incurred"),
    )
    return rows.withColumns(
        {
            "claim_frequency": F.round(ratio(F.col("claim_count"), F.col("exposure_years")), 4),
            "pure_premium": F.round(ratio(F.col("total_incurred"), F.col("exposure_years")), 2),
            "loss_ratio": F.round(ratio(F.col("total_incurred"), F.col("earned_premium")), 4),
        }
    )

"""Dashboard and summary queries over marts and reports. Filters are bound as values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lossline.functions.columns import mean_of, ratio

# State codes and names, with the alternate codes last.
STATE_NAMES = {
    "AGU": "Aguascalientes",
    "BCN": "Baja California",
    "BCS": "Baja California Sur",
    "CAM": "Campeche",
    "CHP": "Chiapas",
    "CHH": "Chihuahua",
    "COA": "Coahuila de Zaragoza",
    "COL": "Colima",
    "CDMX": "Ciudad de Mexico",
    "DUR": "Durango",
    "GUA": "Guanajuato",
    "GRO": "Guerrero",
    "HID": "Hidalgo",
    "JAL": "Jalisco",
    "MEX": "Mexico",
    "MIC": "Michoacan de Ocampo",
    "MOR": "Morelos",
    "NAY": "Nayarit",
    "NLE": "Nuevo Leon",
    "OAX": "Oaxaca",
    "PUE": "Puebla",
    "QUE": "Queretaro",
    "ROO": "Quintana Roo",
    "SLP": "San Luis Potosi",
    "SIN": "Sinaloa",
    "SON": "Sonora",
    "TAB": "Tabasco",
    "TAM": "Tamaulipas",
    "TLA": "Tlaxcala",
    "VER": "Veracruz de Ignacio de la Llave",
    "YUC": "Yucatan",
    "ZAC": "Zacatecas",
    "NL": "Nuevo Leon",
    "QRO": "Queretaro",
    "QROO": "Quintana Roo",
    "MICH": "Michoacan de Ocampo",
    "CHIS": "Chiapas",
    "CHIH": "Chihuahua",
    "COAH": "Coahuila de Zaragoza",
    "DF": "Ciudad de Mexico",
}

TOP = 20


def _mean(name: str):
    return F.round(mean_of(F.sum(name), F.count(name)), 2)


def summary_claims(claims: DataFrame) -> DataFrame:
    status = F.col("claim_status")
    return claims.agg(
        F.count("*").alias("total_claims"),
        F.count_if(status == "open").alias("open_claims"),
        F.count_if(status == "closed").alias("closed_claims"),
        F.sum("total_paid").alias("total_paid"),
        F.sum("incurred_amount").alias("total_incurred"),
        _mean("total_paid").alias("avg_paid_per_claim"),
    )


def summary_triangle_preview(triangle: DataFrame) -> DataFrame:
    devs = [c for c in triangle.columns if c.startswith("dev_year_")]
    return triangle.select("accident_year", *[F.round(c, 0).alias(c) for c in devs], "claim_count")


def summary_frequency_by_coverage(claims: DataFrame, exposure: DataFrame) -> DataFrame:
    """Frequency report rolled up to coverages; exposure days are summed before dividing."""
    loss = claims.groupBy("coverage_type").agg(
        F.count("*").cast("double").alias("claims"), F.sum("incurred_amount").cast("double").alias("incurred")
    )
    base = exposure.groupBy("coverage_type").agg((F.sum("exposure_days").cast("double") / 365.25).alias("years"))
    return loss.join(base, "coverage_type", "full").select(
        "coverage_type",
        "claims",
        F.round("years", 1).alias("exposure_years"),
        F.round(ratio(F.col("claims"), F.col("years")), 4).alias("frequency"),
        F.round(ratio(F.col("incurred"), F.col("years")), 2).alias("pure_premium"),
    )


def bi_home_kpis(claims: DataFrame) -> DataFrame:
    return claims.agg(
        F.countDistinct("claim_id").alias("total_claims"),
        F.sum("total_paid").alias("total_paid"),
        _mean("total_paid").alias("avg_severity"),
        F.countDistinct("policyholder_id").alias("unique_policyholders"),
    )


def bi_portfolio_filter(frequency: DataFrame, coverages: Sequence[str], years: tuple[int, int]) -> DataFrame:
    return frequency.filter(F.col("coverage_type").isin(list(coverages)) & F.col("year").between(*years))


def _latest_year(frequency: DataFrame) -> DataFrame:
    """Rows of the last year. The report has one row per year and coverage."""
    last = frequency.agg(F.max("year").alias("year"))
    return frequency.join(F.broadcast(last), "year")  # one row


def bi_portfolio_kpis(frequency: DataFrame) -> DataFrame:
    paid = F.sum("total_paid")
    return (
        _latest_year(frequency)
        .groupBy("year")
        .agg(
            F.sum("claim_count").alias("total_claims"),
            F.round(F.sum("exposure_years"), 1).alias("total_exposure"),
            F.round(ratio(paid, F.sum("earned_premium")), 4).alias("portfolio_loss_ratio"),
            F.round(ratio(paid, F.sum("claim_count")), 2).alias("avg_severity"),
        )
    )


def bi_loss_ratio_rank(frequency: DataFrame) -> DataFrame:
    return _latest_year(frequency).select("coverage_type", "loss_ratio").orderBy(F.desc("loss_ratio"), "coverage_type")


def bi_geo_options(claims: DataFrame, policyholders: DataFrame) -> DataFrame:
    """Accident years and states with claims; claims are reduced per holder before the join."""
    held = claims.select("policyholder_id", "accident_year").distinct()
    return (
        held.join(policyholders.select("policyholder_id", "state_code"), "policyholder_id")
        .select("accident_year", "state_code")
        .distinct()
    )


def bi_geo_risk(
    claims: DataFrame, policyholders: DataFrame, years: tuple[int, int], states: Sequence[str] = ()
) -> DataFrame:
    """Claims, mean and total paid per state; claims are summed per holder before the join."""
    holder = policyholders.select("policyholder_id", "state_code")
    if states:
        holder = holder.filter(F.col("state_code").isin(list(states)))
    per_holder = (
        claims.filter(F.col("accident_year").between(*years))
        .groupBy("policyholder_id")
        .agg(F.count("claim_id").alias("claims"), F.count("total_paid").alias("n"), F.sum("total_paid").alias("paid"))
    )
    return (
        per_holder.join(holder, "policyholder_id")
        .groupBy("state_code")
        .agg(
            F.sum("claims").alias("claim_count"),
            F.round(mean_of(F.sum("paid"), F.sum("n")), 2).alias("avg_severity"),
            F.sum("paid").alias("total_paid"),
        )
    )


def bi_geo_kpis(by_state: DataFrame) -> DataFrame:
    return by_state.agg(
        F.countDistinct("state_code").alias("states"),
        F.sum("claim_count").alias("total_claims"),
        F.sum("total_paid").alias("total_paid"),
    )


def bi_geo_state_names(by_state: DataFrame) -> DataFrame:
    """Adds the state name; a code without one keeps the code."""
    names = F.create_map(*[F.lit(x) for pair in STATE_NAMES.items() for x in pair])
    return by_state.withColumn("state_name", F.coalesce(names[F.col("state_code")], F.col("state_code")))


def bi_geo_top20(by_state: DataFrame) -> DataFrame:
    return by_state.orderBy(F.desc("claim_count"), "state_code").limit(TOP)


def bi_assessment_distribution(scoring: DataFrame) -> DataFrame:
    return (
        scoring.filter(F.col("pricing_assessment").isNotNull())
        .groupBy(F.col("pricing_assessment").alias("assessment"))
        .agg(F.count("*").alias("count"))
    )


def _mean_ratio(scoring: DataFrame, key: str) -> DataFrame:
    return (
        scoring.groupBy(key)
        .agg(F.avg("price_adequacy_ratio").alias("avg_adequacy_ratio"))
        .orderBy(F.desc("avg_adequacy_ratio"), key)
    )


def bi_adequacy_by_age(scoring: DataFrame) -> DataFrame:
    return _mean_ratio(scoring, "age_band")


def bi_adequacy_by_state_group(scoring: DataFrame) -> DataFrame:
    return _mean_ratio(scoring, "state_risk_group")


def bi_top_underpriced(scoring: DataFrame) -> DataFrame:
    return (
        scoring.filter(F.col("pricing_assessment") == "underpriced")
        .orderBy(F.desc("price_adequacy_ratio"), "policy_id")
        .limit(TOP)
        .select(
            "policy_id",
            "coverage_type",
            "age_band",
            "state_risk_group",
            "predicted_pure_premium",
            "actual_premium",
            "price_adequacy_ratio",
        )
    )

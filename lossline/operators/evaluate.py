"""Scoring of premiums against predictions, and model evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from lossline.config import Config
from lossline.functions.columns import ratio
from lossline.functions.ordering import ord_rank_of_all
from lossline.functions.quantiles import exact_medians


def model_scoring(training: DataFrame, experience: DataFrame, predictions: DataFrame, cfg: Config) -> DataFrame:
    """Predicted loss cost against the premium charged; both null-safe for premiums of zero."""
    adequacy = F.col("price_adequacy_ratio")
    return (
        training.select("policy_id", "coverage_type", "age_band", "state_risk_group", "exposure_years")
        .join(experience.select("policy_id", F.col("annual_premium").alias("actual_premium")), "policy_id")
        .join(predictions.select("policy_id", "predicted_pure_premium"), "policy_id")
        .withColumn("price_adequacy_ratio", ratio(F.col("predicted_pure_premium"), F.col("actual_premium")))
        .withColumn(
            "pricing_assessment",
            F.when(adequacy > cfg.underpriced_above, "underpriced")
            .when(adequacy < cfg.overpriced_below, "overpriced")
            .when(adequacy.isNotNull(), "adequate"),
        )
    )


def _shares():
    total = F.count("*")
    return [
        F.round(100.0 * F.count_if(F.col("pricing_assessment") == kind) / total, 1).alias(f"pct_{kind}")
        for kind in ("underpriced", "overpriced", "adequate")
    ]


def scoring_summary(scoring: DataFrame) -> DataFrame:
    return scoring.filter(F.col("pricing_assessment").isNotNull()).agg(
        F.count("*").alias("total_scored"),
        F.round(F.avg("predicted_pure_premium"), 2).alias("avg_predicted_pp"),
        F.round(F.sum("actual_premium").cast("double") / F.count("actual_premium"), 2).alias("avg_actual_premium"),
        *_shares(),
    )


def pricing_adequacy_report(scoring: DataFrame) -> DataFrame:
    return (
        scoring.filter(F.col("pricing_assessment").isNotNull())
        .groupBy("coverage_type")
        .agg(
            F.count("*").alias("policy_count"),
            F.round(F.avg("price_adequacy_ratio"), 4).alias("avg_adequacy_ratio"),
            *_shares(),
        )
    )


def model_evaluation(training: DataFrame, predictions: DataFrame) -> DataFrame:
    """Errors per split and coverage. ae_ratio is predicted over actual cost, weighted by exposure."""
    actual, predicted, weight = F.col("target_pure_premium"), F.col("predicted_pure_premium"), F.col("exposure_years")
    error = predicted - actual
    return (
        training.select("policy_id", "split", "coverage_type", "target_pure_premium", "exposure_years")
        .join(predictions.select("policy_id", "predicted_pure_premium"), "policy_id")
        .groupBy("split", "coverage_type")
        .agg(
            F.count("*").alias("policy_count"),
            F.round(F.avg(actual), 2).alias("avg_actual_pp"),
            F.round(F.avg(predicted), 2).alias("avg_predicted_pp"),
            F.round(F.avg(error), 2).alias("avg_residual"),
            F.round(F.avg(F.abs(error)), 2).alias("mae"),
            F.round(F.sqrt(F.avg(error * error)), 2).alias("rmse"),
            F.round(ratio(F.sum(predicted * weight), F.sum(actual * weight)), 4).alias("ae_ratio"),
        )
    )


def _ranked(df: DataFrame, actual: str, predicted: str, key: str, ranges: int | None):
    narrow = df.select(F.col(key).alias("k"), F.col(actual).cast("double").alias("y"), F.col(predicted).cast("double").alias("p"))
    return ord_rank_of_all(narrow, ["p", "k"], "r", "n", ranges)


def eval_gini(df: DataFrame, actual: str, predicted: str, key: str, ranges: int | None = None) -> DataFrame:
    """Gini from the ordered Lorenz curve: one row; 0 for no rows or no losses.

    The area under the curve needs only each row's rank: a loss at rank r of n is part of
    n - r + 1 points of the cumulative curve.
    """
    ranked = _ranked(df, actual, predicted, key, ranges)
    total, weighted = F.sum("y"), F.sum(F.col("y") * (F.col("n") - F.col("r") + 1))
    gini = F.when(total != 0, 1 - 2 * weighted / (total * F.max("n"))).otherwise(0.0)
    return ranked.agg(gini.alias("gini"))


def eval_lift_table(
    df: DataFrame, actual: str, predicted: str, key: str, groups: int = 10, ranges: int | None = None
) -> DataFrame:
    """Mean predicted and actual by rank group; groups have n // groups rows, the last takes the rest."""
    ranked = _ranked(df, actual, predicted, key, ranges)
    size = F.expr(f"n div {groups}")
    group = F.when(size > 0, F.least(F.floor((F.col("r") - 1) / F.greatest(size, F.lit(1))) + 1, F.lit(groups))).otherwise(groups)
    by_group = ranked.groupBy(group.cast("int").alias("decile")).agg(
        F.avg("p").alias("p"), F.avg("y").alias("y"), F.sum("y").alias("total"), F.count("*").alias("count")
    )
    everything = Window.partitionBy(F.lit(0))  # one row per group
    overall = F.sum("total").over(everything) / F.sum("count").over(everything)
    return by_group.withColumn("overall", F.when(overall == 0, 1e-10).otherwise(overall)).select(
        "decile",
        F.round("p", 2).alias("avg_predicted"),
        F.round("y", 2).alias("avg_actual"),
        F.round(F.col("y") / F.col("overall"), 4).alias("lift"),
        "count",
    )


def eval_residuals(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Error measures in one row. The median error is exact (see functions.quantiles)."""
    error = (F.col(predicted) - F.col(actual)).cast("double")
    rows = df.select(F.col(actual).cast("double").alias("y"), error.alias("e"), F.abs(error).alias("size"))
    middle = F.broadcast(exact_medians(rows, ["size"]).agg(F.max("median").alias("middle")))  # one row
    relative = F.when(F.col("y") != 0, F.abs(F.col("e") / F.col("y")))
    return rows.crossJoin(middle).agg(
        F.round(F.avg("size"), 2).alias("mae"),
        F.round(F.sqrt(F.avg(F.col("e") * F.col("e"))), 2).alias("rmse"),
        F.round(F.coalesce(F.avg(relative), F.lit(0.0)), 4).alias("mape"),
        F.round(F.avg("e"), 2).alias("mean_residual"),
        F.round(F.stddev_pop("e"), 2).alias("std_residual"),
        F.round(F.max("middle"), 2).alias("median_absolute_error"),
    )

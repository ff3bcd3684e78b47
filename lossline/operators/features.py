"""Pricing features and the training set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lossline.config import Config
from lossline.functions.columns import flag, mean_of, ratio
from lossline.functions.ordering import ord_ntile
from lossline.functions.quantiles import exact_medians, tiles_by_cuts
from lossline.session import materialise

NUMERIC_FEATURES = [
    "log_premium",
    "log_deductible",
    "log_coverage_limit",
    "exposure_years",
    "benchmark_frequency",
    "benchmark_severity",
    "frequency_trend",
    "severity_trend",
]
CATEGORICAL_FEATURES = ["age_band", "state_risk_group", "occupation_risk_group", "coverage_type", "gender"]


def feat_policy_experience(policies: DataFrame, exposure: DataFrame, claims: DataFrame, cfg: Config) -> DataFrame:
    """Exposure and claims experience per policy."""
    paid = F.when(F.col("total_paid") > 0, F.col("total_paid"))
    loss = claims.groupBy("policy_id").agg(
        F.count("*").alias("claims"),
        F.sum("total_paid").alias("paid"),
        F.sum("incurred_amount").alias("incurred"),
        F.sum(paid).alias("positive_paid"),
        F.count(paid).alias("positive_claims"),
        F.max(paid).alias("largest"),
        F.max("accident_date").alias("last_claim_date"),
    )
    earned = exposure.groupBy("policy_id").agg(
        (F.sum("exposure_days").cast("double") / 365.25).alias("years"),
        F.sum("earned_premium").alias("premium"),
    )
    zero = F.lit(0).cast("decimal(38,2)")

    def money(name: str) -> Column:
        return F.coalesce(F.col(name).cast("decimal(38,2)"), zero)

    return (
        policies.join(earned, "policy_id", "left")
        .join(loss, "policy_id", "left")
        .select(
            "policy_id",
            "policyholder_id",
            "coverage_type",
            "annual_premium",
            "deductible",
            "coverage_limit",
            F.col("status").alias("policy_status"),
            F.coalesce("years", F.lit(0.0)).alias("exposure_years"),
            money("premium").alias("earned_premium"),
            F.coalesce("claims", F.lit(0)).alias("claim_count"),
            F.coalesce(ratio(F.coalesce("claims", F.lit(0)), F.col("years")), F.lit(0.0)).alias("claim_frequency"),
            money("paid").alias("total_paid"),
            money("incurred").alias("total_incurred"),
            F.coalesce(mean_of(F.col("positive_paid"), F.col("positive_claims")), F.lit(0.0)).alias("avg_severity"),
            money("largest").alias("max_severity"),
            flag(F.col("largest") > cfg.large_loss_threshold).alias("has_large_loss"),
            F.datediff(F.lit(cfg.valuation_date), "last_claim_date").alias("days_since_last_claim"),
        )
    )


def _risk_group(experience: DataFrame, key: str, name: str) -> DataFrame:
    """Low, medium or high by the loss ratio of the groups of key, a third of the groups each.

    Equal ratios are told apart by the key itself. Occupations are free text, so there may be as many as policyholders: the
    groups are dealt out by range, not ranked in one task.
    """
    groups = experience.groupBy(key).agg(
        F.sum("total_incurred").alias("incurred"), F.sum("earned_premium").alias("earned")
    )
    loss_ratio = F.coalesce(ratio(F.col("incurred"), F.col("earned")), F.lit(0.0))
    tiled = ord_ntile(groups.select(key, loss_ratio.alias("loss_ratio")), ["loss_ratio", key], 3, "_tile")
    group = F.when(F.col("_tile") == 1, "low").when(F.col("_tile") == 2, "medium").otherwise("high")
    return tiled.select(key, group.alias(name))


def age_band(age: Column) -> Column:
    """Bands of completed years. Below 18 and unknown ages count as the last band."""
    return (
        F.when(age.between(18, 25), "18-25")
        .when(age.between(26, 35), "26-35")
        .when(age.between(36, 45), "36-45")
        .when(age.between(46, 55), "46-55")
        .when(age.between(56, 65), "56-65")
        .otherwise("65+")
    )


def feat_risk_segments(experience: DataFrame, policyholders: DataFrame) -> DataFrame:
    """Risk groups per policy.

    Policies are joined with their holders once and written: bands and groups are passes over that table. A holder that is
    there more than once repeats a policy in all but the quarters of the premium, where the policy counts once.
    """
    about = ["current_age", "state_code", "occupation", "gender"]
    copies = Window.partitionBy("policyholder_id").orderBy(*about)
    holder = policyholders.select("policyholder_id", *about, (F.row_number().over(copies) == 1).alias("first_copy"))
    read = ["policy_id", "policyholder_id", "coverage_type", "annual_premium", "deductible", "total_incurred", "earned_premium"]
    known = materialise(experience.select(*read).join(holder, "policyholder_id"), "segments")
    banded = tiles_by_cuts(known, "annual_premium", "policy_id", 4, "quarter", among="first_copy").filter("policy_id IS NOT NULL")
    states = _risk_group(known, "state_code", "state_risk_group")
    occupations = _risk_group(known, "occupation", "occupation_risk_group")
    high = F.lit("high")
    return (
        banded.join(states, "state_code", "left")
        .join(occupations, "occupation", "left")
        .select(
            "policy_id",
            "policyholder_id",
            age_band(F.col("current_age")).alias("age_band"),
            "state_code",
            F.coalesce("state_risk_group", high).alias("state_risk_group"),
            "occupation",
            F.coalesce("occupation_risk_group", high).alias("occupation_risk_group"),
            "coverage_type",
            F.when(F.col("deductible") <= 5000, "low")
            .when(F.col("deductible") <= 15000, "medium")
            .otherwise("high")
            .alias("deductible_band"),
            F.concat(F.lit("Q"), F.col("quarter").cast("string")).alias("premium_band"),
            "gender",
        )
    )


def feat_historical_benchmarks(frequency: DataFrame) -> DataFrame:
    """Yearly benchmarks per coverage with the change against the year before."""
    by_year = Window.partitionBy("coverage_type").orderBy("year")
    names = {
        "claim_frequency": "benchmark_frequency",
        "avg_severity": "benchmark_severity",
        "pure_premium": "benchmark_pure_premium",
        "loss_ratio": "benchmark_loss_ratio",
    }

    def trend(name: str) -> Column:
        before = F.lag(name).over(by_year)
        return F.when(before > 0, (F.col(name) - before) / before)

    return frequency.select("year", "coverage_type", *[F.col(c).alias(n) for c, n in names.items()]).withColumns(
        {"frequency_trend": trend("benchmark_frequency"), "severity_trend": trend("benchmark_severity")}
    )


def latest_benchmark(benchmarks: DataFrame) -> DataFrame:
    """The last year with a frequency, per coverage."""
    wanted = ["benchmark_frequency", "benchmark_severity", "frequency_trend", "severity_trend"]
    last = F.max_by(F.struct(*wanted), "year").alias("last")
    return (
        benchmarks.filter(F.col("benchmark_frequency").isNotNull())
        .groupBy("coverage_type")
        .agg(last)
        .select("coverage_type", "last.*")
    )


def model_training_set(
    experience: DataFrame, segments: DataFrame, policies: DataFrame, benchmarks: DataFrame, cfg: Config
) -> DataFrame:
    """One row per policy with targets, features and the train or test split."""
    latest = latest_benchmark(benchmarks)
    bands = ["age_band", "state_risk_group", "occupation_risk_group", "deductible_band", "premium_band", "gender"]

    def log_at_least_one(name: str) -> Column:
        return F.log(F.greatest(F.col(name).cast("double"), F.lit(1.0)))

    kept = experience.filter(
        (F.col("exposure_years") > cfg.min_training_exposure) & (F.col("policy_status") != "cancelled")
    )
    pure_premium = F.coalesce(ratio(F.col("total_incurred"), F.col("exposure_years")), F.lit(0.0))
    return (
        kept.join(segments.select("policy_id", *bands), "policy_id")
        .join(policies.select("policy_id", "policy_year"), "policy_id")
        .join(latest, "coverage_type", "left")
        .select(
            "policy_id",
            F.col("claim_frequency").alias("target_claim_frequency"),
            pure_premium.alias("target_pure_premium"),
            (F.col("claim_count") > 0).cast("int").alias("target_has_claim"),
            "exposure_years",
            log_at_least_one("annual_premium").alias("log_premium"),
            log_at_least_one("deductible").alias("log_deductible"),
            log_at_least_one("coverage_limit").alias("log_coverage_limit"),
            "age_band",
            "state_risk_group",
            "occupation_risk_group",
            "coverage_type",
            "deductible_band",
            "premium_band",
            "gender",
            *[
                F.coalesce(c, F.lit(0.0)).alias(c)
                for c in ("benchmark_frequency", "benchmark_severity", "frequency_trend", "severity_trend")
            ],
            "claim_count",
            "avg_severity",
            "has_large_loss",
            F.when(F.col("policy_year") <= cfg.train_through_year, "train").otherwise("test").alias("split"),
        )
    )


def training_split_counts(training: DataFrame) -> DataFrame:
    is_train = (F.col("split") == "train").cast("int")
    return training.agg(
        F.count("*").alias("total"), F.sum(is_train).alias("train"), F.sum(1 - is_train).alias("test")
    )


def categories(df: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """Sorted distinct values of each column over the whole table: what becomes the columns of a wide table."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns]))
    distinct = df.select(pairs.alias("p")).select("p.*").filter("value IS NOT NULL").distinct()
    found: dict[str, list[str]] = {c: [] for c in columns}
    for name, value in distinct.toLocalIterator():
        found[name].append(value)
    return {name: sorted(values) for name, values in found.items()}


def feat_indicators(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """key, feature: the indicators that are 1, one row for each category a row has; null has none.

    The long form of feat_one_hot without its zeros: no list of the values is needed, however many there are.
    """
    named = F.array(*[F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c}_"), F.col(c).cast("string"))) for c in columns])
    return df.select(key, F.explode(F.array_compact(named)).alias("feature"))


def feat_one_hot(
    df: DataFrame, columns: list[str], levels: dict[str, list[str]] | None = None
) -> tuple[DataFrame, list[str]]:
    """A 0/1 column per value of each categorical column, null counting as none of them."""
    levels = levels or categories(df, columns)
    added = {
        f"{c}_{v}": F.coalesce((F.col(c) == v).cast("int"), F.lit(0)) for c in columns for v in levels[c]
    }
    return df.withColumns(added), list(added)


def feat_drop_null_target(df: DataFrame, target: str = "target_pure_premium") -> DataFrame:
    return df.filter(F.col(target).isNotNull() & ~F.isnan(target))


def feat_median_impute(df: DataFrame, columns: list[str], by: str = "split") -> DataFrame:
    """Replace null and NaN by the exact median of the column within each value of by (null: a group of its own).

    A column without any value in a group stays as it is. Medians are searched for columns with gaps only.
    """
    gaps = df.agg(*[F.count_if(F.col(c).isNull() | F.isnan(c)).alias(f"_{i}") for i, c in enumerate(columns)]).first() if columns else ()
    columns = [c for c, n in zip(columns, gaps) if n]
    if not columns:
        return df
    wide = exact_medians(df, columns, by).groupBy("group").agg(
        *[F.max(F.when(F.col("name") == c, F.col("median"))).alias(f"_median_{i}") for i, c in enumerate(columns)]
    )
    group = F.coalesce(F.col(by).cast("string"), F.lit(""))
    filled = df.withColumn("_group", group).join(wide.withColumnRenamed("group", "_group"), "_group", "left")
    return filled.select(
        *[
            F.when(F.col(c).isNull() | F.isnan(c), F.col(f"_median_{columns.index(c)}")).otherwise(F.col(c)).alias(c)
            if c in columns
            else F.col(c)
            for c in df.columns
        ]
    )

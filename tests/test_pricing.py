"""Features, models and metrics against closed forms."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from lossline.config import Config
from lossline.operators import evaluate, features, glm, motor


def pairs(spark, actual, predicted):
    return spark.createDataFrame([(i, float(a), float(p)) for i, (a, p) in enumerate(zip(actual, predicted))], "id bigint, y double, p double")


def gini(df):
    return evaluate.eval_gini(df, "y", "p", "id").first()["gini"]


def test_gini(spark):
    rng = random.Random(1)
    y = [rng.gammavariate(1, 100) for _ in range(500)]
    good, bad = gini(pairs(spark, y, y)), gini(pairs(spark, y, [-v for v in y]))
    noise = gini(pairs(spark, y, [rng.random() for _ in y]))
    assert good > 0.3 and bad < -0.3 and abs(noise) < 0.15
    order = sorted(range(500), key=lambda i: y[i])
    so_far, area = 0.0, 0.0
    for i in order:
        so_far += y[i]
        area += so_far / sum(y) / 500
    assert good == pytest.approx(1 - 2 * area)
    assert gini(pairs(spark, [], [])) == 0 and gini(pairs(spark, [0, 0], [1, 2])) == 0


def test_lift(spark):
    rows = evaluate.eval_lift_table(pairs(spark, range(1, 101), range(1, 101)), "y", "p", "id").orderBy("decile").collect()
    assert [r["count"] for r in rows] == [10] * 10 and rows[0]["avg_actual"] == 5.5 and rows[9]["lift"] == round(95.5 / 50.5, 4)
    rest = evaluate.eval_lift_table(pairs(spark, range(23), range(23)), "y", "p", "id", 5).orderBy("decile").collect()
    assert [r["count"] for r in rest] == [4, 4, 4, 4, 7]
    few = evaluate.eval_lift_table(pairs(spark, [1, 2], [1, 2]), "y", "p", "id").collect()
    assert [(r["decile"], r["count"]) for r in few] == [(10, 2)]


def test_residuals(spark):
    row = evaluate.eval_residuals(pairs(spark, [10, 20, 0, 40], [12, 17, 1, 40]), "y", "p").first()
    assert (row["mae"], row["rmse"], row["mape"]) == (1.5, round(math.sqrt(14 / 4), 2), round((0.2 + 0.15 + 0) / 3, 4))
    assert (row["mean_residual"], row["median_absolute_error"]) == (0.0, 1.5) and row["rmse"] >= row["mae"]
    assert row["std_residual"] == round(math.sqrt(14 / 4), 2)


@pytest.fixture(scope="module")
def groups(spark):
    """Two groups; a log-link model of one factor fits each group's mean."""
    rng = random.Random(11)
    rows = [(i, "ab"[i % 2], rng.gammavariate(2, 50 * (1 + i % 2)) if rng.random() < 0.8 else 0.0, rng.randint(0, 4), rng.uniform(0.3, 2)) for i in range(400)]
    df = spark.createDataFrame(rows, "policy_id bigint, g string, cost double, claims int, years double")
    return features.feat_one_hot(df, ["g"])


@pytest.mark.parametrize("kind, target", [("pure_premium", "cost"), ("frequency", "claims"), ("severity", "cost")])
def test_one_factor_models_fit_group_means(groups, kind, target):
    df, names = groups
    fitted = glm.fit_glm(df, kind, names, target)
    used = df.filter(F.col(target) > 0) if kind == "severity" else df
    want = {r["g"]: r["m"] for r in used.groupBy("g").agg(F.avg(target).alias("m")).collect()}
    for row in glm.glm_predict(fitted, df).select("g", "prediction").distinct().collect():
        assert row["prediction"] == pytest.approx(want[row["g"]], rel=1e-5)
    assert fitted.features == ("g_a",)  # the other level is the reference


def test_exposure_is_an_offset(groups):
    df, names = groups
    fitted = glm.fit_glm(df, "frequency", names, "claims", exposure="years")
    want = {r["g"]: r["m"] for r in df.groupBy("g").agg((F.sum("claims") / F.sum("years")).alias("m")).collect()}
    for row in glm.glm_predict(fitted, df).select("g", "prediction").distinct().collect():
        assert row["prediction"] == pytest.approx(want[row["g"]], rel=1e-5)
    table = glm.glm_coefficients(fitted).collect()
    assert {r["feature"] for r in table} == {"g_a", "const"} and all(math.isfinite(r["std_error"]) for r in table)
    sizes = [abs(r["coefficient"]) for r in table]
    assert sizes == sorted(sizes, reverse=True)
    stats = glm.glm_fit_stats(fitted).first()
    assert stats["family"] == "Poisson" and math.isfinite(stats["aic"]) and stats["deviance"] > 0


def test_dependent_and_constant_features_drop_out(spark):
    rows = [(float(i % 7), float(i % 5), 3.0) for i in range(70)]
    df = spark.createDataFrame(rows, "a double, b double, one double").withColumn("both", F.col("a") + 2 * F.col("b"))
    assert glm.independent_features(glm._with_vector(df, ["a", "b", "both", "one"])) == [0, 1]


@pytest.mark.parametrize("size, base", [(8_000, 31.7), (100_000, 3.1), (100_000, 313.3)])
def test_a_number_that_follows_from_a_category_drops_out(spark, size, base):
    """However little it varies beside its size: here sums of raw products were off by more than the tolerance."""
    category = F.substring(F.lit("abcdefgh"), (F.sqrt(F.col("id") * 7) % 8 + 1).cast("int"), F.lit(1))
    df = spark.range(size).select(category.alias("c"), (F.col("id") % 9).cast("double").alias("free"))
    vectors, names = glm.encode(df.withColumn("follows", F.lit(base) + 0.37 * F.log(F.ascii("c") - 95.0) / 100), ["c"], ["follows", "free"])
    assert [names[i] for i in glm.independent_features(vectors)] == [*[f"c_{c}" for c in "abcdefg"], "free"]


def test_design_fills_gaps_and_has_no_limit_of_levels(spark):
    rows = [("train", f"level {i % 1200:04}", None if i % 7 == 0 else float(i % 5), float(i)) for i in range(2400)]
    df = spark.createDataFrame(rows, "split string, age_band string, log_premium double, target_pure_premium double")
    rest = {c: F.lit("x") for c in features.CATEGORICAL_FEATURES if c != "age_band"}
    rest["gender"] = F.lit(None).cast("string")
    rest |= {c: F.lit(1.0) for c in features.NUMERIC_FEATURES if c != "log_premium"}
    design, names = glm.design_matrix(df.withColumns(rest))
    assert len(names) == 1200 + 3 + len(features.NUMERIC_FEATURES) and not any(n.startswith("gender") for n in names)
    vector = design.orderBy("target_pure_premium").first()[glm.ALL]
    assert vector.size == len(names) and vector[0] == 1.0 and vector[1200 + 3] == 2.0


def test_severity_needs_a_positive_amount(groups):
    df, names = groups
    with pytest.raises(ValueError):
        glm.fit_glm(df.filter("cost = 0"), "severity", names, "cost")


def test_scoring_bands(spark):
    training = spark.createDataFrame([(i, "auto", "26-35", "low", 1.0) for i in range(5)], "policy_id bigint, coverage_type string, age_band string, state_risk_group string, exposure_years double")
    experience = spark.createDataFrame([(0, 100.0), (1, 100.0), (2, 100.0), (3, 0.0), (4, 100.0)], "policy_id bigint, annual_premium double")
    predicted = spark.createDataFrame([(0, 120.0), (1, 80.0), (2, 100.0), (3, 50.0)], "policy_id bigint, predicted_pure_premium double")
    scored = evaluate.model_scoring(training, experience, predicted, Config())
    assert {r["policy_id"]: r["pricing_assessment"] for r in scored.collect()} == {0: "underpriced", 1: "overpriced", 2: "adequate", 3: None}
    summary = evaluate.scoring_summary(scored).first()
    assert (summary["total_scored"], summary["pct_underpriced"], summary["avg_predicted_pp"]) == (3, 33.3, 100.0)


def test_age_bands(spark):
    ages = [(17, "65+"), (18, "18-25"), (25, "18-25"), (26, "26-35"), (45, "36-45"), (55, "46-55"), (65, "56-65"), (66, "65+"), (None, "65+")]
    df = spark.createDataFrame(ages, "age int, band string")
    assert df.filter(features.age_band(F.col("age")) != F.col("band")).count() == 0


def test_one_hot_uses_all_values_and_null_is_none(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "c string")
    rows, names = features.feat_one_hot(df, ["c"])
    assert names == ["c_a", "c_b"] and sorted((r["c_a"], r["c_b"]) for r in rows.collect()) == [(0, 0), (0, 1), (1, 0)]


def test_medians_are_imputed_per_split(spark):
    rows = [("train", 1.0), ("train", 3.0), ("train", None), ("test", 10.0), ("test", float("nan"))]
    got = features.feat_median_impute(spark.createDataFrame(rows, "split string, x double"), ["x"]).collect()
    assert sorted((r["split"], r["x"]) for r in got) == [("test", 10.0), ("test", 10.0), ("train", 1.0), ("train", 2.0), ("train", 3.0)]


def test_medians_are_searched_for_columns_with_gaps_only(spark, monkeypatch):
    searched = []
    plain = features.exact_medians
    monkeypatch.setattr(features, "exact_medians", lambda df, columns, by: searched.append(columns) or plain(df, columns, by))
    df = spark.createDataFrame([("train", 1.0, 5.0), ("train", None, 6.0)], "split string, x double, y double")
    assert [(r["x"], r["y"]) for r in features.feat_median_impute(df, ["y", "x"]).orderBy("y").collect()] == [(1.0, 5.0), (1.0, 6.0)]
    assert features.feat_median_impute(df, ["y"]).count() == 2 and searched == [["x"]]


def test_equal_severities_get_their_own_claims(spark, monkeypatch):
    monkeypatch.setattr(motor, "CHUNK", 3)
    frequency = spark.createDataFrame([(1, 8, 0.5), (2, 1, 1.0), (3, 0, 1.0)], "IDpol bigint, ClaimNb int, Exposure double")
    severity = spark.createDataFrame([(1, 10.0)] * 7 + [(1, 99.0), (2, 5.0), (3, 1.0)], "IDpol bigint, ClaimAmount double")
    rows = motor.fremtpl_claims(frequency, severity, ranges=3).orderBy("claim_id").collect()
    assert [r["claim_id"] for r in rows] == list(range(1, 10))
    assert [float(r["total_paid"]) for r in rows] == [99.0] + [10.0] * 7 + [5.0]
    assert rows[0]["claim_number"] == "CLM-000001"

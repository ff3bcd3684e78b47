"""Fits over many levels against the equations that they must satisfy."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lossline.operators import sparse_glm as sg


def test_ten_thousand_levels(spark):
    """One factor: the fitted mean of a level is the mean of its rows."""
    rows = spark.range(60_000).select(
        (F.col("id") % 10_000).alias("level"), (F.col("id") % 7 + 1).cast("double").alias("exposure"), ((F.col("id") * 7919) % 5 + 1).alias("claims")
    )
    fit = sg.fit_levels(rows, ["level"], F.col("claims"), offset=F.log("exposure"), tolerance=1e-10)
    assert len(fit.coefficients) == 10_001 and fit.gradient < 1e-10
    found = sg.predict_levels(fit, rows, ["level"], offset=F.log("exposure"))
    apart = found.groupBy("level").agg(F.abs(F.sum("claims") - F.sum("prediction")).alias("d")).agg(F.max("d")).first()[0]
    assert apart < 1e-4


@pytest.mark.parametrize("power", [sg.POISSON, sg.GAMMA, 1.5])
def test_equations_of_two_factors(spark, power):
    draw = np.random.default_rng(int(power * 10))
    rows = [(f"a{draw.integers(30)}" if draw.random() < 0.95 else None, int(draw.integers(4)), float(draw.gamma(2.0, 3.0)) + 0.01, float(draw.uniform(0.5, 2))) for _ in range(800)]
    df = spark.createDataFrame(rows, "a string, b int, y double, w double").repartition(3)
    fit = sg.fit_levels(df, ["a", "b"], F.col("y"), power, weight=F.col("w"), tolerance=1e-10)
    found = sg.predict_levels(fit, df, ["a", "b"])
    score = F.sum(F.col("w") * (F.col("y") - F.col("prediction")) / F.pow("prediction", F.lit(power - 1)))
    for c in ("a", "b"):
        worst = found.groupBy(c).agg(F.abs(score).alias("s")).agg(F.max("s")).first()[0]
        assert worst < 1e-5
    assert fit.levels.count() == found.select("a").distinct().count() + 4
    known = sg.coefficients(fit).filter("level = 'a3'").first()
    assert known.factor == "a"


def test_new_levels_and_no_rows(spark):
    df = spark.createDataFrame([("x", 2.0), ("x", 4.0), ("y", 6.0)], "a string, y double")
    fit = sg.fit_levels(df, ["a"], F.col("y"))
    new = spark.createDataFrame([("x", 1), ("new", 2)], "a string, n int")
    found = {r.a: r.prediction for r in sg.predict_levels(fit, new, ["a"]).collect()}
    assert found["x"] == pytest.approx(3.0, 1e-6) and found["new"] == pytest.approx(float(np.exp(fit.coefficients[-1])))
    with pytest.raises(ValueError, match="positive target"):
        sg.fit_levels(df.limit(0), ["a"], F.col("y"))

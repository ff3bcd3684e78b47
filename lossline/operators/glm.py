"""Pricing models: Tweedie, Poisson and Gamma regressions with a log link, fitted by Spark ML.

Rows stay distributed: the driver sees category names, the correlation matrix of the
features and the fitted coefficients, whose sizes depend on the number of features only.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.ml.regression import GeneralizedLinearRegression, GeneralizedLinearRegressionModel
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import DataFrame, functions as F

from lossline.operators.features import (
    CATEGORICAL_FEATURES,
    NUMERIC_FEATURES,
    feat_drop_null_target,
    feat_median_impute,
)

#: Vectors of all features, and of those a model uses.
ALL, VECTOR = "all_features", "features"
MIN_EXPOSURE = 1e-10

FAMILIES = {
    "pure_premium": {"family": "tweedie", "variancePower": 1.5, "linkPower": 0.0},
    "frequency": {"family": "poisson", "link": "log"},
    "severity": {"family": "gamma", "link": "log"},
}
FAMILY_NAMES = {"pure_premium": "Tweedie(p=1.5)", "frequency": "Poisson", "severity": "Gamma"}


@dataclass(frozen=True)
class Fitted:
    """A fitted model, all features it was offered, and the places of those it uses."""

    kind: str
    offered: tuple[str, ...]
    used: tuple[int, ...]
    target: str
    model: GeneralizedLinearRegressionModel

    @property
    def features(self) -> tuple[str, ...]:
        return tuple(self.offered[i] for i in self.used)


def design_matrix(training: DataFrame, target: str = "target_pure_premium") -> tuple[DataFrame, list[str]]:
    """Training rows with a known target and the sparse vector ALL, and the names of its entries.

    Gaps in numbers take the median of the split (0 where a split has no value). A category becomes one 0/1 entry per
    value, null none of them. Categories come first, so that of linearly dependent features the numeric ones go.
    """
    rows = feat_median_impute(feat_drop_null_target(training, target), NUMERIC_FEATURES).na.fill(0.0, NUMERIC_FEATURES)
    return encode(rows, CATEGORICAL_FEATURES, NUMERIC_FEATURES)


def encode(rows: DataFrame, categories: list[str], numbers: list[str]) -> tuple[DataFrame, list[str]]:
    """Rows with the sparse vector ALL of categories and numbers, and the names of its entries."""
    found = rows.agg(*[F.count(c).alias(c) for c in categories]).first() if categories else ()
    categories = [c for c in categories if found[c]]  # one without any value has no entry
    indices, entries = [f"_{c}_index" for c in categories], [f"_{c}_entries" for c in categories]
    if not categories:
        return VectorAssembler(inputCols=numbers, outputCol=ALL).transform(rows), list(numbers)
    indexer = StringIndexer(
        inputCols=categories, outputCols=indices, handleInvalid="keep", stringOrderType="alphabetAsc"
    ).fit(rows)
    # The last index is that of null, and the one that the encoder leaves out.
    indexed = indexer.transform(rows)
    encoded = OneHotEncoder(inputCols=indices, outputCols=entries, dropLast=True).fit(indexed).transform(indexed)
    vectors = VectorAssembler(inputCols=entries + numbers, outputCol=ALL).transform(encoded)
    names = [f"{c}_{v}" for c, values in zip(categories, indexer.labelsArray) for v in values]
    return vectors.drop(*indices, *entries), names + numbers


def independent_features(vectors: DataFrame, tolerance: float = 1e-9) -> list[int]:
    """Places in the vector ALL that add something to an intercept and the places before them.

    A reference level per category, constants and combinations of others drop out. The
    fitted means do not change, and the solver can give standard errors. Entries are centred and scaled before they are
    multiplied: products of raw ones lose, over millions of rows, the digits that tell a combination of others.
    """
    metrics = Summarizer.metrics("min", "max").summary(F.col(ALL))
    bounds = vectors.select(metrics.alias("m")).select("m.*").first()
    varying = np.flatnonzero(bounds["min"].toArray() != bounds["max"].toArray()).tolist()
    if len(varying) < 2:
        return varying
    sliced = VectorSlicer(inputCol=ALL, outputCol="_raw", indices=varying).transform(vectors.select(ALL))
    centred = StandardScaler(inputCol="_raw", outputCol=VECTOR, withMean=True, withStd=True).fit(sliced).transform(sliced)
    matrix = Correlation.corr(centred, VECTOR).first()[0].toArray()
    # Cholesky column by column: a column whose remaining variance is gone is dependent.
    kept: list[int] = []
    factors: list[np.ndarray] = []
    for j in range(len(varying)):
        row = np.zeros(len(kept) + 1)
        for i in range(len(kept)):
            row[i] = (matrix[j, kept[i]] - row[:i] @ factors[i][:i]) / factors[i][i]
        left = matrix[j, j] - row[:-1] @ row[:-1]
        if left > tolerance:
            row[-1] = np.sqrt(left)
            kept.append(j)
            factors.append(row)
    return [varying[j] for j in kept]


def _with_vector(rows: DataFrame, names: list[str]) -> DataFrame:
    return rows if ALL in rows.columns else VectorAssembler(inputCols=list(names), outputCol=ALL).transform(rows)


def fit_glm(
    rows: DataFrame, kind: str, features: list[str], target: str, exposure: str | None = None, max_iter: int = 100
) -> Fitted:
    """Fit one of FAMILIES by iteratively reweighted least squares, always with an intercept.

    features: names of columns, or of the entries of ALL where rows have it. Every iteration passes over the rows, so
    the columns it needs are kept on the executors' disks for the time of the fit.
    exposure enters as offset log(max(exposure, 1e-10)). Severity is fitted on positive
    amounts only, and it is an error if there are none. Recoveries can push a pure premium
    below zero, where the Tweedie family is not defined: such a target counts as zero.
    """
    if kind == "pure_premium":
        rows = rows.withColumn(target, F.greatest(F.col(target), F.lit(0.0)))
    if kind == "severity":
        rows = rows.filter(F.col(target) > 0)
    settings = dict(FAMILIES[kind], labelCol=target, featuresCol=VECTOR, maxIter=max_iter, tol=1e-8)
    if exposure:
        rows = rows.withColumn("_offset", F.log(F.greatest(F.col(exposure), F.lit(MIN_EXPOSURE))))
        settings["offsetCol"] = "_offset"
    needed = _with_vector(rows, features).select(ALL, target, *["_offset"] * bool(exposure)).persist(StorageLevel.DISK_ONLY)
    try:
        if kind == "severity" and needed.isEmpty():
            raise ValueError("no positive severity to fit")
        used = independent_features(needed)
        if not used:
            raise ValueError("no feature varies")
        vectors = VectorSlicer(inputCol=ALL, outputCol=VECTOR, indices=used).transform(needed)
        model = GeneralizedLinearRegression(**settings).fit(vectors)
        model.summary.deviance  # noqa: B018  (read while the rows are kept)
        return Fitted(kind, tuple(features), tuple(used), target, model)
    finally:
        needed.unpersist()


def glm_predict(fitted: Fitted, rows: DataFrame, name: str = "prediction", exposure: str | None = None) -> DataFrame:
    """Rows with the predicted mean, not below 0; the key stays on its own row."""
    if fitted.model.hasParam("offsetCol") and fitted.model.isDefined("offsetCol"):
        offset = F.log(F.greatest(F.col(exposure), F.lit(MIN_EXPOSURE))) if exposure else F.lit(0.0)
        rows = rows.withColumn("_offset", offset)
    slicer = VectorSlicer(inputCol=ALL, outputCol=VECTOR, indices=list(fitted.used))
    scored = fitted.model.setPredictionCol("_mean").transform(slicer.transform(_with_vector(rows, fitted.offered)))
    return scored.withColumn(name, F.greatest("_mean", F.lit(0.0))).drop("_mean", "_offset", VECTOR, ALL)


def glm_coefficients(fitted: Fitted) -> DataFrame:
    """Coefficient table, largest absolute value first."""
    from pyspark.sql import SparkSession

    summary = fitted.model.summary
    names = [*fitted.features, "const"]
    values = [*map(float, fitted.model.coefficients), float(fitted.model.intercept)]
    rows = list(zip(names, values, summary.coefficientStandardErrors, summary.tValues, summary.pValues))
    table = SparkSession.getActiveSession().createDataFrame(
        rows, "feature string, coefficient double, std_error double, z_value double, p_value double"
    )
    digits = {"coefficient": 6, "std_error": 6, "z_value": 4, "p_value": 6}
    return table.withColumns({c: F.round(c, n) for c, n in digits.items()}).orderBy(
        F.desc(F.abs("coefficient")), "feature"
    )


def glm_fit_stats(fitted: Fitted) -> DataFrame:
    """Family, deviance and AIC; the Tweedie family has no AIC in Spark and shows null."""
    from pyspark.sql import SparkSession

    summary = fitted.model.summary
    aic = None if fitted.kind == "pure_premium" else float(summary.aic)
    row = (FAMILY_NAMES[fitted.kind], len(fitted.features) + 1, float(summary.deviance), aic)
    return SparkSession.getActiveSession().createDataFrame(
        [row], "family string, parameters int, deviance double, aic double"
    )


def model_predictions(training: DataFrame, kind: str = "pure_premium") -> DataFrame:
    """Fit on the train split, predict every policy: (policy_id, predicted_pure_premium)."""
    encoded, features = design_matrix(training)
    fitted = fit_glm(encoded.filter(F.col("split") == "train"), kind, features, "target_pure_premium")
    return glm_predict(fitted, encoded, "predicted_pure_premium").select("policy_id", "predicted_pure_premium")

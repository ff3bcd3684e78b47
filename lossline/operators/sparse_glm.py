"""Regressions with a log link over categories of any number of levels.

A row knows its levels as a short array of places, never as a vector of all of them. Every step of the fit is one pass over the
rows: tasks add up the gradient of their rows, Spark adds these up by place, and the driver moves a few vectors of one number per
level. No matrix of levels by levels is made anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lossline.functions.ordering import ord_row_number
from lossline.session import materialise

#: Variance power of the mean: Poisson, Gamma, and between them Tweedie.
POISSON, GAMMA = 1.0, 2.0
#: Steps remembered for the curvature.
MEMORY = 12


@dataclass(frozen=True)
class SparseFit:
    """levels: factor, level, place; coefficients by place (the last one is the constant)."""

    power: float
    levels: DataFrame
    coefficients: np.ndarray
    steps: int
    gradient: float


def level_table(rows: DataFrame, factors: Sequence[str]) -> DataFrame:
    """factor, level, place for every value of every factor, numbered from 0; null is a level of its own."""
    named = F.array(*[F.struct(F.lit(c).alias("factor"), F.col(c).cast("string").alias("level")) for c in factors])
    levels = rows.select(F.inline(named)).distinct()
    return materialise(ord_row_number(levels, ["factor", "level"], "_n").select("factor", "level", (F.col("_n") - 1).alias("place")), "levels")


def with_places(rows: DataFrame, factors: Sequence[str], levels: DataFrame) -> DataFrame:
    """Rows with the places of their levels; a level that the table does not know has none."""
    for i, c in enumerate(factors):
        one = levels.filter(F.col("factor") == c).select(F.col("level").alias(f"_l{i}"), F.col("place").alias(f"_p{i}"))
        rows = rows.join(one, F.col(c).cast("string").eqNullSafe(F.col(f"_l{i}")), "left").drop(f"_l{i}")
    at = [f"_p{i}" for i in range(len(factors))]
    return rows.withColumn("places", F.array_compact(F.array(*at))).drop(*at)


def _eta(beta: np.ndarray, places: pa.Array, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    at = places.flatten().to_numpy(zero_copy_only=False)
    of = np.repeat(np.arange(len(offset)), places.value_lengths().to_numpy(zero_copy_only=False))
    return offset + beta[-1] + np.bincount(of, beta[at], len(offset)), at, of


def _slope(power: float, y: np.ndarray, eta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Loss, its slope and curvature in eta (unit deviance up to a constant, log link)."""
    if power == POISSON:
        mu = np.exp(eta)
        return mu - y * eta, mu - y, mu
    if power == GAMMA:
        part = y * np.exp(-eta)
        return part + eta, 1 - part, np.maximum(part, 1.0)
    up, down = np.exp((2 - power) * eta), y * np.exp((1 - power) * eta)
    return up / (2 - power) - down / (1 - power), up - down, (2 - power) * up + (power - 1) * down


def _pass(rows: DataFrame, power: float, beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss, gradient and diagonal of the curvature over all rows."""
    size = len(beta)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, gradient, curve = 0.0, np.zeros(size), np.zeros(size)
        for batch in batches:
            y, weight, offset = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
            eta, at, of = _eta(beta, batch.column(0), offset)
            value, slope, bend = _slope(power, y, eta)
            loss += float(weight @ value)
            slope, bend = weight * slope, weight * bend
            gradient[:-1] += np.bincount(at, slope[of], size - 1)
            curve[:-1] += np.bincount(at, bend[of], size - 1)
            gradient[-1] += slope.sum()
            curve[-1] += bend.sum()
        place = np.flatnonzero(curve)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[-1, place]), pa.array(np.r_[loss, gradient[place]]), pa.array(np.r_[0.0, curve[place]])], names=["place", "g", "h"]
        )

    told = rows.mapInArrow(run, "place long, g double, h double").groupBy("place").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toPandas()
    place, g, h = told["place"].to_numpy(), told["g"].to_numpy(), told["h"].to_numpy()
    gradient, curve = np.zeros(size), np.zeros(size)
    known = place >= 0
    gradient[place[known]], curve[place[known]] = g[known], h[known]
    return float(g[~known].sum()), gradient, curve


def fit_levels(
    rows: DataFrame, factors: Sequence[str], y: Column, power: float = POISSON, weight: Column | None = None, offset: Column | None = None,
    steps: int = 200, tolerance: float = 1e-9,
) -> SparseFit:
    """Fit a constant and one coefficient per level by limited-memory quasi-Newton steps, scaled by the curvature.

    The fit ends when no entry of the gradient exceeds tolerance times the weight of all rows, or after `steps` passes.
    Levels may be linearly dependent (every factor adds up to the constant): the fitted means are unique all the same.
    Rows whose y, weight or offset is null do not count; without a row it is an error.
    """
    levels = level_table(rows, factors)
    one = F.lit(1.0)
    data = with_places(rows, factors, levels).select(
        "places", y.cast("double").alias("y"), (one if weight is None else weight.cast("double")).alias("weight"),
        (F.lit(0.0) if offset is None else offset.cast("double")).alias("offset"),
    )
    data = materialise(data.dropna(subset=["y", "weight", "offset"]), "glm-rows")
    whole = data.agg(F.sum("weight").alias("w"), F.sum(F.col("weight") * F.col("y")).alias("wy"), F.sum(F.col("weight") * F.exp("offset")).alias("we")).first()
    if not whole.w or not whole.wy > 0:
        raise ValueError("no row with a positive target to fit")
    beta = np.zeros(levels.count() + 1)
    beta[-1] = np.log(whole.wy / whole.we)
    loss, gradient, curve = _pass(data, power, beta)
    taken, pairs, count = 0, [], 1
    while np.abs(gradient).max() > tolerance * whole.w and count < steps:
        scale = 1 / np.maximum(curve, 1e-12 * curve.max())
        move = -_direction(gradient, pairs, scale)
        length, slope = 1.0, float(gradient @ move)
        if slope >= 0:  # memory that no longer fits
            pairs, move = [], -scale * gradient
            slope = float(gradient @ move)
        while True:
            trial = beta + length * move
            new_loss, new_gradient, new_curve = _pass(data, power, trial)
            count += 1
            if new_loss <= loss + 1e-4 * length * slope + 1e-12 * abs(loss) or count >= steps:
                break
            length /= 4
        step, change = trial - beta, new_gradient - gradient
        if step @ change > 1e-14 * np.linalg.norm(step) * np.linalg.norm(change):
            pairs = [*pairs, (step, change)][-MEMORY:]
        beta, loss, gradient, curve, taken = trial, new_loss, new_gradient, new_curve, taken + 1
    return SparseFit(power, levels, beta, taken, float(np.abs(gradient).max() / whole.w))


def _direction(gradient: np.ndarray, pairs: list, scale: np.ndarray) -> np.ndarray:
    """The gradient times the inverse curvature that the last steps have seen, started from its diagonal."""
    q, back = gradient.copy(), []
    for step, change in reversed(pairs):
        a = (step @ q) / (step @ change)
        back.append(a)
        q -= a * change
    q *= scale
    for (step, change), a in zip(pairs, reversed(back)):
        q += step * (a - (change @ q) / (step @ change))
    return q


def predict_levels(fit: SparseFit, rows: DataFrame, factors: Sequence[str], name: str = "prediction", offset: Column | None = None) -> DataFrame:
    """Rows with the fitted mean; levels that the fit has not seen add nothing. Other columns pass through."""
    placed = with_places(rows, factors, fit.levels)
    beta = fit.coefficients
    placed = placed.withColumn("_offset", F.lit(0.0) if offset is None else offset.cast("double"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            places, shift = columns[-2:]
            eta, _, _ = _eta(beta, places, shift.to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*columns[:-2], pa.array(np.exp(eta), from_pandas=True)], names=[*batch.schema.names[:-2], name])

    return placed.select(*rows.columns, "places", "_offset").mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + f", {name} double")


def coefficients(fit: SparseFit) -> DataFrame:
    """factor, level, coefficient; the constant has neither."""
    spark = fit.levels.sparkSession
    values = spark.createDataFrame(list(enumerate(fit.coefficients.tolist())), "place long, coefficient double")
    return values.join(fit.levels, "place", "left").select("factor", "level", "coefficient")

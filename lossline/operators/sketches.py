"""Distributions as stored sketches: one row per day and column, merged to any period without reading the data again.

A row holds exact counts and sums, a KLL sketch for ranks and an HLL sketch for distinct values. Sketches of parts merge to a
sketch of the whole with the same error, so a period is read from its days, and a day that arrives late replaces its row alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Size of the KLL sketch. Its rank error is about 2.3 / K**0.9 with 99 % certainty; RANK_ERROR states twice that.
K, RANK_ERROR = 800, 0.01
#: 2**LG registers of the HLL sketch; five of its standard errors (1.04 / sqrt(2**LG)).
LG, DISTINCT_ERROR = 14, 0.041


def daily_sketches(df: DataFrame, columns: Sequence[str], day: str) -> DataFrame:
    """day, column_name, row_count, filled, total (exact), ranks (KLL), values (HLL) per day and numeric column.

    Partial sketches are formed before the shuffle: a day that holds most rows sends one row per task and column. Null
    values count as rows only; rows without a day are a day of their own (null).
    """
    named = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("decimal(28,6)").alias("v")) for c in columns])
    rows = df.select(F.to_date(day).alias("day"), F.inline(named))
    return rows.groupBy("day", "column_name").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count("v").alias("filled"),
        F.sum("v").alias("total"),
        F.kll_sketch_agg_double(F.col("v").cast("double"), F.lit(K)).alias("ranks"),
        F.hll_sketch_agg(F.col("v").cast("string"), F.lit(LG)).alias("values"),
    )


def merged(sketches: DataFrame, period: Column | None = None, spread: int = 32) -> DataFrame:
    """Sketches of periods (an expression of day; by default one of all) and columns, merged in two levels.

    First the days of a stretch by their hash, so no task sees all days of a long history, then the stretches.
    """
    period = F.lit("all") if period is None else period
    rows = sketches.select(period.alias("period"), F.pmod(F.xxhash64("day"), F.lit(spread)).alias("stretch"), *[c for c in sketches.columns if c != "day"])
    for keys in (["period", "column_name", "stretch"], ["period", "column_name"]):
        rows = rows.groupBy(*keys).agg(
            F.sum("row_count").alias("row_count"),
            F.sum("filled").alias("filled"),
            F.sum("total").cast("decimal(38,6)").alias("total"),
            F.kll_merge_agg_double("ranks", F.lit(K)).alias("ranks"),
            F.hll_union_agg("values").alias("values"),
        )
    return rows


def figures(sketches: DataFrame) -> DataFrame:
    """What a merged row says: filled, null rate, mean, quartiles (rank error below RANK_ERROR), distinct values."""
    some = F.col("filled") > 0
    quartile = lambda p: F.when(some, F.kll_sketch_get_quantile_double("ranks", F.lit(p)))
    return sketches.select(
        "period",
        "column_name",
        "filled",
        F.round((F.col("row_count") - F.col("filled")) / F.col("row_count"), 6).alias("null_rate"),
        F.when(some, F.round(F.col("total").cast("double") / F.col("filled"), 4)).alias("mean"),
        quartile(0.25).alias("q25"),
        quartile(0.5).alias("median"),
        quartile(0.75).alias("q75"),
        F.hll_sketch_estimate("values").alias("distinct_values"),
    )


def against_baseline(current: DataFrame, baseline: DataFrame, shift: float = 0.1) -> DataFrame:
    """Per period and column how far the quartiles of the baseline (a merged row per column) have moved in rank.

    moved: the largest distance of 0.25, 0.5, 0.75 from the rank that the baseline's quartiles have in the period;
    drifted: more than `shift` and both rank errors.
    """
    marks = [0.25, 0.5, 0.75]
    quartiles = [F.kll_sketch_get_quantile_double("ranks", F.lit(m)).alias(f"q{i}") for i, m in enumerate(marks)]
    # The rank of a value is asked for with a constant; there are three of them per column.
    known = baseline.filter("filled > 0").select("column_name", *quartiles).collect()
    found = current.filter(F.col("filled") > 0).filter(F.col("column_name").isin([r.column_name for r in known]))
    moved = F.lit(None).cast("double")
    for r in known:
        apart = F.greatest(*[F.abs(F.kll_sketch_get_rank_double("ranks", F.lit(r[f"q{i}"])) - F.lit(m)) for i, m in enumerate(marks)])
        moved = F.when(F.col("column_name") == r.column_name, apart).otherwise(moved)
    return found.select("period", "column_name", "filled", F.round(moved, 6).alias("moved"), (moved > shift + 2 * RANK_ERROR).alias("drifted"))

"""Stored sketches against exact figures."""

from __future__ import annotations

import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from lossline.operators import sketches as sk


def table(spark, shift=0.0, days=40, n=6000):
    draw = random.Random(int(shift) + 1)
    rows = [(date(2024, 1, 1) + timedelta(days=draw.randrange(days)), draw.gauss(100 + shift, 30), float(draw.randrange(3))) for _ in range(n)]
    rows += [(None, 5.0, None), (date(2024, 1, 1), None, None)]
    return spark.createDataFrame(rows, "day date, a double, b double"), rows


def rank_error(values, found, share):
    below, upto = sum(v < found for v in values) / len(values), sum(v <= found for v in values) / len(values)
    return max(0.0, below - share, share - upto)


def test_merged_days_equal_the_whole(spark, tmp_path):
    df, rows = table(spark)
    sk.daily_sketches(df, ["a", "b"], "day").write.partitionBy("day").parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    days = stored.select("day").distinct().count()
    assert stored.count() == 2 * days == 2 * 41
    whole = {r.column_name: r for r in sk.figures(sk.merged(stored, spread=5)).collect()}
    direct = df.agg(*[F.hll_sketch_estimate(F.hll_sketch_agg(F.col(c).cast("decimal(28,6)").cast("string"), F.lit(sk.LG))).alias(c) for c in ("a", "b")]).first()
    for i, c in enumerate(("a", "b"), 1):
        values = [r[i] for r in rows if r[i] is not None]
        r = whole[c]
        assert r.filled == len(values) and abs(r.mean - sum(values) / len(values)) < 1e-3
        assert abs(r.distinct_values - direct[c]) <= max(1, sk.DISTINCT_ERROR * direct[c])
        assert abs(r.distinct_values - len(set(values))) <= max(1, sk.DISTINCT_ERROR * len(set(values)))
        for share, name in ((0.25, "q25"), (0.5, "median"), (0.75, "q75")):
            assert rank_error(values, r[name], share) <= sk.RANK_ERROR


def test_periods_and_drift(spark):
    old, _ = table(spark)
    new, _ = table(spark, shift=60.0)
    baseline = sk.merged(sk.daily_sketches(old, ["a", "b"], "day"))
    current = sk.daily_sketches(old, ["a", "b"], "day").unionByName(
        sk.daily_sketches(new.withColumn("day", F.date_add("day", 366)), ["a", "b"], "day")
    )
    found = {(r.period, r.column_name): r.drifted for r in sk.against_baseline(sk.merged(current, F.year("day")), baseline).collect()}
    assert found[2024, "a"] is False and found[2025, "a"] is True
    empty = sk.daily_sketches(old.limit(0), ["a"], "day")
    assert sk.figures(sk.merged(empty)).count() == 0
    none = sk.figures(sk.merged(sk.daily_sketches(old.filter("a IS NULL"), ["a"], "day"))).first()
    assert none.filled == 0 and none.median is None and none.mean is None

from __future__ import annotations

import random
import statistics

import pytest

from lossline.functions.quantiles import exact_medians


def medians(df, columns, **more):
    return {r["name"]: r["median"] for r in exact_medians(df, columns, **more).collect()}


@pytest.mark.parametrize("size", [1, 2, 9, 1000, 1001])
def test_median(spark, size):
    rng = random.Random(size)
    spread = [rng.gauss(0, 1e4) for _ in range(size)]
    tied = [float(rng.choice([1, 1, 1, 2, 9])) for _ in range(size)]
    df = spark.createDataFrame(list(zip(spread, tied)), "a double, b double").repartition(3)
    assert medians(df, ["a", "b"], ranges=5) == pytest.approx({"a": statistics.median(spread), "b": statistics.median(tied)})


def test_middle_between_two_heavy_ties(spark):
    values = [0.0] * 4995 + [0.2] * 5 + [1.0] * 5000
    df = spark.createDataFrame([(v,) for v in values], "a double")
    assert medians(df, ["a"], ranges=7) == {"a": 0.6}


def test_null_and_nan_do_not_count(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (None, None), (4.0, None)], "a double, b double")
    assert medians(df, ["a", "b"]) == {"a": 2.5}


def test_groups(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", 5.0), ("y", 2.0), (None, 7.0)], "g string, a double")
    found = {r["group"]: r["median"] for r in exact_medians(df, ["a"], "g").collect()}
    assert found == {"x": 3.0, "y": 2.0, "": 7.0}


def test_stretches_are_cut_again(spark, monkeypatch):
    """Few rows to a stretch, coarse sketches, heavy ties."""
    from pyspark.sql import functions as F

    from lossline.functions import quantiles

    monkeypatch.setattr(quantiles, "STRETCH", 3)
    monkeypatch.setattr(quantiles, "ACCURACY", 10)
    rng = random.Random(4)
    spread = [rng.randint(0, 400) if rng.random() < 0.5 else 7 for _ in range(2000)]
    rows = spark.createDataFrame([("g", v) for v in spread] + [("h", v) for v in range(50)], "g string, v long")
    places = [0, 5, 700, 1999]
    found = quantiles.values_at(rows, ["g"], "v", [F.lit(p) for p in places], [0.1]).collect()
    got = {(r.g, r.at): (r.value, r.below) for r in found}
    order = sorted(spread)
    want = {("g", p): (order[p], sum(v < order[p] for v in spread)) for p in places}
    assert got == want | {("h", 0): (0, 0), ("h", 5): (5, 5)}


def test_few_different_values_need_no_cuts(spark, monkeypatch):
    from pyspark.sql import functions as F

    from lossline.functions import quantiles

    written = []
    plain = quantiles.materialise
    monkeypatch.setattr(quantiles, "STRETCH", 10)
    monkeypatch.setattr(quantiles, "materialise", lambda df, name: written.append(name) or plain(df, name))
    rows = spark.range(3000).select(F.lit("g").alias("g"), (F.col("id") % 4).alias("v"))
    found = quantiles.values_at(rows, ["g"], "v", [F.expr("n div 2")], [0.5]).first()
    assert (found.value, found.below) == (2, 1500) and written == ["groups"]


def test_tiles_equal_ntile(spark, tiles=4):
    from lossline.functions.ordering import ord_ntile
    from lossline.functions.quantiles import tiles_by_cuts

    rng = random.Random(tiles)
    for size in (0, 5, 300):
        rows = [(i, rng.choice([None, 1.5, 2.5, 2.5, 9.0, rng.random()])) for i in range(size)]
        df = spark.createDataFrame(rows, "id long, v double")
        got = sorted(tuple(r) for r in tiles_by_cuts(df, "v", "id", tiles, "tile").select("id", "tile").collect())
        assert got == sorted(tuple(r) for r in ord_ntile(df, ["v", "id"], tiles, "tile").select("id", "tile").collect())


def test_no_row_is_sorted(spark, tmp_path):
    from lossline.functions import quantiles

    spark.range(1000).selectExpr("id % 3 AS g", "double(id) AS v").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = quantiles.exact_medians(df, ["v"], "g")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan

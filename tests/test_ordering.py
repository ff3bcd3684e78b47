"""Whole-table order statistics against the plain window and against Python."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window, functions as F

from lossline.functions import ordering as o


@pytest.fixture(scope="module")
def tied(spark):
    """2,000 rows; one value of the key holds a third of them, some keys are null."""
    rng = random.Random(7)
    rows = [(i, None if i % 50 == 0 else 5.0 if rng.random() < 0.35 else float(rng.randint(0, 40)), rng.randint(-9, 9)) for i in range(2000)]
    return spark.createDataFrame(rows, "id bigint, k double, v int").repartition(5)


def plain(df, column):
    window = Window.partitionBy(F.lit(0)).orderBy(F.col("k").asc_nulls_first(), "id")
    return {r["id"]: r["x"] for r in df.withColumn("x", column(window)).collect()}


def ours(df, name):
    return {r["id"]: r[name] for r in df.collect()}


@pytest.mark.parametrize("ranges", [1, 2, 7, 40])
def test_row_number(tied, ranges):
    assert ours(o.ord_row_number(tied, ["k", "id"], ranges=ranges), "row_number") == plain(tied, lambda w: F.row_number().over(w))


@pytest.mark.parametrize("tiles", [1, 3, 7, 2000, 2500])
def test_ntile(tied, tiles):
    assert ours(o.ord_ntile(tied, ["k", "id"], tiles, ranges=9), "tile") == plain(tied, lambda w: F.ntile(tiles).over(w))


def test_running_sum_and_maximum(tied):
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    assert ours(o.ord_running_sum(tied, ["k", "id"], "v", "s", ranges=9), "s") == plain(
        tied, lambda w: F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0))
    )
    assert ours(o.ord_running(tied, ["k", "id"], "v", "m", "max", ranges=9, include_current=False), "m") == plain(
        tied, lambda w: F.max("v").over(before(w))
    )


def test_heavy_value_is_cut_by_the_next_key(tied):
    dealt = o._dealt(tied, ["k", "id"], 16)
    largest = dealt.groupBy(o._PART).count().agg(F.max("count")).first()[0]
    assert largest < 2000 / 16 * 2.5


def test_three_keys(spark):
    rows = [(1, i % 3, i) for i in range(600)]
    df = spark.createDataFrame(rows, "a int, b int, c int")
    got = {(r["b"], r["c"]): r["row_number"] for r in o.ord_row_number(df, ["a", "b", "c"], ranges=12).collect()}
    want = {(b, c): n + 1 for n, (_, b, c) in enumerate(sorted(rows))}
    assert got == want


def test_empty_table(spark):
    empty = spark.createDataFrame([], "k double, id bigint")
    assert o.ord_row_number(empty, ["k", "id"]).count() == 0


def test_wide_numbers_and_text(spark):
    """Neighbours beyond 2**53, which doubles cannot tell apart, and text."""
    rows = [(2**53 + i % 2, f"t{(i * 37) % 4000:05}", i) for i in range(4000)]
    df = spark.createDataFrame(rows, "a bigint, b string, c int")
    got = {r["c"]: r["row_number"] for r in o.ord_row_number(df, ["a", "b"], ranges=8).collect()}
    assert got == {c: n + 1 for n, (_, _, c) in enumerate(sorted(rows))}
    narrow = spark.createDataFrame([(Decimal("1234567890123456789.1"),), (Decimal("1234567890123456789.2"),), (None,)], "d decimal(22,1)")
    assert [r["row_number"] for r in o.ord_row_number(narrow, ["d"], ranges=3).orderBy("d").collect()] == [1, 2, 3]


def test_nan_is_last_and_null_is_first(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, None), (3, 5.0), (4, float("inf"))], "id int, k double")
    assert ours(o.ord_row_number(df, ["k", "id"]), "row_number") == {2: 1, 3: 2, 4: 3, 1: 4}


def test_hot_key_gives_the_running_totals_of_a_plain_window(spark):
    rng = random.Random(3)
    rows = [(None if i % 40 == 0 else 1 if i % 3 else i % 20, rng.randint(0, 50), i, rng.randint(-5, 9)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k bigint, day int, id bigint, v int").withColumn("v", F.col("v").cast("decimal(10,2)"))
    window = Window.partitionBy("k").orderBy("day", "id").rowsBetween(Window.unboundedPreceding, 0)
    found = o.keyed_running(df, "k", ["day", "id"], "v", "s", "n")
    want = df.withColumn("s", F.sum("v").over(window)).withColumn("n", F.row_number().over(window))
    assert found.schema["s"].dataType == want.schema["s"].dataType
    assert {r["id"]: (r["s"], r["n"]) for r in found.collect()} == {r["id"]: (r["s"], r["n"]) for r in want.collect()}


def test_tile_of_rank(spark):
    for n, k in ((10, 4), (3, 5), (7, 7), (100, 10)):
        got = [r[0] for r in spark.range(1, n + 1).select(o.tile_of_rank(F.col("id"), n, k)).collect()]
        want = [r[0] for r in spark.range(1, n + 1).select(F.ntile(k).over(Window.orderBy("id"))).collect()]
        assert got == want

"""Differences of versions, valuations, packing and upserts of files, profiles from footers."""

from __future__ import annotations

import random
from collections import Counter
from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lossline.operators import profile, quality, reports
from lossline.sources import sinks

ROW = "k long, a string, b double"


def diff(spark, old, new, **more):
    old, new = spark.createDataFrame(old, ROW), spark.createDataFrame(new, ROW)
    return Counter(tuple(r) for r in quality.table_diff(old, new, "k", **more).collect())


def test_diff_of_repeated_and_null_keys(spark):
    old = [(1, "x", 1.0), (1, "x", 1.0), (2, "y", None), (None, "n", 1.0), (3, "z", 3.0), (5, "p", 1.0), (5, "q", 1.0)]
    new = [(1, "x", 1.0), (2, "y", 2.0), (None, "m", 1.0), (4, "w", 4.0), (4, "w", 4.0), (5, "q", 1.0), (5, "p", 1.0)]
    want = {(1, "removed", ""): 1, (2, "changed", "b"): 1, (None, "changed", "a"): 1, (3, "removed", ""): 1, (4, "added", ""): 2}
    for buckets in (1, 7, 4096):
        assert diff(spark, old, new, buckets=buckets) == Counter(want)


def test_equal_versions_move_digests_only(spark):
    draw = random.Random(1)
    rows = [(draw.randrange(90), draw.choice("abc"), draw.random()) for _ in range(400)]
    mixed = random.Random(2).sample(rows, len(rows))
    old, new = (spark.createDataFrame(r, ROW).repartition(n) for r, n in ((rows, 3), (mixed, 5)))
    assert quality.changed_buckets(old, new, "k", 16).count() == 0
    assert quality.table_diff(old, new, "k", 16).count() == 0
    # One row less shows in one bucket of 16.
    assert quality.changed_buckets(old, spark.createDataFrame(mixed[1:], ROW), "k", 16).count() == 1
    # A row that moves between keys of a bucket, and one that is there twice instead of once, show too.
    assert quality.changed_buckets(old, spark.createDataFrame([*mixed[1:], mixed[1]], ROW), "k", 1).count() == 1


def test_triangle_at_a_thousand_valuations(spark):
    draw = random.Random(3)
    first = date(2000, 1, 1)
    rows = []
    for _ in range(300):
        year, day = draw.randrange(2000, 2004), first + timedelta(days=draw.randrange(2400))
        rows.append((year, max(-1, day.year - year), day, draw.randrange(100)))
    payments = spark.createDataFrame(rows, "accident_year int, development_year int, payment_date date, payment_amount int")
    dates = [first + timedelta(days=2 * i) for i in range(1000)]
    valuations = spark.createDataFrame([(d,) for d in dates] + [(dates[0],), (None,)], "as_of date")
    found = reports.triangle_as_of(payments, valuations)
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString().replace("BroadcastNestedLoopJoin BuildRight, Cross", "")
    got = {(r.as_of, r.accident_year): tuple(r)[2:] for r in found.collect()}
    for as_of in random.Random(4).sample(dates, 25):
        for year in range(2000, 2004):
            known = [r for r in rows if r[0] == year and r[1] >= 0 and r[2] <= as_of]
            cells = tuple(
                sum(r[3] for r in known if r[1] <= d) if any(r[1] == d for r in known) else None for d in range(6)
            )
            assert got.get((as_of, year)) == (cells if known else None)


def files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


def test_packing_of_small_files(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(3000).select("id", (F.col("id") % 3).alias("part"), F.lit("x y").alias("name"))
    rows.repartition(8).write.partitionBy("part", "name").parquet(path)
    big = spark.range(200_000).select((F.col("id") + 10_000).alias("id"), F.lit(1).alias("part"), F.lit("x y").alias("name"))
    big.coalesce(1).write.mode("append").partitionBy("part", "name").parquet(path)
    before = files(path)
    large = {f for f in before if (tmp_path / "t" / f).stat().st_size > 100_000}
    assert len(large) == 1 and len(before) == 25
    assert sinks.compact_small_files(spark, path, file_bytes=200_000) == 24
    after = files(path)
    assert large <= set(after) and all(after[f] == before[f] for f in large)
    assert Counter(str(Path(f).parent) for f in after) == {"part=0/name=x%20y": 1, "part=1/name=x%20y": 2, "part=2/name=x%20y": 1} or len(after) == 4
    read = spark.read.parquet(path)
    assert read.count() == 203_000 and read.agg(F.sum("id")).first()[0] == sum(range(3000)) + sum(range(10_000, 210_000))
    assert not list((tmp_path / "t").glob("_compact*"))
    assert sinks.compact_small_files(spark, path, file_bytes=200_000) == 0 and files(path) == after


def test_packing_ends_what_a_lost_run_began(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.range(100).repartition(5).write.parquet(path)

    def lost(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(sinks, "_finish", lost)
        with pytest.raises(KeyboardInterrupt):
            sinks.compact_small_files(spark, path)
    assert len(files(tmp_path / "t")) > 5 and spark.read.parquet(path).count() == 100  # what is staged is hidden
    sinks.compact_small_files(spark, path)
    assert len(files(tmp_path / "t")) == 1 and spark.read.parquet(path).count() == 100
    (tmp_path / "t" / "_compact-torn").mkdir()  # staged without a list: nothing was replaced yet
    sinks.compact_small_files(spark, path)
    assert not (tmp_path / "t" / "_compact-torn").exists()


def test_upsert_of_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(60).select("id", F.lit("old").alias("v"), (F.col("id") % 4).cast("int").alias("part")).write.partitionBy("part").parquet(path)
    before = files(path)
    updates = spark.createDataFrame([(1, "new", 1), (2, "moved", 1), (100, "added", 7)], "id long, v string, part int")
    for _ in range(2):  # a repeated run changes nothing
        assert sinks.upsert_partitions(updates, path, "id", "part") in ([1, 2, 7], [1, 7])
        rows = {r.id: (r.v, r.part) for r in spark.read.parquet(path).collect()}
        assert len(rows) == 61 and rows[1] == ("new", 1) and rows[2] == ("moved", 1) and rows[100] == ("added", 7) and rows[6] == ("old", 2)
    after = files(path)
    assert {f for f in before if f.startswith(("part=0", "part=3"))} == {f for f in after if f.startswith(("part=0", "part=3"))}
    assert not {f for f in before if f.startswith("part=1")} & set(after)
    for bad in ([(1, "a", 1), (1, "b", 2)], [(None, "a", 1)]):
        with pytest.raises(ValueError, match="null or repeated"):
            sinks.upsert_partitions(spark.createDataFrame(bad, "id long, v string, part int"), path, "id", "part")


def test_upsert_empties_a_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id long, v string, part string").write.partitionBy("part").parquet(path)
    sinks.upsert_partitions(spark.createDataFrame([(1, "c", "y")], "id long, v string, part string"), path, "id", "part")
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "c", "y"), (2, "b", "y")]


def test_profile_from_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.sql(
        "SELECT id, if(id % 3 = 0, NULL, id * 0.5D) AS x, concat('w', id) AS s, date_add(date'2024-01-01', int(id)) AS d, array(id) AS l, "
        "timestamp'2024-01-01 00:00:00' AS t, CAST(NULL AS int) AS `odd name` FROM range(10)"
    )
    df.repartition(2).write.parquet(path)
    got = {r.column_name: (r.row_count, r.null_count, r.min_value, r.max_value) for r in profile.profile_table(spark, path, "t").collect()}
    assert got["id"] == (10, 0, "0", "9") and got["x"] == (10, 4, "5.000000000e-01", "4.000000000e+00")
    assert got["s"] == (10, 0, "w0", "w9") and got["d"] == (10, 0, "2024-01-01", "2024-01-10") and got["l"] == (10, 0, None, None)
    assert got["t"] == (10, 0, "2024-01-01 00:00:00", "2024-01-01 00:00:00") and got["odd name"] == (10, 10, None, None)
    with profile._footers_first(spark):
        counts, bounds = (
            df._jdf.queryExecution().executedPlan().toString()
            for df in (profile.footer_counts(spark.read.parquet(path)), profile.bounds(spark.read.parquet(path), [0, 3]))
        )
    assert "PushedAggregation: [COUNT(*), COUNT(id)" in counts and "PushedAggregation: [MIN(id), MAX(id), MIN(d), MAX(d)]" in bounds

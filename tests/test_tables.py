"""Sources, sinks, patterns and quality checks on small rows."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lossline.functions.columns import dataset_name
from lossline.operators import patterns, profile, quality
from lossline.session import shared_folder, work_path
from lossline.sources import files, sinks
from lossline.sources.schemas import RAW_SCHEMAS


def test_missing_raw_table_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException):
        files.load_raw_tables(spark, str(tmp_path), "csv")
    with pytest.raises(ValueError):
        files.load_raw_tables(spark, str(tmp_path), "xml")
    with pytest.raises(ValueError):
        files.read_glob(spark, str(tmp_path), "a int", "json")


def test_csv_types_are_declared(spark, tmp_path):
    (tmp_path / "c.csv").write_text("coverage_type,coverage_category,description\nauto,casualty,\"a, b\"\n")
    assert files.read_csv(spark, str(tmp_path / "c.csv"), RAW_SCHEMAS["coverages"]).first()["description"] == "a, b"
    (tmp_path / "bad.csv").write_text("a,b\nx,1\n")
    with pytest.raises(Exception):
        files.read_csv(spark, str(tmp_path / "bad.csv"), "a INT, b INT").collect()


def test_watched_folder_hands_over_new_files_once(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    seen = []
    look = lambda: files.new_files(spark, str(inbox), "a INT", str(tmp_path / "cp"), lambda b, n: seen.extend(r["a"] for r in b.collect()))
    (inbox / "one.csv").write_text("a\n1\n")
    look()
    (inbox / "two.csv").write_text("a\n2\n")
    (inbox / "notes.txt").write_text("a\n9\n")
    look()
    look()
    assert seen == [1, 2]


def test_failing_export_is_logged_or_raised(spark, tmp_path):
    tables = {"good": spark.range(2), "bad": spark.range(2).select(F.array("id").alias("list"))}
    assert list(sinks.export_csv(tables, str(tmp_path), must=False)) == ["good"]
    with pytest.raises(Exception):
        sinks.export_csv(tables, str(tmp_path))


def test_backfill_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.backfill_partitions(spark.createDataFrame([(1, 2020), (2, 2021)], "v int, year int"), path, "year")
    for _ in range(2):
        sinks.backfill_partitions(spark.createDataFrame([(9, 2021)], "v int, year int"), path, "year")
    assert sorted((r["v"], r["year"]) for r in spark.read.parquet(path).collect()) == [(1, 2020), (9, 2021)]


def test_a_hot_year_is_written_by_several_tasks(spark, tmp_path):
    df = spark.range(4000).select("id", F.lit(date(2020, 1, 1)).alias("day"))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "4k")
    written = sinks.write_partitioned(df, str(tmp_path / "t"), "day", ["id"])
    assert written.select("_metadata.file_path").distinct().count() > 1 and written.count() == 4000
    spark.conf.unset(size)


def test_compaction(spark, tmp_path):
    spark.range(1000).repartition(20).write.parquet(str(tmp_path / "many"))
    assert sinks.compact(spark, str(tmp_path / "many"), str(tmp_path / "few")) == 1
    assert len(list((tmp_path / "few").glob("*.parquet"))) == 1 and spark.read.parquet(str(tmp_path / "few")).count() == 1000


def test_profile_of_a_folder(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x\n1\n")
    (tmp_path / "b.txt").write_text("no")
    spark.range(3).write.parquet(str(tmp_path / "p"))
    totals = profile.directory_totals(profile.profile_directory(spark, str(tmp_path))).first()
    assert totals["csv_count"] == 1 and totals["parquet_count"] >= 1 and totals["total_size_bytes"] > 0


def test_scratch_is_below_the_named_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert work_path(spark, "a") != work_path(spark, "a") and work_path(spark, "a").startswith(shared_folder(spark))


def test_a_cluster_must_name_the_shared_folder():
    class Session:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError):
        shared_folder(Session)


def test_history_load_and_lookup(spark):
    changes = spark.createDataFrame([(1, date(2020, 1, 1), "a"), (1, date(2020, 2, 1), "a"), (1, date(2020, 3, 1), "b")], "k int, valid_from date, s string")
    history = patterns.scd2_from_changes(changes, ["k"], "valid_from")
    assert [(r["s"], r["valid_to"]) for r in history.orderBy("valid_from").collect()] == [("a", date(2020, 3, 1)), ("b", None)]
    facts = spark.createDataFrame([(1, date(2019, 1, 1)), (1, date(2020, 2, 29)), (1, date(2020, 3, 1)), (2, date(2020, 3, 1)), (None, None)], "k int, d date")
    got = sorted(((r["k"], str(r["d"]), r["s"]) for r in patterns.scd2_lookup(facts, history, "k", "d").collect()), key=str)
    assert got == sorted([(1, "2019-01-01", None), (1, "2020-02-29", "a"), (1, "2020-03-01", "b"), (2, "2020-03-01", None), (None, "None", None)], key=str)
    loaded = patterns.scd2_apply(history, spark.createDataFrame([(1, "c"), (2, "n")], "k int, s string"), "k", F.lit(date(2021, 1, 1)))
    assert sorted((r["k"], r["s"]) for r in loaded.filter("is_current").collect()) == [(1, "c"), (2, "n")]
    assert loaded.count() == 4
    same = patterns.scd2_apply(loaded, loaded.filter("is_current").select("k", "s"), "k", F.lit(date(2022, 1, 1)))
    assert same.exceptAll(loaded).count() == 0 and same.count() == 4


def test_closed_version_is_not_found_after_its_end(spark):
    history = spark.createDataFrame([(1, date(2020, 1, 1), date(2020, 2, 1), "a")], "k int, valid_from date, valid_to date, s string")
    facts = spark.createDataFrame([(1, date(2020, 1, 31)), (1, date(2020, 2, 1))], "k int, d date")
    assert sorted(str(r["s"]) for r in patterns.scd2_lookup(facts, history, "k", "d").collect()) == ["None", "a"]


def test_masks(spark):
    df = spark.createDataFrame([("abcdef", "x", "ab")], "a string, b string, c string")
    row = patterns.mask_pii(df, hashed=["b"], partial=["a", "c"]).first()
    assert row["a"] == "****ef" and row["c"] == "**" and len(row["b"]) == 64


def test_schema_and_table_diff(spark):
    old = quality.schema_of(spark.createDataFrame([], "a int, b int, c int"))
    new = quality.schema_of(spark.createDataFrame([], "a int, b string, d int"))
    assert {(r["column_name"], r["change"]) for r in quality.schema_diff(old, new).collect()} == {("b", "CHANGED"), ("c", "REMOVED"), ("d", "ADDED")}
    before = spark.createDataFrame([(1, "a", None), (2, "b", 1), (3, "c", 1)], "k int, x string, y int")
    after = spark.createDataFrame([(1, "a", None), (2, "z", None), (4, "d", 1)], "k int, x string, y int")
    got = {(r["k"], r["change"], r["columns"]) for r in quality.table_diff(before, after, "k").collect()}
    assert got == {(2, "changed", "x,y"), (3, "removed", ""), (4, "added", "")}


def test_gate_on_an_empty_table(spark):
    claims = spark.createDataFrame([], RAW_SCHEMAS["claims"])
    policies = spark.createDataFrame([], RAW_SCHEMAS["policies"])
    passed = {r["check_name"]: r["passed"] for r in quality.dq_gate(claims, policies, date(2024, 1, 1)).collect()}
    assert not passed["row_count_claims"] and not passed["date_freshness"] and passed["referential_integrity"]


def test_dataset_names():
    assert dataset_name("staging", "prod") == "staging" and dataset_name("staging", "dev") == "dev_staging"


def test_numbers_of_long_ids_stay_whole(spark):
    from lossline.operators.motor import _number

    rows = spark.createDataFrame([(7,), (999_999,), (1_000_000,), (12_345_678,)], "k long")
    got = [r[0] for r in rows.select(_number("POL-", F.col("k"))).collect()]
    assert got == ["POL-000007", "POL-999999", "POL-1000000", "POL-12345678"]


def test_pivot_adds_up(spark):
    from lossline.operators import patterns

    rows = spark.createDataFrame([("a", 1, 10), ("a", 9, 5), ("a", None, 2), ("b", -1, 3)], "g string, y int, v int")
    got = {r.g: (r.y_1, r.y_2, r.y_other) for r in patterns.pivot_sum(rows, "g", "y", [1, 2], "v", "y_").collect()}
    assert got == {"a": (10, 0, 7), "b": (0, 0, 3)}


def _sources(df):
    return {f.rsplit("/testdata/", 1)[-1].split("/")[-1] for f in df.inputFiles()}


def test_partitioned_tables_are_built_from_those_already_written(spark, data, monkeypatch):
    from lossline.plans import queries_tables
    from lossline.plans.catalog import Data

    seen, write = {}, sinks.write_partitioned

    def noted(df, path, *more):
        seen[path.rsplit("by-year-", 1)[-1].rsplit("-", 1)[0]] = (_sources(df), df.columns)
        return write(df, path, *more)

    monkeypatch.setattr(sinks, "write_partitioned", noted)
    found = queries_tables._partitioned(Data(spark, data))
    assert "lineitem.parquet" in seen["stg_claim_payments"][0]
    for name in ("int_claim_payments_cumulative", "fct_claims", "fct_claim_payments"):
        assert "lineitem.parquet" not in seen[name][0]
        assert not [c for c in seen[name][1] if c.endswith("_date_year")]
    assert {r.table_name for r in found.collect()} == set(sinks.LAYOUT)


def test_exports_share_what_several_of_them_read(spark, data, monkeypatch):
    from lossline.plans import queries_tables
    from lossline.plans.catalog import Data

    seen, export = {}, sinks.export_csv
    monkeypatch.setattr(sinks, "export_csv", lambda tables, folder: seen.update(tables) or export(tables, folder))
    found = queries_tables._exported(Data(spark, data)).collect()
    for name in ("fct_claims", "fct_claim_payments", "rpt_loss_triangle"):
        assert "lineitem.parquet" not in _sources(seen[name])
    assert {r.table_name for r in found} == set(sinks.WAREHOUSE_EXPORTS)

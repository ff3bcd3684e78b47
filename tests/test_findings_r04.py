"""Disk of the warehouse's exports: what a reviewer found to fill it on larger tables."""

from __future__ import annotations

import os
import re
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lossline.plans import queries_tables
from lossline.plans.catalog import Data
from lossline.session import DROP_SHUFFLES, shuffles_dropped
from lossline.sources import sinks


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Three claims of two policies; one payment of claim 1 comes before its accident, claim 3 is paid only before it."""
    at, day = tmp_path_factory.mktemp("tables"), lambda y, m=6: datetime(y, m, 1)
    orders = [(1, 7, "F", 100.0, day(1996), "1-URGENT"), (2, 7, "O", 50.0, day(1996), "1-URGENT"), (3, 8, "O", 70.0, day(1997), "2-HIGH"), (100, 8, None, 5.0, day(1997), "2-HIGH")]
    lines = [(1, 1, 1.0, 10.0, "N", day(1995)), (1, 2, 1.0, 20.0, "A", day(1996)), (1, 3, 1.0, 30.5, "N", day(1997)), (1, 3, 2.0, 0.0, "R", day(1997)),
             (2, 1, 1.0, 40.0, None, day(1996)), (3, 1, 1.0, 60.0, "N", day(1996)), (9, 1, 1.0, 70.0, "N", day(1996)), (None, 1, 1.0, 80.0, "N", day(1996))]
    tables = {
        "nation": ([(0, "PERU", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(7, "Customer#7", 0, "AUTO"), (8, "Customer#8", 0, None)], "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string"),
        "orders": (orders, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": (
            [(key, 1, 1, *rest) for key, *rest in lines],
            "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_shipdate timestamp",
        ),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{at}/{name}.parquet")
    return str(at)


def _shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for _, _, files in os.walk(d) for f in files if re.fullmatch(r"shuffle_.*\.data", f)}


def test_exports_leave_no_shuffle_files(spark, folder):
    before, set_before = _shuffle_files(spark), spark.conf.get(DROP_SHUFFLES, None)
    queries_tables._exported(Data(spark, folder))
    until = time.monotonic() + 20
    while (left := _shuffle_files(spark) - before) and time.monotonic() < until:
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(DROP_SHUFFLES, None) == set_before


def test_exports_are_whole_and_shuffle_payments_once_for_the_triangle(spark, folder, monkeypatch):
    seen, paths, export = {}, {}, sinks.export_csv
    monkeypatch.setattr(sinks, "export_csv", lambda tables, to: (seen.update(tables), paths.update(export(tables, to)), paths)[-1])
    found = [tuple(r) for r in queries_tables._exported(Data(spark, folder)).collect()]
    assert [n for n, _ in found] == list(sinks.WAREHOUSE_EXPORTS)
    assert dict(found) | {"dim_date": 0} == {
        "dim_date": 0, "dim_policyholder": 2, "dim_policy": 2, "dim_coverage": 2, "fct_claims": 4, "fct_claim_payments": 6, "rpt_loss_triangle": 1, "rpt_claim_frequency": 2,
    }
    # What still shuffles comes before the large files; what is kept for it is small.
    assert list(seen)[:2] == ["rpt_claim_frequency", "rpt_loss_triangle"]
    for name in ("fct_claims", "fct_claim_payments", "rpt_loss_triangle"):
        assert all(f.endswith(".zstd.parquet") for f in seen[name].inputFiles())
    plan = seen["rpt_loss_triangle"]._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(claim_id", plan)) == 1
    triangle = spark.read.option("header", True).csv(paths["rpt_loss_triangle"]).select("accident_year", "dev_year_0", "dev_year_1", "latest_cumulative", "claim_count")
    assert [tuple(r) for r in triangle.collect()] == [("1996", "60.00", "70.50", "70.50", "2")]
    paid = spark.read.option("header", True).csv(paths["fct_claims"]).select("claim_id", F.col("total_paid").cast("double"), "payment_count")
    assert sorted(tuple(r) for r in paid.collect()) == [("1", 40.5, "4"), ("100", 0.0, "0"), ("2", 40.0, "1"), ("3", 60.0, "1")]


def test_setting_of_shuffle_files_is_restored(spark):
    before = spark.conf.get(DROP_SHUFFLES, None)
    for given in ("false", "true"):
        spark.conf.set(DROP_SHUFFLES, given)
        with pytest.raises(ValueError), shuffles_dropped(spark):
            assert spark.conf.get(DROP_SHUFFLES) == "true"
            raise ValueError
        assert spark.conf.get(DROP_SHUFFLES) == given
    spark.conf.unset(DROP_SHUFFLES)
    with shuffles_dropped(spark):
        pass
    assert spark.conf.get(DROP_SHUFFLES, None) is None or spark.conf.get(DROP_SHUFFLES) == "false"
    if before is not None:
        spark.conf.set(DROP_SHUFFLES, before)

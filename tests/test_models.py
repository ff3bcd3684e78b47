"""Warehouse models on small hand-made rows."""

from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import Window, functions as F

from lossline.config import Config
from lossline.functions.columns import completed_years, prorated_money
from lossline.operators import intermediate, marts, reports, staging
from lossline.plans.catalog import Data
from lossline.plans.runner import run_layer, run_layers
from lossline.plans.warehouse import RAW, Warehouse
from lossline.sources.projection import PROJECTION_CONFIG, raw_tables
from lossline.sources.schemas import RAW_SCHEMAS


def claims(spark, rows):
    """rows: (claim_id, report day or None, number)."""
    full = [(i, 1, n, date(2021, 5, 1), r, None, " Open ", None, Decimal(1), Decimal(1)) for i, r, n in rows]
    return spark.createDataFrame(full, RAW_SCHEMAS["claims"])


def test_claim_copies_keep_the_earliest_report(spark):
    raw = claims(spark, [(1, date(2021, 6, 2), "b"), (1, date(2021, 6, 1), " a "), (1, None, "x"), (2, None, "c"), (None, None, "z")])
    got = {r["claim_id"]: r for r in staging.stg_claims(raw).collect()}
    assert set(got) == {1, 2}
    assert got[1]["claim_number"] == "a" and got[1]["report_delay_days"] == 31
    assert got[1]["claim_status"] == "open" and got[1]["cause_of_loss"] == "not_specified"
    assert got[2]["report_date"] is None and got[2]["accident_quarter"] == 2


def test_claim_copies_are_thinned_out_before_the_shuffle(spark):
    plan = staging.stg_claims(claims(spark, [(1, None, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_exposure_is_clipped_and_prorated(spark):
    rows = [
        (1, 1, "p", "auto", date(2019, 7, 1), date(2020, 7, 1), Decimal("366.00"), Decimal(0), Decimal(0), "active"),
        (2, 1, "p", "auto", date(2021, 1, 1), date(2022, 1, 1), Decimal("100.00"), Decimal(0), Decimal(0), " Cancelled"),
        (3, 1, "p", "auto", date(2018, 1, 1), date(2019, 1, 1), Decimal("100.00"), Decimal(0), Decimal(0), "expired"),
        (4, 1, "p", "auto", date(2025, 12, 1), date(2026, 12, 1), Decimal("365.00"), Decimal(0), Decimal(0), "active"),
        (5, 1, "p", "auto", date(2022, 1, 1), date(2022, 1, 1), Decimal("1.00"), Decimal(0), Decimal(0), "active"),
    ]
    policies = staging.stg_policies(spark.createDataFrame(rows, RAW_SCHEMAS["policies"]))
    assert policies.count() == 4
    got = {r["policy_id"]: r for r in intermediate.int_policy_exposure(policies, Config()).collect()}
    assert set(got) == {1, 4}
    assert (got[1]["exposure_days"], got[1]["earned_premium"], got[1]["exposure_year"]) == (182, Decimal("182.00"), 2020)
    assert (got[4]["exposure_days"], got[4]["earned_premium"]) == (30, Decimal("30.00"))


@pytest.mark.parametrize("amount, part, whole, want", [("0.01", 1, 2, "0.01"), ("0.01", 1, 3, "0.00"), ("-0.01", 1, 2, "-0.01"), ("100.00", 1, 3, "33.33")])
def test_money_rounds_half_away_from_zero(spark, amount, part, whole, want):
    df = spark.createDataFrame([(Decimal(amount), part, whole)], "a decimal(14,2), p int, w int")
    assert df.select(prorated_money(F.col("a"), F.col("p"), F.col("w"))).first()[0] == Decimal(want)


@pytest.mark.parametrize("birth, day, want", [(date(2000, 2, 29), date(2001, 2, 28), 0), (date(2000, 2, 29), date(2001, 3, 1), 1), (date(1990, 5, 5), date(2020, 5, 5), 30), (date(1990, 5, 5), date(2020, 5, 4), 29)])
def test_age(spark, birth, day, want):
    df = spark.createDataFrame([(birth, day)], "b date, d date")
    assert df.select(completed_years("b", "d")).first()[0] == want


def test_calendar(spark):
    claims = spark.createDataFrame([(date(2020, 5, 1),)], "accident_date date")
    payments = spark.createDataFrame([(date(2021, 5, 1),)], "payment_date date")
    days = marts.dim_date(marts.calendar_span_of(claims, payments, Config())).cache()
    later = marts.calendar_span_of(claims, payments.select(F.date_add("payment_date", 4000).alias("payment_date")), Config()).first()
    assert later["first_day"] == date(2019, 1, 1) and later["last_day"] == date(2032, 12, 31)
    assert days.count() == 2922 and days.select("date_key").distinct().count() == 2922
    row = days.filter("full_date = '2024-12-31'").first()
    assert row["is_year_end"] and row["is_quarter_end"] and row["day_of_week"] == 2 and row["year_quarter_label"] == "2024-Q4"
    assert days.filter("full_date = '2023-01-01'").first()["day_of_week"] == 0


def triangle(spark, cells):
    """Cumulative cells {year: [dev 0, dev 1, ...]} as payments, one claim a year."""
    rows = []
    for year, values in cells.items():
        before = 0
        for dev, value in enumerate(values):
            rows.append((year, year, dev, Decimal(value - before)))
            before = value
    return spark.createDataFrame(rows, "claim_id bigint, accident_year int, development_year int, payment_amount decimal(16,2)")


def test_link_ratios_of_the_textbook_triangle(spark):
    long = reports.triangle_long(triangle(spark, {2021: [500, 1200], 2022: [600, 1400], 2023: [550, 1300], 2024: [580, 1350], 2025: [620]}))
    got = {r["accident_year"]: round(r["link_ratio"], 2) for r in reports.bi_link_ratios(long).collect()}
    assert got == {2021: 2.40, 2022: 2.33, 2023: 2.36, 2024: 2.33}
    assert round(reports.bi_weighted_factors(long).first()["weighted_factor"], 2) == 2.35
    ultimate = {r["accident_year"]: r["ultimate"] for r in reports.chain_ladder_ultimate(long).collect()}
    assert ultimate[2025] == pytest.approx(620 * 5250 / 2230) and ultimate[2021] == 1200


def test_triangle_keeps_gaps_and_counts_claims_paid_early(spark):
    paid = triangle(spark, {2020: [100, 300, 250]})
    early = spark.createDataFrame([(9, 2020, -1, Decimal(5))], paid.schema)
    row = reports.rpt_loss_triangle(paid.union(early)).first()
    assert (row["dev_year_0"], row["dev_year_2"], row["dev_year_3"]) == (100, 250, None)
    assert row["latest_cumulative"] == 300 and row["claim_count"] == 2


def test_running_totals_are_those_of_a_plain_window(spark, data):
    d = Data(spark, data)
    found = intermediate.int_claim_payments_cumulative(d["stg_claim_payments"], d["stg_claims"], d["stg_policies"])
    window = Window.partitionBy("claim_id").orderBy(*intermediate.PAYMENT_ORDER).rowsBetween(Window.unboundedPreceding, 0)
    wrong = found.withColumns({"s": F.sum("payment_amount").over(window), "n": F.row_number().over(window)})
    assert wrong.filter("s <> cumulative_paid OR n <> payment_rank").count() == 0 and found.count() > 0


# --- the layers -----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def run(spark, data, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("warehouse"))
    return run_layers(raw_tables(spark, data), PROJECTION_CONFIG, folder, ("staging", "intermediate", "marts", "reports"))


def test_run_writes_every_layer(run):
    assert run.success and run.error_message is None and run.seconds > 0
    assert [len(layer.tables) for layer in run.layers] == [5, 3, 6, 2]
    assert 0 < run.row_count("fct_claims") == run.row_count("int_claims_enriched") <= run.row_count("stg_claims")
    assert run.row_count("no_such_table") == -1


def test_unknown_layer_and_missing_upstream(spark, data, tmp_path):
    warehouse = Warehouse(raw_tables(spark, data), PROJECTION_CONFIG)
    assert "unknown layer" in run_layer(warehouse, "gold", str(tmp_path)).errors["gold"]
    missing = run_layer(warehouse, "reports", str(tmp_path), ["rpt_loss_triangle"])
    assert "missing upstream" in missing.errors["rpt_loss_triangle"]


def test_run_stops_at_the_first_failing_layer(spark, data, tmp_path):
    raw = dict(raw_tables(spark, data))
    raw["raw_claims"] = raw["raw_claims"]().drop("accident_date")
    run = run_layers(raw, PROJECTION_CONFIG, str(tmp_path))
    assert not run.success and [layer.layer for layer in run.layers] == ["staging"] and "stg_claims" in run.error_message
    del raw["raw_claims"]
    assert "raw table is missing" in run_layers(raw, PROJECTION_CONFIG, str(tmp_path)).error_message


def test_models_name_their_inputs(spark, data):
    warehouse = Warehouse(raw_tables(spark, data), PROJECTION_CONFIG)
    assert len(warehouse) == 25 and list(warehouse)[: len(RAW)] == list(RAW)


def test_training_set_writes_only_the_columns_of_claims_it_reads(spark, data):
    from lossline.plans import warehouse

    plain, kept = Data(spark, data), Data(spark, data)
    whole = kept["model_training_set"]
    assert kept.models._narrow["fct_claims"].columns == list(warehouse.PRICED_CLAIMS)
    assert len(kept["fct_claims"].columns) > len(warehouse.PRICED_CLAIMS)  # others still see the whole table
    plain.models.keep("fct_claims")
    assert not plain.models._narrow
    other = plain["model_training_set"]
    assert not plain.models._narrow and whole.exceptAll(other).count() == other.exceptAll(whole).count() == 0 < whole.count()

"""The raw insurance tables, projected from order, customer and event tables.

An order is a claim, its lines are the payments, a customer is a policyholder, and the
orders one customer places under one priority form a policy. Each function is a plain
projection: nothing is sampled, and the work grows with the tables that are read.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from lossline.config import Config

# Observation window matching the dates found in the order tables.
PROJECTION_CONFIG = Config(
    valuation_date=date(2000, 12, 31),
    observation_start=date(1995, 1, 1),
    train_through_year=1997,
    spine_start=date(1990, 1, 1),
    spine_end=date(2000, 12, 31),
)


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


DIGIT = "CAST(substring(o_orderpriority, 1, 1) AS BIGINT)"


def raw_policies(orders: DataFrame) -> DataFrame:
    policy = orders.groupBy("o_custkey", F.expr(DIGIT).alias("digit")).agg(
        F.min(F.to_date("o_orderdate")).alias("effective_date"), F.max("o_totalprice").alias("price")
    )
    return policy.selectExpr("o_custkey * 10 + digit AS policy_id", "*").selectExpr(
        "policy_id",
        "o_custkey AS policyholder_id",
        "concat('POL-', lpad(CAST(policy_id AS STRING), 10, '0')) AS policy_number",
        "elt(CAST(digit AS INT), ' Auto', 'HOME ', 'liability', 'Health', 'life') AS coverage_type",
        "effective_date",
        "date_add(effective_date, CAST(CASE WHEN policy_id % 97 = 0 THEN 0 ELSE 180 + policy_id % 1500 END AS INT))"
        " AS expiration_date",
        "CAST(price AS DECIMAL(14,2)) AS annual_premium",
        "CAST(policy_id % 20 * 1000 AS DECIMAL(14,2)) AS deductible",
        "CAST(200000 + policy_id % 50 * 100000 AS DECIMAL(16,2)) AS coverage_limit",
        "CASE WHEN policy_id % 13 = 0 THEN 'Cancelled' WHEN policy_id % 3 = 0 THEN ' active ' ELSE 'expired' END"
        " AS status",
    )


def raw_claims(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        "o_orderkey AS claim_id",
        f"o_custkey * 10 + {DIGIT} AS policy_id",
        "to_date(o_orderdate) AS accident_date",
        "CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'O' THEN 'open '"
        " ELSE if(o_orderkey % 2 = 0, 'denied', 'REOPENED') END AS claim_status",
        "CAST(o_totalprice AS DECIMAL(16,2)) AS initial_reserve",
        "explode(if(o_orderkey % 100 = 0, array(0, 1), array(0))) AS copy",
    ).selectExpr(
        "claim_id",
        "policy_id",
        "concat('CLM-', claim_id) AS claim_number",
        "accident_date",
        "date_add(accident_date, CAST(claim_id % 120 + copy AS INT)) AS report_date",
        "if(claim_status = 'Closed', date_add(accident_date, CAST(150 + claim_id % 400 AS INT)), NULL) AS close_date",
        "claim_status",
        "if(claim_id % 25 = 0, NULL, concat('Cause_', claim_id % 6)) AS cause_of_loss",
        "initial_reserve",
        "CAST(if(claim_status IN ('Closed', 'denied'), 0, initial_reserve) AS DECIMAL(16,2)) AS current_reserve",
    )


def raw_claim_payments(lineitem: DataFrame) -> DataFrame:
    return lineitem.selectExpr(
        "(l_orderkey * 8 + l_linenumber) * 1048576 + (l_partkey * 7919 + l_suppkey * 104729) % 1048576 AS payment_id",
        "l_orderkey AS claim_id",
        "to_date(l_shipdate) AS payment_date",
        "CAST(if(l_returnflag = 'R', -10 * l_quantity, l_extendedprice) AS DECIMAL(16,2)) AS payment_amount",
        "CASE l_returnflag WHEN 'N' THEN 'Indemnity' WHEN 'A' THEN 'expense ' ELSE 'recovery' END AS payment_type",
        "l_linenumber",
    ).selectExpr(
        "* EXCEPT (l_linenumber)", "CAST(payment_amount * l_linenumber AS DECIMAL(16,2)) AS cumulative_paid"
    )


def raw_policyholders(customer: DataFrame, nation: DataFrame) -> DataFrame:
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).selectExpr(
        "c_custkey AS policyholder_id",
        "concat(' ', split_part(c_name, '#', 1)) AS first_name",
        "concat(split_part(c_name, '#', 2), ' ') AS last_name",
        "date_add(DATE '1930-01-01', CAST(c_custkey * 37 % 16000 AS INT)) AS date_of_birth",
        "if(c_custkey % 2 = 0, 'm', 'F ') AS gender",
        "lower(n_name) AS state_code",
        "if(c_custkey % 14 = 0, NULL, concat('City ', c_custkey % 40)) AS city",
        "if(c_custkey % 8 = 0, NULL, c_mktsegment) AS occupation",
        "date_add(DATE '1994-01-01', CAST(c_custkey % 700 AS INT)) AS registration_date",
    )


def raw_coverages(orders: DataFrame) -> DataFrame:
    """Reference rows for the coverages in use; life is left out so that left joins miss once."""
    return (
        orders.selectExpr(f"CAST({DIGIT} AS INT) AS digit")
        .distinct()
        .filter("digit < 5")
        .selectExpr(
            "elt(digit, 'AUTO', ' home', 'Liability ', 'health') AS coverage_type",
            "CASE digit WHEN 3 THEN ' casualty' WHEN 4 THEN 'HEALTH' ELSE 'Property_Casualty' END"
            " AS coverage_category",
            "concat(' Cover no. ', digit, ' ') AS description",
        )
    )


def raw_claim_events(events: DataFrame) -> DataFrame:
    """One JSON text per event (column value), with arrival order and the planted defects."""
    return events.selectExpr(
        "event_id",
        """concat_ws(', ',
          CASE WHEN event_id % 29 <> 0 THEN concat('"claim_id": "c-', event_id div 2, '"') END,
          concat('"policy_id": "POL-', user_id, '"'),
          concat('"accident_date": "', if(event_id % 37 = 0, 'not-a-date', date_format(ts, 'yyyy-MM-dd')), '"'),
          concat('"cause_of_loss": "', event_type, '"'),
          concat('"estimated_amount": ', if(event_id % 31 = 0, '-', ''), CAST(value AS DECIMAL(12,2))),
          concat('"coverage_type": "', CASE event_type WHEN 'click' THEN 'auto_colision' WHEN 'view' THEN 'hogar_robo'
            WHEN 'signup' THEN 'vida_individual' WHEN 'purchase' THEN 'gastos_medicos_mayores'
            ELSE 'unknown_x' END, '"'),
          concat('"claimant_state": "S', user_id % 32, '"'),
          '"currency": "MXN"',
          concat('"timestamp": "', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), 'Z"')) AS body""",
        "date_trunc('second', CAST(ts AS TIMESTAMP)) AS event_ts",
    ).selectExpr(
        "event_id",
        "concat('{', body, if(event_id % 41 = 0, '', '}')) AS value",
        "event_ts",
        "event_ts + make_dt_interval(0, 0, CASE WHEN event_id % 10 = 0 THEN 90 WHEN event_id % 7 = 0 THEN 3 ELSE 0 END)"
        " AS arrival_ts",
    )


def motor_frequency(customer: DataFrame, nation: DataFrame, orders: DataFrame) -> DataFrame:
    """Motor third-party frequency table: one row per policy."""
    key = F.col("c_custkey")
    counts = (
        orders.groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count("*").alias("claims"))
    )
    return (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(counts, "c_custkey", "left")
        .select(
            key.alias("IDpol"),
            F.coalesce("claims", F.lit(0)).alias("ClaimNb"),
            ((key % 100 + 1).cast("double") / 100).alias("Exposure"),
            F.substring(F.lit("ABCDEF"), (F.col("c_nationkey") % 6 + 1).cast("int"), F.lit(1)).alias("Area"),
            (4 + key % 9).alias("VehPower"),
            (18 + key % 70).alias("DrivAge"),
            (50 + key % 100).alias("BonusMalus"),
            F.col("n_name").alias("Region"),
        )
    )


def motor_severity(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_custkey").alias("IDpol"),
        F.col("o_totalprice").cast("decimal(16,2)").alias("ClaimAmount"),
    )


def raw_tables(spark: SparkSession, folder: str) -> dict[str, Callable[[], DataFrame]]:
    """The five raw tables of the warehouse by name, each composed only when it is asked for."""

    def of(build: Callable[..., DataFrame], *tables: str) -> Callable[[], DataFrame]:
        return lambda: build(*[load(spark, folder, t) for t in tables])

    return {
        "raw_policyholders": of(raw_policyholders, "customer", "nation"),
        "raw_policies": of(raw_policies, "orders"),
        "raw_claims": of(raw_claims, "orders"),
        "raw_claim_payments": of(raw_claim_payments, "lineitem"),
        "raw_coverages": of(raw_coverages, "orders"),
    }

"""Registered queries against their DuckDB SQL. LOSSLINE_ALL=1 runs every one of them."""

from __future__ import annotations

import os

import pytest
from compare import difference, duck

import __spark_entry__ as contract

BUILT, SQL = contract.queries(), contract.oracle_sql()
SHORT = """
stg_claims stg_policies int_claims_enriched int_claim_payments_cumulative int_policy_exposure fct_claims
rpt_loss_triangle triangle_as_of chain_ladder_ultimate ibnr rpt_claim_frequency summary_frequency_by_coverage
bi_portfolio_kpis bi_geo_risk feat_policy_experience feat_historical_benchmarks ord_ntile fremtpl_claims fremtpl_frequency
str_validate intake_validate_all batch_hourly_summary stream_late_arrivals stream_final_only dq_gate
dq_referential obs_volume table_diff profile_columns src_csv snk_merge_upsert pat_scd2 pat_scd2_lookup
obs_distribution_sketches table_diff_repeated_keys snk_compact_partitions snk_upsert_partitions src_glob_mixed pat_pivot
stream_late_arrivals_state stream_repeat_claims_state stream_session_state stream_enrich_policy_versions glm_frequency_sparse
""".split()


@pytest.fixture(scope="module")
def con(data):
    return duck(data)


@pytest.mark.parametrize("name", list(SQL) if os.environ.get("LOSSLINE_ALL") else SHORT)
def test_same_rows_as_duckdb(spark, con, data, name):
    assert difference(BUILT[name](spark, data), con, SQL[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(BUILT) and len(BUILT) > 150

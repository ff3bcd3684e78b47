"""Staging, intermediate, mart and report queries."""

from __future__ import annotations

from lossline.operators import bi, reports
from lossline.plans.catalog import add
from lossline.plans.oracle import relation, sql, table

# --- models, whole tables --------------------------------------------------------------

for _name, _money, _dates in (
    ("stg_policyholders", "", "date_of_birth registration_date"),
    ("stg_policies", "annual_premium deductible coverage_limit", "effective_date expiration_date"),
    ("stg_claims", "initial_reserve current_reserve", "accident_date report_date close_date"),
    ("stg_claim_payments", "payment_amount cumulative_paid", "payment_date"),
    ("stg_coverages", "", ""),
    (
        "int_claims_enriched",
        "initial_reserve current_reserve annual_premium deductible coverage_limit",
        "accident_date report_date close_date policy_effective_date policy_expiration_date",
    ),
    ("int_claim_payments_cumulative", "payment_amount cumulative_paid", "payment_date accident_date"),
    ("int_policy_exposure", "annual_premium", "effective_date expiration_date exposure_start exposure_end"),
    ("dim_date", "", "full_date"),
    ("dim_policyholder", "", "date_of_birth registration_date"),
    ("dim_policy", "annual_premium deductible coverage_limit", "effective_date expiration_date"),
    ("dim_coverage", "", ""),
    (
        "fct_claims",
        "annual_premium deductible coverage_limit initial_reserve current_reserve total_indemnity total_expense "
        "total_recovery total_paid incurred_amount net_paid",
        "accident_date report_date close_date first_payment_date last_payment_date",
    ),
    ("fct_claim_payments", "payment_amount cumulative_paid", "payment_date accident_date"),
    ("rpt_claim_frequency", "", ""),
):
    add(_name, lambda d, n=_name: d[n], table(_name, _money, _dates))

# --- triangle ----------------------------------------------------------------------------

_DEVS = " ".join(f"dev_year_{i}" for i in range(6))

add(
    "rpt_loss_triangle",
    lambda d: reports.rpt_loss_triangle(d.development, d.cfg.max_development_year),
    table("rpt_loss_triangle", _DEVS + " latest_cumulative"),
)
add(
    "triangle_long",
    lambda d: reports.triangle_long(d.development),
    table("triangle_long", "incremental_paid cumulative_paid"),
)
relation("development_pairs", """
SELECT a.accident_year, a.development_year AS from_dev, CAST(a.cumulative_paid AS DOUBLE) AS earlier,
       CAST(b.cumulative_paid AS DOUBLE) AS later, a.cumulative_paid AS earlier_money, b.cumulative_paid AS later_money
FROM triangle_long a JOIN triangle_long b
  ON b.accident_year = a.accident_year AND b.development_year = a.development_year + 1
WHERE a.cumulative_paid > 0 AND b.cumulative_paid > 0
""")
add(
    "bi_link_ratios",
    lambda d: reports.bi_link_ratios(reports.triangle_long(d.development)),
    sql("SELECT accident_year, from_dev, from_dev + 1 AS to_dev, round(later / earlier, 4) AS link_ratio "
        "FROM development_pairs"),
)
relation("weighted_factors", """
SELECT from_dev, CAST(sum(later_money) AS DOUBLE) / CAST(sum(earlier_money) AS DOUBLE) AS factor
FROM development_pairs GROUP BY from_dev
""")
add(
    "bi_weighted_factors",
    lambda d: reports.bi_weighted_factors(reports.triangle_long(d.development)),
    sql("SELECT from_dev, round(factor, 4) AS weighted_factor FROM weighted_factors"),
)
relation("chain_ladder", """
SELECT l.accident_year, l.latest_dev, CAST(l.latest_paid AS DOUBLE) AS latest_paid,
       ifnull((SELECT exp(sum(ln(factor))) FROM weighted_factors w WHERE w.from_dev >= l.latest_dev), 1.0) AS remaining
FROM (SELECT accident_year, max(development_year) AS latest_dev, arg_max(cumulative_paid, development_year) AS latest_paid
      FROM triangle_long GROUP BY accident_year) l
""")
add(
    "chain_ladder_ultimate",
    lambda d: _round(
        reports.chain_ladder_ultimate(reports.triangle_long(d.development)), {"factor_to_ultimate": 6, "ultimate": 1}
    ),
    sql("SELECT accident_year, latest_dev, latest_paid, round(remaining, 6) AS factor_to_ultimate, "
        "round(latest_paid * remaining, 1) AS ultimate FROM chain_ladder"),
)
add(
    "ibnr",
    lambda d: _round(
        reports.ibnr(reports.chain_ladder_ultimate(reports.triangle_long(d.development)), d["fct_claims"]),
        {"ultimate": 1, "ibnr": 1},
    ),
    sql("""
SELECT accident_year, round(latest_paid * remaining, 1) AS ultimate, CAST(paid AS DOUBLE) AS paid,
       CAST(reserve AS DOUBLE) AS case_reserve,
       round(latest_paid * remaining - (CAST(paid AS DOUBLE) + CAST(reserve AS DOUBLE)), 1) AS ibnr
FROM chain_ladder JOIN (SELECT accident_year, sum(total_paid) AS paid, sum(current_reserve) AS reserve
                        FROM fct_claims GROUP BY accident_year) USING (accident_year)"""),
)


def _round(df, digits):
    from pyspark.sql import functions as F

    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


def _year_ends(d):
    """The last day of every year with a payment: one row per calendar year."""
    from pyspark.sql import functions as F

    return d["stg_claim_payments"].select(
        F.make_date(F.year("payment_date"), F.lit(12), F.lit(31)).alias("as_of")
    ).distinct()


add(
    "triangle_as_of",
    lambda d: reports.triangle_as_of(d.development, _year_ends(d)),
    sql("""
SELECT CAST(as_of AS VARCHAR) AS as_of, accident_year, """
        + ", ".join(f"CAST(max(so_far) FILTER (development_year = {i}) AS DOUBLE) AS dev_year_{i}" for i in range(6))
        + """
FROM (SELECT as_of, accident_year, development_year,
             sum(paid) OVER (PARTITION BY as_of, accident_year ORDER BY development_year) AS so_far
      FROM (SELECT as_of, accident_year, development_year, sum(payment_amount) AS paid
            FROM fct_claim_payments
            JOIN (SELECT DISTINCT make_date(year(payment_date), 12, 31) AS as_of FROM stg_claim_payments)
              ON payment_date <= as_of
            WHERE development_year >= 0 GROUP BY ALL))
GROUP BY as_of, accident_year"""),
)

# --- summaries and dashboard queries -------------------------------------------------------

add(
    "summary_claims",
    lambda d: bi.summary_claims(d["fct_claims"]),
    sql("""
SELECT count(*) AS total_claims, count(*) FILTER (claim_status = 'open') AS open_claims,
       count(*) FILTER (claim_status = 'closed') AS closed_claims, CAST(sum(total_paid) AS DOUBLE) AS total_paid,
       CAST(sum(incurred_amount) AS DOUBLE) AS total_incurred,
       round(CAST(sum(total_paid) AS DOUBLE) / count(*), 2) AS avg_paid_per_claim
FROM fct_claims"""),
)
add(
    "summary_triangle_preview",
    lambda d: bi.summary_triangle_preview(reports.rpt_loss_triangle(d.development)),
    sql("SELECT accident_year, "
        + ", ".join(f"CAST(round(dev_year_{i}, 0) AS DOUBLE) AS dev_year_{i}" for i in range(6))
        + ", claim_count FROM rpt_loss_triangle"),
)
add(
    "summary_frequency_by_coverage",
    lambda d: bi.summary_frequency_by_coverage(d["fct_claims"], d["int_policy_exposure"]),
    sql("""
SELECT coverage_type, claims, round(years, 1) AS exposure_years, round(claims / nullif(years, 0), 4) AS frequency,
       round(incurred / nullif(years, 0), 2) AS pure_premium
FROM (SELECT coverage_type, CAST(sum(claims) AS DOUBLE) AS claims, CAST(sum(incurred) AS DOUBLE) AS incurred
      FROM losses_by_year GROUP BY coverage_type)
FULL JOIN (SELECT coverage_type, CAST(sum(exposure_days) AS DOUBLE) / 365.25 AS years
           FROM int_policy_exposure GROUP BY coverage_type) USING (coverage_type)"""),
)
add(
    "bi_home_kpis",
    lambda d: bi.bi_home_kpis(d["fct_claims"]),
    sql("""
SELECT count(DISTINCT claim_id) AS total_claims, CAST(sum(total_paid) AS DOUBLE) AS total_paid,
       round(CAST(sum(total_paid) AS DOUBLE) / count(*), 2) AS avg_severity,
       count(DISTINCT policyholder_id) AS unique_policyholders
FROM fct_claims"""),
)
_COVERAGES, _YEARS = ("auto", "home", "life"), (1996, 1999)
relation("portfolio", """
SELECT * FROM rpt_claim_frequency WHERE coverage_type IN ('auto', 'home', 'life') AND year BETWEEN 1996 AND 1999
""")


def _portfolio(d):
    return bi.bi_portfolio_filter(d["rpt_claim_frequency"], _COVERAGES, _YEARS)


add("bi_portfolio_filter", _portfolio, table("portfolio"))
add(
    "bi_portfolio_kpis",
    lambda d: bi.bi_portfolio_kpis(_portfolio(d)),
    sql("""
SELECT year, CAST(sum(claim_count) AS BIGINT) AS total_claims, round(sum(exposure_years), 1) AS total_exposure,
       round(sum(total_paid) / nullif(sum(earned_premium), 0), 4) AS portfolio_loss_ratio,
       round(sum(total_paid) / nullif(sum(claim_count), 0), 2) AS avg_severity
FROM portfolio WHERE year = (SELECT max(year) FROM portfolio) GROUP BY year"""),
)
add(
    "bi_loss_ratio_rank",
    lambda d: bi.bi_loss_ratio_rank(_portfolio(d)),
    sql("SELECT coverage_type, loss_ratio FROM portfolio WHERE year = (SELECT max(year) FROM portfolio) "
        "ORDER BY loss_ratio DESC"),
)
add(
    "bi_geo_options",
    lambda d: bi.bi_geo_options(d["fct_claims"], d["dim_policyholder"]),
    sql("SELECT DISTINCT accident_year, state_code FROM fct_claims JOIN dim_policyholder USING (policyholder_id)"),
)
relation("geo_risk", """
SELECT state_code, count(claim_id) AS claim_count, round(CAST(sum(total_paid) AS DOUBLE) / count(*), 2) AS avg_severity,
       CAST(sum(total_paid) AS DOUBLE) AS total_paid
FROM fct_claims JOIN dim_policyholder USING (policyholder_id)
WHERE accident_year BETWEEN 1996 AND 1999 GROUP BY state_code
""")


def _geo(d, states=()):
    return bi.bi_geo_risk(d["fct_claims"], d["dim_policyholder"], _YEARS, states)


add("bi_geo_risk", _geo, table("geo_risk"))
add(
    "bi_geo_risk_states",
    lambda d: _geo(d, ("NATION_1", "NATION_7", "NATION_20")),
    sql("SELECT * FROM geo_risk WHERE state_code IN ('NATION_1', 'NATION_7', 'NATION_20')"),
)
add(
    "bi_geo_kpis",
    lambda d: bi.bi_geo_kpis(_geo(d)),
    sql("SELECT count(DISTINCT state_code) AS states, CAST(sum(claim_count) AS BIGINT) AS total_claims, "
        "CAST(sum(CAST(total_paid AS DECIMAL(38,2))) AS DOUBLE) AS total_paid FROM geo_risk"),
)
_CODES = {"NATION_0": "CDMX", "NATION_1": "JAL", "NATION_2": "NL"}
add(
    "bi_geo_state_names",
    lambda d: bi.bi_geo_state_names(_recode(_geo(d))),
    sql("""
SELECT g.* REPLACE (ifnull(code, state_code) AS state_code), ifnull(name, state_code) AS state_name
FROM geo_risk g LEFT JOIN (VALUES ('NATION_0', 'CDMX', 'Ciudad de Mexico'), ('NATION_1', 'JAL', 'Jalisco'),
  ('NATION_2', 'NL', 'Nuevo Leon')) s(nation, code, name) ON nation = state_code"""),
)


def _recode(df):
    """Give three of the nations real state codes; the others show that unknown codes are kept."""
    return df.replace(_CODES, subset=["state_code"])


add(
    "bi_geo_top20",
    lambda d: bi.bi_geo_top20(_geo(d)),
    sql("SELECT * FROM geo_risk ORDER BY claim_count DESC, state_code LIMIT 20"),
)

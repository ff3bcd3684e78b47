"""DuckDB SQL for the same results, assembled from named relations.

Every relation below is written from the definition of the table, for DuckDB, and does not
share code with the Spark operators. ``sql(body)`` puts the relations a query needs,
directly or through others, into its WITH clause.
"""

from __future__ import annotations

import re

VALUATION = "DATE '2000-12-31'"
START = "DATE '1995-01-01'"
TRAIN_THROUGH = 1997

RELATIONS: dict[str, str] = {}


def relation(name: str, body: str) -> None:
    RELATIONS[name] = body.strip()


def needed(body: str) -> list[str]:
    """Relations used by body, in an order where each follows what it uses."""
    order: list[str] = []

    def visit(text: str) -> None:
        for word in re.findall(r"[a-z_][a-z0-9_]*", text):
            if word in RELATIONS and word not in order and RELATIONS[word] is not text:
                visit(RELATIONS[word])
                if word not in order:
                    order.append(word)

    visit(body)
    return order


def sql(body: str) -> str:
    names = needed(body)
    if not names:
        return body.strip()
    return "WITH " + ",\n".join(f"{n} AS (\n{RELATIONS[n]}\n)" for n in names) + "\n" + body.strip()


def table(name: str, money: str = "", dates: str = "") -> str:
    """A whole relation, money as DOUBLE and dates as text."""
    changes = [f"CAST({c} AS DOUBLE) AS {c}" for c in money.split()]
    changes += [f"CAST({c} AS VARCHAR) AS {c}" for c in dates.split()]
    replace = f" REPLACE ({', '.join(changes)})" if changes else ""
    return sql(f"SELECT *{replace} FROM {name}")


# --- raw tables -----------------------------------------------------------------------

relation("raw_policies", """
SELECT o_custkey * 10 + digit AS policy_id, o_custkey AS policyholder_id,
       'POL-' || lpad(CAST(o_custkey * 10 + digit AS VARCHAR), 10, '0') AS policy_number,
       [' Auto', 'HOME ', 'liability', 'Health', 'life'][digit] AS coverage_type,
       first_order AS effective_date,
       first_order + CAST(CASE WHEN (o_custkey * 10 + digit) % 97 = 0 THEN 0
                               ELSE 180 + (o_custkey * 10 + digit) % 1500 END AS INTEGER) AS expiration_date,
       CAST(price AS DECIMAL(14,2)) AS annual_premium,
       CAST((o_custkey * 10 + digit) % 20 * 1000 AS DECIMAL(14,2)) AS deductible,
       CAST(200000 + (o_custkey * 10 + digit) % 50 * 100000 AS DECIMAL(16,2)) AS coverage_limit,
       CASE WHEN (o_custkey * 10 + digit) % 13 = 0 THEN 'Cancelled'
            WHEN (o_custkey * 10 + digit) % 3 = 0 THEN ' active ' ELSE 'expired' END AS status
FROM (SELECT o_custkey, CAST(left(o_orderpriority, 1) AS BIGINT) AS digit,
             CAST(min(o_orderdate) AS DATE) AS first_order, max(o_totalprice) AS price
      FROM orders GROUP BY ALL)
""")

relation("raw_claims", """
SELECT o_orderkey AS claim_id,
       o_custkey * 10 + CAST(left(o_orderpriority, 1) AS BIGINT) AS policy_id,
       'CLM-' || o_orderkey AS claim_number,
       CAST(o_orderdate AS DATE) AS accident_date,
       CAST(o_orderdate AS DATE) + CAST(o_orderkey % 120 + again AS INTEGER) AS report_date,
       CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + CAST(150 + o_orderkey % 400 AS INTEGER) END
           AS close_date,
       CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'O' THEN 'open '
            ELSE if(o_orderkey % 2 = 0, 'denied', 'REOPENED') END AS claim_status,
       if(o_orderkey % 25 = 0, NULL, 'Cause_' || (o_orderkey % 6)) AS cause_of_loss,
       CAST(o_totalprice AS DECIMAL(16,2)) AS initial_reserve,
       CAST(if(o_orderstatus = 'F' OR (o_orderstatus = 'P' AND o_orderkey % 2 = 0), 0, o_totalprice)
            AS DECIMAL(16,2)) AS current_reserve
FROM (SELECT *, 0 AS again FROM orders UNION ALL SELECT *, 1 FROM orders WHERE o_orderkey % 100 = 0)
""")

relation("raw_claim_payments", """
SELECT *, CAST(payment_amount * line AS DECIMAL(16,2)) AS cumulative_paid
FROM (SELECT (l_orderkey * 8 + l_linenumber) * 1048576 + (l_partkey * 7919 + l_suppkey * 104729) % 1048576 AS payment_id,
             l_orderkey AS claim_id, CAST(l_shipdate AS DATE) AS payment_date,
             CAST(if(l_returnflag = 'R', -10 * l_quantity, l_extendedprice) AS DECIMAL(16,2)) AS payment_amount,
             CASE l_returnflag WHEN 'N' THEN 'Indemnity' WHEN 'A' THEN 'expense ' ELSE 'recovery' END AS payment_type,
             l_linenumber AS line
      FROM lineitem)
""")

relation("raw_policyholders", """
SELECT c_custkey AS policyholder_id, ' ' || split_part(c_name, '#', 1) AS first_name,
       split_part(c_name, '#', 2) || ' ' AS last_name,
       DATE '1930-01-01' + CAST(c_custkey * 37 % 16000 AS INTEGER) AS date_of_birth,
       if(c_custkey % 2 = 0, 'm', 'F ') AS gender, lower(n_name) AS state_code,
       if(c_custkey % 14 = 0, NULL, 'City ' || (c_custkey % 40)) AS city,
       if(c_custkey % 8 = 0, NULL, c_mktsegment) AS occupation,
       DATE '1994-01-01' + CAST(c_custkey % 700 AS INTEGER) AS registration_date
FROM customer JOIN nation ON c_nationkey = n_nationkey
""")

relation("raw_coverages", """
SELECT ['AUTO', ' home', 'Liability ', 'health'][digit] AS coverage_type,
       CASE digit WHEN 3 THEN ' casualty' WHEN 4 THEN 'HEALTH' ELSE 'Property_Casualty' END AS coverage_category,
       ' Cover no. ' || digit || ' ' AS description
FROM (SELECT DISTINCT CAST(left(o_orderpriority, 1) AS INTEGER) AS digit FROM orders)
WHERE digit < 5
""")

# --- staging --------------------------------------------------------------------------

relation("stg_policyholders", """
SELECT policyholder_id, trim(first_name) AS first_name, trim(last_name) AS last_name, date_of_birth,
       upper(trim(gender)) AS gender, upper(trim(state_code)) AS state_code,
       ifnull(trim(city), 'unknown') AS city, ifnull(lower(trim(occupation)), 'unknown') AS occupation,
       registration_date
FROM raw_policyholders WHERE policyholder_id IS NOT NULL
""")

relation("stg_policies", """
SELECT policy_id, policyholder_id, trim(policy_number) AS policy_number,
       lower(trim(coverage_type)) AS coverage_type, effective_date, expiration_date,
       annual_premium, deductible, coverage_limit, lower(trim(status)) AS status,
       date_diff('day', effective_date, expiration_date) AS policy_term_days
FROM raw_policies WHERE policy_id IS NOT NULL AND expiration_date > effective_date
""")

relation("stg_claims", """
SELECT claim_id, policy_id, trim(claim_number) AS claim_number, accident_date, report_date, close_date,
       lower(trim(claim_status)) AS claim_status, ifnull(lower(trim(cause_of_loss)), 'not_specified') AS cause_of_loss,
       initial_reserve, current_reserve,
       date_diff('day', accident_date, report_date) AS report_delay_days,
       year(accident_date) AS accident_year, quarter(accident_date) AS accident_quarter
FROM raw_claims WHERE claim_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY claim_id ORDER BY report_date NULLS LAST, policy_id) = 1
""")

relation("stg_claim_payments", """
SELECT payment_id, claim_id, payment_date, payment_amount, lower(trim(payment_type)) AS payment_type, cumulative_paid
FROM raw_claim_payments WHERE payment_id IS NOT NULL
""")

relation("stg_coverages", """
SELECT lower(trim(coverage_type)) AS coverage_type, lower(trim(coverage_category)) AS coverage_category,
       trim(description) AS description
FROM raw_coverages
""")

# --- intermediate ---------------------------------------------------------------------

relation("int_claims_enriched", f"""
SELECT s.*, p.policyholder_id, p.policy_number, p.coverage_type,
       p.effective_date AS policy_effective_date, p.expiration_date AS policy_expiration_date,
       p.annual_premium, p.deductible, p.coverage_limit, p.status AS policy_status,
       v.coverage_category, v.description AS coverage_description,
       date_diff('month', s.accident_date, {VALUATION}) AS development_months_at_valuation,
       ifnull(s.initial_reserve > 200000, FALSE) AS is_large_loss
FROM stg_claims s JOIN stg_policies p USING (policy_id) LEFT JOIN stg_coverages v USING (coverage_type)
""")

relation("int_claim_payments_cumulative", """
SELECT y.payment_id, y.claim_id, y.payment_date, y.payment_amount, y.payment_type,
       s.accident_date, s.accident_year, p.coverage_type, s.claim_status,
       date_diff('year', s.accident_date, y.payment_date) AS development_year,
       date_diff('month', s.accident_date, y.payment_date) AS development_months,
       sum(y.payment_amount) OVER in_order AS cumulative_paid,
       row_number() OVER in_order AS payment_rank
FROM stg_claim_payments y JOIN stg_claims s USING (claim_id) JOIN stg_policies p USING (policy_id)
WINDOW in_order AS (PARTITION BY y.claim_id ORDER BY y.payment_date, y.payment_id, y.payment_amount
                    ROWS UNBOUNDED PRECEDING)
""")

relation("exposure_clipped", f"""
SELECT *, greatest(effective_date, {START}) AS exposure_start, least(expiration_date, {VALUATION}) AS exposure_end
FROM stg_policies WHERE status <> 'cancelled'
""")

relation("int_policy_exposure", """
SELECT policy_id, policyholder_id, policy_number, coverage_type, effective_date, expiration_date,
       annual_premium, status, exposure_start, exposure_end, days AS exposure_days,
       CAST(days AS DOUBLE) / 365.25 AS exposure_years, CAST(cents AS DOUBLE) / 100 AS earned_premium,
       year(exposure_start) AS exposure_year
FROM (SELECT *, exposure_end - exposure_start AS days,
             (2 * CAST(annual_premium * 100 AS BIGINT) * (exposure_end - exposure_start) + policy_term_days)
             // (2 * policy_term_days) AS cents
      FROM exposure_clipped WHERE exposure_end > exposure_start)
""")

# --- marts ----------------------------------------------------------------------------

relation("calendar_days", """
SELECT least(make_date(min(year(d)), 1, 1), DATE '1990-01-01') AS first_day, greatest(make_date(max(year(d)), 12, 31), DATE '2000-12-31') AS last_day
FROM (SELECT accident_date AS d FROM stg_claims UNION ALL SELECT payment_date FROM stg_claim_payments)
""")

relation("dim_date", """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date, year(d) AS year, quarter(d) AS quarter,
       month(d) AS month, day(d) AS day, dayofweek(d) AS day_of_week, dayname(d) AS day_name,
       monthname(d) AS month_name, weekofyear(d) AS iso_week, dayofweek(d) IN (0, 6) AS is_weekend,
       d = last_day(d) AS is_month_end, d = last_day(d) AND month(d) IN (3, 6, 9, 12) AS is_quarter_end,
       strftime(d, '%m-%d') = '12-31' AS is_year_end, year(d) AS fiscal_year, quarter(d) AS fiscal_quarter,
       concat(year(d), '-Q', quarter(d)) AS year_quarter_label
FROM (SELECT CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE) AS d FROM calendar_days)
""")

relation("dim_policyholder", f"""
SELECT policyholder_id, first_name, last_name, concat_ws(' ', first_name, last_name) AS full_name, date_of_birth,
       date_sub('year', date_of_birth, registration_date) AS age_at_registration,
       date_sub('year', date_of_birth, {VALUATION}) AS current_age,
       gender, state_code, city, occupation, registration_date
FROM stg_policyholders
""")

relation("dim_policy", f"""
SELECT p.policy_id, p.policyholder_id, p.policy_number, p.coverage_type, v.coverage_category,
       v.description AS coverage_description, p.effective_date, p.expiration_date, p.policy_term_days,
       p.annual_premium, p.deductible, p.coverage_limit, p.status, year(p.effective_date) AS policy_year,
       ifnull(p.status = 'active' AND {VALUATION} >= p.effective_date AND {VALUATION} < p.expiration_date, FALSE)
           AS is_currently_active
FROM stg_policies p LEFT JOIN stg_coverages v USING (coverage_type)
""")

relation("dim_coverage", """
SELECT rank() OVER (ORDER BY coverage_type) AS coverage_key, * FROM stg_coverages
""")

relation("payments_by_claim", """
SELECT claim_id, sum(payment_amount) FILTER (payment_type = 'indemnity') AS indemnity,
       sum(payment_amount) FILTER (payment_type = 'expense') AS expense,
       sum(payment_amount) FILTER (payment_type = 'recovery') AS recovery,
       sum(payment_amount) AS paid, count(*) AS n, min(payment_date) AS first_day, max(payment_date) AS last_day
FROM stg_claim_payments GROUP BY claim_id
""")

relation("fct_claims", """
SELECT e.claim_id, e.policy_id, e.policyholder_id, e.claim_number,
       CAST(strftime(e.accident_date, '%Y%m%d') AS INTEGER) AS accident_date_key,
       CAST(strftime(e.report_date, '%Y%m%d') AS INTEGER) AS report_date_key,
       e.accident_date, e.report_date, e.close_date, e.claim_status, e.cause_of_loss, e.coverage_type,
       e.coverage_category, e.accident_year, e.accident_quarter, e.report_delay_days,
       e.development_months_at_valuation, e.is_large_loss, e.annual_premium, e.deductible, e.coverage_limit,
       e.initial_reserve, e.current_reserve, ifnull(b.indemnity, 0) AS total_indemnity,
       ifnull(b.expense, 0) AS total_expense, ifnull(b.recovery, 0) AS total_recovery,
       ifnull(b.paid, 0) AS total_paid, ifnull(b.n, 0) AS payment_count, b.first_day AS first_payment_date,
       b.last_day AS last_payment_date, ifnull(b.paid, 0) + e.current_reserve AS incurred_amount,
       ifnull(b.paid, 0) AS net_paid
FROM int_claims_enriched e LEFT JOIN payments_by_claim b USING (claim_id)
""")

relation("fct_claim_payments", """
SELECT payment_id, claim_id, CAST(strftime(payment_date, '%Y%m%d') AS INTEGER) AS payment_date_key,
       CAST(strftime(accident_date, '%Y%m%d') AS INTEGER) AS accident_date_key, payment_date, accident_date,
       development_year, development_months, accident_year, payment_amount, payment_type, cumulative_paid,
       payment_rank, coverage_type, claim_status
FROM int_claim_payments_cumulative
""")

# --- reports --------------------------------------------------------------------------

relation("triangle_long", """
SELECT accident_year, development_year, paid AS incremental_paid,
       sum(paid) OVER (PARTITION BY accident_year ORDER BY development_year) AS cumulative_paid
FROM (SELECT accident_year, development_year, sum(payment_amount) AS paid
      FROM fct_claim_payments WHERE development_year >= 0 GROUP BY ALL)
""")

relation("rpt_loss_triangle", """
SELECT t.*, c.claim_count
FROM (SELECT accident_year,
             max(cumulative_paid) FILTER (development_year = 0) AS dev_year_0,
             max(cumulative_paid) FILTER (development_year = 1) AS dev_year_1,
             max(cumulative_paid) FILTER (development_year = 2) AS dev_year_2,
             max(cumulative_paid) FILTER (development_year = 3) AS dev_year_3,
             max(cumulative_paid) FILTER (development_year = 4) AS dev_year_4,
             max(cumulative_paid) FILTER (development_year = 5) AS dev_year_5,
             max(cumulative_paid) AS latest_cumulative
      FROM triangle_long GROUP BY accident_year) t
JOIN (SELECT accident_year, count(DISTINCT claim_id) AS claim_count
      FROM fct_claim_payments GROUP BY accident_year) c USING (accident_year)
""")

relation("losses_by_year", """
SELECT accident_year AS year, coverage_type, count(*) AS claims, sum(total_paid) AS paid,
       sum(incurred_amount) AS incurred
FROM fct_claims GROUP BY ALL
""")

relation("exposure_by_year", """
SELECT exposure_year AS year, coverage_type, count(*) AS policies,
       CAST(sum(exposure_days) AS DOUBLE) / 365.25 AS years, sum(CAST(round(earned_premium * 100) AS BIGINT)) AS cents
FROM int_policy_exposure GROUP BY ALL
""")

relation("rpt_claim_frequency", """
SELECT year, coverage_type, ifnull(policies, 0) AS policy_count, ifnull(years, 0) AS exposure_years,
       CAST(ifnull(cents, 0) AS DOUBLE) / 100 AS earned_premium, ifnull(claims, 0) AS claim_count,
       CAST(ifnull(paid, 0) AS DOUBLE) AS total_paid,
       ifnull(CAST(paid AS DOUBLE) / CAST(claims AS DOUBLE), 0) AS avg_severity,
       CAST(ifnull(incurred, 0) AS DOUBLE) AS total_incurred,
       if(years > 0, round(ifnull(claims, 0) / years, 4), NULL) AS claim_frequency,
       if(years > 0, round(CAST(ifnull(incurred, 0) AS DOUBLE) / years, 2), NULL) AS pure_premium,
       if(cents > 0, round(CAST(ifnull(incurred, 0) AS DOUBLE) / (CAST(cents AS DOUBLE) / 100), 4), NULL) AS loss_ratio
FROM losses_by_year FULL JOIN exposure_by_year USING (year, coverage_type)
""")

"""Source, sink and table pattern queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from lossline.functions.columns import digest_key, surrogate_key
from lossline.operators import patterns as p
from lossline.operators.reports import rpt_loss_triangle
from lossline.plans.catalog import add
from lossline.plans.oracle import relation, sql, table
from lossline.session import materialise, shuffles_dropped
from lossline.sources import files, sinks
from lossline.sources.schemas import RAW_SCHEMAS
from lossline.streaming.sinks import append_batches

_RAW_MONEY = {
    "policies": ("annual_premium deductible coverage_limit", "effective_date expiration_date"),
    "claims": ("initial_reserve current_reserve", "accident_date report_date close_date"),
}

# --- sources -------------------------------------------------------------------------------------


def _raw_folder(d, fmt):
    """The raw tables written the way a source system delivers them."""
    folder = d.scratch(f"raw-{fmt}")
    for name in RAW_SCHEMAS:
        writer = d[f"raw_{name}"].write
        if fmt == "csv":
            writer.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
                "ignoreTrailingWhiteSpace", False
            ).csv(f"{folder}/{name}.csv")
        else:
            writer.parquet(f"{folder}/{name}.parquet")
    return folder


add(
    "src_csv",
    lambda d: files.load_raw_tables(d.spark, _raw_folder(d, "csv"), "csv")["raw_claims"],
    table("raw_claims", *_RAW_MONEY["claims"]),
)
add(
    "src_parquet",
    lambda d: files.load_raw_tables(d.spark, _raw_folder(d, "parquet"), "parquet")["raw_policies"],
    table("raw_policies", *_RAW_MONEY["policies"]),
)


def _all_raw(d, fmt):
    """Rows and filled cells of every column of all five tables, read back."""
    found = None
    for name, rows in files.load_raw_tables(d.spark, _raw_folder(d, fmt), fmt).items():
        filled = rows.agg(F.count("*").alias("row_count"), *[F.count(c).alias(c) for c in rows.columns])
        cells = filled.unpivot(["row_count"], rows.columns, "column_name", "filled").withColumn("table_name", F.lit(name))
        found = cells if found is None else found.unionByName(cells)
    return found.select("table_name", "column_name", "row_count", "filled")


_ALL_RAW = sql("\nUNION ALL\n".join(
    f"SELECT 'raw_{t}' AS table_name, '{c}' AS column_name, count(*) AS row_count, count({c}) AS filled FROM raw_{t}"
    for t, schema in RAW_SCHEMAS.items() for c in (field.split()[0] for field in schema.split(", "))))
add("src_csv_tables", lambda d: _all_raw(d, "csv"), _ALL_RAW)
add("src_parquet_tables", lambda d: _all_raw(d, "parquet"), _ALL_RAW)


def _globbed(d):
    folder = _raw_folder(d, "parquet")
    rows = files.read_glob(d.spark, f"{folder}/claim_pay*", RAW_SCHEMAS["claim_payments"], "parquet")
    return rows.groupBy("payment_type", F.col("source_file").contains("claim_payments.parquet").alias("from_payments")).agg(
        F.count("*").alias("n"), F.sum("payment_amount").alias("amount")
    )


add(
    "src_glob",
    _globbed,
    sql("SELECT payment_type, TRUE AS from_payments, count(*) AS n, CAST(sum(payment_amount) AS DOUBLE) AS amount "
        "FROM raw_claim_payments GROUP BY payment_type"),
)


def _mixed(d):
    """Payments in csv and parquet files below one folder, read together."""
    folder, rows = d.scratch("mixed"), d["raw_claim_payments"].select("payment_id", "payment_type", "payment_amount")
    rows.filter("payment_id % 3 = 0").write.option("header", True).option("ignoreTrailingWhiteSpace", False).csv(f"{folder}/exports")
    rows.filter("payment_id % 3 <> 0").write.parquet(f"{folder}/tables")
    read = files.read_folder(d.spark, folder, "payment_id BIGINT, payment_type STRING, payment_amount DECIMAL(16,2)")
    return read.groupBy("payment_type", "format").agg(F.count("*").alias("n"), F.sum("payment_amount").alias("amount"))


add(
    "src_glob_mixed",
    _mixed,
    sql("SELECT payment_type, if(payment_id % 3 = 0, 'csv', 'parquet') AS format, count(*) AS n, CAST(sum(payment_amount) AS DOUBLE) AS amount "
        "FROM raw_claim_payments GROUP BY ALL"),
)


def _watched(d):
    """A folder watched twice: the second look must hand over only the file that came between."""
    folder, out, seen = d.scratch("inbox"), d.scratch("received"), d.scratch("seen")
    names = ["claim_id", "claim_number"]
    schema = "claim_id BIGINT, claim_number STRING"
    claims = d["raw_claims"].select(*names)
    for part, mode in ((0, "overwrite"), (1, "append")):
        claims.filter(F.col("claim_id") % 2 == part).write.mode(mode).option("header", True).csv(folder)
        files.new_files(d.spark, folder, schema, seen, append_batches(out))
    received = d.spark.read.option("basePath", out).parquet(out)
    return received.select(*names, "batch_id")


add(
    "src_new_files",
    _watched,
    sql("SELECT claim_id, claim_number, CAST(claim_id % 2 AS INTEGER) AS batch_id FROM raw_claims"),
)

# --- sinks -----------------------------------------------------------------------------------------

add(
    "snk_full_refresh",
    lambda d: _twice(d, d["stg_policies"]),
    table("stg_policies", *_RAW_MONEY["policies"]),
)


def _twice(d, df):
    path = d.scratch("refresh")
    sinks.full_refresh(df, path)
    return sinks.full_refresh(df, path)


def _exported(d):
    """All exports of the warehouse; returns the rows of each. What several of them read is written once before.

    Shuffle files go with the table they were for, and what still shuffles is exported first: the disk never holds more
    than the tables and one shuffle.
    """
    with shuffles_dropped(d.spark):
        for shared in ("stg_coverages", "stg_policies", "stg_claims", "fct_claims", "int_claim_payments_cumulative"):
            d.models.keep(shared, compression="zstd")
        wanted = {n: d[n] for n in reversed(sinks.WAREHOUSE_EXPORTS)}
        # Dealt out by claim, payments are shuffled once for the sums by claim and the window over claims.
        wanted["rpt_loss_triangle"] = rpt_loss_triangle(d["fct_claim_payments"].repartition("claim_id"))
        paths = sinks.export_csv(wanted, d.scratch("export"))
    counted = [
        d.spark.read.option("header", True).csv(paths[n]).agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
        for n in sinks.WAREHOUSE_EXPORTS
    ]
    result = counted[0]
    for c in counted[1:]:
        result = result.unionByName(c)
    return result


add(
    "snk_csv_export",
    _exported,
    sql("\nUNION ALL\n".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in sinks.WAREHOUSE_EXPORTS)),
)
add(
    "snk_parquet",
    lambda d: sinks.full_refresh(d["raw_claims"], d.scratch("typed")),
    table("raw_claims", *_RAW_MONEY["claims"]),
)


def _partitioned(d):
    """All laid-out tables, written by year and read back; a table is built from those already written."""
    found = None
    for name, (day, cluster) in sinks.LAYOUT.items():
        rows = sinks.write_partitioned(d[name], d.scratch(f"by-year-{name}"), day, cluster)
        d.models[name] = rows.drop(f"{day}_year")
        years = rows.groupBy(F.col(f"{day}_year").alias("year")).agg(F.count("*").alias("n"), F.countDistinct("claim_id").alias("claims"))
        years = years.select(F.lit(name).alias("table_name"), "year", "n", "claims")
        found = years if found is None else found.unionByName(years)
    return found


add(
    "snk_partitioned",
    _partitioned,
    sql("\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, year({day}) AS year, count(*) AS n, count(DISTINCT claim_id) AS claims FROM {t} GROUP BY year({day})"
        for t, (day, _) in sinks.LAYOUT.items())),
)


def _compacted(d):
    source, target = d.scratch("small-files"), d.scratch("compacted")
    d["stg_claim_payments"].repartition(40).write.parquet(source)
    sinks.compact(d.spark, source, target)
    rows = d.spark.read.parquet(target)
    return rows.groupBy("payment_type").agg(
        F.count("*").alias("n"),
        F.sum("payment_amount").alias("amount"),
        F.countDistinct("_metadata.file_path").alias("files"),
    )


add(
    "snk_compact",
    _compacted,
    sql("SELECT payment_type, count(*) AS n, CAST(sum(payment_amount) AS DOUBLE) AS amount, 1 AS files "
        "FROM stg_claim_payments GROUP BY 1"),
)


def _packed(d):
    """Partitions of many small files and one large file each, packed where they lie."""
    path, rows = d.scratch("packed"), d["stg_claim_payments"].withColumn("year", F.year("payment_date"))
    rows.repartition(12).write.partitionBy("year").parquet(path)
    before = d.spark.read.parquet(path).select(F.col("_metadata.file_path").alias("f")).distinct()
    before = materialise(before, "files-before")
    sinks.compact_small_files(d.spark, path)
    read = d.spark.read.parquet(path)
    kept = read.select("*", F.col("_metadata.file_path").alias("f")).join(before.withColumn("old", F.lit(1)), "f", "left")
    return kept.groupBy("year").agg(
        F.count("*").alias("n"), F.sum("payment_amount").alias("amount"), F.countDistinct("f").alias("files"), F.count("old").alias("rows_in_old_files")
    )


add(
    # A year with one file alone keeps it, with all its rows; the others get one file.
    "snk_compact_partitions",
    lambda d: _packed(d).select("year", "n", "amount", "files", ((F.col("rows_in_old_files") == 0) | (F.col("rows_in_old_files") == F.col("n"))).alias("whole")),
    sql("SELECT CAST(year(payment_date) AS INTEGER) AS year, count(*) AS n, CAST(sum(payment_amount) AS DOUBLE) AS amount, 1 AS files, TRUE AS whole "
        "FROM stg_claim_payments GROUP BY 1"),
)


def _policy_updates(d):
    """Updates: every fifth policy ends, and ids above all known ones are new."""
    policies = d["stg_policies"].select("policy_id", "status", "annual_premium")
    ended = policies.filter("policy_id % 5 = 0").withColumn("status", F.lit("expired"))
    added = policies.filter("policy_id % 50 = 1").withColumn("policy_id", F.col("policy_id") + 1_000_000_000)
    return policies, ended.unionByName(added)


add(
    "snk_merge_upsert",
    lambda d: p.merge_upsert(*_policy_updates(d), "policy_id"),
    sql("""
SELECT policy_id, if(policy_id % 5 = 0, 'expired', status) AS status, CAST(annual_premium AS DOUBLE) AS annual_premium
FROM stg_policies
UNION ALL SELECT policy_id + 1000000000, status, CAST(annual_premium AS DOUBLE) FROM stg_policies WHERE policy_id % 50 = 1"""),
)


def _upserted(d):
    """Updates of the policies that end after 1998, by year of their start; some move to another year, some are new."""
    path, policies = d.scratch("upsert"), d["stg_policies"].select("policy_id", "status", F.year("effective_date").alias("year"))
    policies.write.partitionBy("year").parquet(path)
    before = materialise(d.spark.read.parquet(path).select("year", F.col("_metadata.file_path").alias("f")).distinct(), "files-before")
    some = policies.filter("year >= 1997")
    moved = some.filter("policy_id % 5 = 0").withColumn("status", F.lit("moved")).withColumn("year", F.col("year") + 1)
    added = some.filter("policy_id % 50 = 1").withColumn("policy_id", F.col("policy_id") + 1_000_000_000)
    sinks.upsert_partitions(moved.unionByName(added), path, "policy_id", "year")
    after = d.spark.read.parquet(path)
    same = after.select("*", F.col("_metadata.file_path").alias("f")).join(before.select("f", F.lit(1).alias("old")), "f", "left")
    return same.select("policy_id", "status", "year", F.col("old").isNotNull().alias("file_kept"))


add(
    "snk_upsert_partitions",
    _upserted,
    sql("""
SELECT policy_id, status, year, year < 1997 AS file_kept FROM (
  SELECT policy_id, if(year(effective_date) >= 1997 AND policy_id % 5 = 0, 'moved', status) AS status,
         CAST(year(effective_date) + if(year(effective_date) >= 1997 AND policy_id % 5 = 0, 1, 0) AS INTEGER) AS year FROM stg_policies
  UNION ALL SELECT policy_id + 1000000000, status, CAST(year(effective_date) AS INTEGER) FROM stg_policies
  WHERE year(effective_date) >= 1997 AND policy_id % 50 = 1)"""),
)


def _backfilled(d):
    """Load all years, then replay the later ones with doubled amounts, twice."""
    path = d.scratch("backfill")
    rows = d["stg_claim_payments"].select("payment_id", "payment_amount", F.year("payment_date").alias("year"))
    sinks.backfill_partitions(rows, path, "year")
    replay = rows.filter("year >= 1999").withColumn("payment_amount", (F.col("payment_amount") * 2).cast("decimal(16,2)"))
    for _ in range(2):
        sinks.backfill_partitions(replay, path, "year")
    return d.spark.read.parquet(path).groupBy("year").agg(F.count("*").alias("n"), F.sum("payment_amount").alias("amount"))


add(
    "snk_backfill_partition",
    _backfilled,
    sql("SELECT year(payment_date) AS year, count(*) AS n, CAST(sum(payment_amount * if(year(payment_date) >= 1999, 2, 1)) "
        "AS DOUBLE) AS amount FROM stg_claim_payments GROUP BY 1"),
)


def _incremental(d):
    """First load up to a day, then only what is newer, merged by key."""
    columns = ["payment_id", "payment_date", "payment_amount"]
    rows = p.latest_record(d["stg_claim_payments"].select(*columns), ["payment_id"], ["payment_date", "payment_amount"])
    loaded = sinks.full_refresh(rows.filter(F.col("payment_date") <= F.lit(date(1998, 6, 30))), d.scratch("loaded"))
    return p.merge_upsert(loaded, p.newer_than(rows, loaded, "payment_date"), "payment_id")


add(
    "snk_incremental",
    _incremental,
    sql("SELECT payment_id, CAST(payment_date AS VARCHAR) AS payment_date, CAST(payment_amount AS DOUBLE) AS payment_amount "
        "FROM stg_claim_payments "
        "QUALIFY row_number() OVER (PARTITION BY payment_id ORDER BY payment_date DESC, payment_amount DESC) = 1"),
)

# --- patterns -----------------------------------------------------------------------------------------

add(
    "pat_running_total",
    lambda d: p.running_total(d["int_claim_payments_cumulative"], ["claim_id"], "development_months", "payment_amount"),
    sql("""
SELECT claim_id, development_months, CAST(total AS DOUBLE) AS total,
       CAST(sum(total) OVER (PARTITION BY claim_id ORDER BY development_months) AS DOUBLE) AS running_total
FROM (SELECT claim_id, development_months, sum(payment_amount) AS total FROM fct_claim_payments GROUP BY ALL)"""),
)
add(
    "pat_latest_record",
    lambda d: p.latest_record(
        d["stg_claims"].select("policy_id", "report_date", "claim_id", "claim_status"), ["policy_id"], ["report_date", "claim_id"]
    ),
    sql("SELECT policy_id, CAST(report_date AS VARCHAR) AS report_date, claim_id, claim_status FROM stg_claims "
        "QUALIFY row_number() OVER (PARTITION BY policy_id ORDER BY report_date DESC, claim_id DESC) = 1"),
)
relation("monthly_losses", """
SELECT CAST(date_trunc('month', accident_date) AS DATE) AS month, sum(incurred_amount) AS amount, count(*) AS n
FROM fct_claims GROUP BY 1
""")
add(
    "pat_lag_change",
    lambda d: p.lag_change(p.by_month(d["fct_claims"], "accident_date", "incurred_amount"), "month", "amount"),
    sql("SELECT CAST(month AS VARCHAR) AS month, CAST(amount AS DOUBLE) AS amount, n, CAST(lag(amount) OVER (ORDER BY month) "
        "AS DOUBLE) AS previous, CAST(amount - lag(amount) OVER (ORDER BY month) AS DOUBLE) AS change FROM monthly_losses"),
)
add(
    "pat_moving_average",
    lambda d: p.moving_average(p.by_month(d["fct_claims"], "accident_date", "incurred_amount"), "month", "n"),
    sql("""
SELECT CAST(month AS VARCHAR) AS month, CAST(amount AS DOUBLE) AS amount, n,
       CAST(sum(n) OVER w AS DOUBLE) / count(n) OVER w AS moving_average
FROM monthly_losses WINDOW w AS (ORDER BY month ROWS 2 PRECEDING)"""),
)
add(
    "pat_pivot",
    lambda d: p.pivot_sum(d.development, "accident_year", "development_year", range(6), "payment_amount", "dev_"),
    sql("SELECT accident_year, " + ", ".join(
        f"CAST(sum(if(development_year = {i}, payment_amount, 0)) AS DOUBLE) AS dev_{i}" for i in range(6))
        + ", CAST(sum(if(development_year BETWEEN 0 AND 5, 0, payment_amount)) AS DOUBLE) AS dev_other"
        + " FROM fct_claim_payments GROUP BY accident_year"),
)
_METRICS = ["total_paid", "current_reserve", "incurred_amount"]


def _wide(d):
    return d["fct_claims"].select("claim_id", *[F.col(c).cast("decimal(28,2)").alias(c) for c in _METRICS])


add(
    "pat_unpivot",
    lambda d: p.unpivot(_wide(d), ["claim_id"], _METRICS),
    sql("SELECT claim_id, unnest(['total_paid', 'current_reserve', 'incurred_amount']) AS metric_name, "
        "unnest([CAST(total_paid AS DOUBLE), CAST(current_reserve AS DOUBLE), CAST(incurred_amount AS DOUBLE)]) AS metric_value "
        "FROM fct_claims"),
)
add(
    "pat_anti_join",
    lambda d: p.anti_join(d["stg_claims"].select("claim_id", "policy_id"), d["stg_claim_payments"], "claim_id"),
    sql("SELECT claim_id, policy_id FROM stg_claims ANTI JOIN stg_claim_payments USING (claim_id)"),
)
add(
    "pat_date_spine_fill",
    lambda d: p.date_spine_fill(d["stg_claims"], "accident_date"),
    sql("SELECT CAST(day AS VARCHAR) AS day, n FROM claims_per_day"),
)
add(
    "pat_surrogate_key",
    lambda d: d["stg_policies"].select(
        "policy_id",
        digest_key("policyholder_id", "coverage_type").alias("key"),
        (surrogate_key("policyholder_id") == surrogate_key("policy_id")).alias("collides"),
    ),
    sql("SELECT policy_id, md5(concat_ws('|', policyholder_id, ifnull(coverage_type, ''))) AS key, FALSE AS collides "
        "FROM stg_policies"),
)
add(
    "pat_mask_pii",
    lambda d: p.mask_pii(
        d["dim_policyholder"].select("policyholder_id", "full_name", "last_name", "date_of_birth", "state_code"),
        hashed=["full_name"], nulled=["date_of_birth"], partial=["last_name"], salt="s1",
    ),
    sql("""
SELECT policyholder_id, sha256('s1' || full_name) AS full_name,
       if(length(last_name) > 2, repeat('*', length(last_name) - 2) || right(last_name, 2), repeat('*', length(last_name)))
         AS last_name, CAST(NULL AS VARCHAR) AS date_of_birth, state_code
FROM dim_policyholder"""),
)


def _entitled(d):
    """Each analyst sees the nations of one region; ages and states of the rest are coarsened."""
    nation = d.source("nation")
    rights = nation.select(
        F.concat(F.lit("analyst_"), F.col("n_regionkey").cast("string")).alias("user_name"), F.col("n_name").alias("region")
    )
    areas = nation.select(F.col("n_name").alias("region"), F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("area"))
    holders = d["dim_policyholder"].select("policyholder_id", "state_code", "current_age")
    return p.generalise(p.row_policy(holders, rights, "analyst_2", "state_code"), "current_age", "state_code", areas)


add(
    "pat_row_policy",
    _entitled,
    sql("SELECT policyholder_id, current_age // 10 * 10 AS current_age, 'R' || n_regionkey AS area "
        "FROM dim_policyholder JOIN nation ON n_name = state_code WHERE n_regionkey = 2"),
)

relation("status_changes", """
SELECT policy_id, accident_date AS valid_from, claim_status AS status FROM stg_claims
QUALIFY row_number() OVER (PARTITION BY policy_id, accident_date ORDER BY claim_status DESC) = 1
""")
relation("status_history", """
SELECT *, lead(valid_from) OVER (PARTITION BY policy_id ORDER BY valid_from) AS valid_to
FROM (SELECT * FROM status_changes
      QUALIFY status IS DISTINCT FROM lag(status) OVER (PARTITION BY policy_id ORDER BY valid_from))
""")


def _history(d):
    """The status history of each policy: the status of its latest claim."""
    changes = d["stg_claims"].select("policy_id", F.col("accident_date").alias("valid_from"), F.col("claim_status").alias("status"))
    return p.scd2_from_changes(changes, ["policy_id"], "valid_from")


_SCD = "SELECT policy_id, CAST(valid_from AS VARCHAR) AS valid_from, status, CAST(valid_to AS VARCHAR) AS valid_to, valid_to IS NULL AS is_current FROM status_history"
add("pat_scd2", _history, sql(_SCD))


def _loaded_history(d):
    """A snapshot at a day loaded into a history that starts at another."""
    values = d["stg_policies"].select("policy_id", "status", "coverage_type")
    opened = F.lit(date(1995, 1, 1))
    history = values.filter("policy_id % 9 <> 0").select(
        "*", opened.alias("valid_from"), F.lit(None).cast("date").alias("valid_to"), F.lit(True).alias("is_current")
    )
    snapshot = values.filter("policy_id % 8 <> 0").withColumn(
        "status", F.when(F.col("policy_id") % 7 == 0, F.lit("lapsed")).otherwise(F.col("status"))
    )
    return p.scd2_apply(history, snapshot, "policy_id", F.lit(date(2000, 1, 1)))


add(
    "pat_scd2_load",
    _loaded_history,
    sql("""
SELECT policy_id, status, coverage_type, '1995-01-01' AS valid_from,
       if(policy_id % 8 = 0 OR policy_id % 7 = 0, '2000-01-01', NULL) AS valid_to,
       NOT (policy_id % 8 = 0 OR policy_id % 7 = 0) AS is_current
FROM stg_policies WHERE policy_id % 9 <> 0
UNION ALL
SELECT policy_id, if(policy_id % 7 = 0, 'lapsed', status), coverage_type, '2000-01-01', NULL, TRUE
FROM stg_policies WHERE policy_id % 8 <> 0 AND (policy_id % 7 = 0 OR policy_id % 9 = 0)"""),
)
add(
    "pat_scd2_lookup",
    lambda d: p.scd2_lookup(
        d["stg_claims"].select("claim_id", "policy_id", "report_date"), _history(d), "policy_id", "report_date"
    ).select("claim_id", "policy_id", "report_date", "status"),
    sql("""
SELECT claim_id, c.policy_id, CAST(report_date AS VARCHAR) AS report_date, h.status
FROM stg_claims c ASOF LEFT JOIN status_history h ON c.policy_id = h.policy_id AND c.report_date >= h.valid_from"""),
)


def _served(d):
    """Batch totals up to a day, stream totals from that day on."""
    daily = d["stg_claims"].groupBy(F.col("accident_date").alias("day")).agg(F.count("*").alias("n"))
    batch = daily.filter(F.col("day") < F.lit(date(1999, 1, 1))).withColumn("layer", F.lit("batch"))
    return p.lambda_merge(batch, daily.withColumn("layer", F.lit("speed")), F.lit(date(1998, 7, 1)), "day")


add(
    "pat_lambda_merge",
    _served,
    sql("SELECT CAST(accident_date AS VARCHAR) AS day, count(*) AS n, "
        "if(accident_date < DATE '1998-07-01', 'batch', 'speed') AS layer FROM stg_claims GROUP BY accident_date"),
)

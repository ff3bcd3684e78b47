"""Data quality and observability. A check is a frame of violating rows: empty means passed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from lossline.functions.columns import mean_of, ratio
from lossline.functions.quantiles import exact_medians
from lossline.session import materialise

# Declared keys and mandatory columns of the tables.
UNIQUE_KEYS = {
    "stg_policyholders": ["policyholder_id"],
    "stg_policies": ["policy_id"],
    "stg_claims": ["claim_id"],
    "stg_claim_payments": ["payment_id"],
    "dim_policyholder": ["policyholder_id"],
    "dim_policy": ["policy_id"],
    "fct_claims": ["claim_id"],
    "fct_claim_payments": ["payment_id"],
}
NON_NULL = {
    "stg_policyholders": ["policyholder_id", "first_name", "last_name", "state_code"],
    "stg_policies": ["policy_id", "policyholder_id", "coverage_type", "effective_date"],
    "stg_claims": ["claim_id", "policy_id", "accident_date", "report_date"],
    "stg_claim_payments": ["payment_id", "claim_id", "payment_date", "payment_amount"],
    "fct_claims": ["claim_id", "policy_id", "accident_date"],
}
CLAIM_STATUSES = ("open", "closed", "reopened", "denied")
LOWEST_INCURRED = -10_000
STALE_HOURS, WARNING_HOURS = 24, 12


def _all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def dq_claims_rules(claims: DataFrame) -> DataFrame:
    """Every rule a claim breaks, one row each, in one pass over the claims."""
    settled = F.col("claim_status").isin("closed", "denied")
    broken = F.array_compact(
        F.array(
            F.when(F.col("report_date") < F.col("accident_date"), F.lit("report_before_accident")),
            F.when(settled & (F.col("current_reserve") != 0), F.lit("closed_with_reserve")),
            F.when(F.col("incurred_amount") < LOWEST_INCURRED, F.lit("negative_incurred")),
        )
    )
    return claims.select(
        "claim_id", "accident_date", "report_date", "claim_status", F.explode(broken).alias("violation")
    )


def dq_payment_dates(payments: DataFrame) -> DataFrame:
    return payments.filter(F.col("payment_date") < F.col("accident_date")).select(
        "payment_id", "claim_id", "payment_date", "accident_date", F.lit("payment_before_accident").alias("violation")
    )


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows of child whose key is unknown to parent."""
    return child.join(parent.select(key), key, "left_anti")


def dq_referential(claims: DataFrame, policies: DataFrame, payments: DataFrame, known_claims: DataFrame) -> DataFrame:
    """Claims without policy and payments without claim, as (child_id, parent_id, violation)."""
    lost_claims = orphans(claims.select("claim_id", "policy_id"), policies, "policy_id").select(
        F.col("claim_id").alias("child_id"), F.col("policy_id").alias("parent_id"), F.lit("orphan_claim").alias("violation")
    )
    lost_payments = orphans(payments.select("payment_id", "claim_id"), known_claims, "claim_id").select(
        F.col("payment_id").alias("child_id"), F.col("claim_id").alias("parent_id"), F.lit("orphan_payment").alias("violation")
    )
    return lost_claims.unionByName(lost_payments)


def dq_unique_key(tables: Mapping[str, DataFrame], keys: Mapping[str, list[str]] = UNIQUE_KEYS) -> DataFrame:
    """Key values that occur more than once: (table_name, key, copies)."""
    return _all(
        [
            tables[name]
            .groupBy(*columns)
            .agg(F.count("*").alias("copies"))
            .filter(F.col("copies") > 1)
            .select(
                F.lit(name).alias("table_name"),
                F.concat_ws("|", *[F.col(c).cast("string") for c in columns]).alias("key"),
                "copies",
            )
            for name, columns in keys.items()
        ]
    )


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, nulls, row_count) in one pass."""
    counted = df.agg(F.count("*").alias("_rows"), *[F.count(c).alias(c) for c in columns])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("filled")) for c in columns]))
    return counted.select("_rows", pairs.alias("p")).select(
        "p.column_name", (F.col("_rows") - F.col("p.filled")).alias("nulls"), F.col("_rows").alias("row_count")
    )


def dq_non_null(tables: Mapping[str, DataFrame], columns: Mapping[str, list[str]] = NON_NULL) -> DataFrame:
    """Mandatory columns that hold nulls: (table_name, column_name, nulls)."""
    return _all(
        [
            null_counts(tables[name], wanted)
            .filter(F.col("nulls") > 0)
            .select(F.lit(name).alias("table_name"), "column_name", "nulls")
            for name, wanted in columns.items()
        ]
    )


def dq_gate(
    claims: DataFrame,
    policies: DataFrame,
    as_of: datetime,
    max_age_days: int = 30,
    max_null_rate: float = 0.01,
    critical: Sequence[str] = ("claim_id", "policy_id", "accident_date", "cause_of_loss"),
) -> DataFrame:
    """One row per check: (check_name, value, threshold, passed)."""

    def check(name: str, value: Column, threshold: float, passed: Column) -> Column:
        return F.struct(
            F.lit(name).alias("check_name"),
            value.cast("double").alias("value"),
            F.lit(float(threshold)).alias("threshold"),
            F.coalesce(passed, F.lit(False)).alias("passed"),
        )

    def judge(figures: DataFrame, *checks: Column) -> DataFrame:
        return figures.select(F.explode(F.array(*checks)).alias("c")).select("c.*")

    rows, age, nulls, bad, lost = (F.col(c) for c in ("rows", "age", "nulls", "bad", "lost"))
    null_rate = ratio(nulls, rows)
    claim = claims.agg(
        F.count("*").alias("rows"),
        F.datediff(F.lit(as_of), F.max("report_date")).alias("age"),
        F.greatest(*[F.count_if(F.col(c).isNull()) for c in critical]).alias("nulls"),
    )
    policy = policies.agg(F.count("*").alias("rows"), F.count_if(F.col("annual_premium") <= 0).alias("bad"))
    return _all(
        [
            judge(
                claim,
                check("row_count_claims", rows, 0, rows > 0),
                check("date_freshness", age, max_age_days, age <= max_age_days),
                check("null_rate_acceptable", null_rate, max_null_rate, null_rate < max_null_rate),
            ),
            judge(
                policy,
                check("row_count_policies", rows, 0, rows > 0),
                check("premium_positive", bad, 0, bad == 0),
            ),
            judge(
                orphans(claims, policies, "policy_id").agg(F.count("*").alias("lost")),
                check("referential_integrity", lost, 0, lost == 0),
            ),
        ]
    )


def dq_cumulative_monotonic(payments: DataFrame) -> DataFrame:
    """Payments after the first of a claim that lower its cumulative paid, and their share."""
    falls = (F.col("payment_rank") > 1) & (F.col("payment_amount") < 0)
    counted = payments.agg(F.count("*").alias("payments"), F.count_if(falls).alias("falling"))
    return counted.select("payments", "falling", F.round(ratio(F.col("falling"), F.col("payments")), 6).alias("share"))


def _devs(triangle: DataFrame) -> list[str]:
    return [c for c in triangle.columns if c.startswith("dev_year_")]


def dq_triangle_staircase(triangle: DataFrame) -> DataFrame:
    """Filled cells per accident year, and whether an older year has fewer. One row per year."""
    filled = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in _devs(triangle)])
    older = Window.partitionBy(F.lit(0)).orderBy("accident_year").rowsBetween(Window.unboundedPreceding, -1)
    return (
        triangle.select("accident_year", filled.alias("filled"))
        .withColumn("least_before", F.min("filled").over(older))
        .select("accident_year", "filled", F.coalesce(F.col("filled") > F.col("least_before"), F.lit(False)).alias("violation"))
    )


def dq_accepted_values(df: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """Values outside the accepted list with their number of rows."""
    return (
        df.filter(~F.coalesce(F.col(column).isin(list(accepted)), F.lit(False)))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("rows"))
    )


def dq_incurred_ge_paid(claims: DataFrame) -> DataFrame:
    return claims.filter(F.col("incurred_amount") < F.col("total_paid")).select(
        "claim_id", "incurred_amount", "total_paid"
    )


def dq_no_future_accident(claims: DataFrame, valuation: Column) -> DataFrame:
    return claims.filter(F.col("accident_date") > valuation).select("claim_id", "accident_date")


def dq_loss_ratio_band(frequency: DataFrame, width: float = 1.0) -> DataFrame:
    """Loss ratios further than width standard deviations from the mean of their coverage."""
    band = frequency.filter(F.col("loss_ratio").isNotNull()).groupBy("coverage_type").agg(
        F.avg("loss_ratio").alias("mean"), F.stddev_samp("loss_ratio").alias("sd")
    )
    return (
        frequency.join(F.broadcast(band), "coverage_type")  # one row per coverage of the report
        .filter(F.abs(F.col("loss_ratio") - F.col("mean")) > width * F.col("sd"))
        .select("coverage_type", "year", "loss_ratio")
    )


def dq_triangle_complete(long: DataFrame) -> DataFrame:
    """Cells without payments between development year 0 and the last one of the whole triangle.

    The triangle has one row per accident and development year: a small table.
    """
    last = F.max(F.max("development_year")).over(Window.partitionBy(F.lit(0)))
    grid = long.groupBy("accident_year").agg(last.alias("last"))
    cells = grid.select("accident_year", F.explode(F.sequence(F.lit(0), "last")).alias("development_year"))
    return cells.join(long, ["accident_year", "development_year"], "left_anti")


def dq_dev_factor_anomaly(links: DataFrame) -> DataFrame:
    """Age-to-age factors outside the 5th to 95th percentile of their development year."""
    band = links.groupBy("from_dev").agg(F.percentile("link_ratio", F.array(F.lit(0.05), F.lit(0.95))).alias("band"))
    return (
        links.join(F.broadcast(band), "from_dev")  # one row per development year
        .filter((F.col("link_ratio") < F.col("band")[0]) | (F.col("link_ratio") > F.col("band")[1]))
        .select("accident_year", "from_dev", "link_ratio")
    )


# --- observability -----------------------------------------------------------------------------------


def obs_freshness(loaded: Mapping[str, tuple[DataFrame, str]], as_of: datetime) -> DataFrame:
    """Hours since the last load per table, with a status. loaded: name -> (table, time column)."""
    newest = _all(
        [
            table.agg(F.max(F.col(column).cast("timestamp")).alias("last_load")).select(
                F.lit(name).alias("table_name"), "last_load"
            )
            for name, (table, column) in loaded.items()
        ]
    )
    hours = F.floor((F.unix_seconds(F.lit(as_of).cast("timestamp")) - F.unix_seconds("last_load")) / 3600)
    status = F.when(hours > STALE_HOURS, "STALE").when(hours > WARNING_HOURS, "WARNING").otherwise("FRESH")
    return newest.select("table_name", "last_load", hours.alias("hours_since_load"), status.alias("freshness_status"))


def daily(df: DataFrame, day: str, value: str | None = None) -> DataFrame:
    """Rows (and total of value) per day, with zero rows for the days between that have none."""
    sums = [F.count("*").alias("n")] + ([F.sum(value).alias("total"), F.count(value).alias("filled")] if value else [])
    found = df.groupBy(F.col(day).cast("date").alias("day")).agg(*sums)
    span = found.agg(F.min("day").alias("first"), F.max("day").alias("last"))
    spine = span.select(F.explode(F.sequence("first", "last")).alias("day"))
    return spine.join(found, "day", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def _days_before(days: int) -> Window:
    """The days before each day. The input has one row per calendar day."""
    return Window.partitionBy(F.lit(0)).orderBy("day").rowsBetween(-days, -1)


def obs_volume(df: DataFrame, day: str, days: int = 30, width: float = 2.0) -> DataFrame:
    """Days whose row count leaves mean +- width sd of the days before, or drops below half of it."""
    before = _days_before(days)
    counted = daily(df, day).withColumns(
        {
            "seen": F.count("n").over(before),
            "mean": F.avg("n").over(before),
            "sd": F.stddev_samp("n").over(before),
        }
    )
    outside = F.abs(F.col("n") - F.col("mean")) > width * F.col("sd")
    drop = F.col("n") < 0.5 * F.col("mean")
    return counted.filter((F.col("seen") == days) & (outside | drop)).select(
        "day", "n", outside.alias("outside_band"), drop.alias("volume_drop")
    )


def obs_severity_shift(df: DataFrame, day: str, value: str, days: int = 90, width: float = 2.0) -> DataFrame:
    """Days whose mean value lies more than width sd above the rolling mean of the days before."""
    before = _days_before(days)
    rows = daily(df, day, value).withColumn("mean", mean_of(F.col("total"), F.col("filled"))).withColumns(
        {
            "seen": F.count("mean").over(before),
            "rolling": F.avg("mean").over(before),
            "sd": F.stddev_samp("mean").over(before),
        }
    )
    high = (F.col("seen") >= days // 2) & (F.col("mean") - F.col("rolling") > width * F.col("sd"))
    return rows.filter(high).select("day", "n", F.round("mean", 2).alias("mean"))


def obs_distribution(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: mean, quartiles and distinct values, all from mergeable sketches in one pass."""
    figures = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count(c).alias("filled"),
            F.avg(F.col(c).cast("double")).alias("mean"),
            F.percentile_approx(F.col(c).cast("double"), [0.25, 0.5, 0.75], 10_000).alias("q"),
            F.approx_count_distinct(c).alias("distinct_values"),
        ).alias(c)
        for c in columns
    ]
    row = df.agg(*figures).select(F.explode(F.array(*columns)).alias("s"))
    return row.select(
        "s.column_name",
        "s.filled",
        F.round("s.mean", 4).alias("mean"),
        *[F.col("s.q")[i].alias(n) for i, n in enumerate(("q25", "median", "q75"))],
        "s.distinct_values",
    )


def obs_distribution_baseline(
    df: DataFrame, columns: Sequence[str], day: str, width: float = 2.0, at_least: int = 2
) -> DataFrame:
    """Per column and year exact figures, and if the mean lies more than width sd from the means of the years before.

    A year with fewer than at_least years before it has no baseline: its outlier is null. The window runs over one row
    per column and year.
    """
    year = F.year(day)
    values = df.select(year.alias("year"), F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("decimal(28,2)").alias("v")) for c in columns])))
    figures = values.groupBy("column_name", "year").agg(
        F.count("v").alias("filled"), mean_of(F.sum("v"), F.count("v")).alias("mean"), F.countDistinct("v").alias("distinct_values")
    )
    middle = exact_medians(df.withColumn("_year", year), list(columns), "_year").select(
        F.col("name").alias("column_name"), F.col("group").cast("int").alias("year"), "median"
    )
    before = Window.partitionBy("column_name").orderBy("year").rowsBetween(Window.unboundedPreceding, -1)
    apart = F.abs(F.col("mean") - F.avg("mean").over(before)) > width * F.stddev_samp("mean").over(before)
    return figures.join(middle, ["column_name", "year"], "left").select(
        "column_name",
        "year",
        "filled",
        F.round("mean", 4).alias("mean"),
        F.round("median", 4).alias("median"),
        "distinct_values",
        F.when(F.count("mean").over(before) >= at_least, apart).alias("outlier"),
    )


def obs_null_rate(df: DataFrame) -> DataFrame:
    return null_counts(df, df.columns).select(
        "column_name", "nulls", F.round(ratio(F.col("nulls"), F.col("row_count")), 6).alias("null_rate")
    )


def obs_duplicates(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """(table_name, row_count, distinct_ids, has_duplicates) per table and its id column."""
    return _all(
        [
            table.agg(F.count("*").alias("row_count"), F.countDistinct(key).alias("distinct_ids")).select(
                F.lit(name).alias("table_name"),
                "row_count",
                "distinct_ids",
                (F.col("row_count") != F.col("distinct_ids")).alias("has_duplicates"),
            )
            for name, (table, key) in tables.items()
        ]
    )


#: Stretches of keys that table_diff compares by digest; one row of digests each.
BUCKETS = 4096


def _bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    return df.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))


def table_digests(df: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """Per bucket of keys the rows and, for each column, a digest that does not depend on their order.

    A digest is the sum of two 64-bit hashes of key and value over the rows, so a repeated row counts as often as it is
    there. Sums are formed before the shuffle, which moves `buckets` rows a task.
    """
    values = [c for c in df.columns if c != key]
    sums = []
    for i, c in enumerate(values or [key]):
        for seed in (1, 2):
            sums.append(F.sum(F.xxhash64(F.lit(seed), key, c).cast("decimal(20,0)")).alias(f"d{i}_{seed}"))
    return _bucketed(df, key, buckets).groupBy("_bucket").agg(F.count(F.lit(1)).alias("rows"), *sums)


def changed_buckets(before: DataFrame, after: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """The buckets whose rows or digests differ: at most `buckets` rows."""
    old, new = table_digests(before, key, buckets), table_digests(after, key, buckets)
    names = [c for c in old.columns if c != "_bucket"]
    joined = old.select("_bucket", F.struct(*names).alias("old")).join(new.select("_bucket", F.struct(*names).alias("new")), "_bucket", "full")
    return joined.filter(~F.col("old").eqNullSafe(F.col("new"))).select("_bucket")


def table_diff(before: DataFrame, after: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """Rows added, removed or changed between two versions: key, change, columns (that differ).

    Versions are compared by digests per bucket of keys first; only rows of buckets that differ are shuffled. Rows are
    multisets: copies in both versions cancel out. A key with one row left on both sides has changed; otherwise each row
    left is added or removed, as often as it is. A null key is a key like others.
    """
    values = [c for c in before.columns if c != key]
    after = after.select(*before.columns)
    differing = F.broadcast(changed_buckets(before, after, key, buckets))  # at most `buckets` small rows

    def left(df: DataFrame, sign: int) -> DataFrame:
        some = _bucketed(df, key, buckets).join(differing, "_bucket", "left_semi")
        return some.select(F.col(key).alias("k"), F.struct(*values).alias("v") if values else F.lit(0).alias("v"), F.lit(sign).alias("s"))

    net = left(before, -1).unionByName(left(after, 1)).groupBy("k", "v").agg(F.sum("s").alias("net")).filter("net <> 0")
    net = materialise(net, "net-rows")
    sides = net.groupBy("k").agg(
        F.sum(F.greatest("net", F.lit(0))).alias("more"),
        F.sum(F.greatest(-F.col("net"), F.lit(0))).alias("less"),
        F.max(F.when(F.col("net") < 0, F.col("v"))).alias("old"),
        F.max(F.when(F.col("net") > 0, F.col("v"))).alias("new"),
    )
    one = (F.col("more") == 1) & (F.col("less") == 1)
    names = [F.when(~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")), F.lit(c)) for c in values]
    columns = F.concat_ws(",", F.array_compact(F.array(*names))) if values else F.lit("")
    changed = sides.filter(one).select(F.col("k").alias(key), F.lit("changed").alias("change"), columns.alias("columns"))
    others = sides.filter(~one).select(F.col("k").alias("_k"))
    # One side of the join is a key each, the other the rows left, which Spark splits where a key holds many.
    rest = net.join(others, F.col("k").eqNullSafe(F.col("_k")), "left_semi")
    times = F.explode(F.sequence(F.lit(1).cast("bigint"), F.abs("net")))
    rest = rest.select(F.col("k").alias(key), F.when(F.col("net") > 0, "added").otherwise("removed").alias("change"), F.lit("").alias("columns"), times.alias("_n"))
    return changed.unionByName(rest.drop("_n"))


def schema_of(df: DataFrame) -> DataFrame:
    """A schema as rows (column_name, data_type)."""
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column_name string, data_type string")


def schema_diff(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """ADDED, REMOVED and CHANGED columns between two (column_name, data_type) frames."""
    old = expected.select("column_name", F.col("data_type").alias("expected_type"))
    new = actual.select("column_name", F.col("data_type").alias("actual_type"))
    change = F.when(F.col("expected_type").isNull(), "ADDED").when(F.col("actual_type").isNull(), "REMOVED").when(
        F.col("expected_type") != F.col("actual_type"), "CHANGED"
    )
    return (
        old.join(new, "column_name", "full")
        .withColumn("change", change)
        .filter(F.col("change").isNotNull())
        .select("column_name", "change", "expected_type", "actual_type")
    )


def json_schema(events: DataFrame) -> DataFrame:
    """Fields and JSON types found in JSON texts (column value): (column_name, data_type, rows)."""
    pairs = F.explode(F.json_object_keys("value")).alias("column_name")
    return (
        events.select("value", pairs)
        .groupBy("column_name", F.schema_of_variant(
            F.try_variant_get(F.try_parse_json("value"), F.concat(F.lit("$."), F.col("column_name")), "variant")
        ).alias("found"))
        .agg(F.count("*").alias("n"))
        .groupBy(
            "column_name",
            F.when(F.col("found").rlike("^(BIGINT|DECIMAL.*|DOUBLE|FLOAT)$"), "number").otherwise(F.lower("found")).alias("data_type"),
        )
        .agg(F.sum("n").alias("rows"))
    )


def schema_flexible_read(df: DataFrame, wanted: Mapping[str, tuple[str, ...]], defaults: Mapping[str, str] | None = None) -> DataFrame:
    """Wanted columns by any of their names, null (or the default) where a table has none of them."""
    defaults = defaults or {}
    columns = []
    for name, candidates in wanted.items():
        found = [F.col(c) for c in candidates if c in df.columns]
        value = F.coalesce(*found) if found else F.lit(None).cast("string")
        if name in defaults:
            value = F.coalesce(value, F.lit(defaults[name]))
        columns.append(value.alias(name))
    return df.select(*columns)

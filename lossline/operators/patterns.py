"""General table patterns: latest record, spine fill, pivot, keys, masking, history, upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lossline.functions.columns import mean_of


def running_total(df: DataFrame, keys: Sequence[str], period: str, value: str) -> DataFrame:
    """Total per key and period with the running total; the window sees one row per period."""
    per_period = df.groupBy(*keys, period).agg(F.sum(value).alias("total"))
    window = Window.partitionBy(*keys).orderBy(period).rowsBetween(Window.unboundedPreceding, 0)
    return per_period.withColumn("running_total", F.sum("total").over(window))


def latest_record(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key by order, as an aggregate: no sort of a whole group."""
    rest = [c for c in df.columns if c not in (*keys, *order)]
    last = F.max(F.struct(*order, *rest)).alias("last")
    return df.groupBy(*keys).agg(last).select(*keys, "last.*")


def lag_change(periods: DataFrame, period: str, value: str) -> DataFrame:
    """Change against the period before. Input: one row per period."""
    before = F.lag(value).over(Window.partitionBy(F.lit(0)).orderBy(period))
    return periods.withColumn("previous", before).withColumn("change", F.col(value) - F.col("previous"))


def moving_average(periods: DataFrame, period: str, value: str, rows: int = 3) -> DataFrame:
    """Mean of the last rows periods. Input: one row per period."""
    window = Window.partitionBy(F.lit(0)).orderBy(period).rowsBetween(1 - rows, 0)
    mean = mean_of(F.sum(value).over(window), F.count(value).over(window))
    return periods.withColumn("moving_average", mean)


def by_month(df: DataFrame, day: str, value: str) -> DataFrame:
    return df.groupBy(F.trunc(day, "month").alias("month")).agg(
        F.sum(value).alias("amount"), F.count("*").alias("n")
    )


def pivot_sum(df: DataFrame, row: str, column: str, values: Sequence, amount: str, prefix: str) -> DataFrame:
    """Sums of amount, one column per value and one for all others; 0 where there is none. A row adds up to all amounts."""
    sums = [F.sum(F.when(F.col(column) == v, F.col(amount)).otherwise(0)).alias(f"{prefix}{v}") for v in values]
    rest = F.coalesce(~F.col(column).isin(list(values)), F.lit(True))
    return df.groupBy(row).agg(*sums, F.sum(F.when(rest, F.col(amount)).otherwise(0)).alias(f"{prefix}other"))


def unpivot(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Wide to long: (keys, metric_name, metric_value); rows without a value are left out."""
    return df.unpivot(list(keys), list(values), "metric_name", "metric_value").filter(F.col("metric_value").isNotNull())


def anti_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.join(right.select(key), key, "left_anti")


def date_spine_fill(df: DataFrame, day: str) -> DataFrame:
    """Rows per day, with a row of 0 for every day between that has none."""
    counted = df.groupBy(F.col(day).alias("day")).agg(F.count("*").alias("n"))
    spine = counted.agg(F.min("day").alias("first"), F.max("day").alias("last")).select(
        F.explode(F.sequence("first", "last")).alias("day")
    )
    return spine.join(counted, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"))


# --- protection ------------------------------------------------------------------------------


def masked(name: str, keep: int = 2) -> Column:
    """Only the last characters of an identifier; shorter ones are hidden entirely."""
    text = F.col(name).cast("string")
    hidden = F.greatest(F.length(text) - keep, F.lit(0))
    return F.when(F.length(text) > keep, F.concat(F.repeat(F.lit("*"), hidden), F.right(text, F.lit(keep)))).otherwise(
        F.repeat(F.lit("*"), F.length(text))
    )


def mask_pii(
    df: DataFrame, hashed: Sequence[str] = (), nulled: Sequence[str] = (), partial: Sequence[str] = (), salt: str = ""
) -> DataFrame:
    """Identifiers hashed (joinable), nulled, or cut to their last characters."""
    columns = {c: F.sha2(F.concat(F.lit(salt), F.col(c).cast("string")), 256) for c in hashed}
    columns |= {c: F.lit(None).cast(df.schema[c].dataType) for c in nulled}
    columns |= {c: masked(c) for c in partial}
    return df.withColumns(columns)


def row_policy(df: DataFrame, entitlements: DataFrame, user: str, region: str) -> DataFrame:
    """Rows of the regions a user is entitled to. entitlements: (user_name, region)."""
    allowed = entitlements.filter(F.col("user_name") == user).select(F.col("region").alias(region)).distinct()
    return df.join(allowed, region, "left_semi")


def generalise(df: DataFrame, age: str, region: str, regions: DataFrame) -> DataFrame:
    """Quasi-identifiers coarsened: age to its decade, region to the area it belongs to (region, area)."""
    decade = F.floor(F.col(age) / 10) * 10
    area = regions.withColumnRenamed("region", region)
    return df.join(area, region, "left").drop(region).withColumn(age, decade.cast("int"))


# --- history ------------------------------------------------------------------------------------


def scd2_from_changes(changes: DataFrame, keys: Sequence[str], valid_from: str) -> DataFrame:
    """Versions with valid_to (exclusive, null for the current one) from dated changes of each key.

    A key has as many rows as it has changes; changes of one day collapse to the last first.
    """
    rest = [c for c in changes.columns if c not in (*keys, valid_from)]
    per_day = changes.groupBy(*keys, valid_from).agg(F.max(F.struct(*rest)).alias("v")).select(*keys, valid_from, "v.*")
    timeline = Window.partitionBy(*keys).orderBy(valid_from)
    before = F.lag(F.struct(*rest)).over(timeline)
    changed = per_day.withColumn("_before", before).filter(~F.struct(*rest).eqNullSafe(F.col("_before"))).drop("_before")
    return changed.withColumn("valid_to", F.lead(valid_from).over(timeline)).withColumn(
        "is_current", F.col("valid_to").isNull()
    )


def scd2_apply(history: DataFrame, snapshot: DataFrame, key: str, as_of: Column) -> DataFrame:
    """Load a snapshot into a history (key, values, valid_from, valid_to, is_current).

    Current rows that changed or vanished are closed at as_of; new and changed rows open there.
    """
    values = [c for c in snapshot.columns if c != key]
    current = history.filter("is_current").select(key, F.struct(*values).alias("held"), "valid_from")
    incoming = snapshot.select(key, F.struct(*values).alias("new"))
    met = current.join(incoming, key, "full")
    same = F.col("held").eqNullSafe(F.col("new"))
    no_end = F.lit(None).cast("date")
    kept = F.struct(F.col("held").alias("v"), F.col("valid_from"), F.when(same, no_end).otherwise(as_of).alias("valid_to"))
    opened = F.struct(F.col("new").alias("v"), as_of.alias("valid_from"), no_end.alias("valid_to"))
    versions = F.array_compact(
        F.array(F.when(F.col("held").isNotNull(), kept), F.when(F.col("new").isNotNull() & ~same, opened))
    )
    loaded = met.select(key, F.explode(versions).alias("r")).select(
        key, "r.v.*", "r.valid_from", "r.valid_to", F.col("r.valid_to").isNull().alias("is_current")
    )
    return history.filter("NOT is_current").unionByName(loaded)


def scd2_lookup(facts: DataFrame, history: DataFrame, key: str, day: str) -> DataFrame:
    """Each fact with the version of its key that was valid on its day.

    The version is found once per key and day, from the distinct days of the facts and the
    version starts in one timeline; facts then join by key and day. A key with very many
    facts never meets all of its versions row by row.
    """
    values = [c for c in history.columns if c not in (key, "valid_from", "valid_to", "is_current")]
    starts = history.select(
        key, F.col("valid_from").alias(day), F.struct("valid_from", "valid_to", *values).alias("_v"), F.lit(0).alias("_asks")
    )
    asked = facts.select(key, day).distinct().select(
        key, day, F.lit(None).cast(starts.schema["_v"].dataType).alias("_v"), F.lit(1).alias("_asks")
    )
    so_far = Window.partitionBy(key).orderBy(day, "_asks").rowsBetween(Window.unboundedPreceding, 0)
    found = (
        starts.unionByName(asked)
        .withColumn("_v", F.last("_v", ignorenulls=True).over(so_far))
        .filter("_asks = 1")
        .withColumn("_v", F.when(F.col("_v.valid_to").isNull() | (F.col(day) < F.col("_v.valid_to")), F.col("_v")))
        .select(key, day, "_v")
    )
    known = facts.filter(F.col(key).isNotNull() & F.col(day).isNotNull())
    unknown = facts.filter(F.col(key).isNull() | F.col(day).isNull())
    matched = known.join(found, [key, day], "left").select(*facts.columns, "_v.*")
    return matched.unionByName(unknown, allowMissingColumns=True)


def lambda_merge(batch: DataFrame, stream: DataFrame, cutoff: Column, when: str) -> DataFrame:
    """Serving view: batch rows up to the cutoff, stream rows after it."""
    return batch.filter(F.col(when) < cutoff).unionByName(stream.filter(F.col(when) >= cutoff))


# --- loads ----------------------------------------------------------------------------------------


def merge_upsert(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """The target with matching rows replaced and new rows added, by one full join."""
    values = [c for c in target.columns if c != key]
    old = target.select(key, F.struct(*values).alias("old"))
    new = updates.select(key, F.struct(*values).alias("new"))
    return old.join(new, key, "full").select(key, F.coalesce("new", "old").alias("row")).select(key, "row.*")


def newer_than(source: DataFrame, loaded: DataFrame, column: str) -> DataFrame:
    """Source rows newer than the newest loaded one; all of them if nothing is loaded yet.

    The newest value is read first and enters as a literal, so that the scan can skip files.
    """
    newest = loaded.agg(F.max(column)).first()[0]
    return source if newest is None else source.filter(F.col(column) > F.lit(newest))

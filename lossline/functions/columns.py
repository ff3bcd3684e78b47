"""Column expressions shared by the models. All of them stay inside generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def clean_lower(name: str) -> Column:
    return F.lower(F.trim(name))


def clean_upper(name: str) -> Column:
    return F.upper(F.trim(name))


def date_key(day: str | Column) -> Column:
    """yyyymmdd as an integer, from the date parts."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def month_distance(start: str | Column, end: str | Column) -> Column:
    """Calendar months between two dates, ignoring the day of month."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def completed_years(birth: str | Column, day: str | Column) -> Column:
    """Age in completed years."""
    not_reached = F.month(day) * 100 + F.dayofmonth(day) < F.month(birth) * 100 + F.dayofmonth(birth)
    return F.year(day) - F.year(birth) - not_reached.cast("int")


def flag(condition: Column) -> Column:
    """Boolean that is false, not null, where the condition is unknown."""
    return F.coalesce(condition, F.lit(False))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient of doubles; null where the denominator is null, zero or negative."""
    bottom = denominator.cast("double")
    return F.when(bottom > 0, numerator.cast("double") / bottom)


def mean_of(total: Column, count: Column) -> Column:
    """Mean from an exact total, so that no floating sum depends on row order."""
    return total.cast("double") / F.nullif(count, F.lit(0)).cast("double")


def prorated_money(amount: Column, part: Column, whole: Column) -> Column:
    """amount * part / whole in cents, rounded half away from zero with integer arithmetic."""
    scaled = (amount * 100).cast("bigint") * part.cast("bigint")
    size = F.call_function("div", 2 * F.abs(scaled) + whole, F.lit(2) * whole)
    cents = F.when(scaled < 0, -size).otherwise(size)
    return (cents.cast("decimal(18,0)") / 100).cast("decimal(16,2)")


def surrogate_key(*names: str) -> Column:
    """Deterministic 64-bit key over columns; a null part counts as an empty one."""
    parts = [F.coalesce(F.col(n).cast("string"), F.lit("")) for n in names]
    return F.xxhash64(F.concat_ws("|", *parts))


def digest_key(*names: str) -> Column:
    """The same key as hex text from md5, for other engines to reproduce."""
    parts = [F.coalesce(F.col(n).cast("string"), F.lit("")) for n in names]
    return F.md5(F.concat_ws("|", *parts).cast("binary"))


def dataset_name(name: str, environment: str) -> str:
    """Dataset (schema) name, prefixed outside production."""
    return name if environment == "prod" else f"dev_{name}"

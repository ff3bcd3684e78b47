"""Order statistics over a whole table, without moving the table into one task.

A plain ``Window.orderBy`` with no partition sends every row to a single task. Here the rows are
dealt out by range of all sort keys, sorted, and written to the shared folder with their place: a
task that runs again, or a second reader, sees each row where it was. The totals of the partitions
before it turn a local position or running total into that of the whole table; they are a table of
one row per partition. Keys are compared as what they are (numbers of any width, text, dates), nulls
first; a heavy tie of the first key is cut by the next one, so the keys together should tell rows apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lossline.session import materialise

_PLACE, _PART, _POS, _BASE, _ALL = "_ord_place", "_ord_part", "_ord_pos", "_ord_base", "_ord_all"


def _dealt(df: DataFrame, keys: list[str], ranges: int | None) -> DataFrame:
    """Rows with _PLACE (partition and position in it) and _PART, in the order of the keys.

    ranges: partitions to deal out to; by default as many as the session has for a shuffle.
    """
    order = [F.col(k).asc_nulls_first() for k in keys]
    spread = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
    sorted_rows = spread.sortWithinPartitions(*order).withColumn(_PLACE, F.monotonically_increasing_id())
    # The upper bits of that id are the number of the partition, the lower 33 the row in it.
    return materialise(sorted_rows, "ordered").withColumn(_PART, F.shiftright(_PLACE, 33))


def _before(dealt: DataFrame, total: Column, how: str = "sum") -> DataFrame:
    """Per partition the total of those before it, and of all; one row per partition, so it can be broadcast."""
    per_part = dealt.groupBy(_PART).agg(total.alias("_t"))
    everything = Window.partitionBy(F.lit(0))
    before = everything.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    function = {"sum": F.sum, "max": F.max}[how]
    return F.broadcast(per_part.select(_PART, function("_t").over(before).alias(_BASE), function("_t").over(everything).alias(_ALL)))


def _numbered(df: DataFrame, keys: list[str], name: str, ranges: int | None) -> DataFrame:
    """Rows with their position from 1 in name, and the number of all rows in _ALL."""
    dealt = _dealt(df, keys, ranges)
    place = F.col(_PLACE).bitwiseAND(F.lit((1 << 33) - 1)) + 1
    joined = dealt.join(_before(dealt, F.count("*")), _PART)
    return joined.withColumn(name, place + F.coalesce(_BASE, F.lit(0))).drop(_PLACE, _PART, _BASE)


def ord_row_number(df: DataFrame, keys: list[str], name: str = "row_number", ranges: int | None = None) -> DataFrame:
    """Position of each row (from 1) when the whole table is sorted by keys, nulls first."""
    return _numbered(df, keys, name, ranges).drop(_ALL)


def ord_rank_of_all(df: DataFrame, keys: list[str], name: str, rows: str, ranges: int | None = None) -> DataFrame:
    """As ord_row_number, with the number of all rows in a further column."""
    return _numbered(df, keys, name, ranges).withColumnRenamed(_ALL, rows)


def tile_of_rank(rank: Column, rows: Column | int, tiles: int) -> Column:
    """NTILE from a rank: the first (rows mod tiles) tiles hold one row more."""
    rows = rows if isinstance(rows, Column) else F.lit(rows)
    rows = rows.cast("bigint")
    size = F.floor(rows / tiles)
    extra = rows % tiles
    wide = extra * (size + 1)
    return (
        F.when(rank <= wide, F.floor((rank - 1) / (size + 1)) + 1)
        .otherwise(extra + F.floor((rank - 1 - wide) / F.greatest(size, F.lit(1))) + 1)
        .cast("int")
    )


def ord_ntile(df: DataFrame, keys: list[str], tiles: int, name: str = "tile", ranges: int | None = None) -> DataFrame:
    """NTILE over the whole table sorted by keys."""
    ranked = _numbered(df, keys, "_ord_rank", ranges)
    return ranked.withColumn(name, tile_of_rank(F.col("_ord_rank"), F.col(_ALL), tiles)).drop("_ord_rank", _ALL)


def ord_running(
    df: DataFrame,
    keys: list[str],
    value: str,
    name: str,
    how: str = "sum",
    ranges: int | None = None,
    include_current: bool = True,
) -> DataFrame:
    """Running sum or maximum of value over the whole table sorted by keys."""
    function = {"sum": F.sum, "max": F.max}[how]
    dealt = _dealt(df, keys, ranges)
    frame = Window.partitionBy(_PART).orderBy(_PLACE).rowsBetween(Window.unboundedPreceding, 0 if include_current else -1)
    local, before = F.col(_POS), F.col(_BASE)
    if how == "sum":
        joined = F.when(before.isNull(), local).when(local.isNull(), before).otherwise(local + before)
    else:
        joined = F.greatest(local, before)
    return (
        dealt.withColumn(_POS, function(value).over(frame))
        .join(_before(dealt, function(value), how), _PART)
        .withColumn(name, joined)
        .drop(_PLACE, _PART, _POS, _BASE, _ALL)
    )


def ord_running_sum(df: DataFrame, keys: list[str], value: str, name: str = "running_sum", **more) -> DataFrame:
    return ord_running(df, keys, value, name, "sum", **more)


#: Rows of one key that a single task may put in order.
LONG_KEY = 100_000


def keyed_running(df: DataFrame, key: str, order: list[str], value: str, sum_name: str, rank_name: str) -> DataFrame:
    """Running sum and row number per key, for keys of any number of rows."""
    short, long = keyed_running_parts(df, key, order, value, sum_name, rank_name)
    return short.unionByName(long)


def keyed_running_parts(
    df: DataFrame, key: str, order: list[str], value: str, sum_name: str, rank_name: str, long_key: int = LONG_KEY
) -> tuple[DataFrame, DataFrame]:
    """As keyed_running, in two tables: the rows of keys with at most `long_key` rows, and those of longer ones.

    The first are dealt out by key, once, and stay so for what follows; the second are cut by day. The long keys are at
    most one in `long_key` rows, so their list can be broadcast.
    """
    counted = df.groupBy(F.col(key).alias("_long")).agg(F.count("*").alias("_rows"))
    long_keys = F.broadcast(counted.filter(F.col("_rows") > long_key).select("_long"))
    is_long = F.col(key).eqNullSafe(F.col("_long"))
    by_key = Window.partitionBy(key).orderBy(F.col(order[0]).asc_nulls_first(), *order[1:]).rowsBetween(Window.unboundedPreceding, 0)
    short = df.join(long_keys, is_long, "left_anti").withColumns(
        {sum_name: F.sum(value).over(by_key), rank_name: F.row_number().over(by_key).cast("bigint")}
    )
    return short, _running_by_day(df.join(long_keys, is_long, "left_semi"), key, order, value, sum_name, rank_name)


def _running_by_day(df: DataFrame, key: str, order: list[str], value: str, sum_name: str, rank_name: str) -> DataFrame:
    """Running sum and row number of keys with very many rows.

    The rows of a key are windowed per value of the first order column (a day), and the totals of
    the days before come from a table with one row per key and day, which is summed before it is shuffled.
    """
    day, kind = order[0], df.schema[value].dataType
    daily = df.groupBy(key, day).agg(F.sum(value).alias("_sum"), F.count("*").alias("_rows"))
    before = Window.partitionBy(key).orderBy(F.col(day).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    base = daily.select(
        F.col(key).alias("_key"), F.col(day).alias("_day"), F.sum("_sum").over(before).alias("_base_sum"), F.sum("_rows").over(before).alias("_base_rank")
    )
    within = Window.partitionBy(key, day).orderBy(*[F.col(c) for c in order[1:]]).rowsBetween(Window.unboundedPreceding, 0)
    local = df.withColumn("_local", F.sum(value).over(within)).withColumn("_n", F.row_number().over(within).cast("bigint"))
    whole = F.sum(value).over(within)  # its type is that of a sum
    sum_type = df.select(whole.alias("x")).schema["x"].dataType if kind.typeName() == "decimal" else None
    total = F.when(F.col("_base_sum").isNull(), F.col("_local")).when(F.col("_local").isNull(), F.col("_base_sum")).otherwise(F.col("_local") + F.col("_base_sum"))
    return (
        local.join(base, F.col(key).eqNullSafe(F.col("_key")) & F.col(day).eqNullSafe(F.col("_day")))
        .withColumn(sum_name, total.cast(sum_type) if sum_type else total)
        .withColumn(rank_name, F.col("_n") + F.coalesce("_base_rank", F.lit(0)))
        .drop("_key", "_day", "_base_sum", "_base_rank", "_local", "_n")
    )

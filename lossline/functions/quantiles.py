"""Exact order statistics of large tables, without sorting them.

As long as a stretch of values is long, a sketch gives cut points: at first close to both sides of the wanted ranks, later evenly.
One pass counts the values between the cut points exactly, so the stretch that holds a rank is certain whatever the sketch
says; only the values in these stretches are kept. What is left is counted value by value: heavy ties are one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lossline.session import materialise

#: Rank error of the sketch: one in so many rows.
ACCURACY = 10_000
#: Different values of a stretch that are put in order in one task (as estimated; never more than its rows).
STRETCH = 1_000_000
EVEN = 64


def values_at(values: DataFrame, keys: Sequence[str], value: str, places: Sequence[Column], near: Sequence[float]) -> DataFrame:
    """keys, at, value, below: the value at each place (from 0; an expression of n, the rows of the group) and the rows
    of the group below that value.

    near: the shares of the rows around which the places lie; they only decide how soon the search ends. Values must not be
    null. `values` is read several times, so it should be a written table.
    """
    keys = list(keys)
    rows = values.select(*keys, F.col(value).alias("_v"))
    told = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("_v").alias("_different"))
    told = materialise(told, "groups")
    wanted = told.select(*keys, F.explode(F.array_distinct(F.array(*[p.cast("bigint") for p in places]))).alias("at"))
    wanted = wanted.select("*", F.col("at").alias("_place"), F.lit(0).cast("bigint").alias("_base"))
    longest = told.agg(F.max(F.least("n", "_different"))).first()[0]
    path = list(keys)
    shares = sorted({min(1.0, max(0.0, p + s * 2 / ACCURACY)) for p in near for s in (-1, 1)})
    while (longest or 0) > STRETCH:
        cuts = rows.groupBy(*path).agg(F.percentile_approx("_v", shares, ACCURACY).alias("_cuts"))
        bucket = F.size(F.filter("_cuts", lambda c: c < F.col("_v")))
        placed = rows.join(cuts, path).withColumn("_b", bucket).drop("_cuts")
        counts = placed.groupBy(*path, "_b").agg(F.count(F.lit(1)).alias("_n"), F.approx_count_distinct("_v").alias("_different"))
        earlier = Window.partitionBy(*path).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        held = (F.col("_place") >= F.col("_before")) & (F.col("_place") < F.col("_before") + F.col("_n"))
        chosen = wanted.join(counts, path).filter(held)
        step = f"_b{len(path)}"
        chosen = chosen.select(
            *path, F.col("_b").alias(step), "at", (F.col("_place") - F.col("_before")).alias("_place"),
            (F.col("_base") + F.col("_before")).alias("_base"), "_n", "_different",
        )
        chosen = materialise(chosen, "stretches")
        rows = placed.withColumnRenamed("_b", step).join(chosen.select(*path, step).distinct(), [*path, step], "left_semi")
        path, wanted = [*path, step], chosen.drop("_n", "_different")
        longest = chosen.agg(F.max(F.least("_n", "_different"))).first()[0]
        shares = [i / EVEN for i in range(1, EVEN)]
    counted = rows.groupBy(*path, "_v").agg(F.count(F.lit(1)).alias("_n"))
    so_far = Window.partitionBy(*path).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    counted = counted.withColumn("_end", F.sum("_n").over(so_far))
    found = wanted.join(counted, path).filter((F.col("_place") < F.col("_end")) & (F.col("_place") >= F.col("_end") - F.col("_n")))
    below = F.col("_base") + F.col("_end") - F.col("_n")
    return found.select(*keys, "at", F.col("_v").alias("value"), below.alias("below"))


def exact_medians(df: DataFrame, columns: list[str], by: str | None = None, ranges: int | None = None) -> DataFrame:
    """group, name, median: the mean of the two middle values of each column, within each value of `by` if given.

    All columns and groups are searched in the same passes. Null and NaN values do not count; a column without others has
    no row. Without `by`, group is an empty text. ranges: partitions of the table that is searched.
    """
    group = F.coalesce(F.col(by).cast("string"), F.lit("")) if by else F.lit("")
    narrow = df.select(group.alias("group"), *[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)])
    narrow = materialise(narrow.repartition(ranges) if ranges else narrow, "median-columns")
    named = F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"_{i}").alias("value")) for i, c in enumerate(columns)])
    values = narrow.select("group", F.inline(named)).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    middle = values_at(values, ["group", "name"], "value", [F.expr("(n - 1) div 2"), F.expr("n div 2")], [0.5])
    return middle.groupBy("group", "name").agg(F.avg("value").alias("median"))


def tiles_by_cuts(df: DataFrame, value: str, key: str, tiles: int, name: str, among: str = "true") -> DataFrame:
    """df with NTILE by (value, key) over the whole table, nulls of value first; key tells all rows apart.

    The first row of each tile is searched, by value and among equal values by key; rows are compared with these few, so
    none of them moves. Only rows that `among` (a condition) holds for are counted; others get the tile they would lie in.
    """
    rows = materialise(df.filter(among).select(F.col(value).alias("_value"), F.col(key).alias("_key")), "tile-columns")
    total, nulls = rows.agg(F.count(F.lit(1)), F.count_if(F.col("_value").isNull())).first()
    size, extra = divmod(total, tiles)
    starts = [tile * size + min(tile, extra) for tile in range(1, tiles)]
    starts = [s for s in starts if s < total]
    if not starts:
        return df.withColumn(name, F.lit(1))
    # The value of each first row (null before the others), and its place among the rows of that value.
    known = rows.filter("_value IS NOT NULL").withColumn("_g", F.lit(0))
    after = [s - nulls for s in starts if s >= nulls]
    found = values_at(known, ["_g"], "_value", [F.lit(p) for p in after], [p / (total - nulls) for p in after]).collect() if after else []
    at = {r.at: (r.value, r.below) for r in found}
    firsts = [(None, s) if s < nulls else (at[s - nulls][0], s - nulls - at[s - nulls][1]) for s in starts]
    tied = [F.when(F.col("_value").eqNullSafe(F.lit(v)), i) for i, (v, _) in enumerate(firsts)]
    places = [F.when(F.col("_g") == i, F.lit(place)) for i, (_, place) in enumerate(firsts)]
    # Several tiles may begin within one value: its rows are searched once for each.
    groups = rows.select("_key", F.explode(F.array_compact(F.array(*tied))).alias("_g"))
    edges = values_at(groups, ["_g"], "_key", [F.coalesce(*places)], [i / 8 for i in range(1, 8)]).collect()
    edge = {r["_g"]: r.value for r in edges}
    tile = F.lit(1)
    for i, (v, _) in enumerate(firsts):
        same = F.col(value).eqNullSafe(F.lit(v)) & (F.col(key) >= F.lit(edge[i]))
        beyond = F.col(value).isNotNull() if v is None else F.coalesce(F.col(value) > F.lit(v), F.lit(False))
        tile = tile + F.when(same | beyond, 1).otherwise(0)
    return df.withColumn(name, tile.cast("int"))

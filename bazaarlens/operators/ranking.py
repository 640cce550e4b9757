"""Exact ranks and quantiles for groups of any size.

A window or ``percentile`` puts a whole group into one task. Here equal values are counted first, so a value that
a third of the rows share is one row per map task. The counts are then cut by range of (group, value): the cuts
follow the data, so a large group goes to as many partitions as it needs, however close its values are. Sums per
group and partition are few; rows only meet the rows of their group in their own partition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.session import settle

#: Rows of a group that may be sorted in one row.
GROUP_ROWS = 50_000


def join_same(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join in which NULL equals NULL."""
    other = right.select(*[F.col(c).alias(f"_right_{c}") if c in on else F.col(c) for c in right.columns])
    match = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in on])
    return left.join(other, match).drop(*[f"_right_{c}" for c in on])


def _placed(long: DataFrame, group: Sequence[str], weight: str | None = None) -> DataFrame:
    """Distinct values ``_v`` of every group with their rows, the rows before them, and the group's totals.

    A row stands for as many as its ``weight`` says. NaN is the largest number; NULL comes after it.
    """
    value = F.col("_v").asc_nulls_last()
    counts = long.groupBy(*group, "_v").agg((F.sum(weight) if weight else F.count("*")).alias("_cnt"))
    # written with the number of its range, which any later read then agrees on
    cut = settle(counts.repartitionByRange(*group, value).withColumn("_part", F.spark_partition_id()), "values")
    known = F.sum(F.when(F.col("_v").isNotNull(), F.col("_cnt")).otherwise(0))
    sums = cut.groupBy(*group, "_part").agg(F.sum("_cnt").alias("_in"), known.alias("_in_known"))
    whole = Window.partitionBy(*group)
    # a group has one row here for each range that it reaches into
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(
        *group,
        "_part",
        F.coalesce(F.sum("_in").over(earlier), F.lit(0)).alias("_base"),
        F.sum("_in").over(whole).alias("_total"),
        F.sum("_in_known").over(whole).alias("_known"),
    )
    inside = Window.partitionBy(*group, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    local = cut.withColumn("_before", F.coalesce(F.sum("_cnt").over(inside), F.lit(0)))
    return join_same(local, bases, [*group, "_part"]).select(
        *group, "_v", "_cnt", (F.col("_base") + F.col("_before")).alias("_before"), "_total", "_known"
    )


def rank_within(
    df: DataFrame,
    ids: Sequence[str],
    keys: Sequence[str],
    values: Mapping[str, str],
    size_as: str = "group_size",
) -> DataFrame:
    """Add ``rank()`` (ascending, NaN last of the numbers, then NULL, ties equal) of several columns within ``keys``.

    ``ids`` must identify a row; ``values`` maps output name to value column.
    """
    names = list(values)
    items = [F.struct(F.lit(i).alias("_m"), F.col(values[n]).cast("double").alias("_v")) for i, n in enumerate(names)]
    long = df.select(*dict.fromkeys([*ids, *keys]), F.inline(F.array(*items)))
    group = [*keys, "_m"]
    ranked = _placed(long, group).select(*group, "_v", (F.col("_before") + 1).alias("_rank"), "_total")
    wide = (
        join_same(long, ranked, [*group, "_v"])
        .groupBy(*ids)
        .agg(
            F.max("_total").alias(size_as),
            *[F.max(F.when(F.col("_m") == i, F.col("_rank"))).alias(n) for i, n in enumerate(names)],
        )
    )
    return df.join(wide, list(ids))


def percentile_of(rank: Column | str, size: Column | str) -> Column:
    """0..100, NULL for a group of one."""
    r = F.col(rank) if isinstance(rank, str) else rank
    n = F.col(size) if isinstance(size, str) else size
    return F.bround(F.lit(100.0) * (r - 1) / F.nullif(n - 1, F.lit(0))).cast("int")


def group_quantiles(
    df: DataFrame, keys: Sequence[str], metrics: Mapping[str, tuple[Column, float]], weight: str | None = None
) -> DataFrame:
    """Exact interpolated quantiles per key.

    ``metrics`` maps an output name to (value, q). NULL values do not count; a key whose values are all NULL
    stays, with NULL. A row stands for as many as the column ``weight`` says, a positive whole number.
    """
    names = list(metrics)
    items = [
        F.struct(F.lit(i).alias("_m"), metrics[n][0].cast("double").alias("_v")) for i, n in enumerate(names)
    ]
    group = [*keys, "_m"]
    weights = [F.col(weight).alias("_weight")] if weight else []
    rows = _placed(df.select(*keys, *weights, F.inline(F.array(*items))), group, "_weight" if weight else None)
    q = reduce(
        lambda acc, i: F.when(F.col("_m") == i, F.lit(float(metrics[names[i]][1]))).otherwise(acc),
        range(len(names)),
        F.lit(None).cast("double"),
    )
    # the quantile lies between the rows number lo and hi (from 0)
    place = q * (F.col("_known") - 1)
    last = F.col("_before") + F.col("_cnt") - 1

    def at(row: Column) -> Column:
        return F.max(F.when(F.col("_v").isNotNull() & (F.col("_before") <= row) & (row <= last), F.col("_v")))

    ends = rows.groupBy(*group).agg(
        F.max(place).alias("_place"), at(F.floor(place)).alias("_lo"), at(F.ceil(place)).alias("_hi")
    )
    part = F.col("_place") - F.floor("_place")
    value = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * part
    picked = ends.withColumn("_q", F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise(value))
    return picked.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_m") == i, F.col("_q"))).alias(n) for i, n in enumerate(names)]
    )


def many_group_quantiles(df: DataFrame, keys: Sequence[str], metrics: Mapping[str, tuple[Column, float]], most: int = GROUP_ROWS) -> DataFrame:
    """``group_quantiles`` for very many groups: each of up to ``most`` rows is sorted in one row, larger ones are cut by range.

    ``df`` is read twice, and once more if there are larger groups.
    """
    sizes = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    large = settle(sizes.filter(F.col("_n") > most).select(*[F.col(k).alias(f"_large_{k}") for k in keys]), "large-groups")
    if large.isEmpty():
        return _sorted_quantiles(df, keys, metrics)
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_large_{k}")) for k in keys])
    small = _sorted_quantiles(df.join(large, match, "left_anti"), keys, metrics)
    return small.unionByName(group_quantiles(df.join(large, match, "left_semi"), keys, metrics))


def _sorted_quantiles(df: DataFrame, keys: Sequence[str], metrics: Mapping[str, tuple[Column, float]]) -> DataFrame:
    names = list(metrics)
    rows = df.select(*keys, *[metrics[n][0].cast("double").alias(f"_v{i}") for i, n in enumerate(names)]).repartition(*keys)
    lists = rows.groupBy(*keys).agg(*[F.sort_array(F.collect_list(f"_v{i}")).alias(f"_v{i}") for i in range(len(names))])

    def middle(values: str, q: float) -> Column:
        place = F.lit(float(q)) * (F.size(values) - 1)
        lo, hi = F.get(values, F.floor(place).cast("int")), F.get(values, F.ceil(place).cast("int"))
        return F.when(lo == hi, lo).otherwise(lo + (hi - lo) * (place - F.floor(place)))

    return lists.select(*keys, *[middle(f"_v{i}", metrics[n][1]).alias(n) for i, n in enumerate(names)])


def numbered(df: DataFrame, ids: Sequence[str], out: str = "position", seed: int | str | None = None) -> DataFrame:
    """Number all rows 1..n in the order of md5(ids), without a single-task sort.

    The first four hex digits cut the table into 65,536 even slices. ``ids`` must
    identify a row.
    """
    text = F.concat_ws("|", *([F.lit(str(seed))] if seed is not None else []), *[F.col(c).cast("string") for c in ids])
    keyed = df.withColumn("_md5", F.md5(text.cast("binary"))).withColumn("_part", F.substring("_md5", 1, 4))
    # at most 65,536 rows in the window without a key
    sizes = keyed.groupBy("_part").agg(F.count("*").alias("_n"))
    starts = sizes.select(
        "_part",
        (F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_n")).alias("_start"),
        F.sum("_n").over(Window.partitionBy()).alias("_rows"),
    )
    inside = Window.partitionBy("_part").orderBy("_md5", *ids)
    return (
        keyed.join(F.broadcast(starts), "_part")
        .withColumn(out, F.col("_start") + F.row_number().over(inside))
        .withColumn(f"{out}_of", F.col("_rows"))
        .drop("_md5", "_part", "_start", "_rows")
    )

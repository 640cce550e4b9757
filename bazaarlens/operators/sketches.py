"""Approximate distinct counts and quantiles from sketches that are kept and merged.

A sketch of a day (or any other slice) is written once; any longer period is then a merge of small binary rows instead
of another pass over the facts. Errors are bounded and do not grow with the input. The exact paths are ``ranking.py``
and a plain ``count(distinct)``; these are a choice by name, never a fallback.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Registers are 2^LG_K; one standard deviation of the relative error is below 1.04 / sqrt(2^LG_K).
LG_K = 12
#: Items of a level; the rank error is below RANK_ERROR[k] with 99 % confidence.
KLL_K = 400


def distinct_error(lg_k: int = LG_K, deviations: float = 4.0) -> float:
    """Bound of the relative error of a distinct count at so many standard deviations."""
    return deviations * 1.04 / math.sqrt(1 << lg_k)


def rank_error(k: int = KLL_K) -> float:
    """Bound of the normalised rank error of a quantile (double-sided, 99 % confidence) of a sketch of size ``k``."""
    return 2.446 / k**0.9433


def distinct_sketches(df: DataFrame, by: Sequence[str], value: Column, lg_k: int = LG_K) -> DataFrame:
    """by..., rows, sketch: one sketch of the different values of every group; NULL values do not count."""
    # a sketch takes text or whole numbers; a group of NULLs alone has an empty sketch
    return df.groupBy(*by).agg(F.count("*").alias("rows"), F.hll_sketch_agg(value, lg_k).alias("sketch"))


def merged_distinct(sketches: DataFrame, by: Sequence[str], name: str = "distinct_values") -> DataFrame:
    """by..., rows, ``name``: the estimate over all sketches of a group, merged before and after the shuffle."""
    merged = sketches.groupBy(*by).agg(F.sum("rows").alias("rows"), F.hll_union_agg("sketch").alias("sketch"))
    return merged.select(*by, "rows", F.hll_sketch_estimate("sketch").alias(name))


def in_windows(daily: DataFrame, day: str, as_of: str, windows: Sequence[int]) -> DataFrame:
    """Every daily row once for each look-back window (in days, up to and with ``as_of``) that holds its day."""
    age = F.date_diff(F.lit(as_of).cast("date"), F.col(day))
    held = F.filter(F.array(*[F.lit(w) for w in sorted(windows)]), lambda w: (age >= 0) & (age < w))
    return daily.withColumn("window_days", F.explode(held))


def quantile_sketches(df: DataFrame, by: Sequence[str], values: Mapping[str, Column], k: int = KLL_K) -> DataFrame:
    """by..., and for each name a sketch of its values: one aggregation, no sort. NULL and NaN values do not count."""

    def sketch(value: Column) -> Column:
        number = value.cast("double")
        return F.kll_sketch_agg_double(F.when(~F.isnan(number), number), k)

    return df.groupBy(*by).agg(*[sketch(v).alias(n) for n, v in values.items()])


def merged_quantiles(sketches: DataFrame, by: Sequence[str], quantiles: Mapping[str, tuple[str, float]], k: int = KLL_K) -> DataFrame:
    """by..., and for each name the quantile (sketch column, rank) over all sketches of a group; NULL without values."""
    columns = sorted({c for c, _ in quantiles.values()})
    merged = sketches.groupBy(*by).agg(*[F.kll_merge_agg_double(c, k).alias(c) for c in columns])

    def at(column: str, rank: float) -> Column:
        known = F.kll_sketch_get_n_double(column) > 0
        return F.when(known, F.kll_sketch_get_quantile_double(F.when(known, F.col(column)), F.lit(rank)))

    return merged.select(*by, *[at(c, q).alias(n) for n, (c, q) in quantiles.items()])


def approx_quantiles(df: DataFrame, by: Sequence[str], quantiles: Mapping[str, tuple[Column, float]], k: int = KLL_K) -> DataFrame:
    """by..., and for each name the approximate quantile (value, rank): the sketch counterpart of ``group_quantiles``."""
    sketches = quantile_sketches(df, by, {n: v for n, (v, _) in quantiles.items()}, k)
    return merged_quantiles(sketches, by, {n: (n, q) for n, (_, q) in quantiles.items()}, k)

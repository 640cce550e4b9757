"""Quality gates and data checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions.columns import half_even, ratio
from bazaarlens.operators.ranking import group_quantiles
from bazaarlens.session import settle


def compare_totals(before: DataFrame, after: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Two sums per key, NULL a key like any other; a key missing on one side counts as zero there."""
    left = before.select(*keys, F.col(value).alias("_before"), F.lit(None).alias("_after"))
    right = after.select(*keys, F.lit(None).alias("_before"), F.col(value).alias("_after"))
    total = lambda c: F.coalesce(F.sum(c).cast("double"), F.lit(0.0))
    return left.unionByName(right).groupBy(*keys).agg(total("_before").alias("before"), total("_after").alias("after"))


def revenue_drift(
    before: DataFrame, after: DataFrame, key: str = "partner_category", value: str = "revenue", limit_pct: float = 5.0
) -> DataFrame:
    """Change in percent per category; a zero baseline gives NULL and no flag."""
    rows = compare_totals(before, after, [key], value)
    # the quotient is scaled after the division, as published results are
    diff = half_even(ratio(F.col("after") - F.col("before"), "before") * 100, 2)
    return rows.withColumn("diff_pct", diff).withColumn(
        "flagged", F.coalesce(F.abs("diff_pct") > limit_pct, F.lit(False))
    )


def validate_combos(
    df: DataFrame, combo: str = "combo_id", coefficient: str = "coefficient_in_combo", tolerance: float = 0.01
) -> DataFrame:
    """At least two rows and coefficients that sum to one."""
    sums = df.groupBy(combo).agg(
        F.count(coefficient).alias("n_rows"), F.sum(F.col(coefficient).cast("decimal(18,6)")).cast("double").alias("coef_sum")
    )
    return sums.withColumn("ok", (F.col("n_rows") >= 2) & (F.abs(F.col("coef_sum") - 1.0) <= tolerance))


def reconcile_totals(source: DataFrame, merged: DataFrame, keys: Sequence[str], value: str, limit_pct: float = 1.0) -> DataFrame:
    """Source against merged totals with the gap in percent."""
    rows = compare_totals(source, merged, keys, value)
    return rows.withColumn("gap_pct", half_even(ratio(F.col("after") - F.col("before"), "before") * 100, 4)).withColumn(
        "ok", F.coalesce(F.abs("gap_pct") <= limit_pct, F.col("after") == 0)
    )


def verdict(df: DataFrame, check: str, good: Column) -> DataFrame:
    """(check, rows, failures, passed) of one check."""
    return df.agg(
        F.lit(check).alias("check"),
        F.count("*").alias("n_rows"),
        F.count_if(~F.coalesce(good, F.lit(False))).alias("failures"),
    ).withColumn("passed", F.col("failures") == 0)


def qc_gate(*verdicts: DataFrame) -> DataFrame:
    """All verdicts plus the gate row, which passes only when every check passes."""
    rows = reduce(DataFrame.unionByName, verdicts)
    gate = rows.agg(
        F.lit("GATE").alias("check"),
        F.sum("n_rows").alias("n_rows"),
        F.sum("failures").alias("failures"),
        F.bool_and("passed").alias("passed"),
    )
    return rows.unionByName(gate)


def volume_check(df: DataFrame, day: Column, expected: DataFrame, tolerance: float = 0.2) -> DataFrame:
    """Rows per period against the expected number (period, expected)."""
    counts = df.groupBy(day.alias("period")).agg(F.count("*").alias("n_rows"))
    rows = counts.join(expected, "period", "full")
    n = F.coalesce("n_rows", F.lit(0))
    gap = ratio(n - F.col("expected"), "expected")
    return rows.select("period", n.alias("n_rows"), "expected", gap.alias("gap"), F.coalesce(F.abs(gap) <= tolerance, F.lit(False)).alias("ok"))


def id_check(df: DataFrame, key: str) -> DataFrame:
    """Rows without an id and surplus rows of repeated ids."""
    per_id = df.groupBy(key).agg(F.count("*").alias("_n"))
    missing = F.col(key).isNull()
    return per_id.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(missing, F.col("_n"))), F.lit(0)).alias("missing_ids"),
        F.coalesce(F.sum(F.when(~missing, F.col("_n") - 1)), F.lit(0)).alias("duplicate_rows"),
    )


def profile_nulls_outliers(df: DataFrame, columns: Sequence[str], fence: float = 1.5) -> DataFrame:
    """NULL rate and rows outside the quartile fences, one row per column.

    The rows are read once: equal values are counted, and all figures come from the counts. The quartiles are exact and
    never gather a column in one task.
    """
    values = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    counts = settle(df.select(F.inline(values)).groupBy("column", "value").agg(F.count("*").alias("n")), "profile")
    quart = group_quantiles(counts, ["column"], {"q1": (F.col("value"), 0.25), "q3": (F.col("value"), 0.75)}, weight="n")
    low = F.col("q1") - fence * (F.col("q3") - F.col("q1"))
    high = F.col("q3") + fence * (F.col("q3") - F.col("q1"))
    rows = lambda when: F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0))
    # one row per profiled column
    return (
        counts.join(F.broadcast(quart), "column", "left")
        .groupBy("column")
        .agg(
            F.sum("n").alias("n_rows"),
            ratio(rows(F.col("value").isNull()), F.sum("n")).alias("null_rate"),
            F.max("q1").alias("q1"),
            F.max("q3").alias("q3"),
            rows((F.col("value") < low) | (F.col("value") > high)).alias("outliers"),
        )
    )


def agg_vs_detail(aggregate: DataFrame, detail: DataFrame, keys: Sequence[str], value: str, tolerance: float = 0.01) -> DataFrame:
    """Keys whose stored aggregate differs from the sum of the detail rows."""
    rows = compare_totals(aggregate, detail, keys, value)
    return rows.withColumn("ok", F.abs(F.col("before") - F.col("after")) <= tolerance)


def spot_sample(df: DataFrame, ids: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """n rows in hash order: random, but the same every time. A sample is the feature here."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in ids])
    return df.withColumn("_h", F.md5(text.cast("binary"))).orderBy("_h", *ids).limit(n).drop("_h")

"""Market master, combos, periods, shares and the monthly monitor."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bazaarlens.functions.columns import cascade, ratio
from bazaarlens.operators.ranking import join_same
from bazaarlens.session import settle

# Brand texts that stand for no brand.
FUZZY_BRANDS = ["Undefined", "No Brand", "Unknown", "Other", ""]


def allocate_combo(sales: DataFrame, combos: DataFrame, on: str = "combo_id", value: str = "revenue") -> DataFrame:
    """Split a combo's revenue over its parts by coefficient; single items keep theirs."""
    parts = combos.select(on, "partner_category", "coefficient_in_combo")
    share = F.coalesce(F.col("coefficient_in_combo"), F.lit(1.0))
    return sales.join(parts, on, "left").withColumn("allocated", F.col(value).cast("double") * share)


def _finished(spark: SparkSession, path: str) -> bool:
    """The committer's marker; readers hide it, so the file system is asked."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def build_period(
    spark: SparkSession, out: str, period: str, build: Callable[[str], DataFrame], resume: bool = True
) -> bool:
    """Write one period's partition; with ``resume`` a finished partition is left alone.

    Returns whether the partition was written.
    """
    path = f"{out}/period={period}"
    if resume and _finished(spark, path):
        return False
    build(period).write.mode("overwrite").parquet(path)
    return True


def build_periods(
    df: DataFrame, out: str, period: Column, build: Callable[[DataFrame], DataFrame], periods: Sequence[str], resume: bool = True
) -> list[str]:
    """Write the partitions of many periods in one pass; with ``resume`` finished ones are left alone.

    ``build`` aggregates a frame that has the column ``period`` and must keep it. Returns the periods that were
    written. A marker beside the partitions says that a period is finished, also if it has no rows.
    """
    spark = df.sparkSession
    todo = [p for p in periods if not (resume and _finished(spark, f"{out}/_done/{p}"))]
    if todo:
        rows = build(df.withColumn("period", period).filter(F.col("period").isin(todo)))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period").parquet(out)
        for p in todo:
            _mark(spark, f"{out}/_done/{p}")
    return todo


def _mark(spark: SparkSession, path: str) -> None:
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    marker.getFileSystem(spark._jsc.hadoopConfiguration()).create(marker, True).close()


def in_months(df: DataFrame, months: Sequence[str]) -> DataFrame:
    """Rows of the months (MM/yyyy). Where ``df`` has the raw date as ``period``, the scan is given its ranges."""
    if "period" not in df.columns:
        return df.filter(F.col("time").isin(list(months)))
    kind = df.schema["period"].dataType
    day, hit = F.col("period"), F.lit(False)
    for m in months:
        month, year = map(int, m.split("/"))
        first, end = f"{year}-{month:02d}-01", f"{year + month // 12}-{month % 12 + 1:02d}-01"
        hit = hit | ((day >= F.lit(first).cast(kind)) & (day < F.lit(end).cast(kind)))
    return df.filter(hit)


def market_share(df: DataFrame, within: Sequence[str], dims: Sequence[str], value: str = "sales") -> DataFrame:
    """Sum per ``within`` + ``dims`` and its share of the ``within`` total.

    Both sums are combined before their shuffles; totals join back, so no window holds a
    whole market. Rows of a NULL group are a market of their own.
    """
    keys = [*within, *dims]
    sums = df.groupBy(*keys).agg(F.sum(value).alias("_sum"))
    totals = sums.groupBy(*within).agg(F.sum("_sum").alias("_total"))
    return join_same(sums, totals, within).select(
        *keys, F.col("_sum").cast("double").alias(value), ratio("_sum", "_total").alias("share")
    )


def top_sellers(df: DataFrame, within: Sequence[str], dim: str, n: int = 1, value: str = "sales") -> DataFrame:
    """The n best sellers per group with their position."""
    sums = df.groupBy(*within, dim).agg(F.sum(value).alias(value))
    w = Window.partitionBy(*within).orderBy(F.desc(value), F.asc(dim))
    return sums.withColumn("position", F.row_number().over(w)).filter(F.col("position") <= n)


def _two_months(df: DataFrame, dim: str, new: str, prev: str) -> DataFrame:
    pivot = in_months(df, [prev, new]).groupBy(dim).pivot("time", [prev, new]).agg(F.sum("sales"))
    return pivot.select(
        dim,
        F.coalesce(F.col(f"`{prev}`").cast("double"), F.lit(0.0)).alias("prev"),
        F.coalesce(F.col(f"`{new}`").cast("double"), F.lit(0.0)).alias("new"),
    ).withColumn("mom", ratio(F.col("new") - F.col("prev"), "prev"))


def fuzzy(brand: str = "brand") -> Column:
    return F.coalesce(F.col(brand).isin(FUZZY_BRANDS), F.lit(False))


def undefined_spike(df: DataFrame, new: str, prev: str, share_limit: float = 0.15, drift_warn: float = 0.3) -> DataFrame:
    """Share of undefined brands in both months and the verdict for the new one."""
    def total(month: str, only_fuzzy: bool) -> Column:
        cond = F.col("time") == month
        return F.coalesce(F.sum(F.when(cond & fuzzy() if only_fuzzy else cond, F.col("sales"))).cast("double"), F.lit(0.0))

    sums = in_months(df, [new, prev]).agg(
        total(new, True).alias("undefined_new"),
        total(prev, True).alias("undefined_prev"),
        total(new, False).alias("total_new"),
        total(prev, False).alias("total_prev"),
    )
    out = sums.select(
        "*",
        F.coalesce(ratio("undefined_new", "total_new"), F.lit(0.0)).alias("share_new"),
        F.coalesce(ratio("undefined_prev", "total_prev"), F.lit(0.0)).alias("share_prev"),
        F.coalesce(ratio(F.col("undefined_new") - F.col("undefined_prev"), "undefined_prev"), F.lit(float("inf"))).alias("mom"),
    )
    return out.withColumn(
        "status", cascade([(F.col("share_new") > share_limit, "ALERT"), (F.col("mom") > drift_warn, "WARNING")], "OK")
    )


def brand_debut(df: DataFrame, new: str) -> DataFrame:
    """Brands seen in the new month only, with revenue and market share."""
    now = df.filter(F.col("time") == new)
    seen = df.filter(F.col("time") != new).select(F.col("brand").alias("_seen")).distinct()
    sums = now.groupBy("time", "brand").agg(F.sum("sales").alias("_s"))
    total = sums.groupBy("time").agg(F.sum("_s").alias("_t"))
    return (
        sums.join(seen, F.col("brand").eqNullSafe(F.col("_seen")), "left_anti")
        .join(total, "time")
        .select("brand", F.col("_s").cast("double").alias("sales"), ratio("_s", "_t").alias("share"))
    )


def brand_drift(
    df: DataFrame, new: str, prev: str, min_revenue: float = 1e8, warn: float = 0.3, alert: float = 0.6
) -> DataFrame:
    """Defined brands with a significant previous month that fell or rose sharply."""
    rows = _two_months(df, "brand", new, prev).filter(~fuzzy() & (F.col("prev") >= min_revenue))
    mom = F.col("mom")
    status = cascade([(mom < -alert, "ALERT"), (mom < -warn, "WARNING"), (mom > alert, "SPIKE")], "OK")
    return rows.withColumn("status", status)


def platform_mom(df: DataFrame, new: str, prev: str) -> DataFrame:
    """Both months per platform and for the whole market."""
    both = F.explode(F.array(F.col("platform"), F.lit("ALL")))
    return _two_months(df.withColumn("platform", both), "platform", new, prev)


def monitor_summary(df: DataFrame, new: str, prev: str, **limits) -> DataFrame:
    """One row per issue of the month; no rows means the report can go out.

    The market is read once: all checks use its sums by brand and month, which are written in between.
    """
    keys = ["brand", "time", *(["period"] if "period" in df.columns else [])]
    if "period" in keys:  # any day of the month stands for it
        df = df.withColumn("period", F.trunc("period", "MM").cast(df.schema["period"].dataType))
    df = settle(df.groupBy(*keys).agg(F.sum("sales").alias("sales")), "months")
    spike = undefined_spike(df, new, prev).filter(F.col("status") != "OK")
    drift = brand_drift(df, new, prev, **limits).filter(F.col("status") != "OK")
    return (
        spike.select(F.lit("undefined").alias("check"), "status", F.lit("Undefined").alias("item"), F.col("share_new").alias("value"))
        .unionByName(brand_debut(df, new).select(F.lit("debut").alias("check"), F.lit("NEW").alias("status"), F.col("brand").alias("item"), F.col("share").alias("value")))
        .unionByName(drift.select(F.lit("drift").alias("check"), "status", F.col("brand").alias("item"), F.col("mom").alias("value")))
    )


def go_no_go(issues: DataFrame) -> DataFrame:
    return issues.agg(F.count("*").alias("issues")).withColumn("go", F.col("issues") == 0)

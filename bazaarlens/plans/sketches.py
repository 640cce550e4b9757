"""Sketch queries. Estimates differ from the exact values of the checks, so each row says whether it keeps its bound."""

from __future__ import annotations

from pyspark.sql import functions as F

from bazaarlens.functions.columns import ratio
from bazaarlens.operators import sketches as sk
from bazaarlens.plans.registry import query
from bazaarlens.session import settle
from bazaarlens.sources.tables import table

WINDOWS = (14, 30, 90)


@query(
    "ag2_approx",
    f"""SELECT w AS window_days, o_orderstatus AS status, count(*) AS orders, count(DISTINCT o_custkey) AS customers, true AS within
        FROM orders, (SELECT unnest({list(WINDOWS)})::INT AS w), (SELECT max(o_orderdate)::DATE AS last FROM orders)
        WHERE date_diff('day', o_orderdate::DATE, last) < w GROUP BY ALL""",
)
def ag2_approx(spark, sf):
    """Customers of 14, 30 and 90 days from one table of daily sketches, next to the exact numbers."""
    orders = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("day"), F.col("o_orderstatus").alias("status"), "o_custkey")
    last = str(orders.agg(F.max("day")).first()[0])
    daily = settle(sk.distinct_sketches(orders, ["day", "status"], F.col("o_custkey")), "daily-customers")
    by = ["window_days", "status"]
    found = sk.merged_distinct(sk.in_windows(daily, "day", last, WINDOWS), by, "estimate").withColumnRenamed("rows", "orders")
    exact = sk.in_windows(orders, "day", last, WINDOWS).groupBy(*by).agg(F.countDistinct("o_custkey").alias("customers"))
    close = F.abs(F.col("estimate") - F.col("customers")) <= sk.distinct_error() * F.col("customers")
    return found.join(exact, by).select(*by, "orders", "customers", close.alias("within"))


def _ranks_hold(rows, found, by, value, names):
    """Per group its rows, and whether every quantile lies within the rank error."""
    n = F.count("v")
    checks = []
    for name, q in names.items():
        below, upto = F.count_if(F.col("v") < F.col(name)), F.count_if(F.col("v") <= F.col(name))
        checks.append((below <= (q + sk.rank_error()) * n + 1) & (upto >= (q - sk.rank_error()) * n - 1))
    good = checks[0]
    for c in checks[1:]:
        good = good & c
    return rows.select(*by, value.alias("v")).join(found, by).groupBy(*by).agg(n.alias("known"), good.alias("within"))


@query(
    "ag10_approx",
    "SELECT l_suppkey, count(l_extendedprice / nullif(l_quantity, 0)) FILTER (l_discount > 0.02) AS known, true AS within FROM lineitem GROUP BY 1 HAVING known > 0",
)
def ag10_approx(spark, sf):
    """Conditional medians and upper quartiles per supplier by one aggregation."""
    value = F.when(F.col("l_discount") > 0.02, ratio("l_extendedprice", "l_quantity"))
    rows = table(spark, sf, "lineitem").withColumn("value", value)
    found = settle(sk.approx_quantiles(rows, ["l_suppkey"], {"mid": (F.col("value"), 0.5), "high": (F.col("value"), 0.75)}), "approx-medians")
    return _ranks_hold(rows, found, ["l_suppkey"], F.col("value"), {"mid": 0.5, "high": 0.75}).filter("known > 0")


@query(
    "ag18_approx",
    "SELECT l_returnflag, count(l_extendedprice) AS known, true AS within FROM lineitem GROUP BY 1",
)
def ag18_approx(spark, sf):
    """Quantiles of large groups, merged from sketches of every shipping day."""
    rows = table(spark, sf, "lineitem").withColumn("day", F.col("l_shipdate").cast("date"))
    daily = settle(sk.quantile_sketches(rows, ["day", "l_returnflag"], {"price": F.col("l_extendedprice")}), "daily-prices")
    found = settle(sk.merged_quantiles(daily, ["l_returnflag"], {"low": ("price", 0.05), "mid": ("price", 0.5), "high": ("price", 0.75)}), "merged-prices")
    return _ranks_hold(rows, found, ["l_returnflag"], F.col("l_extendedprice"), {"low": 0.05, "mid": 0.5, "high": 0.75})

"""Sketches keep their error bounds, also after merging, and count nothing that is NULL."""

import random

import pytest
from pyspark.sql import functions as F

from bazaarlens.operators import sketches as sk


def test_daily_sketches_give_any_window(spark):
    rows = spark.range(200_000).selectExpr("date_add(date'2026-01-01', cast(id % 60 as int)) day", "if(id % 3 = 0, 'hot', concat('g', id % 7)) g", "nullif((id * id) % 30011, 0) v")
    daily = sk.distinct_sketches(rows, ["day", "g"], F.col("v"))
    found = sk.merged_distinct(sk.in_windows(daily, "day", "2026-02-20", (7, 30, 90)), ["window_days", "g"], "n")
    exact = sk.in_windows(rows, "day", "2026-02-20", (7, 30, 90)).groupBy("window_days", "g").agg(F.countDistinct("v").alias("exact"), F.count("*").alias("m"))
    got = found.join(exact, ["window_days", "g"]).collect()
    assert len(got) == 24
    for r in got:
        assert abs(r.n - r.exact) <= sk.distinct_error() * r.exact and r.rows == r.m, r


def test_windows_end_with_their_day(spark):
    days = spark.createDataFrame([("2026-01-10",), ("2026-01-04",), ("2026-01-03",), ("2026-01-11",)], "d string").selectExpr("date(d) day")
    assert sorted((r.day.day, r.window_days) for r in sk.in_windows(days, "day", "2026-01-10", (7, 1)).collect()) == [(4, 7), (10, 1), (10, 7)]


@pytest.mark.parametrize("k", [200, 400])
def test_rank_errors(spark, k):
    rng = random.Random(k)
    rows = [(g, rng.choice([rng.gauss(0, 1), float(rng.randrange(5))])) for g in ("a", "b", "c") for _ in range({"a": 40_000, "b": 500, "c": 3}[g])]
    df = spark.createDataFrame([*rows, ("a", None), ("b", float("nan")), ("n", None)], "g string, v double").repartition(7)
    marks = {f"q{int(q * 100)}": q for q in (0.05, 0.25, 0.5, 0.95)}
    got = {r.g: r for r in sk.approx_quantiles(df, ["g"], {n: (F.col("v"), q) for n, q in marks.items()}, k).collect()}
    assert set(got) == {"a", "b", "c", "n"} and all(got["n"][n] is None for n in marks)
    for g in ("a", "b", "c"):
        values = sorted(v for h, v in rows if h == g)
        for name, q in marks.items():
            x, n = got[g][name], len(values)
            below, upto = sum(v < x for v in values), sum(v <= x for v in values)
            assert below <= (q + sk.rank_error(k)) * n + 1 and upto >= (q - sk.rank_error(k)) * n - 1


def test_one_aggregation_without_a_range_sort(spark):
    df = spark.range(10).selectExpr("id % 2 g", "cast(id as double) v")
    plan = sk.quantile_sketches(df, ["g"], {"v": F.col("v")})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "rangepartitioning" not in plan and "partial_kll" in plan

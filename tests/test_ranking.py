"""Spread ranks, quantiles and numbering against brute force, with a hot group and hot values."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from bazaarlens.operators import ranking
from bazaarlens.operators.quality import profile_nulls_outliers
from bazaarlens.operators.ranking import group_quantiles


@pytest.fixture(scope="module")
def skewed():
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        g = "hot" if i % 3 == 0 else f"g{rng.randrange(40)}"
        v = rng.choice([0.0, 0.0, 1.5, rng.uniform(-5, 5), rng.uniform(0, 1e-4), rng.uniform(0, 1e9), None])
        rows.append((i, g, v))
    return pd.DataFrame(rows, columns=["id", "g", "v"])


def frame(spark, pdf):
    return spark.createDataFrame([(int(a), b, None if pd.isna(c) else float(c)) for a, b, c in pdf.itertuples(index=False)], "id long, g string, v double")


def test_rank(spark, skewed):
    got = ranking.rank_within(frame(spark, skewed), ["id"], ["g"], {"rk": "v"}, "n").toPandas().set_index("id").sort_index()
    want = skewed.groupby("g")["v"].rank(method="min", na_option="bottom").astype(int)
    assert (got["rk"].to_numpy() == want.to_numpy()).all()
    assert (got["n"].to_numpy() == skewed.groupby("g")["id"].transform("size").to_numpy()).all()


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.75, 0.9, 1.0])
def test_quantiles(spark, skewed, q):
    df = frame(spark, skewed).withColumn("w", F.when(F.col("v") > 0, F.col("v")))
    got = ranking.group_quantiles(df, ["g"], {"a": (F.col("v"), q), "b": (F.col("w"), q)}).toPandas().set_index("g")
    want_a = skewed.groupby("g")["v"].quantile(q)
    want_b = skewed[skewed["v"] > 0].groupby("g")["v"].quantile(q)
    assert len(got) == skewed["g"].nunique()
    for g in got.index:
        assert np.isclose(got.loc[g, "a"], want_a[g], rtol=1e-12)
        assert np.isclose(got.loc[g, "b"], want_b[g], rtol=1e-12)


def test_ranks_like_spark_s(spark):
    """NULL, NaN, infinities, signed zeros and a NULL group."""
    values = [None, None, float("nan"), float("nan"), float("inf"), float("-inf"), 0.0, -0.0, 1.5, 1.5, -2.0]
    rows = [(i, ("a", "b", None)[i % 3], v) for i, v in enumerate(values * 3)]
    df = spark.createDataFrame(rows, "id long, g string, v double")
    want = df.withColumn("rk", F.rank().over(Window.partitionBy("g").orderBy(F.asc_nulls_last("v")))).select("id", "rk")
    got = ranking.rank_within(df, ["id"], ["g"], {"rk": "v"}, "n").select("id", "rk")
    assert sorted(got.collect()) == [(i, int(r)) for i, r in sorted(want.collect())]


def test_groups_of_nulls_stay(spark):
    df = spark.createDataFrame([("x", None)] * 20 + [("y", 1.0), ("y", None)], "g string, v double")
    assert sorted(map(tuple, ranking.group_quantiles(df, ["g"], {"m": (F.col("v"), 0.5)}).collect())) == [("x", None), ("y", 1.0)]


def test_close_values_are_spread(spark):
    """100,000 values of one group within 0.0001 go to several tasks."""
    df = spark.range(100_000).select(F.lit("g").alias("g"), (F.lit(0.5) + F.col("id") * 1e-9).alias("_v"))
    parts = []
    keep = ranking.settle

    def spy(frame, name):
        out = keep(frame, name)
        parts.extend(r["n"] for r in out.groupBy("_part").agg(F.count("*").alias("n")).collect())
        return out

    ranking.settle = spy
    try:
        got = ranking.group_quantiles(df, ["g"], {"m": (F.col("_v"), 0.5)}).first()
    finally:
        ranking.settle = keep
    assert abs(got.m - (0.5 + 49_999.5e-9)) < 1e-12
    assert len(parts) >= 4 and max(parts) < 50_000


def test_numbered(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    got = ranking.numbered(df, ["k"], "p", 1).toPandas()
    assert sorted(got["p"]) == list(range(1, 5001)) and set(got["p_of"]) == {5000}


@pytest.mark.parametrize("seed", range(2))
def test_weighted_quantiles_and_profile(spark, seed):
    """Counted values give what the rows give, and the profile what pandas finds."""
    pick = random.Random(seed)
    rows = [(pick.choice([None, 1.0, 2.0, 2.0, 50.0, pick.random() * 9]), pick.choice([None, 7])) for _ in range(300)]
    df = spark.createDataFrame([(*r, None) for r in rows], "a double, b int, c double")
    counts = df.groupBy("b", "a").agg(F.count("*").alias("n"))
    of = {"low": (F.col("a"), 0.1), "high": (F.col("a"), 0.9)}
    plain, weighted = (sorted(map(tuple, x.collect()), key=str) for x in (group_quantiles(df, ["b"], of), group_quantiles(counts, ["b"], of, weight="n")))
    assert plain == weighted and len(plain) == 2
    got = {r["column"]: r for r in profile_nulls_outliers(df, ["a", "b", "c"]).collect()}
    for i, name in enumerate("ab"):
        known = pd.Series([r[i] for r in rows if r[i] is not None], dtype=float)
        q1, q3 = known.quantile(0.25), known.quantile(0.75)
        out = ((known < q1 - 1.5 * (q3 - q1)) | (known > q3 + 1.5 * (q3 - q1))).sum()
        r = got[name]
        assert (r.n_rows, r.outliers) == (300, out) and r.null_rate == pytest.approx(1 - len(known) / 300)
        assert (r.q1, r.q3) == (pytest.approx(q1), pytest.approx(q3))
    assert (got["c"].n_rows, got["c"].null_rate, got["c"].q1, got["c"].outliers) == (300, 1.0, None, 0)
    assert profile_nulls_outliers(df.limit(0), ["a"]).count() == 0

"""NULL as a key: a group of its own wherever groups are compared, shared or inserted."""

from pyspark.sql import functions as F

from bazaarlens.operators import live, market, quality, search
from bazaarlens.operators.cascade import dictionary_vote
from bazaarlens.sources import sinks


def test_share_of_a_null_group(spark):
    rows = spark.createDataFrame([("c", "x", 1), (None, "x", 2), (None, None, 6)], "partner_category string, brand string, sales int")
    got = {(r.partner_category, r.brand): r.share for r in market.market_share(rows, ["partner_category"], ["brand"]).collect()}
    assert got == {("c", "x"): 1.0, (None, "x"): 0.25, (None, None): 0.75}


def test_equal_builds_do_not_drift(spark):
    rows = spark.createDataFrame([("c", 5.0), (None, 7.0), (None, None)], "partner_category string, revenue double")
    got = quality.revenue_drift(rows, rows).collect()
    assert sorted((str(r.partner_category), r.before, r.after, r.diff_pct, r.flagged) for r in got) == [("None", 7.0, 7.0, 0.0, False), ("c", 5.0, 5.0, 0.0, False)]
    other = rows.filter("revenue = 7").select("partner_category", F.col("revenue").cast("decimal(9,2)").alias("revenue"))
    assert {(r.partner_category, r.before, r.after) for r in quality.compare_totals(rows, other, ["partner_category"], "revenue").collect()} == {("c", 5.0, 0.0), (None, 7.0, 7.0)}


def test_unknown_keyword_keeps_its_share(spark):
    rows = [(None, "a", "1"), (None, "a", "2"), (None, None, "3"), ("k", "b", "4"), ("k", "a", "5"), ("k", "a", "6")]
    df = spark.createDataFrame(rows, "key_word string, brand string, product_base_id string")
    got = {(r.key_word, r.brand): r.products for r in search.search_share(df).collect()}
    assert got == {(None, "a"): 2, (None, "No Brand"): 1, ("k", "b"): 1, ("k", "a"): 2}
    gaps = {r.key_word: (r.leader, r.own_share) for r in search.keyword_gaps(df, "No Brand").collect()}
    assert gaps[None] == ("a", 1 / 3) and gaps["k"] == ("a", 0.0)


def test_insert_of_null_keys(spark, tmp_path):
    rows = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k int, v int")
    for _ in range(3):
        sinks.insert_new(rows, str(tmp_path / "t"), ["k"], [F.asc("v")])
    assert sorted((str(r.k), r.v) for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [("1", 3), ("None", 1)]


def test_a_term_votes_once(spark):
    posts = spark.createDataFrame([("p", ["x", "y"])], "id string, terms array<string>")
    words = spark.createDataFrame([("x", "A", "a", 1.0), ("x", "A", "a", 1.0), ("x", "A", "a", 0.5), ("y", "B", "b", 1.5)], "term string, category_l1 string, category_l2 string, weight double")
    assert dictionary_vote(posts, "id", "terms", words).first().category_l1 == "B"


def test_months_without_a_brand(spark):
    rows = [("k", "a", "1", "2026-01-03"), ("k", "b", "2", "2026-01-09"), ("k", "a", "3", "2026-03-01"), ("k", "b", "4", "2026-05-01"), (None, "a", "1", "2026-02-01"), ("k", "a", "9", None)]
    df = spark.createDataFrame(rows, "key_word string, brand string, product_base_id string, created string")
    got = {(r.key_word, r.brand, r.month.month): (r.products, r.total, r.share, r.change) for r in search.search_share_months(df, F.col("created")).collect()}
    assert len(got) == 11 and got[None, "a", 2] == (1, 1, 1.0, None)
    assert got["k", "b", 1] == (1, 2, 0.5, None) and got["k", "b", 3] == (0, 1, 0.0, None)
    # nothing of the keyword was seen in February and April
    assert got["k", "a", 2] == (0, 0, None, None) and got["k", "a", 3] == (1, 1, 1.0, None)
    dense = spark.createDataFrame([("k", "a", str(i), f"2026-0{i + 1}-01") for i in range(3)] + [("k", "b", "x", "2026-01-01"), ("k", "b", "x", "2026-03-01")], df.schema)
    change = {(r.brand, r.month.month): r.change for r in search.search_share_months(dense, F.col("created")).collect()}
    assert change["b", 2] == -0.5 and change["b", 3] == 0.5


def test_minutes_are_dense(spark):
    rows = [("s", 59_999, 1, 0.1, 5), ("s", 60_000, 2, 0.2, None), ("s", 100_000, 3, 0.3, 9), ("s", 100_000, 1, None, 7), ("s", 240_500, 4, 0.4, None), (None, 0, 1, 1.0, 1), ("s", None, 9, 9.0, 9)]
    df = spark.createDataFrame(rows, "session_id string, bucket_time_ms long, views long, placed_sales double, ccu long")
    got = {(r.session_id, r.bucket_time_ms // 60_000): (r.buckets, r.views, r.placed_sales, r.ccu) for r in live.resample_minutes(df, ("views", "placed_sales"), ("ccu",)).collect()}
    assert got == {("s", 0): (1, 1, 0.1, 5), ("s", 1): (3, 6, 0.5, 9), ("s", 2): (0, 0, 0.0, 9), ("s", 3): (0, 0, 0.0, 9), ("s", 4): (1, 4, 0.4, 9), (None, 0): (1, 1, 1.0, 1)}

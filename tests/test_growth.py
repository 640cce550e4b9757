"""Work that must not grow with what the tables repeat: plans and results of the steps that were mended for it."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from bazaarlens.operators import cascade as cas
from bazaarlens.operators import classify, creators, ranking


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_votes_are_not_dealt_by_post(spark):
    """Each term stands for many categories; only the found terms of a post are shuffled by its key."""
    posts = spark.createDataFrame([(i, ["bolt", "x"] if i % 2 else ["rod", "bolt"]) for i in range(40)] + [(None, ["rod"]), (7, ["rod"]), (99, ["x"])], "id long, terms array<string>")
    words = spark.createDataFrame([(t, f"L{i % 3}", f"M{i}", float(i % 5 + (t == "rod"))) for t in ("bolt", "rod") for i in range(30)], "term string, category_l1 string, category_l2 string, weight double")
    voted = cas.dictionary_vote(posts, "id", "terms", words)
    assert not re.search(r"hashpartitioning\(id#\d+L?, category_l1", plan(voted))
    # every post found the same favourites, the six categories of the largest weight
    assert sorted(voted.collect(), key=str) == sorted([(i, "L0", "Unknown", True) for i in [*range(40), None]], key=str)


def test_tags_are_not_broadcast(spark, tmp_path):
    """Packed tag tables look small to Spark; the joins on the posts' key must not send them through the driver."""
    guess = spark.createDataFrame([(1, "A"), (2, "Unknown")], "post_base_id long, category_l1 string")
    truth = spark.createDataFrame([(1, "A")], "post_base_id long, category_l1 string")
    truth.write.parquet(f"{tmp_path}/truth")
    quality = cas.tag_quality(guess, spark.read.parquet(f"{tmp_path}/truth"))
    assert "BroadcastHashJoin" not in plan(quality)
    assert quality.first()[:4] == (2, 1, 0.5, 1.0)


def test_many_groups(spark):
    """Small groups meet in one row, larger ones by range; both give the quantiles of group_quantiles."""
    rows = [(g, float("nan") if g == 3 and i == 0 else float((i * 7) % 11) if (i + (g or 0)) % 5 else None) for g in (1, 2, 3, None) for i in range(40 if g == 2 else 9)]
    df = spark.createDataFrame([*rows, (5, None)], "g int, v double")
    of = {"low": (F.col("v"), 0.25), "mid": (F.col("v"), 0.5), "top": (F.col("v") * 2, 1.0)}
    want = sorted(map(str, ranking.group_quantiles(df, ["g"], of).collect()))
    for most in (0, 10, 1000):
        assert sorted(map(str, ranking.many_group_quantiles(df, ["g"], of, most).collect())) == want


def test_category_before_windows(spark):
    """A post's products are looked up once, whatever the number of windows."""
    day = F.expr("timestamp_ntz'2001-08-01' - make_dt_interval(days)")
    posts = spark.createDataFrame([(1, 1, 10, [1, 2, 2], 0), (2, 1, None, [9], 20), (3, 2, 5, [], 3), (4, None, 5, [1], 400)], "post_base_id long, channel_base_id long, view_count long, list_product_base_id array<long>, days int").withColumn("created_at_platform", day)
    products = spark.createDataFrame([(1, 1, "a"), (2, 2, "b")], "product_base_id long, categories__id_1 long, brand string")
    categories = spark.createDataFrame([("1", "A"), ("2", "B")], "category_id string, category_name string")
    got = creators.scoped_category(posts, products, categories, (7, 30), "2001-08-02")
    old = creators.video_dominant_category(creators.scope_windows(posts, (7, 30), "2001-08-02"), products, categories)
    assert sorted(got.collect(), key=str) == sorted(old.select(*got.columns).collect(), key=str)
    # no window deals the products any more
    assert not re.search(r"hashpartitioning\(window_days", plan(got))


def test_texts_are_not_dealt_by_label(spark):
    """A label's texts are cut to its cap in parts before they meet, and its support is judged after that."""
    rows = [(i, f"text {i % 70}", "a" if i % 4 else "b") for i in range(400)] + [(900, "one", "c"), (None, "late", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, label string").repartition(6)
    out = classify.balance_labels(df, ["doc_id"], 2, 20)
    first = {}
    for i, text, label in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        first.setdefault((label, text), i)
    want = [x for label in "ab" for x in sorted((i, label) for (of, _), i in first.items() if of == label)[:20]]
    assert sorted((r.doc_id, r.label) for r in out.collect()) == sorted(want)
    assert re.search(r"hashpartitioning\(label#\d+, _share#\d+", plan(out))

"""Hashtag, brand and dictionary views over videos."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.functions.columns import blank_to, has_any_tag, has_items, has_tag, matched_tags, on_days, trailing
from bazaarlens.operators.dedup import duplicate_rows, latest_by, limit_by, newest, require_keys
from bazaarlens.operators.lookups import dominant_category, linked
from bazaarlens.session import settle

CRAWL_ORDER = ("updated_at", "last_time_crawled_at", "view_count")


def day_videos(posts: DataFrame, day: str, days: int = 1) -> DataFrame:
    """Newest row per video of the day's crawl."""
    rows = require_keys(posts.filter(on_days("updated_at", day, days)), ["post_id_platform"])
    return latest_by(rows, ["post_id_platform"], newest(*CRAWL_ORDER))


def tagged_links(posts: DataFrame, day: str, days: int = 1) -> DataFrame:
    """Videos of the day with both products and hashtags, written once for their two readers."""
    rows = linked(day_videos(posts, day, days)).filter(has_items("hashtags"))
    return settle(rows.select("post_id_platform", "hashtags", "list_product_base_id"), "day-videos")


def _hashtag_counts(videos: DataFrame, labels: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Different videos per label and lower-cased hashtag.

    A video has one row, so distinct hashtags inside the row replace a distinct count:
    the plain count is combined before the shuffle and no hot hashtag gathers its videos.
    """
    tags = F.array_distinct(F.transform("hashtags", lambda h: F.lower(h)))
    return (
        videos.select("post_id_platform", tags.alias("_tags"))
        .join(labels, "post_id_platform")
        .select(*keys, F.explode("_tags").alias("hashtag"))
        .groupBy(*keys, "hashtag")
        .agg(F.count("*").alias("count_unique_video"))
    )


def hashtag_by_category(
    posts: DataFrame, products: DataFrame, categories: DataFrame, day: str, days: int = 1
) -> DataFrame:
    """Different videos per dominant category and hashtag."""
    videos = tagged_links(posts, day, days)
    labels = dominant_category(videos, products, categories, ["post_id_platform"])
    return _hashtag_counts(videos, labels, ["category"])


def hashtag_by_brand(
    posts: DataFrame, products: DataFrame, categories: DataFrame, day: str, days: int = 1
) -> DataFrame:
    """Different videos per dominant category, brand and hashtag."""
    videos = tagged_links(posts, day, days)
    labels = dominant_category(videos, products, categories, ["post_id_platform"], with_brand=True)
    return _hashtag_counts(videos, labels, ["category", "brand"])


def leaderboard(counts: DataFrame, k: tuple[int, int, int] = (5, 10, 20)) -> DataFrame:
    """Top categories, their top brands, and the brands' top hashtags.

    Ranks run on the aggregated counts; brand and category totals come from the counts too.
    """
    cats, brands, tags = k
    total = F.sum("count_unique_video").alias("_sum")
    by_brand = counts.groupBy("category", "brand").agg(total)
    by_cat = by_brand.groupBy("category").agg(F.sum("_sum").alias("_sum"))
    cat_rank = by_cat.select(
        "category", F.dense_rank().over(Window.orderBy(F.desc("_sum"))).alias("cat_rk")
    ).filter(F.col("cat_rk") <= cats)
    brand_w = Window.partitionBy("category").orderBy(F.desc("_sum"), F.asc("brand"))
    brand_rank = by_brand.select("category", "brand", F.row_number().over(brand_w).alias("brand_rk")).filter(
        F.col("brand_rk") <= brands
    )
    tag_w = Window.partitionBy("category", "brand").orderBy(F.desc("count_unique_video"), F.asc("hashtag"))
    tag_rank = counts.withColumn("hashtag_rk", F.row_number().over(tag_w)).filter(F.col("hashtag_rk") <= tags)
    return tag_rank.join(brand_rank, ["category", "brand"]).join(cat_rank, "category")


def hashtag_leaderboard(
    posts: DataFrame,
    products: DataFrame,
    categories: DataFrame,
    day: str,
    days: int = 1,
    k: tuple[int, int, int] = (5, 10, 20),
) -> DataFrame:
    # ranks, totals and tags all start from the counts
    return leaderboard(settle(hashtag_by_brand(posts, products, categories, day, days), "hashtag-counts"), k)


def videos_by_hashtag(posts: DataFrame, tag: str, as_of: str, days: int = 7) -> DataFrame:
    """Newest rows of the last days whose hashtags hold ``tag``."""
    rows = posts.filter(trailing("updated_at", days, as_of) & has_items("hashtags"))
    rows = latest_by(rows, ["post_id_platform"], newest(*CRAWL_ORDER))
    return rows.filter(has_tag("hashtags", tag))


def videos_by_brand(posts: DataFrame, products: DataFrame, brand: str, day: str, days: int = 1) -> DataFrame:
    """Videos that link products of a brand, with the set of those products.

    The empty brand is compared as '', so a search for 'Unknown' finds nothing.
    """
    videos = linked(day_videos(posts, day, days))
    match = products.filter(F.lower(F.coalesce("brand", F.lit(""))) == brand.lower()).select(
        "product_base_id", blank_to("brand", "Unknown").alias("brand")
    )
    hits = (
        videos.select("post_id_platform", F.explode(F.array_distinct("list_product_base_id")).alias("product_base_id"))
        .join(match, "product_base_id")
        .groupBy("post_id_platform")
        # the set is a part of one post's own product list
        .agg(F.max("brand").alias("brand"), F.array_sort(F.collect_set("product_base_id")).alias("product_base_ids"))
        .withColumn("product_count", F.size("product_base_ids").cast("bigint"))
    )
    return videos.join(hits, "post_id_platform")


def match_dictionary(posts: DataFrame, tags: Sequence[str], as_of: str, days: int = 90) -> DataFrame:
    """Videos whose hashtags meet a dictionary, with the matched tags and their number."""
    rows = posts.filter(trailing("created_at_platform", days, as_of) & has_items("hashtags"))
    rows = latest_by(rows, ["post_base_id"], newest(*CRAWL_ORDER))
    return (
        rows.filter(has_any_tag("hashtags", tags))
        .withColumn("has_product_link", has_items("list_product_base_id"))
        .withColumn("matched_tags", matched_tags("hashtags", tags))
        .withColumn("match_count", F.size("matched_tags").cast("bigint"))
    )


def crawl_duplicates(posts: DataFrame, after: str, min_count: int = 2) -> DataFrame:
    """All crawl rows after a moment of linked videos that were crawled repeatedly."""
    rows = linked(posts.filter(F.col("updated_at") > F.lit(after).cast("timestamp_ntz")))
    return duplicate_rows(rows, "post_id_platform", min_count)

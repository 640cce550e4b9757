"""Creator summaries, activity, tiers, percentiles and focus."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions.columns import cascade, follower_tier, half_even, has_items, on_days, ratio, since, trailing
from bazaarlens.operators.dedup import latest_by, limit_by, newest, require_keys
from bazaarlens.operators.lookups import dominant_category, explode_products, heaviest, linked, with_category
from bazaarlens.session import settle
from bazaarlens.operators.ranking import many_group_quantiles, percentile_of, rank_within

CRAWL_ORDER = ("updated_at", "last_time_crawled_at", "view_count")

# The niches that are ranked by default.
ALLOWED_NICHES = [
    "Chăm sóc sắc đẹp & Chăm sóc cá nhân",
    "Trang phục nữ & Đồ lót",
    "Trang phục nam & Đồ lót",
    "Đồ ăn & Đồ uống",
    "Trẻ sơ sinh & thai sản",
    "Đồ gia dụng",
    "Phụ kiện thời trang",
]
# Look-back windows in days.
WINDOWS = (14, 30, 90)


def attribute_views(posts: DataFrame, products: DataFrame, categories: DataFrame) -> DataFrame:
    """Views of a post split evenly over its linked products, summed by creator and category."""
    links = explode_products(posts, ["channel_id", "view_count"])
    share = ratio(F.coalesce("view_count", F.lit(0)), "product_count")
    return (
        with_category(links.select("channel_id", "product_base_id", share.alias("_share")), products, categories)
        .groupBy("channel_id", "category")
        .agg(F.sum("_share").alias("category_total_view"))
    )


def creator_summary(
    posts: DataFrame, products: DataFrame, categories: DataFrame, day: str, days: int = 1
) -> DataFrame:
    """Per creator: videos, linked videos, views, and the two categories that bring most views."""
    base = require_keys(posts.filter(on_days("updated_at", day, days)), ["channel_id", "post_id_platform"])
    # read by two aggregations, so the collapse is paid once
    base = settle(
        latest_by(base, ["post_id_platform"], newest(*CRAWL_ORDER)).select(
            "channel_id", "channel_name", "view_count", "list_product_base_id"
        ),
        "day-posts",
    )
    views = F.coalesce("view_count", F.lit(0))
    is_linked = has_items("list_product_base_id")
    stats = base.groupBy("channel_id").agg(
        F.max("channel_name").alias("channel_name"),
        F.count("*").alias("total_video"),
        F.count_if(is_linked).alias("video_with_link"),
        F.sum(views).alias("total_view_all_video"),
        F.coalesce(F.sum(F.when(is_linked, views)), F.lit(0)).alias("total_view_video_aff"),
    )
    # two rows per creator at most, whatever the number of categories
    top = limit_by(
        attribute_views(linked(base), products, categories).withColumn("_minus", -F.col("category_total_view")),
        2,
        ["channel_id"],
        [F.asc("_minus"), F.asc("category")],
    )
    ordered = F.array_sort(F.collect_list(F.struct("_minus", "category")))
    tops = top.groupBy("channel_id").agg(ordered.alias("_top"))
    first, second = F.try_element_at("_top", F.lit(1)), F.try_element_at("_top", F.lit(2))
    joined = stats.join(tops, "channel_id", "left")
    view_1 = F.coalesce(-first["_minus"], F.lit(0.0))
    return joined.select(
        "channel_id",
        "channel_name",
        "total_video",
        "video_with_link",
        "total_view_all_video",
        "total_view_video_aff",
        first["category"].alias("top_1_category"),
        view_1.alias("top_1_category_total_view"),
        half_even(ratio(view_1 * 100.0, "total_view_video_aff"), 2).alias("top_1_category_pct"),
        second["category"].alias("top_2_category"),
        F.coalesce(-second["_minus"], F.lit(0.0)).alias("top_2_category_total_view"),
    )


def followed_channels(
    channels: DataFrame, country: str | None = None, min_followers: int = 1000, country_first: bool = False
) -> DataFrame:
    """Newest channel row above the follower floor.

    The floor always acts before the version collapse; the country test acts after it
    unless ``country_first`` is set.
    """
    here = F.lit(True) if country is None else F.lower("country") == country.lower()
    rows = channels.filter(F.col("follower_count") > min_followers)
    if country_first:
        rows = rows.filter(here)
    rows = latest_by(rows, ["channel_base_id"], newest("updated_at", "follower_count"))
    return rows if country_first else rows.filter(here)


def active_creators(
    posts: DataFrame, channels: DataFrame, start: str, country: str, min_followers: int = 1000
) -> DataFrame:
    """Number of creators of a country, above a follower floor, that posted since ``start``."""
    recent = posts.filter(since("created_at_platform", start)).select(
        "post_base_id", "channel_base_id", *CRAWL_ORDER
    )
    recent = latest_by(recent, ["post_base_id"], newest(*CRAWL_ORDER))
    here = followed_channels(channels, country, min_followers).select("channel_base_id")
    return recent.join(here, "channel_base_id").agg(F.countDistinct("channel_base_id").alias("total_channel"))


def tier_distribution(
    posts: DataFrame, channels: DataFrame, start: str, country: str, min_followers: int = 1000
) -> DataFrame:
    """Creators per follower tier among those that posted since ``start``."""
    active = posts.filter(since("created_at_platform", start)).select("channel_base_id")
    return (
        followed_channels(channels, country, min_followers)
        .join(active, "channel_base_id", "left_semi")
        .groupBy(follower_tier("follower_count").alias("tier"))
        .agg(F.countDistinct("channel_base_id").alias("creators"))
    )


def scope_windows(posts: DataFrame, windows: Sequence[int], as_of: str, time_col: str = "created_at_platform") -> DataFrame:
    """One row per post and look-back window that contains it."""
    spans = F.explode(F.array(*[F.lit(w) for w in windows]))
    inside = cascade([(F.col("window_days") == w, trailing(time_col, w, as_of)) for w in windows], False)
    return posts.filter(trailing(time_col, max(windows), as_of)).withColumn("window_days", spans).filter(inside)


VIDEO_KEYS = ("channel_base_id", "post_base_id", "view_count")


def video_dominant_category(
    scoped: DataFrame, products: DataFrame, categories: DataFrame, keys: Sequence[str] = ("window_days", *VIDEO_KEYS)
) -> DataFrame:
    return dominant_category(linked(scoped), products, categories, list(keys))


def scoped_category(
    posts: DataFrame, products: DataFrame, categories: DataFrame, windows: Sequence[int], as_of: str, time_col: str = "created_at_platform"
) -> DataFrame:
    """Category of every post in each window that contains it; posts must be one row each.

    A post has the same category in all of them, so its products are looked up and counted once.
    """
    recent = posts.filter(trailing(time_col, max(windows), as_of))
    best = video_dominant_category(recent, products, categories, [*VIDEO_KEYS, time_col])
    return scope_windows(best, windows, as_of, time_col).select("window_days", *VIDEO_KEYS, "category")


def creator_niche(video_category: DataFrame) -> DataFrame:
    """Category with most views per creator and window."""
    views = video_category.groupBy("window_days", "channel_base_id", "category").agg(
        F.sum("view_count").alias("cat_view")
    )
    return heaviest(views, ["window_days", "channel_base_id"], ["category"], "cat_view").withColumnRenamed(
        "category", "primary_niche"
    )


FEATURE_MEDIANS = (
    "view_rate",
    "like_rate",
    "comment_rate",
    "share_rate",
    "shoppable_med_view",
    "purchase_intent",
)


def creator_features(
    scoped: DataFrame, channels: DataFrame, min_videos: int = 3, scope: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Median engagement rates and shopping shares per creator and window.

    With ``scope``, ``scoped`` are posts that it deals to their windows; they join and are written once for all windows.
    """
    ids = ["window_days", "channel_base_id"]
    # medians and counts read the same narrow rows
    place = ["window_days"] if scope is None else ["created_at_platform"]
    rows = settle(
        scoped.join(channels.select("channel_base_id", "follower_count"), "channel_base_id").select(
            *place, "channel_base_id", "channel_name", "follower_count", "view_count", "reaction_count", "comment_count", "share_count",
            "collect_count", "list_product_base_id",
        ),
        "scoped",
    )
    rows = rows if scope is None else scope(rows)
    seen, shop = F.col("view_count") > 0, has_items("list_product_base_id")

    def med(cond: Column, value: Column) -> tuple[Column, float]:
        return F.when(cond, value), 0.5

    medians = many_group_quantiles(
        rows,
        ids,
        {
            "view_rate": med(F.col("follower_count") > 0, ratio("view_count", "follower_count")),
            "like_rate": med(seen, ratio("reaction_count", "view_count")),
            "comment_rate": med(seen, ratio("comment_count", "view_count")),
            "share_rate": med(seen, ratio("share_count", "view_count")),
            "shoppable_med_view": med(seen & shop, F.col("view_count")),
            "purchase_intent": med(seen & shop, ratio(F.col("collect_count") + F.col("share_count"), "view_count")),
        },
    )
    counts = (
        rows.groupBy(*ids)
        .agg(
            F.max("channel_name").alias("channel_name"),
            F.max("follower_count").alias("followers"),
            F.count("*").alias("video_count"),
            F.count_if(shop).alias("shoppable_video_count"),
        )
        .filter(F.col("video_count") >= min_videos)
        .withColumn("shoppable_rate", ratio("shoppable_video_count", "video_count"))
    )
    return counts.join(medians, ids).filter(F.col("comment_rate").isNotNull())


def creator_percentiles(
    posts: DataFrame,
    channels: DataFrame,
    products: DataFrame,
    categories: DataFrame,
    as_of: str,
    windows: Sequence[int] = WINDOWS,
    niches: Sequence[str] | None = ALLOWED_NICHES,
    country: str | None = "vn",
    min_followers: int = 1000,
    min_videos: int = 3,
) -> DataFrame:
    """Percentile of every creator within (window, follower tier, primary niche)."""
    span = trailing("created_at_platform", max(windows), as_of)
    fields = [
        "post_base_id",
        "channel_base_id",
        "channel_name",
        "created_at_platform",
        "view_count",
        "reaction_count",
        "comment_count",
        "share_count",
        "collect_count",
        "list_product_base_id",
    ]
    recent = posts.filter(span)
    # features, niches and counts read the collapsed posts: write them once, narrow
    dedup = settle(latest_by(recent, ["post_base_id"], newest(*CRAWL_ORDER)).select(*fields), "posts")
    followed = followed_channels(channels, country, min_followers, country_first=True)
    features = creator_features(dedup, followed, min_videos, lambda rows: scope_windows(rows, windows, as_of))
    niche = creator_niche(scoped_category(dedup, products, categories, windows, as_of))
    if niches is not None:
        niche = niche.filter(F.col("primary_niche").isin(list(niches)))
    feat = features.join(niche, ["window_days", "channel_base_id"]).withColumn("tier", follower_tier("followers"))
    # one row per creator and window; the ranks read it three times
    feat = settle(feat, "features")
    ranks = {"_view": "view_rate", "_like": "like_rate", "_comment": "comment_rate", "_share": "share_rate"}
    ranked = rank_within(
        feat, ["window_days", "channel_base_id"], ["window_days", "tier", "primary_niche"], ranks, "_size"
    )
    return ranked.select(
        "window_days",
        F.col("channel_base_id").alias("channel_id"),
        "channel_name",
        "followers",
        "tier",
        "primary_niche",
        "video_count",
        "view_rate",
        "like_rate",
        "comment_rate",
        "share_rate",
        "shoppable_rate",
        "shoppable_video_count",
        "shoppable_med_view",
        "purchase_intent",
        *[percentile_of(f"_{m}", "_size").alias(f"{m}_pctile") for m in ("view", "like", "comment", "share")],
    )


def creator_focus(video_category: DataFrame, min_share: float = 0.6) -> DataFrame:
    """Main category of a creator by video share and whether the creator is specialised."""
    counts = video_category.groupBy("channel_base_id", "category").agg(F.count("*").alias("videos"))
    totals = counts.groupBy("channel_base_id").agg(F.sum("videos").alias("tagged_videos"))
    best = heaviest(counts, ["channel_base_id"], ["category", "videos"], "videos")
    share = ratio("videos", "tagged_videos")
    return best.join(totals, "channel_base_id").select(
        "channel_base_id",
        F.col("category").alias("creator_primary_category"),
        share.alias("top_share"),
        F.when(share >= min_share, "Specialized").otherwise("Generalist").alias("creator_focus_type"),
        "tagged_videos",
    )


def engagement_tier(df: DataFrame) -> DataFrame:
    """High from 5 %, Medium from 1 %, else Low; NULL without views."""
    rate = ratio(
        sum((F.coalesce(c, F.lit(0)) for c in ("reaction_count", "comment_count", "share_count")), F.lit(0)),
        "view_count",
    )
    label = F.when(rate >= 0.05, "High Engagement").when(rate >= 0.01, "Medium").when(rate.isNotNull(), "Low")
    return df.withColumn("engagement_rate", rate).withColumn("engagement_quality_tier", label)


def creator_role_niche(role: DataFrame, video_category: DataFrame, min_share: float = 0.4) -> DataFrame:
    """Role label beside the niche, which needs ``min_share`` of a creator's tagged videos."""
    focus = creator_focus(video_category).select("channel_base_id", "creator_primary_category", "top_share")
    niche = F.when(F.col("top_share") >= min_share, F.col("creator_primary_category")).otherwise("Mixed")
    return role.join(focus, "channel_base_id", "left").select(
        "channel_base_id",
        "creator_role",
        F.when(F.col("top_share").isNull(), "Unknown").otherwise(niche).alias("creator_niche"),
    )


def metric_history(df: DataFrame, metric: str, keep: Sequence[str] = ("video_id",)) -> DataFrame:
    """Nested (date, value, delta) history as daily rows."""
    return df.select(*keep, F.inline(metric))

"""Livestream staging, facts and product performance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.functions.columns import band, cascade, clock, half_even, local_time, ratio
from bazaarlens.operators.quality import compare_totals
from bazaarlens.operators.ranking import group_quantiles
from bazaarlens.sources.readers import complete_rows

# Staging column, document field and type, per table.
SESSION = [
    ("session_id", "sessionId", "bigint"),
    ("title", "title", "string"),
    ("status", "status", "bigint"),
    ("start_time_ms", "startTime", "bigint"),
    ("duration_ms", "duration", "bigint"),
    ("cover_image", "coverImage", "string"),
    ("viewers", "viewers", "bigint"),
    ("views", "views", "bigint"),
    ("peak_views", "peakViews", "bigint"),
    ("engaged_uv", "engagedUv", "bigint"),
    ("avg_engaged_ccu", "avgEngagedCcu", "bigint"),
    ("avg_views_duration_ms", "avgViewsDuration", "bigint"),
    ("thirty_mins_count", "thirtyMinsCount", "bigint"),
    ("comments", "comments", "bigint"),
    ("likes", "likes", "bigint"),
    ("atc", "atc", "bigint"),
    ("product_clicks", "productClicks", "bigint"),
    ("conversion_rate", "conversionRate", "double"),
    ("followers_growth", "followersGrowth", "bigint"),
    ("paid_orders", "paidOrders", "bigint"),
    ("paid_sales", "paidSales", "double"),
    ("placed_orders", "placedOrders", "bigint"),
    ("placed_item_sold", "placedItemSold", "bigint"),
    ("placed_sales", "placedSales", "double"),
    ("confirmed_orders", "confirmedOrders", "bigint"),
    ("confirmed_item_sold", "confirmedItemSold", "bigint"),
    ("confirmed_sales", "confirmedSales", "double"),
]
LIVE_INFO = [
    ("session_id", "sessionId", "bigint"),
    ("title", "title", "string"),
    ("status", "status", "bigint"),
    ("start_time_ms", "startTime", "bigint"),
    ("duration_ms", "duration", "bigint"),
    ("cover_image", "coverImage", "string"),
]
PERFORMANCE = [
    ("views", "views", "bigint"),
    ("viewers", "viewers", "bigint"),
    ("likes", "likes", "bigint"),
    ("comments", "comments", "bigint"),
    ("shares", "shares", "bigint"),
    ("paid_orders", "paidOrders", "bigint"),
    ("paid_sales", "paidSales", "double"),
    ("placed_orders", "placedOrders", "bigint"),
    ("placed_sales", "placedSales", "double"),
    ("item_placed_orders", "itemPlacedOrders", "bigint"),
    ("placed_buyers", "placedBuyers", "bigint"),
    ("placed_sales_per_buyer", "placedSalesPerBuyer", "double"),
    ("confirmed_orders", "confirmedOrders", "bigint"),
    ("confirmed_sales", "confirmedSales", "double"),
    ("item_confirmed_orders", "itemConfirmedOrders", "bigint"),
    ("confirmed_buyers", "confirmedBuyers", "bigint"),
    ("confirmed_sales_per_buyer", "confirmedSalesPerBuyer", "double"),
    ("comment_rate", "commentRate", "double"),
]
PROMOTION = [
    ("coins_round", "coinsRound", "bigint"),
    ("coins_claimed", "coinsClaimed", "bigint"),
    ("time_claimed", "timeClaimed", "bigint"),
    ("auction_round", "auctionRound", "bigint"),
    ("user_claimed", "userClaimed", "bigint"),
]
KEY_METRICS = [
    ("live_cover_clicks_rate", "liveCoverClicksRate", "double"),
    ("ctr", "ctr", "double"),
    ("avg_view_duration_ms", "avgViewDuration", "bigint"),
    ("peak_viewers", "peakViewers", "bigint"),
    ("engaged_viewers", "engagedViewers", "bigint"),
    ("followers_growth", "followersGrowth", "bigint"),
    ("product_imp", "productImp", "bigint"),
    ("product_clicks", "productClicks", "bigint"),
    ("product_click_uv", "productClickUv", "bigint"),
    ("product_click_rate", "productClickRate", "double"),
    ("atc", "atc", "bigint"),
    ("conversion_rate", "conversionRate", "double"),
    ("sales_per_buyer", "salesPerBuyer", "double"),
    ("sales_per_order", "salesPerOrder", "double"),
    ("placed_gpm", "placedGPM", "double"),
    ("confirmed_gpm", "confirmedGPM", "double"),
    ("placed_cor", "placedCOR", "double"),
    ("confirmed_cor", "confirmedCOR", "double"),
    ("placed_abs", "placedABS", "double"),
    ("confirmed_abs", "confirmedABS", "double"),
    ("placed_imp_order_rate", "placedImpOrderRate", "double"),
    ("confirmed_imp_order_rate", "confirmedImpOrderRate", "double"),
]
PRODUCT = [
    ("item_id", "itemId", "string"),
    ("shop_id", "shopId", "bigint"),
    ("title", "title", "string"),
    ("cover_image", "coverImage", "string"),
    ("min_price", "minPrice", "double"),
    ("max_price", "maxPrice", "double"),
    ("viewers", "viewers", "bigint"),
    ("clicks", "clicks", "bigint"),
    ("click_rate", "clickRate", "double"),
    ("atc", "atc", "bigint"),
    ("paid_orders", "paidOrders", "bigint"),
    ("paid_sales", "paidSales", "double"),
    ("placed_orders", "placedOrders", "bigint"),
    ("placed_item_sold", "placedItemSold", "bigint"),
    ("placed_sales", "placedSales", "double"),
    ("placed_co_rate", "placedCORate", "double"),
    ("confirmed_orders", "confirmedOrders", "bigint"),
    ("confirmed_item_sold", "confirmedItemSold", "bigint"),
    ("confirmed_sales", "confirmedSales", "double"),
    ("confirmed_co_rate", "confirmedCORate", "double"),
    ("conversion_rate", "conversionRate", "double"),
    ("affiliate_orders", "affiliateOrders", "bigint"),
    ("affiliate_item_sold", "affiliateItemSold", "bigint"),
    ("affiliate_sales", "affiliateSales", "double"),
    ("grass_date", "grassDate", "bigint"),
]
MINUTE = [
    ("bucket_time_ms", "time", "bigint"),
    ("views", "views", "bigint"),
    ("viewers", "viewers", "bigint"),
    ("likes", "likes", "bigint"),
    ("comment", "comment", "bigint"),
    ("atc", "atc", "bigint"),
    ("ccu", "ccu", "bigint"),
    ("engaged_ccu", "engagedCcu", "bigint"),
    ("placed_orders", "placedOrders", "bigint"),
    ("placed_sales", "placedSales", "double"),
    ("confirmed_orders", "confirmedOrders", "bigint"),
    ("confirmed_sales", "confirmedSales", "double"),
]
# Traffic sources (id, label, confidence).
TRAFFIC_LABELS = [
    (1, "Live tab / Live feed", "MEDIUM"),
    (2, "Search", "MEDIUM"),
    (3, "Recommendation / For You", "MEDIUM"),
    (4, "Shop profile", "MEDIUM"),
    (5, "Following / Subscribe", "MEDIUM"),
    (6, "Notifications / Push", "LOW"),
    (7, "Share / Deeplink", "LOW"),
    (8, "Category / Mall", "LOW"),
    (9, "Affiliate / Voucher", "LOW"),
    (99, "Others / Unknown", "HIGH"),
]

Fields = list[tuple[str, str, str]]


def _struct(fields: Fields) -> str:
    """Document schema of a table."""
    return ", ".join(f"{field}:{kind}" for field, kind in dict.fromkeys((field, kind) for _, field, kind in fields))


SESSION_SCHEMA = f"struct<{_struct(SESSION)}>"
PRODUCT_SCHEMA = f"struct<{_struct(PRODUCT)}>"
DETAIL_SCHEMA = (
    f"struct<code:int, data:struct<liveInfo:struct<{_struct(LIVE_INFO)}>, performance:struct<{_struct(PERFORMANCE)}>, "
    f"promotion:struct<{_struct(PROMOTION)}, streamingPriceSets:array<bigint>>, keyMetrics:struct<{_struct(KEY_METRICS)}>>>"
)
#: Of a minute document: what adds up over buckets, and what is a level at a time.
MINUTE_LEVELS = ("viewers", "ccu", "engaged_ccu")
MINUTE_SUMS = tuple(name for name, _, _ in MINUTE if name not in ("bucket_time_ms", *MINUTE_LEVELS))
MINUTE_SCHEMA = f"struct<{_struct(MINUTE)}>"
TRAFFIC_SCHEMA = "struct<code:int, data:array<struct<sourceId:int, view:bigint, viewPercentage:double>>>"
PROFILE_SCHEMA = "struct<code:int, data:array<struct<type:string, distribution:array<struct<itemName:string, value:bigint>>>>>"


def _columns(root: str, fields: Fields) -> list[Column]:
    return [F.col(f"{root}.{field}").alias(out) for out, field, _ in fields]


def _times(df: DataFrame) -> DataFrame:
    return df.withColumn("start_time_vn", local_time("start_time_ms")).withColumn("duration_hms", clock("duration_ms"))


def stage_live_session(docs: DataFrame) -> DataFrame:
    """One row per session document; ``docs`` has the parsed document in ``data``."""
    return _times(docs.select(*_columns("data", SESSION)))


def stage_live_info(docs: DataFrame) -> DataFrame:
    return _times(docs.select(*_columns("data.data.liveInfo", LIVE_INFO)))


def _session() -> Column:
    return F.col("data.data.liveInfo.sessionId").alias("session_id")


def stage_performance(docs: DataFrame) -> DataFrame:
    return docs.select(_session(), *_columns("data.data.performance", PERFORMANCE))


def stage_promotion(docs: DataFrame) -> DataFrame:
    skus = F.coalesce(F.size("data.data.promotion.streamingPriceSets"), F.lit(0)).alias("streaming_price_skus")
    return docs.select(_session(), *_columns("data.data.promotion", PROMOTION), skus)


def stage_promo_skus(docs: DataFrame) -> DataFrame:
    return docs.select(_session(), F.explode("data.data.promotion.streamingPriceSets").alias("item_id"))


def stage_key_metrics(docs: DataFrame) -> DataFrame:
    return docs.select(_session(), *_columns("data.data.keyMetrics", KEY_METRICS))


def stage_minute(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """Minute buckets; a document that was cut off keeps its complete rows."""
    rows = docs.select("session_id", F.explode(complete_rows(doc, MINUTE_SCHEMA)).alias("m")).filter(F.col("m.time").isNotNull())
    out = rows.select("session_id", *_columns("m", MINUTE))
    return out.withColumn("bucket_time_vn", local_time("bucket_time_ms"))


def resample_minutes(buckets: DataFrame, sums: Sequence[str] = MINUTE_SUMS, levels: Sequence[str] = MINUTE_LEVELS) -> DataFrame:
    """One row per session and minute from its first to its last bucket, on whole minutes.

    Buckets that fall into the same minute are added up; ``levels`` take the last known value and carry it on through
    minutes without a bucket, which count 0. Of buckets at the same instant the larger level counts. ``buckets``
    is the number of buckets of the minute. Buckets without a time are left out; a NULL session is one of its own.
    """
    spot = F.unix_millis(F.window(F.timestamp_millis("bucket_time_ms"), "1 minute")["start"])
    # a decimal sum does not depend on the order of the buckets
    total = lambda c: F.sum(F.col(c).cast("decimal(30,6)")).cast(buckets.schema[c].dataType)
    last = lambda c: F.max(F.when(F.col(c).isNotNull(), F.struct("bucket_time_ms", F.col(c).alias("level"))))["level"]
    minutes = (
        buckets.withColumn("_minute", spot)
        .groupBy("session_id", "_minute")
        .agg(F.count("*").alias("buckets"), *[total(c).alias(c) for c in sums], *[last(c).alias(c) for c in levels])
    )
    spans = minutes.groupBy("session_id").agg(F.min("_minute").alias("_first"), F.max("_minute").alias("_last"))
    calendar = spans.select("session_id", F.explode(F.expr("sequence(_first, _last, 60000L)")).alias("_minute"))
    same = [F.col(f"c.{c}").eqNullSafe(F.col(f"m.{c}")) for c in ("session_id", "_minute")]
    w = Window.partitionBy("session_id").orderBy("bucket_time_ms").rowsBetween(Window.unboundedPreceding, 0)
    filled = calendar.alias("c").join(minutes.alias("m"), same, "left").select(
        "c.session_id", F.col("c._minute").alias("bucket_time_ms"), *[F.coalesce(f"m.{c}", F.lit(0)).alias(c) for c in ("buckets", *sums)], *[f"m.{c}" for c in levels]
    )
    return filled.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in levels}).withColumn("bucket_time_vn", local_time("bucket_time_ms"))


def stage_traffic(docs: DataFrame) -> DataFrame:
    rows = docs.select("session_id", F.inline("data.data"))
    labels = docs.sparkSession.createDataFrame(TRAFFIC_LABELS, "source_id int, source_label string, label_confidence string")
    return rows.select(
        "session_id", F.col("sourceId").alias("source_id"), "view", F.col("viewPercentage").alias("view_percentage")
    ).join(F.broadcast(labels), "source_id", "left")


def stage_product(docs: DataFrame) -> DataFrame:
    """One row per item over its documents of different sessions.

    A document that repeats another in every field is a repeated delivery and counts once. Counts and money are added
    up; a rate is the mean of the documents' rates, weighted by what it is a rate of (plain if that is nowhere
    known); texts and prices are kept.
    """
    rows = docs.select(*_columns("data", PRODUCT)).distinct()
    add = ["viewers", "clicks", "atc", "paid_orders", "paid_sales", "placed_orders", "placed_item_sold", "placed_sales",
           "confirmed_orders", "confirmed_item_sold", "confirmed_sales", "affiliate_orders", "affiliate_item_sold", "affiliate_sales"]
    rates = {"click_rate": "viewers", "placed_co_rate": "clicks", "confirmed_co_rate": "clicks", "conversion_rate": "clicks"}

    def mean(rate: str, weight: str) -> Column:
        of = F.sum(F.when(F.col(rate).isNotNull(), F.col(weight)))
        return F.coalesce(ratio(F.sum(F.col(rate) * F.col(weight)), of), F.avg(rate))

    return rows.groupBy("item_id", "shop_id").agg(
        F.max("title").alias("title"),
        F.max("cover_image").alias("cover_image"),
        F.min("min_price").alias("min_price"),
        F.max("max_price").alias("max_price"),
        *[F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in add],
        *[mean(c, w).alias(c) for c, w in rates.items()],
        F.max("grass_date").alias("grass_date"),
        F.count("*").alias("documents"),
    )


def stage_profile(docs: DataFrame, kind: str) -> DataFrame:
    """Audience buckets in long form; kind is viewer or buyer."""
    dims = docs.select("session_id", F.explode("data.data").alias("d"))
    return dims.select("session_id", F.lit(kind).alias("kind"), F.col("d.type").alias("dimension"), F.inline("d.distribution")).select(
        "session_id", "kind", "dimension", F.col("itemName").alias("item_name"), "value"
    )


def pair_by_ordinal(docs: DataFrame, sessions: DataFrame) -> DataFrame:
    """Give documents without a session id the id of the detail document with the same number."""
    ids = sessions.select("ordinal", F.col("data.data.liveInfo.sessionId").alias("session_id"))
    return docs.join(ids, "ordinal")


def fact_live_product(promo: DataFrame, products: DataFrame) -> DataFrame:
    """Session x product through the promotion items."""
    keyed = products.withColumn("item_id", F.col("item_id").cast("bigint"))
    return promo.join(keyed, "item_id")


def fact_live_session(session: DataFrame, performance: DataFrame, metrics: DataFrame) -> DataFrame:
    """Session fact; measures the session document lacks come from the detail documents."""
    p = performance.select("session_id", F.col("views").alias("_pv"), F.col("likes").alias("_pl"), F.col("paid_orders").alias("_po"), F.col("paid_sales").alias("_ps"))
    k = metrics.select("session_id", F.col("product_clicks").alias("_kc"), F.col("followers_growth").alias("_kf"), F.col("peak_viewers").alias("_kp"))
    fill = {"views": "_pv", "likes": "_pl", "paid_orders": "_po", "paid_sales": "_ps", "product_clicks": "_kc", "followers_growth": "_kf", "peak_views": "_kp"}
    out = session.join(p, "session_id", "left").join(k, "session_id", "left")
    return out.withColumns({c: F.coalesce(c, f, F.lit(0)) for c, f in fill.items()}).drop(*fill.values())


def product_state(df: DataFrame, impressions: str = "impressions") -> DataFrame:
    """Only in cart, High Focus (from the 75th percentile of products with impressions) or Pinned in live."""
    shown = df.filter(F.col(impressions) > 0).select(F.lit(1).alias("_one"), F.col(impressions).alias("_v"))
    cut = group_quantiles(shown, ["_one"], {"_p75": (F.col("_v"), 0.75)})
    imp = F.coalesce(impressions, F.lit(0))
    out = df.withColumn("_one", F.lit(1)).join(F.broadcast(cut), "_one", "left")
    return out.withColumn(
        "product_state", cascade([(imp == 0, "Only in cart"), (imp >= F.col("_p75"), "High Focus")], "Pinned in live")
    ).drop("_one", "_p75")


def gmv_efficiency(df: DataFrame, min_clicks: int = 10, cap: float = 0.99) -> DataFrame:
    """GMV per 100 clicks, only from ``min_clicks`` clicks on, GMV capped at a percentile."""
    rows = df.withColumn("_one", F.lit(1))
    top = group_quantiles(rows, ["_one"], {"_cap": (F.col("gmv"), cap)})
    capped = F.least(F.col("gmv").cast("double"), F.col("_cap"))
    return (
        rows.join(F.broadcast(top), "_one", "left")
        .withColumn("gmv_per_100_clicks", F.when(F.col("clicks") >= min_clicks, ratio(capped * 100, "clicks")))
        .drop("_one", "_cap")
    )


def product_matrix(df: DataFrame, clicks_q: float = 0.5, gmv_q: float = 0.5) -> DataFrame:
    """Four quadrants of clicks and GMV per 100 clicks; the cuts are quantiles of the rated products."""
    rated = df.filter(F.col("gmv_per_100_clicks").isNotNull()).withColumn("_one", F.lit(1))
    cuts = group_quantiles(
        rated, ["_one"], {"_c": (F.col("clicks"), clicks_q), "_g": (F.col("gmv_per_100_clicks"), gmv_q)}
    )
    busy, rich = F.col("clicks") >= F.col("_c"), F.col("gmv_per_100_clicks") >= F.col("_g")
    label = cascade(
        [
            (F.col("gmv_per_100_clicks").isNull(), "Not rated"),
            (busy & rich, "Winning/Hero Products"),
            (rich, "Hidden Gems"),
            (busy, "High Traffic Products"),
        ],
        "Non-Efficiency",
    )
    out = df.withColumn("_one", F.lit(1)).join(F.broadcast(cuts), "_one", "left")
    return out.withColumn("segment", label).drop("_one", "_c", "_g")


def price_segment(df: DataFrame, edges: Sequence[tuple[str, float, float | None]], price: str = "price") -> DataFrame:
    return df.withColumn("price_segment", band(price, edges))


def compare_campaigns(df: DataFrame, campaign: str, first: str, second: str, by: Sequence[str], value: str = "gmv") -> DataFrame:
    """Two campaigns side by side per host with growth and position in the second."""
    a, b = df.filter(F.col(campaign) == first), df.filter(F.col(campaign) == second)
    rows = compare_totals(a, b, by, value)
    return rows.withColumn("growth", ratio(F.col("after") - F.col("before"), "before"))


def top_hosts(compared: DataFrame, by: Sequence[str], n: int = 10) -> DataFrame:
    return compared.orderBy(F.desc("after"), *[F.asc(c) for c in by]).limit(n)


def live_overview(sessions: DataFrame, by: Sequence[str], gmv: str = "confirmed_sales") -> DataFrame:
    """Sessions, audience and one kind of revenue per host or channel."""
    return sessions.groupBy(*by).agg(
        F.count("*").alias("sessions"),
        F.sum(F.coalesce("views", F.lit(0))).alias("views"),
        F.sum(F.coalesce("viewers", F.lit(0))).alias("viewers"),
        F.sum(F.coalesce(gmv, F.lit(0))).cast("double").alias("gmv"),
    )


def recommend_products(live: DataFrame, market: DataFrame, n: int = 3, same: Sequence[str] = ("category", "price_segment")) -> DataFrame:
    """Best market products of the category and price segment of each live product, except itself.

    Only the n + 1 best products of a segment can be recommended, so the market is cut to
    them before the join and no segment pairs all its products.
    """
    w = Window.partitionBy(*same).orderBy(F.desc("market_gmv"), F.asc("product_base_id"))
    best = market.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n + 1)
    best = best.select(*same, F.col("product_base_id").alias("recommended_id"), "market_gmv", "_rn")
    pairs = live.select("product_base_id", *same).join(best, list(same)).filter(F.col("recommended_id") != F.col("product_base_id"))
    place = F.row_number().over(Window.partitionBy("product_base_id").orderBy("_rn"))
    return pairs.withColumn("position", place).filter(F.col("position") <= n).drop("_rn")


def reconcile_gmv(sources: Mapping[str, DataFrame], base: str, value: str = "gmv", key: str = "session_id") -> DataFrame:
    """Gap of every other source against the base source per session."""
    out = None
    for name, df in sources.items():
        if name == base:
            continue
        rows = compare_totals(sources[base], df, [key], value).select(
            key, F.lit(name).alias("source"), "before", "after", half_even(F.col("after") - F.col("before"), 2).alias("gap")
        )
        out = rows if out is None else out.unionByName(rows)
    return out

"""Livestream and credit queries. Raw documents are written from the tables and staged back."""

from __future__ import annotations

from pyspark.sql import functions as F

from bazaarlens.operators import credit, live
from bazaarlens.plans.registry import div, query, r
from bazaarlens.plans.views import ctes
from bazaarlens.sources.tables import table

MS = "(date_diff('day', DATE '1970-01-01', o_orderdate::DATE) * 86400000 + o_orderkey * 1000 + 224)"
DUR = "(o_orderkey * 1234 % 90000000)"


def _ms():
    return F.date_diff(F.col("o_orderdate").cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint") * 86_400_000 + F.col("o_orderkey") * 1000 + 224


def _dur():
    return F.col("o_orderkey") * 1234 % 90_000_000


def _info():
    return [
        F.col("o_orderkey").alias("sessionId"), F.col("o_orderpriority").alias("title"), F.lit(2).alias("status"),
        _ms().alias("startTime"), _dur().alias("duration"), F.lit("cover").alias("coverImage"),
    ]


def _money(c):
    return F.round(F.col(c), 2)


def session_docs(spark, sf):
    o = table(spark, sf, "orders")
    done = F.col("o_orderstatus") == "F"
    doc = F.struct(
        *_info(),
        F.floor(F.col("o_totalprice") / 1000).alias("viewers"),
        F.when(done, F.floor(F.col("o_totalprice") / 500)).alias("views"),
        (F.col("o_custkey") % 17).alias("comments"),
        (F.col("o_custkey") % 5).alias("atc"),
        F.lit(1).alias("placedOrders"),
        F.col("o_totalprice").alias("placedSales"),
        F.when(done, F.lit(1)).otherwise(0).alias("confirmedOrders"),
        F.when(done, F.col("o_totalprice")).otherwise(0.0).alias("confirmedSales"),
    )
    return o.select("o_custkey", F.to_json(doc).alias("doc")).select("o_custkey", F.from_json("doc", live.SESSION_SCHEMA).alias("data"))


def detail_docs(spark, sf):
    o = table(spark, sf, "orders")
    k = F.col("o_custkey")
    data = F.struct(
        F.struct(*_info()).alias("liveInfo"),
        F.struct(
            F.floor(F.col("o_totalprice") / 400).alias("views"), (k % 90).alias("likes"), (k % 7).alias("shares"), F.lit(1).alias("paidOrders"),
            F.col("o_totalprice").alias("paidSales"), ((k % 100) / 200).alias("commentRate"),
        ).alias("performance"),
        F.struct(
            (k % 3).alias("coinsRound"), (k % 11).alias("userClaimed"),
            F.when(k % 4 != 0, F.array(k, k + 1)).otherwise(F.array().cast("array<bigint>")).alias("streamingPriceSets"),
        ).alias("promotion"),
        F.struct((k % 40).alias("productClicks"), (k % 9).alias("followersGrowth"), (k % 60).alias("peakViewers"), F.lit(0.25).alias("ctr"), (k / 7).alias("placedGPM")).alias("keyMetrics"),
    )
    doc = F.to_json(F.struct(F.lit(0).alias("code"), data.alias("data")))
    return o.select("o_custkey", doc.alias("doc")).select("o_custkey", F.from_json("doc", live.DETAIL_SCHEMA).alias("data"))


TIME_SQL = f"""strftime(TIMESTAMP '1970-01-01' + to_milliseconds({MS}) + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') AS start_time_vn,
  printf('%02d:%02d:%02d', {DUR} // 3600000, {DUR} // 60000 % 60, {DUR} // 1000 % 60) AS duration_hms"""


@query(
    "liv1_session",
    f"""SELECT o_orderkey AS session_id, o_orderpriority AS title, {MS} AS start_time_ms, {TIME_SQL}, floor(o_totalprice / 1000)::BIGINT AS viewers,
        CASE WHEN o_orderstatus = 'F' THEN floor(o_totalprice / 500)::BIGINT END AS views, o_totalprice AS placed_sales,
        CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END AS confirmed_sales FROM orders""",
)
def liv1_session(spark, sf):
    return live.stage_live_session(session_docs(spark, sf)).select(
        "session_id", "title", "start_time_ms", "start_time_vn", "duration_hms", "viewers", "views", "placed_sales", "confirmed_sales"
    )


@query("liv2_info", f"SELECT o_orderkey AS session_id, o_orderpriority AS title, 2::BIGINT AS status, {MS} AS start_time_ms, {DUR} AS duration_ms, 'cover' AS cover_image, {TIME_SQL} FROM orders")
def liv2_info(spark, sf):
    return live.stage_live_info(detail_docs(spark, sf))


@query(
    "liv3_performance",
    f"""SELECT o_orderkey AS session_id, floor(o_totalprice / 400)::BIGINT AS views, o_custkey % 90 AS likes, o_custkey % 7 AS shares, o_totalprice AS paid_sales,
        {r('(o_custkey % 100)::DOUBLE / 200')} AS comment_rate FROM orders""",
)
def liv3_performance(spark, sf):
    return live.stage_performance(detail_docs(spark, sf)).select(
        "session_id", "views", "likes", "shares", "paid_sales", F.bround("comment_rate", 6).alias("comment_rate")
    )


@query(
    "liv4_promotion",
    "SELECT o_orderkey AS session_id, o_custkey % 3 AS coins_round, o_custkey % 11 AS user_claimed, CASE WHEN o_custkey % 4 <> 0 THEN 2 ELSE 0 END::INT AS streaming_price_skus FROM orders",
)
def liv4_promotion(spark, sf):
    return live.stage_promotion(detail_docs(spark, sf)).select("session_id", "coins_round", "user_claimed", "streaming_price_skus")


@query("liv5_promo_skus", "SELECT o_orderkey AS session_id, unnest([o_custkey, o_custkey + 1]) AS item_id FROM orders WHERE o_custkey % 4 <> 0")
def liv5_promo_skus(spark, sf):
    return live.stage_promo_skus(detail_docs(spark, sf))


@query(
    "liv6_key_metrics",
    f"""SELECT o_orderkey AS session_id, o_custkey % 40 AS product_clicks, o_custkey % 9 AS followers_growth, o_custkey % 60 AS peak_viewers, 0.25::DOUBLE AS ctr,
        {r('o_custkey::DOUBLE / 7')} AS placed_gpm FROM orders""",
)
def liv6_key_metrics(spark, sf):
    return live.stage_key_metrics(detail_docs(spark, sf)).select(
        "session_id", "product_clicks", "followers_growth", "peak_viewers", "ctr", F.bround("placed_gpm", 6).alias("placed_gpm")
    )


def minute_docs(spark, sf):
    """Three buckets per event; the document of every fifth event is cut off inside the third."""
    start = F.date_diff(F.col("ts").cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint") * 86_400_000 + F.col("event_id") * 60_000
    rows = F.transform(
        F.sequence(F.lit(0), F.lit(2)),
        lambda i: F.struct((start + i * 60_000).alias("time"), (F.col("user_id") + i).alias("views"), F.col("value").alias("placedSales")),
    )
    doc = F.to_json(F.struct(F.lit(0).alias("code"), rows.alias("data")))
    cut = F.when(F.col("event_id") % 5 == 0, F.substring(doc, F.lit(1), F.length(doc) - 12)).otherwise(doc)
    return table(spark, sf, "events").select(F.col("event_id").alias("session_id"), cut.alias("doc"))


@query(
    "liv7_minute",
    """WITH b AS (SELECT event_id AS session_id, unnest(CASE WHEN event_id % 5 = 0 THEN [0, 1] ELSE [0, 1, 2] END) AS i, user_id, value,
         date_diff('day', DATE '1970-01-01', ts::DATE) * 86400000 + event_id * 60000 AS start FROM events)
       SELECT session_id, start + i * 60000 AS bucket_time_ms, strftime(TIMESTAMP '1970-01-01' + to_milliseconds(start + i * 60000) + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') AS bucket_time_vn,
       user_id + i AS views, value AS placed_sales FROM b""",
)
def liv7_minute(spark, sf):
    return live.stage_minute(minute_docs(spark, sf)).select("session_id", "bucket_time_ms", "bucket_time_vn", "views", "placed_sales")


@query(
    "liv7_resample",
    """WITH b AS (SELECT user_id % 97 AS session_id, (event_id * 7919) % 20000 * 1000 + event_id % 1000 AS ms, user_id AS views, value AS placed_sales,
         CASE WHEN event_id % 3 > 0 THEN event_id % 50 END AS ccu FROM events),
       m AS (SELECT session_id, ms - ms % 60000 AS minute, count(*) AS buckets, sum(views)::BIGINT AS views, sum(placed_sales::DECIMAL(30,6))::DOUBLE AS placed_sales,
         arg_max(ccu, (ms, ccu)) FILTER (ccu IS NOT NULL) AS ccu FROM b GROUP BY ALL),
       c AS (SELECT session_id, unnest(range(min(minute), max(minute) + 1, 60000)) AS minute FROM m GROUP BY session_id)
       SELECT session_id, minute AS bucket_time_ms, strftime(TIMESTAMP '1970-01-01' + to_milliseconds(minute) + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') AS bucket_time_vn,
       coalesce(buckets, 0) AS buckets, coalesce(views, 0) AS views, coalesce(placed_sales, 0) AS placed_sales,
       last_value(ccu IGNORE NULLS) OVER (PARTITION BY session_id ORDER BY minute) AS ccu FROM c LEFT JOIN m USING (session_id, minute)""",
)
def liv7_resample(spark, sf):
    """A document per event: skewed times, minutes with several buckets and minutes with none."""
    at = (F.col("event_id") * 7919) % 20000 * 1000 + F.col("event_id") % 1000
    bucket = F.struct(at.alias("time"), F.col("user_id").alias("views"), F.col("value").alias("placedSales"), F.when(F.col("event_id") % 3 > 0, F.col("event_id") % 50).alias("ccu"))
    docs = table(spark, sf, "events").select((F.col("user_id") % 97).alias("session_id"), F.to_json(F.struct(F.lit(0).alias("code"), F.array(bucket).alias("data"))).alias("doc"))
    out = live.resample_minutes(live.stage_minute(docs))
    return out.select("session_id", "bucket_time_ms", "bucket_time_vn", "buckets", "views", "placed_sales", "ccu")


@query(
    "liv8_traffic",
    """WITH t AS (SELECT o_orderkey AS session_id, unnest([2, 9, 50, 99])::INT AS source_id, unnest([o_custkey % 5, 0, 1, o_custkey % 3]) AS view FROM orders)
       SELECT session_id, source_id, CASE source_id WHEN 2 THEN 'Search' WHEN 9 THEN 'Affiliate / Voucher' WHEN 99 THEN 'Others / Unknown' END AS source_label,
       CASE source_id WHEN 2 THEN 'MEDIUM' WHEN 9 THEN 'LOW' WHEN 99 THEN 'HIGH' END AS label_confidence, view FROM t""",
)
def liv8_traffic(spark, sf):
    k = F.col("o_custkey")
    rows = F.array(*[F.struct(F.lit(i).alias("sourceId"), v.cast("bigint").alias("view")) for i, v in ((2, k % 5), (9, F.lit(0)), (50, F.lit(1)), (99, k % 3))])
    docs = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("session_id"), F.from_json(F.to_json(F.struct(F.lit(0).alias("code"), rows.alias("data"))), live.TRAFFIC_SCHEMA).alias("data")
    )
    return live.stage_traffic(docs).drop("view_percentage")


def product_docs(spark, sf):
    doc = F.struct(
        F.col("l_partkey").cast("string").alias("itemId"), F.col("l_partkey").alias("shopId"), F.lit("t").alias("title"),
        F.col("l_extendedprice").alias("minPrice"), F.col("l_extendedprice").alias("maxPrice"),
        F.col("l_quantity").cast("bigint").alias("clicks"), F.when(F.col("l_returnflag") == "A", F.col("l_linenumber")).alias("paidOrders"),
        F.floor("l_extendedprice").cast("double").alias("confirmedSales"),
    )
    return table(spark, sf, "lineitem").select(F.from_json(F.to_json(doc), live.PRODUCT_SCHEMA).alias("data"))


PRODUCTS = (
    "lp",
    """SELECT l_partkey::VARCHAR AS item_id, l_partkey AS shop_id, min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price, sum(l_quantity)::BIGINT AS clicks,
       sum(CASE WHEN l_returnflag = 'A' THEN l_linenumber ELSE 0 END)::BIGINT AS paid_orders, sum(floor(l_extendedprice))::DOUBLE AS confirmed_sales, count(*) AS documents
       FROM lineitem GROUP BY l_partkey""",
)
PRODUCT_COLS = ["item_id", "shop_id", "min_price", "max_price", "clicks", "paid_orders", "confirmed_sales", "documents"]


@query("liv9_product", ctes(PRODUCTS) + "SELECT * FROM lp")
def liv9_product(spark, sf):
    return live.stage_product(product_docs(spark, sf)).select(*PRODUCT_COLS)


@query(
    "liv10_profile",
    """SELECT c_custkey AS session_id, 'viewer' AS kind, unnest(['identity', 'identity', 'age']) AS dimension, unnest(['follower', 'nonFollower', '18-24']) AS item_name,
       unnest([c_custkey % 7, c_custkey % 5, c_nationkey]) AS value FROM customer""",
)
def liv10_profile(spark, sf):
    def dim(name, *items):
        cells = [F.struct(F.lit(n).alias("itemName"), v.cast("bigint").alias("value")) for n, v in items]
        return F.struct(F.lit(name).alias("type"), (F.array(*cells) if cells else F.array().cast("array<struct<itemName:string,value:bigint>>")).alias("distribution"))

    k = F.col("c_custkey")
    data = F.array(dim("identity", ("follower", k % 7), ("nonFollower", k % 5)), dim("gender"), dim("age", ("18-24", F.col("c_nationkey"))))
    docs = table(spark, sf, "customer").select(
        k.alias("session_id"), F.from_json(F.to_json(F.struct(F.lit(0).alias("code"), data.alias("data"))), live.PROFILE_SCHEMA).alias("data")
    )
    return live.stage_profile(docs, "viewer")


@query(
    "liv11_fact_product",
    ctes(PRODUCTS, ("promo", "SELECT o_orderkey AS session_id, unnest([o_custkey, o_custkey + 1]) AS item_id FROM orders WHERE o_custkey % 4 <> 0"))
    + "SELECT session_id, promo.item_id, clicks, confirmed_sales FROM promo JOIN lp ON promo.item_id = lp.item_id::BIGINT",
)
def liv11_fact_product(spark, sf):
    out = live.fact_live_product(live.stage_promo_skus(detail_docs(spark, sf)), live.stage_product(product_docs(spark, sf)))
    return out.select("session_id", "item_id", "clicks", "confirmed_sales")


@query(
    "liv12_fact_session",
    """SELECT o_orderkey AS session_id, CASE WHEN o_orderstatus = 'F' THEN floor(o_totalprice / 500) ELSE floor(o_totalprice / 400) END::BIGINT AS views, o_custkey % 90 AS likes,
       o_custkey % 40 AS product_clicks, o_custkey % 9 AS followers_growth, o_custkey % 60 AS peak_views, 1::BIGINT AS paid_orders, o_totalprice AS paid_sales,
       o_totalprice AS placed_sales FROM orders""",
)
def liv12_fact_session(spark, sf):
    detail = detail_docs(spark, sf)
    out = live.fact_live_session(live.stage_live_session(session_docs(spark, sf)), live.stage_performance(detail), live.stage_key_metrics(detail))
    return out.select("session_id", "views", "likes", "product_clicks", "followers_growth", "peak_views", "paid_orders", "paid_sales", "placed_sales")


# performance -----------------------------------------------------------------------------


def live_products(spark, sf):
    shown = (F.col("l_returnflag") == "A") & (F.col("l_discount") > 0.08)
    facts = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("product_base_id")).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("clicks"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("gmv"),
        F.count_if(shown).alias("impressions"),
    )
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("product_base_id"), F.col("p_type").alias("category"), F.col("p_retailprice").alias("price"))
    return facts.join(part, "product_base_id")


PERF = (
    "perf",
    """SELECT l_partkey AS product_base_id, p_type AS category, p_retailprice AS price, sum(l_quantity)::BIGINT AS clicks, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS gmv,
       count(*) FILTER (l_returnflag = 'A' AND l_discount > 0.08) AS impressions FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL""",
)
EDGES = [("low", 0, 950.0), ("mid", 950.01, 1000.0), ("high", 1000.01, None)]
EDGE_SQL = "CASE WHEN price >= 1000.01 THEN 'high' WHEN price >= 950.01 AND price <= 1000.0 THEN 'mid' WHEN price >= 0 AND price <= 950.0 THEN 'low' ELSE 'Unknown' END"
EFF = (
    "eff",
    f"""SELECT *, CASE WHEN clicks >= 400 THEN {div('least(gmv, (SELECT quantile_cont(gmv, 0.9) FROM perf)) * 100', 'clicks')} END AS g FROM perf""",
)


@query(
    "liv13_state",
    ctes(PERF)
    + """SELECT product_base_id, impressions, CASE WHEN impressions = 0 THEN 'Only in cart'
      WHEN impressions >= (SELECT quantile_cont(impressions, 0.75) FROM perf WHERE impressions > 0) THEN 'High Focus' ELSE 'Pinned in live' END AS product_state FROM perf""",
)
def liv13_state(spark, sf):
    return live.product_state(live_products(spark, sf)).select("product_base_id", "impressions", "product_state")


@query("liv14_efficiency", ctes(PERF, EFF) + f"SELECT product_base_id, clicks, gmv, {r('g', 4)} AS gmv_per_100_clicks FROM eff")
def liv14_efficiency(spark, sf):
    out = live.gmv_efficiency(live_products(spark, sf), 400, 0.9)
    return out.select("product_base_id", "clicks", "gmv", F.bround("gmv_per_100_clicks", 4).alias("gmv_per_100_clicks"))


@query(
    "liv15_matrix",
    ctes(PERF, EFF, ("cuts", "SELECT quantile_cont(clicks, 0.5) AS c, quantile_cont(g, 0.5) AS e FROM eff WHERE g IS NOT NULL"))
    + """SELECT product_base_id, CASE WHEN g IS NULL THEN 'Not rated' WHEN clicks >= c AND g >= e THEN 'Winning/Hero Products' WHEN g >= e THEN 'Hidden Gems'
      WHEN clicks >= c THEN 'High Traffic Products' ELSE 'Non-Efficiency' END AS segment FROM eff CROSS JOIN cuts""",
)
def liv15_matrix(spark, sf):
    return live.product_matrix(live.gmv_efficiency(live_products(spark, sf), 400, 0.9)).select("product_base_id", "segment")


@query("liv16_price", ctes(PERF) + f"SELECT product_base_id, price, {EDGE_SQL} AS price_segment FROM perf")
def liv16_price(spark, sf):
    return live.price_segment(live_products(spark, sf), EDGES).select("product_base_id", "price", "price_segment")


def _by_host(spark, sf):
    line = table(spark, sf, "lineitem").select("l_suppkey", "l_shipdate", F.col("l_extendedprice").cast("decimal(18,2)").alias("gmv"))
    return line.select(F.col("l_suppkey").alias("host"), F.date_format("l_shipdate", "MM-dd").alias("campaign"), "gmv")


@query(
    "liv17_campaigns",
    ctes(
        ("c", "SELECT l_suppkey AS host, strftime(l_shipdate, '%m-%d') AS campaign, l_extendedprice::DECIMAL(18,2) AS gmv FROM lineitem"),
        ("t", """SELECT host, coalesce(sum(gmv) FILTER (campaign = '11-11'), 0)::DOUBLE AS before, coalesce(sum(gmv) FILTER (campaign = '12-12'), 0)::DOUBLE AS after
          FROM c WHERE campaign IN ('11-11', '12-12') GROUP BY ALL"""),
    )
    + f"SELECT *, {r(div('after - before', 'before'))} AS growth FROM t",
)
def liv17_campaigns(spark, sf):
    out = live.compare_campaigns(_by_host(spark, sf), "campaign", "11-11", "12-12", ["host"])
    return out.withColumn("growth", F.bround("growth", 6))


@query(
    "liv17_top_hosts",
    """SELECT l_suppkey AS host, sum(l_extendedprice::DECIMAL(18,2)) FILTER (strftime(l_shipdate, '%m-%d') = '12-12')::DOUBLE AS after FROM lineitem
       GROUP BY 1 HAVING after IS NOT NULL ORDER BY 2 DESC, 1 LIMIT 5""",
)
def liv17_top_hosts(spark, sf):
    out = live.compare_campaigns(_by_host(spark, sf), "campaign", "11-11", "12-12", ["host"])
    return live.top_hosts(out, ["host"], 5).select("host", "after")


@query(
    "liv18_overview",
    """SELECT o_custkey AS host, count(*) AS sessions, sum(CASE WHEN o_orderstatus = 'F' THEN floor(o_totalprice / 500) ELSE 0 END)::BIGINT AS views,
       sum(floor(o_totalprice / 1000))::BIGINT AS viewers, sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice::DECIMAL(18,2) ELSE 0 END)::DOUBLE AS gmv FROM orders GROUP BY 1""",
)
def liv18_overview(spark, sf):
    docs = session_docs(spark, sf)
    rows = docs.select(F.col("o_custkey").alias("host"), F.col("data.views").alias("views"), F.col("data.viewers").alias("viewers"),
                       F.col("data.confirmedSales").cast("decimal(18,2)").alias("confirmed_sales"))
    return live.live_overview(rows, ["host"])


@query(
    "liv19_recommend",
    ctes(
        PERF,
        ("m", f"SELECT product_base_id, category, {EDGE_SQL} AS price_segment, gmv AS market_gmv FROM perf"),
        ("best", "SELECT *, row_number() OVER (PARTITION BY category, price_segment ORDER BY market_gmv DESC, product_base_id) AS rn FROM m"),
    )
    + """SELECT a.product_base_id, b.product_base_id AS recommended_id, b.market_gmv, row_number() OVER (PARTITION BY a.product_base_id ORDER BY rn)::INT AS position
      FROM m a JOIN best b USING (category, price_segment) WHERE a.product_base_id <> b.product_base_id AND rn <= 4 QUALIFY position <= 3""",
)
def liv19_recommend(spark, sf):
    rows = live.price_segment(live_products(spark, sf), EDGES)
    out = live.recommend_products(rows, rows.withColumnRenamed("gmv", "market_gmv"))
    return out.select("product_base_id", "recommended_id", "market_gmv", "position")


@query(
    "liv20_reconcile",
    """WITH d AS (SELECT l_orderkey AS session_id, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS v FROM lineitem GROUP BY 1),
       p AS (SELECT o_orderkey AS session_id, o_totalprice AS b, CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END AS c FROM orders)
       SELECT coalesce(p.session_id, d.session_id) AS session_id, 'lines' AS source, coalesce(b, 0) AS before, coalesce(v, 0) AS after, """
    + r("coalesce(v, 0) - coalesce(b, 0)", 2)
    + " AS gap FROM p FULL JOIN d USING (session_id) UNION ALL SELECT session_id, 'confirmed', b, c, "
    + r("c - b", 2) + " FROM p",
)
def liv20_reconcile(spark, sf):
    orders = table(spark, sf, "orders")
    amount = F.col("o_totalprice").cast("decimal(18,2)")
    base = orders.select(F.col("o_orderkey").alias("session_id"), amount.alias("gmv"))
    done = orders.select(F.col("o_orderkey").alias("session_id"), F.when(F.col("o_orderstatus") == "F", amount).otherwise(0).alias("gmv"))
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("session_id"), F.col("l_extendedprice").cast("decimal(18,2)").alias("gmv"))
    return live.reconcile_gmv({"placed": base, "lines": lines, "confirmed": done}, "placed")


# credit ----------------------------------------------------------------------------------

AS_OF = "2001-08-02"


def shops(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("shop_id"), F.col("c_mktsegment").alias("segment"),
        F.date_add(F.lit("1994-01-01").cast("date"), (F.col("c_custkey") % 2000).cast("int")).alias("opened_at"),
    )


def order_log(spark, sf):
    status = F.when(F.col("o_orderstatus") == "F", "delivered").when(F.col("o_orderstatus") == "P", "cancelled").when(F.col("o_orderkey") % 2 == 0, "returned").otherwise("open")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("shop_id"), F.col("o_orderdate").alias("order_date"),
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "5-LOW").alias("is_cod"), status.alias("status"), F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
    )


SHOP_FEATURES = [
    ("shops", "SELECT c_custkey AS shop_id, c_mktsegment AS segment, DATE '1994-01-01' + (c_custkey % 2000)::INT AS opened_at FROM customer"),
    (
        "log",
        """SELECT o_custkey AS shop_id, o_orderdate AS order_date, o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW') AS is_cod, o_totalprice::DECIMAL(18,2) AS amount,
           CASE WHEN o_orderstatus = 'F' THEN 'delivered' WHEN o_orderstatus = 'P' THEN 'cancelled' WHEN o_orderkey % 2 = 0 THEN 'returned' ELSE 'open' END AS status FROM orders""",
    ),
    (
        "f",
        f"""SELECT s.shop_id, segment, opened_at, date_diff('day', opened_at, DATE '{AS_OF}')::INT AS age_days, count(status) AS orders,
            {div('count(*) FILTER (is_cod)', 'count(status)')} AS cod_share, {div("count(*) FILTER (status = 'delivered')", 'count(status)')} AS success_rate,
            {div("count(*) FILTER (status = 'returned')", 'count(status)')} AS return_rate, {div("count(*) FILTER (status = 'cancelled')", 'count(status)')} AS cancel_rate,
            coalesce(sum(amount), 0)::DOUBLE AS total_value FROM shops s LEFT JOIN log USING (shop_id) GROUP BY ALL""",
    ),
    (
        "scored",
        """SELECT *, (CASE WHEN success_rate >= 0.6 THEN 40 WHEN success_rate >= 0.4 THEN 25 WHEN success_rate >= 0.2 THEN 10 ELSE 0 END
           + CASE WHEN return_rate <= 0.1 THEN 20 WHEN return_rate <= 0.3 THEN 10 ELSE 0 END + CASE WHEN orders >= 12 THEN 20 WHEN orders >= 6 THEN 10 ELSE 0 END
           + CASE WHEN age_days >= 1500 THEN 20 WHEN age_days >= 500 THEN 10 ELSE 0 END)::INT AS score,
           CASE WHEN score >= 60 THEN 'Eligible' WHEN score >= 40 THEN 'Under Review' ELSE 'Rejected' END AS decision FROM f""",
    ),
]
RATES = ["cod_share", "success_rate", "return_rate", "cancel_rate"]


def features(spark, sf):
    return credit.shop_features(order_log(spark, sf), shops(spark, sf), AS_OF)


@query("cod1_features", ctes(*SHOP_FEATURES) + f"SELECT * REPLACE ({', '.join(f'{r(c)} AS {c}' for c in RATES)}) FROM f")
def cod1_features(spark, sf):
    return features(spark, sf).withColumns({c: F.bround(c, 6) for c in RATES})


@query("cod2_score", ctes(*SHOP_FEATURES) + "SELECT shop_id, score, decision FROM scored")
def cod2_score(spark, sf):
    return credit.score_shops(features(spark, sf)).select("shop_id", "score", "decision")


@query(
    "cod3_limit",
    ctes(*SHOP_FEATURES)
    + """SELECT shop_id, decision, least(floor(CASE decision WHEN 'Eligible' THEN 0.3::DOUBLE WHEN 'Under Review' THEN 0.1::DOUBLE ELSE 0::DOUBLE END * total_value), 200000)::DOUBLE AS credit_limit FROM scored""",
)
def cod3_limit(spark, sf):
    return credit.credit_limit(credit.score_shops(features(spark, sf))).select("shop_id", "decision", "credit_limit")


BASE = ["orders", "success_rate", "total_value"]


@query(
    "cod4_baseline",
    ctes(*SHOP_FEATURES)
    + f"SELECT segment, {', '.join(r(f'quantile_cont({m}, {q})', 4) + f' AS {m}_p{int(q * 100)}' for m in BASE for q in (0.25, 0.5, 0.75))} FROM f GROUP BY segment",
)
def cod4_baseline(spark, sf):
    out = credit.shop_baseline(features(spark, sf), "segment", BASE)
    return out.select("segment", *[F.bround(c, 4).alias(c) for c in out.columns if c != "segment"])


@query(
    "cod5_risk",
    ctes(*SHOP_FEATURES[:2])
    + f"""SELECT order_date::DATE AS day, count(*) AS orders, coalesce(sum(amount) FILTER (is_cod), 0)::DOUBLE AS cod_value,
      coalesce(sum(amount) FILTER (is_cod AND status IN ('returned', 'cancelled')), 0)::DOUBLE AS cod_value_lost,
      {r(div("count(*) FILTER (status IN ('returned', 'cancelled'))", 'count(*)'))} AS failure_rate FROM log GROUP BY 1""",
)
def cod5_risk(spark, sf):
    return credit.risk_monitor(order_log(spark, sf)).withColumn("failure_rate", F.bround("failure_rate", 6))

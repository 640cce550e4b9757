"""One query per basic operation of the inventory, over whole tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from bazaarlens.functions import columns as c
from bazaarlens.functions import text as t
from bazaarlens.operators import dedup
from bazaarlens.operators.lookups import explode_products, heaviest, linked, with_category
from bazaarlens.operators.ranking import group_quantiles, percentile_of, rank_within
from bazaarlens.plans.registry import div, query, r
from bazaarlens.plans.views import AS_OF, categories, channels, ctes, latest_sql, posts, products
from bazaarlens.sources.tables import table


def T(name, sql):
    """Register a query over one table: fn(df) -> df."""
    source, stem = name
    return lambda fn: query(stem, sql)(lambda spark, sf: fn(table(spark, sf, source)))


def P(stem, sql, *views, tags=False):
    """Register a query over the posts view."""
    view = "tposts" if tags else "posts"
    return lambda fn: query(stem, ctes(view, *views) + sql)(lambda spark, sf: fn(posts(spark, sf, tags=tags)))


# projection and filters ------------------------------------------------------------------

T(("orders", "prj1_project"), "SELECT o_orderkey AS order_id, o_custkey AS shop, o_totalprice * 2 AS twice FROM orders")(
    lambda d: d.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("shop"), (F.col("o_totalprice") * 2).alias("twice"))
)


@query("prj2_alias_reuse", "SELECT l_orderkey, l_linenumber, l_partkey, l_partkey % 7 AS a, l_partkey % 7 + 1 AS b FROM lineitem")
def prj2_alias_reuse(spark, sf):
    return spark.sql(
        "SELECT l_orderkey, l_linenumber, l_partkey, l_partkey % 7 AS a, a + 1 AS b FROM {lines}", lines=table(spark, sf, "lineitem")
    )


T(("part", "fil1_keys"), "SELECT p_partkey FROM part WHERE nullif(CASE WHEN p_size % 2 = 0 THEN p_brand ELSE '' END, 'Brand#4') <> ''")(
    lambda d: dedup.require_keys(
        d.select("p_partkey", F.nullif(F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).otherwise(""), F.lit("Brand#4")).alias("k")), ["k"]
    ).select("p_partkey")
)
T(("lineitem", "fil2_day"), "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_shipdate::DATE = DATE '2000-06-11'")(
    lambda d: d.filter(c.on_days("l_shipdate", "2000-06-11")).select("l_orderkey", "l_linenumber", "l_partkey")
)
T(("orders", "fil3_trailing"), f"SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '{AS_OF}' - to_days(90)")(
    lambda d: d.filter(c.trailing("o_orderdate", 90, AS_OF)).select("o_orderkey")
)
T(("orders", "fil4_bound"), "SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '2000-03-01 00:00:00'")(
    lambda d: d.filter(c.since("o_orderdate", "2000-03-01 00:00:00")).select("o_orderkey")
)
P("fil5_items", "SELECT post_base_id, updated_at FROM posts WHERE len(list_product_base_id) > 0")(
    lambda d: d.filter(c.has_items("list_product_base_id")).select("post_base_id", "updated_at")
)
P("fil6_tag", "SELECT post_base_id, updated_at FROM tposts WHERE len(list_filter(hashtags, lambda h: lower(h) = 'fyp')) > 0", tags=True)(
    lambda d: d.filter(c.has_tag("hashtags", "FYP")).select("post_base_id", "updated_at")
)
P("fil7_any_tag", "SELECT post_base_id, updated_at FROM tposts WHERE len(list_filter(hashtags, lambda h: lower(h) IN ('hot', 'red_rod'))) > 0", tags=True)(
    lambda d: d.filter(c.has_any_tag("hashtags", ["Hot", "red_rod"])).select("post_base_id", "updated_at")
)


@query("fil8_membership", "SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)")
def fil8_membership(spark, sf):
    rich = table(spark, sf, "customer").filter(F.col("c_acctbal") > 5000).select(F.col("c_custkey").alias("o_custkey"))
    orders = table(spark, sf, "orders").filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    return orders.join(rich, "o_custkey", "left_semi").select("o_orderkey")


T(("customer", "fil9_ignore_case"), "SELECT c_custkey FROM customer WHERE lower(c_mktsegment) = lower('HouseHold')")(
    lambda d: d.filter(F.lower("c_mktsegment") == "household").select("c_custkey")
)
T(("orders", "fil10_having"), "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) >= 12")(
    lambda d: d.groupBy("o_custkey").agg(F.count("*").alias("n")).filter(F.col("n") >= 12)
)

# dedup -----------------------------------------------------------------------------------

KEY = ["l_orderkey", "l_linenumber"]


def _newest():
    return dedup.newest("l_shipdate", "l_extendedprice", "l_partkey")


_VER = "PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_extendedprice DESC, l_partkey DESC"
T(("lineitem", "ded1_latest"), f"SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem QUALIFY row_number() OVER ({_VER}) = 1")(
    lambda d: dedup.latest_by(d, KEY, _newest()).select(*KEY, "l_partkey", "l_shipdate")
)
T(("lineitem", "ded2_limit_by"), "SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) <= 3")(
    lambda d: dedup.limit_by(d, 3, ["l_suppkey"], [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber"), F.asc("l_partkey")]).select("l_suppkey", *KEY, "l_partkey")
)
T(("lineitem", "ded3_duplicate_rows"), "SELECT l_orderkey, l_partkey, l_shipdate FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) >= 8)")(
    lambda d: dedup.duplicate_rows(d, "l_orderkey", 8).select("l_orderkey", "l_partkey", "l_shipdate")
)
T(("orders", "ded4_distinct"), "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")(lambda d: d.select("o_custkey", "o_orderstatus").distinct())
T(("documents", "ded5_first"), "SELECT doc_id, lang, source FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1")(
    lambda d: dedup.first_by(d, ["text"], [F.asc("doc_id")]).select("doc_id", "lang", "source")
)
T(("part", "ded6_keyword_product"), "SELECT p_type, p_name, p_partkey FROM part QUALIFY row_number() OVER (PARTITION BY p_type, p_name ORDER BY p_partkey) = 1")(
    lambda d: dedup.first_by(d, ["p_type", "p_name"], [F.asc("p_partkey")]).select("p_type", "p_name", "p_partkey")
)


@query("ded7_merge", "SELECT o_orderkey AS sku_id, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 END, o_totalprice) AS revenue, o_orderstatus AS partner_category FROM orders")
def ded7_merge(spark, sf):
    o = table(spark, sf, "orders")
    old = o.select(F.concat(F.col("o_orderkey").cast("string"), F.lit("_old")).alias("sku_id"), F.col("o_totalprice").alias("revenue"), F.col("o_orderstatus").alias("partner_category"))
    new = o.filter(F.col("o_orderkey") % 3 == 0).select(F.concat(F.col("o_orderkey").cast("string"), F.lit("_new")).alias("sku_id"), (F.col("o_totalprice") + 1).alias("revenue"), F.col("o_orderstatus").alias("partner_category"))
    return dedup.merge_master(old, new).withColumn("sku_id", F.col("sku_id").cast("bigint"))


# joins -----------------------------------------------------------------------------------


def J(stem, sql):
    return lambda fn: query(stem, sql)(lambda spark, sf: fn(lambda n: table(spark, sf, n)))


J("jn1_inner", "SELECT l_orderkey, l_linenumber, l_partkey, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND l_partkey % 5 = o_custkey % 5")(
    lambda tb: tb("lineitem").join(tb("orders"), (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("l_partkey") % 5 == F.col("o_custkey") % 5)).select(*KEY, "l_partkey", "o_custkey")
)
J("jn2_left", "SELECT c_custkey, o_orderkey FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'P') ON c_custkey = o_custkey AND c_nationkey % 2 = o_orderkey % 2")(
    lambda tb: tb("customer").join(tb("orders").filter(F.col("o_orderstatus") == "P"), (F.col("c_custkey") == F.col("o_custkey")) & (F.col("c_nationkey") % 2 == F.col("o_orderkey") % 2), "left").select("c_custkey", "o_orderkey")
)


@query(
    "jn3_lookup",
    ctes("posts", "products", "categories", "named", ("l", "SELECT post_base_id, updated_at, unnest(list_product_base_id) AS product_base_id FROM posts"))
    + "SELECT post_base_id, updated_at, product_base_id, coalesce(category, 'Unknown') AS category, coalesce(brand, 'Unknown') AS brand FROM l LEFT JOIN named USING (product_base_id)",
)
def jn3_lookup(spark, sf):
    links = explode_products(posts(spark, sf), ["post_base_id", "updated_at"]).drop("product_count")
    return with_category(links, products(spark, sf), categories(spark, sf))


J("jn4_semi", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")(
    lambda tb: tb("customer").join(tb("orders").filter(F.col("o_totalprice") > 400000).select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi").select("c_custkey")
)
J("jn5_anti", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")(
    lambda tb: tb("customer").join(tb("orders").filter(F.col("o_totalprice") > 400000).select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey")
)


@query("jn6_windows", f"SELECT o_orderkey, d::INT AS window_days FROM orders CROSS JOIN (VALUES (30), (400)) w(d) WHERE o_orderdate >= TIMESTAMP '{AS_OF}' - to_days(d)")
def jn6_windows(spark, sf):
    from bazaarlens.operators.creators import scope_windows

    return scope_windows(table(spark, sf, "orders"), (30, 400), AS_OF, "o_orderdate").select("o_orderkey", "window_days")


P("jn7_unnest", "SELECT post_base_id, updated_at, unnest(list_product_base_id) AS product_base_id FROM posts")(
    lambda d: explode_products(d, ["post_base_id", "updated_at"]).drop("product_count")
)


@query(
    "jn8_full",
    "SELECT coalesce(k, j) AS suppkey, coalesce(a, 0) AS before, coalesce(b, 0) AS after FROM (SELECT s_suppkey AS k, s_acctbal AS a FROM supplier WHERE s_suppkey % 3 <> 0) FULL JOIN (SELECT s_suppkey AS j, s_acctbal * 2 AS b FROM supplier WHERE s_suppkey % 2 = 0) ON k = j",
)
def jn8_full(spark, sf):
    s = table(spark, sf, "supplier").withColumnRenamed("s_suppkey", "suppkey")
    a = s.filter(F.col("suppkey") % 3 != 0).select("suppkey", F.col("s_acctbal").alias("a"))
    b = s.filter(F.col("suppkey") % 2 == 0).select("suppkey", (F.col("s_acctbal") * 2).alias("b"))
    return a.join(b, "suppkey", "full").select("suppkey", F.coalesce("a", F.lit(0.0)).alias("before"), F.coalesce("b", F.lit(0.0)).alias("after"))


@query("jn9_ordinal", "SELECT o_orderkey AS ordinal, o_orderkey * 3 AS session_id, o_orderpriority AS doc FROM orders")
def jn9_ordinal(spark, sf):
    from bazaarlens.operators.live import pair_by_ordinal

    o = table(spark, sf, "orders")
    ids = o.select(
        F.col("o_orderkey").alias("ordinal"),
        F.struct(F.struct(F.struct((F.col("o_orderkey") * 3).alias("sessionId")).alias("liveInfo")).alias("data")).alias("data"),
    )
    return pair_by_ordinal(o.select(F.col("o_orderkey").alias("ordinal"), F.col("o_orderpriority").alias("doc")), ids)


J("jn10_map", "SELECT c_custkey, coalesce(n, 0) AS orders FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) ON c_custkey = o_custkey")(
    lambda tb: tb("customer").join(tb("orders").filter(F.col("o_orderstatus") == "P").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n")), "c_custkey", "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("orders"))
)

# aggregation -----------------------------------------------------------------------------

SUP = "l_suppkey"
T(("lineitem", "ag1_count"), "SELECT l_suppkey, count(*) AS n, count(nullif(l_returnflag, 'N')) AS known FROM lineitem GROUP BY 1")(
    lambda d: d.groupBy(SUP).agg(F.count("*").alias("n"), F.count(F.nullif("l_returnflag", F.lit("N"))).alias("known"))
)
T(("lineitem", "ag2_distinct"), "SELECT l_suppkey, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_orderkey) AS orders FROM lineitem GROUP BY 1")(
    lambda d: d.groupBy(SUP).agg(F.countDistinct("l_partkey").alias("parts"), F.countDistinct("l_orderkey").alias("orders"))
)
T(("lineitem", "ag3_sum"), "SELECT l_suppkey, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS value FROM lineitem GROUP BY 1")(
    lambda d: d.groupBy(SUP).agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("value"))
)
T(("lineitem", "ag4_max"), "SELECT l_suppkey, max(l_shipdate) AS last, min(l_shipdate) AS first FROM lineitem GROUP BY 1")(
    lambda d: d.groupBy(SUP).agg(F.max("l_shipdate").alias("last"), F.min("l_shipdate").alias("first"))
)
T(("orders", "ag5_any"), "SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS some FROM orders GROUP BY 1")(
    lambda d: d.groupBy("o_custkey").agg(F.min_by("o_orderpriority", "o_orderkey").alias("some"))
)


@query("ag6_argmax", "SELECT l_suppkey, l_partkey FROM (SELECT l_suppkey, l_partkey, count(*) AS n FROM lineitem GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_partkey) = 1")
def ag6_argmax(spark, sf):
    n = table(spark, sf, "lineitem").groupBy(SUP, "l_partkey").agg(F.count("*").alias("n"))
    return heaviest(n, [SUP], ["l_partkey"], "n")


@query("ag7_joint_argmax", "SELECT l_suppkey, l_returnflag, l_linestatus FROM (SELECT l_suppkey, l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2, 3) QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_returnflag, l_linestatus) = 1")
def ag7_joint_argmax(spark, sf):
    n = table(spark, sf, "lineitem").groupBy(SUP, "l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))
    return heaviest(n, [SUP], ["l_returnflag", "l_linestatus"], "n")


# the counts per flag are at most three per supplier, per priority five per customer
T(("lineitem", "ag8_sorted_tuples"), "SELECT l_suppkey, string_agg(l_returnflag || ':' || n, ',' ORDER BY n DESC, l_returnflag) AS flags FROM (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2) GROUP BY 1")(
    lambda d: d.groupBy(SUP, "l_returnflag").agg(F.count("*").alias("n")).groupBy(SUP).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "l_returnflag"))), lambda x: F.concat(x["l_returnflag"], F.lit(":"), (-x["m"]).cast("string"))), ",").alias("flags")
    )
)
T(("orders", "ag9_unique_set"), "SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS priorities FROM orders GROUP BY 1")(
    lambda d: d.groupBy("o_custkey").agg(F.array_join(F.array_sort(F.collect_set("o_orderpriority")), ",").alias("priorities"))
)


@query("ag10_median_if", "SELECT l_suppkey, median(CASE WHEN l_discount > 0.02 THEN l_extendedprice / nullif(l_quantity, 0) END) AS med FROM lineitem GROUP BY 1")
def ag10_median_if(spark, sf):
    value = F.when(F.col("l_discount") > 0.02, c.ratio("l_extendedprice", "l_quantity"))
    return group_quantiles(table(spark, sf, "lineitem"), [SUP], {"med": (value, 0.5)})


T(("lineitem", "ag11_count_if"), f"SELECT l_suppkey, count(*) FILTER (l_returnflag = 'R') AS n, {r(div("count(*) FILTER (l_returnflag = 'R')", "count(*)"))} AS part FROM lineitem GROUP BY 1")(
    lambda d: d.groupBy(SUP).agg(F.count_if(F.col("l_returnflag") == "R").alias("n"), F.bround(c.ratio(F.count_if(F.col("l_returnflag") == "R"), F.count("*")), 6).alias("part"))
)
T(("orders", "ag12_first_non_null"), "SELECT o_custkey, arg_min(nullif(o_orderstatus, 'F'), o_orderkey) FILTER (o_orderstatus <> 'F') AS status FROM orders GROUP BY 1")(
    lambda d: d.withColumn("s", F.nullif("o_orderstatus", F.lit("F"))).groupBy("o_custkey").agg(F.min_by("s", F.when(F.col("s").isNotNull(), F.col("o_orderkey"))).alias("status"))
)
# the output row is the group's text itself: this form is for groups that fit a row
T(("orders", "ag13_concat"), "SELECT o_custkey, string_agg(lower(o_orderpriority), ' ' ORDER BY o_orderkey) AS words FROM orders GROUP BY 1")(
    lambda d: d.groupBy("o_custkey").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", F.lower("o_orderpriority").alias("w")))), lambda x: x["w"]), " ").alias("words")
    )
)
T(("documents", "ag14_value_counts"), "SELECT lang, count(*) AS n FROM documents GROUP BY 1")(lambda d: d.groupBy("lang").agg(F.count("*").alias("n")))
T(("orders", "ag15_pivot"), "SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'P') AS p, count(*) FILTER (o_orderstatus = 'X') AS x FROM orders GROUP BY 1")(
    lambda d: d.groupBy("o_custkey").pivot("o_orderstatus", ["F", "P", "X"]).agg(F.count(F.lit(1))).select(
        "o_custkey", *[F.coalesce(v, F.lit(0)).alias(v.lower()) for v in ("F", "P", "X")]
    )
)


@query("ag16_broadcast_back", f"SELECT l_suppkey, l_partkey, n, {r(div('n', 'sum(n) OVER (PARTITION BY l_suppkey)'))} AS part FROM (SELECT l_suppkey, l_partkey, sum(l_quantity)::BIGINT AS n FROM lineitem GROUP BY 1, 2)")
def ag16_broadcast_back(spark, sf):
    n = table(spark, sf, "lineitem").groupBy(SUP, "l_partkey").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("n"))
    totals = n.groupBy(SUP).agg(F.sum("n").alias("total"))
    return n.join(totals, SUP).select(SUP, "l_partkey", "n", F.bround(c.ratio("n", "total"), 6).alias("part"))


T(("lineitem", "ag17_tolerance"), "SELECT l_orderkey, count(*) AS n_rows, sum(l_discount::DECIMAL(18,6))::DOUBLE AS total, count(*) >= 2 AND abs(sum(l_discount::DECIMAL(18,6))::DOUBLE - 0.2) <= 0.05 AS ok FROM lineitem GROUP BY 1")(
    lambda d: d.groupBy("l_orderkey").agg(F.count("*").alias("n_rows"), F.sum(F.col("l_discount").cast("decimal(18,6)")).cast("double").alias("total")).withColumn(
        "ok", (F.col("n_rows") >= 2) & (F.abs(F.col("total") - 0.2) <= 0.05)
    )
)


@query("ag18_upper_quantile", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_extendedprice >= (SELECT quantile_cont(l_extendedprice, 0.75) FROM lineitem)")
def ag18_upper_quantile(spark, sf):
    from bazaarlens.operators.ranking import group_quantiles

    d = table(spark, sf, "lineitem").withColumn("_one", F.lit(1))
    cut = group_quantiles(d, ["_one"], {"p": (F.col("l_extendedprice"), 0.75)})
    # a single row
    return d.join(F.broadcast(cut), "_one").filter(F.col("l_extendedprice") >= F.col("p")).select(*KEY, "l_partkey")


T(("lineitem", "ag19_partial"), "SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity)::BIGINT AS units FROM lineitem GROUP BY 1, 2")(
    lambda d: d.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("units"))
)

# windows, order, sets --------------------------------------------------------------------


@query("wn2_dense_rank", "SELECT l_suppkey, dense_rank() OVER (ORDER BY count(*) DESC)::INT AS rk FROM lineitem GROUP BY 1 QUALIFY rk <= 10")
def wn2_dense_rank(spark, sf):
    n = table(spark, sf, "lineitem").groupBy(SUP).agg(F.count("*").alias("n"))
    return n.select(SUP, F.dense_rank().over(Window.orderBy(F.desc("n"))).alias("rk")).filter(F.col("rk") <= 10)


T(("orders", "wn1_row_number"), "SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey)::INT AS rn FROM orders QUALIFY rn <= 5")(
    lambda d: d.withColumn("rn", F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_orderdate"), "o_orderkey"))).filter(F.col("rn") <= 5).select("o_custkey", "o_orderkey", "rn")
)


@query("wn3_percentile", "SELECT c_custkey, round_even(100.0::DOUBLE * (rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal) - 1) / nullif(count(*) OVER (PARTITION BY c_nationkey) - 1, 0), 0)::INT AS pctile FROM customer")
def wn3_percentile(spark, sf):
    d = rank_within(table(spark, sf, "customer"), ["c_custkey"], ["c_nationkey"], {"rk": "c_acctbal"}, "n")
    return d.select("c_custkey", percentile_of("rk", "n").alias("pctile"))


J("wn4_group_count", "SELECT c_custkey, count(*) OVER (PARTITION BY c_nationkey) AS n FROM customer")(
    lambda tb: tb("customer").join(tb("customer").groupBy("c_nationkey").agg(F.count("*").alias("n")), "c_nationkey").select("c_custkey", "n")
)
J("wn5_group_sum", "SELECT c_custkey, (sum(c_acctbal::DECIMAL(18,2)) OVER (PARTITION BY c_nationkey))::DOUBLE AS total FROM customer")(
    lambda tb: tb("customer").join(tb("customer").groupBy("c_nationkey").agg(F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double").alias("total")), "c_nationkey").select("c_custkey", "total")
)
T(("part", "wn6_top_n"), "SELECT p_brand, p_partkey FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) <= 4")(
    lambda d: dedup.limit_by(d, 4, ["p_brand"], [F.desc("p_retailprice"), F.asc("p_partkey")]).select("p_brand", "p_partkey")
)
T(("part", "so1_sort"), "SELECT p_partkey, p_brand, p_size FROM part")(lambda d: d.orderBy("p_brand", F.desc("p_size"), "p_partkey").select("p_partkey", "p_brand", "p_size"))
P("so2_array_sort", "SELECT post_base_id, updated_at, list_aggregate(list_sort(hashtags), 'string_agg', '|') AS tags FROM tposts WHERE len(hashtags) > 0", tags=True)(
    lambda d: d.filter(c.has_items("hashtags")).select("post_base_id", "updated_at", F.array_join(F.array_sort("hashtags"), "|").alias("tags"))
)
T(("lineitem", "so3_nlargest"), "SELECT l_suppkey, l_partkey, n FROM (SELECT l_suppkey, l_partkey, sum(l_quantity)::BIGINT AS n FROM lineitem GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_partkey) <= 5")(
    lambda d: dedup.limit_by(d.groupBy(SUP, "l_partkey").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("n")), 5, [SUP], [F.desc("n"), F.asc("l_partkey")])
)
P("so4_nth", "SELECT post_base_id, updated_at, coalesce(list_product_base_id[2], -1) AS second FROM posts")(
    lambda d: d.select("post_base_id", "updated_at", c.nth("list_product_base_id", 2, F.lit(-1).cast("bigint")).alias("second"))
)


@query(
    "so5_hierarchy",
    """WITH n AS (SELECT p_type AS category, p_brand AS brand, p_name AS hashtag, count(*) AS count_unique_video FROM part GROUP BY ALL),
       cr AS (SELECT category, dense_rank() OVER (ORDER BY sum(count_unique_video) DESC)::INT AS cat_rk FROM n GROUP BY 1),
       br AS (SELECT category, brand, row_number() OVER (PARTITION BY category ORDER BY sum(count_unique_video) DESC, brand)::INT AS brand_rk FROM n GROUP BY 1, 2),
       hr AS (SELECT *, row_number() OVER (PARTITION BY category, brand ORDER BY count_unique_video DESC, hashtag)::INT AS hashtag_rk FROM n)
       SELECT * FROM hr JOIN br USING (category, brand) JOIN cr USING (category) WHERE cat_rk <= 3 AND brand_rk <= 4 AND hashtag_rk <= 5""",
)
def so5_hierarchy(spark, sf):
    from bazaarlens.operators.videos import leaderboard

    n = table(spark, sf, "part").groupBy(F.col("p_type").alias("category"), F.col("p_brand").alias("brand"), F.col("p_name").alias("hashtag")).agg(
        F.count("*").alias("count_unique_video")
    )
    return leaderboard(n, (3, 4, 5))


T(("embeddings", "so6_topk"), "SELECT vec_id, list_sort(list_transform(range(64), lambda i: {'m': -embedding[i + 1], 'i': i}))[1].i::INT AS best FROM embeddings")(
    lambda d: d.select("vec_id", F.array_sort(F.transform("embedding", lambda x, i: F.struct((-x).alias("m"), i.alias("i"))))[0]["i"].cast("int").alias("best"))
)
J("st1_union", "SELECT o_orderkey AS k, o_orderstatus AS s, NULL::BIGINT AS extra FROM orders UNION ALL SELECT l_orderkey, l_linestatus, l_partkey FROM lineitem")(
    lambda tb: tb("orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s")).unionByName(
        tb("lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linestatus").alias("s"), F.col("l_partkey").alias("extra")), allowMissingColumns=True
    )
)
J("st2_difference", "SELECT DISTINCT o_orderkey AS k FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")(
    lambda tb: tb("orders").select(F.col("o_orderkey").alias("k")).join(tb("lineitem").select(F.col("l_orderkey").alias("k")), "k", "left_anti").distinct()
)

# scalar, array and text functions --------------------------------------------------------

T(("part", "f1_nulls"), "SELECT p_partkey, coalesce(nullif(p_brand, 'Brand#1'), 'none') AS brand FROM part")(
    lambda d: d.select("p_partkey", c.blank_to(F.when(F.col("p_brand") == "Brand#1", "").otherwise(F.col("p_brand")), "none").alias("brand"))
)
T(("customer", "f2_cascade"), "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'low' ELSE 'high' END AS state FROM customer")(
    lambda d: d.select("c_custkey", c.cascade([(F.col("c_acctbal") < 0, "debt"), (F.col("c_acctbal") < 5000, "low")], "high").alias("state"))
)
T(("orders", "f3_casts"), "SELECT o_orderkey, try_cast(o_orderpriority[1] AS DOUBLE) AS a, try_cast(o_orderpriority AS DOUBLE) AS b, o_orderdate::DATE AS day FROM orders")(
    lambda d: d.select("o_orderkey", c.to_number(F.substring("o_orderpriority", 1, 1)).alias("a"), c.to_number("o_orderpriority").alias("b"), F.col("o_orderdate").cast("date").alias("day"))
)
T(("lineitem", "f4_round"), "SELECT l_orderkey, l_linenumber, l_partkey, round_even(l_quantity / 2, 0)::DOUBLE AS half FROM lineitem")(
    lambda d: d.select(*KEY, "l_partkey", c.half_even(F.col("l_quantity") / 2, 0).alias("half"))
)
T(("lineitem", "f5_divide"), "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity / nullif(l_linenumber - 3, 0) AS q FROM lineitem")(
    lambda d: d.select(*KEY, "l_partkey", c.ratio("l_quantity", F.col("l_linenumber") - 3).alias("q"))
)
P("f6_length", "SELECT post_base_id, updated_at, len(list_product_base_id)::INT AS n FROM posts")(
    lambda d: d.select("post_base_id", "updated_at", F.size("list_product_base_id").alias("n"))
)
P("f7_filter", "SELECT post_base_id, updated_at, array_to_string(list_filter(hashtags, lambda h: lower(h) IN ('hot', '#fyp', 'small ring')), '|') AS m FROM tposts", tags=True)(
    lambda d: d.select("post_base_id", "updated_at", F.array_join(c.matched_tags("hashtags", ["HOT", "#fyp", "Small Ring"]), "|").alias("m"))
)
T(("orders", "f8_struct"), "SELECT o_orderkey, o_custkey + 1 AS b FROM orders")(
    lambda d: d.select("o_orderkey", F.struct(F.col("o_orderkey").alias("a"), (F.col("o_custkey") + 1).alias("b")).alias("s")).select("o_orderkey", "s.b")
)
T(("documents", "f9_lower"), "SELECT doc_id, md5(lower(text)) AS low FROM documents")(lambda d: d.select("doc_id", F.md5(F.lower("text").cast("binary")).alias("low")))
T(("documents", "f10_regex"), "SELECT doc_id FROM documents WHERE regexp_matches(lower(text), 'threea|ungder|(^|[^a-z])quevi([^a-z]|$)')")(
    lambda d: d.filter(t.pattern_hit(F.lower("text"), "threea|ungder|(^|[^a-z])quevi([^a-z]|$)")).select("doc_id")
)
T(("documents", "f11_offset"), "SELECT doc_id, CASE WHEN contains(lower(text), 'the ') THEN instr(lower(text), 'the ') - 1 END::INT AS pos FROM documents")(
    lambda d: d.select("doc_id", t.first_offset(F.lower("text"), "the ").alias("pos"))
)
T(("documents", "f12_escape"), "SELECT doc_id FROM documents WHERE contains(text, 'a.') OR contains(text, '%%') OR contains(text, '$*')")(
    lambda d: d.filter(t.pattern_hit("text", t.any_of(["a.", "%%", "$*"]))).select("doc_id")
)
T(("part", "f13_contains"), "SELECT p_partkey FROM part WHERE contains(p_name, 'old') OR contains(p_name, 'izmo')")(
    lambda d: d.filter(t.contains_any("p_name", ["old", "izmo"])).select("p_partkey")
)
T(("customer", "f14_suffix"), "SELECT c_custkey, c_name AS name FROM customer")(
    lambda d: d.select("c_custkey", t.strip_suffix(F.concat("c_name", F.when(F.col("c_custkey") % 2 == 0, "_old").otherwise("_new"))).alias("name"))
)
T(("part", "f15_sentence"), "SELECT p_partkey, upper(p_name[1]) || lower(p_name[2:]) || ' nam' AS s FROM part")(
    lambda d: d.select("p_partkey", t.sentence_case(F.concat(F.lit("  "), F.upper(F.replace("p_name", F.lit(" "), F.lit("   "))), F.lit("\t NAM "))).alias("s"))
)
T(("documents", "f17_fold"), "SELECT doc_id, md5(trim(regexp_replace(strip_accents(lower(text)), '[^a-z0-9]+', ' ', 'g'))) AS folded FROM documents")(
    lambda d: d.select("doc_id", F.md5(t.fold("text").cast("binary")).alias("folded"))
)
T(("part", "f18_hashtag"), "SELECT p_partkey, lower(p_name) || ' x' AS tag FROM part")(
    lambda d: d.select("p_partkey", t.fold_hashtag(F.concat(F.lit("#"), F.replace(F.initcap("p_name"), F.lit(" "), F.lit("")), F.lit("_x"))).alias("tag"))
)
T(("part", "f19_stop"), "SELECT p_partkey, array_to_string(list_filter(string_split(p_name, ' '), lambda w: w NOT IN ('red', 'rod')), ' ') AS words FROM part")(
    lambda d: d.select("p_partkey", F.array_join(t.drop_stop_terms(F.split("p_name", " "), ["red", "rod"]), " ").alias("words"))
)
T(("documents", "f20_mojibake"), "SELECT doc_id, md5(text) AS text FROM documents")(
    # spoil the texts by reading their UTF-8 bytes as Latin-1, then repair them
    lambda d: d.select("doc_id", F.md5(t.repair_mojibake(F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")).cast("binary")).alias("text"))
)
T(("orders", "f21_times"), "SELECT o_orderkey, strftime(TIMESTAMP '1970-01-01' + to_milliseconds(o_orderkey * 123456789) + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') AS at FROM orders")(
    lambda d: d.select("o_orderkey", c.local_time(F.col("o_orderkey") * 123456789).alias("at"))
)
T(("part", "f22_template"), "SELECT p_partkey, '1__' || p_partkey || '__' || p_size AS id, 'https://shopee.vn/product/' || p_size || '/' || p_partkey AS url FROM part")(
    lambda d: d.select("p_partkey", F.concat_ws("__", F.lit("1"), F.col("p_partkey").cast("string"), F.col("p_size").cast("string")).alias("id"), F.format_string("https://shopee.vn/product/%d/%d", "p_size", "p_partkey").alias("url"))
)
T(("events", "f23_json"), "SELECT event_id, coalesce((props->>'$.k')::BIGINT, -1) AS k, coalesce(props->>'$.z', 'none') AS z FROM events")(
    lambda d: d.withColumn("p", F.from_json("props", "k bigint, z string")).select("event_id", F.coalesce("p.k", F.lit(-1)).alias("k"), F.coalesce("p.z", F.lit("none")).alias("z"))
)
T(("orders", "f24_dates"), "SELECT o_orderkey, o_orderdate::DATE - 90 AS before, (o_orderdate - to_days(7))::DATE AS week FROM orders")(
    lambda d: d.select("o_orderkey", F.date_sub("o_orderdate", 90).alias("before"), (F.col("o_orderdate") - F.make_dt_interval(days=F.lit(7))).cast("date").alias("week"))
)
J("f25_second_source", "SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END, v, 0) AS value FROM orders LEFT JOIN (SELECT l_orderkey, max(l_extendedprice) AS v FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey")(
    lambda tb: tb("orders").join(tb("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_extendedprice").alias("v")), "o_orderkey", "left").select(
        "o_orderkey", F.coalesce(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")), "v", F.lit(0.0)).alias("value")
    )
)

"""Domain views over the given tables, each with the same view as SQL text.

posts       one row per line of an order: line = crawl version of a post, key repeats are
            versions, the part (and sometimes a second one) is the linked product
products    parts; the category id is a cast lookup key and partly unknown
categories  regions
channels    customers with two crawl versions each
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.sources.tables import table

AS_OF = "2001-08-02"
WINDOWS = (365, 730, 1825)


def posts(spark: SparkSession, sf: str, tags: bool = False) -> DataFrame:
    return with_tags(raw_posts(spark, sf, True)) if tags else raw_posts(spark, sf)


def with_tags(raw: DataFrame) -> DataFrame:
    """Hashtags and description of raw posts, in place of the short columns that they are made of."""
    units = F.col("reaction_count")
    # a third of the lines carries the generic tag, some of them twice
    generic = F.when(F.col("l_linenumber") <= 2, F.array(F.lit("FYP"), F.lit("#fyp"))).otherwise(
        F.array().cast("array<string>")
    )
    spelled = F.when(units % 10 == 0, F.array(F.initcap("p_name"))).otherwise(F.array().cast("array<string>"))
    none = F.array().cast("array<string>")
    return raw.select(
        *[c for c in raw.columns if c not in ("l_linenumber", "o_orderpriority", "p_name")],
        F.when(units % 9 == 0, none)
        .otherwise(F.concat(F.split("p_name", " "), F.array(F.replace("p_name", F.lit(" "), F.lit("_"))), generic, spelled))
        .alias("hashtags"),
        F.concat_ws(" ", F.when(units % 4 == 0, F.lit("only the")), "p_name", F.lower("o_orderpriority")).alias("description"),
    )


def raw_posts(spark: SparkSession, sf: str, tags: bool = False) -> DataFrame:
    line = table(spark, sf, "lineitem")
    order = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    df = line.join(order, F.col("l_orderkey") == F.col("o_orderkey"))
    if tags:
        df = df.join(table(spark, sf, "part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    units = F.col("l_quantity").cast("bigint")
    post = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    extra = ["l_linenumber", "o_orderpriority", "p_name"] if tags else []
    return df.select(
        post.alias("post_base_id"),
        post.alias("post_id_platform"),
        F.col("o_custkey").alias("channel_base_id"),
        F.col("o_custkey").alias("channel_id"),
        F.concat(F.lit("channel "), F.col("o_custkey").cast("string")).alias("channel_name"),
        F.col("o_orderdate").alias("created_at_platform"),
        F.col("l_shipdate").alias("updated_at"),
        (F.col("l_shipdate") + F.make_dt_interval(hours=units.cast("int"))).alias("last_time_crawled_at"),
        F.when(units != 13, F.floor("l_extendedprice")).alias("view_count"),
        units.alias("reaction_count"),
        (F.col("l_linenumber") + F.floor(F.col("l_discount") * 100)).alias("comment_count"),
        F.floor(F.col("l_tax") * 100).alias("share_count"),
        (units % 7).alias("collect_count"),
        F.when(F.col("l_tax") < 0.02, F.array().cast("array<bigint>"))
        .when(F.col("l_discount") >= 0.05, F.array_distinct(F.array("l_partkey", "l_suppkey")))
        .otherwise(F.array("l_partkey"))
        .alias("list_product_base_id"),
        *extra,
    )


def products(spark: SparkSession, sf: str) -> DataFrame:
    brand = F.when(F.col("p_brand") == "Brand#1", F.lit("")).when(F.col("p_brand") != "Brand#2", F.col("p_brand"))
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_base_id"),
        (F.col("p_size") % 6).cast("bigint").alias("categories__id_1"),
        brand.alias("brand"),
        F.col("p_type").alias("category_l2"),
        F.col("p_retailprice").alias("price"),
        F.col("p_name").alias("product_name"),
    )


def categories(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "region").select(
        F.col("r_regionkey").cast("string").alias("category_id"), F.col("r_name").alias("category_name")
    )


def channels(spark: SparkSession, sf: str) -> DataFrame:
    owed = F.greatest(F.col("c_acctbal"), F.lit(0.0))
    nation = table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    return (
        table(spark, sf, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "c_name", "n_regionkey", owed.alias("owed"), F.explode(F.array(F.lit(0), F.lit(1))).alias("v"))
        .select(
            F.col("c_custkey").alias("channel_base_id"),
            F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("country"),
            F.floor(F.col("owed") * F.col("owed") / F.when(F.col("v") == 0, 50.0).otherwise(100.0)).alias("follower_count"),
            F.when(F.col("v") == 0, F.lit("2001-01-01")).otherwise(F.lit("2001-06-01")).cast("timestamp_ntz").alias("updated_at"),
            F.concat_ws(" ", F.lit("shop"), "c_name").alias("bio"),
        )
    )


# ---------------------------------------------------------------------------------------
# the same views as SQL

_POST_COLS = """
  l_orderkey * 8 + l_linenumber AS post_base_id, l_orderkey * 8 + l_linenumber AS post_id_platform,
  o_custkey AS channel_base_id, o_custkey AS channel_id, 'channel ' || o_custkey AS channel_name,
  o_orderdate AS created_at_platform, l_shipdate AS updated_at,
  l_shipdate + to_hours(l_quantity::INT) AS last_time_crawled_at,
  CASE WHEN l_quantity <> 13 THEN floor(l_extendedprice)::BIGINT END AS view_count,
  l_quantity::BIGINT AS reaction_count,
  l_linenumber + floor(l_discount * 100)::BIGINT AS comment_count,
  floor(l_tax * 100)::BIGINT AS share_count, l_quantity::BIGINT % 7 AS collect_count,
  CASE WHEN l_tax < 0.02 THEN []::BIGINT[]
       WHEN l_discount >= 0.05 AND l_partkey <> l_suppkey THEN [l_partkey, l_suppkey]
       ELSE [l_partkey] END AS list_product_base_id"""

_TAG_COLS = """,
  CASE WHEN l_quantity::BIGINT % 9 = 0 THEN []::VARCHAR[] ELSE
    string_split(p_name, ' ') || [replace(p_name, ' ', '_')]
    || CASE WHEN l_linenumber <= 2 THEN ['FYP', '#fyp'] ELSE []::VARCHAR[] END
    || CASE WHEN l_quantity::BIGINT % 10 = 0 THEN
         [list_aggregate(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', ' ')]
       ELSE []::VARCHAR[] END END AS hashtags,
  CASE WHEN l_quantity::BIGINT % 4 = 0 THEN 'only the ' ELSE '' END || p_name || ' ' || lower(o_orderpriority) AS description"""

VIEW_SQL = {
    "posts": f"SELECT {_POST_COLS} FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
    "tposts": f"SELECT {_POST_COLS}{_TAG_COLS} FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey",
    "products": """SELECT p_partkey AS product_base_id, (p_size % 6)::BIGINT AS categories__id_1,
        CASE p_brand WHEN 'Brand#1' THEN '' WHEN 'Brand#2' THEN NULL ELSE p_brand END AS brand,
        p_type AS category_l2, p_retailprice AS price, p_name AS product_name FROM part""",
    "categories": "SELECT r_regionkey::VARCHAR AS category_id, r_name AS category_name FROM region",
    "channels": """SELECT c_custkey AS channel_base_id, 'R' || n_regionkey AS country,
        floor(greatest(c_acctbal, 0.0) * greatest(c_acctbal, 0.0) / CASE v WHEN 0 THEN 50.0::DOUBLE ELSE 100.0::DOUBLE END)::BIGINT AS follower_count,
        CASE v WHEN 0 THEN TIMESTAMP '2001-01-01' ELSE TIMESTAMP '2001-06-01' END AS updated_at,
        'shop ' || c_name AS bio
        FROM customer JOIN nation ON c_nationkey = n_nationkey CROSS JOIN (VALUES (0), (1)) t(v)""",
    # a product with its category and brand names
    "named": """SELECT p.product_base_id, coalesce(c.category_name, 'Unknown') AS category,
        coalesce(nullif(p.brand, ''), 'Unknown') AS brand, p.category_l2
        FROM products p LEFT JOIN categories c ON p.categories__id_1::VARCHAR = c.category_id""",
}


def ctes(*parts: str | tuple[str, str]) -> str:
    """WITH clause from view names and (name, select) pairs."""
    texts = [(p, VIEW_SQL[p]) if isinstance(p, str) else p for p in parts]
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in texts) + "\n"


def latest_sql(source: str, key: str, where: str = "TRUE") -> str:
    order = "updated_at DESC NULLS LAST, last_time_crawled_at DESC NULLS LAST, view_count DESC NULLS LAST"
    return f"SELECT * FROM {source} WHERE {where} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1"

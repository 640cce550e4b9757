"""Product and category lookups over linked posts.

No side is broadcast by hand: Spark compares the dimension's size with
``spark.sql.autoBroadcastJoinThreshold`` and falls back to a sort-merge join, whose hot
product keys adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions.columns import blank_to, has_items


def linked(posts: DataFrame) -> DataFrame:
    return posts.filter(has_items("list_product_base_id"))


def explode_products(posts: DataFrame, keep: Sequence[str | Column]) -> DataFrame:
    """One row per linked product with the link count of the post; posts without links drop out."""
    return posts.select(
        *keep,
        F.size("list_product_base_id").alias("product_count"),
        F.explode("list_product_base_id").alias("product_base_id"),
    )


def with_category(df: DataFrame, products: DataFrame, categories: DataFrame) -> DataFrame:
    """Left lookup product -> category and brand; unknown ones become 'Unknown'."""
    known = products.select(
        "product_base_id", F.col("categories__id_1").cast("string").alias("category_id"), F.col("brand").alias("_brand")
    )
    names = categories.select("category_id", "category_name")
    return (
        df.join(known, "product_base_id", "left")
        .join(names, "category_id", "left")
        .withColumn("category", F.coalesce("category_name", F.lit("Unknown")))
        .withColumn("brand", blank_to("_brand", "Unknown"))
        .drop("category_id", "category_name", "_brand")
    )


def heaviest(df: DataFrame, keys: Sequence[str], pick: Sequence[str], weight: str) -> DataFrame:
    """Per key the ``pick`` values of the row with the largest weight; ties take the smallest values.

    NULL weights never win. All picked values come from the same row.
    """
    best = F.min_by(F.struct(*pick), F.struct((-F.col(weight)).alias("_w"), *pick))
    return (
        df.filter(F.col(weight).isNotNull())
        .groupBy(*keys)
        .agg(best.alias("_best"))
        .select(*keys, *[F.col(f"_best.{p}").alias(p) for p in pick])
    )


def dominant_category(
    posts: DataFrame, products: DataFrame, categories: DataFrame, keys: Sequence[str], with_brand: bool = False
) -> DataFrame:
    """Category (and brand, from the same row) that most linked products of a post have."""
    pick = ["category", "brand"] if with_brand else ["category"]
    counts = (
        with_category(explode_products(posts, keys), products, categories)
        .groupBy(*keys, *pick)
        .agg(F.count("*").alias("product_cnt"))
    )
    return heaviest(counts, keys, pick, "product_cnt")

"""Hashtag purity and the dictionaries built from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.functions.columns import ratio
from bazaarlens.operators.creators import ALLOWED_NICHES
from bazaarlens.operators.dedup import limit_by

# Brands that stand for no brand.
NOISE_BRANDS = ("Unknown", "Không Có")


def add_purity(counts: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """purity = n / sum of n over the groups of a hashtag; disc_score = n * purity^2.

    The input has one row per group and hashtag, so a hashtag's window holds at most as many
    rows as there are groups, however popular the hashtag is.
    """
    n = F.col("count_unique_video")
    total = F.sum(n).over(Window.partitionBy(*scope, "hashtag"))
    return counts.withColumn("purity", ratio(n, total)).withColumn("disc_score", n * (F.col("purity") * F.col("purity")))


def _listed(scored: DataFrame, keys: Sequence[str], min_purity: float, min_count: int, top: int) -> DataFrame:
    """Best ``top`` hashtags per key as one list; the list is bounded by ``top``."""
    kept = scored.filter((F.col("purity") >= min_purity) & (F.col("count_unique_video") >= min_count))
    best = limit_by(kept, top, keys, [F.desc("disc_score"), F.asc("hashtag")])
    order = F.array_sort(F.collect_list(F.struct((-F.col("disc_score")).alias("s"), "hashtag")))
    return best.groupBy(*keys).agg(
        F.count("*").alias("hashtag_count"),
        F.array_join(F.transform(order, lambda x: x["hashtag"]), ", ").alias("list_hashtag"),
    )


def category_dictionary(
    counts: DataFrame,
    min_purity: float = 0.5,
    min_count: int = 30,
    top: int = 200,
    targets: Sequence[str] | None = ALLOWED_NICHES,
    scope_before_filter: bool = False,
) -> DataFrame:
    """Typical hashtags per category.

    By default the target categories are selected first, so purity compares only them;
    ``scope_before_filter`` measures purity over all categories.
    """
    keep = F.lit(True) if targets is None else F.col("category").isin(list(targets))
    scored = add_purity(counts).filter(keep) if scope_before_filter else add_purity(counts.filter(keep))
    out = _listed(scored, ["category"], min_purity, min_count, top)
    return out.select(F.col("category").alias("cate"), F.lit("").alias("brand"), "hashtag_count", "list_hashtag")


def brand_dictionary(
    counts: DataFrame,
    min_purity: float = 0.6,
    min_count: int = 30,
    top: int = 30,
    noise: Sequence[str] = NOISE_BRANDS,
) -> DataFrame:
    """Typical hashtags per brand, measured within the brand's category."""
    scored = add_purity(counts.filter(~F.col("brand").isin(list(noise))), ["category"])
    out = _listed(scored, ["category", "brand"], min_purity, min_count, top)
    return out.select(F.col("category").alias("cate"), "brand", "hashtag_count", "list_hashtag")


def purity_verdict(counts: DataFrame, min_volume: int, min_purity: float = 0.8) -> DataFrame:
    """KEEP a hashtag for a category when it is frequent overall and nearly exclusive."""
    total = F.sum("count_unique_video").over(Window.partitionBy("hashtag"))
    scored = add_purity(counts).withColumn("global_freq", total)
    keep = (F.col("global_freq") > min_volume) & (F.col("purity") > min_purity)
    return scored.withColumn("action", F.when(keep, "KEEP").otherwise("DROP"))


def dictionary_entries(counts: DataFrame, min_purity: float = 0.0, min_count: int = 1) -> DataFrame:
    """Weighted dictionary rows (term, category, weight) with weight = purity."""
    scored = add_purity(counts).filter((F.col("purity") >= min_purity) & (F.col("count_unique_video") >= min_count))
    return scored.select(F.col("hashtag").alias("term"), F.col("category").alias("category_l1"), F.col("purity").alias("weight"))

"""Share of search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.functions.columns import blank_to, ratio
from bazaarlens.operators.dedup import limit_by
from bazaarlens.operators.lookups import heaviest
from bazaarlens.operators.ranking import join_same, rank_within

KEYS = ["key_word", "brand"]


def brand_products(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Different products per keyword and brand: distinct first, so no keyword is gathered."""
    named = df.withColumn("brand", blank_to("brand", "No Brand"))
    return (
        named.select(*by, *KEYS, "product_base_id")
        .distinct()
        .groupBy(*by, *KEYS)
        .agg(F.count("*").alias("products"))
    )


def _with_share(counts: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    group = [*by, "key_word"]
    totals = counts.groupBy(*group).agg(F.sum("products").alias("total"))
    return join_same(counts, totals, group).withColumn("share", ratio("products", "total"))


def search_share(df: DataFrame, top_n: int = 3) -> DataFrame:
    """Share of the top brands per keyword; all other brands fold into 'Others'."""
    shares = _with_share(brand_products(df))
    top = limit_by(shares, top_n, ["key_word"], [F.desc("products"), F.asc("brand")])
    rest = (
        top.groupBy("key_word")
        .agg(F.sum("products").alias("_top"), F.max("total").alias("total"))
        .withColumn("products", F.col("total") - F.col("_top"))
        .filter(F.col("products") > 0)
        .select("key_word", F.lit("Others").alias("brand"), "products", "total", ratio("products", "total").alias("share"))
    )
    return top.select(*KEYS, "products", "total", "share").unionByName(rest)


def search_share_trend(df: DataFrame, period: Column) -> DataFrame:
    """Share per period and its change against the last period in which the brand was seen."""
    by = ("period",)
    shares = _with_share(brand_products(df.withColumn("period", period), by), by)
    # a window holds one row per period
    w = Window.partitionBy(*KEYS).orderBy("period")
    before = F.lag("share").over(w)
    return shares.withColumn("prev_share", before).withColumn("change", F.col("share") - before)


def search_share_months(df: DataFrame, day: Column) -> DataFrame:
    """Share of every brand in every month from a keyword's first to its last, and its change from month to month.

    A brand that is missing from a month has 0 products and a share of 0. A month without any product of the
    keyword has a total of 0 and NULL shares: nothing was measured. Rows without a day are left out.
    """
    by = ("month",)
    dated = df.withColumn("month", F.trunc(day.cast("date"), "month")).filter(F.col("month").isNotNull())
    counts = brand_products(dated, by)
    spans = counts.groupBy("key_word").agg(F.min("month").alias("_first"), F.max("month").alias("_last"))
    months = F.explode(F.expr("sequence(_first, _last, interval 1 month)")).alias("month")
    calendar = join_same(counts.select(*KEYS).distinct(), spans, ["key_word"]).select(*KEYS, months)
    found = counts.select("month", *KEYS, "products").withColumn("_seen", F.lit(True))
    same = [F.col(f"c.{c}").eqNullSafe(F.col(f"f.{c}")) for c in ("month", *KEYS)]
    dense = calendar.alias("c").join(found.alias("f"), same, "left").select("c.*", F.coalesce("f.products", F.lit(0)).alias("products"))
    shares = _with_share(dense, by)
    # one row per month
    before = F.lag("share").over(Window.partitionBy(*KEYS).orderBy("month"))
    return shares.withColumn("prev_share", before).withColumn("change", F.col("share") - F.col("prev_share"))


def search_rank(df: DataFrame) -> DataFrame:
    """Best and average position of a brand per keyword."""
    named = df.withColumn("brand", blank_to("brand", "No Brand"))
    return named.groupBy(*KEYS).agg(
        F.min("position").alias("best_position"),
        ratio(F.sum("position"), F.count("*")).alias("avg_position"),
        F.count("*").alias("items"),
    )


def position_by(df: DataFrame, ids: list[str], score: Column) -> DataFrame:
    """Position within the keyword by descending score, ties share a position."""
    scored = df.withColumn("_minus", -score)
    return rank_within(scored, ids, ["key_word"], {"position": "_minus"}, "items_of_keyword").drop("_minus")


def keyword_gaps(df: DataFrame, own: str) -> DataFrame:
    """Keywords that another brand leads, with the own share and the gap."""
    shares = _with_share(brand_products(df))
    lead = heaviest(shares, ["key_word"], ["brand", "share"], "products").select(
        "key_word", F.col("brand").alias("leader"), F.col("share").alias("leader_share")
    )
    mine = shares.filter(F.col("brand") == own).select(F.col("key_word").alias("own_key"), F.col("share").alias("own"))
    own_share = F.coalesce("own", F.lit(0.0))
    return (
        lead.join(mine, F.col("key_word").eqNullSafe(F.col("own_key")), "left")
        .filter(F.col("leader") != own)
        .select("key_word", "leader", "leader_share", own_share.alias("own_share"), (F.col("leader_share") - own_share).alias("gap"))
    )


def sponsored_share(df: DataFrame, flag: str = "is_ad") -> DataFrame:
    """Organic and sponsored items per keyword and brand; needs an ad flag in the input."""
    named = df.withColumn("brand", blank_to("brand", "No Brand"))
    ads = F.count_if(F.col(flag))
    return named.groupBy(*KEYS).agg(
        F.count("*").alias("items"), ads.alias("sponsored"), ratio(ads, F.count("*")).alias("sponsored_share")
    )

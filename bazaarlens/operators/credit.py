"""Shop features, scorecard, limits and risk monitoring.

The published material names the features and the three outcomes; weights and cut points
are not published, so they are inputs with plain defaults.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions.columns import cascade, ratio
from bazaarlens.operators.ranking import group_quantiles

# (feature, higher is better, [(threshold, points)...] from best to worst)
DEFAULT_CARD = (
    ("success_rate", True, ((0.6, 40), (0.4, 25), (0.2, 10))),
    ("return_rate", False, ((0.1, 20), (0.3, 10))),
    ("orders", True, ((12, 20), (6, 10))),
    ("age_days", True, ((1500, 20), (500, 10))),
)


def shop_features(orders: DataFrame, shops: DataFrame, as_of: str) -> DataFrame:
    """Age, volume, COD share, outcome rates and value per shop.

    ``orders`` has shop_id, order_date, is_cod, status and amount; a shop without orders
    keeps its row with NULL rates.
    """
    n = F.count("*")
    stats = orders.groupBy("shop_id").agg(
        n.alias("orders"),
        ratio(F.count_if("is_cod"), n).alias("cod_share"),
        ratio(F.count_if(F.col("status") == "delivered"), n).alias("success_rate"),
        ratio(F.count_if(F.col("status") == "returned"), n).alias("return_rate"),
        ratio(F.count_if(F.col("status") == "cancelled"), n).alias("cancel_rate"),
        F.sum("amount").cast("double").alias("total_value"),
    )
    age = F.date_diff(F.lit(as_of).cast("date"), F.col("opened_at").cast("date"))
    return shops.join(stats, "shop_id", "left").select(
        *shops.columns,
        age.alias("age_days"),
        F.coalesce("orders", F.lit(0)).alias("orders"),
        "cod_share",
        "success_rate",
        "return_rate",
        "cancel_rate",
        F.coalesce("total_value", F.lit(0.0)).alias("total_value"),
    )


def points(card: Sequence[tuple[str, bool, Sequence[tuple[float, int]]]]) -> Column:
    """Sum of the points of each feature's first band that holds."""
    total = F.lit(0)
    for feature, higher, bands in card:
        hit = [((F.col(feature) >= t) if higher else (F.col(feature) <= t), p) for t, p in bands]
        total = total + cascade(hit, 0)
    return total


def score_shops(features: DataFrame, card=DEFAULT_CARD, eligible: int = 60, review: int = 40) -> DataFrame:
    score = points(card)
    return features.withColumn("score", score).withColumn(
        "decision",
        cascade([(F.col("score") >= eligible, "Eligible"), (F.col("score") >= review, "Under Review")], "Rejected"),
    )


def credit_limit(
    scored: DataFrame, rates: Mapping[str, float] = {"Eligible": 0.3, "Under Review": 0.1}, cap: float = 200_000.0
) -> DataFrame:
    """Limit = rate of the decision x value, up to a cap."""
    rate = cascade([(F.col("decision") == d, r) for d, r in rates.items()], 0.0)
    return scored.withColumn("credit_limit", F.least(F.floor(rate * F.col("total_value")).cast("double"), F.lit(cap)))


def shop_baseline(features: DataFrame, segment: str, metrics: Sequence[str]) -> DataFrame:
    """Quartiles of the features per segment."""
    wanted = {f"{m}_p{int(q * 100)}": (F.col(m), q) for m in metrics for q in (0.25, 0.5, 0.75)}
    return group_quantiles(features, [segment], wanted)


def risk_monitor(orders: DataFrame) -> DataFrame:
    """Daily volume, COD value at risk and failure rates."""
    n = F.count("*")
    failed = F.col("status").isin("returned", "cancelled")
    return orders.groupBy(F.col("order_date").cast("date").alias("day")).agg(
        n.alias("orders"),
        F.coalesce(F.sum(F.when(F.col("is_cod"), F.col("amount"))), F.lit(0)).cast("double").alias("cod_value"),
        F.coalesce(F.sum(F.when(F.col("is_cod") & failed, F.col("amount"))), F.lit(0)).cast("double").alias("cod_value_lost"),
        ratio(F.count_if(failed), n).alias("failure_rate"),
    )

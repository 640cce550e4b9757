"""Writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.operators.dedup import append_new
from bazaarlens.session import frees_shuffles
from bazaarlens.sources.tables import exists


def write_tagged(df: DataFrame, path: str, columns: Sequence[str], tags: Sequence[str], kind: str = "csv") -> None:
    """Base columns that exist, then the tag columns, in this order."""
    out = df.select(*[c for c in columns if c in df.columns], *tags)
    writer = out.write.mode("overwrite")
    writer.csv(path, header=True, escape='"') if kind == "csv" else writer.format(kind).save(path)


def insert_new(df: DataFrame, target: str, keys: Sequence[str], order: Sequence[Column]) -> None:
    """Append the rows whose key the target lacks; running it again adds nothing.

    Only a missing target counts as empty; one that cannot be read is an error. One writer at a time.
    """
    spark = df.sparkSession
    existing = spark.read.parquet(target) if exists(spark, target) else df.limit(0)
    append_new(df, existing, keys, order).write.mode("append").parquet(target)


def attach_tags(facts: DataFrame, tags: DataFrame, key: str = "post_base_id") -> DataFrame:
    """Serving table: the fact with its tag columns; untagged facts become 'Unknown'."""
    extra = [c for c in tags.columns if c not in facts.columns]
    out = facts.join(tags.select(key, *extra), key, "left")
    defaults = {"category_l1": "Unknown", "category_l2": "Unknown", "category_source": "unknown"}
    for c, value in defaults.items():
        if c in extra:
            out = out.withColumn(c, F.coalesce(c, F.lit(value)))
    return out.withColumn("category_confidence", F.coalesce("category_confidence", F.lit(0.0))) if "category_confidence" in extra else out


def write_serving(df: DataFrame, path: str, by: str = "category_l1") -> None:
    """Partitioned by category. Rebalanced by size: a hot category gets as many writers as it has data for."""
    with frees_shuffles(df.sparkSession):
        df.hint("rebalance", by).write.mode("overwrite").partitionBy(by).parquet(path)


def metrics_report(metrics: DataFrame, settings: dict[str, str]) -> DataFrame:
    """One-row report: settings, metrics and a Markdown table of the metrics."""
    numbers = [c for c, t in metrics.dtypes if t in ("double", "bigint", "int")]
    lines = F.concat_ws(
        "\n",
        F.lit("| Metric | Value |"),
        F.lit("|---|---|"),
        *[F.concat(F.lit(f"| {c} | "), F.format_number(F.col(c).cast("double"), 4), F.lit(" |")) for c in numbers],
    )
    return metrics.select(*[F.lit(v).alias(k) for k, v in settings.items()], *metrics.columns, lines.alias("markdown"))


def write_report(report: DataFrame, path: str) -> None:
    report.coalesce(1).write.mode("overwrite").json(path)

"""Version collapse, top-n per key, duplicate listings and keyed merges.

``row_number() <= n`` filters are planned with a WindowGroupLimit on both sides of the
shuffle: every map task keeps at most n rows of a key, so a key that holds a third of
the table still sends only n rows per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def newest(*cols: str) -> list[Column]:
    return [F.desc_nulls_last(c) for c in cols]


def oldest(*cols: str) -> list[Column]:
    return [F.asc_nulls_last(c) for c in cols]


def limit_by(df: DataFrame, n: int, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first ``n`` rows of every key in ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order`` (give newest first)."""
    return limit_by(df, 1, keys, order)


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first by an explicit order column, since Spark has no input order."""
    return limit_by(df, 1, keys, order)


def require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows whose key is NULL or, for text, empty."""
    types = {f.name: f.dataType for f in df.schema.fields}
    for k in keys:
        df = df.filter(F.col(k).isNotNull())
        if isinstance(types[k], StringType):
            df = df.filter(F.col(k) != "")
    return df


def duplicate_keys(df: DataFrame, keys: Sequence[str], min_count: int = 2) -> DataFrame:
    """Keys that occur at least ``min_count`` times, with the count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") >= min_count)


def duplicate_rows(df: DataFrame, key: str, min_count: int = 2) -> DataFrame:
    """Every version row of the ids that occur at least ``min_count`` times."""
    ids = duplicate_keys(require_keys(df, [key]), [key], min_count).select(key)
    return df.join(ids, key, "left_semi")


def normalize_ids(df: DataFrame, key: str = "sku_id") -> DataFrame:
    from bazaarlens.functions.text import strip_suffix

    return df.withColumn(key, strip_suffix(key))


def merge_master(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str] = ("sku_id", "partner_category"),
    order: Sequence[Column] = (),
    keep_tags: Sequence[str] = (),
) -> DataFrame:
    """Merge two snapshots on the composite key; the current row wins.

    ``order`` decides between rows of one snapshot that share a key, then all columns do, so
    that a merge repeats. ``keep_tags`` lists columns whose previous value survives when the key already existed.
    """
    id_col = keys[0]
    both = normalize_ids(old, id_col).withColumn("_priority", F.lit(0)).unionByName(
        normalize_ids(new, id_col).withColumn("_priority", F.lit(1)), allowMissingColumns=True
    )
    rest = [F.asc_nulls_last(c) for c, t in both.dtypes if c != "_priority" and not t.startswith("map")]
    merged = latest_by(both, keys, [F.desc("_priority"), *order, *rest]).drop("_priority")
    if not keep_tags:
        return merged
    kept = latest_by(normalize_ids(old, id_col), keys, [*order, *[F.asc_nulls_last(c) for c, t in old.dtypes if not t.startswith("map")]]).select(
        *keys, *[F.col(c).alias(f"_old_{c}") for c in keep_tags]
    )
    out = merged.join(kept, list(keys), "left")
    return out.select(
        *[F.coalesce(F.col(f"_old_{c}"), F.col(c)).alias(c) if c in keep_tags else F.col(c) for c in merged.columns]
    )


def append_new(df: DataFrame, existing: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Rows to insert: one per key, and only keys that the target lacks; NULL equals NULL."""
    fresh = first_by(df, keys, order)
    held = existing.select(*[F.col(k).alias(f"_held_{k}") for k in keys])
    return fresh.join(held, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_held_{k}")) for k in keys]), "left_anti")

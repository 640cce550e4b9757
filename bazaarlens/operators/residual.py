"""Routing of items the rules leave open to a second stage, and its results."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bazaarlens.functions.columns import blank_to
from bazaarlens.operators.dedup import first_by
from bazaarlens.operators.ranking import numbered

# Allowed audiences of the second stage and its default brand.
GENDERS = ["nam", "nữ", "unisex"]
NO_BRAND = "No Brand"


def residual_batches(df: DataFrame, size: int = 30, key: str = "product_base_id", name: str = "product_name") -> DataFrame:
    """Open items in numbered batches of ``size``; rows without id or name stay out."""
    usable = df.filter(
        F.col(key).isNotNull()
        & (F.trim(F.col(key).cast("string")) != "")
        & (F.lower(F.col(key).cast("string")) != "nan")
        & (F.trim(F.coalesce(name, F.lit(""))) != "")
    )
    rows = numbered(usable, [key], "_n")
    return rows.withColumn("batch_id", F.floor((F.col("_n") - 1) / size)).drop("_n", "_n_of")


def pack_batches(batches: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One row per batch with its items; a batch never holds more than its size."""
    return batches.groupBy("batch_id").agg(F.collect_list(F.struct(*fields)).alias("skus"))


def run_batches(
    packed: DataFrame, tag: Callable[[list[dict]], list[dict]], schema: str, key: str = "product_base_id"
) -> DataFrame:
    """Call a tagger per batch on the executors; adds ``status`` and ``error`` to the columns of ``schema``.

    The items of a failing batch come back with status ``failed``, the error's text and NULL in all other columns,
    so the caller can send them again. Items that a successful call leaves out have status ``open``.
    """

    def call(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for skus in frame["skus"]:
                items = [s.asDict() if hasattr(s, "asDict") else dict(s) for s in skus]
                try:
                    found = [{**r, "status": "tagged", "error": None} for r in tag(items)]
                    done = {r[key] for r in found}
                    found += [{key: i[key], "status": "open", "error": None} for i in items if i[key] not in done]
                except Exception as why:  # noqa: BLE001  kept with every item of the batch
                    found = [{key: i[key], "status": "failed", "error": f"{type(why).__name__}: {why}"} for i in items]
                if found:
                    yield pd.DataFrame([[r.get(n) for n in names] for r in found], columns=names, dtype=object)

    out = f"{schema}, status string, error string"
    names = StructType.fromDDL(out).names
    return packed.select("skus").mapInPandas(call, out)


def apply_results(df: DataFrame, results: DataFrame, hint: str, key: str = "product_base_id") -> DataFrame:
    """Attach second-stage results to all rows of an id, within the allowed values.

    The category must be the hint or empty, the audience one of three; an empty brand
    becomes 'No Brand'. A result that breaks a rule is cleared, not guessed. Failed and open items count as without
    result; of several results for an id the first in the order of all columns counts. ``signs_reasons``, the
    text that explains a decision, goes along where the results have it.
    """
    if "status" in results.columns:
        results = results.filter(F.col("status") == "tagged")
    results = first_by(results, [key], [F.asc_nulls_last(c) for c in results.columns if c != key])
    reasons = [c for c in ("signs_reasons",) if c in results.columns]
    category, gender = F.coalesce("r_category", F.lit("")), F.col("r_gender")
    clean = results.select(
        key,
        F.when(category == hint, category).otherwise("").alias("category"),
        F.when(gender.isin(GENDERS), gender).alias("gender"),
        blank_to("r_brand", NO_BRAND).alias("brand_tagged"),
        *reasons,
        F.lit(True).alias("_hit"),
    )
    return df.join(clean, key, "left").withColumn("tagged", F.coalesce("_hit", F.lit(False))).drop("_hit")

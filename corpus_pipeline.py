"""From raw documents to packed training sequences: four stages, each over all that the one before it kept.

Every stage works on its own input: language ID learns from the labels it finds there, duplicates are those among
the rows that are left. All but the last return the columns of documents, whatever further columns there are. An empty
table gives no rows in any stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from bazaarlens.llm.exact_dedup import drop_duplicates
from bazaarlens.llm.language_crf import keep_languages, train
from bazaarlens.llm.packing import pack
from bazaarlens.llm.registry import shipped
from bazaarlens.llm.simhash import drop_near_duplicates
from bazaarlens.session import settle

#: Share of the way from chance (one of the learned labels) to certainty that a language's mean probability must reach.
LEAST_SHARE = 2 / 15
#: That bound with the four labels of the given tables.
LEAST_SCORE = 0.35


def least_score(labels: int) -> float:
    """Mean probability of the language below which a document is rejected; a single label is certain."""
    return round(1 / labels + LEAST_SHARE * (1 - 1 / labels), 9) if labels else 1.0


@shipped
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or without a language of at least ``least_score``, go.

    So NULL and empty texts go. Rows are judged one by one, with equal results for equal texts; ids and labels of a
    row do not matter for its own result, and rows without id or label are not learned from.
    """
    field = train(docs)
    return keep_languages(docs, field, least_score(len(field.labels) if field else 0)).select(*docs.columns)


@shipped
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The longest row of each group of equal texts stays, on ties the one with the smallest doc_id.

    NULL texts equal empty ones. NULL ids lose ties; rows that share both doc_id and text are one document and stay
    or go together.
    """
    return drop_duplicates(docs).select(*docs.columns)


@shipped
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of close fingerprints (3-word shingles, 2 bits) stays, also of rows that repeat.

    It is the one with the smallest doc_id. Rows without doc_id stay beside those with one; of a group without any
    known id one row stays. NULL and empty texts share a fingerprint.
    """
    return drop_near_duplicates(docs, shingle=3, radius=2).select(*docs.columns)


@shipped
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens, the windows mixed from the sources like the whole, up to a packet per source.

    NULL and empty texts are an end id; NULL sources are one source; rows that repeat, or have no id, are packed each.
    """
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("packing", packing)]

#: No SQL: the stages run a trained model, bit fingerprints and a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

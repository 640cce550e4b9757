"""Exact duplicates, with frequent texts split off before the shuffle.

Every text becomes a SHA-256 of its normalised form, so only narrow rows travel. Misra-Gries counters
(``freqItems``, merged map-side) name the digests that may hold more than ``support`` of all rows. Their exact
counts and winners are verified by an aggregation over these digests alone and broadcast: at most
``1 / support`` rows by construction. Rows of a frequent digest are then decided where they lie; all others
take an ordinary shuffle, where no digest has more than that share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.session import settle

#: The characters of [\x20\x09-\x0D], which do not count in a comparison.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
SUPPORT = 0.01


def text_digest(text: Column) -> Column:
    """SHA-256 of the text without blanks; NULL counts as the empty text."""
    return F.sha2(F.translate(F.coalesce(text, F.lit("")), BLANKS, ""), 256)


def _first(doc_id: Column, length: Column) -> Column:
    """Largest for the row that stays: most code points, then smallest id, NULL ids last."""
    return F.struct(length.alias("length"), doc_id.isNotNull().alias("known"), F.bitwise_not(doc_id).alias("back"))


def duplicates(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points stays, then the one with the smallest doc_id; an unknown
    (NULL) doc_id loses ties. Rows that repeat both doc_id and text are the same document: all of them count in
    group_size and they are kept or dropped together. NULL texts equal empty ones and texts of blanks. An empty
    table gives no rows; other columns, whatever their names, are not read.
    """
    text = docs["text"]
    narrow = settle(
        docs.select(
            docs["doc_id"].alias("doc_id"),
            F.char_length(F.coalesce(text, F.lit(""))).alias("length"),
            text_digest(text).alias("text_sha256"),
        ),
        "digests",
    )
    best = [
        F.max(_first(F.col("doc_id"), F.col("length"))).alias("best"),
        F.count("*").alias("group_size"),
    ]
    candidates = narrow.stat.freqItems(["text_sha256"], support).select(
        F.explode("text_sha256_freqItems").alias("text_sha256")
    )
    # at most 1 / support candidates; the counters also name some that are not frequent
    verified = settle(
        narrow.join(F.broadcast(candidates), "text_sha256", "left_semi").groupBy("text_sha256").agg(*best), "frequent"
    )
    hot = narrow.join(F.broadcast(verified), "text_sha256")
    rest = narrow.join(F.broadcast(verified.select("text_sha256")), "text_sha256", "left_anti")
    cold = rest.join(rest.groupBy("text_sha256").agg(*best), "text_sha256")
    keep_id = F.bitwise_not(F.col("best.back"))
    return hot.unionByName(cold).select(
        "doc_id",
        keep_id.alias("keep_id"),
        "group_size",
        (F.col("doc_id").eqNullSafe(keep_id) & (F.col("length") == F.col("best.length"))).alias("kept"),
        "text_sha256",
    )


def drop_duplicates(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """The rows of ``docs`` that ``duplicates`` keeps, with all their columns.

    The texts are shuffled once, to where the dropped ids are, at any size: neither side is broadcast or sorted.
    """
    gone = settle(
        duplicates(docs, support).filter(~F.col("kept")).select(F.col("doc_id").alias("gone_id"), "text_sha256"),
        "dropped",
    ).distinct().hint("shuffle_hash")
    digest = text_digest(docs["text"])
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["gone_id"]) & (digest == gone["text_sha256"]), "left_anti")

"""CSV whose quoted texts hold line ends, read by many tasks.

Line ends inside quotes cannot be told from record ends within one part of a file. So lines are read as text, which
splits, and quotes are counted per part of the file: the number of quotes before a part, a prefix sum over few rows,
says whether it starts inside a quoted text. Each task then puts the lines of its part together to records. Only the
records that cross from one part into the next meet in a shuffle. Fields are cut by Spark's own CSV parser.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bazaarlens.session import settle

#: A piece is a whole record, or what a part holds of a record that crosses its start or end.
PIECES = "file string, block long, seq long, begins boolean, ends boolean, text string"
BATCH = 4096


def _lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))


def piece_batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows of ``PIECES`` in batches."""
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()]
    names = [f.split()[0] for f in PIECES.split(", ")]
    while some := list(islice(rows, BATCH)):
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some, strict=True), kinds, strict=True)], names)


def join_crossing(pieces: DataFrame, glue: str) -> DataFrame:
    """file, block, seq, text: whole pieces, and those that cross parts of a file put together."""
    crossing = pieces.filter("not (begins and ends)")
    # at most two for each part of a file
    upto = Window.partitionBy("file").orderBy("block", "seq").rowsBetween(Window.unboundedPreceding, 0)
    chains = crossing.withColumn("chain", F.sum(F.col("begins").cast("int")).over(upto))
    joined = chains.groupBy("file", "chain").agg(F.array_sort(F.collect_list(F.struct("block", "seq", "text"))).alias("p")).select(
        "file", F.col("p")[0]["block"].alias("block"), F.col("p")[0]["seq"].alias("seq"), F.array_join(F.col("p")["text"], glue).alias("text")
    )
    return pieces.filter("begins and ends").select("file", "block", "seq", "text").unionByName(joined)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from piece_batches(_cut(batches))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    part = None
    held: list[str] = []  # lines of the record that is open
    begins = open_ = False
    seq = 0
    for batch in batches:
        for file, block, line, inside in zip(*[batch[c].to_pylist() for c in ("file", "block", "line", "inside")], strict=True):
            if (file, block) != part:
                if held:
                    yield *part, seq, begins, False, "\n".join(held)
                part, held, begins, open_, seq = (file, block), [], not inside, inside, 0
            held.append(line)
            open_ ^= line.count('"') % 2 == 1
            if not open_:
                yield file, block, seq, begins, True, "\n".join(held)
                held, begins, seq = [], True, seq + 1
    if held:
        yield *part, seq, begins, False, "\n".join(held)


def records(spark: SparkSession, path: str) -> DataFrame:
    """file, block, seq, text: the records of all files below ``path`` without their final line end.

    ``block`` and ``seq`` give their order in a file. A record that is still open at the end of its file is given as it
    is. A record must fit in a row, a file and a part of a file need not.
    """
    lines = _lines(spark, path)
    quotes = F.sum(F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))).alias("quotes")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    parity = lines.groupBy("file", "block").agg(quotes).select("file", "block", (F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2 == 1).alias("inside"))
    parity = settle(parity, "csv-parity")
    # Spark picks the join by the size of what was settled; the lines' order holds either way
    placed = lines.withColumn("at", F.monotonically_increasing_id()).join(parity, ["file", "block"]).sortWithinPartitions("file", "block", "at")
    pieces = settle(placed.select("file", "block", "line", "inside").mapInArrow(_pieces, PIECES), "csv-pieces")
    return join_crossing(pieces, "\n")


def read_split_csv(spark: SparkSession, path: str, schema: str, header: bool = True, sep: str = ",") -> DataFrame:
    """The rows of CSV files with a declared schema; quotes inside quoted texts are doubled, as RFC 4180 has it.

    Lines end with LF or CRLF; inside quotes both stay as they are. Empty lines are no records, with ``header`` nor is the
    first of each file. As with Spark's reader, missing fields are NULL and fields that do not fit are NULL.
    """
    text = F.regexp_replace("text", "\r$", "")
    rows = records(spark, path).withColumn("text", text).filter("text <> ''")
    if header:
        rows = rows.filter("not (block = 0 and seq = 0)")
    return rows.select(_fields(schema, sep).alias("row")).select("row.*")


def _fields(schema: str, sep: str) -> Column:
    return F.from_csv(F.col("text"), F.lit(schema), {"sep": sep, "escape": '"', "multiLine": "true"})

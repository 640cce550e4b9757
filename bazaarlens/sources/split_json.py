"""Large JSON objects keyed by keyword, read by many tasks as one row per key.

Such a file is one object, often one line, so a line reader makes it one string. Here it is read in pieces that end
at closing braces, which splits anywhere. Whether a part of the file starts inside a string is a prefix sum of quotes, how
deep it starts is a prefix sum of brackets; with both, each task cuts its part at the commas between the outer
keys. Entries that cross from one part into the next meet in a shuffle. Values become VARIANT: fields that only some
entries have, or whose type drifts, are kept as they came and read by path.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bazaarlens.session import settle
from bazaarlens.sources.split_csv import PIECES, join_crossing, piece_batches

_ESCAPED = re.compile(r"\\.", re.DOTALL)
_MARKS = re.compile(r'\\.|["{}\[\],]', re.DOTALL)


def _pieces_of_files(spark: SparkSession, path: str) -> DataFrame:
    pieces = spark.read.option("lineSep", "}").text(path)
    return pieces.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("piece"))


def _before(sums: DataFrame, value: str, name: str) -> DataFrame:
    """Sum of ``value`` over the earlier parts of each file."""
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("file", "block", F.coalesce(F.sum(value).over(earlier), F.lit(0)).alias(name))


def _counted(piece: str, inside: bool) -> tuple[int, int, bool]:
    """Brackets opened and closed by a piece and the brace behind it, and whether that brace lies in a string."""
    parts = _ESCAPED.sub("", piece).split('"')
    outside = "".join(parts[int(inside) :: 2])
    inside ^= len(parts) % 2 == 0
    return outside.count("{") + outside.count("["), outside.count("]") + (not inside), inside


def _depths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, depth, inside = None, 0, False
    rows = []
    for batch in batches:
        for file, block, piece, begin in zip(*[batch[c].to_pylist() for c in ("file", "block", "piece", "inside")], strict=True):
            if (file, block) != part:
                if part:
                    rows.append((*part, depth))
                part, depth, inside = (file, block), 0, begin
            opened, closed, inside = _counted(piece, inside)
            depth += opened - closed
    if part:
        rows.append((*part, depth))
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [()] * 3, [pa.string(), pa.int64(), pa.int64()], strict=True)], ["file", "block", "depth"])


class _Entries:
    """Cuts the pieces of one part of a file at the commas and braces of the outer object."""

    def __init__(self, inside: bool, depth: int):
        self.inside, self.depth, self.held, self.begins, self.seq = inside, depth, [], depth == 0, 0

    def add(self, piece: str) -> Iterator[tuple[int, bool, bool, str]]:
        opened, closed, inside = _counted(piece, self.inside)
        if self.depth - closed > 1:  # stays within an entry
            self.held.append(piece + "}")
            self.depth, self.inside = self.depth + opened - closed, inside
            return
        text, at = piece + "}", 0
        for mark in _MARKS.finditer(text):
            c = mark.group()
            if c == '"':
                self.inside = not self.inside
            elif self.inside or len(c) > 1:
                continue
            elif c in "{[":
                self.depth += 1
                if self.depth == 1:
                    at, self.held, self.begins = mark.end(), [], True
            elif c in "}]" or self.depth == 1:
                if self.depth == 1:
                    yield from self._entry(text[at : mark.start()], True)
                    at = mark.end()
                self.depth -= c != ","
        if self.depth > 0:
            self.held.append(text[at:])

    def _entry(self, last: str, ends: bool) -> Iterator[tuple[int, bool, bool, str]]:
        text = "".join(self.held) + last
        if text.strip() or not self.begins:
            yield self.seq, self.begins, ends, text
            self.seq += 1
        self.held, self.begins = [], True

    def rest(self) -> Iterator[tuple[int, bool, bool, str]]:
        if self.depth > 0:
            yield from self._entry("", False)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        part, entries = None, None
        for batch in batches:
            for file, block, piece, inside, depth in zip(*[batch[c].to_pylist() for c in ("file", "block", "piece", "inside", "depth")], strict=True):
                if (file, block) != part:
                    if entries:
                        yield from ((*part, *e) for e in entries.rest())
                    part, entries = (file, block), _Entries(inside, depth)
                yield from ((*part, *e) for e in entries.add(piece))
        if entries:
            yield from ((*part, *e) for e in entries.rest())

    yield from piece_batches(rows())


def read_keyed_json(spark: SparkSession, path: str) -> DataFrame:
    """key, value (VARIANT) for every outer key of the objects in the files below ``path``; file, block, seq are their order.

    A file holds one object or several, on any number of lines. Repeated keys give a row each. An entry that is no
    valid JSON, such as one that is cut off at the end of its file, gives a row with NULL key and value. An entry must
    fit in a row; a file, and a part of it, need not. Empty objects and files give no rows.
    """
    pieces = _pieces_of_files(spark, path).withColumn("at", F.monotonically_increasing_id())
    plain = F.regexp_replace("piece", r"(?s)\\.", "")
    quotes = F.sum(F.length(plain) - F.length(F.replace(plain, F.lit('"'), F.lit("")))).alias("quotes")
    begins = settle(_before(pieces.groupBy("file", "block").agg(quotes), "quotes", "quotes").select("file", "block", (F.col("quotes") % 2 == 1).alias("inside")), "json-quotes")
    # Spark picks the joins by the size of what was settled; the order of the pieces holds either way
    inside = pieces.join(begins, ["file", "block"]).sortWithinPartitions("file", "block", "at").select("file", "block", "at", "piece", "inside")
    deltas = inside.drop("at").mapInArrow(_depths, "file string, block long, depth long")
    depths = settle(_before(deltas.groupBy("file", "block").agg(F.sum("depth").alias("depth")), "depth", "depth"), "json-depths")
    placed = inside.join(depths, ["file", "block"]).sortWithinPartitions("file", "block", "at").drop("at")
    entries = join_crossing(settle(placed.mapInArrow(_cut, PIECES), "json-entries"), "")
    objects = entries.withColumn("object", F.try_parse_json(F.concat(F.lit("{"), "text", F.lit("}"))))
    found = objects.lateralJoin(spark.tvf.variant_explode_outer(F.col("object").outer()))
    return found.select("file", "block", "seq", "key", "value")


def variant_items(rows: DataFrame, path: str, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """key_word, position (from 1), the named fields (path in the item, type), item (VARIANT) of every list element.

    Fields that are missing, or do not fit their type, are NULL; ``item`` keeps all that came.
    """
    lists = rows.select(F.col("key").alias("key_word"), F.posexplode(F.try_variant_get("value", path, "array<variant>")).alias("i", "item"))
    named = [F.try_variant_get("item", p, kind).alias(name) for name, (p, kind) in fields.items()]
    return lists.select("key_word", (F.col("i") + 1).alias("position"), *named, "item")


def search_results(spark: SparkSession, path: str) -> DataFrame:
    """Search items of keyword objects ($.items)."""
    basic = {n: (f"$.item_basic.{n}", k) for n, k in (("itemid", "bigint"), ("shopid", "bigint"), ("name", "string"), ("brand", "string"), ("price", "bigint"), ("historical_sold", "bigint"))}
    return variant_items(read_keyed_json(spark, path), "$.items", basic)


def lazada_results(spark: SparkSession, path: str) -> DataFrame:
    """Search items of the other platform ($.mods.listItems)."""
    fields = {n: (f"$.{n}", "string") for n in ("itemId", "name", "brandName")}
    return variant_items(read_keyed_json(spark, path), "$.mods.listItems", fields)

"""CSV, keyword-keyed JSON, concatenated JSON, newest file and rule readers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bazaarlens.functions.columns import blank_to
from bazaarlens.functions.rule_tables import Brand, Rule
from bazaarlens.functions.text import sentence_case
from bazaarlens.operators.dedup import first_by
from bazaarlens.session import settle

ITEM = "item_basic struct<itemid:bigint, shopid:bigint, name:string, brand:string, image:string, price:bigint, historical_sold:bigint>"
SEARCH_SCHEMA = f"map<string, struct<items:array<struct<{ITEM.replace(' struct', ':struct', 1)}>>>>"


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header; multi-line texts and a declared schema, so nothing is inferred."""
    return spark.read.schema(schema).csv(path, header=True, multiLine=True, escape='"')


def search_items(docs: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """JSON objects keyed by keyword as one row per item with its place in the list."""
    by_key = docs.select(*keep, F.explode(F.from_json(F.col(value), SEARCH_SCHEMA)).alias("key_word", "result"))
    return by_key.select(*keep, "key_word", F.posexplode("result.items").alias("_ordinal", "item")).select(
        *keep, "key_word", (F.col("_ordinal") + 1).alias("position"), "item.item_basic.*"
    )


def read_search_results(spark: SparkSession, path: str) -> DataFrame:
    return search_items(spark.read.text(path, wholetext=True))


# Id and link templates of the marketplace.
ID_PREFIX, LINK = "1", "https://shopee.vn/product/%d/%d"


def parse_search(items: DataFrame, created_at: Column, keep: Sequence[str] = ()) -> DataFrame:
    """Keyed search facts: normal keyword, product id, link; the first item of an id stays."""
    has_ids = (F.coalesce("itemid", F.lit(0)) != 0) & (F.coalesce("shopid", F.lit(0)) != 0)
    rows = items.filter(has_ids).select(
        *keep,
        created_at.alias("created_at"),
        sentence_case("key_word").alias("key_word"),
        F.concat_ws("__", F.lit(ID_PREFIX), F.col("itemid").cast("string"), F.col("shopid").cast("string")).alias("product_base_id"),
        F.coalesce("name", F.lit("")).alias("product_name"),
        F.format_string(LINK, "shopid", "itemid").alias("url"),
        F.coalesce("brand", F.lit("")).alias("brand"),
        F.coalesce("image", F.lit("")).alias("url_thumbnail"),
        "position",
    )
    return first_by(rows, ["created_at", "key_word", "product_base_id"], [F.asc("position"), F.asc("product_name")])


def lazada_items(docs: DataFrame, value: str = "value", item: str = "itemId:string, name:string, brandName:string") -> DataFrame:
    """The same rows from payloads that keep their items below mods.listItems.

    The item fields are not documented, so their schema is a parameter.
    """
    schema = f"map<string, struct<mods:struct<listItems:array<struct<{item}>>>>>"
    by_key = docs.select(F.explode(F.from_json(F.col(value), schema)).alias("key_word", "result"))
    return by_key.select("key_word", F.posexplode("result.mods.listItems").alias("_ordinal", "item")).select(
        "key_word", (F.col("_ordinal") + 1).alias("position"), "item.*"
    )


def read_lazada(spark: SparkSession, path: str) -> DataFrame:
    return lazada_items(spark.read.text(path, wholetext=True))


# a document begins with its envelope, which in a document's middle follows one of : , [
_ENVELOPE = r'(?=\{"code")'
_NEW_ENVELOPE = r'(?<![:,\[\s])\s*(?=\{"code")'
# a text cannot hold a line end, but it can hold blanks
_LINES = r"(?<=\})\s*\n\s*(?=\{)"
_APART = r"(?<=\})[ \t]+(?=\{)"
_BEGIN = r'^\s*\{\s*["}]'


def _may_parse(doc: Column) -> Column:
    """Does an object begin here, and does a brace close outside of its texts? Cheap, and true of all that parses."""
    bare = F.regexp_replace(F.regexp_replace(doc, r"(?s)\\.", ""), r'"[^"]*"', "")
    return doc.rlike(_BEGIN) & F.substring_index(bare, '"', 1).contains("}")


def _is_json(doc: Column) -> Column:
    """What follows a complete document does not count."""
    return F.try_parse_json(doc).isNotNull()


def _parses(doc: Column) -> Column:
    """As ``_is_json``, faster for texts that are likely none: the parser raises an error for each of them."""
    return _may_parse(doc) & _is_json(doc)


def _closed(piece: Column) -> Column:
    """A piece with the outer brackets that the separator took."""
    return F.concat(F.when(piece.startswith("{"), piece).otherwise(F.concat(F.lit("{"), piece)), F.lit("}"))


def _bound(value: Column, then) -> Column:
    """``then`` of a value that is made once."""
    return F.transform(F.array(value), then)[0]


def _on_line(parses) -> Callable[[Column], Column]:
    """Documents of a line, which may stand apart; NULL if it is not whole."""

    def of_parts(parts: Column, line: Column) -> Column:
        return F.when((F.size(parts) > 1) & F.forall(parts, _parses), parts).when(parses(line), F.array(line))

    return lambda line: _bound(F.split(line, _APART), lambda parts: of_parts(parts, line))


def _documents(closed: Column) -> Column:
    """Documents of a piece; NULL where one is not whole."""

    def of_lines(lines: Column) -> Column:
        return F.when(F.forall(lines, lambda line: line.rlike(_BEGIN)), F.flatten(F.transform(lines, _on_line(_parses))))

    return _bound(F.split(closed, _LINES), of_lines)


def _cut_off(line: Column) -> Column:
    """Documents of a line that does not parse: a cut-off document runs straight into the next one's envelope.

    Where it stops at a mark that an inner object may follow, the longest end that parses is the next document.
    """

    def halves(pieces: Column) -> Column:
        end = lambda i: F.array_join(F.slice(pieces, i, F.size(pieces)), "")
        first = lambda at, i: F.when(at > 0, at).when(_parses(end(i)), i).otherwise(0)
        at = F.aggregate(F.sequence(F.lit(2), F.size(pieces)), F.lit(0), first)
        two = lambda i: F.when(i > 0, F.array(F.array_join(F.slice(pieces, 1, i - 1), ""), end(i)))
        return F.when(F.size(pieces) > 1, _bound(at, two))

    def loose(part: Column, several: Column) -> Column:
        two = F.coalesce(_bound(F.split(part, _ENVELOPE), halves), F.array(part))
        return F.when(several & _parses(part), F.array(part)).otherwise(two)

    return _bound(F.split(line, _NEW_ENVELOPE), lambda parts: F.flatten(F.transform(parts, lambda p: loose(p, F.size(parts) > 1))))


def _documents_or_cut(closed: Column) -> Column:
    """As ``_documents``; of a text that does not parse, every line that does is one document, and the others are cut off."""

    def of_lines(lines: Column) -> Column:
        return _bound(F.transform(lines, _on_line(_is_json)), lambda found: of_found(lines, found))

    def of_found(lines: Column, found: Column) -> Column:
        one = F.zip_with(lines, found, lambda line, f: F.when(f.isNotNull(), F.array(line)).otherwise(_cut_off(line)))
        return F.coalesce(F.flatten(found), F.filter(F.flatten(one), lambda d: d != ""))

    return _bound(F.split(closed, _LINES), of_lines)


def _quotes(text: Column) -> Column:
    """Quotes that are not escaped."""
    rest = F.regexp_replace(text, r"(?s)\\.", "")
    return F.length(rest) - F.length(F.replace(rest, F.lit('"'), F.lit("")))


def read_concat_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON documents written one after another, with their order number within the file.

    ``}{`` is the record separator, so a large file is read in splits. It also cuts texts that hold ``}{``: pieces that
    do not parse are put together again while a quote is open. Only what still does not parse is taken for
    cut-off documents. Order numbers come from the number of documents in the splits before, and so does an open quote
    that a split begins with; windows hold one split, or one row per split of a file.
    """
    text = F.trim(F.col("value"))
    pieces = settle(
        spark.read.text(path, lineSep="}{")
        .select(
            text.alias("value"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_row"),
        )
        .filter(F.col("value") != "")
        .withColumn("_docs", _documents(_closed(F.col("value"))))
        .withColumn("_quotes", F.when(F.col("_docs").isNull(), _quotes(F.col("value"))).otherwise(0)),
        "pieces",
    )
    whole = pieces.filter(F.col("_docs").isNotNull()).select("file", "_block", "_row", F.posexplode("_docs").alias("_part", "doc"))
    docs = settle(whole.unionByName(_rejoined(pieces)), "documents")
    inside = F.row_number().over(Window.partitionBy("file", "_block").orderBy("_row", "_part"))
    before = _earlier(docs.groupBy("file", "_block").agg(F.count("*").alias("_n")))
    return docs.withColumn("_in", inside).join(before, ["file", "_block"]).select(
        "file", (F.col("_before") + F.col("_in") - 1).alias("ordinal"), "doc", F.from_json("doc", schema).alias("data")
    )


def _earlier(counts: DataFrame) -> DataFrame:
    """``_n`` of the splits before, per file: one row per split."""
    w = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("file", "_block", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))


def _rejoined(pieces: DataFrame) -> DataFrame:
    """Documents of the pieces that do not parse alone, at the place of their first piece.

    A piece begins a group unless a quote is open, counted from the last whole piece on. What an earlier split leaves
    open is only known later, so a split's first pieces are looked at both ways.
    """
    split = Window.partitionBy("file", "_block").orderBy("_row")
    upto = split.rowsBetween(Window.unboundedPreceding, 0)
    fine = F.col("_docs").isNotNull()
    counted = pieces.select("file", "_block", "_row", fine.alias("_fine"), "_quotes", F.when(~fine, F.col("value")).alias("value"))
    since = counted.withColumn("_upto", F.sum("_quotes").over(upto))
    since = since.withColumn("_reset", F.max(F.when(F.col("_fine"), F.col("_upto"))).over(upto))
    # quotes since the last whole piece, or since the split's begin
    since = since.withColumn("_since", F.col("_upto") - F.coalesce("_reset", F.lit(0)))
    odd = (F.col("_since") - F.col("_quotes")) % 2 == 1
    begins = {0: ~odd, 1: F.when(F.col("_reset").isNull(), odd).otherwise(~odd)}
    for carried, begin in begins.items():
        since = since.withColumn(f"_begin{carried}", F.max(F.when(~F.col("_fine") & begin, F.col("_row"))).over(upto))
    last = since.groupBy("file", "_block").agg(
        F.max("_reset").isNotNull().alias("_resets"), F.max_by("_since", "_row").alias("_left"), F.max("_begin0").alias("_begin0"), F.max("_begin1").alias("_begin1")
    )
    joined = since.filter(~F.col("_fine")).join(_carried(last), ["file", "_block"])
    own = F.when(F.col("_odd"), F.col("_begin1")).otherwise(F.col("_begin0"))
    place = F.struct("_block", "_row", "value")
    groups = joined.withColumn("_first", F.coalesce(F.when(own.isNotNull(), F.struct("_block", own.alias("_row"))), "_open"))
    texts = groups.groupBy("file", "_first").agg(F.sort_array(F.collect_list(place)).alias("_all")).select(
        "file", "_first._block", "_first._row", _closed(F.array_join(F.col("_all")["value"], "}{")).alias("_text")
    )
    return texts.select("file", "_block", "_row", F.posexplode(_documents_or_cut(F.col("_text"))).alias("_part", "doc"))


def _carried(splits: DataFrame) -> DataFrame:
    """Does a split begin within a quote (``_odd``), and which group was open then (``_open``)? One row per split."""
    w = Window.partitionBy("file").orderBy("_block")
    earlier, upto = (w.rowsBetween(Window.unboundedPreceding, at) for at in (-1, 0))
    total = splits.withColumn("_total", F.sum("_left").over(upto))
    # of the last split with a whole piece, only the quotes after that piece count
    reset = F.max(F.when(F.col("_resets"), F.col("_total") - F.col("_left"))).over(earlier)
    odd = (F.col("_total") - F.col("_left") - F.coalesce(reset, F.lit(0))) % 2 == 1
    marked = total.withColumn("_odd", odd)
    begin = F.when(F.col("_odd"), F.col("_begin1")).otherwise(F.col("_begin0"))
    group = F.when(begin.isNotNull(), F.struct("_block", begin.alias("_row")))
    return marked.select("file", "_block", "_odd", F.last(group, ignorenulls=True).over(earlier).alias("_open"))


def complete_rows(doc: Column | str, schema: str) -> Column:
    """The flat objects of a document's list that are complete, also when the document is cut off."""
    found = F.regexp_extract_all(doc if isinstance(doc, Column) else F.col(doc), F.lit(r"\{[^{}]*\}"), F.lit(0))
    return F.transform(found, lambda o: F.from_json(o, schema))


def latest_file(spark: SparkSession, glob: str, by: str = "modificationTime") -> str | None:
    """Path of the newest match of a glob, a file or a table's whole folder; None without a match.

    ``by`` is modificationTime or name; ties go to the larger path. Only metadata is read.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(glob)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    rows = [(0 if by == "name" else f.getModificationTime(), f.getPath().toString()) for f in found or ()]
    return max(rows)[1] if rows else None


def load_rules(spark: SparkSession, path: str) -> list[Rule]:
    """Rule table (label, priority, source, keyword_pattern) in file order; a rule table is small."""
    rows = spark.read.schema("seq int, label string, priority int, source string, keyword_pattern string").csv(
        path, header=True, multiLine=True, escape='"'
    )
    return [
        Rule(r["label"], (r["source"] or "both").lower(), r["keyword_pattern"] or "", r["priority"] if r["priority"] is not None else 99)
        for r in rows.orderBy("seq").toLocalIterator()
    ]


def load_brands(spark: SparkSession, path: str) -> list[Brand]:
    rows = spark.read.schema("brand_key string, brand_display string, keyword_pattern string").csv(
        path, header=True, multiLine=True, escape='"'
    )
    return [Brand(r["brand_key"], blank(r["brand_display"], r["brand_key"]), r["keyword_pattern"]) for r in rows.orderBy("brand_key").toLocalIterator()]


def blank(value: str | None, default: str) -> str:
    return value if value else default


def load_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Versioned dictionary JSON as rows with its version."""
    schema = "version string, entries array<struct<term:string, category_l1:string, category_l2:string, weight:double>>"
    doc = spark.read.schema(schema).json(path, multiLine=True)
    return doc.select("version", F.inline("entries"))


def _one_document(spark: SparkSession, path: str, schema: str):
    """The only document of a configuration file, which people keep by hand and which is small."""
    row = spark.read.schema(schema).json(path, multiLine=True).first()
    if row is None or row["version"] is None:
        raise ValueError(f"{path} is not a versioned configuration")
    return row


def load_concerns(spark: SparkSession, path: str) -> tuple[str, dict[str, list[str]], dict[str, list[str]]]:
    """Version, terms by concern, and concerns by category, of a concern dictionary."""
    schema = "version string, scope map<string, array<string>>, concerns map<string, struct<terms: array<string>>>"
    row = _one_document(spark, path, schema)
    return row["version"], {k: list(v["terms"]) for k, v in (row["concerns"] or {}).items()}, {k: list(v) for k, v in (row["scope"] or {}).items()}


def load_stop_list(spark: SparkSession, path: str) -> tuple[str, list[str]]:
    """Version and generic terms of a stop list."""
    row = _one_document(spark, path, "version string, terms array<string>")
    return row["version"], list(row["terms"] or [])


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small table written in the program."""
    return spark.createDataFrame(list(rows), schema)

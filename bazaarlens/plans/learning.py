"""Second stage, classification, streaming, source and sink queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from bazaarlens.functions.terms import find_terms
from bazaarlens.functions.text import nfkc
from bazaarlens.operators import classify as ml
from bazaarlens.operators import residual
from bazaarlens.operators.ranking import numbered
from bazaarlens.plans.registry import div, query, r
from bazaarlens.plans.tagging import (
    BRANDS,
    CAT_COLS,
    CLASSED,
    CLIPS,
    VIDEO_TAG_SQL,
    VIDEO_TAGS,
    cascade_sql,
    cascaded,
    classified,
    clips,
    video_tags,
    videos,
)
from bazaarlens.plans.views import ctes, latest_sql, posts
from bazaarlens.session import fresh_path, interim
from bazaarlens.sources import readers, sinks, split_csv, split_json
from bazaarlens.sources.keyed import KeyedTable
from bazaarlens.sources.tables import load_posts, table
from bazaarlens.streaming import jobs, retag
from bazaarlens.streaming.compact import UpdatedTable

# second stage ----------------------------------------------------------------------------

OTHERS = (
    "others",
    """SELECT p_partkey AS product_base_id, (row_number() OVER (ORDER BY md5(p_partkey::VARCHAR), p_partkey) - 1) // 30 AS batch_id
       FROM classed WHERE partner_category = 'Others'""",
)


def open_items(spark, sf):
    return classified(spark, sf).filter(F.col("partner_category") == "Others").select(
        F.col("p_partkey").alias("product_base_id"), F.col("p_name").alias("product_name"), F.col("p_brand").alias("brand")
    )


@query("tag21_batches", ctes(CLASSED, OTHERS) + "SELECT product_base_id, batch_id FROM others")
def tag21_batches(spark, sf):
    return residual.residual_batches(open_items(spark, sf)).select("product_base_id", "batch_id")


def second_stage(skus):
    """Stand-in for the caller's tagger: decides from the name only."""
    out = []
    for s in skus:
        name = s["product_name"]
        out.append(
            {
                "product_base_id": s["product_base_id"],
                "r_category": "tools" if "anvil" in name else "toys" if "gizmo" in name else "",
                "r_gender": "nam" if "cold" in name else "all",
                "r_brand": s["brand"] if "old" in name else "",
            }
        )
    return out


@query(
    "tag22_apply",
    ctes(CLASSED)
    + """SELECT l_orderkey, l_linenumber, l_extendedprice, p_partkey AS product_base_id,
      CASE WHEN o THEN CASE WHEN contains(p_name, 'anvil') THEN 'tools' ELSE '' END END AS category, CASE WHEN o AND contains(p_name, 'cold') THEN 'nam' END AS gender,
      CASE WHEN o THEN CASE WHEN contains(p_name, 'old') THEN p_brand ELSE 'No Brand' END END AS brand_tagged, o AS tagged
      FROM lineitem JOIN (SELECT *, partner_category = 'Others' AS o FROM classed) ON l_partkey = p_partkey""",
)
def tag22_apply(spark, sf):
    batches = residual.residual_batches(open_items(spark, sf))
    results = residual.run_batches(
        residual.pack_batches(batches, ["product_base_id", "product_name", "brand"]),
        second_stage,
        "product_base_id bigint, r_category string, r_gender string, r_brand string",
    )
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", F.col("l_partkey").alias("product_base_id"))
    return residual.apply_results(rows, results, "tools")


# classification --------------------------------------------------------------------------


def labelled(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        F.when(F.col("doc_id") % 50 != 0, F.col("text")).alias("text"),
        F.when(F.col("doc_id") % 11 == 0, F.lit("NaN")).when(F.col("doc_id") % 13 == 0, F.lit("")).otherwise(F.upper("lang")).alias("label"),
    )


LABELLED = [
    (
        "raw",
        """SELECT doc_id, CASE WHEN doc_id % 50 <> 0 THEN text END AS text,
           CASE WHEN doc_id % 11 = 0 THEN 'NaN' WHEN doc_id % 13 = 0 THEN '' ELSE upper(lang) END AS label FROM documents""",
    ),
    ("clean", "SELECT doc_id, nfc_normalize(lower(text)) AS text, lower(label) AS label FROM raw WHERE text <> '' AND label <> '' AND lower(label) NOT IN ('none', 'nan')"),
    (
        "balanced",
        """SELECT * FROM (SELECT * FROM clean WHERE label IN (SELECT label FROM clean GROUP BY label HAVING count(*) >= 2)
             QUALIFY row_number() OVER (PARTITION BY text, label ORDER BY doc_id) = 1)
           QUALIFY row_number() OVER (PARTITION BY label ORDER BY doc_id) <= 100""",
    ),
]


@query("ml1_clean", ctes(*LABELLED) + "SELECT doc_id, label, md5(text) AS text FROM clean")
def ml1_clean(spark, sf):
    return ml.clean_labelled(labelled(spark, sf)).select("doc_id", "label", F.md5(F.col("text").cast("binary")).alias("text"))


@query("ml2_balance", ctes(*LABELLED) + "SELECT doc_id, label FROM balanced")
def ml2_balance(spark, sf):
    return ml.balance_labels(ml.clean_labelled(labelled(spark, sf)), ["doc_id"]).select("doc_id", "label")


@query(
    "ml3_label_map",
    "SELECT source AS label, count(*) AS n, (row_number() OVER (ORDER BY count(*) DESC, source) - 1)::INT AS label_id FROM documents GROUP BY 1",
)
def ml3_label_map(spark, sf):
    return ml.label_map(table(spark, sf, "documents").select(F.col("source").alias("label")))


@query(
    "ml4_split",
    """WITH n AS (SELECT doc_id, row_number() OVER (ORDER BY md5('42|' || doc_id), doc_id) AS p, count(*) OVER () AS n FROM documents),
       s AS (SELECT *, floor(0.1::DOUBLE * n)::BIGINT AS v FROM n)
       SELECT doc_id, CASE WHEN p <= n - 2 * v THEN 'train' WHEN p <= n - v THEN 'val' ELSE 'test' END AS split FROM s""",
)
def ml4_split(spark, sf):
    return ml.split_exact(table(spark, sf, "documents").select("doc_id"), ["doc_id"])


@query("ml5_weights", f"SELECT vec_id, label, {r('1.0::DOUBLE / count(*) OVER (PARTITION BY label)', 9)} AS weight FROM embeddings")
def ml5_weights(spark, sf):
    df = ml.class_weights(table(spark, sf, "embeddings").select("vec_id", "label"))
    return df.withColumn("weight", F.bround("weight", 9))


@query(
    "ml6_normalize",
    f"""WITH n AS (SELECT vec_id, embedding, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS n FROM embeddings)
        SELECT vec_id, {r('embedding[1]::DOUBLE / n')} AS first_item, {r('embedding[64]::DOUBLE / n')} AS last_item FROM n""",
)
def ml6_normalize(spark, sf):
    df = ml.normalize_vectors(table(spark, sf, "embeddings"))
    return df.select(
        "vec_id",
        F.bround(F.get("embedding", F.lit(0)), 6).alias("first_item"),
        F.bround(F.get("embedding", F.lit(63)), 6).alias("last_item"),
    )


def _trained(spark, sf):
    data = ml.split_exact(ml.normalize_vectors(table(spark, sf, "embeddings")), ["vec_id"])
    train = data.filter(F.col("split") == "train")
    labels = ml.label_map(train.select("label"))
    rows = train.join(labels.drop("n"), "label").select("vec_id", "embedding", "label", "label_id")
    # one row per class
    model = ml.train_classifier(rows, labels.count(), 64, epochs=40)
    return model, data.filter(F.col("split") != "train").drop("split"), labels


@query("ml7_classifier")
def ml7_classifier(spark, sf):
    model, rest, labels = _trained(spark, sf)
    scored = ml.predict_topk(model, rest, labels, 1)
    return ml.macro_metrics(scored.withColumn("label", F.col("label").cast("string")), "label", "pred_1_label")


@query("ml8_topk")
def ml8_topk(spark, sf):
    model, rest, labels = _trained(spark, sf)
    return ml.predict_topk(model, rest, labels, 3).drop("embedding")


@query(
    "ml8_topk_given",
    f"""WITH p AS (SELECT vec_id, [round(abs(embedding[i])::DOUBLE, 1) for i in range(1, 7)] AS chances FROM embeddings),
       u AS (SELECT vec_id, unnest(chances) AS p, generate_subscripts(chances, 1) - 1 AS id FROM p),
       o AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, id) AS n FROM u)
       SELECT vec_id, max(CASE WHEN n = 1 THEN CASE id WHEN 5 THEN 'unknown' ELSE 'class ' || id END END) AS pred_1_label, max(CASE WHEN n = 1 THEN {r('p', 4)} END) AS pred_1_score,
         max(CASE WHEN n = 2 THEN CASE id WHEN 5 THEN 'unknown' ELSE 'class ' || id END END) AS pred_2_label, max(CASE WHEN n = 2 THEN {r('p', 4)} END) AS pred_2_score
       FROM o GROUP BY vec_id""",
)
def ml8_topk_given(spark, sf):
    """Probabilities with many ties, and a class without a name."""
    chances = F.transform(F.slice("embedding", 1, 6), lambda x: F.round(F.abs(x).cast("double"), 1))
    rows = table(spark, sf, "embeddings").select("vec_id", chances.alias("chances"))
    labels = spark.createDataFrame([(i, f"class {i}") for i in range(5)], "label_id int, label string")
    return ml.topk_labels(rows, labels, 2, "chances").drop("chances")


METRICS = [
    ("pairs", "SELECT lang AS truth, CASE WHEN doc_id % 4 = 0 THEN 'en' WHEN doc_id % 9 = 0 THEN 'xx' ELSE lang END AS guess FROM documents"),
    ("classes", "SELECT truth AS label FROM pairs UNION SELECT guess FROM pairs"),
    (
        "c",
        """SELECT label, (SELECT count(*) FROM pairs WHERE truth = label) AS support, (SELECT count(*) FROM pairs WHERE guess = label) AS predicted,
           (SELECT count(*) FROM pairs WHERE guess = label AND truth = label) AS tp FROM classes""",
    ),
    ("m", f"SELECT *, coalesce({div('tp', 'predicted')}, 0) AS p, coalesce({div('tp', 'support')}, 0) AS rec, coalesce(2 * p * rec / nullif(p + rec, 0), 0) AS f1 FROM c"),
    (
        "macro",
        f"""SELECT sum(support)::BIGINT AS n_samples, count(*) AS n_classes, {r('avg(rec)')} AS macro_accuracy, {r('avg(p)')} AS macro_precision,
            {r('avg(rec)')} AS macro_recall, {r('avg(f1)')} AS macro_f1 FROM m""",
    ),
]


def _macro(spark, sf):
    k = F.col("doc_id")
    guess = F.when(k % 4 == 0, "en").when(k % 9 == 0, "xx").otherwise(F.col("lang"))
    df = ml.macro_metrics(table(spark, sf, "documents").select(F.col("lang").alias("label"), guess.alias("prediction")))
    return df.withColumns({c: F.bround(c, 6) for c in df.columns if c.startswith("macro")})


query("ml9_metrics", ctes(*METRICS) + "SELECT * FROM macro")(_macro)


@query("f16_nfkc", "SELECT doc_id, md5(nfc_normalize(text)) AS text FROM documents")
def f16_nfkc(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(nfkc("text", "NFC").cast("binary")).alias("text"))


#: Terms by rule: every pair of these syllables.
SYLLABLES = "an ar as at ed en er es ha in io is it le nd ng nt of on or ou re se st te th the ti to und".split()


@query(
    "fil7_terms",
    f"""WITH s AS (SELECT unnest({SYLLABLES}) AS s), terms AS (SELECT list(a.s || b.s) AS terms FROM s a, s b),
        hits AS (SELECT doc_id, list_distinct(list_filter(terms, lambda t: contains(lower(text), t))) AS hit, lower(text) AS text FROM documents, terms),
        first AS (SELECT *, list_sort(list_transform(hit, lambda t: (instr(text, t) - 1, t)))[1] AS f FROM hits)
        SELECT doc_id, len(hit)::INT AS terms, f[2]::VARCHAR AS first_term, f[1]::INT AS first_at FROM first""",
)
def fil7_terms(spark, sf):
    """A dictionary of 900 terms in one pass over every text."""
    found = find_terms(F.lower("text"), [a + b for a in SYLLABLES for b in SYLLABLES])
    hits = table(spark, sf, "documents").select("doc_id", found.alias("hit"))
    return hits.select("doc_id", F.size("hit").alias("terms"), F.get("hit", F.lit(0))["term"].alias("first_term"), F.get("hit", F.lit(0))["at"].alias("first_at"))


# streaming -------------------------------------------------------------------------------


@query("str1_tag_stream", ctes(CLIPS) + f"SELECT video_id, {VIDEO_TAG_SQL} FROM clips")
def str1_tag_stream(spark, sf):
    docs = jobs.stream_table(spark, sf, "documents").select(
        F.col("doc_id").alias("video_id"),
        F.when(F.col("doc_id") % 5 != 0, F.split_part("text", F.lit("\n"), F.lit(1))).alias("hashtags"),
        F.col("text").alias("description"),
    )
    tagged = jobs.tag_on_arrival(docs, lambda df: video_tags(df).select("video_id", *VIDEO_TAGS))
    return jobs.run_to_end(tagged, "tagged")


def _link_or_rule(rows):
    """A product link decides; without one the first rule of the dictionary version does."""
    link = F.col("list_product_base_id")
    v1 = F.when(F.col("text").contains("the"), "english").otherwise("Unknown")
    v2 = F.when(F.col("text").contains("der"), "german").when(F.col("text").contains("the"), "english").otherwise("Unknown")
    rule = F.when(F.col("tag_dict_version") == "v2", v2).otherwise(v1)
    return rows.select(
        "post_base_id",
        F.when(F.size(link) > 0, F.concat(F.lit("shelf "), (F.element_at(link, 1) % 7).cast("string"))).otherwise(rule).alias("category_l1"),
        F.when(F.size(link) > 0, "product_link").otherwise("rule").alias("category_source"),
        "tag_dict_version",
    )


@query(
    "str1_retag",
    """SELECT doc_id AS post_base_id, CASE WHEN doc_id % 4 = 0 THEN 'shelf ' || ((doc_id * 3) % 7)
         ELSE CASE WHEN contains(text, 'der') THEN 'german' WHEN contains(text, 'the') THEN 'english' ELSE 'Unknown' END END AS category_l1,
         CASE WHEN doc_id % 4 = 0 THEN 'product_link' ELSE 'rule' END AS category_source, 'v2' AS tag_dict_version FROM documents""",
)
def str1_retag(spark, sf):
    """Links come before and after their posts, then a new dictionary; every phase is a restart of the stream."""
    posts = table(spark, sf, "documents").select(F.col("doc_id").alias("post_base_id"), "text")
    early, late = posts.filter("post_base_id % 10 <> 4"), posts.filter("post_base_id % 10 = 4")
    links = posts.filter("post_base_id % 4 = 0").select("post_base_id", F.array(F.col("post_base_id") * 3).alias("list_product_base_id"))
    event = lambda rows, at: retag.post_events(rows, "post_base_id", F.lit(at), ["text"])
    phases = [
        event(early, 1).unionByName(retag.version_event(spark, "v1", 1)),
        retag.link_events(links, "post_base_id", F.lit(2), "list_product_base_id"),
        event(late, 3).unionByName(retag.version_event(spark, "v2", 3)),
    ]
    return retag.run_phases(spark, phases, fields=posts.schema, key="post_base_id", products="list_product_base_id", tagger=_link_or_rule)


@query("str2_ingest", "SELECT DISTINCT user_id, event_type FROM events")
def str2_ingest(spark, sf):
    events = jobs.stream_table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    out = jobs.ingest_once(events, ["user_id", "event_type"], "ts", "60 days")
    return jobs.run_to_end(out.select("user_id", "event_type"), "ingest")


@query(
    "str3_minutes",
    """SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS minute, event_type, count(*) AS n, sum(value::DECIMAL(18,2))::DOUBLE AS total FROM events
       GROUP BY 1, 2""",
)
def str3_minutes(spark, sf):
    events = jobs.stream_table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    out = jobs.run_updates(jobs.minute_metrics(events), ["minute", "event_type"], "minutes")
    return out.withColumn("minute", F.col("minute").cast("timestamp_ntz"))


@query(
    "str3_compacted",
    """SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS minute, event_type, count(*) AS n, sum(value::DECIMAL(18,2))::DOUBLE AS total FROM events
       GROUP BY 1, 2""",
)
def str3_compacted(spark, sf):
    """Events arrive week by week; after each delivery the minutes behind the watermark are closed."""
    events = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    weeks = [r.m for r in events.select(F.date_trunc("week", "ts").alias("m")).distinct().orderBy("m").collect()]
    inbox, target, checkpoint = (fresh_path(spark, n) for n in ("minutes-in", "minutes-out", "minutes-state"))
    for week in weeks:
        part = events.filter(F.date_trunc("week", "ts") == F.lit(week))
        part.write.mode("append").parquet(inbox)
        stream = jobs.minute_metrics(spark.readStream.schema(events.schema).parquet(inbox))
        jobs.run_updates(stream, ["minute", "event_type"], "minutes", target, checkpoint)
        minutes = UpdatedTable(spark, target, stream.schema, ["minute", "event_type"], "minute")
        minutes.compact(str(part.agg(F.max("ts") - F.expr("interval 11 minutes")).first()[0]))
    return minutes.read().withColumn("minute", F.col("minute").cast("timestamp_ntz"))


# sources and sinks -----------------------------------------------------------------------


@query("src1_scan", "SELECT l_orderkey, l_partkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-06-01'")
def src1_scan(spark, sf):
    df = load_posts(spark, f"{sf.rstrip('/')}/lineitem.parquet", ["l_orderkey", "l_partkey", "l_shipdate"])
    return df.filter(F.col("l_shipdate") >= F.lit("2001-06-01").cast("timestamp_ntz")).drop("l_shipdate")


@query("src2_csv", "SELECT doc_id, md5(text) AS text, lang FROM documents")
def src2_csv(spark, sf):
    path = fresh_path(spark, "csv")
    table(spark, sf, "documents").select("doc_id", "text", "lang").write.csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    df = readers.read_csv(spark, path, "doc_id bigint, text string, lang string")
    return df.withColumn("text", F.md5(F.col("text").cast("binary")))


@query("src2_split_csv", "SELECT doc_id, md5('\"' || text || '\",' || chr(13) || chr(10) || lang) AS text, lang FROM documents")
def src2_split_csv(spark, sf):
    """Quotes, separators and both line ends inside the texts."""
    path = fresh_path(spark, "csv")
    text = F.concat(F.lit('"'), "text", F.lit('",\r\n'), "lang")
    rows = table(spark, sf, "documents").select("doc_id", text.alias("text"), "lang")
    rows.write.csv(path, header=True, quoteAll=True, escape='"', lineSep="\n", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    df = split_csv.read_split_csv(spark, path, "doc_id bigint, text string, lang string")
    return df.withColumn("text", F.md5(F.col("text").cast("binary")))


@query(
    "src3_search_json",
    """WITH p AS (SELECT *, lower(p_type) AS k FROM part), u AS (SELECT p_partkey, k, unnest([1, 2, 3]) AS position FROM p)
       SELECT '  ' || k || '   FOR Men ' AS key_word, position::INT AS position, CASE WHEN position < 3 THEN p_partkey END AS itemid FROM u""",
)
def src3_search_json(spark, sf):
    from bazaarlens.plans.market import search_docs

    return readers.search_items(search_docs(spark, sf)).select("key_word", "position", "itemid")


@query(
    "src4_concat_json",
    """SELECT o_orderkey AS session_id, 'x}{y "' || o_orderpriority || '" {"code": 1} {' AS title, o_orderkey AS inner_code FROM orders
       UNION ALL SELECT -1 - o_orderkey, 'again', NULL FROM orders WHERE o_orderkey % 5 <> 0
       UNION ALL SELECT NULL, NULL, NULL FROM orders WHERE o_orderkey % 5 = 0""",
)
def src4_concat_json(spark, sf):
    """Documents one after another: separators inside texts, nested envelopes, cut-off documents."""
    path = fresh_path(spark, "concat")
    key = F.col("o_orderkey")
    title = F.concat(F.lit('x}{y "'), "o_orderpriority", F.lit('" {"code": 1} {'))
    inner = F.struct(F.struct(key.alias("code")).alias("inner"))
    doc = F.to_json(F.struct(F.lit(0).alias("code"), key.alias("sessionId"), title.alias("title"), F.array(inner).alias("list")))
    again = F.to_json(F.struct(F.lit(0).alias("code"), (F.lit(-1) - key).alias("sessionId"), F.lit("again").alias("title")))
    # every fifth order's second document stops within a list; the next one follows at once
    cut = F.when(key % 5 == 0, F.lit('{"code":0,"rows":[{"time":1},{"time"')).otherwise(again)
    table(spark, sf, "orders").select(F.concat(cut, doc).alias("value")).write.text(path)
    docs = readers.read_concat_json(spark, path, "sessionId bigint, title string, list array<struct<inner:struct<code:bigint>>>")
    return docs.select(F.col("data.sessionId").alias("session_id"), F.col("data.title").alias("title"), F.get("data.list", 0)["inner"]["code"].alias("inner_code"))


@query("src5_latest", "SELECT count(*) AS n_rows, max(event_id) AS last_id FROM events")
def src5_latest(spark, sf):
    newest = readers.latest_file(spark, f"{sf.rstrip('/')}/events.parquet*")
    return spark.read.parquet(newest).agg(F.count("*").alias("n_rows"), F.max("event_id").alias("last_id"))


@query("src6_rules", ctes(CLIPS) + f"SELECT video_id, brand_detail FROM (SELECT video_id, {VIDEO_TAG_SQL} FROM clips)")
def src6_rules(spark, sf):
    """Brand rules from a rule file on disk, applied to all texts."""
    from bazaarlens.operators.tagging import tag_brands

    path = fresh_path(spark, "rules")
    spark.createDataFrame(BRANDS, "brand_key string, brand_display string, keyword_pattern string").write.csv(path, header=True, escape='"')
    return tag_brands(clips(spark, sf), readers.load_brands(spark, path)).select("video_id", "brand_detail")


@query(
    "src7_literal",
    "SELECT o_orderkey, t.label FROM orders JOIN (VALUES ('1-URGENT', 'hot'), ('2-HIGH', 'warm')) t(k, label) ON o_orderpriority = t.k",
)
def src7_literal(spark, sf):
    words = readers.literal_table(spark, [("1-URGENT", "hot"), ("2-HIGH", "warm")], "o_orderpriority string, label string")
    return table(spark, sf, "orders").join(words, "o_orderpriority").select("o_orderkey", "label")


@query("src8_lazada", "SELECT lower(p_type) AS key_word, 1::INT AS position, p_partkey::VARCHAR AS \"itemId\", p_name AS name, p_brand AS \"brandName\" FROM part")
def src8_lazada(spark, sf):
    item = F.struct(F.col("p_partkey").cast("string").alias("itemId"), F.col("p_name").alias("name"), F.col("p_brand").alias("brandName"))
    body = F.struct(F.struct(F.array(item).alias("listItems")).alias("mods"))
    docs = table(spark, sf, "part").select(F.to_json(F.create_map(F.lower("p_type"), body)).alias("value"))
    return readers.lazada_items(docs)


def _keyword_files(spark, sf, result):
    """Every part as an object keyed by keyword, some of them over several lines, in files without an outer list."""
    path = fresh_path(spark, "keyword-json")
    body = F.to_json(F.create_map(F.lower("p_type"), result))
    spread = F.when(F.col("p_partkey") % 2 == 0, F.replace(body, F.lit(","), F.lit(",\n  "))).otherwise(body)
    table(spark, sf, "part").select(spread.alias("value")).write.text(path)
    return path


@query(
    "src3_variant",
    """SELECT lower(p_type) AS key_word, i::INT AS position, CASE WHEN i = 1 THEN p_partkey END AS itemid, CASE WHEN i = 1 THEN p_name END AS name,
       CASE WHEN i = 2 THEN p_size::BIGINT END AS drifted FROM part, (SELECT unnest([1, 2]) AS i)""",
)
def src3_variant(spark, sf):
    """The second item of every list has another shape, which is kept."""
    basic = F.struct(F.struct(F.col("p_partkey").alias("itemid"), F.col("p_name").alias("name")).alias("item_basic"), F.lit(None).cast("bigint").alias("size"))
    other = F.struct(F.lit(None).cast("struct<itemid:bigint,name:string>").alias("item_basic"), F.col("p_size").cast("bigint").alias("size"))
    items = split_json.search_results(spark, _keyword_files(spark, sf, F.struct(F.array(basic, other).alias("items"))))
    return items.select("key_word", "position", "itemid", "name", F.try_variant_get("item", "$.size", "bigint").alias("drifted"))


@query("src8_variant", "SELECT lower(p_type) AS key_word, 1::INT AS position, p_partkey::VARCHAR AS \"itemId\", p_name AS name, p_brand AS \"brandName\" FROM part")
def src8_variant(spark, sf):
    item = F.struct(F.col("p_partkey").cast("string").alias("itemId"), F.col("p_name").alias("name"), F.col("p_brand").alias("brandName"))
    path = _keyword_files(spark, sf, F.struct(F.struct(F.array(item).alias("listItems")).alias("mods")))
    return split_json.lazada_results(spark, path).drop("item")


@query("snk1_tagged", ctes(CLIPS) + f"SELECT video_id, channel_id, {VIDEO_TAG_SQL} FROM clips")
def snk1_tagged(spark, sf):
    path = fresh_path(spark, "videos-tagged")
    sinks.write_tagged(video_tags(clips(spark, sf)), path, ["video_id", "channel_id", "missing"], VIDEO_TAGS, "parquet")
    return spark.read.parquet(path)


@query("snk2_insert", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def snk2_insert(spark, sf):
    """Two overlapping deliveries and a repeat leave one row per key."""
    path = fresh_path(spark, "inserted")
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice")
    order = [F.asc("l_shipdate"), F.asc("l_extendedprice")]
    first = rows.filter(F.col("l_shipdate") < F.lit("1999-06-01").cast("timestamp_ntz"))
    for part in (first, rows, rows):
        sinks.insert_new(part, path, ["l_orderkey", "l_linenumber"], order)
    return spark.read.parquet(path).select("l_orderkey", "l_linenumber")


@query("snk2_keyed", "SELECT DISTINCT nullif(l_orderkey % 5000, 7) AS l_orderkey, nullif(l_linenumber, 4) AS l_linenumber FROM lineitem")
def snk2_keyed(spark, sf):
    """Deliveries that overlap, one of them twice and one in two shares, with NULL in either key."""
    rows = table(spark, sf, "lineitem").select(
        F.nullif(F.col("l_orderkey") % 5000, F.lit(7)).alias("l_orderkey"), F.nullif("l_linenumber", F.lit(4)).alias("l_linenumber"), "l_shipdate", "l_extendedprice"
    )
    order = [F.asc("l_shipdate"), F.asc("l_extendedprice")]
    target = KeyedTable(spark, fresh_path(spark, "keyed"), rows.schema, ["l_orderkey", "l_linenumber"], 16)
    first = rows.filter(F.col("l_shipdate") < F.lit("1999-06-01").cast("timestamp_ntz"))
    for delivery, part, share in (("a", first, (0, 1)), ("b", rows, (0, 2)), ("b", rows, (1, 2)), ("a", first, (0, 1)), ("c", rows, (0, 1))):
        target.insert(part, delivery, order, share)
    return target.read().select("l_orderkey", "l_linenumber")


@query("snk3_report", ctes(*METRICS) + "SELECT 'demo' AS project, * FROM macro")
def snk3_report(spark, sf):
    path = fresh_path(spark, "report")
    metrics = _macro(spark, sf)
    report = sinks.metrics_report(metrics, {"project": "demo"})
    sinks.write_report(report, path)
    return spark.read.schema(report.schema).json(path).drop("markdown")


@query("snk4_serving", ctes(*cascade_sql()) + f"SELECT {', '.join(CAT_COLS)}, f.channel_base_id FROM final f")
def snk4_serving(spark, sf):
    path = fresh_path(spark, "serving")
    facts = videos(spark, sf)
    with interim(spark) as keep:
        # one wide shuffle at a time: the join's is gone before that of the writers begins
        tags = keep(cascaded(spark, sf, facts).select(*CAT_COLS), "tags").hint("merge")
        sinks.write_serving(keep(sinks.attach_tags(facts, tags), "served"), path)
    return spark.read.parquet(path).select(*CAT_COLS, "channel_base_id")

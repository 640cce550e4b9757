"""Tagging, purity and cascade queries.

The default rule tables are Vietnamese; the given texts are not, so the queries bring rule
tables of the same shape whose words occur in the given texts.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from bazaarlens.functions.columns import has_items
from bazaarlens.functions.rule_tables import Brand, Rule
from bazaarlens.functions.text import fold
from bazaarlens.operators import cascade as cas
from bazaarlens.operators import purity as pur
from bazaarlens.operators import tagging as tag
from bazaarlens.operators.creators import CRAWL_ORDER
from bazaarlens.operators.dedup import latest_by, newest
from bazaarlens.plans.creators import BRAND_COUNTS, CAT_COUNTS, TAGGED, brand_hashtag_counts, hashtag_counts
from bazaarlens.plans.registry import div, query, r
from bazaarlens.plans.views import categories, ctes, latest_sql, products, raw_posts, with_tags
from bazaarlens.session import interim, settle
from bazaarlens.sources.tables import table

# ---------------------------------------------------------------------------------------
# videos as texts


def clips(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    return d.select(
        F.col("doc_id").alias("video_id"),
        F.col("source").alias("channel_id"),
        F.when(F.col("doc_id") % 7 != 0, F.concat(F.lit("chan "), "lang")).alias("channel_name"),
        F.when(F.col("doc_id") % 5 != 0, F.split_part("text", F.lit("\n"), F.lit(1))).alias("hashtags"),
        F.col("text").alias("description"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("doc_id").cast("int"))).alias("platform_created_at"),
    )


def profiles(spark, sf):
    s = table(spark, sf, "supplier").filter(F.col("s_suppkey") % 4 != 0)
    k = F.col("s_suppkey")
    return s.select(
        F.concat(F.lit("src"), k.cast("string")).alias("channel_id"),
        F.when(k % 5 != 0, F.col("s_name")).alias("channel_name"),
        F.when(k % 3 == 0, "find me on Instagram").when(k % 3 == 1, F.concat(F.lit("for work mail "), "s_name")).alias("description"),
        F.when(F.col("s_acctbal") > 0, F.floor(F.col("s_acctbal") * F.col("s_acctbal") / 50)).alias("followers"),
        (k * 3).alias("video_count"),
    )


CLIPS = (
    "clips",
    """SELECT doc_id AS video_id, source AS channel_id, CASE WHEN doc_id % 7 <> 0 THEN 'chan ' || lang END AS channel_name,
       CASE WHEN doc_id % 5 <> 0 THEN split_part(text, chr(10), 1) END AS hashtags, text AS description,
       TIMESTAMP '2024-01-01' + to_minutes(doc_id) AS platform_created_at,
       lower(coalesce(CASE WHEN doc_id % 5 <> 0 THEN split_part(text, chr(10), 1) END, '')) AS h, lower(coalesce(text, '')) AS d,
       lower(coalesce(CASE WHEN doc_id % 5 <> 0 THEN split_part(text, chr(10), 1) END, '')) || ' ' || lower(coalesce(text, '')) AS b FROM documents""",
)
PROFILES = (
    "profiles",
    """SELECT 'src' || s_suppkey AS channel_id, CASE WHEN s_suppkey % 5 <> 0 THEN s_name END AS channel_name,
       CASE s_suppkey % 3 WHEN 0 THEN 'find me on Instagram' WHEN 1 THEN 'for work mail ' || s_name END AS description,
       CASE WHEN s_acctbal > 0 THEN floor(s_acctbal * s_acctbal / 50)::BIGINT END AS followers, s_suppkey * 3 AS video_count
       FROM supplier WHERE s_suppkey % 4 <> 0""",
)
WORD = r"(^|[^a-zà-ÿ]){}([^a-zà-ÿ]|$)"
BRANDS = [
    Brand("alba", "Alba", "quevi|ouché|eneux"),
    Brand("bela", "Bela", "threea|onnd|" + WORD.format("shat")),
    Brand("cora", "Cora", "schung|ungder|undie"),
    Brand("dove", "Dove", "ciónlos|losque"),
]
CONCERNS = [
    Rule("Sun", "both", "erenth|heedst|" + WORD.format("his")),
    Rule("Dry", "hashtags", "the |der |la "),
    Rule("Calm", "description", "ierre|schen|onha"),
]
FALLBACK = Rule("General", "both", WORD.format("and") + "|" + WORD.format("und"))
FLAGS = [Rule("True", "both", r"\|"), Rule("Maybe", "hashtags", "%|\\$")]
CONTENT = [
    Rule("Sponsored", "both", "rewh|" + WORD.format("de"), 1),
    Rule("Review", "both", WORD.format("to"), 2),
    Rule("Tutorial", "hashtags", "ing|ung|tion", 3),
    Rule("Unboxing", "description", "^the|^la", 3),
]
COL = {"both": "b", "hashtags": "h", "description": "d"}


def _hit(rule: Rule) -> str:
    return f"regexp_matches({COL[rule.source]}, '{rule.pattern}')"


def _list(pairs) -> str:
    items = ", ".join(f"CASE WHEN {cond} THEN '{label}' END" for label, cond in pairs)
    return f"list_filter([{items}], lambda x: x IS NOT NULL)"


BRAND_LIST = _list([(b.display, f"regexp_matches(b, '{b.pattern}')") for b in BRANDS])
CONCERN_SQL = f"array_to_string({_list([(c.label, _hit(c)) for c in CONCERNS])}, '; ')"
FALL_SQL = f"CASE WHEN {CONCERN_SQL} = '' AND {_hit(FALLBACK)} THEN 'General' ELSE {CONCERN_SQL} END"
FLAG_SQL = f"CASE WHEN {_hit(FLAGS[1])} THEN 'Maybe' WHEN {_hit(FLAGS[0])} THEN 'True' ELSE '' END"


def _offset(text: str, pattern: str) -> str:
    return f"CASE WHEN regexp_matches({text}, '{pattern}') THEN length(regexp_extract({text}, '(?s)^(.*?)(?:{pattern})', 1)) END"


def _place(rule: Rule) -> str:
    parts = []
    if rule.source in ("hashtags", "both"):
        parts.append(_offset("h", rule.pattern))
    if rule.source in ("description", "both"):
        base = "length(h) + 1 + " if rule.source == "both" else ""
        parts.append(f"{base}({_offset('d', rule.pattern)})")
    return f"least({', '.join(parts)})" if len(parts) > 1 else parts[0]


CONTENT_ITEMS = ", ".join(
    "{" + f"'pos': {_place(c)}, 'pri': {c.priority}, 'seq': {i}, 'label': '{c.label}'" + "}" for i, c in enumerate(CONTENT)
)
CONTENT_SQL = f"coalesce(list_sort(list_filter([{CONTENT_ITEMS}], lambda x: x.pos IS NOT NULL))[1].label, '')"


@query(
    "tag1_search_text",
    ctes(CLIPS) + "SELECT video_id, md5(h) AS tags, md5(d) AS description, md5(b) AS both_texts FROM clips",
)
def tag1_search_text(spark, sf):
    md5 = lambda s: F.md5(tag.search_text(s).cast("binary"))
    return clips(spark, sf).select(
        "video_id", md5("hashtags").alias("tags"), md5("description").alias("description"), md5("both").alias("both_texts")
    )


BRAND_SQL = f"""CASE len({BRAND_LIST}) WHEN 0 THEN 'No Brand' WHEN 1 THEN 'Single-brand' ELSE 'Multi-brand' END AS brand_scope,
  CASE WHEN len({BRAND_LIST}) = 0 THEN 'No Brand' ELSE array_to_string({BRAND_LIST}, '; ') END AS brand_detail"""


@query("tag2_brands", ctes(CLIPS) + f"SELECT video_id, {BRAND_SQL} FROM clips")
def tag2_brands(spark, sf):
    return tag.tag_brands(clips(spark, sf), BRANDS).select("video_id", "brand_scope", "brand_detail")


@query("tag4_multi", ctes(CLIPS) + f"SELECT video_id, {CONCERN_SQL} AS skin_concern FROM clips")
def tag4_multi(spark, sf):
    return tag.tag_multi(clips(spark, sf), CONCERNS, "skin_concern").select("video_id", "skin_concern")


@query("tag5_fallback", ctes(CLIPS) + f"SELECT video_id, {FALL_SQL} AS skin_concern FROM clips")
def tag5_fallback(spark, sf):
    df = tag.tag_multi(clips(spark, sf), CONCERNS, "skin_concern")
    return tag.tag_fallback(df, "skin_concern", FALLBACK).select("video_id", "skin_concern")


@query("tag6_earliest", ctes(CLIPS) + f"SELECT video_id, {CONTENT_SQL} AS content_type FROM clips")
def tag6_earliest(spark, sf):
    return tag.tag_earliest(clips(spark, sf), CONTENT, "content_type").select("video_id", "content_type")


@query("tag7_flag", ctes(CLIPS) + f"SELECT video_id, {FLAG_SQL} AS partnership_flag FROM clips")
def tag7_flag(spark, sf):
    return tag.tag_flag(clips(spark, sf), FLAGS, "partnership_flag").select("video_id", "partnership_flag")


VIDEO_TAGS = ["brand_scope", "brand_detail", "skin_concern", "product_type", "partnership_flag", "content_type"]


def video_tags(df):
    return tag.tag_videos(df, BRANDS, CONCERNS, FALLBACK, CONCERNS[:2], FLAGS, CONTENT)


VIDEO_TAG_SQL = f"""{BRAND_SQL}, {FALL_SQL} AS skin_concern,
  array_to_string({_list([(c.label, _hit(c)) for c in CONCERNS[:2]])}, '; ') AS product_type, {FLAG_SQL} AS partnership_flag,
  {CONTENT_SQL} AS content_type"""


@query("tag0_videos", ctes(CLIPS) + f"SELECT video_id, {VIDEO_TAG_SQL} FROM clips")
def tag0_videos(spark, sf):
    return video_tags(clips(spark, sf)).select("video_id", *VIDEO_TAGS)


# creators --------------------------------------------------------------------------------

TYPES = [
    Rule("Gamer", "both", "losque", 4),
    Rule("Doctor", "profile", "supplier#0000000[01]2", 1),
    Rule("Partner", "both", "for work|rewhreb", 2),
    Rule("Mom", "hashtags_agg", "schungdie|unddas", 3),
    Rule("Named", "channel_name", "chan fr", 5),
    Rule("Any", "profile_both", "instagram|onndthe", 6),
]
BANDS = [("Nano", 0, 999), ("Micro", 1000, 9999), ("Rising", 10000, 99999), ("Macro", 100000, 999999), ("Mega", 1000000, None)]
PLATFORMS = [Rule("multi-platform", "description", "instagram|youtube")]
ORDER = ["platform_created_at", "video_id"]


def _band_sql(c: str) -> str:
    steps = " ".join(
        f"WHEN {c} >= {lo}" + (f" AND {c} <= {hi}" if hi is not None else "") + f" THEN '{label}'" for label, lo, hi in BANDS
    )
    return f"CASE {steps} ELSE 'Unknown' END"


TAG_HITS = {i: f"bool_or(regexp_matches(h, '{t.pattern}'))" for i, t in enumerate(TYPES)}
CREATOR_BASE = [
    CLIPS,
    PROFILES,
    (
        "vbase",
        f"""SELECT channel_id, arg_min(channel_name, video_id) FILTER (channel_name IS NOT NULL) AS vname, count(video_id) AS video_count_in_dataset,
            max(platform_created_at) AS last_video_at, {', '.join(f'{e} AS t{i}' for i, e in TAG_HITS.items())} FROM clips GROUP BY channel_id""",
    ),
    (
        "cbase",
        """SELECT v.*, coalesce(p.channel_name, v.vname) AS channel_name, p.description, p.followers, p.video_count AS channel_total_video,
           lower(coalesce(p.description, '')) AS pd, lower(coalesce(p.channel_name, v.vname, '')) AS pn
           FROM vbase v LEFT JOIN profiles p USING (channel_id)""",
    ),
]


def _type_hit(i: int, t: Rule) -> str:
    desc, name = f"regexp_matches(pd, '{t.pattern}')", f"regexp_matches(pn, '{t.pattern}')"
    profile = f"regexp_matches(pn || ' ' || pd, '{t.pattern}')"
    return {
        "description": desc,
        "channel_name": name,
        "hashtags_agg": f"t{i}",
        "profile": profile,
        "profile_both": f"({profile} OR t{i})",
    }.get(t.source, f"({desc} OR t{i})")


TYPE_SQL = (
    "CASE "
    + " ".join(f"WHEN {_type_hit(i, t)} THEN '{t.label}'" for i, t in sorted(enumerate(TYPES), key=lambda x: x[1].priority))
    + " ELSE 'Unknown' END"
)
LOYALTY = [
    (
        "bcount",
        f"SELECT channel_id, brand, count(*) AS n FROM (SELECT channel_id, unnest({BRAND_LIST}) AS brand FROM clips) GROUP BY ALL",
    ),
    ("loyal", "SELECT channel_id, string_agg(brand, '|' ORDER BY n DESC, brand) AS detail, count(*) AS k FROM bcount GROUP BY ALL"),
]
LOYALTY_SQL = """CASE WHEN k IS NULL THEN 'No-Brand' WHEN k = 1 THEN 'Single Brand' ELSE 'Multi-Brand' END AS brand_loyalty,
  coalesce(detail, 'No-Brand') AS brand_detail, coalesce(k, 0) AS brand_count"""
PLATFORM_SQL = "CASE WHEN regexp_matches(pd, 'instagram|youtube') THEN 'multi-platform' ELSE 'only Tiktok' END"


@query("tag3_priority", ctes(*CREATOR_BASE) + f"SELECT channel_id, {TYPE_SQL} AS key_type FROM cbase")
def tag3_priority(spark, sf):
    base = tag.creator_base(clips(spark, sf), profiles(spark, sf), ORDER, TYPES)
    return tag.tag_priority(base, TYPES, "key_type").select("channel_id", "key_type")


@query("tag8_band", ctes(PROFILES) + f"SELECT channel_id, {_band_sql('followers')} AS tier FROM profiles")
def tag8_band(spark, sf):
    return tag.tag_band(profiles(spark, sf), "followers", BANDS, "tier").select("channel_id", "tier")


@query(
    "tag9_creator_base",
    ctes(*CREATOR_BASE) + "SELECT channel_id, channel_name, video_count_in_dataset, last_video_at, followers, channel_total_video FROM cbase",
)
def tag9_creator_base(spark, sf):
    return tag.creator_base(clips(spark, sf), profiles(spark, sf), ORDER).select(
        "channel_id", "channel_name", "video_count_in_dataset", "last_video_at", "followers", "channel_total_video"
    )


@query("tag10_loyalty", ctes(*CREATOR_BASE, *LOYALTY) + f"SELECT channel_id, {LOYALTY_SQL} FROM vbase LEFT JOIN loyal USING (channel_id)")
def tag10_loyalty(spark, sf):
    videos = clips(spark, sf)
    out = tag.brand_loyalty(videos.select("channel_id").distinct(), videos, BRANDS)
    return out.select("channel_id", "brand_loyalty", "brand_detail", "brand_count")


@query("tag11_platform", ctes(PROFILES) + f"SELECT channel_id, {PLATFORM_SQL.replace('pd', 'lower(description)')} AS platform_addons FROM profiles")
def tag11_platform(spark, sf):
    return tag.tag_platform(profiles(spark, sf), PLATFORMS).select("channel_id", "platform_addons")


@query(
    "tag0_creators",
    ctes(*CREATOR_BASE, *LOYALTY)
    + f"""SELECT channel_id, channel_name, followers, video_count_in_dataset, {TYPE_SQL} AS key_type, {_band_sql('followers')} AS tier,
      {LOYALTY_SQL}, {PLATFORM_SQL} AS platform_addons, '2026-05-26T00:00:00' AS tagged_at FROM cbase LEFT JOIN loyal USING (channel_id)""",
)
def tag0_creators(spark, sf):
    df = tag.tag_creators(
        clips(spark, sf), profiles(spark, sf), ORDER, TYPES, BANDS, BRANDS, PLATFORMS, "2026-05-26T00:00:00"
    )
    return df.select(
        "channel_id", "channel_name", "followers", "video_count_in_dataset", "key_type", "tier",
        "brand_loyalty", "brand_detail", "brand_count", "platform_addons", "tagged_at",
    )


@query(
    "tag12_brand_rules",
    """WITH t AS (SELECT DISTINCT lower(p_brand) AS k, p_brand AS shown, p_type || '#' || p_size % 3 AS raw FROM part),
       e AS (SELECT k, shown, regexp_replace(lower(raw), '([^\\p{L}\\p{N}_])', '\\\\\\1', 'g') AS tag FROM t)
       SELECT k AS brand_key, min(shown) AS brand_display, string_agg(tag, '|' ORDER BY tag) || CASE WHEN k = 'brand#7' THEN '|\\blrp\\b' ELSE '' END AS keyword_pattern,
       count(*) AS hashtag_count FROM e GROUP BY k""",
)
def tag12_brand_rules(spark, sf):
    part = table(spark, sf, "part")
    tags = part.select(
        F.lower("p_brand").alias("brand_key"),
        F.col("p_brand").alias("brand_display"),
        F.concat("p_type", F.lit("#"), (F.col("p_size") % 3).cast("string")).alias("hashtag"),
    )
    extra = spark.createDataFrame([("brand#7", r"\blrp\b")], "brand_key string, keyword_pattern string")
    return tag.brand_rule_table(tags, extra)


GIFTS = ["cold", "old g"]
PRODUCT_RULES = [("Combo", ["small ring", "red rod"]), ("Ring", ["ring"]), ("Rod", ["rod"]), ("Metal", ["bolt", "gear"])]
AUDIENCE_RULES = [("Unisex", ["blue"]), ("Male", ["re"]), ("Female", ["o"])]


def _contains(ws) -> str:
    return "(" + " OR ".join(f"contains(lower(p_name), '{w}')" for w in ws) + ")"


def _first(rules, default) -> str:
    return "CASE " + " ".join(f"WHEN {_contains(ws)} THEN '{label}'" for label, ws in rules) + f" ELSE '{default}' END"


CLASS_SQL = f"CASE WHEN {_contains(GIFTS)} THEN 'Others' ELSE {_first(PRODUCT_RULES, 'Others')} END"
CLASSED = (
    "classed",
    f"""SELECT p_partkey, p_name, p_brand, p_retailprice, {CLASS_SQL} AS partner_category,
        CASE WHEN {CLASS_SQL} = 'Others' THEN 'Others' ELSE {_first(AUDIENCE_RULES, 'Unisex')} END AS partner_function FROM part""",
)


def classified(spark, sf):
    return tag.classify_product(table(spark, sf, "part"), "p_name", GIFTS, PRODUCT_RULES, AUDIENCE_RULES)


@query("tag13_product", ctes(CLASSED) + "SELECT p_partkey, partner_category, partner_function FROM classed")
def tag13_product(spark, sf):
    return classified(spark, sf).select("p_partkey", "partner_category", "partner_function")


@query("qc2_others", ctes(CLASSED) + f"SELECT p_partkey, {_first(PRODUCT_RULES, 'Others')} AS would_be FROM classed WHERE partner_category = 'Others' AND {_first(PRODUCT_RULES, 'Others')} <> 'Others'")
def qc2_others(spark, sf):
    return tag.audit_others(classified(spark, sf), "p_name", categories=PRODUCT_RULES).select("p_partkey", "would_be")


BY_CATEGORY = {"en": CONCERNS, "de": [Rule("Kalt", "both", "ungder|undie")], "fr": [Rule("Doux", "description", "eneux|ouché")]}


@query(
    "tag23_by_category",
    ctes((CLIPS[0], CLIPS[1].replace("AS video_id,", "AS video_id, lang,", 1)))
    + f"""SELECT video_id, CASE lang WHEN 'en' THEN {CONCERN_SQL}
      WHEN 'de' THEN array_to_string({_list([(c.label, _hit(c)) for c in BY_CATEGORY['de']])}, '; ')
      WHEN 'fr' THEN array_to_string({_list([(c.label, _hit(c)) for c in BY_CATEGORY['fr']])}, '; ') ELSE '' END AS concern FROM clips""",
)
def tag23_by_category(spark, sf):
    docs = table(spark, sf, "documents")
    df = docs.select(
        F.col("doc_id").alias("video_id"),
        "lang",
        F.when(F.col("doc_id") % 5 != 0, F.split_part("text", F.lit("\n"), F.lit(1))).alias("hashtags"),
        F.col("text").alias("description"),
    )
    return tag.tag_by_category(df, BY_CATEGORY, "lang", "concern").select("video_id", "concern")


# ---------------------------------------------------------------------------------------
# purity


def _purity(source: str, scope: str) -> str:
    p = f"(count_unique_video::DOUBLE / sum(count_unique_video) OVER (PARTITION BY {scope}hashtag))"
    return f"SELECT *, {p} AS purity, count_unique_video * ({p} * {p}) AS disc_score FROM {source}"


TARGETS = ["AFRICA", "ASIA", "EUROPE"]
TARGETS_SQL = "('AFRICA', 'ASIA', 'EUROPE')"


@query(
    "pur1_purity",
    ctes(*TAGGED, *CAT_COUNTS, ("p", _purity("cat_counts", "")))
    # not rounded: both sides do the same double operations, and rounding would split near-ties
    + "SELECT category, hashtag, count_unique_video, purity, disc_score FROM p",
)
def pur1_purity(spark, sf):
    return pur.add_purity(hashtag_counts(spark, sf))


def _dict_sql(source: str, keys: str, min_p: float, min_n: int, top: int) -> str:
    return f"""SELECT {keys}, count(*) AS hashtag_count, string_agg(hashtag, ', ' ORDER BY disc_score DESC, hashtag) AS list_hashtag FROM
      (SELECT * FROM {source} WHERE purity >= {min_p} AND count_unique_video >= {min_n}
       QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY disc_score DESC, hashtag) <= {top}) GROUP BY {keys}"""


@query(
    "pur2_category_dict",
    ctes(
        *TAGGED,
        *CAT_COUNTS,
        ("kept", f"SELECT * FROM cat_counts WHERE category IN {TARGETS_SQL}"),
        ("p", _purity("kept", "")),
        ("d", _dict_sql("p", "category", 0.3, 3, 40)),
    )
    + "SELECT category AS cate, '' AS brand, hashtag_count, list_hashtag FROM d",
)
def pur2_category_dict(spark, sf):
    return pur.category_dictionary(hashtag_counts(spark, sf), 0.3, 3, 40, TARGETS)


@query(
    "pur3_brand_dict",
    ctes(
        *TAGGED,
        *BRAND_COUNTS,
        ("kept", "SELECT * FROM brand_counts WHERE brand NOT IN ('Unknown', 'Không Có')"),
        ("p", _purity("kept", "category, ")),
        ("d", _dict_sql("p", "category, brand", 0.05, 2, 10)),
    )
    + "SELECT category AS cate, brand, hashtag_count, list_hashtag FROM d",
)
def pur3_brand_dict(spark, sf):
    return pur.brand_dictionary(brand_hashtag_counts(spark, sf), 0.05, 2, 10)


@query(
    "pur4_verdict",
    ctes(*TAGGED, *CAT_COUNTS, ("p", _purity("cat_counts", "")))
    + """SELECT category, hashtag, sum(count_unique_video) OVER (PARTITION BY hashtag)::BIGINT AS global_freq,
      CASE WHEN sum(count_unique_video) OVER (PARTITION BY hashtag) > 20 AND purity > 0.2 THEN 'KEEP' ELSE 'DROP' END AS action FROM p""",
)
def pur4_verdict(spark, sf):
    return pur.purity_verdict(hashtag_counts(spark, sf), 20, 0.2).select("category", "hashtag", "global_freq", "action")


# ---------------------------------------------------------------------------------------
# cascade

TAG_HEADS, KEY_TAILS = ("small", "red", "hot"), ("bolt", "gear", "rod")
VERSION, TAGGED_AT = "v2", "2026-06-01 00:00:00"


def videos(spark, sf):
    fields = ["post_base_id", "channel_base_id", "updated_at", "view_count", "list_product_base_id"]
    made_of = ["last_time_crawled_at", "reaction_count", "l_linenumber", "o_orderpriority", "p_name"]
    with interim(spark) as keep:
        # the shuffles of the joins are gone before those of the collapse begin
        raw = keep(raw_posts(spark, sf, tags=True).select(*fields, *made_of), "raw-videos")
        # the texts are made after the collapse, which moves what they are made of
        newest_rows = with_tags(latest_by(raw, ["post_base_id"], newest(*CRAWL_ORDER))).select(*fields, "hashtags", "description")
        return settle(newest_rows, "videos")


def dictionaries(spark, sf):
    """Hashtag terms are product names, keyword terms their nouns; weight = number of products."""
    named = products(spark, sf).join(
        categories(spark, sf), F.col("categories__id_1").cast("string") == F.col("category_id")
    )
    keys = [F.col("category_name").alias("category_l1"), F.col("category_l2")]
    head, tail = F.split_part("product_name", F.lit(" "), F.lit(1)), F.split_part("product_name", F.lit(" "), F.lit(2))
    weight = F.count("*").cast("double").alias("weight")
    by_tag = named.filter(head.isin(*TAG_HEADS)).groupBy(F.col("product_name").alias("term"), *keys).agg(weight)
    by_word = named.filter(tail.isin(*KEY_TAILS)).groupBy(tail.alias("term"), *keys).agg(weight)
    return by_tag, by_word


def cascaded(spark, sf, df=None, **options):
    df = videos(spark, sf) if df is None else df
    by_tag, by_word = dictionaries(spark, sf)
    return cas.tag_category_cascade(
        df, products(spark, sf), categories(spark, sf), by_tag, by_word, VERSION, TAGGED_AT, longest=2, min_videos=4, min_share=0.4, **options
    )


FOLD_SQL = "trim(regexp_replace(strip_accents(lower({x})), '[^a-z0-9]+', ' ', 'g'))"
SPLIT_SQL = r"regexp_replace(replace(replace({x}, '#', ''), '_', ' '), '([\p{{Ll}}\p{{N}}])(\p{{Lu}})', '\1 \2', 'g')"
HASH_TERM = FOLD_SQL.format(x=SPLIT_SQL.format(x="h"))
STOP_SQL = "('xuhuong', 'fyp', 'foryou', 'viral', 'trending', 'capcut', 'xh', 'xhtiktok', 'reviewdung')"


def _vote(name: str, terms: str, entries: str) -> list[tuple[str, str]]:
    return [
        (
            f"{name}_score",
            f"""SELECT post_base_id, l1, l2, sum(weight) AS score FROM (SELECT post_base_id, unnest({terms}) AS term FROM vids)
                JOIN {entries} USING (term) GROUP BY ALL""",
        ),
        (
            name,
            f"""SELECT post_base_id, min(l1) AS l1, CASE WHEN count(*) = 1 THEN min(l2) ELSE 'Unknown' END AS l2, count(*) > 1 AS tied
                FROM (SELECT * FROM {name}_score QUALIFY rank() OVER (PARTITION BY post_base_id ORDER BY score DESC) = 1) GROUP BY ALL""",
        ),
    ]


def cascade_sql(hidden: bool = False) -> list:
    link = "[]::BIGINT[]" if hidden else "list_product_base_id"
    tokens = f"list_filter(string_split({FOLD_SQL.format(x='description')}, ' '), lambda w: w <> '' AND w NOT IN {STOP_SQL})"
    return [
        "tposts",
        "products",
        "categories",
        ("latest", latest_sql("tposts", "post_base_id")),
        (
            "vids",
            f"""SELECT post_base_id, channel_base_id, {link} AS links, list_product_base_id,
                list_distinct(list_filter(list_transform(hashtags, lambda h: {HASH_TERM}), lambda h: h <> '' AND h NOT IN {STOP_SQL})) AS tag_terms,
                {tokens} AS t FROM latest""",
        ),
        (
            "pairs",
            """SELECT p.product_base_id, c.category_name AS l1, p.category_l2 AS l2, p.product_name FROM products p
               JOIN categories c ON p.categories__id_1::VARCHAR = c.category_id""",
        ),
        (
            "tdict",
            f"SELECT product_name AS term, l1, l2, count(*) AS weight FROM pairs WHERE split_part(product_name, ' ', 1) IN {TAG_HEADS} GROUP BY ALL",
        ),
        (
            "kdict",
            f"""SELECT split_part(product_name, ' ', 2) AS term, l1, l2, count(*) AS weight FROM pairs
                WHERE split_part(product_name, ' ', 2) IN {KEY_TAILS} GROUP BY ALL""",
        ),
        (
            "t0",
            """SELECT post_base_id, l1, l2 FROM (SELECT post_base_id, l1, l2, count(*) AS n FROM
               (SELECT post_base_id, unnest(links) AS product_base_id FROM vids) JOIN pairs USING (product_base_id) GROUP BY ALL)
               QUALIFY row_number() OVER (PARTITION BY post_base_id ORDER BY n DESC, l1, l2) = 1""",
        ),
        *_vote("t1", "tag_terms", "tdict"),
        *_vote("t2", "list_distinct(t || list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))", "kdict"),
        (
            "step",
            """SELECT v.post_base_id, v.channel_base_id, v.list_product_base_id, coalesce(t0.l1, t1.l1, t2.l1) AS l1,
               CASE WHEN t0.l1 IS NOT NULL THEN t0.l2 WHEN t1.l1 IS NOT NULL THEN t1.l2 ELSE t2.l2 END AS l2,
               CASE WHEN t0.l1 IS NOT NULL THEN 'product_link' WHEN t1.l1 IS NOT NULL THEN 'hashtag' WHEN t2.l1 IS NOT NULL THEN 'keyword' END AS source,
               CASE WHEN t0.l1 IS NOT NULL THEN 1.0 WHEN t1.l1 IS NOT NULL THEN CASE WHEN t1.tied THEN 0.7 ELSE 0.8 END
                    WHEN t2.l1 IS NOT NULL THEN CASE WHEN t2.tied THEN 0.55 ELSE 0.65 END END::DOUBLE AS confidence
               FROM vids v LEFT JOIN t0 USING (post_base_id) LEFT JOIN t1 USING (post_base_id) LEFT JOIN t2 USING (post_base_id)""",
        ),
        (
            "prior",
            """SELECT channel_base_id, l1 AS prior_l1, n::DOUBLE / total AS prior_share FROM
               (SELECT *, sum(n) OVER (PARTITION BY channel_base_id) AS total FROM
                 (SELECT channel_base_id, l1, count(*) AS n FROM step WHERE l1 IS NOT NULL GROUP BY ALL))
               QUALIFY row_number() OVER (PARTITION BY channel_base_id ORDER BY n DESC, l1) = 1 AND total >= 4 AND prior_share >= 0.4""",
        ),
        (
            "final",
            """SELECT post_base_id, s.channel_base_id, list_product_base_id, coalesce(l1, prior_l1, 'Unknown') AS category_l1, coalesce(l2, 'Unknown') AS category_l2,
               CASE WHEN source IS NOT NULL THEN source WHEN prior_l1 IS NOT NULL THEN 'creator_prior' ELSE 'unknown' END AS category_source,
               CASE WHEN source IS NOT NULL THEN confidence WHEN prior_l1 IS NOT NULL THEN 0.5 ELSE 0.0 END::DOUBLE AS category_confidence
               FROM step s LEFT JOIN prior USING (channel_base_id)""",
        ),
    ]


CAT_COLS = ["post_base_id", "category_l1", "category_l2", "category_source", "category_confidence"]


@query(
    "tag14_cascade",
    ctes(*cascade_sql())
    + f"SELECT {', '.join(CAT_COLS)}, 'v2' AS tag_dict_version, TIMESTAMP '2026-06-01' AS tagged_at FROM final",
)
def tag14_cascade(spark, sf):
    return cascaded(spark, sf).select(*CAT_COLS, "tag_dict_version", "tagged_at")


@query("tag15_vote", ctes(*cascade_sql()) + "SELECT post_base_id, l1 AS category_l1, l2 AS category_l2, tied FROM t2")
def tag15_vote(spark, sf):
    _, by_word = dictionaries(spark, sf)
    return cas.dictionary_vote(cas.with_text_terms(videos(spark, sf), "terms", longest=2), "post_base_id", "terms", by_word)


@query("tag16_prior", ctes(*cascade_sql()) + f"SELECT channel_base_id, prior_l1, {r('prior_share')} AS prior_share FROM prior")
def tag16_prior(spark, sf):
    tagged = cascaded(spark, sf).withColumn(
        "category_l1", F.when(~F.col("category_source").isin("creator_prior", "unknown"), F.col("category_l1"))
    )
    return cas.creator_prior(tagged, 4, 0.4).withColumn("prior_share", F.bround("prior_share", 6))


CONCERN_TERMS = {"hardware": ["bolt", "red rod"], "round": ["ring"], "hot": ["hot"]}
CONCERN_SCOPE = {"ASIA": ["hardware", "round"], "EUROPE": ["hot", "hardware"]}


def _with_concerns(df):
    return cas.tag_concerns(df, cas.concern_text(df), CONCERN_TERMS, CONCERN_SCOPE)


def _concern(names) -> str:
    tags = f"coalesce(' . ' || array_to_string(list_transform(hashtags, lambda h: {HASH_TERM}), ' . '), '')"
    padded = "(' ' || " + FOLD_SQL.format(x="description") + f" || {tags} || ' ')"
    return _list([(n, " OR ".join(f"contains({padded}, ' {t} ')" for t in CONCERN_TERMS[n])) for n in names])


CONCERN_LIST = f"""CASE category_l1 WHEN 'ASIA' THEN {_concern(CONCERN_SCOPE['ASIA'])}
  WHEN 'EUROPE' THEN {_concern(CONCERN_SCOPE['EUROPE'])} ELSE []::VARCHAR[] END"""
SERVED = ("served", f"SELECT f.*, {CONCERN_LIST} AS concerns FROM final f JOIN latest USING (post_base_id)")


@query("tag17_concerns", ctes(*cascade_sql(), SERVED) + "SELECT post_base_id, array_to_string(concerns, ';') AS concerns FROM served")
def tag17_concerns(spark, sf):
    return _with_concerns(cascaded(spark, sf)).select("post_base_id", F.array_join("concerns", ";").alias("concerns"))


@query(
    "fil11_segment",
    ctes(*cascade_sql(), SERVED)
    + """SELECT post_base_id, category_l2, category_confidence FROM served
      WHERE category_l1 = 'ASIA' AND list_contains(concerns, 'hardware') AND category_confidence >= 0.65""",
)
def fil11_segment(spark, sf):
    return cas.segment(_with_concerns(cascaded(spark, sf)), "ASIA", "hardware", 0.65).select(
        "post_base_id", "category_l2", "category_confidence"
    )


@query(
    "tag18_quality",
    ctes(
        *cascade_sql(hidden=True),
        (
            "truth",
            """SELECT post_base_id, l1 AS truth FROM (SELECT post_base_id, l1, l2, count(*) AS n FROM
               (SELECT post_base_id, unnest(list_product_base_id) AS product_base_id FROM vids) JOIN pairs USING (product_base_id) GROUP BY ALL)
               QUALIFY row_number() OVER (PARTITION BY post_base_id ORDER BY n DESC, l1, l2) = 1""",
        ),
        (
            "s",
            """SELECT count(*) AS videos, count(truth) AS checked, count(*) FILTER (category_l1 <> 'Unknown') AS covered,
               count(*) FILTER (category_l1 = truth) AS hit FROM final LEFT JOIN truth USING (post_base_id)""",
        ),
    )
    + f"""SELECT videos, checked, {r(div('covered', 'videos'))} AS coverage, {r(div('hit', 'checked'))} AS accuracy,
      {div('covered', 'videos')} >= 0.8 AND {div('hit', 'checked')} >= 0.85 AS accepted FROM s""",
)
def tag18_quality(spark, sf):
    df = videos(spark, sf)
    truth = cas.product_link_category(df, products(spark, sf), categories(spark, sf))
    hidden = df.withColumn("list_product_base_id", F.array().cast("array<bigint>"))
    out = cas.tag_quality(cascaded(spark, sf, hidden), truth)
    return out.withColumns({"coverage": F.bround("coverage", 6), "accuracy": F.bround("accuracy", 6)})


OLD_TAGS = """CASE WHEN post_base_id % 3 = 0 THEN 'v1' ELSE 'v2' END"""


@query(
    "tag19_retag",
    ctes(
        *cascade_sql(),
        ("olds", "SELECT *, CASE WHEN post_base_id % 3 = 0 THEN 'v1' ELSE 'v2' END AS ver, CASE WHEN post_base_id % 5 = 0 THEN 'hashtag' ELSE 'product_link' END AS src FROM vids"),
        ("redo", "SELECT post_base_id, ver <> 'v2' OR (len(list_product_base_id) > 0 AND src <> 'product_link') AS old, src FROM olds"),
    )
    + """SELECT r.post_base_id, CASE WHEN old THEN coalesce(t0.l1, 'Unknown') ELSE 'kept' END AS category_l1,
      CASE WHEN old THEN CASE WHEN t0.l1 IS NULL THEN 'unknown' ELSE 'product_link' END ELSE src END AS category_source,
      'v2' AS tag_dict_version FROM redo r LEFT JOIN t0 USING (post_base_id)""",
)
def tag19_retag(spark, sf):
    key = F.col("post_base_id")
    old = videos(spark, sf).select(
        "post_base_id",
        "list_product_base_id",
        F.lit("kept").alias("category_l1"),
        F.when(key % 5 == 0, "hashtag").otherwise("product_link").alias("category_source"),
        F.when(key % 3 == 0, "v1").otherwise("v2").alias("tag_dict_version"),
    )

    def by_link(rows):
        found = cas.product_link_category(rows, products(spark, sf), categories(spark, sf)).select(
            "post_base_id", F.col("category_l1").alias("l1")
        )
        return rows.join(found, "post_base_id", "left").select(
            "post_base_id",
            "list_product_base_id",
            F.coalesce("l1", F.lit("Unknown")).alias("category_l1"),
            F.when(F.col("l1").isNull(), "unknown").otherwise("product_link").alias("category_source"),
            F.lit("v2").alias("tag_dict_version"),
        )

    return cas.retag_outdated(old, "v2", by_link).drop("list_product_base_id")


@query(
    "tag20_split",
    """SELECT p_partkey AS sku_id, CASE WHEN p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1996-01-01')
       THEN 'existing' ELSE 'new' END AS part_of FROM part""",
)
def tag20_split(spark, sf):
    new = table(spark, sf, "part").select(F.col("p_partkey").alias("sku_id"))
    master = (
        table(spark, sf, "lineitem")
        .filter(F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp_ntz"))
        .select(F.col("l_partkey").alias("sku_id"))
    )
    old, fresh = tag.split_existing(master, new)
    return old.withColumn("part_of", F.lit("existing")).unionByName(fresh.withColumn("part_of", F.lit("new")))

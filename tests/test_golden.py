"""Worked examples with known results."""

import pytest
from pyspark.sql import functions as F

from bazaarlens.functions import columns as c
from bazaarlens.functions import rule_tables as rt
from bazaarlens.functions import text as t
from bazaarlens.operators import cascade, classify, creators, dedup, live, market, purity, quality, residual, search, tagging


def one(df, column):
    return [r[column] for r in df.collect()]


def test_merge_master(spark):
    old = spark.createDataFrame([("SKU001_old", "Shower gel", 850000), ("SKU002_old", "Facewash", 600000), ("SKU003_old", "Deodorant", 450000)], "sku_id string, partner_category string, revenue long")
    new = spark.createDataFrame([("SKU001_new", "Shower gel", 890000), ("SKU004", "Shampoo", 990000)], old.schema)
    merged = dedup.merge_master(old, new)
    assert {r["sku_id"]: r["revenue"] for r in merged.collect()} == {"SKU001": 890000, "SKU002": 600000, "SKU003": 450000, "SKU004": 990000}
    again = dedup.merge_master(merged, new)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, merged.collect()))


def test_suffix_once(spark):
    df = spark.createDataFrame([("a_old_new",), ("b_new",), ("c",)], "x string").select(t.strip_suffix("x").alias("x"))
    assert one(df, "x") == ["a_old", "b", "c"]


def test_drift_and_combos(spark):
    before = spark.createDataFrame([("Shower gel", 1000000), ("Shampoo", 800000), ("Deodorant", 300000), ("Gone", 5)], "partner_category string, revenue long")
    after = spark.createDataFrame([("Shower gel", 1020000), ("Shampoo", 950000), ("Deodorant", 295000), ("Fresh", 7)], before.schema)
    got = {r["partner_category"]: (r["diff_pct"], r["flagged"]) for r in quality.revenue_drift(before, after).collect()}
    assert got == {"Shower gel": (2.0, False), "Shampoo": (18.75, True), "Deodorant": (-1.67, False), "Gone": (-100.0, True), "Fresh": (None, False)}
    combos = spark.createDataFrame([("C1", 0.6), ("C1", 0.4), ("C2", 0.7), ("C2", 0.5), ("C3", 1.0)], "combo_id string, coefficient_in_combo double")
    assert {r["combo_id"]: r["ok"] for r in quality.validate_combos(combos).collect()} == {"C1": True, "C2": False, "C3": False}


def test_text(spark):
    df = spark.createDataFrame([("  dầu   GỘI nam ",)], "x string")
    assert one(df.select(t.sentence_case("x").alias("y")), "y") == ["Dầu gội nam"]
    assert one(spark.createDataFrame([("Dưỡng Ẩm!",)], "x string").select(t.fold("x").alias("y")), "y") == ["duong am"]
    row = spark.createDataFrame([("đẹp",)], "x string").select(t.fold("x").alias("a"), t.fold("x", fold_d=True).alias("b")).first()
    assert (row.a, row.b) == ("ep", "dep")
    assert one(spark.createDataFrame([("#triMun_daDau",)], "x string").select(t.fold_hashtag("x").alias("y")), "y") == ["tri mun da dau"]
    bad = "dưỡng ẩm".encode().decode("latin-1")
    fixed = spark.createDataFrame([(bad,), ("dưỡng ẩm",), ("plain",), ("café",)], "x string").select(t.repair_mojibake("x").alias("y"))
    assert one(fixed, "y") == ["dưỡng ẩm", "dưỡng ẩm", "plain", "café"]
    offsets = spark.createDataFrame([("😀 xin review",), ("none",)], "x string").select(t.first_offset("x", "review").alias("y"))
    assert one(offsets, "y") == [6, None]
    assert one(spark.createDataFrame([("ﬁne",)], "x string").select(t.nfkc("x").alias("y")), "y") == ["fine"]


def test_rounding_and_times(spark):
    row = spark.range(1).select(
        c.half_even(F.lit(2.5)).alias("a"), c.half_even(F.lit(3.5)).alias("b"), c.local_time(F.lit(1766198025224)).alias("t"), c.clock(F.lit(9000933)).alias("d")
    ).first()
    assert (row.a, row.b, row.t, row.d) == (2.0, 4.0, "2025-12-20 09:33:45", "02:30:00")


def test_bands(spark):
    df = spark.createDataFrame([("999",), ("1000",), ("9999",), ("10000",), ("1000000",), (None,), ("many",)], "f string")
    assert one(tagging.tag_band(df, "f", rt.FOLLOWER_BANDS, "tier"), "tier") == ["Nano", "Micro", "Micro", "Rising", "Mega", "Unknown", "Unknown"]


def clips(spark, *rows):
    return spark.createDataFrame(list(rows), "hashtags string, description string")


def test_video_rules(spark):
    df = clips(spark, ("unboxing", "review"), (None, "skincare"), ("trimun spf", "#ad with Vichy"), ("xmun", None))
    brands = tagging.compile_brand_rules()
    assert [b.key for b in brands] == ["cetaphil", "eucerin", "svr", "torriden", "vichy"]
    got = tagging.tag_videos(df, brands, rt.SKIN_CONCERNS, rt.SKINCARE_FALLBACK, rt.PRODUCT_TYPES, rt.PARTNERSHIP, rt.CONTENT_TYPES).collect()
    assert got[0].content_type == "Unboxing" and got[0].brand_scope == "No Brand" and got[0].skin_concern == ""
    assert got[1].skin_concern == "Skincare"
    assert (got[2].skin_concern, got[2].product_type, got[2].partnership_flag) == ("Sun Protection; Acne", "Sunscreen", "True")
    assert (got[2].brand_detail, got[2].content_type) == ("Vichy", "Sponsored/Partnership")
    assert got[3].skin_concern == "Acne"


def test_earliest_ties_and_unicode_word_edges(spark):
    rules = [rt.Rule("B", "both", "ab", 2), rt.Rule("A", "both", "abc", 1), rt.Rule("D", "both", "x", 3)]
    got = tagging.tag_earliest(clips(spark, ("zz abc", "x"), ("", "x")), rules, "l")
    assert one(got, "l") == ["A", "D"]
    edge = tagging.tag_flag(clips(spark, (None, "đad"), (None, "an ad!")), rt.PARTNERSHIP, "p")
    assert one(edge, "p") == ["", "True"]


def test_creators(spark):
    videos = spark.createDataFrame(
        [(1, "c1", None, "#obagi #koc", "cerave", 1), (2, "c1", "Lan", "#obagi", None, 2), (3, "c2", "Dr. An", None, None, 3)],
        "video_id int, channel_id string, channel_name string, hashtags string, description string, platform_created_at int",
    )
    channels = spark.createDataFrame([("c2", "Dr An", "on instagram", "1500", 9)], "channel_id string, channel_name string, description string, followers string, video_count int")
    got = {r.channel_id: r for r in tagging.tag_creators(videos, channels, ["platform_created_at"], rt.CREATOR_TYPES, rt.FOLLOWER_BANDS, rt.CREATOR_BRANDS, rt.PLATFORM_RULES, "2026-05-26").collect()}
    assert (got["c1"].key_type, got["c1"].tier, got["c1"].brand_detail, got["c1"].brand_loyalty, got["c1"].channel_name) == ("Beauty KOC", "Unknown", "Obagi|CeraVe", "Multi-Brand", "Lan")
    assert (got["c2"].key_type, got["c2"].tier, got["c2"].brand_loyalty, got["c2"].platform_addons, got["c2"].channel_total_video) == ("Doctor", "Micro", "No-Brand", "multi-platform", 9)


def test_products(spark):
    names = ["sua tam tang kem dau goi", "combo dau goi va dau xa", "Dau goi NAM", "nuoc hoa unisex", "nuoc hoa", "thing"]
    df = tagging.classify_product(spark.createDataFrame([(n,) for n in names], "product_name string"))
    assert [(r.partner_category, r.partner_function) for r in df.collect()] == [
        ("Others", "Others"), ("Combo (Shampoo and hair conditioner)", "Unisex"), ("Shampoo", "Male"), ("Perfume", "Unisex"), ("Perfume", "Female"), ("Others", "Others"),
    ]
    assert one(tagging.audit_others(df), "would_be") == ["Shampoo"]


def test_purity(spark):
    df = spark.createDataFrame([("Beauty", "serum", 45000), ("Food", "serum", 3000), ("Beauty", "fyp", 10), ("Food", "fyp", 90)], "category string, hashtag string, count_unique_video long")
    got = {(r.category, r.hashtag): r for r in purity.purity_verdict(df, 1000).collect()}
    assert got["Beauty", "serum"].purity == 0.9375 and got["Beauty", "serum"].action == "KEEP" and got["Food", "serum"].action == "DROP"
    assert got["Beauty", "serum"].disc_score == 45000 * 0.9375**2
    d = purity.category_dictionary(df, targets=None).collect()
    assert [(r.cate, r.list_hashtag) for r in sorted(d)] == [("Beauty", "serum"), ("Food", "fyp")]
    scoped = purity.category_dictionary(df, targets=["Beauty"]).first()
    assert scoped.list_hashtag == "serum"
    assert purity.category_dictionary(df, targets=["Beauty"], min_count=1).first().hashtag_count == 2
    assert purity.category_dictionary(df, targets=["Beauty"], min_count=1, scope_before_filter=True).first().hashtag_count == 1


def test_cascade(spark):
    posts = spark.createDataFrame(
        [(1, "c", ["x"], "nothing", ["p"]), (2, "c", ["#triMun", "fyp"], "", []), (3, "c", [], "hay tri mun", []), (4, "c", [], "a b", []), (5, "d", ["both"], "", []), (6, "d", None, None, None)],
        "post_base_id int, channel_base_id string, hashtags array<string>, description string, list_product_base_id array<string>",
    )
    products = spark.createDataFrame([("p", 1, "Face")], "product_base_id string, categories__id_1 long, category_l2 string")
    cats = spark.createDataFrame([("1", "Beauty")], "category_id string, category_name string")
    entries = spark.createDataFrame([("tri mun", "Beauty", "Skincare", 1.0), ("both", "Beauty", "A", 0.5), ("both", "Food", "B", 0.5)], "term string, category_l1 string, category_l2 string, weight double")
    got = {r.post_base_id: r for r in cascade.tag_category_cascade(posts, products, cats, entries, entries, "v1", "2026-06-01", min_videos=3).collect()}
    rows = {k: (r.category_l1, r.category_l2, r.category_source, r.category_confidence) for k, r in got.items()}
    assert rows == {
        1: ("Beauty", "Face", "product_link", 1.0), 2: ("Beauty", "Skincare", "hashtag", 0.8), 3: ("Beauty", "Skincare", "keyword", 0.65),
        4: ("Beauty", "Unknown", "creator_prior", 0.5), 5: ("Beauty", "Unknown", "hashtag", 0.7), 6: ("Unknown", "Unknown", "unknown", 0.0),
    }


def test_concerns(spark):
    df = spark.createDataFrame([("Beauty", "bi mun nhieu"), ("Beauty", "trimunx"), ("Food", "mun")], "category_l1 string, x string")
    out = cascade.tag_concerns(df, t.fold("x"), {"acne": ["mun"]}, {"Beauty": ["acne"]})
    assert one(out, "concerns") == [["acne"], [], []]


def test_percentile_single_member(spark):
    from bazaarlens.operators.ranking import percentile_of, rank_within

    df = spark.createDataFrame([(1, "a", 5.0), (2, "b", 1.0), (3, "b", 2.0), (4, "b", 2.0), (5, "b", 4.0)], "id int, g string, v double")
    got = rank_within(df, ["id"], ["g"], {"rk": "v"}, "n").select("id", percentile_of("rk", "n").alias("p")).orderBy("id")
    assert one(got, "p") == [None, 0, 33, 33, 100]


def test_search_share(spark):
    rows = [("Dầu gội nam", b, f"{b}{i}") for b, n in (("A", 7), ("B", 5), ("C", 4), ("D", 3), ("", 11)) for i in range(n)]
    df = spark.createDataFrame(rows, "key_word string, brand string, product_base_id string")
    got = {r.brand: round(r.share * 100, 1) for r in search.search_share(df.filter("brand <> ''").unionByName(spark.createDataFrame([("Dầu gội nam", f"x{i}", f"x{i}") for i in range(11)], df.schema))).collect()}
    assert got == {"A": 23.3, "B": 16.7, "C": 13.3, "Others": 46.7}


def test_monitor(spark):
    df = spark.createDataFrame(
        [("05/2026", "A", 40.0), ("04/2026", "A", 200.0), ("05/2026", "New", 10.0), ("05/2026", "", 20.0), ("04/2026", "", 10.0), ("04/2026", "B", 100.0), ("05/2026", "B", 65.0), ("01/2026", "Old", 1.0)],
        "time string, brand string, sales double",
    )
    issues = {(r.check, r.status, r.item) for r in market.monitor_summary(df, "05/2026", "04/2026", min_revenue=50).collect()}
    assert issues == {("undefined", "WARNING", "Undefined"), ("debut", "NEW", "New"), ("drift", "ALERT", "A"), ("drift", "WARNING", "B")}
    assert market.go_no_go(market.monitor_summary(df, "05/2026", "04/2026", min_revenue=50)).first().go is False


def test_unknown_brand_finds_nothing(spark):
    from bazaarlens.operators.videos import videos_by_brand

    posts = spark.createDataFrame([(1, "2026-06-11 10:00:00", ["p"])], "post_id_platform int, u string, list_product_base_id array<string>").select(
        "post_id_platform", F.col("u").cast("timestamp_ntz").alias("updated_at"), F.col("u").cast("timestamp_ntz").alias("last_time_crawled_at"), F.lit(1).alias("view_count"), "list_product_base_id"
    )
    products = spark.createDataFrame([("p", "")], "product_base_id string, brand string")
    assert videos_by_brand(posts, products, "Unknown", "2026-06-11").count() == 0
    assert videos_by_brand(posts, products, "", "2026-06-11").first().brand == "Unknown"


def test_second_stage_keeps_duplicates(spark):
    df = spark.createDataFrame([("1", "x"), ("1", "x"), ("2", "y")], "product_base_id string, product_name string")
    res = spark.createDataFrame([("1", "hint", "nam", ""), ("2", "other", "m", "B")], "product_base_id string, r_category string, r_gender string, r_brand string")
    got = [(r.product_base_id, r.category, r.gender, r.brand_tagged) for r in residual.apply_results(df, res, "hint").orderBy("product_base_id").collect()]
    assert got == [("1", "hint", "nam", "No Brand"), ("1", "hint", "nam", "No Brand"), ("2", "", None, "B")]


def test_labels(spark):
    df = spark.createDataFrame([(1, "A", "X"), (2, "a", "x"), (3, None, "x"), (4, "b", "nan"), (5, "c", "ｘ"), (6, "d", "y")], "id int, text string, label string")
    clean = classify.clean_labelled(df)
    assert sorted((r.id, r.label) for r in clean.collect()) == [(1, "x"), (2, "x"), (5, "x"), (6, "y")]
    kept = classify.balance_labels(clean, ["id"], min_count=2, max_count=2)
    assert sorted(one(kept, "id")) == [1, 5]


def test_live_quadrants(spark):
    rows = [(1, 100, 1000.0), (2, 10, 900.0), (3, 90, 50.0), (4, 12, 5.0), (5, 1, 9999.0)]
    df = spark.createDataFrame(rows, "id int, clicks int, gmv double")
    got = {r.id: r.segment for r in live.product_matrix(live.gmv_efficiency(df, 10, 1.0)).collect()}
    assert got == {1: "Winning/Hero Products", 2: "Hidden Gems", 3: "High Traffic Products", 4: "Non-Efficiency", 5: "Not rated"}


def test_attributed_views_add_up(spark):
    posts = spark.createDataFrame([("c", 30, ["a", "b", "zz"]), ("c", 9, ["a"]), ("c", 5, [])], "channel_id string, view_count int, list_product_base_id array<string>")
    products = spark.createDataFrame([("a", 1, "x"), ("b", 2, None)], "product_base_id string, categories__id_1 long, brand string")
    cats = spark.createDataFrame([("1", "One"), ("2", "Two")], "category_id string, category_name string")
    got = {r.category: r.category_total_view for r in creators.attribute_views(posts, products, cats).collect()}
    assert got == {"One": 19.0, "Two": 10.0, "Unknown": 10.0}


@pytest.mark.parametrize(
    "pattern,hits",
    [
        (["a|b"], ["xa|by"]),
        (["a|b", "c."], ["xa|by", "c. d"]),
        (["(x)"], ["the (x)"]),
        (["a\\b"], ["a\\b"]),
        (["1+1", "[y]"], ["is 1+1", "[y]"]),
    ],
)
def test_rules_match_their_terms_literally(spark, pattern, hits):
    from bazaarlens.functions.text import any_of, pattern_hit

    others = ["b", "a", "c d", "x", "11", "y", "ab", "(", "|", ""]
    df = spark.createDataFrame([(t,) for t in [*hits, *others]], "t string")
    got = {r.t for r in df.filter(pattern_hit("t", any_of(pattern))).collect()}
    assert got == set(hits)


def test_patterns_in_any_case(spark):
    from bazaarlens.functions.text import first_offset, pattern_hit

    df = spark.createDataFrame([("x UNBOXING y",), ("ĐẸP",), ("none",)], "t string")
    assert [r[0] for r in df.select(first_offset("t", "unboxing|đẹ+p", ignore_case=True)).collect()] == [2, 0, None]
    assert [r[0] for r in df.select(pattern_hit("t", "Unboxing", ignore_case=True)).collect()] == [True, False, False]


def test_a_failing_batch_is_reported(spark):
    from bazaarlens.operators import residual

    items = spark.createDataFrame([(i, f"n{i}") for i in range(90)], "product_base_id long, product_name string")

    def tag(skus):
        if any(s["product_base_id"] == 7 for s in skus):
            raise TimeoutError("no answer")
        return [{"product_base_id": s["product_base_id"], "r_category": "c", "r_gender": "nam", "r_brand": "b", "signs_reasons": "seen"} for s in skus[1:]]

    packed = residual.pack_batches(residual.residual_batches(items), ["product_base_id", "product_name"])
    out = residual.run_batches(packed, tag, "product_base_id long, r_category string, r_gender string, r_brand string, signs_reasons string").cache()
    counts = {r.status: r["count"] for r in out.groupBy("status").count().collect()}
    assert counts == {"failed": 30, "open": 2, "tagged": 58}
    assert {r.error for r in out.filter("status = 'failed'").collect()} == {"TimeoutError: no answer"}
    applied = residual.apply_results(items.withColumn("hint", F.lit("c")), out, "hint")
    assert applied.filter("tagged").count() == 58 and applied.filter("signs_reasons = 'seen'").count() == 58


def test_a_merge_with_ties_repeats(spark):
    from bazaarlens.operators.dedup import merge_master

    old = spark.createDataFrame([("A_old", "x", 1), ("A_new", "x", 2)], "sku_id string, partner_category string, revenue int")
    for rows in (old, old.orderBy("revenue"), old.orderBy("sku_id")):
        assert [r.revenue for r in merge_master(rows, old.limit(0)).collect()] == [1]


def test_item_rates_are_means_of_documents(spark):
    from bazaarlens.operators.live import PRODUCT_SCHEMA, stage_product

    docs = [
        '{"itemId": "a", "shopId": 1, "viewers": 100, "clicks": 10, "clickRate": 0.1, "conversionRate": 0.2, "placedSales": 918400.5}',
        '{"itemId": "a", "shopId": 1, "viewers": 300, "clicks": 90, "clickRate": 0.3, "conversionRate": 1.0, "placedSales": 1.0}',
        '{"itemId": "a", "shopId": 1, "viewers": 300, "clicks": 90, "clickRate": 0.3, "conversionRate": 1.0, "placedSales": 1.0}',
        '{"itemId": "b", "shopId": 1, "viewers": 0, "clicks": 0, "clickRate": 0.4}',
    ]
    frame = spark.createDataFrame([(d,) for d in docs], "doc string").select(F.from_json("doc", PRODUCT_SCHEMA).alias("data"))
    got = {r.item_id: r for r in stage_product(frame).collect()}
    assert (got["a"].viewers, got["a"].documents, got["a"].placed_sales) == (400, 2, 918401.5)
    assert abs(got["a"].click_rate - 0.25) < 1e-12 and abs(got["a"].conversion_rate - 0.92) < 1e-12
    assert got["b"].click_rate == 0.4


def test_basket_sizes_may_have_decimals(spark):
    from bazaarlens.operators.live import DETAIL_SCHEMA, stage_key_metrics

    doc = '{"code": 0, "data": {"liveInfo": {"sessionId": 5}, "keyMetrics": {"placedABS": 918400.0, "confirmedABS": 7.5, "atc": 3}}}'
    row = stage_key_metrics(spark.createDataFrame([(doc,)], "doc string").select(F.from_json("doc", DETAIL_SCHEMA).alias("data"))).first()
    assert (row.session_id, row.placed_abs, row.confirmed_abs, row.atc) == (5, 918400.0, 7.5, 3)


def test_search_keywords_count_for_categories_and_concerns(spark, tmp_path):
    import json

    from bazaarlens.sources import readers

    (tmp_path / "concern_dict.json").write_text(json.dumps({"version": "v7", "scope": {"Beauty": ["acne"]}, "concerns": {"acne": {"terms": ["tri mun", "mun"]}}}))
    (tmp_path / "stoplist.json").write_text(json.dumps({"version": "v7", "terms": ["viral"]}))
    version, terms, scope = readers.load_concerns(spark, str(tmp_path / "concern_dict.json"))
    stop_version, stop = readers.load_stop_list(spark, str(tmp_path / "stoplist.json"))
    assert (version, stop_version, stop, scope) == ("v7", "v7", ["viral"], {"Beauty": ["acne"]})
    posts = spark.createDataFrame(
        [
            (1, 9, [], None, ["Trị Mụn", None], []),
            (2, 9, ["#Mun"], "serum", None, []),
            (3, 8, ["viral"], "viral", ["tri", "mun hot"], []),
            (4, 8, None, None, None, []),
        ],
        "post_base_id long, channel_base_id long, hashtags array<string>, description string, search_keywords array<string>, list_product_base_id array<long>",
    )
    products = spark.createDataFrame([], "product_base_id long, categories__id_1 long, category_l2 string")
    categories = spark.createDataFrame([], "category_id string, category_name string")
    entry = "term string, category_l1 string, category_l2 string, weight double"
    keyword = spark.createDataFrame([("tri mun", "Beauty", "Skin", 1.0), ("serum", "Beauty", "Care", 0.9), ("viral", "Spam", "S", 5.0)], entry)
    got = cascade.tag_category_cascade(posts, products, categories, spark.createDataFrame([("viral", "Spam", "S", 5.0)], entry), keyword, version, "2026-06-01", stop=stop)
    got = cascade.tag_concerns(got, cascade.concern_text(got), terms, scope)
    rows = {r.post_base_id: (r.category_l1, r.category_l2, r.category_source, r.concerns) for r in got.collect()}
    assert rows == {
        1: ("Beauty", "Skin", "keyword", ["acne"]),
        2: ("Beauty", "Care", "keyword", ["acne"]),
        3: ("Unknown", "Unknown", "unknown", []),
        4: ("Unknown", "Unknown", "unknown", []),
    }

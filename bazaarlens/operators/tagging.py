"""Rule tagging. Rules are small tables on the driver; each becomes one Column, so all
labels of a video come from one narrow projection without a shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions.columns import band, cascade, to_number
from bazaarlens.functions.rule_tables import (
    AUDIENCES,
    BRAND_EXTRA,
    BRAND_HASHTAGS,
    GIFT_WORDS,
    PLATFORM_DEFAULT,
    PRODUCT_CATEGORIES,
    VIDEO_BRANDS,
    Brand,
    Rule,
)
from bazaarlens.functions.text import any_of, contains_any, first_offset, pattern_hit
from bazaarlens.operators.dedup import first_by

SEP = "; "


def _low(name: str) -> Column:
    return F.lower(F.coalesce(F.col(name), F.lit("")))


def search_text(source: str = "both") -> Column:
    """Lower-cased hashtags, description, or both with a space between."""
    if source in ("hashtags", "description"):
        return _low(source)
    return F.concat(_low("hashtags"), F.lit(" "), _low("description"))


# Columns that hold the search texts while rules run: folded once, read by every rule.
_TEXTS = {"hashtags": "_t_hashtags", "description": "_t_description", "both": "_t_both"}


def _with_texts(df: DataFrame) -> DataFrame:
    return df if "_t_both" in df.columns else df.withColumns({name: search_text(s) for s, name in _TEXTS.items()})


def _without_texts(df: DataFrame, before: DataFrame) -> DataFrame:
    return df.drop(*[c for c in _TEXTS.values() if c not in before.columns])


def _text(source: str) -> Column:
    return F.col(_TEXTS.get(source, "_t_both"))


def _labels(pairs: Sequence[tuple[str, Column]]) -> Column:
    """Array of the labels whose condition holds, in rule order."""
    if not pairs:
        return F.array().cast("array<string>")
    return F.filter(F.array(*[F.when(hit, F.lit(label)) for label, hit in pairs]), lambda x: x.isNotNull())


def brand_hits(brands: Sequence[Brand]) -> Column:
    return _labels([(b.display, pattern_hit(_text("both"), b.pattern)) for b in brands])


def tag_brands(df: DataFrame, brands: Sequence[Brand]) -> DataFrame:
    """brand_scope and brand_detail in rule order."""
    hits = _with_texts(df).withColumn("_hits", brand_hits(brands))
    n = F.size("_hits")
    out = (
        hits.withColumn("brand_scope", cascade([(n == 0, "No Brand"), (n == 1, "Single-brand")], "Multi-brand"))
        .withColumn("brand_detail", F.when(n == 0, "No Brand").otherwise(F.array_join("_hits", SEP)))
        .drop("_hits")
    )
    return _without_texts(out, df)


def multi_label(rules: Sequence[Rule]) -> Column:
    return F.array_join(_labels([(r.label, pattern_hit(_text(r.source), r.pattern)) for r in rules]), SEP)


def tag_multi(df: DataFrame, rules: Sequence[Rule], out: str) -> DataFrame:
    """All matching labels, joined; '' without a match."""
    return _without_texts(_with_texts(df).withColumn(out, multi_label(rules)), df)


def tag_fallback(df: DataFrame, out: str, rule: Rule) -> DataFrame:
    """A general label for rows that got no specific one."""
    generic = pattern_hit(_text(rule.source), rule.pattern)
    empty = F.coalesce(F.col(out), F.lit("")) == ""
    tagged = _with_texts(df).withColumn(out, F.when(empty & generic, F.lit(rule.label)).otherwise(F.col(out)))
    return _without_texts(tagged, df)


def tag_flag(df: DataFrame, rules: Sequence[Rule], out: str, default: str = "") -> DataFrame:
    """The last matching rule wins."""
    steps = [(pattern_hit(_text(r.source), r.pattern), r.label) for r in reversed(list(rules))]
    return _without_texts(_with_texts(df).withColumn(out, cascade(steps, default)), df)


def tag_earliest(df: DataFrame, rules: Sequence[Rule], out: str) -> DataFrame:
    """Label whose keyword comes first, in any case; hashtags stand before the description."""
    tags, desc = _text("hashtags"), _text("description")
    found = []
    for seq, rule in enumerate(rules):
        places = []
        if rule.source in ("hashtags", "both"):
            places.append(first_offset(tags, rule.pattern, ignore_case=True))
        if rule.source in ("description", "both"):
            base = F.length(tags) + 1 if rule.source == "both" else F.lit(0)
            places.append(base + first_offset(desc, rule.pattern, ignore_case=True))
        if places:
            at = places[0] if len(places) == 1 else F.least(*places)
            found.append(
                F.struct(at.alias("pos"), F.lit(rule.priority).alias("pri"), F.lit(seq).alias("seq"), F.lit(rule.label).alias("label"))
            )
    best = F.array_min(F.filter(F.array(*found), lambda x: x["pos"].isNotNull()))
    return _without_texts(_with_texts(df).withColumn(out, F.coalesce(best["label"], F.lit(""))), df)


def tag_videos(
    df: DataFrame,
    brands: Sequence[Brand],
    concerns: Sequence[Rule],
    fallback: Rule | None,
    types: Sequence[Rule],
    partnership: Sequence[Rule],
    content: Sequence[Rule],
) -> DataFrame:
    """All video tags in the fixed column order."""
    plain, df = df, _with_texts(df)
    df = tag_multi(tag_brands(df, brands), concerns, "skin_concern")
    if fallback is not None:
        df = tag_fallback(df, "skin_concern", fallback)
    df = tag_multi(df, types, "product_type")
    df = tag_earliest(tag_flag(df, partnership, "partnership_flag"), content, "content_type")
    return _without_texts(df, plain)


def tag_by_category(df: DataFrame, rules: Mapping[str, Sequence[Rule]], category: str, out: str) -> DataFrame:
    """Multi-label rules that belong to a category; other categories get ''."""
    steps = [(F.col(category) == name, multi_label(rs)) for name, rs in rules.items()]
    return _without_texts(_with_texts(df).withColumn(out, cascade(steps, "")), df)


def tag_band(df: DataFrame, value: str, bands: Sequence[tuple[str, float, float | None]], out: str) -> DataFrame:
    return df.withColumn(out, band(to_number(F.col(value).cast("string")), bands))


# ---------------------------------------------------------------------------------------
# creators


def creator_base(
    videos: DataFrame, channels: DataFrame, order: Sequence[str], rules: Sequence[Rule] = ()
) -> DataFrame:
    """One row per channel that has videos, with the profile where there is one.

    ``order`` names the columns that decide which video or profile comes first. Rules that
    read hashtags are tested per video and only their outcome is aggregated, so a channel's
    hashtags are never gathered into one text; a hit must lie inside one video's hashtags.
    """
    place = F.struct(*order)
    name = F.col("channel_name")
    tags = F.lower(F.coalesce("hashtags", F.lit("")))
    hits = [F.bool_or(pattern_hit(tags, r.pattern)).alias(f"_tag_hit_{i}") for i, r in enumerate(rules)]
    base = videos.groupBy("channel_id").agg(
        F.min_by(name, F.when(name.isNotNull(), place)).alias("channel_name_video"),
        F.count("video_id").alias("video_count_in_dataset"),
        F.max("platform_created_at").alias("last_video_at"),
        *hits,
    )
    # the given order decides; the other columns only make ties repeatable
    ties = dict.fromkeys([*(c for c in order if c in channels.columns), *channels.columns])
    profile = first_by(channels, ["channel_id"], [F.asc_nulls_last(c) for c in ties if c != "channel_id"])
    if "video_count" in profile.columns:
        profile = profile.withColumnRenamed("video_count", "channel_total_video")
    out = base.join(profile, "channel_id", "left")
    return out.withColumn("channel_name", F.coalesce("channel_name", "channel_name_video")).drop("channel_name_video")


def tag_priority(df: DataFrame, rules: Sequence[Rule], out: str, default: str = "Unknown") -> DataFrame:
    """Single label: the matching rule with the smallest priority.

    Reads ``channel_name``, ``description`` and, for hashtags, the ``_tag_hit_*`` columns
    of :func:`creator_base` (or a text column ``hashtags_agg``).
    """
    name, desc = _low("channel_name"), _low("description")
    profile = F.concat(name, F.lit(" "), desc)
    steps = []
    for i, rule in sorted(enumerate(rules), key=lambda x: (x[1].priority, x[0])):
        marked = f"_tag_hit_{i}"
        in_tags = F.coalesce(F.col(marked), F.lit(False)) if marked in df.columns else (
            pattern_hit(_low("hashtags_agg"), rule.pattern) if "hashtags_agg" in df.columns else F.lit(False)
        )
        where = {
            "description": pattern_hit(desc, rule.pattern),
            "channel_name": pattern_hit(name, rule.pattern),
            "hashtags_agg": in_tags,
            "profile": pattern_hit(profile, rule.pattern),
            "profile_both": pattern_hit(profile, rule.pattern) | in_tags,
        }
        steps.append((where.get(rule.source, pattern_hit(desc, rule.pattern) | in_tags), rule.label))
    return df.withColumn(out, cascade(steps, default))


def tag_platform(df: DataFrame, rules: Sequence[Rule], out: str = "platform_addons", default: str = PLATFORM_DEFAULT) -> DataFrame:
    desc = _low("description")
    return df.withColumn(out, cascade([(pattern_hit(desc, r.pattern), r.label) for r in reversed(list(rules))], default))


def brand_loyalty(creators: DataFrame, videos: DataFrame, brands: Sequence[Brand]) -> DataFrame:
    """Number of brands over a creator's videos; detail by most videos, then name."""
    counts = (
        _with_texts(videos)
        .withColumn("_hits", brand_hits(brands))
        .select("channel_id", F.explode("_hits").alias("brand"))
        .groupBy("channel_id", "brand")
        .agg(F.count("*").alias("n"))
    )
    # the list holds at most one item per brand rule
    ranked = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "brand"))), lambda x: x["brand"])
    detail = counts.groupBy("channel_id").agg(
        F.array_join(ranked, "|").alias("_detail"), F.count("*").alias("_brands")
    )
    n = F.coalesce("_brands", F.lit(0))
    return (
        creators.join(detail, "channel_id", "left")
        .withColumn("brand_loyalty", cascade([(n == 0, "No-Brand"), (n == 1, "Single Brand")], "Multi-Brand"))
        .withColumn("brand_detail", F.coalesce("_detail", F.lit("No-Brand")))
        .withColumn("brand_count", n)
        .drop("_detail", "_brands")
    )


def tag_creators(
    videos: DataFrame,
    channels: DataFrame,
    order: Sequence[str],
    types: Sequence[Rule],
    bands: Sequence[tuple[str, float, float | None]],
    brands: Sequence[Brand],
    platforms: Sequence[Rule],
    tagged_at: str,
) -> DataFrame:
    """Creator profile with all creator tags."""
    df = tag_priority(creator_base(videos, channels, order, types), types, "key_type")
    df = brand_loyalty(tag_band(df, "followers", bands, "tier"), videos, brands)
    df = tag_platform(df, platforms).withColumn("tagged_at", F.lit(tagged_at))
    return df.drop(*[c for c in df.columns if c.startswith("_tag_hit_")])


def compile_brand_rules(
    hashtags: Mapping[str, Sequence[str]] = BRAND_HASHTAGS,
    extra: Mapping[str, str] = BRAND_EXTRA,
    names: Sequence[tuple[str, str]] = VIDEO_BRANDS,
) -> list[Brand]:
    """Brand rules ordered by key: literal hashtags, then the extra pattern.

    A brand without hashtags gets no rule, even when it has an extra pattern.
    """
    shown = dict(names)
    out = []
    for key in sorted(hashtags):
        tags = list(dict.fromkeys(t.strip().lower() for t in hashtags[key] if t and t.strip()))
        if tags:
            out.append(Brand(key, shown.get(key, key), any_of(tags, extra.get(key))))
    return out


def brand_rule_table(hashtags: DataFrame, extra: DataFrame) -> DataFrame:
    """The same from rule tables: (brand_key, brand_display, hashtag) and (brand_key, keyword_pattern).

    A rule table has one row per brand hashtag, so a brand's list stays small.
    """
    tags = hashtags.select("brand_key", "brand_display", F.lower(F.trim("hashtag")).alias("hashtag"))
    tags = tags.filter(F.col("hashtag") != "").dropDuplicates(["brand_key", "hashtag"])
    literal = F.regexp_replace("hashtag", r"([^\p{L}\p{N}_])", r"\\$1")
    parts = tags.groupBy("brand_key").agg(
        F.min("brand_display").alias("brand_display"),
        F.array_join(F.array_sort(F.collect_list(literal)), "|").alias("_tags"),
        F.count("*").alias("hashtag_count"),
    )
    pattern = F.concat_ws("|", "_tags", F.nullif(F.trim("keyword_pattern"), F.lit("")))
    return parts.join(extra, "brand_key", "left").select("brand_key", "brand_display", pattern.alias("keyword_pattern"), "hashtag_count")


# ---------------------------------------------------------------------------------------
# products


def _product_text(name: str) -> Column:
    return F.lower(F.coalesce(F.col(name), F.lit("")))


def product_category(text: Column, categories: Sequence[tuple[str, Sequence[str]]]) -> Column:
    return cascade([(contains_any(text, ws), label) for label, ws in categories], "Others")


def classify_product(
    df: DataFrame,
    name: str = "product_name",
    gifts: Sequence[str] = GIFT_WORDS,
    categories: Sequence[tuple[str, Sequence[str]]] = PRODUCT_CATEGORIES,
    audiences: Sequence[tuple[str, Sequence[str]]] = AUDIENCES,
) -> DataFrame:
    """partner_category and partner_function by literal substrings, first rule wins.

    A gift word sends the listing to Others before any category is tried. Substrings are
    plain, so a short audience word also hits inside longer words.
    """
    text = _product_text(name)
    guarded = F.when(contains_any(text, gifts), F.lit("Others")).otherwise(product_category(text, categories))
    audience = cascade([(contains_any(text, ws), label) for label, ws in audiences], "Unisex")
    return df.withColumn("partner_category", guarded).withColumn(
        "partner_function", F.when(F.col("partner_category") == "Others", "Others").otherwise(audience)
    )


def audit_others(
    df: DataFrame,
    name: str = "product_name",
    label: str = "partner_category",
    categories: Sequence[tuple[str, Sequence[str]]] = PRODUCT_CATEGORIES,
) -> DataFrame:
    """Rows in Others whose name holds the words of a real category."""
    return df.withColumn("would_be", product_category(_product_text(name), categories)).filter(
        (F.col(label) == "Others") & (F.col("would_be") != "Others")
    )


def split_existing(master: DataFrame, new: DataFrame, key: str = "sku_id") -> tuple[DataFrame, DataFrame]:
    """(existing, new) rows of the current period: existing ones keep their tags."""
    known = master.select(key).distinct()
    return new.join(known, key, "left_semi"), new.join(known, key, "left_anti")

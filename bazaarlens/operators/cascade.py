"""Category cascade, dictionary vote, creator prior, concerns and re-tagging."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.functions.columns import cascade, has_items, ratio
from bazaarlens.functions.rule_tables import STOP_TAGS
from bazaarlens.functions.text import drop_stop_terms, fold, fold_hashtag, ngrams, words
from bazaarlens.operators.lookups import explode_products, heaviest, linked
from bazaarlens.session import interim, settle

# Confidence of each tier and the loss for a tie.
CONFIDENCE = {"product_link": 1.0, "hashtag": 0.8, "keyword": 0.65, "creator_prior": 0.5, "unknown": 0.0}
TIE_LOSS = 0.1


def hashtag_terms(col_name: str = "hashtags", stop: Sequence[str] = STOP_TAGS) -> Column:
    """Folded hashtags without the generic ones; a split hashtag stays one term."""
    folded = F.transform(F.coalesce(F.col(col_name), F.array().cast("array<string>")), lambda h: fold_hashtag(h))
    return F.array_distinct(drop_stop_terms(F.filter(folded, lambda h: h != ""), stop))


def with_text_terms(
    df: DataFrame,
    out: str,
    text: str = "description",
    longest: int = 3,
    stop: Sequence[str] = STOP_TAGS,
    keywords: str = "search_keywords",
) -> DataFrame:
    """Add the runs of 1..longest words of the folded text and of each search keyword, without generic words.

    ``keywords`` is an array column and may be missing. A run never joins words of two keywords. The words get a
    column of their own first: the runs name them several times, and one projection would fold the text once
    per mention.
    """
    tokens = drop_stop_terms(words(fold(F.coalesce(F.col(text), F.lit("")))), stop)
    rows, runs = df.withColumn("_words", tokens), ngrams("_words", longest)
    if keywords in df.columns:
        folded = F.transform(_listed(keywords), lambda k: drop_stop_terms(words(fold(k)), stop))
        rows = rows.withColumn("_searched", folded)
        runs = F.concat(runs, F.flatten(F.transform("_searched", lambda w: ngrams(w, longest))))
    return rows.withColumn(out, F.array_distinct(runs)).drop("_words", "_searched")


def _listed(c: str) -> Column:
    return F.filter(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda x: x.isNotNull())


def concern_text(df: DataFrame, text: str = "description", hashtags: str = "hashtags", keywords: str = "search_keywords") -> Column:
    """Folded description, hashtags and search keywords (as far as ``df`` has them), kept apart by a mark."""
    parts = [fold(F.coalesce(F.col(text), F.lit("")))] if text in df.columns else []
    if hashtags in df.columns:
        parts.append(F.transform(_listed(hashtags), lambda h: fold_hashtag(h)))
    if keywords in df.columns:
        parts.append(F.transform(_listed(keywords), lambda k: fold(k)))
    return F.concat_ws(" . ", *parts)


def dictionary_vote(df: DataFrame, key: str, terms: str, dictionary: DataFrame) -> DataFrame:
    """Category with the highest total weight over the different matched terms.

    A tie gives the first level 1 name, level 2 'Unknown' and ``tied``; weights are summed
    as decimals, so that ties are exact. A term listed twice for a category votes once, with its largest weight.
    Only terms of the dictionary are dealt by ``key``, and rows with the same ones share a vote.
    """
    weight = F.max(F.col("weight").cast("decimal(18,9)")).alias("weight")
    entries = dictionary.groupBy("term", "category_l1", "category_l2").agg(weight)
    known = entries.select("term").distinct()
    # explode_outer: plain explode adds a size filter that evaluates the terms twice
    found = df.select(key, F.explode_outer(terms).alias("term")).join(known, "term", "left_semi")
    # a term found twice counts twice, as the list keeps both
    sets = settle(found.groupBy(key).agg(F.sort_array(F.collect_list("term")).alias("_found")), "found-terms")
    votes = (
        # dealt by the found terms from here on: the votes, many for each of them, stay where they are
        sets.select("_found").distinct()
        .select("_found", F.explode("_found").alias("term"))
        .join(entries, "term")
        .groupBy("_found", "category_l1", "category_l2")
        .agg(F.sum("weight").alias("score"))
    )
    best = F.rank().over(Window.partitionBy("_found").orderBy(F.desc("score")))
    top = votes.withColumn("_r", best).filter(F.col("_r") == 1)
    won = top.groupBy("_found").agg(
        F.min("category_l1").alias("category_l1"),
        F.when(F.count("*") == 1, F.min("category_l2")).otherwise("Unknown").alias("category_l2"),
        (F.count("*") > 1).alias("tied"),
    )
    return sets.join(won, "_found").select(key, "category_l1", "category_l2", "tied")


def product_link_category(posts: DataFrame, products: DataFrame, categories: DataFrame, key: str = "post_base_id") -> DataFrame:
    """(level 1, level 2) that most linked products have; products of unknown category do not count."""
    named = products.select(
        "product_base_id", F.col("categories__id_1").cast("string").alias("category_id"), "category_l2"
    ).join(categories.select("category_id", F.col("category_name").alias("category_l1")), "category_id")
    counts = (
        explode_products(linked(posts), [key])
        .join(named.select("product_base_id", "category_l1", "category_l2"), "product_base_id")
        .groupBy(key, "category_l1", "category_l2")
        .agg(F.count("*").alias("_n"))
    )
    return heaviest(counts, [key], ["category_l1", "category_l2"], "_n")


def creator_prior(tagged: DataFrame, min_videos: int = 5, min_share: float = 0.6, videos: Column | None = None) -> DataFrame:
    """Main category of the creators with enough tagged videos and a clear favourite.

    ``videos`` adds up the videos of several rows; without it each row is one.
    """
    counts = tagged.filter(F.col("category_l1").isNotNull()).groupBy("channel_base_id", "category_l1").agg(
        (F.count("*") if videos is None else videos).alias("n")
    )
    total = counts.groupBy("channel_base_id").agg(F.sum("n").alias("total"))
    best = heaviest(counts, ["channel_base_id"], ["category_l1", "n"], "n").join(total, "channel_base_id")
    share = ratio("n", "total")
    return best.filter((F.col("total") >= min_videos) & (share >= min_share)).select(
        "channel_base_id", F.col("category_l1").alias("prior_l1"), share.alias("prior_share")
    )


def _score(source: str, tied: Column | None = None) -> Column:
    full = CONFIDENCE[source]
    if tied is None:
        return F.lit(full)
    return F.when(tied, F.lit(round(full - TIE_LOSS, 2))).otherwise(F.lit(full))


def tag_category_cascade(
    posts: DataFrame,
    products: DataFrame,
    categories: DataFrame,
    hashtag_dict: DataFrame,
    keyword_dict: DataFrame,
    version: str,
    tagged_at: str,
    longest: int = 3,
    min_videos: int = 5,
    min_share: float = 0.6,
    key: str = "post_base_id",
    stop: Sequence[str] = STOP_TAGS,
) -> DataFrame:
    """Product link, else hashtags, else words of description and search keywords, else creator prior, else Unknown.

    A tier only sees the posts that the tiers above left open. Between tiers only the key and its tag are written. The
    prior is found and given on one narrow row for each key and channel, so that the posts with their texts are dealt
    once, at the end. Tags pack so well that Spark takes a table of millions of them for a small one, which it
    would send through the driver to every task: the joins on ``key`` ask for a merge. The stop list and dictionaries may come from versioned files (``readers``).
    """
    tag, pair = ["l1", "l2", "source", "confidence"], [key, "channel_base_id"]
    by_link = product_link_category(posts, products, categories, key).select(
        key, F.col("category_l1").alias("l1"), F.coalesce("category_l2", F.lit("Unknown")).alias("l2"), F.lit("product_link").alias("source"), _score("product_link").alias("confidence")
    )

    def votes(rows: DataFrame, source: str, entries: DataFrame) -> DataFrame:
        return dictionary_vote(rows, key, "_terms", entries).select(
            key, F.col("category_l1").alias("l1"), F.col("category_l2").alias("l2"), F.lit(source).alias("source"), _score(source, F.col("tied")).alias("confidence")
        )

    texts = [c for c in ("description", "search_keywords") if c in posts.columns]
    with interim(posts.sparkSession) as keep:
        tier_0 = keep(by_link, "tier-0")
        no_link = posts.select(key, "hashtags", *texts).join(tier_0.select(key).hint("merge"), key, "left_anti")
        tier_1 = keep(votes(no_link.select(key, hashtag_terms(stop=stop).alias("_terms")), "hashtag", hashtag_dict), "tier-1")
        no_tag = no_link.select(key, *texts).join(tier_1.select(key).hint("merge"), key, "left_anti")
        tier_2 = votes(with_text_terms(no_tag, "_terms", longest=longest, stop=stop), "keyword", keyword_dict)
        tags = keep(tier_0.unionByName(tier_1).unionByName(tier_2), "tiers")
        told = posts.groupBy(*pair).agg(F.count("*").alias("_n")).join(tags.hint("merge"), key, "left")
        marks = settle(told.select(*pair, *tag, "_n"), "marks")
    prior = creator_prior(marks.withColumnRenamed("l1", "category_l1"), min_videos, min_share, F.sum("_n"))
    use_prior = F.col("l1").isNull() & F.col("prior_l1").isNotNull()
    # only what has no category yet is dealt by channel
    left = marks.filter(F.col("l1").isNull()).join(prior, "channel_base_id", "left").select(
        *pair,
        F.coalesce("l1", "prior_l1").alias("l1"),
        "l2",
        F.coalesce("source", F.when(use_prior, "creator_prior")).alias("source"),
        F.coalesce("confidence", F.when(use_prior, _score("creator_prior"))).alias("confidence"),
    )
    given = marks.filter(F.col("l1").isNotNull()).select(*pair, *tag).unionByName(left).withColumnsRenamed({c: f"_{c}" for c in pair})
    same = F.col(key).eqNullSafe(F.col(f"_{key}")) & F.col("channel_base_id").eqNullSafe(F.col("_channel_base_id"))
    return posts.join(given.hint("merge"), same, "left").select(
        *posts.columns,
        F.coalesce("l1", F.lit("Unknown")).alias("category_l1"),
        F.coalesce("l2", F.lit("Unknown")).alias("category_l2"),
        F.coalesce("source", F.lit("unknown")).alias("category_source"),
        F.coalesce("confidence", _score("unknown")).alias("category_confidence"),
        F.lit(version).alias("tag_dict_version"),
        F.lit(tagged_at).cast("timestamp_ntz").alias("tagged_at"),
    )


def tag_concerns(
    df: DataFrame,
    text: Column,
    concerns: Mapping[str, Sequence[str]],
    scope: Mapping[str, Sequence[str]],
    category: str = "category_l1",
    out: str = "concerns",
) -> DataFrame:
    """Concerns of the row's category whose terms occur as whole words of the folded text.

    The text gets a column of its own, as the terms name it several times, and is made for categories in scope only.
    """
    padded = F.when(F.col(category).isin(list(scope)), F.concat(F.lit(" "), text, F.lit(" ")))

    def hit(name: str) -> Column:
        cond = F.lit(False)
        for term in concerns[name]:
            cond = cond | F.col("_padded").contains(f" {term} ")
        return F.when(cond, F.lit(name))

    steps = [
        (F.col(category) == group, F.filter(F.array(*[hit(n) for n in names]), lambda x: x.isNotNull()))
        for group, names in scope.items()
    ]
    return df.withColumn("_padded", padded).withColumn(out, cascade(steps, F.array().cast("array<string>"))).drop("_padded")


def tag_quality(guess: DataFrame, truth: DataFrame, key: str = "post_base_id", min_coverage: float = 0.8, min_accuracy: float = 0.85) -> DataFrame:
    """Coverage of the guesses and their accuracy on posts whose product link gives the truth."""
    known = truth.select(key, F.col("category_l1").alias("_truth"))
    both = guess.select(key, "category_l1").join(known.hint("merge"), key, "left")
    stats = both.agg(
        F.count("*").alias("videos"),
        F.count_if(F.col("category_l1") != "Unknown").alias("covered"),
        F.count("_truth").alias("checked"),
        F.count_if(F.col("category_l1") == F.col("_truth")).alias("right"),
    )
    return stats.select(
        "videos",
        "checked",
        ratio("covered", "videos").alias("coverage"),
        ratio("right", "checked").alias("accuracy"),
    ).withColumn(
        "accepted", (F.col("coverage") >= min_coverage) & F.coalesce(F.col("accuracy") >= min_accuracy, F.lit(False))
    )


def needs_retag(version: str) -> Column:
    """Never tagged, tagged with another dictionary, or linked to products since."""
    upgraded = has_items("list_product_base_id") & (F.col("category_source") != "product_link")
    return F.col("tag_dict_version").isNull() | (F.col("tag_dict_version") != version) | upgraded


def retag_outdated(tagged: DataFrame, version: str, tagger: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Tag only the rows that need it; all other rows keep their tags."""
    old = F.coalesce(needs_retag(version), F.lit(True))
    return tagged.filter(~old).unionByName(tagger(tagged.filter(old)))


def segment(df: DataFrame, l1: str, concern: str | None = None, min_confidence: float = 0.0) -> DataFrame:
    """Rows of a category, with a concern, above a confidence."""
    out = df.filter((F.col("category_l1") == l1) & (F.col("category_confidence") >= min_confidence))
    return out if concern is None else out.filter(F.array_contains("concerns", concern))

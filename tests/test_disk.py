"""What wide rows and finished steps hold on disk: shuffles and tables that nothing reads any more must be gone."""

from __future__ import annotations

import os
import re
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from bazaarlens import session
from bazaarlens.operators import cascade as cas
from bazaarlens.plans import learning, tagging
from bazaarlens.sources import sinks

ENTRY = "term string, category_l1 string, category_l2 string, weight double"


def shuffle_files(spark) -> set[str]:
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for top in dirs for _, _, names in os.walk(top.getPath()) for f in names if f.startswith("shuffle_")}


def exchanges(spark, df) -> list[str]:
    """Input columns of each shuffle of the plan."""
    text = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: (.*)", text)


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


@pytest.fixture
def tables(tmp_path):
    """Orders with five lines each, two of them versions of one post; the first part's name is in the dictionary."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    day = datetime(2000, 1, 1)
    lines = [(o, 1 + (o + n) % 3, 1, min(n, 4), float(3 + n), 100.0 + n, 0.0, 0.0 if n % 2 else 0.05, day.replace(day=1 + n)) for o in range(1, 9) for n in range(1, 6)]
    names = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"]
    at = {
        "lineitem": dict(zip(names, map(list, zip(*lines, strict=True)), strict=True)),
        "orders": {"o_orderkey": [*range(1, 9)], "o_custkey": [1 + o % 2 for o in range(1, 9)], "o_orderdate": [day] * 8, "o_orderpriority": ["1-URGENT"] * 8},
        "part": {"p_partkey": [1, 2, 3], "p_name": ["small bolt", "large ring", "red rod"], "p_brand": ["b"] * 3, "p_type": ["x", "y", "z"], "p_size": [2, 5, 3], "p_retailprice": [1.0] * 3},
        "region": {"r_regionkey": [0, 1, 2, 3], "r_name": ["AFRICA", "AMERICA", "ASIA", "EUROPE"]},
    }
    for name, columns in at.items():
        pq.write_table(pa.table(columns), f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_settled_shuffles_are_given_back(spark):
    rows = spark.range(5000).groupBy((F.col("id") % 1000).alias("k")).agg(F.count("*").alias("n"))
    held = shuffle_files(spark)
    # the plan of this frame stays alive, so nothing is left to the collector of the JVM
    done = session.settle(rows, "counts")
    ends = time.time() + 20
    while shuffle_files(spark) - held and time.time() < ends:
        time.sleep(0.2)
    assert not shuffle_files(spark) - held
    assert done.count() == 1000 and done.filter("n = 5").count() == 1000


def test_interim_tables_go(spark):
    with session.interim(spark) as keep:
        a = keep(spark.range(5), "a")
        b = session.settle(a.withColumn("v", F.col("id") * 2), "b")
        folder = os.path.dirname(os.path.dirname(a.inputFiles()[0].removeprefix("file:")))
        assert os.path.exists(folder)
    assert not os.path.exists(folder) and sorted(r.v for r in b.collect()) == [0, 2, 4, 6, 8]
    with pytest.raises(ZeroDivisionError), session.interim(spark) as keep:
        folder = os.path.dirname(os.path.dirname(keep(spark.range(5), "a").inputFiles()[0].removeprefix("file:")))
        raise ZeroDivisionError
    assert not os.path.exists(folder)


def test_posts_are_dealt_once(spark, no_broadcast):
    """Repeated and NULL keys and channels keep their tag and prior, and texts are in one shuffle only."""
    rows = [
        (1, 9, "serum", [1]), (2, 9, "x", [1]), (3, 9, "none", []),
        # the same key in two channels and twice in one; a channel without a favourite; no key; no channel
        (4, 9, "none", []), (4, 8, "none", []), (4, 9, "none", []), (5, 8, "serum", []), (6, 8, "rod", []),
        (None, 9, "none", []), (None, 8, "none", []), (None, 9, "none", []), (7, None, "none", []), (8, None, "serum", []),
    ]
    posts = spark.createDataFrame([(k, c, t, [], p) for k, c, t, p in rows], "post_base_id long, channel_base_id long, description string, hashtags array<string>, list_product_base_id array<long>")
    products = spark.createDataFrame([(1, 1, "Care")], "product_base_id long, categories__id_1 long, category_l2 string")
    categories = spark.createDataFrame([("1", "Beauty")], "category_id string, category_name string")
    words = spark.createDataFrame([("serum", "Beauty", "Skin", 1.0), ("rod", "Tools", "Rods", 1.0)], ENTRY)
    done = cas.tag_category_cascade(posts, products, categories, words, words, "v", "2026-06-01", min_videos=2, min_share=0.6)
    got = sorted(map(str, done.select("post_base_id", "channel_base_id", "category_l1", "category_l2", "category_source", "category_confidence").collect()))
    link, word, rod = ("Beauty", "Care", "product_link", 1.0), ("Beauty", "Skin", "keyword", 0.65), ("Tools", "Rods", "keyword", 0.65)
    prior, none = ("Beauty", "Unknown", "creator_prior", 0.5), ("Unknown", "Unknown", "unknown", 0.0)
    tags = [link, link, prior, prior, none, prior, word, rod, prior, none, prior, none, word]
    want = spark.createDataFrame([(k, c, *t) for (k, c, *_), t in zip(rows, tags, strict=True)], "post_base_id long, channel_base_id long, category_l1 string, category_l2 string, category_source string, category_confidence double")
    assert got == sorted(map(str, want.collect()))
    assert sum("description" in x for x in exchanges(spark, done.select("post_base_id", "description", "category_l1", "category_confidence"))) == 1


def test_a_category_may_be_null(spark):
    """A link to a category without a name keeps its source and level 2; the prior still gives level 1."""
    posts = spark.createDataFrame([(1, 9, [1]), (2, 9, [2]), (3, 9, [2]), (4, 8, [1])], "post_base_id long, channel_base_id long, list_product_base_id array<long>").withColumn("hashtags", F.array().cast("array<string>"))
    products = spark.createDataFrame([(1, 1, "Odd"), (2, 2, "Care")], "product_base_id long, categories__id_1 long, category_l2 string")
    categories = spark.createDataFrame([("1", None), ("2", "Beauty")], "category_id string, category_name string")
    none = spark.createDataFrame([], ENTRY)
    done = cas.tag_category_cascade(posts.withColumn("description", F.lit(None).cast("string")), products, categories, none, none, "v", "2026-06-01", min_videos=2)
    got = {r.post_base_id: (r.category_l1, r.category_l2, r.category_source, r.category_confidence) for r in done.collect()}
    care = ("Beauty", "Care", "product_link", 1.0)
    assert got == {1: ("Beauty", "Odd", "product_link", 1.0), 2: care, 3: care, 4: ("Unknown", "Odd", "product_link", 1.0)}


def test_concern_texts_are_folded_once(spark):
    posts = spark.createDataFrame([("ASIA", "Red rod, bolt"), ("EUROPE", "red rod"), ("AFRICA", "bolt"), (None, "bolt"), ("ASIA", None)], "category_l1 string, description string")
    done = tagging._with_concerns(posts)
    assert [r.concerns for r in done.collect()] == [["hardware"], ["hardware"], [], [], []] and done.columns == ["category_l1", "description", "concerns"]
    plan = done._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1


def test_serving_is_joined_before_it_is_dealt_to_writers(spark, tables, monkeypatch):
    """The join's wide shuffle is gone before that of the writers begins, and only what the result reads is left."""
    found, write, work = [], sinks.write_serving, session.work_folder(spark)

    def spied(df, path, by="category_l1"):
        found.append(exchanges(spark, df))
        write(df, path, by)

    monkeypatch.setattr(sinks, "write_serving", spied)
    before = {*os.listdir(work)}
    rows = learning.snk4_serving(spark, tables).collect()
    assert found == [[]]
    kept = {re.sub("-[0-9a-f]{32}$", "", x) for x in {*os.listdir(work)} - before}
    assert kept <= {"videos", "found-terms", "marks", "serving"}
    assert len(rows) == 32 and len({r.post_base_id for r in rows}) == 32
    assert {(r.category_l1, r.category_source) for r in rows} >= {("ASIA", "product_link"), ("EUROPE", "product_link")}

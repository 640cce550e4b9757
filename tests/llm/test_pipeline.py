"""Each stage against brute force on its own input, and the whole run."""

import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from test_packing import check
from test_simhash import groups, plain

from bazaarlens.llm.language_crf import Labeller, train

FOLDER = "/root/testdata/sf0.001"


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    english = docs.filter("lang = 'en' and n_chars > 500").orderBy("doc_id").first()
    shout = (9004, "".join(c.upper() if c.isascii() else c for c in english.text), "en", "src2", english.n_chars)
    odd = [shout, (9001, "12 34 !!", "en", "src1", 8), (9002, None, None, None, None), (9003, "", "en", None, 0)]
    before = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    labeller = Labeller(train(before))
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, before, FOLDER)
        old = rows(before)
        if name == "packing":
            check(got.collect(), {i: r.text for i, r in old.items()}, 1024)
            break
        assert got.columns == docs.columns
        got.write.parquet(path := f"{tmp_path}/{name}")
        got = spark.read.parquet(path)
        new = rows(got)
        assert all(new[i] == old[i] for i in new) and len(new) == got.count()
        if name == "language_id":
            want = {i for i, r in old.items() if (p := labeller.predict([r.text or ""])[0])[0] != "und" and p[1] >= corpus_pipeline.LEAST_SCORE}
            assert not want & {9001, 9002, 9003} and len(want) >= 0.98 * len(old)
        elif name == "exact_dedup":
            best = {}
            for i, r in old.items():
                key = re.sub(r"[\x20\x09-\x0D]", "", r.text or "")
                best[key] = min(best.get(key, (1, 0)), (-len(r.text or ""), i))
            want = {i for _, i in best.values()}
        else:
            fps = {i: plain(r.text or "") for i, r in old.items()}
            root = groups(sorted(set(fps.values())), 2)
            least = {}
            for i, fp in fps.items():
                least[root[fp]] = min(least.get(root[fp], i), i)
            want = set(least.values())
            assert 9004 in old and 9004 not in want
        assert set(new) == want, name
        before = got


def test_run(spark):
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.filter("length <= 0 or length > 1024").count() == 0
    assert got.select("sequence_id").distinct().count() == got.agg({"sequence_id": "max"}).first()[0] + 1


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_empty(spark, name, stage):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    assert stage(spark, docs, FOLDER).count() == 0


def test_least_score_follows_the_number_of_labels():
    got = [corpus_pipeline.least_score(k) for k in (1, 2, 4, 10)]
    assert got == pytest.approx([1.0, 0.5666666667, 0.35, 0.22]) and corpus_pipeline.least_score(4) == corpus_pipeline.LEAST_SCORE == 0.35


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_odd_rows(spark, name, stage):
    """NULLs, repeats and further columns whose names the operators use themselves."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").filter("lang = 'en'").limit(60)
    first = docs.orderBy("doc_id").first()
    more = [first, first, (None, first.text, "en", "s", 1), (None, None, None, None, None), (-5, "", None, None, 0), (first.doc_id, "another text of that id", "en", None, 0)]
    odd = docs.unionByName(spark.createDataFrame(more, docs.schema))
    names = ("queue", "tokens", "hash", "range", "text_sha256", "gone_id", "lang_pred", "score", "fingerprint", "row_key", "part", "kept")
    for c in names:
        odd = odd.withColumn(c, F.lit("x"))
    got = stage(spark, odd, FOLDER)
    if name == "packing":
        whole = got.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m"), F.sum(F.when(F.col("start") == 0, F.col("doc_tokens"))).alias("all")).collect()
        assert all(r.n == r["all"] for r in whole) and {None, -5} <= {r.doc_id for r in whole}
        return
    assert got.columns == odd.columns
    rows = [(r.doc_id, r.text) for r in got.collect()]
    assert set(rows) <= {(r.doc_id, r.text) for r in odd.collect()}
    if name == "language_id":
        assert rows.count((first.doc_id, first.text)) == 3 and (None, first.text) in rows and (-5, "") not in rows
    elif name == "exact_dedup":
        assert rows.count((first.doc_id, first.text)) == 3 and (None, first.text) not in rows and (-5, "") in rows
    else:
        assert rows.count((first.doc_id, first.text)) == 1

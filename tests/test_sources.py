"""Readers and writers."""

import json
import re

import pytest

from pyspark.sql import functions as F

from bazaarlens.operators import live, market
from bazaarlens.sources import readers, sinks


def test_concatenated_documents(spark, tmp_path):
    docs = [{"code": 0, "data": [{"sourceId": i, "view": i * 2, "viewPercentage": 0.5}]} for i in range(200)]
    path = tmp_path / "a.json"
    path.write_text("".join(json.dumps(d) for d in docs), encoding="utf-8")
    got = readers.read_concat_json(spark, str(path), "code int, data array<struct<sourceId:int, view:bigint, viewPercentage:double>>").orderBy("ordinal").collect()
    assert [r.ordinal for r in got] == list(range(200))
    assert [r.data.data[0].sourceId for r in got] == list(range(200))


def test_documents_in_several_splits(spark, tmp_path):
    path = tmp_path / "b.json"
    path.write_text("".join(json.dumps({"n": i, "pad": "x" * 50}) for i in range(3000)), encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = readers.read_concat_json(spark, str(path), "n int, pad string")
        rows = df.select("ordinal", "data.n").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r.ordinal, r.n) for r in rows) == [(i, i) for i in range(3000)]


@pytest.mark.parametrize("size", [60, 1000, 10**6])
def test_separators_inside_texts(spark, tmp_path, size):
    texts = ['x"}{"y', "}{", "a}{b}{c", 'nested {"code": 1}', "plain", "back\\slash\\"]
    docs = [{"code": 0, "n": i, "t": texts[i % 6], "o": {"p": {"code": i}}, "l": [{"code": 1}, {"code": 2}]} for i in range(120)]
    path = tmp_path / "q.json"
    for between in ("", "\n"):
        path.write_text(between.join(json.dumps(d) for d in docs), encoding="utf-8")
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        try:
            got = readers.read_concat_json(spark, str(path), "n int, t string").select("ordinal", "data.n", "data.t").collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert sorted(map(tuple, got)) == [(i, i, d["t"]) for i, d in enumerate(docs)]


def test_windows_of_pieces_hold_one_split(spark, tmp_path, monkeypatch):
    """No piece of this file parses alone, so all of them are neighbours."""
    docs = [{"code": 0, "n": i, "t": "x}{y"} for i in range(50)]
    (tmp_path / "w.json").write_text("\n".join(map(json.dumps, docs)), encoding="utf-8")
    plans, rejoined = [], readers._rejoined

    def seen(pieces):
        out = rejoined(pieces)
        plans.append(out._jdf.queryExecution().optimizedPlan().toString())
        return out

    monkeypatch.setattr(readers, "_rejoined", seen)
    got = readers.read_concat_json(spark, str(tmp_path / "w.json"), "n int, t string").select("ordinal", "data.n", "data.t").collect()
    assert sorted(map(tuple, got)) == [(i, i, "x}{y") for i in range(50)]
    windows = re.findall(r"windowspecdefinition\(([^)]*?) ASC NULLS FIRST(, _row)?", plans[0])
    by_row = [keys for keys, more in windows if more or "_row#" in keys]
    assert windows and all(keys.count("_block#") == 1 and "_row#" in keys for keys in by_row), plans[0]


def test_cut_off_documents_beside_inner_envelopes(spark, tmp_path):
    def doc(i):
        return json.dumps({"code": 0, "n": i, "l": [{"code": 1}, {"code": 2}], "o": {"code": 3}, "t": 'a} {"b'})

    for cut in ('{"code": 0, "n": -1, "l": [{"time": 1}, {"time"', '{"code": 0, "l": [', '{"code": 0, "o":', '{"code": 0, "l": [1,'):
        path = tmp_path / "c.json"
        path.write_text(doc(0) + doc(1) + cut + doc(3) + doc(4) + cut + doc(6) + doc(7), encoding="utf-8")
        got = readers.read_concat_json(spark, str(path), "n int, t string").select("ordinal", "data.n", "data.t").collect()
        rows = {r.ordinal: (r.n, r.t) for r in got}
        assert sorted(rows) == list(range(8)) and all(rows[i] == (i, 'a} {"b') for i in (0, 1, 3, 4, 6, 7)), cut


def test_truncated_document_keeps_complete_rows(spark, tmp_path):
    path = tmp_path / "c.json"
    path.write_text('{"code": 0, "data": [{"time": 60000, "views": 1}, {"time": 120000, "views": 2}, {"time": 180000, "viewers"{"code": 0, "data": [{"time": 60000, "views": 9}]}', encoding="utf-8")
    docs = readers.read_concat_json(spark, str(path), "code int").withColumnRenamed("ordinal", "session_id")
    got = live.stage_minute(docs).select("session_id", "bucket_time_ms", "views").collect()
    assert sorted(map(tuple, got)) == [(0, 60000, 1), (0, 120000, 2), (1, 60000, 9)]


def test_search_json(spark, tmp_path):
    def basic(i, s, **kw):
        return {"item_basic": {"itemid": i, "shopid": s, **kw}}

    doc = {"  dầu   GỘI ": {"query": 1, "items": [basic(7681301862, 400589752, name="A", brand=None), basic(7681301862, 400589752, name="B"), basic(None, 3), {"item_basic": None}]}, "empty": {"items": None}}
    path = tmp_path / "s.json"
    path.write_text(json.dumps(doc, ensure_ascii=False), encoding="utf-8")
    rows = readers.parse_search(readers.read_search_results(spark, str(path)), F.lit("2026-03-10").cast("date")).collect()
    assert len(rows) == 1
    assert (rows[0].key_word, rows[0].product_base_id, rows[0].product_name, rows[0].brand, rows[0].url) == (
        "Dầu gội", "1__7681301862__400589752", "A", "", "https://shopee.vn/product/400589752/7681301862",
    )


def test_rules_and_dictionary(spark, tmp_path):
    (tmp_path / "r.csv").write_text('seq,label,priority,source,keyword_pattern\n2,B,,,b|"\n1,A,3,Description,"a,b"\n', encoding="utf-8")
    rules = readers.load_rules(spark, str(tmp_path / "r.csv"))
    assert [(r.label, r.source, r.priority) for r in rules] == [("A", "description", 3), ("B", "both", 99)]
    (tmp_path / "d.json").write_text(json.dumps({"version": "v1", "entries": [{"term": "serum", "category_l1": "Beauty", "category_l2": "Skin", "weight": 0.9}]}), encoding="utf-8")
    row = readers.load_dictionary(spark, str(tmp_path / "d.json")).first()
    assert (row.version, row.term, row.weight) == ("v1", "serum", 0.9)


def test_latest_file(spark, tmp_path):
    for n in ("x_1.csv", "x_3.csv", "x_2.csv"):
        (tmp_path / n).write_text("a\n")
    assert readers.latest_file(spark, f"{tmp_path}/x_*.csv", by="name").endswith("x_3.csv")
    assert readers.latest_file(spark, f"{tmp_path}/none_*.csv") is None


def test_insert_twice(spark, tmp_path):
    target = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    for part in (df, df, spark.createDataFrame([(2, "z"), (3, "d")], df.schema)):
        sinks.insert_new(part, target, ["k"], [F.asc("v")])
    assert sorted(map(tuple, spark.read.parquet(target).collect())) == [(1, "a"), (2, "c"), (3, "d")]


def test_period_resume(spark, tmp_path):
    calls = []

    def build(period):
        calls.append(period)
        return spark.createDataFrame([(len(calls),)], "n int")

    out = str(tmp_path / "p")
    assert market.build_period(spark, out, "202601", build) is True
    assert market.build_period(spark, out, "202601", build) is False
    assert market.build_period(spark, out, "202601", build, resume=False) is True
    assert calls == ["202601", "202601"] and spark.read.parquet(out).first().n == 2


def test_tagged_csv_and_report(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi"\nthere', "x")], "video_id int, description string, tag string")
    sinks.write_tagged(df, str(tmp_path / "v"), ["video_id", "gone", "description"], ["tag"])
    back = readers.read_csv(spark, str(tmp_path / "v"), "video_id int, description string, tag string").first()
    assert tuple(back) == (1, 'say "hi"\nthere', "x")
    report = sinks.metrics_report(spark.createDataFrame([(0.5, 3)], "f1 double, n int"), {"model": "m"}).first()
    assert report.model == "m" and "| f1 | 0.5000 |" in report.markdown


def test_serving_partitions(spark, tmp_path):
    facts = spark.createDataFrame([(1, 5), (2, 6)], "post_base_id int, v int")
    tags = spark.createDataFrame([(1, "Beauty", 0.8)], "post_base_id int, category_l1 string, category_confidence double")
    sinks.write_serving(sinks.attach_tags(facts, tags), str(tmp_path / "s"))
    got = {r.post_base_id: (r.category_l1, r.category_confidence) for r in spark.read.parquet(str(tmp_path / "s")).collect()}
    assert got == {1: ("Beauty", 0.8), 2: ("Unknown", 0.0)}


def test_periods_in_one_pass(spark, tmp_path):
    df = spark.createDataFrame([(2001, 1), (2001, 2), (2002, 5), (2003, 7)], "y int, v int")
    built = []

    def build(rows):
        built.append(1)
        return rows.groupBy("period").agg(F.sum("v").alias("v"))

    out, year = str(tmp_path / "p"), F.col("y").cast("string")
    assert market.build_periods(df, out, year, build, ["2001", "2002"]) == ["2001", "2002"]
    assert market.build_periods(df, out, year, build, ["2001", "2002", "2003", "2004"]) == ["2003", "2004"]
    assert market.build_periods(df, out, year, build, ["2003", "2004"]) == [] and len(built) == 2
    assert sorted((r.period, r.v) for r in spark.read.parquet(out).collect()) == [(2001, 3), (2002, 5), (2003, 7)]

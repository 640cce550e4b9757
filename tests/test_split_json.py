"""Entries of large keyword objects come back from files that many tasks read."""

import json
import random

import pytest
from pyspark.sql import functions as F

from bazaarlens.sources.split_json import lazada_results, read_keyed_json, search_results

ODD = [
    {"a": 1}, {}, [], [1, [2, {"x": "}"}]], "text, with {braces} [and] \"quotes\" \\ end", "\\", '"', None, True, 1.5, {"deep": [{"er": [{"est": "},{"}]}]}, "é🙂\n\t", "}", {"}": "]"},
]


@pytest.fixture(params=["100b", "128m"])
def parts(spark, request):
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def found(df):
    rows = df.select("file", "block", "seq", "key", F.to_json("value").alias("value")).collect()
    return [(r.key, r.value and json.loads(r.value)) for r in sorted(rows, key=lambda r: r[:3])]


@pytest.mark.parametrize("style", [{}, {"indent": 1}, {"separators": (",", ":")}, {"ensure_ascii": False}])
def test_any_layout(spark, tmp_path, parts, style):
    rng = random.Random(str(style))
    data = {f"key {i} \"}},{{": rng.choice(ODD) for i in range(120)}
    (tmp_path / "one.json").write_text(json.dumps(data, **style), encoding="utf-8")
    assert found(read_keyed_json(spark, str(tmp_path))) == list(data.items())


def test_several_objects_and_odd_files(spark, tmp_path, parts):
    (tmp_path / "a").write_text('{"a": 1, "a": {"b": 2}}\n {}\n{"c": [{}]}{"d": "x"}\n')
    (tmp_path / "b").write_text("")
    (tmp_path / "c").write_text("  { }  ")
    (tmp_path / "d").write_text('{"whole": {"x": 1}, "cut": {"x": ' + "[1, " * 200)
    assert found(read_keyed_json(spark, str(tmp_path))) == [("a", 1), ("a", {"b": 2}), ("c", [{}]), ("d", "x"), ("whole", {"x": 1}), (None, None)]


def test_drifting_items(spark, tmp_path, parts):
    items = [{"item_basic": {"itemid": 1, "name": "n", "new": [1]}}, {"item_basic": {"itemid": "2", "shopid": "x"}}, {"other": 1}, {"item_basic": {"itemid": 3, "price": 10**17}}]
    (tmp_path / "s").write_text(json.dumps({"kw": {"items": items}, "none": {"items": []}, "odd": {"items": 5}, "gone": None}))
    rows = search_results(spark, str(tmp_path / "s")).withColumn("item", F.to_json("item")).collect()
    got = [(r.key_word, r.position, r.itemid, r.shopid, r.name, r.price) for r in sorted(rows, key=lambda r: r.position)]
    assert got == [("kw", 1, 1, None, "n", None), ("kw", 2, 2, None, None, None), ("kw", 3, None, None, None, None), ("kw", 4, 3, None, None, 10**17)]
    assert json.loads(min(rows, key=lambda r: r.position)["item"]) == items[0]
    (tmp_path / "l").write_text(json.dumps({"kw": {"mods": {"listItems": [{"itemId": 7, "name": "x"}, {"brandName": "b"}]}}}))
    assert sorted(tuple(r)[:5] for r in lazada_results(spark, str(tmp_path / "l")).collect()) == [("kw", 1, "7", "x", None), ("kw", 2, None, None, "b")]

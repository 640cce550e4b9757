"""A keyed table takes each key once, shuffles the delivery alone and may be written by several runs."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from bazaarlens.sources.keyed import KeyedTable

SCHEMA = "k long, part string, v double"


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def new_table(spark, path, buckets=8):
    return KeyedTable(spark, str(path), rows(spark, []).schema, ["k", "part"], buckets)


def found(table):
    return sorted(((r.k, r.part, r.v) for r in table.read().collect()), key=str)


def test_null_keys_and_overlaps_enter_once(spark, tmp_path):
    data = [(1, "a", 2.0), (1, "a", 1.0), (None, "a", 3.0), (None, "a", 4.0), (2, None, 5.0), (None, None, 6.0), (2, "null", 7.0), (2, "", 8.0)]
    table = new_table(spark, tmp_path / "t")
    want = sorted([(1, "a", 1.0), (None, "a", 3.0), (2, None, 5.0), (None, None, 6.0), (2, "null", 7.0), (2, "", 8.0)], key=str)
    for delivery in ("first", "first", "second"):
        table.insert(rows(spark, data), delivery, [F.asc("v")])
        assert found(table) == want
    table.insert(rows(spark, [*data, (3, "a", 9.0)]), "third", [F.asc("v")])
    assert found(table) == sorted([*want, (3, "a", 9.0)], key=str)
    table.insert(rows(spark, []), "none", [F.asc("v")])
    assert len(found(table)) == 7


def test_a_repeated_delivery_takes_the_place_of_its_first_run(spark, tmp_path):
    table = new_table(spark, tmp_path / "t")
    table.insert(rows(spark, [(1, "a", 1.0), (2, "a", 1.0)]), "a", [F.asc("v")])
    table.insert(rows(spark, [(2, "a", 5.0), (3, "a", 5.0)]), "b", [F.asc("v")])
    table.insert(rows(spark, [(1, "a", 7.0), (3, "a", 7.0), (4, "a", 7.0)]), "a", [F.asc("v")])
    assert found(table) == [(1, "a", 7.0), (3, "a", 5.0), (4, "a", 7.0)]


def test_only_the_delivery_is_shuffled(spark, tmp_path):
    table = new_table(spark, tmp_path / "t")
    data = rows(spark, [(i, "a", float(i)) for i in range(100)])
    table.insert(data, "a", [F.asc("v")])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = table.new_rows(data, "b", [F.asc("v")])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan and "SelectedBucketsCount: 8 out of 8" in plan
    assert "ReadSchema: struct<row_key:binary>" in plan  # of what is held, the digests alone are read


def test_shares_are_written_at_the_same_time(spark, tmp_path):
    table = new_table(spark, tmp_path / "t")
    data = rows(spark, [(i % 500, "a", float(i)) for i in range(2000)])
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: table.insert(data, "d", [F.asc("v")], (i, 4)), range(4)))
    assert [(r[0], r[2]) for r in sorted(found(table))] == [(i, float(i)) for i in range(500)]
    assert not list((tmp_path / "t").glob(".spark-staging*"))


def test_another_session_goes_on(spark, tmp_path):
    new_table(spark, tmp_path / "t").insert(rows(spark, [(1, "a", 1.0)]), "a", [F.asc("v")])
    other = spark.newSession()
    spark.sql(f"DROP TABLE {new_table(spark, tmp_path / 't').name}")  # its files stay, as those of another cluster's session
    table = KeyedTable(other, str(tmp_path / "t"), rows(spark, []).schema, ["k", "part"], 8)
    table.insert(other.createDataFrame([(1, "a", 2.0), (2, "a", 2.0)], SCHEMA), "b", [F.asc("v")])
    assert found(table) == [(1, "a", 1.0), (2, "a", 2.0)]


def test_own_columns_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="delivery"):
        KeyedTable(spark, str(tmp_path / "t"), spark.range(1).withColumn("delivery", F.lit(1)).schema, ["id"])

"""Compaction keeps the rows and bounds the folders, while the stream goes on."""

from pyspark.sql import functions as F

from bazaarlens.session import fresh_path
from bazaarlens.streaming import jobs
from bazaarlens.streaming.compact import UpdatedTable

SCHEMA = "minute timestamp, event_type string, n long, total double"
KEYS = ["minute", "event_type"]


def batch(spark, target, number, rows):
    df = spark.createDataFrame(rows, SCHEMA.replace("timestamp", "string")).withColumn("minute", F.col("minute").cast("timestamp"))
    df.coalesce(1).write.mode("overwrite").parquet(f"{target}/batch={number}")
    return df.schema


def state(table, **since):
    return sorted((str(r.minute)[11:16], r.event_type, r.n) for r in table.read(**since).collect())


def at(text):
    return F.lit(f"2026-01-01 {text}:00").cast("timestamp")


def test_many_small_batches(spark):
    target = fresh_path(spark, "updates")
    want, schema, table = {}, None, None
    for i in range(200):
        minute = f"2026-01-01 00:{i // 5:02d}:00"
        want[minute[11:16]] = i
        # each minute is changed by five batches, and the one before it once more
        rows = [(minute, "a", i, 1.0)] + ([(f"2026-01-01 00:{i // 5 - 1:02d}:00", "a", 1000 + i, 1.0)] if i % 5 == 0 and i else [])
        if len(rows) > 1:
            want[rows[1][0][11:16]] = 1000 + i
        schema = batch(spark, target, i, rows)
        if i % 20 == 19:
            table = table or UpdatedTable(spark, target, schema, KEYS, "minute")
            table.compact(f"2026-01-01 00:{max(0, i // 5 - 2):02d}:00")
    assert state(table) == sorted((m, "a", n) for m, n in want.items())
    base, live = table.folders()
    assert len(live) == 1 and len(base) == 10
    assert state(table, since=at("00:38")) == [("00:38", "a", 1195), ("00:39", "a", 199)]
    plan = table.read(since=at("00:38"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "_base" not in plan
    assert sum(n.startswith("batch=") for n in table._children(target)) <= 40  # the others are gone


def test_readers_that_started_before_keep_their_files(spark):
    target = fresh_path(spark, "updates")
    schema = batch(spark, target, 0, [("2026-01-01 00:00:00", "a", 1, 1.0)])
    table = UpdatedTable(spark, target, schema, KEYS, "minute")
    early = table.read()
    batch(spark, target, 1, [("2026-01-01 00:00:00", "a", 2, 1.0), (None, "a", 5, 1.0)])
    table.compact("2026-01-01 00:00:00")
    assert early.count() == 1 and state(table) == [("", "a", 5), ("00:00", "a", 2)]
    assert table.compact("2026-01-01 00:00:00")["number"] == 2 and state(table) == [("", "a", 5), ("00:00", "a", 2)]


def test_failed_compactions_and_unfinished_batches_do_not_count(spark):
    target = fresh_path(spark, "updates")
    schema = batch(spark, target, 0, [("2026-01-01 00:00:00", "a", 1, 1.0)])
    table = UpdatedTable(spark, target, schema, KEYS, "minute")
    batch(spark, target, 1, [("2026-01-01 00:05:00", "a", 2, 1.0)])
    table._fs.delete(table._path(f"{target}/batch=1/_SUCCESS"), False)
    batch(spark, f"{target}/_base", 7, [("2026-01-01 00:09:00", "x", 9, 9.0)])  # of a compaction that never committed
    assert state(table) == [("00:00", "a", 1)] and table.manifest()["number"] == 0
    empty = UpdatedTable(spark, fresh_path(spark, "nothing"), schema, KEYS, "minute")
    assert empty.read().count() == 0 and empty.compact("2026-01-01 00:00:00")["number"] == 0


def test_stream_goes_on_after_compaction(spark, tmp_path):
    place = {"target": str(tmp_path / "out"), "checkpoint": str(tmp_path / "state")}
    table = None
    rows = []
    for i in range(6):
        new = [(f"2026-01-01 00:{i * 10 + j:02d}:30", "a", float(j)) for j in range(4)] + [(f"2026-01-01 00:{i * 10:02d}:59", "a", 5.0)]
        rows += new
        df = spark.createDataFrame(new, "ts string, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp"))
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = jobs.minute_metrics(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")))
        jobs.run_updates(stream, KEYS, "m", **place)
        table = table or UpdatedTable(spark, place["target"], stream.schema, KEYS, "minute")
        table.compact(f"2026-01-01 00:{max(0, i * 10 - 10):02d}:00")
    all_rows = spark.createDataFrame(rows, "ts string, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp"))
    want = all_rows.groupBy(F.date_trunc("minute", "ts").alias("minute"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    assert sorted(map(tuple, table.read().collect())) == sorted(map(tuple, want.collect()))

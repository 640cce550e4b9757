"""Streams give the batch results, over several files and repeated deliveries."""

from pyspark.sql import functions as F

from bazaarlens.streaming import jobs


def deliveries(spark, tmp_path, rows, files):
    schema = "k string, ts timestamp, event_type string, value double"
    for i in range(files):
        spark.createDataFrame(rows[i::files], schema.replace("timestamp", "string")).withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return spark.readStream.schema(schema).parquet(str(tmp_path / "in"))


def test_repeats_are_dropped(spark, tmp_path):
    rows = [(f"k{i % 50}", f"2026-01-01 00:{i % 50:02d}:00", "a", 1.0) for i in range(300)]
    stream = jobs.ingest_once(deliveries(spark, tmp_path, rows, 3), ["k"], "ts")
    assert jobs.run_to_end(stream, "once").count() == 50


def test_minutes_match_batch(spark, tmp_path):
    rows = [("k", f"2026-01-01 {h:02d}:{m:02d}:{s:02d}", "ab"[s % 2], float(s)) for h in range(2) for m in range(60) for s in (1, 20, 40)]
    out = jobs.run_to_end(jobs.minute_metrics(deliveries(spark, tmp_path, rows, 2)), "minutes")
    batch = spark.read.parquet(str(tmp_path / "in")).groupBy(F.date_trunc("minute", "ts").alias("minute"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    last = F.lit("2026-01-01 01:49:40").cast("timestamp")
    want = batch.filter(F.col("minute") + F.expr("interval 1 minute") <= last)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, want.collect())) and out.count() > 100


def test_batch_function(spark, tmp_path):
    seen = []
    jobs.upsert_batches(deliveries(spark, tmp_path, [("k", "2026-01-01 00:00:00", "a", 1.0)], 1), lambda df, i: seen.append(df.count()), "b")
    assert sum(seen) == 1


def test_table_of_many_files(spark, tmp_path):
    spark.range(100).repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    assert jobs.run_to_end(jobs.stream_table(spark, str(tmp_path), "events"), "many").count() == 100


def test_streams_go_on_after_a_stop(spark, tmp_path):
    """A second run of the same job sees only new files and still knows the keys of the first."""
    rows = [(f"k{i}", "2026-01-01 00:00:30", "a", 1.0) for i in range(20)]
    place = {"target": str(tmp_path / "out"), "checkpoint": str(tmp_path / "state")}
    first = jobs.run_to_end(jobs.ingest_once(deliveries(spark, tmp_path, rows, 2), ["k"], "ts"), "once", **place)
    assert first.count() == 20
    again = jobs.ingest_once(deliveries(spark, tmp_path, rows[:9] + [("new", "2026-01-01 00:05:00", "a", 1.0)], 1), ["k"], "ts")
    assert sorted(r.k for r in jobs.run_to_end(again, "once", **place).collect()) == sorted({r[0] for r in rows} | {"new"})
    assert jobs.run_to_end(again, "once", **place).count() == 21


def test_open_minutes_are_given_and_go_on(spark, tmp_path):
    place = {"target": str(tmp_path / "out"), "checkpoint": str(tmp_path / "state")}
    keys = ["minute", "event_type"]

    def run(rows):
        stream = jobs.minute_metrics(deliveries(spark, tmp_path, rows, 1))
        return {r.minute.minute: (r.n, r.total) for r in jobs.run_updates(stream, keys, "m", **place).collect()}

    assert run([("k", "2026-01-01 00:00:10", "a", 1.0), ("k", "2026-01-01 00:01:10", "a", 2.0)]) == {0: (1, 1.0), 1: (1, 2.0)}
    assert run([("k", "2026-01-01 00:01:50", "a", 5.0)]) == {0: (1, 1.0), 1: (2, 7.0)}


def test_batches_go_on_after_a_stop(spark, tmp_path):
    seen = []
    for i in range(2):
        stream = deliveries(spark, tmp_path, [("k", f"2026-01-01 00:00:0{i}", "a", float(i))], 1)
        jobs.upsert_batches(stream, lambda df, _: seen.extend(r.value for r in df.collect()), "b", str(tmp_path / "state"))
    assert seen == [0.0, 1.0]

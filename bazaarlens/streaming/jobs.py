"""Streaming versions of the incremental needs: tag on arrival, idempotent ingest, minute metrics."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from bazaarlens.operators.dedup import latest_by, newest
from bazaarlens.session import fresh_path


def stream_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table as a stream, whether it is a folder of files or a single file."""
    path = f"{folder.rstrip('/')}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isDirectory():
        return reader.parquet(path)
    # a file stream watches folders
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def run_to_end(stream: DataFrame, name: str, target: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Process all available input into a Parquet table and read it.

    Give ``target`` and ``checkpoint``, both in a folder that the cluster shares, for a stream that goes on: a
    later call with the same two resumes after the last committed batch and remembers its state. Without them
    the call is a run of its own below the work folder.
    """
    spark = stream.sparkSession
    out, state = target or fresh_path(spark, name), checkpoint or fresh_path(spark, f"{name}-state")
    query = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", state)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def run_updates(
    stream: DataFrame, keys: Sequence[str], name: str, target: str | None = None, checkpoint: str | None = None
) -> DataFrame:
    """Process all available input of an aggregation; the newest row of every key, also of those still open.

    Every batch writes the rows that it changed into a folder of its own, which a repeated batch overwrites.
    ``target`` and ``checkpoint`` as in ``run_to_end``.
    """
    spark = stream.sparkSession
    out, state = target or fresh_path(spark, name), checkpoint or fresh_path(spark, f"{name}-state")

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", state)
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    schema = StructType([*stream.schema.fields, StructField("batch", LongType())])
    return latest_by(spark.read.schema(schema).parquet(out), keys, newest("batch")).drop("batch")


def tag_on_arrival(stream: DataFrame, tagger: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply a stateless tagger: the batch columns run on the stream unchanged."""
    return tagger(stream)


def ingest_once(stream: DataFrame, keys: Sequence[str], time_col: str, delay: str = "1 day") -> DataFrame:
    """Drop repeated deliveries of a key; the watermark bounds the remembered keys."""
    return stream.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(list(keys))


def minute_metrics(stream: DataFrame, time_col: str = "ts", value: str = "value", delay: str = "10 minutes") -> DataFrame:
    """Events and value per minute and type.

    ``run_to_end`` gives the minutes that the watermark has passed, which are final; ``run_updates`` gives all.
    """
    return (
        stream.withWatermark(time_col, delay)
        .groupBy(F.window(time_col, "1 minute").alias("w"), "event_type")
        .agg(F.count("*").alias("n"), F.sum(F.col(value).cast("decimal(18,2)")).cast("double").alias("total"))
        .select(F.col("w.start").alias("minute"), "event_type", "n", "total")
    )


def upsert_batches(
    stream: DataFrame, write: Callable[[DataFrame, int], None], name: str, checkpoint: str | None = None
) -> None:
    """Run a batch function per micro-batch, for steps that need joins such as the cascade.

    With a ``checkpoint`` a later call goes on after the last batch that ended.
    """
    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint or fresh_path(stream.sparkSession, f"{name}-state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()

"""Table scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def tune(spark: SparkSession) -> None:
    """Let adaptive execution split a skewed join side even when that adds a shuffle."""
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table; the columns a query uses and its filters reach the scan."""
    tune(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def exists(spark: SparkSession, path: str) -> bool:
    """Is there a file or folder? Any other trouble with the path is an error."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def load_posts(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df

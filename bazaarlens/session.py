"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "bazaarlens", cpus: str = "*", shuffle: int = 8) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.adaptive.enabled", "true")
        # small test tables would otherwise end in one task per stage
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def work_folder(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables and stream checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master, whose
    single machine is the whole cluster, may fall back to a temporary folder.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="bazaarlens-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the work folder that no other run uses."""
    return f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def frees_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes inside give their shuffle files back when they end, not when the driver's JVM collects their plans."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _written(df: DataFrame, path: str) -> DataFrame:
    with frees_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the work folder and read it back.

    Cuts the lineage of a frame that several branches read, keeps it columnar and
    prunable, and survives the loss of executors. Its shuffles leave the disk with the end of the writing.
    """
    return _written(df, fresh_path(df.sparkSession, name))


@contextmanager
def interim(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A ``settle`` for tables that only writes inside read; they are deleted at the end, also after an error."""
    folder = fresh_path(spark, "interim")
    try:
        yield lambda df, name: _written(df, f"{folder}/{name}-{uuid.uuid4().hex}")
    finally:
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)

"""A table that takes each key once, without moving what it holds.

The table is bucketed by a digest of its key columns, so an insert shuffles the delivery alone: the scan of the held
digests is already dealt by bucket. Every delivery is a partition of its own, written with dynamic overwrite. Repeating
a delivery replaces that partition, and deliveries (or bucket shares of one) can be written at the same time, as each
has its own staging folder and is put in place by one rename.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bazaarlens.operators.dedup import first_by

BUCKETS = 64


def key_digest(keys: Sequence[str]) -> Column:
    """SHA-256 over the named values; NULL is a value of its own."""
    # a NULL field is left out of the object, which no value is
    return F.unhex(F.sha2(F.to_json(F.struct(*keys)), 256))


class KeyedTable:
    """Rows of ``schema`` below ``path``, at most one for each combination of ``keys``; NULL equals NULL.

    The folder holds everything; a session only registers it. ``schema``, ``keys`` and ``buckets`` must be those the
    folder was made with. Columns named row_key or delivery are taken.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], buckets: int = BUCKETS):
        taken = {"row_key", "delivery"} & set(schema.names)
        if taken:
            raise ValueError(f"columns {sorted(taken)} are the table's own")
        self.spark, self.schema, self.keys, self.buckets = spark, schema, list(keys), buckets
        self.name = f"keyed_{hashlib.sha256(path.encode()).hexdigest()[:24]}"
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(place)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}, row_key BINARY, delivery STRING) USING parquet "
            "OPTIONS (partitionOverwriteMode 'dynamic') "
            f"PARTITIONED BY (delivery) CLUSTERED BY (row_key) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def _held(self) -> DataFrame:
        # other sessions may have written since
        self.spark.catalog.recoverPartitions(self.name)
        return self.spark.table(self.name)

    def read(self) -> DataFrame:
        return self._held().select(*self.schema.names)

    def new_rows(self, df: DataFrame, delivery: str, order: Sequence[Column], share: tuple[int, int] = (0, 1)) -> DataFrame:
        """One row per key of ``df`` that no other delivery has brought, the first by ``order``.

        ``share`` (i, n) takes only the keys of every n-th bucket, beginning with the i-th.
        """
        part, parts = share
        keyed = df.select(*self.schema.names).withColumn("row_key", key_digest(self.keys))
        if parts > 1:
            keyed = keyed.filter(F.pmod(F.hash("row_key"), F.lit(self.buckets)) % parts == part)
        fresh = first_by(keyed.repartition(self.buckets, "row_key"), ["row_key"], order)
        held = self._held().filter(F.col("delivery") != self._partition(delivery, share)).select("row_key")
        return fresh.join(held, "row_key", "left_anti").withColumn("delivery", F.lit(self._partition(delivery, share)))

    def insert(self, df: DataFrame, delivery: str, order: Sequence[Column], share: tuple[int, int] = (0, 1)) -> None:
        """Add the rows of a delivery whose keys are new.

        The delivery names itself: the same name again replaces what it brought before, so a run that failed is
        simply repeated. Shares of one delivery may run at the same time, as their keys differ; different deliveries
        may too if they cannot bring the same new key.
        """
        rows = self.new_rows(df, delivery, order, share).select(*self.schema.names, "row_key", "delivery")
        rows.write.mode("overwrite").insertInto(self.name)

    @staticmethod
    def _partition(delivery: str, share: tuple[int, int]) -> str:
        return delivery if share[1] == 1 else f"{delivery}.{share[0]}of{share[1]}"

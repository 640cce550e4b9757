"""Keeping the output of an updating stream small.

``run_updates`` writes one folder per batch, so a reader would open more of them every hour. Compaction moves keys that
can no longer change (minutes the watermark has passed) to a base that is never written again, and merges what the
live batches say about the others into one folder. A manifest says which folders count; it is put in place by one
rename, after all data are written. A reader opens the base it needs, one live folder and the batches since.

Folders that a new manifest leaves out are retired with it and deleted by the compaction after next, so readers that
started before keep their files. A compaction that fails leaves folders that no manifest names, and nothing else.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from bazaarlens.operators.dedup import latest_by, newest

EMPTY = {"number": 0, "upto": -1, "base": [], "live": [], "retired": [], "closed": None}


class UpdatedTable:
    """What ``run_updates`` wrote to ``target``: the newest row of every key, with bounded numbers of folders.

    ``keys`` hold ``time``, the column whose old values are closed. One compaction at a time; the stream may run on.
    """

    def __init__(self, spark: SparkSession, target: str, schema: StructType, keys: Sequence[str], time: str):
        self.spark, self.target, self.keys, self.time = spark, target.rstrip("/"), list(keys), time
        self.schema = StructType([*schema.fields, StructField("batch", LongType())])
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.target).getFileSystem(spark._jsc.hadoopConfiguration())

    def _children(self, folder: str) -> list[str]:
        place = self._path(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(place)] if self._fs.exists(place) else []

    def manifest(self) -> dict:
        """The newest one; before the first compaction an empty one."""
        names = sorted(n for n in self._children(f"{self.target}/_manifests") if n.endswith(".json"))
        if not names:
            return dict(EMPTY)
        return json.loads("".join(r.value for r in self.spark.read.text(f"{self.target}/_manifests/{names[-1]}").collect()))

    def _batches(self, after: int) -> list[int]:
        """Finished batches beyond the manifest."""
        numbers = [int(n.split("=")[1]) for n in self._children(self.target) if n.startswith("batch=")]
        return sorted(n for n in numbers if n > after and self._fs.exists(self._path(f"{self.target}/batch={n}/_SUCCESS")))

    def folders(self, manifest: dict | None = None) -> tuple[list[str], list[str]]:
        """The folders that a read opens: closed ones, and those that may repeat a key."""
        now = manifest or self.manifest()
        return now["base"], [*now["live"], *[f"{self.target}/batch={n}" for n in self._batches(now["upto"])]]

    def _rows(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        # folders of the stream carry their number in the name, those made here in a column
        found = [self.spark.read.schema(self.schema).option("basePath", self.target).parquet(p) if "/batch=" in p else self.spark.read.schema(self.schema).parquet(p) for p in paths]
        out = found[0]
        for f in found[1:]:
            out = out.unionByName(f)
        return out

    def _open_rows(self, live: list[str]) -> DataFrame:
        return latest_by(self._rows(live), self.keys, newest("batch"))

    def read(self, since: Column | None = None) -> DataFrame:
        """The newest row of every key; with ``since`` only those at or after that time.

        A read of times after the last closed one opens live folders alone.
        """
        now = self.manifest()
        base, live = self.folders(now)
        rows = self._open_rows(live)
        if since is not None:
            rows = rows.filter(F.col(self.time) >= since)
            closed = F.lit(now["closed"]).cast(self.schema[self.time].dataType)
            if now["closed"] is None or self.spark.range(1).select(since >= closed).first()[0]:
                base = []
        if base:
            old = self._rows(base)
            rows = rows.unionByName(old if since is None else old.filter(F.col(self.time) >= since))
        return rows.drop("batch")

    def compact(self, closed: str) -> dict:
        """Close all times before ``closed``, merge the live batches, and return the new manifest.

        Only times that the stream's watermark has passed may be closed: a later batch must not change them. A time
        that went back would open closed rows again, so the latest one ever given holds.
        """
        now = self.manifest()
        if now["closed"] is not None and now["closed"] > closed:
            closed = now["closed"]
        batches = self._batches(now["upto"])
        _, live = self.folders(now)
        mark = uuid.uuid4().hex
        old, fresh = f"{self.target}/_base/{mark}", f"{self.target}/_live/{mark}"
        if not live:
            return now
        rows = self._open_rows(live)
        before = F.col(self.time) < F.lit(closed).cast(self.schema[self.time].dataType)
        rows.filter(before).write.parquet(old)
        rows.filter(~F.coalesce(before, F.lit(False))).write.parquet(fresh)
        done = {
            "number": now["number"] + 1,
            "upto": batches[-1] if batches else now["upto"],
            "base": [*now["base"], old],
            "live": [fresh],
            "retired": live,
            "closed": closed,
        }
        self._commit(done)
        for folder in now["retired"]:
            self._fs.delete(self._path(folder), True)
        return done

    def _commit(self, manifest: dict) -> None:
        folder = f"{self.target}/_manifests"
        self._fs.mkdirs(self._path(folder))
        draft = self._path(f"{folder}/.{uuid.uuid4().hex}")
        out = self._fs.create(draft)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        if not self._fs.rename(draft, self._path(f"{folder}/{manifest['number']:012d}.json")):
            raise RuntimeError(f"another compaction of {self.target} was quicker")

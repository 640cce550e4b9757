"""Tags that follow their posts: keyed state that sends a post to the tagger again whenever its tags are out of date.

Posts, product links and dictionary versions arrive as events in any order. State keeps the newest post and links of
each key, and with which version and links it was last sent. A link that comes late upgrades the tags of a post, one
that comes early waits for its post; a new dictionary version sends every remembered post again. Keys are dealt to
buckets, and a version event goes to each bucket, so a version reaches all posts without a list of them.

State expires ``lifetime`` after a post's last event, which bounds it; older posts are for ``retag_outdated`` on the table.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Container, Iterator, Sequence
from hashlib import md5
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from bazaarlens.operators.dedup import latest_by, newest
from bazaarlens.session import fresh_path

EVENT = "kind string, key string, at long, body string"
DUE = "key string, body string, link string, tag_dict_version string"
BUCKETS = 256
#: Posts that are read from the state, or handed on, together.
CHUNK = 1000
#: Characters of the records that a task holds back before it writes them to the state.
ROOM = 1 << 24
#: The only store that keeps several states, and no batches without input: with a lifetime, one would follow another forever.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    # a page of the state is one message, which has to fit in memory
    "spark.sql.execution.arrow.transformWithStateInPySpark.maxStateRecordsPerBatch": str(CHUNK),
}


def post_events(posts: DataFrame, key: str, at: Column, fields: Sequence[str]) -> DataFrame:
    """New or changed posts. Of several events of a key the largest ``at`` counts, then the larger text."""
    return posts.select(F.lit("post").alias("kind"), F.col(key).cast("string").alias("key"), at.cast("long").alias("at"), F.to_json(F.struct(*fields)).alias("body"))


def link_events(links: DataFrame, key: str, at: Column, products: str) -> DataFrame:
    """All products of a post as an array; the newest event replaces older ones."""
    return links.select(F.lit("link").alias("kind"), F.col(key).cast("string").alias("key"), at.cast("long").alias("at"), F.to_json(F.col(products)).alias("body"))


def version_event(spark: SparkSession, version: str, at: int) -> DataFrame:
    return spark.createDataFrame([("version", None, at, version)], EVENT)


class TagState(StatefulProcessor):
    """The posts of a bucket. Result rows are the posts whose tags are due.

    Every batch sends what it makes due, so before a batch each post was sent as it is held, with the version held: a post
    is due if its text or links differ from those before the batch, and all posts are due if the version does. Nothing
    has to be marked as sent. Each call to the state is a message to the JVM and back, so a post is read and written
    once for many events, and a new version reads the whole bucket in pages.
    """

    def __init__(self, lifetime_ms: int | None):
        self.lifetime_ms = lifetime_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.version = handle.getValueState("version", "at long, name string")
        # the last two are not used any more; with them, checkpoints from before still open
        record = "post_at long, post string, link_at long, link string, sent_version string, sent string"
        self.posts = handle.getMapState("posts", "key string", record, self.lifetime_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        at, version = self.version.get() if self.version.exists() else (None, None)
        before, empty = version, not self.posts.exists()
        marks: dict[str, bytes | None] = {}  # of the keys with events, as they were before the batch
        held: dict[str, tuple] = {}  # their records; beyond ROOM they are in the state only
        room = ROOM
        for chunk in rows:
            for kind, k, when, body in chunk[["kind", "key", "at", "body"]].itertuples(index=False, name=None):
                if kind == "version":
                    if version is None or (when, body) > (at, version):
                        at, version = when, body
                    continue
                if k not in held:
                    if room < 0:
                        self._write(held)
                        held, room = {}, ROOM
                    known = k in marks or not empty and self.posts.containsKey((k,))
                    held[k] = tuple(self.posts.getValue((k,))) if known else (None,) * 6
                    marks.setdefault(k, _mark(held[k]))
                    room -= len(held[k][1] or "")
                held[k] = _merged(held[k], kind, when, body)
                room -= len(body or "")
        self._write(held)
        if version != before:
            self.version.update((at, version))
            yield from self._sent(self._all(marks), version)
        else:
            yield from self._sent(self._changed(marks, held), version)

    def _write(self, records: dict[str, tuple]) -> None:
        for k, record in records.items():
            self.posts.updateValue((k,), record)

    def _all(self, written: Container[str]) -> Iterator[tuple[str, tuple]]:
        for (k,), record in self.posts.iterator():
            if record[1] is not None and self.lifetime_ms is not None and k not in written:
                self.posts.updateValue((k,), record)  # a version counts as an event of the post
            yield k, record

    def _changed(self, marks: dict[str, bytes | None], held: dict[str, tuple]) -> Iterator[tuple[str, tuple]]:
        for k in sorted(marks):
            record = held[k] if k in held else self.posts.getValue((k,))
            if _mark(record) != marks[k]:
                yield k, record

    @staticmethod
    def _sent(due: Iterator[tuple[str, tuple]], version: str | None) -> Iterator[pd.DataFrame]:
        rows = ((k, post, link, version) for k, (_, post, _, link, *_) in due if post is not None)
        while out := list(islice(rows, CHUNK)):
            yield pd.DataFrame(out, columns=["key", "body", "link", "tag_dict_version"], dtype="object")

    def close(self) -> None:
        pass


def _merged(record: tuple, kind: str, when: int, body: str) -> tuple:
    post_at, post, link_at, link, *rest = record
    if kind == "post" and (post is None or (when, body) > (post_at, post)):
        post_at, post = when, body
    elif kind == "link" and (link is None or (when, body) > (link_at, link)):
        link_at, link = when, body
    return (post_at, post, link_at, link, *rest)


def _mark(record: tuple) -> bytes | None:
    """Tells texts and links apart; None without a text."""
    return None if record[1] is None else md5(json.dumps([record[1], record[3]]).encode()).digest()


def due_posts(events: DataFrame, buckets: int = BUCKETS, lifetime: str | None = "90 days") -> DataFrame:
    """Posts to tag (key, body, link, tag_dict_version) from a stream of ``EVENT`` rows; rows without a key are left out."""
    seconds = None if lifetime is None else pd.Timedelta(lifetime).total_seconds()
    mine = F.array(F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int"))
    every = F.sequence(F.lit(0), F.lit(buckets - 1))
    dealt = events.filter("kind = 'version' or key is not null").withColumn("bucket", F.explode(F.when(F.col("kind") == "version", every).otherwise(mine)))
    state = TagState(None if seconds is None else int(seconds * 1000))
    return dealt.groupBy("bucket").transformWithStateInPandas(state, DUE, "Update", "None" if seconds is None else "ProcessingTime")


def run_retag(
    events: DataFrame, fields: StructType, key: str, products: str, tagger: Callable[[DataFrame], DataFrame], target: str, checkpoint: str,
    buckets: int = BUCKETS, lifetime: str | None = "90 days",
) -> None:
    """Process all available events; every batch writes the newly tagged posts to a folder of its own below ``target``.

    ``tagger`` gets key, ``fields``, ``products`` (array of bigint, empty if unknown) and tag_dict_version as an ordinary
    table, so it may join. Called again with the same two folders it goes on after the last committed batch; a
    repeated batch overwrites its folder. ``read_tags`` gives the newest tags of every post.
    """
    spark = events.sparkSession

    def write(rows: DataFrame, batch: int) -> None:
        posts = rows.select(
            F.col("key").cast(fields[key].dataType).alias(key),
            *[F.from_json("body", fields)[f].alias(f) for f in fields.names if f != key],
            F.coalesce(F.from_json("link", "array<bigint>"), F.array().cast("array<bigint>")).alias(products),
            "tag_dict_version",
        )
        tagger(posts).write.mode("overwrite").parquet(f"{target}/batch={batch}")

    before = {k: spark.conf.get(k) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    try:  # a started query has its own copy of the settings
        query = due_posts(events, buckets, lifetime).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("update").trigger(availableNow=True).start()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    query.awaitTermination()


def read_tags(spark: SparkSession, target: str, key: str) -> DataFrame:
    """The newest row of every post."""
    return latest_by(spark.read.parquet(target), [key], newest("batch")).drop("batch")


def run_phases(spark: SparkSession, phases: Sequence[DataFrame], **how) -> DataFrame:
    """Deliver tables of events one after another, with a new run of the stream after each, and read the tags."""
    inbox, target, checkpoint = (fresh_path(spark, n) for n in ("retag-in", "retag-out", "retag-state"))
    for events in phases:
        events.write.mode("append").parquet(inbox)
        run_retag(spark.readStream.schema(EVENT).parquet(inbox), target=target, checkpoint=checkpoint, **how)
    return read_tags(spark, target, how["key"])

"""Tags follow late links, changed posts and new dictionaries, over restarts and like the batch path."""

import random
from collections import Counter
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from bazaarlens.operators.cascade import retag_outdated
from bazaarlens.session import fresh_path
from bazaarlens.streaming import retag

POST = "id long, text string"


def tagger(rows):
    linked = F.size("products") > 0
    return rows.select(
        "id", "text", "products", F.when(linked, "link").otherwise("rule").alias("category_source"),
        F.concat_ws("/", F.when(linked, F.col("products")[0].cast("string")).otherwise(F.col("text")), "tag_dict_version").alias("tag"), "tag_dict_version",
    )


class Feed:
    """A stream that is stopped after every delivery."""

    def __init__(self, spark, lifetime="90 days"):
        self.spark, self.lifetime = spark, lifetime
        self.inbox, self.target, self.checkpoint = (fresh_path(spark, n) for n in ("feed", "feed-out", "feed-state"))

    def deliver(self, *events):
        for e in events:
            e.coalesce(1).write.mode("append").parquet(self.inbox)
        stream = self.spark.readStream.schema(retag.EVENT).parquet(self.inbox)
        schema = self.spark.createDataFrame([], POST).schema
        retag.run_retag(stream, schema, "id", "products", tagger, self.target, self.checkpoint, 4, self.lifetime)
        return {r.id: (r.tag, len(r.products)) for r in retag.read_tags(self.spark, self.target, "id").collect()}

    def batches(self):
        return self.spark.read.parquet(self.target).groupBy("batch").count().count()

    def posts(self, rows, at):
        return retag.post_events(self.spark.createDataFrame(rows, POST), "id", F.lit(at), ["text"])

    def links(self, rows, at):
        return retag.link_events(self.spark.createDataFrame(rows, "id long, p array<long>"), "id", F.lit(at), "p")

    def version(self, name, at):
        return retag.version_event(self.spark, name, at)


@pytest.mark.parametrize("lifetime", ["90 days", None])
def test_late_and_early_links_and_a_new_dictionary(spark, lifetime):
    feed = Feed(spark, lifetime)
    got = feed.deliver(feed.version("v1", 1), feed.posts([(1, "a"), (2, "b"), (3, None)], 1), feed.links([(9, [90])], 1))
    assert got == {1: ("a/v1", 0), 2: ("b/v1", 0), 3: ("v1", 0)}
    got = feed.deliver(feed.links([(2, [7, 8])], 2))
    assert got[2] == ("7/v1", 2) and got[1] == ("a/v1", 0)
    got = feed.deliver(feed.posts([(9, "late")], 3), feed.version("v2", 3))
    assert got == {1: ("a/v2", 0), 2: ("7/v2", 2), 3: ("v2", 0), 9: ("90/v2", 1)}
    # neither the versions of a post nor those of the dictionary go back
    got = feed.deliver(feed.version("v0", 0), feed.posts([(1, "old")], 0), feed.links([(2, [1])], 1))
    assert got == {1: ("a/v2", 0), 2: ("7/v2", 2), 3: ("v2", 0), 9: ("90/v2", 1)}


def test_repeats_send_nothing(spark):
    feed = Feed(spark)
    feed.deliver(feed.version("v1", 1), feed.posts([(1, "a"), (2, "b")], 1))
    rows = feed.spark.read.parquet(feed.target).count()
    feed.deliver(feed.version("v1", 5), feed.posts([(1, "a"), (2, "b")], 1))
    feed.deliver(feed.posts([(1, "a")], 9))
    assert feed.spark.read.parquet(feed.target).count() == rows == 2
    assert feed.deliver(feed.posts([(1, "changed")], 10))[1] == ("changed/v1", 0)


def test_like_the_batch_path(spark):
    feed = Feed(spark)
    posts = [(i, f"t{i % 3}") for i in range(300)]
    links = [(i, [i * 2]) for i in range(0, 300, 7)]
    feed.deliver(feed.version("v1", 1), feed.posts(posts[:200], 1), feed.links(links[:10], 1))
    feed.deliver(feed.links(links[10:], 2), feed.posts(posts[200:], 2))
    feed.deliver(feed.version("v2", 3))
    held = spark.createDataFrame([(i, t, [], "rule", t, "v1") for i, t in posts], "id long, text string, products array<long>, category_source string, tag string, tag_dict_version string")
    linked = spark.createDataFrame(links, "id long, p array<long>")
    now = held.join(linked, "id", "left").withColumn("products", F.coalesce("p", F.array().cast("array<bigint>"))).drop("p")
    want = retag_outdated(now.withColumnRenamed("products", "list_product_base_id"), "v2", lambda d: tagger(d.withColumnRenamed("list_product_base_id", "products").withColumn("tag_dict_version", F.lit("v2"))).withColumnRenamed("products", "list_product_base_id"))
    got = retag.read_tags(spark, feed.target, "id")
    cols = ["id", "category_source", "tag", "tag_dict_version"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))


def test_settings_are_given_back(spark):
    before = {k: spark.conf.get(k) for k in retag.SETTINGS}
    feed = Feed(spark)
    feed.deliver(feed.version("v1", 1), feed.posts([(None, "no key"), (1, "a")], 1))
    assert before == {k: spark.conf.get(k) for k in retag.SETTINGS}


class Held:
    """A bucket's state in memory, which counts the messages that Spark's would cost: one for each call or page."""

    def __init__(self):
        self.calls, self.version, self.posts = Counter(), {}, {}

    def getValueState(self, name, schema):
        return SimpleNamespace(exists=lambda: "v" in self.version, get=lambda: self.version["v"], update=lambda v: self.version.update(v=v))

    def getMapState(self, name, key_schema, schema, ttl):
        def counted(call, run):
            def do(*args):
                self.calls[call] += 1
                return run(*args)

            return do

        def pages(rows):
            for i, row in enumerate(sorted(rows)):
                self.calls["page"] += i % retag.CHUNK == 0
                yield row

        return SimpleNamespace(
            exists=counted("exists", lambda: bool(self.posts)), containsKey=counted("containsKey", lambda k: k in self.posts), getValue=counted("getValue", lambda k: self.posts[k]),
            updateValue=counted("updateValue", self.posts.__setitem__), iterator=lambda: pages(self.posts.items()), keys=lambda: pages(self.posts),
        )

    def batch(self, *chunks, lifetime=1000):
        """Rows sent, and messages about posts."""
        self.calls.clear()
        state = retag.TagState(lifetime)
        state.init(self)
        out = state.handleInputRows((0,), iter([pd.DataFrame(c, columns=["kind", "key", "at", "body"]) for c in chunks]), None)
        return [tuple(r) for d in out for r in d.itertuples(index=False)], sum(self.calls.values())


def test_messages_per_post():
    """A message is most of what a post costs: one write for a new one, one for a new version, and none if that has no lifetime to prolong."""
    bucket = Held()
    posts = [("post", f"k{i:04}", 1, f"text {i}") for i in range(2500)]
    sent, n = bucket.batch([("version", None, 1, "v1"), *posts[:2000]], posts[2000:])
    assert len(sent) == 2500 and n <= 2500 + 10
    sent, n = bucket.batch([("link", f"k{i:04}", 2, "[1]") for i in range(500)])
    assert len(sent) == 500 and n <= 3 * 500 + 10
    sent, n = bucket.batch([("version", None, 2, "v2")])
    assert {s[3] for s in sent} == {"v2"} and len(sent) == 2500 and n <= 2500 + 10
    sent, n = bucket.batch([("version", None, 3, "v3")], lifetime=None)
    assert len(sent) == 2500 and n <= 10


def test_a_version_prolongs_what_it_sends():
    """A post lives on from the last version that sent it; a link without a post does not."""
    bucket = Held()
    bucket.batch([("version", None, 1, "v1"), ("post", "a", 1, "x"), ("link", "b", 1, "[1]")])
    bucket.batch([("version", None, 2, "v2"), ("post", "c", 2, "y")])
    assert bucket.calls["updateValue"] == 2  # a for the version, c for its event


@pytest.mark.parametrize("room", [-1, 20, 1 << 24])
def test_one_row_per_post_and_batch(monkeypatch, room):
    """Whether a task holds the records of a batch or goes back to the state for them, over any number of chunks."""
    monkeypatch.setattr(retag, "ROOM", room, raising=False)
    bucket, rng = Held(), random.Random(1)
    post, link, sent_as, version = {}, {}, {}, None
    for at in range(12):
        chunks = [[(rng.choice(["post", "link"]), f"k{rng.randrange(9)}", rng.randrange(at, at + 3), rng.choice(["[1]", "[2]", "[2, 3]"])) for _ in range(6)] for _ in range(4)]
        if at in (0, 3, 7):
            chunks[2].append(("version", None, at, version := f"v{at}"))
        for kind, k, when, body in (e for c in chunks for e in c if e[0] != "version"):
            of = post if kind == "post" else link
            of[k] = max(of.get(k, (when, body)), (when, body))
        now = {k: (post[k][1], link[k][1] if k in link else None, version) for k in post}
        sent, _ = bucket.batch(*chunks)
        assert sorted(sent, key=str) == sorted(((k, *v) for k, v in now.items() if sent_as.get(k) != v), key=str)
        sent_as.update(now)
    # there and back within a batch is no change
    text = bucket.posts["k0",][1]
    assert bucket.batch([("post", "k0", 90, "other")], [("post", "k0", 91, text)])[0] == []

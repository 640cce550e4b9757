"""Trie of conversation prefixes by truncation peeling.

Every prefix of a conversation has a key that chains the digests of its turns. Peeling starts at the greatest depth:
conversations that end there join the nodes that survive from below, each node's last turn is stripped, and what is
left is grouped again as the next depth. Members, children, leaves and savings are added up on the way, so one descent
finds the nodes and finishes them.

Equal conversations count as one sequence with its ending ids. A subtree of at most ``SHARD`` sequences is peeled
inside one task, as a stream sorted by depth that holds two depths at a time. Larger nodes, near the root, are peeled
depth by depth with ordinary aggregations, so a turn that a third of all conversations share is never in one task.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.session import settle

#: Sequences of a subtree that one task peels.
SHARD = 1024
#: Ids of a piece of an ending list, and rows of a batch that is handed on.
PIECE, BATCH = 8192, 16384
ROOT = b""
NO_ENDS = hashlib.sha256(b"").hexdigest()
CHAIN = pa.schema([("conv", pa.int64()), ("depth", pa.int64()), ("key", pa.binary()), ("parent", pa.binary()), ("words", pa.int64()), ("ended", pa.bool_())])
PIECES = pa.schema([("key", pa.binary()), ("first", pa.int64()), ("n", pa.int64()), ("ids", pa.string())])
ENDS = pa.schema([("end_conv", pa.int64()), ("n_ended", pa.int64()), ("sha", pa.string())])
NODES = pa.schema(
    [("key", pa.binary()), ("depth", pa.int64()), ("parent", pa.binary()), ("is_top", pa.bool_()), ("conv", pa.int64()), ("parent_conv", pa.int64())]
    + [(c, pa.int64()) for c in ("n", "children", "leaves", "saved")]
    + [("sha", pa.string())]
)


def _ddl(schema: pa.Schema) -> str:
    names = {"int64": "long", "binary": "binary", "bool": "boolean", "string": "string"}
    return ", ".join(f"{f.name} {names[str(f.type)]}" for f in schema)


class _Out:
    """Rows of a schema, handed on in batches."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows = schema, []

    def ready(self, least: int = BATCH) -> Iterator[pa.RecordBatch]:
        if len(self.rows) >= least:
            columns = zip(*self.rows, strict=True) if self.rows else [()] * len(self.schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema)
            self.rows = []


def _streamed(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[batch[c].to_pylist() for c in columns], strict=True)


def borrowed(conv: int, most: int) -> int:
    """How many turns a conversation takes from the first of its group."""
    return zlib.crc32(str(conv).encode()) % most if most else 0


def _chains(most: int):
    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(CHAIN)
        base = conv = last = None
        head: list[tuple[bytes, int]] = []
        skip = 0

        def push(digest: bytes, words: int) -> None:
            nonlocal last
            out.rows.append((*last, False))
            _, depth, key, _, _ = last
            last = (conv, depth + 1, hashlib.blake2b(key + digest, digest_size=16).digest(), key, words)

        for at, other, c, digest, words in _streamed(batches, "base", "other", "conv", "digest", "words"):
            if c != conv or conv is None:
                if last:
                    out.rows.append((*last, True))
                    yield from out.ready()
                if at != base:
                    base, head = at, []
                conv, last, skip = c, (c, 0, ROOT, None, 0), 0
                if other:
                    skip = borrowed(c, most)
                    for turn in head[:skip]:
                        push(*turn)
            if not other and len(head) < most:
                head.append((digest, words))
            if skip:
                skip -= 1
            else:
                push(digest, words)
                yield from out.ready()
        if last:
            out.rows.append((*last, True))
        yield from out.ready(0)

    return chained


def _chained(turns: DataFrame, group: int, most: int) -> DataFrame:
    conv = turns["conv_id"].cast("long")
    role, text = (F.coalesce(turns[c], F.lit("")) for c in ("role", "text"))
    base = conv - conv % group if most else conv
    narrow = turns.filter(conv.isNotNull()).select(
        base.alias("base"),
        (conv != base).alias("other"),
        conv.alias("conv"),
        turns["turn"].alias("turn"),
        F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )
    ordered = narrow.repartition("base").sortWithinPartitions("base", "other", "conv", "turn", "digest")
    return ordered.mapInArrow(_chains(most), _ddl(CHAIN))


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = _Out(PIECES)
    at: bytes | None = None
    ids: list[int] = []
    for key, conv in _streamed(batches, "key", "conv"):
        if ids and (key != at or len(ids) >= PIECE):
            out.rows.append((at, ids[0], len(ids), ",".join(map(str, ids))))
            ids = []
            yield from out.ready(64)
        at = key
        ids.append(conv)
    if ids:
        out.rows.append((at, ids[0], len(ids), ",".join(map(str, ids))))
    yield from out.ready(0)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = _Out(ENDS)
    at = digest = None
    first = n = 0
    for key, least, count, ids in _streamed(batches, "key", "first", "n", "ids"):
        if at is None or key != at:
            if at is not None:
                out.rows.append((first, n, digest.hexdigest()))
                yield from out.ready()
            at, first, n, digest = key, least, 0, hashlib.sha256()
        digest.update(("," if n else "").encode() + ids.encode())
        n += count
    if at is not None:
        out.rows.append((first, n, digest.hexdigest()))
    yield from out.ready(0)


def _endings(chain: DataFrame) -> DataFrame:
    """end_conv (least of its sequence), n_ended, sha: the members of every sequence.

    Ids are listed by range, so a sequence with very many members is listed by many tasks; only finished pieces of the
    list meet, and they pass through the hash one by one.
    """
    ended = chain.filter("ended").select("key", "conv")
    pieces = ended.repartitionByRange("key", "conv").sortWithinPartitions("key", "conv").mapInArrow(_listed, _ddl(PIECES))
    return pieces.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_hashed, _ddl(ENDS))


def _peeled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Finished nodes of subtrees, from rows sorted by shard, falling depth and key."""
    out = _Out(NODES)
    shard = depth = run = None
    below: dict[bytes, list] = {}  # of the nodes of this depth, what their children add up to
    above: dict[bytes, list] = {}  # the same of their parents, so far

    def finish() -> None:
        key, parent, words, ended, conv, sha = run
        n, least, children, leaves, saved, rows = below.pop(key, None) or [0, None, 0, 0, 0, []]
        n += ended
        if ended and (least is None or conv < least):
            least = conv
        saved += (n - 1) * words
        leaves = leaves or 1
        out.rows += [(*r[:5], least, *r[6:]) for r in rows]
        row = (key, depth, parent, key == shard, least, None, n, children, leaves, saved, sha)
        if key == shard:
            out.rows.append(row)
            return
        up = above.setdefault(parent, [0, None, 0, 0, 0, []])
        up[0] += n
        up[1] = least if up[1] is None else min(up[1], least)
        up[2] += 1
        up[3] += leaves
        up[4] += saved
        up[5].append(row)

    for s, d, key, parent, words, ended, conv, sha in _streamed(batches, "shard", "depth", "key", "parent", "words", "n_ended", "conv", "sha"):
        if run is None or (s, d, key) != (shard, depth, run[0]):
            if run is not None:
                finish()
                yield from out.ready()
            if (s, d) != (shard, depth):
                below, above = (above if s == shard else {}), {}
            shard, depth, run = s, d, [key, parent, words, 0, None, None]
        if ended:
            run[3:] = ended, conv, sha
    if run is not None:
        finish()
    yield from out.ready(0)


def _sums(rows: DataFrame) -> DataFrame:
    """What the children in ``rows`` add to their parents."""
    return rows.groupBy(F.col("parent").alias("of")).agg(
        F.sum("n").alias("up_n"), F.min("conv").alias("up_conv"), F.count("*").alias("up_children"),
        F.sum("leaves").alias("up_leaves"), F.sum("saved").alias("up_saved"),
    )


def _added(rows: DataFrame, sums: DataFrame) -> DataFrame:
    """Heavy nodes with the sums of more children."""
    plus = lambda c: (F.col(c) + F.coalesce(F.col(f"up_{c}"), F.lit(0))).alias(c)
    return rows.join(sums, F.col("key") == F.col("of"), "left").select(
        "key", "depth", "parent", "words", "sha", F.least("conv", "up_conv").alias("conv"), *[plus(c) for c in ("n", "children", "leaves", "saved")]
    )


def _heavy_nodes(heavy: DataFrame, ended: DataFrame, tops: DataFrame) -> DataFrame | None:
    """Nodes above the shards, peeled depth by depth; None without any."""
    deepest = heavy.agg(F.max("depth")).first()[0]
    if deepest is None:
        return None
    own = ended.select(F.col("key").alias("of"), F.col("conv").alias("end_conv"), "n_ended", "sha")
    zero = [F.lit(0).cast("long").alias(c) for c in ("children", "leaves", "saved")]
    start = heavy.join(own, F.col("key") == F.col("of"), "left").select(
        "key", "depth", "parent", "words", "sha", F.col("end_conv").alias("conv"), F.coalesce("n_ended", F.lit(0)).alias("n"), *zero
    )
    start = settle(_added(start, _sums(tops)), "heavy-start")
    levels: list[DataFrame] = []
    for depth in range(deepest, -1, -1):
        here = start.filter(F.col("depth") == depth)
        if levels:
            here = _added(here, _sums(levels[-1]))
        levels.append(settle(here.withColumn("saved", F.col("saved") + (F.col("n") - 1) * F.col("words")), "heavy-level"))
    done = levels[0]
    for level in levels[1:]:
        done = done.unionByName(level)
    parents = done.select(F.col("key").alias("of"), F.col("conv").alias("parent_conv"))
    return done.join(parents, F.col("parent") == F.col("of"), "left")


def prefix_trie(turns: DataFrame, group: int = 1, most: int = 0, shard: int = SHARD) -> DataFrame:
    """One row per distinct prefix of the conversations of ``turns`` (conv_id, turn, role, text), the root included.

    conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (words that a prefix
    cache need not read again), ends_sha256 (of the sorted ids of conversations that end here), node (key as hex);
    the texts of a node are the first ``depth`` turns of its conv_id.

    With ``most``, a conversation c takes its first h = crc32(c) % most turns from conversation c - c % group and goes on
    with its own turns after its first h; without turns it still counts in the root. Turns are ordered by number, NULL
    first; rows that share a number follow each other by their digest, repeats stay. NULL role and text are empty.
    Rows without conv_id are left out; an empty table gives no rows; other columns, whatever their names, are not read.
    """
    chain = settle(_chained(turns, group, most), "chains")
    ends = settle(_endings(chain), "endings")
    # equal conversations go on as their least member
    members = chain.join(ends, F.col("conv") == F.col("end_conv")).select(
        "conv", "depth", "key", "parent", "words", "ended", F.when(F.col("ended"), F.col("n_ended")).alias("n_ended"), F.when(F.col("ended"), F.col("sha")).alias("sha")
    )
    members = settle(members, "sequences")
    heavy = settle(
        members.groupBy("key").agg(F.count("*").alias("sequences"), *[F.first(c).alias(c) for c in ("depth", "parent", "words")]).filter(F.col("sequences") > shard).drop("sequences"),
        "heavy",
    )
    light = members.join(heavy.select("key"), "key", "left_anti")
    tops = light.groupBy("conv").agg(F.min(F.struct("depth", "key"))["key"].alias("shard"))
    rows = light.join(tops, "conv").repartition("shard").sortWithinPartitions("shard", F.desc("depth"), "key")
    nodes = settle(rows.mapInArrow(_peeled, _ddl(NODES)), "nodes")
    ended = members.filter("ended").join(heavy.select("key"), "key", "left_semi")
    above = _heavy_nodes(heavy, ended, nodes.filter("is_top"))
    if above is None:
        return _result(nodes)
    parents = above.select(F.col("key").alias("of"), F.col("conv").alias("of_conv"))
    top = nodes.filter("is_top").join(parents, F.col("parent") == F.col("of"), "left").withColumn("parent_conv", F.col("of_conv"))
    return _result(nodes.filter("not is_top")).unionByName(_result(top)).unionByName(_result(above))


def _result(nodes: DataFrame) -> DataFrame:
    def column(name: str, as_: str) -> Column:
        return F.col(name).alias(as_)

    return nodes.select(
        column("conv", "conv_id"), "depth", column("parent_conv", "parent_conv_id"), column("n", "n_convs"), column("children", "n_children"),
        column("leaves", "n_leaves"), column("saved", "saved_tokens"), F.coalesce("sha", F.lit(NO_ENDS)).alias("ends_sha256"), F.lower(F.hex("key")).alias("node"),
    )

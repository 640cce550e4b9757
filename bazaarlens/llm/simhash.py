"""Near duplicates by SimHash: fingerprints within a few bits of each other, found in BK-trees.

The trees are sharded by equal bits. Cut into one block more than the radius, two fingerprints within the radius
agree in a block, so they meet in the shard of that block's value. A shard with more than ``SHARD`` fingerprints
is cut again by its other bits, which keeps every close pair together and must end: with ``n`` bits left a shard
cannot hold more than 2^n fingerprints. So each tree has a size bound at any input size, whatever the data.

In a tree, children hang on the integer distance to their parent; a search follows only edges within the radius of
its own distance. Links of a shard are kept as a spanning star; components are then found over all shards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.components import components
from bazaarlens.llm.tokens import release
from bazaarlens.session import settle

SHINGLE = 3
RADIUS = 2
SEED = 42
#: Fingerprints of a tree.
SHARD = 1024
BITS = 64


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """SimHash over word shingles, repeats included. Without words it is zero."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # of bytes: ASCII letters and blanks alone
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    stops = np.cumsum([len(w) + 1 for w in words]).tolist()
    starts = [0, *stops]
    joined, hash64, last = b" ".join(words), xxhash.xxh64_intdigest, min(shingle, len(words)) - 1
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 15):  # so many fit in 16 bits
        some = range(at, min(n, at + (1 << 15)))
        hashes = np.array([hash64(joined[starts[i] : stops[i + last] - 1], SEED) for i in some], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint16)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


class BKTree:
    """Distinct fingerprints; each child is keyed by its Hamming distance to the parent."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        at = 0
        if self.values:
            while True:
                d = (value ^ self.values[at]).bit_count()
                if d == 0:
                    return
                below = self.children[at].get(d)
                if below is None:
                    self.children[at][d] = len(self.values)
                    break
                at = below
        self.values.append(value)
        self.children.append({})

    def within(self, value: int, radius: int) -> list[int]:
        """Places of all fingerprints within the radius."""
        found, open_ = [], [0] if self.values else []
        values, children = self.values, self.children
        while open_:
            at = open_.pop()
            d = (value ^ values[at]).bit_count()
            if d <= radius:
                found.append(at)
            if edges := children[at]:
                low, high = d - radius, d + radius
                open_.extend([below for edge, below in edges.items() if low <= edge <= high])
        return found


def star(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Links of a shard, reduced to one link from each linked fingerprint to the least of its group."""
    tree = BKTree()
    for v in values:
        tree.add(v)
    parent = list(range(len(tree.values)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for i, v in enumerate(tree.values):
        for j in tree.within(v, radius):
            a, b = root(i), root(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
    return [(v, tree.values[root(i)]) for i, v in enumerate(tree.values) if root(i) != i]


def _cuts(free: list[int], parts: int) -> list[list[int]]:
    """The free bits in nearly equal blocks."""
    edge = [len(free) * i // parts for i in range(parts + 1)]
    return [free[a:b] for a, b in zip(edge, edge[1:], strict=False)]


def _masks(level: int, radius: int) -> list[tuple[int, int]]:
    """(mask, mask of the level before) of all shards of a level."""
    out = [(0, 0)]
    for _ in range(level):
        out = [
            (mask | sum(1 << b for b in block), mask)
            for mask, _ in out
            for block in _cuts([b for b in range(BITS) if not mask >> b & 1], radius + 1)
        ]
    return out


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _shards(rows: DataFrame, level: int, radius: int) -> DataFrame:
    """Fingerprints with the shards of a level that they belong to: mask, value, fp."""
    kinds = F.array(
        *[F.struct(F.lit(_signed(m)).cast("long").alias("mask"), F.lit(_signed(up)).cast("long").alias("up")) for m, up in _masks(level, radius)]
    )
    if level > 1:
        kinds = F.filter(kinds, lambda k: k["up"] == F.col("mask"))
    return rows.select("fp", F.explode(F.transform(kinds, lambda k: k["mask"])).alias("mask")).select(
        "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value"), "fp"
    )


def _search(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[int] = []
        key = None
        for batch in batches:
            out: list[tuple[int, int]] = []
            for mask, value, fp in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (mask, value) != key:
                    out += star(held, radius)
                    key, held = (mask, value), []
                held.append(fp & (1 << BITS) - 1)
            yield _links(out)
        yield _links(star(held, radius))

    return run


def _links(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    ends = [np.array(x, np.uint64).view(np.int64) for x in zip(*rows, strict=True)] or [np.zeros(0, np.int64)] * 2
    return pa.record_batch([pa.array(x) for x in ends], names=["a", "b"])


def close_links(fingerprints: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """Links (a, b) that connect just the distinct fingerprints (column fp, long) within the radius of each other."""
    rows, parts, level = fingerprints, [], 0
    while True:
        level += 1
        sharded = settle(_shards(rows, level, radius), "shards")
        sizes = settle(sharded.groupBy("mask", "value").agg(F.count("*").alias("n")).filter("n > 1"), "shard-sizes")
        held = sharded.join(sizes.filter(F.col("n") <= shard), ["mask", "value"]).select("mask", "value", "fp")
        keys = ["mask", "value"]
        parts.append(held.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_search(radius), "a long, b long"))
        large = sizes.filter(F.col("n") > shard)
        if large.isEmpty():
            break
        rows = sharded.join(large, ["mask", "value"], "left_semi").select("fp", "mask")
    links = parts[0]
    for more in parts[1:]:
        links = links.unionByName(more)
    return links


def _fingerprinted(docs: DataFrame, shingle: int, *others: Column) -> DataFrame:
    """doc_id, fp and ``others`` of every row, written to the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            doc_id, text, *rest = batch.columns
            fps = np.array([fingerprint(t.as_py() or "", shingle) for t in text], np.uint64)
            yield pa.record_batch([doc_id, pa.array(fps.view(np.int64)), *rest], names=["doc_id", "fp", *batch.schema.names[2:]])

    read = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"), *others)
    kinds = "".join(f", {f.name} {f.dataType.simpleString()}" for f in read.schema.fields[2:])
    return settle(read.mapInArrow(run, f"doc_id long, fp long{kinds}"), "fingerprints")


def _leasts(rows: DataFrame, least: Column, radius: int, shard: int) -> DataFrame:
    """fp and the minimum ``least`` (an aggregate) over its component, for every fingerprint of ``rows``."""
    nodes = settle(rows.groupBy("fp").agg(least.alias("own")), "nodes")
    roots = components(close_links(nodes.select("fp"), radius, shard)).withColumnRenamed("node", "fp")
    of = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    found = of.groupBy("root").agg(F.min("own").alias("least"))
    return of.select("fp", "root").join(found, "root").select("fp", "least")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row of ``docs``.

    component_id is the smallest doc_id that links of at most ``radius`` differing bits reach, its own included.
    NULL texts are empty; texts without words have fingerprint zero and link like any other. Equal fingerprints are
    one node, so copies cost nothing more; repeated rows keep their places in the result. A NULL doc_id is never a
    component_id unless the component has no other. An empty table gives no rows; other columns are not read.
    """
    rows = _fingerprinted(docs, shingle)
    named = _leasts(rows, F.min("doc_id"), radius, shard).withColumnRenamed("least", "component_id")
    return rows.join(named, "fp").select("doc_id", _hex(F.col("fp")).alias("fingerprint"), "component_id")


def _hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of ``docs`` for each component: that with the smallest doc_id, of several that with the least text hash.

    Rows with a NULL doc_id stay beside rows with one, as nothing says which document they are; of a component whose
    doc_ids are all NULL one row stays. Rows are told apart by a key that is written with them, so rows that share a
    doc_id, or repeat each other, are decided one by one.
    """
    key = "row_key"
    while key in {c.lower() for c in docs.columns}:
        key += "_"
    keyed = settle(docs.withColumn(key, F.monotonically_increasing_id()), "keyed")
    rows = _fingerprinted(keyed, shingle, F.xxhash64(keyed["text"]).alias("hash"), keyed[key].alias("key"))
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "hash", "key")
    leasts = _leasts(rows, F.min(order), radius, SHARD)
    spare = (F.col("key") != F.col("least.key")) & (F.col("doc_id").isNotNull() | F.col("least.unknown"))
    gone = settle(rows.join(leasts, "fp").filter(spare).select(F.col("key").alias("gone_key")), "near-dropped").hint("shuffle_hash")
    return keyed.join(gone, keyed[key] == gone["gone_key"], "left_anti").drop(key)

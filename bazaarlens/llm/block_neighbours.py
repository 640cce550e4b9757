"""Nearest neighbours by a block matrix join with int8 tiles.

Queries and candidates are cut into blocks. A tile multiplies int8 codes of a query block and a candidate block, which
gives every inner product with a bound of its quantisation error. Pairs whose upper bound cannot reach the best
lower bounds are left; the others are computed anew in double precision and kept in one heap per query. A task
takes one query block through a group of candidate blocks, so the heaps of earlier tiles prune later ones; the
heaps of all groups are merged last. No pair leaves a tile but the k best of each query.

Equal vectors are one candidate with its k + 1 smallest ids, which is all that ties can ask for. The result is exact.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.session import settle

K = 20
#: Queries that go through the candidates together, and how many of them meet a candidate block at once.
QUERY_BLOCK, TILE = 8192, 1024
BLOCK = 2048
#: Candidate blocks that one task takes a query block through.
GROUP = 4

_BLOCKS = "dim int, qb int, cg int, kind int, cb int, rows int, vectors binary, counts binary, ids binary"


def codes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes and scales of the rows of ``x``, and the lengths of what they stand for and of what they miss."""
    scale = np.abs(x).max(1) / 127
    scale[scale == 0] = 1.0
    with np.errstate(over="ignore", invalid="ignore"):
        code = np.clip(np.rint(np.nan_to_num(x / scale[:, None])), -127, 127)
        stands = code * scale[:, None]
        missed = np.sqrt(((x - stands) ** 2).sum(1))
        return code.astype(np.int8), scale, np.sqrt((stands**2).sum(1)), missed


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision, added from the first component to the last."""
    out = np.zeros(len(a))
    for d in range(a.shape[1]):
        out += a[:, d] * b[:, d]
    return out


class Tiles:
    """The heaps of one query block, fed with candidate blocks."""

    def __init__(self, queries: np.ndarray, own: np.ndarray, k: int):
        self.x, self.own, self.k = queries, own.tolist(), k
        self.code, self.scale, self.stands, self.missed = codes(queries)
        self.length = np.sqrt((queries**2).sum(1))
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in self.own]

    def _own_only(self, counts: np.ndarray, first: np.ndarray, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Queries and the candidates that are nothing but themselves: classes whose only id is the query's."""
        single = np.flatnonzero(counts == 1)
        held = ids[first[single]]
        order = np.argsort(held, kind="stable")
        low, high = (np.searchsorted(held[order], self.own, side) for side in ("left", "right"))
        for i in np.flatnonzero(high > low).tolist():
            yield i, single[order[low[i] : high[i]]]

    def add(self, y: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        code, scale, stands, missed = codes(y)
        # products of codes are whole numbers below 2^24 up to 1040 components: exact in single precision
        kind = np.float32 if y.shape[1] <= 1040 else np.float64
        near = (self.code.astype(kind) @ code.astype(kind).T).astype(float) * self.scale[:, None] * scale
        error = self.missed[:, None] * (stands + missed) + self.stands[:, None] * missed
        error += 1e-9 * self.length[:, None] * (stands + missed)  # rounding of the steps here
        first = np.cumsum(counts) - counts
        for i, own in self._own_only(counts, first, ids):
            near[i, own] = -np.inf
        # every other class has an id that counts, so the k-th best lower bound is a floor
        floor = np.full(len(self.x), -np.inf)
        if len(y) > self.k:
            floor = np.partition(near - error, len(y) - self.k, axis=1)[:, len(y) - self.k]
        full = [i for i, h in enumerate(self.heaps) if len(h) == self.k]
        floor[full] = np.maximum(floor[full], [self.heaps[i][0][0] for i in full])
        with np.errstate(invalid="ignore"):
            q, c = np.nonzero(~(near + error < floor[:, None]))
        for at in range(0, len(q), 1 << 16):
            some = slice(at, at + (1 << 16))
            score = inner(self.x[q[some]], y[c[some]])
            for i, j, s in zip(q[some].tolist(), c[some].tolist(), score.tolist(), strict=True):
                heap = self.heaps[i]
                if len(heap) == self.k and s < heap[0][0]:
                    continue
                for vec_id in ids[first[j] : first[j] + counts[j]].tolist():
                    if vec_id == self.own[i]:
                        continue
                    if len(heap) < self.k:
                        heapq.heappush(heap, (s, -vec_id))
                    elif (s, -vec_id) > heap[0]:
                        heapq.heapreplace(heap, (s, -vec_id))
                    else:
                        break  # further ids are larger

    def rows(self) -> tuple[list[int], list[int], list[float]]:
        found = [(own, -vec_id, s) for own, heap in zip(self.own, self.heaps, strict=True) for s, vec_id in heap]
        return tuple(map(list, zip(*found, strict=True))) if found else ([], [], [])


def _blocks(rows: DataFrame, by: list[str], wide: bool) -> DataFrame:
    """One row for each block of (v, ids): its vectors as one array, the ids of all, and how many each has."""

    def join(key: tuple[pa.Scalar, ...], frame: pa.Table) -> pa.Table:
        vectors = frame["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        ids = frame["ids"].combine_chunks()
        parts = [vectors.astype("<f8" if wide else "<f4"), ids.value_lengths().to_numpy().astype("<i4"), ids.flatten().to_numpy().astype("<i8")]
        return pa.table(
            [
                pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int32()), pa.array([len(frame)], pa.int32()),
                *[pa.array([p.tobytes()], pa.binary()) for p in parts],
            ],
            names=["dim", "block", "rows", "vectors", "counts", "ids"],
        )

    return rows.groupBy(*by).applyInArrow(join, "dim int, block int, rows int, vectors binary, counts binary, ids binary")


def _run(k: int, wide: bool):
    def read(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x = np.frombuffer(row["vectors"], "<f8" if wide else "<f4").astype(float).reshape(row["rows"], -1)
        return x, np.frombuffer(row["counts"], "<i4"), np.frombuffer(row["ids"], "<i8")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(tiles: Tiles) -> pa.RecordBatch:
            a, b, c = tiles.rows()
            return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.float64())], names=["query_id", "vec_id", "score"])

        tiles: list[Tiles] | None = None
        key = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in ("dim", "qb", "cg", "kind")}
                now = (row["dim"], row["qb"], row["cg"])
                if now != key and tiles is not None:
                    yield from map(out, tiles)
                    tiles = None
                key = now
                if row["kind"] and tiles is None:
                    continue  # candidates of a dimension or block without queries
                x, counts, ids = read({n: batch.column(n)[i].as_py() for n in ("rows", "vectors", "counts", "ids")})
                if row["kind"] == 0:
                    tiles = [Tiles(x[at : at + TILE], ids[at : at + TILE], k) for at in range(0, len(x), TILE)]
                else:
                    for tile in tiles:
                        tile.add(x, counts, ids)
        if tiles is not None:
            yield from map(out, tiles)

    return run


def nearest(vectors: DataFrame, every: int = 20, k: int = K, query_block: int = QUERY_BLOCK, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows with the largest inner product of each row whose vec_id is divisible by ``every``.

    Needs vec_id and embedding; other columns, whatever their names, are not read. Rows with a NULL vec_id, and
    vectors that are NULL, empty, zero or hold NULL or non-finite components take no part; only vectors of the same
    number of components meet. Ties go to the smaller vec_id. Rows with the query's vec_id are never its candidates;
    rows that repeat vec_id and vector count once. Different vectors of one vec_id are candidates of their own, so the
    id may take several ranks; as queries they share one answer, the k best pairs of any of them. A query without
    candidates, and an empty table, give no rows.
    """
    v = F.col("v")
    wide = "double" in dict(vectors.dtypes)["embedding"]
    valid = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), vectors["embedding"].alias("v")).filter(
        F.col("vec_id").isNotNull()
        & v.isNotNull()
        & F.forall(v, lambda x: F.coalesce((F.abs(x) < float("inf")), F.lit(False)))
        & F.exists(v, lambda x: F.coalesce(x != 0, F.lit(False)))
    )
    rows = valid.groupBy("v", "vec_id").agg(F.lit(1).alias("_"))
    least = Window.partitionBy("v").orderBy("vec_id")
    classes = settle(
        rows.withColumn("n", F.row_number().over(least)).filter(F.col("n") <= k + 1)
        .groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")),
        "classes",
    )
    asked = settle(rows.filter(F.col("vec_id") % every == 0).select("v", F.array("vec_id").alias("ids")), "asked")
    dim = F.size("v").alias("dim")
    n_blocks = max(1, math.ceil(classes.count() / block))
    n_queries = max(1, math.ceil(asked.count() / query_block))
    groups = math.ceil(n_blocks / GROUP)
    part = lambda n: F.pmod(F.xxhash64("v", "ids"), F.lit(n)).cast("int").alias("block")
    candidates = _blocks(classes.select(dim, part(n_blocks), "v", "ids"), ["dim", "block"], wide)
    queries = _blocks(asked.select(dim, part(n_queries), "v", "ids"), ["dim", "block"], wide)
    data = ["rows", "vectors", "counts", "ids"]
    # the stated queries meet all rows, block by block
    left = queries.select(
        "dim", F.col("block").alias("qb"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("cg"), F.lit(0).alias("kind"), F.lit(0).alias("cb"), *data
    )
    right = candidates.select(
        "dim", F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1))).alias("qb"), (F.col("block") % groups).alias("cg"), F.lit(1).alias("kind"), F.col("block").alias("cb"), *data
    )
    found = (
        left.unionByName(right)
        .repartition(n_queries * groups, "dim", "qb", "cg")
        .sortWithinPartitions("dim", "qb", "cg", "kind", "cb")
        .mapInArrow(_run(k, wide), "query_id long, vec_id long, score double")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""Collocations from a weighted de Bruijn graph.

Nodes are pairs of neighbouring words, edges the three-word grams between overlapping nodes. Each word of a piece gives
one row: the longest gram that starts there, cut off at the end of the piece. Summed rows are the graph, and shorter
counts follow from it: a node's count is its outgoing flow plus the pieces that end in it, a word's count the sum over
its nodes plus the pieces that end in it. Unary paths of frequent edges are compacted to one row of words and counts.

Only frequent nodes matter, so a first pass counts nodes by hash and sets the bits of the frequent ones in a sieve of
fixed size. Rows of other nodes are cut down to what they still count for, their first word; sums stay exact, as all
rows of a node are treated alike and the sieve never denies a frequent one. A full sieve cuts nothing and is still right.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.session import settle

MARKS = b".,;:!?\x0a\x0b\x0c\x0d"
LEAST = 10
TOP = 2000
#: Percent of a phrase's count at which a longer candidate around it takes its place.
SHARE = 50
#: The sieve has 2^SIEVE bits (8 MB), so at most 2^(SIEVE - 6) words of 64 bits pass the driver.
SIEVE = 26
#: Bytes of text that are counted together, words that are looked up at once.
TOGETHER, LOOKUP = 10 << 20, 1 << 18
#: Edges of a path in one row; longer paths go on in the next.
PATH = 4096
#: A language is first ranked in so many parts, so no task ranks all its phrases.
PARTS = 64
_LINES = bytes(10 if b in MARKS else b for b in range(256))
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


class Words:
    """The words of some texts of a language: their ids here, and which of them end a piece."""

    def __init__(self, lang: str, texts: list[bytes]):
        self.lang, self.table, ids = lang, {}, []
        words: list[bytes] = []
        ends: list[int] = []
        at = 0
        for text in texts:
            # of bytes: ASCII letters alone are lowered, and blanks and tabs are all that is left to split at
            for piece in text.lower().translate(_LINES).split(b"\n"):
                found = piece.split()
                if found:
                    words += found
                    ends.append(at + len(words) - 1)
                    if len(words) >= LOOKUP:
                        at += len(words)
                        ids.append(self._ids(words))
                        words = []
        ids.append(self._ids(words))
        self.ids = np.concatenate(ids)
        self.follows = np.ones(len(self.ids), bool)  # a word of the same piece follows
        self.follows[ends] = False

    def _ids(self, words: list[bytes]) -> np.ndarray:
        table = self.table
        for w in words:
            if w not in table:
                table[w] = len(table)
        return np.fromiter(map(table.__getitem__, words), np.int64, len(words))

    def nodes(self) -> np.ndarray:
        """64-bit hashes of language and both words, for each word that another follows."""
        seed = xxhash.xxh32_intdigest(self.lang.encode("utf-8", "surrogatepass"))
        own = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in self.table), np.uint64, len(self.table))
        first = self.ids[np.flatnonzero(self.follows)]
        second = self.ids[np.flatnonzero(self.follows) + 1]
        with np.errstate(over="ignore"):
            h = own[first] * _MIX[0] ^ (own[second] + (own[first] >> np.uint64(29)))
            h = (h ^ (h >> np.uint64(32))) * _MIX[1]
        return h ^ (h >> np.uint64(29))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            text = text.as_py().encode("utf-8", "surrogatepass")
            held.setdefault(lang.as_py(), []).append(text)
            size += len(text)
            if size >= TOGETHER:
                yield from (Words(*x) for x in held.items())
                held, size = {}, 0
    yield from (Words(*x) for x in held.items())


def _counted_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for words in _texts(batches):
        hashes, counts = np.unique(words.nodes().view(np.int64), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(counts.astype(np.int64))], ["node", "n"])


def _grams(words: Words, sieve: np.ndarray) -> pa.RecordBatch:
    h = words.nodes()
    kept = np.ones(len(h), bool)
    for p in (h & np.uint64((1 << SIEVE) - 1), (h >> np.uint64(SIEVE)) & np.uint64((1 << SIEVE) - 1)):
        kept &= (sieve[p >> np.uint64(6)] >> (p & np.uint64(63)) & np.uint64(1)).astype(bool)
    node = np.zeros(len(words.ids) + 2, bool)
    node[np.flatnonzero(words.follows)[kept]] = True
    n, size = len(words.ids), len(words.table) + 1
    after = np.append(words.ids, [0, 0]) + 1  # 0: none
    second = np.where(node[:n], after[1 : n + 1], 0)
    third = np.where(node[:n] & node[1 : n + 1], after[2 : n + 2], 0)
    pairs, rank = np.unique(words.ids * size + second, return_inverse=True)
    grams, counts = np.unique(rank * size + third, return_counts=True)
    pairs, third = pairs[grams // size], grams % size
    names = pa.array([None, *words.table], pa.binary()).cast(pa.string())
    columns = [names.take(pa.array(i)) for i in (pairs // size + 1, pairs % size, third)]
    lang = pa.repeat(pa.scalar(words.lang, pa.string()), len(counts))
    return pa.RecordBatch.from_arrays([lang, *columns, pa.array(counts.astype(np.int64))], ["lang", "w1", "w2", "w3", "n"])


def _counted_grams(sieve) -> Callable:
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(sieve.value, np.uint64)
        for words in _texts(batches):
            grams = _grams(words, bits)
            yield from (grams.slice(i, 1 << 16) for i in range(0, len(grams), 1 << 16))

    return counted


def _sieve(texts: DataFrame, least: int) -> np.ndarray:
    """Two bits for every frequent node."""
    frequent = texts.mapInArrow(_counted_nodes, "node long, n long").groupBy("node").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    place = F.lit((1 << SIEVE) - 1)
    places = frequent.select(F.explode(F.array(F.col("node").bitwiseAND(place), F.shiftrightunsigned("node", SIEVE).bitwiseAND(place))).alias("place"))
    bit = F.expr("shiftleft(1L, cast(place & 63 as int))")
    rows = places.groupBy(F.shiftright("place", 6).alias("at")).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(1 << SIEVE - 6, np.uint64)
    out[rows["at"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return out


def phrase_graph(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """lang, w1, w2, w3, n over whole texts: the summed longest grams of every place.

    An edge of at least ``least`` has a row of its own. w3 is NULL in the row of a node's other edges and the pieces that
    end in it, w2 too for the pieces that end in a word and its infrequent nodes. So flows are sums: of a frequent
    node over its rows, of a word over all of its rows, of a language over everything. Written once.
    """
    texts = docs.select(F.coalesce(docs["lang"], F.lit("und")).alias("lang"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    sieve = docs.sparkSession.sparkContext.broadcast(_sieve(texts, least).tobytes())
    rows = texts.mapInArrow(_counted_grams(sieve), "lang string, w1 string, w2 string, w3 string, n long")
    # by node: edges and flows of a node are then sums in one place
    edges = rows.repartition("lang", "w1", "w2").groupBy("lang", "w1", "w2", "w3").agg(F.sum("n").alias("n"))
    merged = edges.groupBy("lang", "w1", "w2", F.when(F.col("n") >= least, F.col("w3")).alias("w3")).agg(F.sum("n").alias("n"))
    return settle(merged, "phrase-graph")


def _edge(*words: str) -> Column:
    return F.concat_ws(" ", *words)  # words hold no blanks


def _ranked(links: DataFrame) -> DataFrame:
    """lang, edge, prev, head, steps: the first edge of each edge's path and the way to it; head is NULL in a cycle.

    Pointers double in every round. A round that finishes nothing means that no path goes on: what is left are cycles.
    """
    state = settle(
        links.select("lang", "edge", "prev", F.coalesce("prev", "edge").alias("head"), F.col("prev").isNotNull().cast("long").alias("steps"), F.col("prev").isNull().alias("done")),
        "path-links",
    )
    total, known = state.count(), state.filter("done").count()
    while known < total:
        far = state.select(F.col("lang").alias("lang2"), F.col("edge").alias("edge2"), F.col("head").alias("further"), F.col("steps").alias("more"), F.col("done").alias("end"))
        moved = (
            state.filter("not done")
            .join(far, (F.col("lang") == F.col("lang2")) & (F.col("head") == F.col("edge2")))
            .select("lang", "edge", "prev", F.col("further").alias("head"), (F.col("steps") + F.col("more")).alias("steps"), F.col("end").alias("done"))
        )
        state = settle(state.filter("done").unionByName(moved), "path-links")
        found = state.filter("done").count()
        if found == known:
            break
        known = found
    return state.select("lang", "edge", "prev", F.when(F.col("done"), F.col("head")).alias("head"), F.when(F.col("done"), F.col("steps")).alias("steps"))


def _cut(cycles: DataFrame) -> DataFrame:
    """The links of cycles, each opened before its least edge."""
    state, seen = settle(cycles.select("lang", "edge", "prev", F.col("prev").alias("at"), F.least("edge", "prev").alias("least")), "cycles"), None
    while True:
        mark = state.agg(F.sum(F.xxhash64("edge", "least").cast("decimal(38,0)"))).first()[0]
        if mark == seen:
            break
        seen = mark
        far = state.select(F.col("lang").alias("lang2"), F.col("edge").alias("edge2"), F.col("at").alias("further"), F.col("least").alias("least2"))
        joined = state.join(far, (F.col("lang") == F.col("lang2")) & (F.col("at") == F.col("edge2")))
        state = settle(joined.select("lang", "edge", "prev", F.col("further").alias("at"), F.least("least", "least2").alias("least")), "cycles")
    return state.select("lang", "edge", F.when(F.col("edge") != F.col("least"), F.col("prev")).alias("prev"))


def compact(graph: DataFrame) -> DataFrame:
    """Paths of the frequent edges of ``graph``: lang, path (its first edge), part, words, counts.

    A node with one edge in and one edge out lies inside a path; all others end paths. ``counts`` holds the edge counts,
    so ``words`` is two longer. A cycle is opened before its least edge. A path of more than ``PATH`` edges has
    several rows, numbered by part. No edges give no rows.
    """
    edges = graph.filter("w3 is not null").select("lang", "w1", "w2", "w3", "n", _edge("w1", "w2", "w3").alias("edge"))
    into = edges.groupBy("lang", F.col("w2").alias("a"), F.col("w3").alias("b")).agg(F.count("*").alias("ins"), F.first("edge").alias("prev"))
    out = edges.groupBy("lang", F.col("w1").alias("a"), F.col("w2").alias("b")).agg(F.count("*").alias("outs"))
    inside = into.join(out, ["lang", "a", "b"]).filter("ins = 1 and outs = 1").select(F.col("lang").alias("lang2"), "a", "b", "prev")
    links = edges.join(inside, (F.col("lang") == F.col("lang2")) & (F.col("w1") == F.col("a")) & (F.col("w2") == F.col("b")), "left").select("lang", "edge", "prev")
    ranked = _ranked(links)
    places = ranked.filter("head is not null")
    cycles = settle(ranked.filter("head is null").select("lang", "edge", "prev"), "cycles")
    if not cycles.isEmpty():
        places = places.unionByName(_ranked(_cut(cycles)))
    placed = edges.join(places.select("lang", "edge", "head", "steps"), ["lang", "edge"])
    parts = placed.groupBy("lang", F.col("head").alias("path"), F.floor(F.col("steps") / PATH).alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("steps", "w1", "w2", "w3", "n"))).alias("e")
    )
    words = F.concat(F.array(F.col("e")[0]["w1"], F.col("e")[0]["w2"]), F.col("e")["w3"])
    return parts.select("lang", "path", "part", words.alias("words"), F.col("e")["n"].alias("counts"))


def _score(parts: tuple[str, str]) -> Column:
    """Exact: sums of decimals of 38 digits."""
    wide = "cast({0} as decimal(15,0))"
    a, left, right = (wide.format(c) for c in ("a", *parts))
    return F.expr(f"(cast(1000000 as decimal(7,0)) * ({a} * {a})) div ({left} * {right})")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, share: int = SHARE) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of two and three words of every language.

    a, l and r count phrase, first part and rest of its weakest cut, n all words of the language; score is
    floor(10^6 a a / (l r)). Phrases inside a longer one with at least ``share`` percent of their count are left out.
    Ties go to the larger a, then to the smaller phrase in byte order. NULL languages are ``und``, NULL texts empty;
    repeated rows count each; ids are not read, so NULL or repeated ones change nothing. An empty table, or one without
    a phrase of ``least`` occurrences, gives no rows; other columns, whatever their names, are not read.
    """
    graph = phrase_graph(docs, least)
    paths = settle(compact(graph), "phrase-paths")
    at = lambda k: F.expr(f"words[i + {k}]").alias(f"w{k + 1}")
    edges = paths.select("lang", "words", F.posexplode("counts").alias("i", "n")).select("lang", at(0), at(1), at(2), "n")
    nodes = settle(graph.filter("w2 is not null").groupBy("lang", "w1", "w2").agg(F.sum("n").alias("n")).filter(F.col("n") >= least), "phrase-nodes")
    words = settle(graph.groupBy("lang", "w1").agg(F.sum("n").alias("n")).filter(F.col("n") >= least), "phrase-words")

    def known(rows: DataFrame, counts: DataFrame, name: str, *by: str) -> DataFrame:
        found = counts.select("lang", *[F.col(f"w{i + 1}").alias(c) for i, c in enumerate(by)], F.col("n").alias(name))
        return rows.join(found, ["lang", *by])

    three = known(edges.withColumnRenamed("n", "a"), words, "l1", "w1")
    three = known(known(known(three, nodes, "r1", "w2", "w3"), nodes, "l2", "w1", "w2"), words, "r2", "w3")
    # struct order is the rule: least score, then the earlier cut
    cuts = F.least(*[F.struct(_score((f"l{k}", f"r{k}")).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in (1, 2)])
    three = three.select("lang", _edge("w1", "w2", "w3").alias("phrase"), "a", cuts.alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    around = edges.select("lang", "w1", "w2", "n").unionByName(edges.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), "n"))
    around = around.groupBy("lang", "w1", "w2").agg(F.max("n").alias("longer"))
    two = nodes.withColumnRenamed("n", "a").join(around, ["lang", "w1", "w2"], "left")
    two = two.filter(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a")))
    two = known(known(two, words, "l", "w1"), words, "r", "w2")
    two = two.select("lang", _edge("w1", "w2").alias("phrase"), "a", "l", "r", _score(("l", "r")).alias("score"))
    best = _best(_best(three.unionByName(two), top, "lang", F.pmod(F.hash("phrase"), F.lit(PARTS))), top, "lang")
    totals = graph.groupBy(F.col("lang").alias("of")).agg(F.sum("n").alias("n"))
    return best.join(totals, F.col("lang") == F.col("of")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _best(rows: DataFrame, top: int, *by: str | Column) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.desc("a"), "phrase")
    return rows.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)

"""Mixture-controlled packing: deficit round-robin over one token queue per source.

A queue is the concatenation of its documents' tokens. Every round gives each queue its quantum, the target
share of one window; a queue serves a packet of ``packet`` tokens whenever its deficit covers one and carries
what is left into the next round, so that windows hold the target proportions up to one packet per queue.
Packets fill windows without gaps; the tokens that are left when a queue holds less than a packet come last.

All packets are equally long, so after r rounds a queue with quantum q has served floor(r q / packet) of them and
carries r q mod packet. Any task can therefore compute the state at any round from the queues' sizes alone:
nothing is passed from task to task, and no task sees more than its own documents.

Two passes: the first writes ids with each document's place among its queue's tokens in this partition; the second
adds the queue's tokens of earlier partitions and cuts. Only sums per partition and queue are shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.llm.tokens import store
from bazaarlens.session import settle

MAX_TOKENS = 1024
PACKET = 128
#: Texts that are encoded together.
BATCH = 1250
#: Every task holds the sizes of so many queues. Of more sources the smallest share the last queue, one after another.
MAX_QUEUES = 10_000
TAIL = "~"  # names of sources begin with =
#: Quanta are counted in this part of a token.
SCALE = 1 << 12

_TOKENS = "part int, queue string, doc_id long, before long, tokens long, ids binary"
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, queue string, ids binary"


class Rounds:
    """The state of deficit round-robin after any number of rounds."""

    def __init__(self, sizes: np.ndarray, targets: np.ndarray, packet: int, window: int):
        self.sizes, self.packet, self.window = sizes.astype(np.int64), packet, window
        share = targets / targets.sum() if len(targets) else targets
        self.quantum = np.maximum(1, np.rint(share * window * SCALE)).astype(np.int64)
        self.packets = self.sizes // packet
        self.dry = -(self.packets * (packet * SCALE) // -self.quantum)  # rounds until a queue is empty
        rest = self.sizes % packet
        self.rest_at = packet * int(self.packets.sum()) + np.cumsum(rest) - rest

    def served(self, rounds: np.ndarray) -> np.ndarray:
        """Packets served by each queue (columns) after so many rounds (rows); an empty queue loses its deficit."""
        turns = np.minimum(rounds[:, None], self.dry)
        return np.minimum(turns * self.quantum // (self.packet * SCALE), self.packets)

    def rank(self, queue: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Packets served before packet ``number`` of ``queue``, in rounds that visit the queues in turn."""
        out = np.empty(len(queue), np.int64)
        step = max(1, (1 << 20) // max(1, len(self.sizes)))
        for at in range(0, len(queue), step):
            q, n = queue[at : at + step], number[at : at + step]
            last = -((n + 1) * (self.packet * SCALE) // -self.quantum[q])  # the round that serves it
            before, after = self.served(last - 1), self.served(last)
            earlier = np.arange(len(self.sizes)) < q[:, None]
            out[at : at + step] = (
                before.sum(1) + ((after - before) * earlier).sum(1) + n - before[np.arange(len(q)), q]
            )
        return out

    def pieces(self, queue: np.ndarray, first: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, ...]:
        """Cut stretches of queues: stretch, start in it, length, and place in the concatenated windows."""
        packet = self.packet
        low, high = first // packet, (first + length - 1) // packet
        count = np.where(length > 0, high - low + 1, 0)
        of = np.repeat(np.arange(len(queue)), count)
        number = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + low[of]
        begin = np.maximum(number * packet, first[of])
        end = np.minimum((number + 1) * packet, (first + length)[of])
        q = queue[of]
        full = number < self.packets[q]
        place = np.empty(len(of), np.int64)
        place[full] = self.rank(q[full], number[full]) * packet + begin[full] - number[full] * packet
        place[~full] = self.rest_at[q[~full]] + begin[~full] - number[~full] * packet
        # what comes last may cross the end of a window
        room = self.window - place % self.window
        over = np.flatnonzero(end - begin > room)
        of, begin, end, place = (
            np.concatenate([of, of[over]]),
            np.concatenate([begin, (begin + room)[over]]),
            np.concatenate([np.minimum(end, begin + room), end[over]]),
            np.concatenate([place, (place + room)[over]]),
        )
        order = np.lexsort((begin, of))
        of, begin, end, place = of[order], begin[order], end[order], place[order]
        # packets of one document that follow each other in a window are one piece
        new = np.ones(len(of), bool)
        new[1:] = (of[1:] != of[:-1]) | (place[1:] != place[:-1] + (end - begin)[:-1]) | (place[1:] % self.window == 0)
        heads = np.flatnonzero(new)
        stop = end[np.append(heads[1:], len(of)) - 1] if len(of) else end
        return of[heads], begin[heads] - first[of[heads]], stop - begin[heads], place[heads]


def token_table(docs: DataFrame, path: str, end_id: int | None) -> DataFrame:
    """Ids of every document with its place among the tokens of its queue in the same partition."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part = store(path, "byte"), TaskContext.get().partitionId()
        schema = pa.schema(
            [("part", pa.int32()), ("queue", pa.string()), ("doc_id", pa.int64()), ("before", pa.int64()), ("tokens", pa.int64()), ("ids", pa.binary())]
        )
        end = b"" if end_id is None else np.array([end_id], words.dtype).tobytes()
        seen: dict[str, int] = {}
        for batch in batches:
            doc_id, queue, text = batch.columns
            for at in range(0, len(text), BATCH):
                ids = [x.tobytes() + end for x in words.encode_many([t.as_py() or "" for t in text[at : at + BATCH]])]
                queues, before = queue[at : at + BATCH].to_pylist(), []
                tokens = [len(x) // words.dtype.itemsize for x in ids]
                for q, n in zip(queues, tokens, strict=True):
                    before.append(seen.get(q, 0))
                    seen[q] = before[-1] + n
                yield pa.record_batch(
                    [[part] * len(ids), queues, doc_id[at : at + BATCH], before, tokens, ids], schema=schema
                )

    queue = F.coalesce(F.concat(F.lit("="), docs["source"].cast("string")), F.lit(""))
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), queue.alias("queue"), docs["text"].alias("text")
    ).mapInArrow(encode, _TOKENS)


def pack(
    docs: DataFrame,
    path: str,
    end_id: int | None = 0,
    targets: Mapping[str | None, float] | None = None,
    max_tokens: int = MAX_TOKENS,
    packet: int = PACKET,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of documents and their places in sequences of at most ``max_tokens``.

    Needs doc_id, text and source; other columns, whatever their names, are not read. NULL texts are empty; NULL
    sources are a queue of their own; doc_ids may be NULL or repeat, each row is packed by itself. ``end_id`` ends
    every document. ``targets`` gives weights by source (missing ones weigh as the smallest); by default a source
    weighs what its tokens are, so that every window is mixed like the whole. When a queue runs dry the others go on
    in their proportions. Of more than ``MAX_QUEUES`` sources the smallest share a queue, which weighs what all their
    tokens do, or the smallest of the given targets. A document without tokens has no piece; an empty table gives no rows. Every sequence but
    the last is full.
    """
    if max_tokens % packet:
        raise ValueError("packets must fill a sequence")
    rows = settle(token_table(docs, path, end_id), "tokens")
    sums = settle(rows.groupBy("queue", "part").agg(F.sum("tokens").alias("tokens")), "queue-sums")
    by_size = sums.groupBy("queue").agg(F.sum("tokens").alias("all")).orderBy(F.desc("all"), "queue")
    own = settle(by_size.limit(MAX_QUEUES - 1).select(F.col("queue").alias("own")), "own-queues")
    sums = sums.join(own, F.col("queue") == F.col("own"), "left").withColumn("turn", F.coalesce("own", F.lit(TAIL)))
    earlier = Window.partitionBy("turn").orderBy("part", "queue").rowsBetween(Window.unboundedPreceding, -1)
    # one row per input split and queue: small enough to broadcast until there are very many splits
    bases = settle(
        sums.select("turn", "queue", "part", "tokens", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("base")),
        "bases",
    )
    # at most MAX_QUEUES rows
    sizes = bases.groupBy("turn").agg(F.sum("tokens").alias("tokens")).orderBy("turn").collect()
    names = [r["turn"] for r in sizes]
    tokens = np.array([r["tokens"] for r in sizes], np.int64)
    if targets is None:
        weights = tokens.astype(float)
    else:
        named = {"" if k is None else f"={k}": float(v) for k, v in targets.items()}
        weights = np.array([named.get(n, min(named.values())) for n in names])
    rounds = Rounds(tokens, np.maximum(weights, 1e-12), packet, max_tokens)
    number = {n: i for i, n in enumerate(names)}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_id, queue, turn, tokens, first, ids = batch.columns
            queues = queue.to_pylist()
            of, start, length, place = rounds.pieces(
                np.array([number[q] for q in turn.to_pylist()], np.int64), first.to_numpy(), tokens.to_numpy()
            )
            crc, own, held, wide = [], [], -1, memoryview(b"")
            for i, s, n in zip(of.tolist(), start.tolist(), length.tolist(), strict=True):
                if i != held:
                    raw = ids[i].as_py()
                    narrow = np.frombuffer(raw, f"<u{len(raw) // tokens[i].as_py()}")
                    held, wide = i, memoryview(narrow.astype("<u4").tobytes())
                crc.append(zlib.crc32(wide[4 * s : 4 * (s + n)]))
                own.append(bytes(wide[4 * s : 4 * (s + n)]) if with_ids else None)
            at = pa.array(of)
            yield pa.record_batch(
                [
                    doc_id.take(at), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), tokens.take(at),
                    pa.array(place // max_tokens), pa.array(place % max_tokens),
                    pa.array([queues[i][1:] if queues[i] else None for i in of.tolist()], pa.string()), pa.array(own, pa.binary()),
                ],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "queue", "ids"],
            )

    placed = rows.join(bases.select("turn", "queue", "part", "base"), ["queue", "part"]).select(
        "doc_id", "queue", "turn", "tokens", (F.col("base") + F.col("before")).alias("first"), "ids"
    )
    out = placed.mapInArrow(cut, _PIECES).withColumnRenamed("queue", "source")
    return out if with_ids else out.drop("ids")


def sequences(pieces: DataFrame, max_tokens: int = MAX_TOKENS, pad_id: int = 0) -> DataFrame:
    """Whole sequences of pieces with ids: sequence_id, used, input_ids (padded, except at a power of two).

    A group holds at most ``max_tokens`` ids.
    """

    def join(key: tuple[pa.Scalar, ...], frame: pa.Table) -> pa.Table:
        frame = frame.sort_by("offset")
        ids = np.frombuffer(b"".join(frame["ids"].to_pylist()), "<u4").astype(np.int32)
        padded = ids if len(ids) & (len(ids) - 1) == 0 else np.pad(ids, (0, max_tokens - len(ids)), constant_values=pad_id)
        return pa.table(
            [pa.array([key[0].as_py()]), pa.array([len(ids)], pa.int32()), pa.array([padded], pa.list_(pa.int32()))],
            names=["sequence_id", "used", "input_ids"],
        )

    return pieces.select("sequence_id", "offset", "ids").groupBy("sequence_id").applyInArrow(
        join, "sequence_id long, used int, input_ids array<int>"
    )

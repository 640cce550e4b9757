"""Packing against the tokenizers library and a round-robin that runs one packet at a time."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from bazaarlens.llm.packing import SCALE, Rounds, pack, sequences

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def served_in_turn(rounds: Rounds) -> list[tuple[int, int]]:
    """Textbook deficit round-robin."""
    deficit, done, out = [0] * len(rounds.sizes), [0] * len(rounds.sizes), []
    while len(out) < rounds.packets.sum():
        for q in range(len(done)):
            if done[q] == rounds.packets[q]:
                continue
            deficit[q] += int(rounds.quantum[q])
            while deficit[q] >= rounds.packet * SCALE and done[q] < rounds.packets[q]:
                deficit[q] -= rounds.packet * SCALE
                out.append((q, done[q]))
                done[q] += 1
    return out


@pytest.mark.parametrize("sizes,targets", [([5000, 90, 1300, 0], [4, 1, 2, 1]), ([7, 7], [1, 1]), ([9000, 300], [1, 50])])
def test_rounds_are_deficit_round_robin(sizes, targets):
    rounds = Rounds(np.array(sizes), np.array(targets, float), 16, 64)
    order = served_in_turn(rounds)
    queue, number = (np.array(x, np.int64) for x in zip(*order)) if order else (np.zeros(0, np.int64),) * 2
    assert rounds.rank(queue, number).tolist() == list(range(len(order)))


def check(rows, texts, max_tokens):
    """Every id of every row lies in exactly one piece, at a place of its own, without gaps."""
    want = {i: np.array([*ids, 0], "<u4") for i, ids in zip(texts, library_ids([t or "" for t in texts.values()]))}
    place, spans = [], {}
    for r in rows:
        ids = want[r.doc_id]
        assert r.doc_tokens == len(ids) and 0 < r.length <= max_tokens - r.offset
        assert zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32
        spans.setdefault(r.doc_id, []).append((r.start, r.length))
        place.append((r.sequence_id * max_tokens + r.offset, r.length))
    assert set(spans) == set(want)
    for i, s in spans.items():
        at = 0
        for start, length in sorted(s):
            assert start == at
            at += length
        assert at == len(want[i])
    at = 0
    for start, length in sorted(place):
        assert start == at
        at += length


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_query(spark, folder):
    from bazaarlens.llm.queries import op1_packing

    docs = spark.read.parquet(f"/root/testdata/{folder}/documents.parquet").select("doc_id", "text").collect()
    check(op1_packing(spark, f"/root/testdata/{folder}").collect(), {r.doc_id: r.text for r in docs}, 1024)


def test_windows_hold_the_targets(spark):
    docs = spark.range(600).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("word of text "), 40).alias("text"),
        F.when(F.col("id") < 400, "a").when(F.col("id") < 500, "b").alias("source"),
    )
    got = pack(docs, PATH, targets={"a": 0.5, "b": 0.25, None: 0.25}, max_tokens=512, packet=64)
    # while all queues last (100 documents of b hold 12,100 tokens) each window is mixed up to a packet per queue
    rows = got.filter("sequence_id < 80").groupBy("sequence_id", "source").agg(F.sum("length").alias("n")).collect()
    for r in rows:
        assert abs(r.n - {"a": 256, "b": 128, None: 128}[r.source]) <= 64


def test_odd_rows(spark):
    schema = "doc_id long, text string, source string, ids string, tokens int, part int, queue string"
    texts = {1: None, 2: "", 3: "a  b\n\n c\tdon't x  y", 4: "x" * 70_000, 5: "  lead  \n", 6: "<|endoftext|> é漢字🙂"}
    rows = [(i, t, None if i % 2 else "s", "q", 7, 7, "z") for i, t in texts.items()]
    got = pack(spark.createDataFrame(rows, schema), PATH, max_tokens=64, packet=16, with_ids=True).cache()
    check(got.collect(), texts, 64)
    whole = {r.sequence_id: r for r in sequences(got, 64).collect()}
    last = max(whole)
    assert all(r.used == 64 == len(r.input_ids) for i, r in whole.items() if i < last)
    n = whole[last].used
    assert len(whole[last].input_ids) == (n if n & (n - 1) == 0 else 64)
    assert pack(spark.createDataFrame([], schema), PATH).count() == 0
    twice = pack(spark.createDataFrame([(None, "ab", "s"), (None, "ab", "s")], "doc_id long, text string, source string"), PATH)
    assert twice.agg(F.sum("length")).first()[0] == 2 * twice.first().doc_tokens


def test_the_smallest_of_many_sources_share_a_queue(spark, monkeypatch):
    monkeypatch.setattr("bazaarlens.llm.packing.MAX_QUEUES", 3)
    texts = {i: "some text " * (40 if i % 40 < 2 else 1 + i % 3) for i in range(400)}
    docs = spark.createDataFrame([(i, t, str(i % 40)) for i, t in texts.items()], "doc_id long, text string, source string").repartition(5)
    rows = pack(docs, PATH, max_tokens=64, packet=16).collect()
    check(rows, texts, 64)
    assert all(r.source == str(r.doc_id % 40) for r in rows)


def test_more_sources_than_queues(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("a few words").alias("text"), F.col("id").cast("string").alias("source"))
    got = pack(docs, PATH).agg(F.sum("length").alias("n"), F.countDistinct("source").alias("sources"), F.max("sequence_id").alias("last")).first()
    assert (got.n, got.sources, got.last) == (80_000, 20_000, 78)

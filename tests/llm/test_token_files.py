"""Token files and Elias-Fano lists: exact round trips."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from bazaarlens.llm import token_files
from bazaarlens.llm.elias_fano import EliasFano
from bazaarlens.llm.token_files import TokenFile, read_token_files, write_token_files

PATH = public_tokenizers.path("word_bpe_49k.json")


def library_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return [[*e.ids, 1] for e in t.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("count,top", [(0, 0), (1, 0), (1, 10**15), (5, 5), (1000, 999), (1000, 10**12), (3000, 40)])
def test_elias_fano(count, top):
    pick = random.Random(count)
    values = sorted(pick.randrange(top + 1) for _ in range(count))
    coded, end = EliasFano.from_bytes(b"x" + EliasFano.of(np.array(values)).to_bytes(), 1)
    assert coded.values().tolist() == values == [coded[i] for i in range(count)]
    # two bits and the low bits of a value, the samples and a head
    assert end <= 30 + count * (3 + max(0, (top // count).bit_length() - 1 if count else 0)) / 8 + count / 60 + 8
    with pytest.raises(IndexError):
        coded[count]


def want(docs):
    order = sorted(docs, key=lambda x: (x[0] is not None, x[0] or 0))
    at, out = 0, []
    for (doc_id, _), ids in zip(order, library_ids([t or "" for _, t in order]), strict=True):
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_query(spark, folder):
    from bazaarlens.llm.queries import op8_token_files

    docs = [tuple(r) for r in spark.read.parquet(f"/root/testdata/{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, op8_token_files(spark, f"/root/testdata/{folder}").collect())) == want(docs)


def test_odd_rows(spark, tmp_path, monkeypatch):
    docs = [(None, "no id"), (-5, None), (0, ""), (7, "A  b\n c\x1cd İ ς"), (2**62, "z" * 30_000), (3, "<|endoftext|> é é")]
    frame = spark.createDataFrame([(*x, 1, "p") for x in docs], "doc_id long, text string, tokens int, path string")
    manifest = write_token_files(frame, PATH, str(tmp_path))
    got = read_token_files(manifest, with_ids=True).collect()
    assert sorted((tuple(r)[:4] for r in got), key=lambda r: r[1]) == want(docs)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in got)
    assert read_token_files(write_token_files(frame.limit(0), PATH, str(tmp_path))).count() == 0


def test_repeated_ids_and_direct_access(spark, tmp_path):
    frame = spark.createDataFrame([(1, "b b"), (1, "a"), (1, "b b"), (0, "c c c")], "doc_id long, text string").coalesce(1)
    manifest = write_token_files(frame, PATH, str(tmp_path))
    rows = sorted(read_token_files(manifest, with_ids=True).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [0, 1, 1, 1] and rows[1].n_tokens + rows[2].n_tokens + rows[3].n_tokens == 8
    ids = [i for path in [r.path for r in manifest.orderBy("part", "number").collect()] for i in _all(path)]
    assert ids == [np.frombuffer(r.ids, "<u4").tolist() for r in rows]


def _all(path):
    file = TokenFile(path)
    return [file.ids(i).tolist() for i in range(file.docs)]


def test_large_tables_make_many_files(spark, tmp_path, monkeypatch):
    words = token_files.store(PATH, "word")

    def small(folder, name):
        return made.append(name) or original(folder, name)

    made, original = [], token_files.new_file
    monkeypatch.setattr(token_files, "new_file", small)
    file = token_files._Writer(str(tmp_path), "part", words.dtype)
    for i in range(700):
        file.add(i * 3, words.encode("a b c"))
    file.close()
    read = TokenFile(file.path)
    assert read.doc_ids() == list(range(0, 2100, 3)) and read.ids(0, 700).tolist() == words.encode("a b c").tolist() * 700


@pytest.mark.parametrize("count,top", [(1, 0), (700, 10**12), (3000, 40), (200_000, 10**6), (70_000, 2**62)])
def test_stretches_of_values(count, top):
    pick = random.Random(count)
    values = sorted(pick.randrange(top + 1) for _ in range(count))
    coded = EliasFano.of(np.array(values))
    for first in [0, 1, 255, 256, count - 1, count, *(pick.randrange(count) for _ in range(50))]:
        last = min(count, first + pick.choice([0, 1, 7, 300]))
        assert coded.values(first, last).tolist() == values[first:last]
    assert coded.values().tolist() == values and coded.values(count // 2).tolist() == values[count // 2 :]


def test_reader_holds_a_stretch_of_a_large_file(spark, tmp_path, monkeypatch):
    import tracemalloc

    file = token_files._Writer(str(tmp_path), "part", np.dtype("<u2"))
    one = np.array([1], "<u2")
    for i in range(1_000_000):
        file.add(None if i < 1500 else 3 * i, one)
    file.close()
    tracemalloc.start()
    read = TokenFile(file.path)
    for at in range(0, read.docs, 1 << 16):
        assert read.bounds(at, at + 1024).tolist() == list(range(at, at + 1025))[: read.docs - at + 1]
        assert read.doc_ids(at, at + 1024) == [None if i < 1500 else 3 * i for i in range(at, min(at + 1024, read.docs))]
    # the coded lists (under six bits of a document) and little more
    assert tracemalloc.get_traced_memory()[1] < 4_000_000
    tracemalloc.stop()
    assert read.doc_ids(1400, 1600) == [None] * 100 + [3 * i for i in range(1500, 1600)]


@pytest.mark.parametrize("most", [1, 5, 40])
def test_files_by_documents_and_reads_by_ids(spark, tmp_path, monkeypatch, most):
    docs = [(i, "a b " * (i % 7)) for i in range(60)] + [(None, "x")] * 3
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(token_files, "FILE_DOCS", most)
    monkeypatch.setattr(token_files, "READ_TOKENS", most)
    read = _in_process(frame)
    assert sorted(read, key=lambda r: r[1]) == want(docs)


def _in_process(frame):
    """Write and read in this process, so that the changed bounds hold."""
    import tempfile

    words, rows, folder = token_files.store(PATH, "word"), [], tempfile.mkdtemp()
    docs = sorted(map(tuple, frame.collect()), key=lambda x: (x[0] is not None, x[0] or 0))
    base = 0
    for n in range(0, len(docs), token_files.FILE_DOCS):
        file = token_files._Writer(folder, f"part-{n}", words.dtype)
        for doc_id, text in docs[n : n + token_files.FILE_DOCS]:
            file.add(doc_id, np.append(words.encode(text or ""), 1).astype(words.dtype))
        file.close()
        for batch in token_files._documents(TokenFile(file.path), base, 16, False):
            rows += [tuple(r.values())[:4] for r in batch.to_pylist()]
        base += file.tokens
    return rows

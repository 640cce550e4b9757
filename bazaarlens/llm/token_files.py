"""Token files: the ids of many documents one after another, with Elias-Fano coded document boundaries.

A file holds the ids (little-endian, 16 or 32 bits), then the documents' ends and their doc_ids, both Elias-Fano
coded, then a footer of fixed size. Documents are in ascending doc_id order through all files; the manifest names
the files in order. Ids are streamed, so a writer holds the ids of a few documents and 16 bytes for each document of its
file; a reader holds the coded boundaries as they are and selects those of some documents at a time.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.llm.elias_fano import EliasFano
from bazaarlens.llm.files import new_file, open_file
from bazaarlens.llm.tokens import store
from bazaarlens.session import settle

MAGIC = b"BZTOKEN1"
#: A file is closed when it holds this many ids.
FILE_TOKENS = 1 << 27
#: Or this many documents.
FILE_DOCS = 1 << 22
#: Ids that a reader holds together, or one document.
READ_TOKENS = 1 << 20
#: Texts that are encoded together.
BATCH = 1250
# documents, of these without doc_id (they come first), smallest doc_id, bytes of an id, bytes of the two lists
_FOOTER = struct.Struct("<QQqIQ8s")
_MANIFEST = "part int, number int, path string, docs long, tokens long"
_DOCS = "doc_id long, at long, n_tokens long, ids_crc32 long, ids binary"


class _Writer:
    def __init__(self, folder: str, name: str, dtype: np.dtype):
        self.path, self.out = new_file(folder, name)
        self.dtype, self.ends, self.doc_ids, self.unknown, self.tokens = dtype, array("q"), array("q"), 0, 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.out.write(ids.tobytes())
        self.tokens += len(ids)
        self.ends.append(self.tokens)
        if doc_id is None:
            self.unknown += 1
        else:
            self.doc_ids.append(doc_id)

    def close(self) -> None:
        least = self.doc_ids[0] if self.doc_ids else 0
        steps = np.frombuffer(self.doc_ids, np.uint64) - np.int64(least).view(np.uint64)
        lists = EliasFano.of(np.frombuffer(self.ends, np.uint64)).to_bytes() + EliasFano.of(steps).to_bytes()
        self.out.write(lists)
        self.out.write(_FOOTER.pack(len(self.ends), self.unknown, least, self.dtype.itemsize, len(lists), MAGIC))
        self.out.close()


class TokenFile:
    """Direct access to the documents of one file."""

    def __init__(self, path: str):
        self._file = open_file(path)
        end = self._file.size() - _FOOTER.size
        self._file.seek(end)
        self.docs, self.unknown, self._least, size, lists, magic = _FOOTER.unpack(self._file.read(_FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{path} is not a token file")
        self.dtype = np.dtype(f"<u{size}")
        self._file.seek(end - lists)
        data = self._file.read(lists)
        self.ends, at = EliasFano.from_bytes(data)
        self._steps, _ = EliasFano.from_bytes(data, at)

    def doc_ids(self, first: int = 0, last: int | None = None) -> list[int | None]:
        """Of the documents ``first`` to ``last`` (without it; by default of all)."""
        last = self.docs if last is None else min(last, self.docs)
        known = self._steps.values(max(first - self.unknown, 0), max(last - self.unknown, 0)) + self._least
        return [None] * max(0, min(last, self.unknown) - first) + known.tolist()

    def bounds(self, first: int, last: int) -> np.ndarray:
        """Where the documents ``first`` to ``last`` (without it) begin, and where the last of them ends."""
        return np.concatenate([[self.ends[first - 1] if first else 0], self.ends.values(first, last)])

    def ids(self, first: int, last: int | None = None) -> np.ndarray:
        """Ids of the documents ``first`` to ``last`` (without it; by default of one document)."""
        last = first + 1 if last is None else last
        begin = self.ends[first - 1] if first else 0
        end = self.ends[last - 1] if last else 0
        self._file.seek(begin * self.dtype.itemsize)
        return np.frombuffer(self._file.read((end - begin) * self.dtype.itemsize), self.dtype)


def write_token_files(docs: DataFrame, path: str, folder: str, end_id: int | None = 1, kind: str = "word") -> DataFrame:
    """Write the ids of all documents below ``folder``; returns the manifest, one row per file.

    Documents go in ascending doc_id order, those without doc_id first; rows with the same doc_id go by the hash of
    their text. NULL texts are empty. Other columns, whatever their names, are not read. The sort moves texts once;
    ids are only written to the files.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, number, rows, file = store(path, kind), TaskContext.get().partitionId(), 0, [], None
        end = np.array([] if end_id is None else [end_id], words.dtype)

        def close() -> None:
            file.close()
            rows.append((part, number, file.path, len(file.ends), file.tokens))

        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                doc_ids, texts = (c.to_pylist() for c in batch.slice(at, BATCH).columns)
                for doc_id, ids in zip(doc_ids, words.encode_many([t or "" for t in texts]), strict=True):
                    if file is None:
                        file = _Writer(folder, f"part-{part:06d}-{number:04d}", words.dtype)
                    file.add(doc_id, np.concatenate([ids, end]))
                    if file.tokens >= FILE_TOKENS or len(file.ends) >= FILE_DOCS:
                        close()
                        file, number = None, number + 1
        if file is not None:
            close()
        if rows:
            kinds = [("part", pa.int32()), ("number", pa.int32()), ("path", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64())]
            yield pa.record_batch([list(x) for x in zip(*rows, strict=True)], schema=pa.schema(kinds))

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    return settle(
        docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(write, _MANIFEST),
        "token-manifest",
    )


def _documents(file: TokenFile, base: int, step: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    """The documents of a file: ``step`` boundaries are selected at a time, and as many texts read as READ_TOKENS allow, at least one."""
    for at in range(0, file.docs, step):
        bounds, first = file.bounds(at, at + step), 0
        while first < len(bounds) - 1:
            last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + READ_TOKENS, "right")) - 1)
            cut = bounds[first : last + 1]
            data = memoryview(file.ids(at + first, at + last).astype("<u4").tobytes())
            own = [data[4 * a : 4 * b] for a, b in zip((cut[:-1] - cut[0]).tolist(), (cut[1:] - cut[0]).tolist())]
            yield pa.record_batch(
                [
                    pa.array(file.doc_ids(at + first, at + last), pa.int64()), pa.array(cut[:-1] + base), pa.array(np.diff(cut)),
                    pa.array([zlib.crc32(x) for x in own], pa.int64()),
                    pa.array([bytes(x) if with_ids else None for x in own], pa.binary()),
                ],
                names=["doc_id", "at", "n_tokens", "ids_crc32", "ids"],
            )
            first = last


def read_token_files(manifest: DataFrame, with_ids: bool = False, step: int = 1024) -> DataFrame:
    """Documents of the files in order: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, ids.

    The ids are unsigned 32-bit, little-endian, and only there if asked for. A document of no ids (no end id and
    empty text) has n_tokens 0 and crc 0. An empty manifest gives no rows.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(*batch.columns, strict=True):
                yield from _documents(TokenFile(path.as_py()), base.as_py(), step, with_ids)

    # one row per file, and a file holds up to FILE_TOKENS ids: the window sees a short list
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select("path", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    files = manifest.count()
    out = placed.repartition(max(1, files)).mapInArrow(read, _DOCS).withColumnRenamed("at", "start")
    return out if with_ids else out.drop("ids")

"""Byte-level BPE by dynamic programming over prefixes.

For every prefix of a match exactly one token can come last in its encoding: the one that fits the encoding of
what is before it. The table of these last tokens gives the encoding of every prefix, so bytes can be appended
without starting again, and after an edit only entries near it change.

Two tokens fit when merging their bytes anew gives both back, which is checked by undoing the merges along
the border, youngest first. Splits of tokens are found once, by merging each token's bytes with older ranks only.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from bazaarlens.llm.tokens import STORE_ENTRIES, ChunkStore, odd

#: Checked pairs of tokens that a worker keeps.
PAIR_ENTRIES = 400_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, map(bytes.strip, lines)))}


def merge(data: bytes, ranks: dict[bytes, int], below: int) -> list[bytes]:
    """Plain merging, lowest rank first, with ranks under ``below``."""
    parts = [data[i : i + 1] for i in range(len(data))]
    while len(parts) > 1:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1))
        if rank >= below:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class PrefixEncoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("every byte must be a token")
        self.ranks, self.size = ranks, max(ranks.values()) + 1
        self.longest = max(map(len, ranks))
        self.bytes_of: list[bytes] = [b""] * self.size
        # where a token was merged; single bytes point to themselves
        self.left, self.right = list(range(self.size)), list(range(self.size))
        #: Prefixes of tokens as a tree: what follows by byte, and under -1 the prefix's token. That is -1 if it is none,
        #: or one that merging never makes.
        self.root: dict = {-1: -1}
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
            parts = merge(token, ranks, rank)
            if len(parts) == 2:
                self.left[rank], self.right[rank] = ranks[parts[0]], ranks[parts[1]]
            node = self.root
            for byte in token:
                node = node.setdefault(byte, {-1: -1})
            if len(parts) <= 2:
                node[-1] = rank
        self.match = regex.compile(pattern)
        self._pairs: dict[int, bool] = {}
        # texts by their chunks between blanks, and chunks by their matches
        self._matches: dict[str, bytes] = {}
        self._texts = ChunkStore("byte", lambda chunks: map(self._chunk, chunks), STORE_ENTRIES // 2)

    def _fit(self, one: int, two: int) -> bool:
        """Do ``one`` and ``two`` stay apart when their bytes are merged together?"""
        left, right, bytes_of, ranks = self.left, self.right, self.bytes_of, self.ranks
        limit = self.size  # the youngest merge that was undone: a pair across the border must not be older
        while True:
            across = ranks.get(bytes_of[one] + bytes_of[two])
            if across is not None and across < limit:
                return False
            # undo the younger of both; on a tie the left one was merged first
            if one > two and right[one] != one:
                limit, one = one, right[one]
            elif left[two] != two:
                limit, two = two + 1, left[two]
            elif right[one] != one:
                limit, one = one, right[one]
            else:
                return True

    def fit(self, one: int, two: int) -> bool:
        key = one * self.size + two
        found = self._pairs.get(key)
        if found is None:
            if len(self._pairs) >= PAIR_ENTRIES:
                self._pairs.clear()
            found = self._pairs[key] = self._fit(one, two)
        return found

    def extend(self, data: bytes, last: list[int], upto: int | None = None) -> None:
        """Fill the table of last tokens from where it ends. Entry i belongs to the prefix of i bytes."""
        root, pairs, fit, size, end = self.root, self._pairs, self.fit, self.size, len(data) if upto is None else upto
        first = len(last)
        last.extend([-1] * (end + 1 - first))
        for j in range(max(0, first - self.longest), end):
            before, node, e = last[j], root, j
            for byte in data[j:end]:
                node = node.get(byte)
                if node is None:
                    break
                e += 1
                token = node[-1]
                if token >= 0 and e >= first and last[e] < 0:
                    if j:
                        fits = pairs.get(before * size + token)
                        if not (fit(before, token) if fits is None else fits):
                            continue
                    last[e] = token

    def tokens(self, last: list[int], end: int | None = None) -> list[int]:
        """The encoding of a prefix, read backwards from its last token."""
        at, out = len(last) - 1 if end is None else end, []
        while at > 0:
            out.append(last[at])
            at -= len(self.bytes_of[last[at]])
        return out[::-1]

    def encode_match(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:  # also tokens that merging never makes
            return [whole]
        last = [-1]
        self.extend(data, last)
        return self.tokens(last)

    def _chunk(self, chunk: str) -> bytes:
        known, out = self._matches, []
        for match in self.match.findall(chunk):
            ids = known.get(match)
            if ids is None:
                found = self.encode_match(match.encode())
                ids = struct.pack(f"<{len(found)}I", *found)
                if len(match) < 16:
                    if len(known) >= STORE_ENTRIES // 4:
                        known.clear()
                    known[match] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, unsigned 32-bit, little-endian."""
        return self._chunk(text) if odd(text) else self._texts.encode(text)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class EditableText:
    """A text with its matches and their prefix tables, kept exact under appends and edits."""

    def __init__(self, encoder: PrefixEncoder, text: str = ""):
        self.encoder, self.text = encoder, ""
        self.matches: list[tuple[int, int, list[int]]] = []  # start, end, table
        self.replace(0, 0, text)

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, end: int, new: str) -> None:
        """Put ``new`` in place of text[start:end]. Matches well before and after keep their tables."""
        old, shift = self.matches, len(new) - (end - start)
        text = self.text[:start] + new + self.text[end:]
        # a match may look past its end, so begin two matches before the one that the edit touches
        keep = 0
        while keep < len(old) and old[keep][1] < start:
            keep += 1
        keep = max(0, keep - 2)
        after = {m[0] + shift: i for i, m in enumerate(old) if m[0] >= end}
        tables = {self.text[m[0] : m[1]]: m[2] for m in old[keep:] if m[0] <= end}
        out, at = old[:keep], old[keep][0] if keep < len(old) else (old[-1][1] if old else 0)
        while at < len(text):
            if at in after and at >= start + len(new):
                out += [(a + shift, b + shift, t) for a, b, t in old[after[at] :]]
                break
            m = self.encoder.match.match(text, at)
            out.append((m.start(), m.end(), self._table(m[0], tables)))
            at = m.end()
        self.text, self.matches = text, out

    def _table(self, match: str, tables: dict[str, list[int]]) -> list[int]:
        """The table of a match, continued from an old one where they begin alike."""
        if match in tables:
            return tables[match]
        shared: list[int] = [-1]
        data = match.encode()
        for other, table in tables.items():
            alike = 0
            for a, b in zip(data, other.encode(), strict=False):
                if a != b:
                    break
                alike += 1
            if alike >= len(shared):
                shared = table[: alike + 1]
        last = list(shared)
        self.encoder.extend(data, last)
        return last

    def ids(self) -> list[int]:
        out: list[int] = []
        for start, end, table in self.matches:
            whole = self.encoder.ranks.get(self.text[start:end].encode())
            out += [whole] if whole is not None else self.encoder.tokens(table)
        return out


_LOADED: dict[tuple[str, str], PrefixEncoder] = {}


def encoder(path: str, pattern: str) -> PrefixEncoder:
    """The encoder of this Python worker; it lives as long as the worker."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = PrefixEncoder(read_ranks(path), pattern)
    return _LOADED[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """Encode every whole text and decode its ids again: doc_id, n_tokens, ids_sha256, decoded_sha256.

    NULL texts are empty: no ids, and both digests are those of no bytes. Rows are independent, so repeated rows or
    doc_ids give repeated results; an empty table gives no rows. Other columns, whatever their names, are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path, pattern)
        for batch in batches:
            doc_id, text = batch.columns
            for at in range(0, len(text), 500):
                count, first, second, own = [], [], [], []
                for t in text[at : at + 500]:
                    ids = bpe.encode(t.as_py() or "")
                    count.append(len(ids) // 4)
                    first.append(hashlib.sha256(ids).hexdigest())
                    second.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
                    own.append(ids if with_ids else None)
                yield pa.record_batch(
                    [doc_id[at : at + 500], pa.array(count, pa.int64()), pa.array(first, pa.string()), pa.array(second, pa.string()), pa.array(own, pa.binary())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"],
                )

    out = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, ids binary"
    )
    return out if with_ids else out.drop("ids")

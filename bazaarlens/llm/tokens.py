"""Token ids of whole texts by the tokenizers library, one dictionary lookup per word.

Both vocabularies used here never join characters across ASCII blanks, so the ids of a text are those of its
chunks put together. A worker keeps the ids of the chunks it has seen; only new chunks go through the library.
The store has two generations of bounded size, so frequent chunks stay and memory is bounded. Texts with other
blanks or control characters skip the store and go through the library whole.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa

#: Entries of each of the two generations of a worker's store, about 250 bytes each.
STORE_ENTRIES = 700_000
#: Longer chunks are encoded each time.
STORE_CHARS = 48
#: Characters that are looked up at once; longer texts are cut at a blank between words.
SEGMENT_CHARS = 1 << 20

# what a tokenizer's pattern may take for a blank beside [\x20\x09-\x0D], and the separators Python adds
_ODD = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff]")
_CUT = re.compile(r"(?<=[^\x20\x09-\x0D]) (?=[^\x20\x09-\x0D])")
# letters from here on may change by their neighbours when normalised or put into lower case
_HIGH = re.compile("[\u0250-\U0010ffff]")
BLANKS = " \t\n\x0b\x0c\r"
#: 1 for blanks.
_BYTE_KINDS = np.array([chr(b) in BLANKS for b in range(256)], np.uint8)
#: Characters of the texts whose chunks are looked up together.
TOGETHER_CHARS = 1 << 22
#: New words of one row for the library.
ROW = 64
#: Marks that end a word; no token joins them to a letter before them.
MARKS = ".,;:!?"
# with the blank before a word, as byte-level patterns take it; or words alone where blanks are dropped
CHUNKS = {
    "byte": re.compile(r" ?[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+(?![^\x20\x09-\x0D])|[\x20\x09-\x0D]+"),
    "word": re.compile(r"[^\x20\x09-\x0D]+"),
}

_LOADED: dict[tuple[str, str], WordStore] = {}


def odd(text: str) -> bool:
    """Must the text be encoded whole?"""
    return _ODD.search(text) is not None


def segments(text: str) -> Iterator[str]:
    """The text in pieces of bounded length, cut before a single blank between words where there is one."""
    at = 0
    while len(text) - at > SEGMENT_CHARS:
        cut = _CUT.search(text, at + SEGMENT_CHARS)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


class ChunkStore:
    """Encoded chunks by text. ``learn`` encodes a list of new ones."""

    def __init__(self, kind: str, learn: Callable[[list[str]], Iterable[bytes]], entries: int = STORE_ENTRIES):
        self.find, self.learn, self.entries = CHUNKS[kind].findall, learn, entries
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        return b"".join(map(self._segment, segments(text)))

    def _segment(self, text: str) -> bytes:
        return b"".join(self.lookup(self.find(text)))

    def lookup(self, chunks: list[str]) -> list[bytes]:
        """The ids of every chunk."""
        if len(self.known) > self.entries:
            self.known, self.old = {}, self.known
        parts = list(map(self.known.get, chunks))
        if None not in parts:
            return parts
        places = [i for i, p in enumerate(parts) if p is None]
        long = self._add({chunks[i] for i in places})
        for i in places:
            parts[i] = self.known[chunks[i]]
        for c in long:
            del self.known[c]
        return parts

    def _add(self, new: set[str]) -> list[str]:
        """Put new chunks into the store; returns those too long to stay."""
        known, old = self.known, self.old
        fresh, parts = [], []
        for c in new:
            if c in old:
                known[c] = old[c]
                continue
            word = c.rstrip(MARKS)
            if len(word) < len(c) and word and word[-1] < "\u0250" and word[-1].isalpha():
                parts.append((c, word, c[len(word) :]))
            else:
                fresh.append(c)
        more = {x for _, word, marks in parts for x in (word, marks) if x not in known}.difference(fresh)
        known.update((x, old[x]) for x in more if x in old)
        fresh += [x for x in more if x not in known]
        known.update(zip(fresh, self.learn(fresh), strict=True))
        for c, word, marks in parts:
            known[c] = known[word] + known[marks]
        return [c for c in (*new, *more) if len(c) > STORE_CHARS]


class WordStore:
    """Ids as little-endian unsigned 16-bit integers (32 where the vocabulary is larger)."""

    def __init__(self, path: str, kind: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.lower = kind == "word"
        self.chunks = ChunkStore(kind, self._library if self.lower else self._joined)
        if not self.lower:
            # of byte-level tokens: a character for each byte
            self.bytes = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
            for token, i in self.tokenizer.get_vocab().items():
                self.bytes[i] = len(token)

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        kind = "H" if self.dtype.itemsize == 2 else "I"
        ids = [array(kind, e.ids) for e in found]
        if sys.byteorder == "big":
            for x in ids:
                x.byteswap()
        return [x.tobytes() for x in ids]

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text. Each chunk is looked up once for some texts together."""
        out: list[np.ndarray | None] = [None] * len(texts)
        group, size = [], 0
        for i, text in enumerate(texts):
            if len(text) > SEGMENT_CHARS or odd(text):
                out[i] = self.encode(text)
                continue
            if size + len(text) > TOGETHER_CHARS:
                self._together(texts, group, out)
                group, size = [], 0
            group.append(i)
            size += len(text)
        self._together(texts, group, out)
        return out

    def _together(self, texts: list[str], group: list[int], out: list) -> None:
        if not group:
            return
        held = [texts[i].lower() if self.lower and not _HIGH.search(texts[i]) else texts[i] for i in group]
        parts = [t.encode("utf-8", "surrogatepass") for t in held]
        buffer = b" " + b" ".join(parts) + b" "
        raw = np.frombuffer(buffer, np.uint8)
        kinds = _BYTE_KINDS[raw]
        edges = np.cumsum([0, *[len(p) + 1 for p in parts]])
        kinds[edges] = 2
        starts = _chunk_starts(kinds, raw, joins=not self.lower)
        offsets = np.append(starts, len(raw)).astype(np.int32)
        chunks = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(buffer)])
        kept = kinds[starts] == 0 if self.lower else kinds[starts] != 2
        coded = chunks.filter(pa.array(kept)).dictionary_encode()
        found = self.chunks.lookup([c.decode("utf-8", "surrogatepass") for c in coded.dictionary.to_pylist()])
        ids = np.frombuffer(b"".join(found), self.dtype)
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // self.dtype.itemsize
        first = np.cumsum(lengths) - lengths
        places = coded.indices.to_numpy()
        sizes = lengths[places]
        upto = np.cumsum(sizes)
        all_ids = ids[np.repeat(first[places] - (upto - sizes), sizes) + np.arange(sizes.sum())]
        # tokens before each text: those of the chunks that begin before it
        chunks_before = np.searchsorted(starts[kept], edges)
        tokens = np.append(0, upto)[chunks_before]
        for i, a, b in zip(group, tokens.tolist(), tokens[1:].tolist(), strict=False):
            out[i] = all_ids[a:b]

    def _joined(self, texts: list[str]) -> list[bytes]:
        """As ``_library``: words with a blank before them are encoded in a row and told apart by their bytes."""
        words = [c for c in texts if len(c) > 1 and c[0] == " " and c[1] not in BLANKS]
        if len(words) < 2:
            return self._library(texts)
        rows = ["".join(words[i : i + ROW]) for i in range(0, len(words), ROW)]
        found = self.tokenizer.encode_batch_fast(rows, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, self.dtype) for e in found])
        ends = np.cumsum([len(c.encode()) for c in words])
        upto = np.cumsum(self.bytes[ids])
        last = np.searchsorted(upto, ends)
        if last[-1] >= len(upto) or (upto[last] != ends).any():
            return self._library(texts)  # a token that crosses words; none is known
        raw, size = ids.tobytes(), self.dtype.itemsize
        cuts = [0, *((last + 1) * size).tolist()]
        known = dict(zip(words, (raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)), strict=True))
        other = [c for c in texts if c not in known]
        known.update(zip(other, self._library(other), strict=True))
        return [known[c] for c in texts]

    def encode(self, text: str) -> np.ndarray:
        if odd(text):
            ids = self._library([text])[0]
        else:
            if self.lower and not _HIGH.search(text):
                text = text.lower()  # as the library will, with fewer chunks to keep
            ids = self.chunks.encode(text)
        return np.frombuffer(ids, self.dtype)


def _chunk_starts(kinds: np.ndarray, raw: np.ndarray, joins: bool) -> np.ndarray:
    """Where the chunks of ``CHUNKS`` begin in texts laid between separators (kind 2; 1: blank, 0: any other byte)."""
    word, blank, edge = kinds == 0, kinds == 1, kinds == 2
    start = edge.copy()
    start[1:] |= edge[:-1] | (blank[1:] & word[:-1])
    # a word takes the one space before it along, other blanks stay apart
    start[1:] |= word[1:] & blank[:-1] & ((raw[:-1] != 32) if joins else True)
    if joins:
        start[1:-1] |= blank[1:-1] & blank[:-2] & word[2:]
    return np.flatnonzero(start)


def store(path: str, kind: str) -> WordStore:
    """The store of this Python worker; it lives until the worker turns to another operator."""
    if (path, kind) not in _LOADED:
        release()
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark shares out the cores
        _LOADED[path, kind] = WordStore(path, kind)
    return _LOADED[path, kind]


def release() -> None:
    """Give the store back: workers are used again for other operators, which need the memory."""
    _LOADED.clear()

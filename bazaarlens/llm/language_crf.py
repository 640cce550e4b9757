"""Language of texts by a linear-chain conditional random field over words.

Every word has a label, so text that switches languages is labelled word by word. A word's features are its hashed
character n-grams, where those with a begin or end mark are its affixes, and its entry in a lexicon of words seen in
training; labels of neighbouring words are tied by learned transitions. Forward-backward gives each word's label
probabilities; a text gets the language with the largest mean.

The model is fitted on the driver from a bounded sample: at most ``per_language`` documents of each label, of each
``SLICES`` slices of ``SLICE_WORDS`` words. Training sequences join pieces of different languages, so the field
learns to switch.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bazaarlens.llm.tokens import release, segments
from bazaarlens.session import settle

UNKNOWN = "und"
PER_LANGUAGE = 400
SLICES = 3
SLICE_WORDS = 48
#: A label's hashes are counted in 2^RANGE_BITS ranges.
RANGE_BITS = 10
#: Slices of so many labels at most go to the driver; more are refused.
MAX_LABELS = 1000
NGRAM = 4
HASH_BITS = 16
#: A longer run of letters is cut into pieces of so many letters, each a word of the chain.
WORD_CHARS = 64
#: Words of the lexicon of each language.
LEXICON = 4000
#: Scored words that a worker keeps.
STORE_WORDS = 200_000
#: Words that are labelled at once.
POOL_WORDS = 150_000

_WORDS = re.compile(rf"[^\W\d_]{{1,{WORD_CHARS}}}")
_BEGIN, _END = "\x02", "\x03"


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed n-grams of words: feature, word it belongs to; and a hash of each whole word."""
    marked = np.frombuffer("".join([_BEGIN + w + _END for w in words]).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    length = np.array([len(w) + 2 for w in words])
    owner = np.repeat(np.arange(len(words)), length)
    found, of = [], []
    with np.errstate(over="ignore"):
        h = np.zeros(len(marked), np.uint64)
        for n in range(1, NGRAM + 1):
            size = len(marked) - n + 1
            if size <= 0:
                break
            h = h[:size] * np.uint64(0x100000001B3) + marked[n - 1 :] + np.uint64(n)
            inside = owner[:size] == owner[n - 1 :]
            if n == 1:  # the marks alone say nothing
                inside &= marked > 3
            found.append(_mix(h[inside]) >> np.uint64(64 - HASH_BITS))
            of.append(owner[:size][inside])
        place = np.arange(len(marked)) - np.repeat(np.cumsum(length) - length, length)
        power = _mix(place.astype(np.uint64) + np.uint64(1)) | np.uint64(1)
        whole = np.add.reduceat(_mix(marked) * power, np.cumsum(length) - length) if len(words) else np.zeros(0, np.uint64)
    return np.concatenate(found).astype(np.int64), np.concatenate(of), whole


def forward_backward(
    scores: np.ndarray, lengths: np.ndarray, begin: np.ndarray, step: np.ndarray, transitions: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities of every word of many sequences laid end to end; and expected transitions, if wanted.

    ``scores`` are log potentials of words (rows), ``begin`` and ``step`` those of first labels and transitions.
    """
    k = scores.shape[1]
    order = np.argsort(-lengths, kind="stable")
    lengths = lengths[order]
    total = int(lengths.sum())
    longest = int(lengths[0]) if len(lengths) else 0
    # time-major: at step t the sequences longer than t come first
    active = np.searchsorted(-lengths, -np.arange(longest), "left")
    first = np.concatenate([[0], np.cumsum(active)])
    starts = (np.cumsum(lengths[np.argsort(order, kind="stable")]) - lengths[np.argsort(order, kind="stable")])[order]
    of = np.repeat(np.arange(len(lengths)), lengths)
    time = np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    packed, flat = first[time] + of, starts[of] + time
    potential = np.empty((total, k))
    potential[packed] = np.exp(scores[flat] - scores[flat].max(1, keepdims=True))
    move = np.exp(step - step.max())
    alpha = np.empty_like(potential)
    now = np.exp(begin - begin.max()) * potential[: active[0]] if longest else None
    bounds = first.tolist()
    for t in range(longest):
        a, b = bounds[t], bounds[t + 1]
        if t:
            now = (now[: b - a] @ move) * potential[a:b]
        now /= now.sum(1, keepdims=True)
        alpha[a:b] = now
    beta = np.empty_like(potential)
    expected = np.zeros((k, k))
    back = np.ones((0, k))
    for t in range(longest - 1, -1, -1):
        a, b = bounds[t], bounds[t + 1]
        if len(back) < b - a:  # sequences that end here
            back = np.concatenate([back, np.ones((b - a - len(back), k))])
        back = back / back.sum(1, keepdims=True)
        beta[a:b] = back
        if t:
            ahead = potential[a:b] * back
            if transitions:
                pair = alpha[bounds[t - 1] : bounds[t - 1] + b - a, :, None] * move * ahead[:, None, :]
                expected += (pair / pair.sum((1, 2), keepdims=True)).sum(0)
            back = ahead @ move.T
    out = np.empty_like(potential)
    both = alpha * beta
    out[flat] = (both / both.sum(1, keepdims=True))[packed]
    return out, expected


@dataclass
class Field:
    """A fitted conditional random field."""

    labels: list[str]
    grams: np.ndarray  # (hash, label)
    lexicon: np.ndarray  # sorted hashes of words
    entries: np.ndarray  # (word of the lexicon, label); the last row is for all others
    begin: np.ndarray
    step: np.ndarray

    def scores(self, words: list[str]) -> np.ndarray:
        """Log potentials of distinct words, one row each."""
        found, of, whole = features(words)
        order = np.argsort(of, kind="stable")
        starts = np.searchsorted(of[order], np.arange(len(words)))  # no word is without a feature
        sums = np.add.reduceat(self.grams[found[order]], starts, axis=0)
        return (sums + self.entries[self.entry(whole)]).astype(np.float32)

    def entry(self, whole: np.ndarray) -> np.ndarray:
        none = len(self.lexicon)
        if not none:
            return np.zeros(len(whole), np.int64)
        at = np.searchsorted(self.lexicon, whole)
        return np.where((at < none) & (self.lexicon[np.minimum(at, none - 1)] == whole), at, none)


def fit(samples: list[tuple[str, list[list[str]]]], seed: int = 7, epochs: int = 3, rate: float = 0.2) -> Field | None:
    """A field from (label, slices of words); None without any word."""
    rng = np.random.default_rng(seed)
    pieces = [(label, [w.lower() for w in s]) for label, slices in samples for s in slices if s]
    labels = sorted({label for label, _ in pieces})
    if not labels:
        return None
    k, number = len(labels), {x: i for i, x in enumerate(labels)}
    words = sorted({w for _, s in pieces for w in s})
    place = {w: i for i, w in enumerate(words)}
    found, of, whole = features(words)
    order = np.argsort(of, kind="stable")
    found, of = found[order], of[order]
    bounds = np.searchsorted(of, np.arange(len(words) + 1))
    counts = np.zeros((len(words), k))
    for label, s in pieces:
        np.add.at(counts, ([place[w] for w in s], number[label]), 1)
    chosen = set()
    for i in range(k):
        best = np.argsort(-counts[:, i], kind="stable")[:LEXICON]
        chosen.update(best[counts[best, i] > 1].tolist())
    lexicon = np.unique(whole[sorted(chosen)]) if chosen else np.zeros(0, np.uint64)
    field = Field(labels, np.zeros((1 << HASH_BITS, k)), lexicon, np.zeros((len(lexicon) + 1, k)), np.zeros(k), np.zeros((k, k)))
    entry = field.entry(whole)
    squares = [np.full_like(x, 1e-6) for x in (field.grams, field.entries, field.begin, field.step)]

    def update(values: np.ndarray, square: np.ndarray, gradient: np.ndarray) -> None:
        square += gradient**2
        values -= rate * gradient / np.sqrt(square)

    coded = [(number[label], np.array([place[w] for w in s])) for label, s in pieces]
    for _ in range(epochs):
        mixed = [coded[i] for i in rng.permutation(len(coded))]
        # a sequence joins a few pieces, each a random part of a slice
        sequences, at = [], 0
        while at < len(mixed):
            n = int(rng.integers(1, 4))
            parts = []
            for label, ids in mixed[at : at + n]:
                size = int(rng.integers(max(1, len(ids) // 3), len(ids) + 1))
                begin = int(rng.integers(0, len(ids) - size + 1))
                parts.append((label, ids[begin : begin + size]))
            sequences.append(parts)
            at += n
        for at in range(0, len(sequences), 48):
            batch = sequences[at : at + 48]
            ids = np.concatenate([x for parts in batch for _, x in parts])
            truth = np.concatenate([np.full(len(x), label) for parts in batch for label, x in parts])
            lengths = np.array([sum(len(x) for _, x in parts) for parts in batch])
            used, inverse = np.unique(ids, return_inverse=True)
            size = bounds[used + 1] - bounds[used]
            gram = found[np.repeat(bounds[used] - np.cumsum(size) + size, size) + np.arange(size.sum())]
            rep = np.repeat(np.arange(len(used)), size)
            sums = np.stack([np.bincount(rep, field.grams[gram, i], len(used)) for i in range(k)], 1) + field.entries[entry[used]]
            chance, expected = forward_backward(sums[inverse], lengths, field.begin, field.step, True)
            wrong = chance
            wrong[np.arange(len(ids)), truth] -= 1
            by_word = np.stack([np.bincount(inverse, wrong[:, i], len(used)) for i in range(k)], 1)
            heads = np.cumsum(lengths) - lengths
            pairs = np.ones(len(ids), bool)
            pairs[heads] = False
            real = np.bincount(truth[np.flatnonzero(pairs) - 1] * k + truth[pairs], minlength=k * k).reshape(k, k)
            update(field.grams, squares[0], np.stack([np.bincount(gram, by_word[rep, i], 1 << HASH_BITS) for i in range(k)], 1))
            update(field.entries, squares[1], np.stack([np.bincount(entry[used], by_word[:, i], len(lexicon) + 1) for i in range(k)], 1))
            update(field.begin, squares[2], wrong[heads].sum(0))
            update(field.step, squares[3], expected - real)
    field.grams, field.entries = field.grams.astype(np.float32), field.entries.astype(np.float32)
    return field


class Labeller:
    """Labels texts with a field; keeps the scores of words it has seen."""

    def __init__(self, field: Field | None):
        self.field = field
        self.place: dict[str, int] = {}
        self.used = 0
        self.table = np.zeros((1024, len(field.labels) if field else 0), np.float32)

    def _known(self, words: list[str]) -> np.ndarray:
        """Rows of the table for words; -1 where no character is a letter."""
        new = list(set(words).difference(self.place))
        if new:
            if len(self.place) + len(new) > STORE_WORDS:
                self.place, self.used, new = {}, 0, list(set(words))
            real = [w for w in new if any(map(str.isalpha, w))]
            first, need = self.used, self.used + len(real)
            if need > len(self.table):
                more = np.zeros((max(need, 2 * len(self.table)), self.table.shape[1]), np.float32)
                more[:first] = self.table[:first]
                self.table = more
            if real:
                self.table[first:need] = self.field.scores(real)
            self.used = need
            self.place.update(zip(real, range(first, need), strict=True))
            self.place.update((w, -1) for w in set(new).difference(real))
        return np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))

    def word_chances(self, texts: list[str]) -> tuple[list[int], np.ndarray]:
        """Words of each text, and label probabilities of all words in turn."""
        scores, lengths = [], []
        for text in texts:
            n = 0
            for part in segments(text):
                rows = self._known(_WORDS.findall(part.lower()))
                rows = rows[rows >= 0]
                scores.append(self.table[rows])
                n += len(rows)
            lengths.append(n)
        flat = np.concatenate(scores) if scores else np.zeros((0, self.table.shape[1]), np.float32)
        some = np.array([n for n in lengths if n], np.int64)
        chance, _ = forward_backward(flat, some, self.field.begin, self.field.step)
        return lengths, chance

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """Language and its mean probability over the words; ``und`` and 0 without a letter."""
        if self.field is None:
            return [(UNKNOWN, 0.0)] * len(texts)
        lengths, chance = self.word_chances(texts)
        out, at = [], 0
        for n in lengths:
            if n:
                mean = chance[at : at + n].mean(0)
                best = int(mean.argmax())
                out.append((self.field.labels[best], min(1.0, float(mean[best]))))
            else:
                out.append((UNKNOWN, 0.0))
            at += n
        return out


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def _least_hashes(rows: DataFrame, per_language: int) -> DataFrame:
    """The rows with the ``per_language`` smallest hashes of each label.

    Ranges of hashes are counted first, so that only the rows of the smallest ranges, which hold enough, are ranked.
    """
    hashed = rows.withColumn("hash", F.xxhash64("doc_id")).withColumn("range", F.shiftright("hash", 64 - RANGE_BITS))
    earlier = Window.partitionBy("lang").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = hashed.groupBy("lang", "range").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    bounds = settle(counts.filter(F.col("before") < per_language).groupBy("lang").agg(F.max("range").alias("most")), "sample-bounds")
    few = hashed.join(bounds, "lang").filter(F.col("range") <= F.col("most"))
    by_hash = Window.partitionBy("lang").orderBy("hash", "doc_id")
    return few.withColumn("n", F.row_number().over(by_hash)).filter(F.col("n") <= per_language).select("lang", "doc_id")


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> list[tuple[str, list[list[str]]]]:
    """Slices of words of at most ``per_language`` labelled documents of each language, chosen by a hash of the id.

    Long runs of letters are pieces of ``WORD_CHARS``, as in prediction.
    Documents without id or label, and those held out, are not seen. More than ``MAX_LABELS`` labels are an error.
    """
    known = docs.select(docs["doc_id"].alias("doc_id"), docs["lang"].alias("lang"), docs["text"].alias("text"))
    known = known.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    ids = settle(_least_hashes(known.select("lang", "doc_id"), per_language), "sample-ids")
    if (labels := ids.select("lang").distinct().count()) > MAX_LABELS:
        raise ValueError(f"{labels} labels: a field of more than {MAX_LABELS} cannot be fitted on the driver")
    words = F.regexp_extract_all("text", F.lit(rf"\p{{L}}{{1,{WORD_CHARS}}}"), 0)
    slices = F.array(
        *[
            F.slice("words", F.pmod(F.xxhash64("doc_id", F.lit(i)), F.greatest(F.lit(1), F.size("words") - SLICE_WORDS)).cast("int") + 1, SLICE_WORDS)
            for i in range(SLICES)
        ]
    )
    # per_language rows for each label; Spark broadcasts them by their size
    rows = (
        known.join(ids.select("lang", "doc_id"), ["lang", "doc_id"], "left_semi")
        .filter(F.col("text").isNotNull())
        .select("lang", "doc_id", words.alias("words"))
        .select("lang", "doc_id", slices.alias("slices"))
        .groupBy("lang", "doc_id")
        .agg(F.min("slices").alias("slices"))
        .collect()
    )
    return [(r.lang, r.slices) for r in sorted(rows, key=lambda r: (r.lang, r.doc_id))]


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Field | None:
    return fit(sample(docs, per_language))


def _label(texts: pa.Array, labeller: Labeller) -> Iterator[tuple[list[str], list[float]]]:
    """Predictions in stretches of bounded size, in order."""
    pool, size = [], 0

    def done():
        found = labeller.predict(pool)
        return [x for x, _ in found], [x for _, x in found]

    for t in texts:
        text = t.as_py() or ""
        pool.append(text)
        size += len(text) // 6
        if size >= POOL_WORDS or len(pool) >= 4096:
            yield done()
            pool, size = [], 0
    if pool:
        yield done()


def predict_languages(docs: DataFrame, field: Field | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs``.

    The prediction sees the whole text alone. NULL texts, texts without a letter, and all texts if there was nothing
    to learn from get ``und`` and score 0. Ties go to the label that comes first in order. Rows are independent, so
    repeated rows give repeated results; an empty table gives no rows; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        labeller = Labeller(field)
        for batch in batches:
            doc_id, held, text = batch.columns
            at = 0
            for lang, score in _label(text, labeller):
                n = len(lang)
                yield pa.record_batch(
                    [doc_id[at : at + n], held[at : at + n], pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )
                at += n

    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), held_out(docs["doc_id"]).alias("held_out"), docs["text"].alias("text")
    ).mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_languages(docs: DataFrame, field: Field | None, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose language is known with at least the score ``least``."""

    @F.arrow_udf("boolean")
    def known(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release()
        labeller = Labeller(field)
        for text in texts:
            found = [(lang != UNKNOWN and score >= least) for some in _label(text, labeller) for lang, score in zip(*some, strict=True)]
            yield pa.array(found, pa.bool_())

    return docs.filter(known(docs["text"]))

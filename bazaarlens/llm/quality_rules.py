"""Quality rules: counts that any text must pass, then its distance from the language it claims to be.

References are made from all documents of a language: how often each class of characters occurs, and how often each
of its common words (those with at least ``1 / COMMON`` of its words, so at most ``COMMON`` by construction). A
document is compared with both by the Jensen-Shannon distance (root of the divergence in bits, 0 to 1). Texts and
references below a minimum length say too little and are not compared.

The references join their documents as an ordinary table: Spark broadcasts it if it is small and shuffles if not.
"""

from __future__ import annotations

import json
import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.session import settle

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
#: Percent of the words that may lie in repeated windows.
MOST_REPEATED = 30
#: A common word has at least one in so many words of its language.
COMMON = 500
#: Characters and words below which a text is not compared, and those of a usable reference.
LEAST_CHARS, LEAST_COMPARED, LEAST_REFERENCE = 500, 100, 2000
#: Largest distances of a text that stays.
CLASS_LIMIT, WORD_LIMIT = 0.25, 0.35
#: Words that a batch counts before it hands them on.
HELD = 200_000
CLASSES = ("ascii lower", "ascii upper", "ascii digit", "blank", "ascii mark", "ascii symbol", "letter", "upper", "accent", "mark", "symbol", "digit", "other")


def character_class(c: str) -> int:
    kind = unicodedata.category(c)
    if c in BLANKS or kind[0] == "Z":
        return 3
    if c < "\x80":
        return {"Ll": 0, "Lu": 1, "Nd": 2}.get(kind, 4 if kind[0] == "P" else 5 if kind[0] == "S" else 12)
    return 7 if kind == "Lu" else {"L": 6, "M": 8, "P": 9, "S": 10, "N": 11}.get(kind[0], 12)


@cache
def _class_table() -> np.ndarray:
    return np.array([character_class(chr(i)) for i in range(0x110000)], np.uint8)


def class_counts(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.bincount(_class_table()[codes], minlength=len(CLASSES))


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words (a power of two) which occurs at least twice."""
    if len(words) <= window:
        return 0
    ids: dict[bytes, int] = {}
    rank = np.array([ids.setdefault(w, len(ids)) for w in words], np.int64)
    size = 1
    while size < window:  # equal windows have equal ranks; two of a size make one of the next
        pairs = rank[:-size] * (int(rank.max()) + 1) + rank[size:]
        rank = np.unique(pairs, return_inverse=True)[1]
        size *= 2
    again = np.bincount(rank)[rank] > 1
    inside = np.zeros(len(words), bool)
    for shift in range(window):
        inside[shift : shift + len(again)] |= again
    return int(inside.sum())


def measures(text: str) -> dict:
    """The base counts and their verdict."""
    words = text.encode("utf-8", "surrogatepass").split()  # of bytes: the six ASCII blanks alone
    seen: set[str] = set()
    again = 0
    for line in text.split("\n"):
        if line.strip(BLANKS):
            again += line in seen
            seen.add(line)
    repeated = repeated_words(words)
    return {
        "n_words": len(words),
        "word_chars": len(text) - sum(map(text.count, BLANKS)),
        "n_symbols": sum(map(text.count, SYMBOLS)),
        "n_dup_lines": again,
        "n_repeat_words": repeated,
        "base_failed": len(words) < LEAST_WORDS or 100 * repeated > MOST_REPEATED * len(words),
    }


def _entropy(counts: np.ndarray) -> float:
    p = counts[counts > 0] / counts.sum()
    return float(-(p * np.log2(p)).sum())


def js_distance(a: np.ndarray, b: np.ndarray) -> float:
    """Root of the Jensen-Shannon divergence of two histograms, in bits; neither may be empty."""
    p, q = a / a.sum(), b / b.sum()
    return math.sqrt(max(0.0, _entropy(p + q) - (_entropy(a) + _entropy(b)) / 2))


class Reference:
    """Histograms of one language, as ``references`` writes them."""

    def __init__(self, ref: str):
        held = json.loads(ref)
        self.total = held["total"]
        self.classes = np.zeros(len(CLASSES))
        for c in held["classes"]:
            self.classes[int(c["key"])] = c["n"]
        self.place = {w["key"]: i for i, w in enumerate(held["words"])}
        common = [w["n"] for w in held["words"]]
        self.words = np.array([*common, self.total - sum(common)], float)

    def distances(self, text: str, n_words: int) -> tuple[float | None, float | None]:
        """Of the classes and of the common words; None where too little is known."""
        classes = words = None
        if self.total >= LEAST_REFERENCE:
            if len(text) >= LEAST_CHARS:
                classes = js_distance(class_counts(text), self.classes)
            if n_words >= LEAST_COMPARED:
                found = np.zeros(len(self.words))
                for w, n in Counter(_words(text)).items():
                    found[self.place.get(w, -1)] += n
                words = js_distance(found, self.words)
        return classes, words


def _words(text: str) -> list[str]:
    return [w.decode("utf-8", "surrogatepass") for w in text.lower().encode("utf-8", "surrogatepass").split()]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter = Counter()
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            lang, text = lang.as_py(), text.as_py() or ""
            words = _words(text)
            counts.update([(lang, "word", w) for w in words])
            counts[lang, "total", ""] += len(words)
            for i, n in enumerate(class_counts(text).tolist()):
                if n:
                    counts[lang, "class", str(i)] += n
            if len(counts) > HELD:
                yield _rows(counts)
                counts = Counter()
        yield _rows(counts)


def _rows(counts: Counter) -> pa.RecordBatch:
    langs, kinds, keys = zip(*counts, strict=True) if counts else ((), (), ())
    values = [pa.array(x, pa.string()) for x in (langs, kinds, keys)] + [pa.array(list(counts.values()), pa.int64())]
    return pa.RecordBatch.from_arrays(values, ["lang", "kind", "key", "n"])


def references(docs: DataFrame, common: int = COMMON) -> DataFrame:
    """lang, ref: the histograms of each language (NULL is one of its own) over all its texts, as JSON.

    Batches count before the shuffle, so a language or word that is everywhere sends one row per batch. NULL texts
    count as empty; a language without words has a total of 0; an empty table gives no rows.
    """
    narrow = docs.select(docs["lang"].alias("lang"), docs["text"].alias("text"))
    counts = settle(
        narrow.mapInArrow(_counted, "lang string, kind string, key string, n long").groupBy("lang", "kind", "key").agg(F.sum("n").alias("n")), "language-counts"
    )
    # a row per language: Spark broadcasts it by its size and leaves the counts where they are
    totals = settle(counts.filter("kind = 'total'").select(F.col("lang").alias("of"), F.col("n").alias("total")), "language-totals")
    some = counts.filter("kind <> 'total'").join(totals, F.col("lang").eqNullSafe(F.col("of"))).filter((F.col("kind") == "class") | (F.col("n") * common >= F.col("total")))

    def listed(kind: str) -> Column:
        return F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct("key", "n"))))

    return some.groupBy("lang").agg(
        F.to_json(F.struct(F.first("total").alias("total"), listed("class").alias("classes"), listed("word").alias("words"))).alias("ref")
    )


RESULT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, class_distance double, word_distance double, kept boolean"


def _judged(texts: pd.Series, refs: pd.Series) -> pd.DataFrame:
    known: dict[str, Reference] = {}
    rows = []
    for text, ref in zip(texts, refs, strict=True):
        text = text or ""
        row = measures(text)
        classes = words = None
        if ref is not None:
            if ref not in known:
                known[ref] = Reference(ref)
            classes, words = known[ref].distances(text, row["n_words"])
        far = (classes or 0) > CLASS_LIMIT or (words or 0) > WORD_LIMIT
        rows.append(row | {"class_distance": classes, "word_distance": words, "kept": not (row["base_failed"] or far)})
    columns = [c.split()[0] for c in RESULT.split(", ")]
    return pd.DataFrame(rows, columns=columns).astype({"class_distance": "float64", "word_distance": "float64"})


def _with_references(docs: DataFrame, refs: DataFrame | None) -> tuple[DataFrame, Column]:
    refs = settle(references(docs), "language-references") if refs is None else refs
    joined = docs.join(refs, docs["lang"].eqNullSafe(refs["lang"]), "left")
    return joined, F.pandas_udf(_judged, RESULT)(docs["text"], refs["ref"])


def quality(docs: DataFrame, refs: DataFrame | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, the base counts, base_failed, class_distance, word_distance, kept.

    ``refs`` are references of another corpus; without them the documents' own are made. A distance is NULL where the
    text or its reference is too short, or the language has none; it then decides nothing. NULL and empty texts
    have no words and fail the base rules. Rows are judged one by one: repeated rows and NULL ids stay rows of their
    own. An empty table gives no rows; other columns, whatever their names, are not read.
    """
    joined, judged = _with_references(docs, refs)
    return joined.select(docs["doc_id"], judged.alias("judged")).select("doc_id", "judged.*")


def keep_quality(docs: DataFrame, refs: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps, with all their columns; odd rows as there."""
    joined, judged = _with_references(docs, refs)
    return joined.filter(judged["kept"]).select(*[docs[c] for c in docs.columns])

"""Dictionaries of many terms, found in one walk over each text.

One substring test per term makes plans and work grow with the dictionary. Here all terms share an automaton (a trie
whose nodes also know where to go on after a mismatch), which passes a text once whatever the number of terms. It
travels with the function as a list of terms, and each worker builds it once. Short lists stay with ``contains_any``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Mapping

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from bazaarlens.functions.columns import col

FOUND = "array<struct<term:string,at:int>>"
_BUILT: dict[str, object] = {}


def _automaton(mark: str, terms: list[str]):
    if mark not in _BUILT:
        import ahocorasick

        _BUILT.clear()  # a worker keeps the dictionary it works with
        built = ahocorasick.Automaton()
        for t in terms:
            built.add_word(t, t)
        built.make_automaton()
        _BUILT[mark] = built
    return _BUILT[mark]


def find_terms(text: Column | str, terms: Iterable[str], whole_words: bool = False) -> Column:
    """The different terms that a text contains, each with its first 0-based place in characters, in order of place and term.

    Terms are compared as they are: lower both sides to ignore case. Blank terms never hit, a NULL text gives NULL and an
    empty dictionary an empty list. With ``whole_words`` a term must not touch a letter, digit or underscore.
    """
    known = sorted({t for t in terms if t and t.strip()})
    if not known:
        return F.when(col(text).isNotNull(), F.array().cast(FOUND))
    mark = hashlib.sha256("\0".join(known).encode()).hexdigest()

    def find(texts: pd.Series) -> pd.Series:
        automaton = _automaton(mark, known)

        def places(t: str | None) -> list[tuple[str, int]] | None:
            if t is None:
                return None
            first: dict[str, int] = {}
            for end, term in automaton.iter(t):
                at = end - len(term) + 1
                if term not in first and not (whole_words and (_word(t, at - 1) or _word(t, end + 1))):
                    first[term] = at
            return [{"term": w, "at": at} for w, at in sorted(first.items(), key=lambda x: (x[1], x[0]))]

        return texts.map(places)

    return F.pandas_udf(find, FOUND)(col(text).cast("string"))


def _word(text: str, at: int) -> bool:
    return 0 <= at < len(text) and (text[at].isalnum() or text[at] == "_")


def find_labels(text: Column | str, dictionary: Mapping[str, Iterable[str]], whole_words: bool = False) -> Column:
    """The labels of which a term is found, each with the first place of any of its terms, in order of place and label.

    One term may belong to several labels.
    """
    labels: dict[str, list[str]] = {}
    for label, terms in dictionary.items():
        for t in terms:
            labels.setdefault(t, []).append(label)
    held = {t: sorted(set(ls)) for t, ls in labels.items() if t and t.strip()}
    found = find_terms(text, held, whole_words)

    def named(rows: pd.Series) -> pd.Series:
        def label(hits) -> list[dict] | None:
            if hits is None:
                return None
            first: dict[str, int] = {}
            for hit in hits:
                for name in held[hit["term"]]:
                    first.setdefault(name, hit["at"])
            return [{"label": w, "at": at} for w, at in sorted(first.items(), key=lambda x: (x[1], x[0]))]

        return rows.map(label)

    return F.pandas_udf(named, "array<struct<label:string,at:int>>")(found)

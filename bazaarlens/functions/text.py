"""Text normalisation and matching."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from bazaarlens.functions.columns import col


def _fold_table() -> tuple[str, str]:
    """Accented letters with an ASCII base, then the combining marks that are dropped."""
    src, dst = [], []
    for cp in range(0xC0, 0x2000):
        ch = chr(cp).lower()
        if len(ch) != 1 or ch in src:
            continue
        parts = unicodedata.normalize("NFD", ch)
        if len(parts) > 1 and parts[0].isascii() and all(unicodedata.combining(p) for p in parts[1:]):
            src.append(ch)
            dst.append(parts[0])
    marks = [chr(cp) for cp in range(0x300, 0x370) if unicodedata.combining(chr(cp))]
    return "".join(src + marks), "".join(dst)


_FOLD_FROM, _FOLD_TO = _fold_table()


def fold(c: Column | str, fold_d: bool = False) -> Column:
    """Lower case, no diacritics, only a-z 0-9, single spaces.

    ``đ`` has no decomposition, so it becomes a space unless ``fold_d`` maps it to d.
    """
    low = F.lower(col(c))
    if fold_d:
        low = F.translate(low, "đ", "d")
    plain = F.translate(low, _FOLD_FROM, _FOLD_TO)
    return F.trim(F.regexp_replace(plain, "[^a-z0-9]+", " "))


def split_hashtag(c: Column | str) -> Column:
    """Drop ``#``, split ``_`` and camelCase. Runs before lower-casing."""
    spaced = F.replace(F.replace(col(c), F.lit("#"), F.lit("")), F.lit("_"), F.lit(" "))
    return F.regexp_replace(spaced, r"([\p{Ll}\p{N}])(\p{Lu})", "$1 $2")


def fold_hashtag(c: Column | str, fold_d: bool = False) -> Column:
    return fold(split_hashtag(c), fold_d)


def drop_stop_terms(tokens: Column | str, stop: Iterable[str]) -> Column:
    known = sorted(set(stop))
    return F.filter(col(tokens), lambda t: ~t.isin(known)) if known else col(tokens)


def words(c: Column | str) -> Column:
    """Words of folded text, without the empty word."""
    return F.filter(F.split(col(c), " "), lambda w: w != "")


def ngrams(tokens: Column | str, longest: int) -> Column:
    """All runs of 1..longest neighbouring tokens, each joined by a space."""
    arr = col(tokens)

    def runs(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.size(arr) - F.lit(n - 1))
        joined = F.transform(starts, lambda i: F.array_join(F.slice(arr, i, n), " "))
        return F.when(F.size(arr) >= n, joined).otherwise(F.array().cast("array<string>"))

    return F.concat(*[runs(n) for n in range(1, longest + 1)])


def sentence_case(c: Column | str) -> Column:
    """Collapse white space, first letter upper case, the rest lower case; NULL gives ''."""
    flat = F.trim(F.regexp_replace(F.coalesce(col(c), F.lit("")), r"(?U)\s+", " "))
    return F.concat(F.upper(F.substring(flat, 1, 1)), F.lower(F.substring(flat, 2, 2_000_000_000)))


# Marks that UTF-8 bytes leave behind when they are read as Latin-1.
_MOJIBAKE = "[ÃÂÄÅÆÇá][\u0080-¿]"


def repair_mojibake(c: Column | str) -> Column:
    """Undo a UTF-8 text that was read as Latin-1; other texts stay as they are."""
    text = col(c)
    fits = ~text.rlike("[^\u0000-ÿ]")
    fixed = F.try_validate_utf8(F.encode(F.when(fits, text), "ISO-8859-1").cast("string"))
    return F.coalesce(F.when(text.rlike(_MOJIBAKE) & fits, fixed), text)


def nfkc(c: Column | str, form: str = "NFKC") -> Column:
    """Unicode normal form. Spark has no built-in, so non-ASCII rows go through Arrow."""

    @F.pandas_udf("string")
    def normal(s: pd.Series) -> pd.Series:
        return s.map(lambda v: unicodedata.normalize(form, v), na_action="ignore")

    return normal(col(c))


def strip_suffix(c: Column | str, suffixes: Sequence[str] = ("_old", "_new")) -> Column:
    """Remove one trailing suffix, once."""
    return F.regexp_replace(col(c), "(" + "|".join(re.escape(s) for s in suffixes) + ")$", "")


def contains_any(c: Column | str, parts: Sequence[str]) -> Column:
    """Literal substring test for any of ``parts``."""
    hit = F.lit(False)
    for i, p in enumerate(parts):
        hit = col(c).contains(p) if i == 0 else hit | col(c).contains(p)
    return hit


# Unicode word classes cost time, so only patterns that name a class ask for them.
_CLASS = re.compile(r"\\[bBwWdDsS]")
# text without a meaning of its own in a pattern, and escaped marks
_LITERAL = re.compile(r"(?:[\w #:&/-]|\\[^\w\s]|\\ )+")


def _flags(pattern: str, ignore_case: bool = False) -> str:
    return ("(?iu)" if ignore_case else "") + ("(?U)" if _CLASS.search(pattern) else "")


def _alternatives(pattern: str) -> list[str] | None:
    """The pattern cut at each bar that is not escaped; None if it has groups, classes or counts."""
    parts, escaped = [""], False
    for ch in pattern:
        if not escaped and ch in "([{":
            return None
        if not escaped and ch == "|":
            parts.append("")
        else:
            parts[-1] += ch
        escaped = ch == "\\" and not escaped
    return parts


def split_literals(pattern: str) -> tuple[list[str], str]:
    """Alternatives that are plain text, without their escapes, and the rest of the pattern."""
    parts = _alternatives(pattern)
    if parts is None:
        return [], pattern
    plain = [re.sub(r"\\(.)", r"\1", p) for p in parts if _LITERAL.fullmatch(p)]
    return plain, "|".join(p for p in parts if not _LITERAL.fullmatch(p))


def pattern_hit(text: Column | str, pattern: str | None, ignore_case: bool = False) -> Column:
    """Regex search with Unicode word edges; an empty pattern never hits.

    Plain alternatives become substring tests, which scan several times faster than a
    regex alternation.
    """
    if not pattern or not pattern.strip():
        return F.lit(False)
    plain, rest = split_literals(pattern)
    if ignore_case:
        plain = [p.lower() for p in plain]
    # a text that contains "abc" contains "ab": only the shortest words need a test
    plain = [p for p in dict.fromkeys(plain) if not any(o != p and o in p for o in plain)]
    hit = contains_any(F.lower(col(text)) if ignore_case else text, plain) if plain else F.lit(False)
    if rest:
        hit = hit | col(text).rlike(_flags(rest, ignore_case) + rest)
    return F.coalesce(hit, F.lit(False))


def first_offset(text: Column | str, pattern: str, ignore_case: bool = False) -> Column:
    """0-based offset, in characters, of the first match; NULL without one."""
    before = F.regexp_extract(col(text), "(?s)" + _flags(pattern, ignore_case) + "^(.*?)(?:" + pattern + ")", 1)
    return F.when(pattern_hit(text, pattern, ignore_case), F.length(before))


def any_of(terms: Iterable[str], extra: str | None = None) -> str:
    """One alternation that matches the terms literally, then an extra pattern."""
    parts = [re.escape(t.strip().lower()) for t in terms if t and t.strip()]
    if extra and extra.strip():
        parts.append(extra)
    return "|".join(parts)

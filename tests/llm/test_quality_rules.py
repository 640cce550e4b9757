"""Quality rules against plain counts and histograms."""

import json
import math
import re
from collections import Counter

import pytest

from bazaarlens.llm import quality_rules as q
from bazaarlens.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    """The base counts, word by word."""
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often, inside = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            inside.update(range(i, i + 8))
    lines, dup = text.split("\n"), 0
    for i, line in enumerate(lines):
        dup += bool(WORD.search(line)) and line in lines[:i]
    failed = len(words) < 20 or 100 * len(inside) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside), failed


def distance(a, b):
    p = {k: v / sum(a.values()) for k, v in a.items()}
    r = {k: v / sum(b.values()) for k, v in b.items()}
    out = 0
    for k in {*p, *r}:
        m = (p.get(k, 0) + r.get(k, 0)) / 2
        out += sum(x[k] * math.log2(x[k] / m) / 2 for x in (p, r) if x.get(k))
    return math.sqrt(max(out, 0))


def expected(rows):
    """doc_id -> counts, distances and verdict of (doc_id, text, lang) rows."""
    classes, words = {}, {}
    for _, text, lang in rows:
        classes.setdefault(lang, Counter()).update(map(q.character_class, text or ""))
        words.setdefault(lang, Counter()).update(WORD.findall((text or "").lower()))
    out = {}
    for i, text, lang in rows:
        base, total = plain(text), sum(words[lang].values())
        common = {w for w, n in words[lang].items() if n * 500 >= total}
        fold = lambda c: Counter({w: n for w, n in c.items() if w in common}) + Counter({None: sum(n for w, n in c.items() if w not in common)})
        c = w = None
        if total >= 2000 and len(text or "") >= 500:
            c = distance(Counter(map(q.character_class, text)), classes[lang])
        if total >= 2000 and base[0] >= 100:
            w = distance(fold(Counter(WORD.findall(text.lower()))), fold(words[lang]))
        out[i] = (*base, c, w, not base[-1] and (c or 0) <= 0.25 and (w or 0) <= 0.35)
    return out


def same(rows, want):
    got = {r.doc_id: r for r in rows}
    assert set(got) == set(want)
    for i, w in want.items():
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) == (*w[:6], w[8]), i
        assert (r.class_distance, r.word_distance) == tuple(x if x is None else pytest.approx(x, abs=1e-7) for x in w[6:8])


def test_query_against_plain_counts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    want = expected([tuple(r) for r in docs.collect()])
    same(QUERIES["op13_quality_rules"](spark, "/root/testdata/sf0.01").collect(), want)
    assert {True, False} == {w[8] for w in want.values()}
    assert any(not w[5] and not w[8] for w in want.values())  # some fail by distance alone


ODD = [
    (1, None, "en"), (2, "", "en"), (3, " \n\t\x0b\x0c\r", None), (4, "a " * 40, None), (5, "x" * 300_000, "de"),
    (6, "one two three four five six seven eight " * 2 + " ".join(map(str, range(60))), "en"),
    (7, "line\nline\n \n \nother#$|<\nline", "xx"), (8, " nb sp  é 🙂 " * 30, None), (9, "\x1c\x1d\x85" * 25, "en"),
    (10, " ".join(f"w{i % 25}" for i in range(5000)), "de"),
]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(*r, 1, "x", True) for r in ODD], "doc_id long, text string, lang string, n_words int, ref string, kept boolean")
    want = expected(ODD)
    same(q.quality(docs).collect(), want)
    kept = q.keep_quality(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, w in want.items() if w[8]}
    twice = docs.unionByName(docs.filter("doc_id = 6")).selectExpr("nullif(doc_id, 6) doc_id", "text", "lang")
    assert q.quality(twice).filter("doc_id is null").count() == 2
    assert q.quality(docs.limit(0)).count() == 0 and q.keep_quality(docs.limit(0)).count() == 0


def test_references_of_another_corpus(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    refs = q.references(docs.filter("lang = 'en'"))
    ref = json.loads(refs.first().ref)
    assert refs.count() == 1 and len(ref["words"]) <= q.COMMON and ref["total"] > 100_000
    got = q.quality(docs, refs)
    assert got.join(docs, "doc_id").filter("lang <> 'en' and (class_distance is not null or word_distance is not null)").count() == 0
    german = q.quality(docs.filter("lang = 'de'").withColumn("lang", docs["lang"].substr(0, 0)), refs.selectExpr("'' lang", "ref"))
    compared = german.filter("not base_failed and word_distance is not null")
    assert compared.filter("kept").count() <= 0.05 * compared.count()  # some texts bear a wrong label


def test_junk_goes_and_prose_stays(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    judged = q.quality(docs).filter("not base_failed").join(labels, "doc_id")
    kept = {r.quality: r["avg(k)"] for r in judged.selectExpr("quality", "int(kept) k").groupBy("quality").avg("k").collect()}
    assert kept[1] > 0.995 and kept[0] < 0.25

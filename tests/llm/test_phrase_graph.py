"""Phrase counts, paths and collocations against plain counts."""

import random
import re
from collections import Counter

import pytest

from bazaarlens.llm import phrase_graph as g

SCHEMA = "doc_id long, text string, lang string, n string, w1 int, rank boolean"


def frame(spark, rows):
    return spark.createDataFrame([(i, text, lang, "x", 1, True) for i, (text, lang) in enumerate(rows)], SCHEMA)


def grams(rows):
    out = {}
    for text, lang in rows:
        lower = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                out.setdefault(lang or "und", Counter()).update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    return out


def expected(rows, least=10, top=2000):
    out = []
    for lang, f in grams(rows).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        found = []
        for p, a in f.items():
            if len(p) == 1 or a < least or any(len(q) > len(p) and c >= least and p in (q[:2], q[1:]) and 100 * c >= 50 * a for q, c in f.items()):
                continue
            score, k = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i, p.decode(), -a, x, y, n, -s) for i, (s, a, p, x, y) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


ODD = [
    (None, "en"), ("", None), (" \t \n", "en"), ("A b\x0bc\x0cd e.f", None), ("nul\x00word É é\xa0x \x1fy " * 12, None), ("ab ab ab ab " * 30_000, "de"),
    *[("New York, new\tyork! The New  York times", "en")] * 7, *[("q" * 50_000 + " tail", "fr")] * 11,
]


def test_odd_rows(spark):
    assert got(g.collocations(frame(spark, ODD))) == expected(ODD)
    assert g.collocations(frame(spark, ODD).limit(0)).count() == 0
    assert g.collocations(frame(spark, [("too few words", "en")])).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_random_texts(spark, monkeypatch, seed):
    rng = random.Random(seed)
    monkeypatch.setattr(g, "TOGETHER", 2000)
    rows = [(" ".join(rng.choice("abcdef") + rng.choice(["", "", ".", "\n"]) for _ in range(rng.randrange(80))), rng.choice(["en", "de", None])) for _ in range(150)]
    rows += [("one two three four five six seven", "en")] * 12
    assert got(g.collocations(frame(spark, rows), least=12, top=30)) == expected(rows, 12, 30)


def test_flows_and_sieve(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = grams([(r.text, r.lang) for r in docs.collect()])
    graph = g.phrase_graph(docs).collect()
    words, nodes, edges = Counter(), Counter(), {}
    for r in graph:
        words[r.lang, r.w1] += r.n
        nodes[r.lang, r.w1, r.w2] += r.n
        if r.w3 is not None:
            edges[r.lang, r.w1, r.w2, r.w3] = r.n
    assert words == {(lang, *p): c for lang, f in want.items() for p, c in f.items() if len(p) == 1}
    frequent = {(lang, *p): c for lang, f in want.items() for p, c in f.items() if len(p) == 2 and c >= 10}
    assert frequent and all(nodes[k] == c for k, c in frequent.items())
    assert edges == {(lang, *p): c for lang, f in want.items() for p, c in f.items() if len(p) == 3 and c >= 10}
    # nodes that cannot be candidates were cut off
    assert sum(k[2] is not None for k in nodes) < 0.2 * sum(len(p) == 2 for f in want.values() for p in f)


def test_paths(spark):
    passage = " ".join(f"w{i}" for i in range(200))
    rows = [(passage, "en")] * 12 + [("a b c a b c a b c a b", "de")] * 10 + [("z z z z", "fr")] * 10
    paths = {(r.lang, r.path): r for r in g.compact(g.phrase_graph(frame(spark, rows))).collect()}
    assert len(paths) == 3
    long = paths["en", "w0 w1 w2"]
    assert " ".join(long.words) == passage and long.counts == [12] * 198
    ring = paths["de", "a b c"]
    assert ring.words == ["a", "b", "c", "a", "b"] and ring.counts == [30, 30, 30]
    assert (paths["fr", "z z z"].words, paths["fr", "z z z"].counts) == (["z", "z", "z"], [20])


def test_long_paths_are_cut(spark, monkeypatch):
    monkeypatch.setattr(g, "PATH", 50)
    rows = [(" ".join(f"w{i}" for i in range(200)), "en")] * 10
    parts = sorted(g.compact(g.phrase_graph(frame(spark, rows))).collect(), key=lambda r: r.part)
    assert [len(r.counts) for r in parts] == [50, 50, 50, 48] and parts[1].words[0] == "w50"
    assert got(g.collocations(frame(spark, rows))) == expected(rows)


def test_counts_beyond_64_bits(spark):
    rows = spark.createDataFrame([(4_000_000_000, 5_000_000_000, 6_000_000_000)], "a long, l long, r long")
    assert rows.select(g._score(("l", "r")).alias("s")).first().s == 1000000 * 4_000_000_000**2 // (5_000_000_000 * 6_000_000_000)

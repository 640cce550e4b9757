"""Large dictionaries hit what one test per term hits, in one pass and with a plan that does not grow."""

import random
import re

from pyspark.sql import functions as F

from bazaarlens.functions.terms import find_labels, find_terms
from bazaarlens.functions.text import contains_any


def plain(text, terms, whole=False):
    if text is None:
        return None
    hits = []
    for t in {t for t in terms if t and t.strip()}:
        at = [m.start() for m in re.finditer(f"(?={re.escape(t)})", text)]
        at = [a for a in at if not whole or not (re.search(r"\w$", text[:a]) or re.match(r"\w", text[a + len(t) :]))]
        if at:
            hits.append((min(at), t))
    return [(t, a) for a, t in sorted(hits)]


def test_against_one_test_per_term(spark):
    rng = random.Random(1)
    terms = ["".join(rng.choice("abcé ") for _ in range(rng.randrange(1, 5))) for _ in range(300)] + ["", "  ", "a.b", "🙂b"]
    texts = ["".join(rng.choice("abcé .🙂_") for _ in range(rng.randrange(60))) for _ in range(200)] + [None, "", "a" * 50_000]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    for whole in (False, True):
        for r in df.withColumn("f", find_terms("text", terms, whole)).collect():
            assert (None if r.f is None else [tuple(x) for x in r.f]) == plain(r.text, terms, whole)
    known = [t for t in terms if t.strip()]
    both = df.select(F.size(find_terms("text", terms)) > 0, contains_any("text", known)).filter("text is not null").collect()
    assert all(a == b for a, b in both)


def test_labels(spark):
    df = spark.createDataFrame([("red shoe by acme",), ("acme acme",), ("none",), (None,)], "text string")
    words = {"brand": ["acme", "by ac"], "colour": ["red", "blue"], "thing": ["shoe", "acme"]}
    got = [None if r.f is None else [tuple(x) for x in r.f] for r in df.select(find_labels("text", words).alias("f")).collect()]
    assert got == [[("colour", 0), ("thing", 4), ("brand", 9)], [("brand", 0), ("thing", 0)], [], None]


def test_plans_do_not_grow_with_the_dictionary(spark):
    df = spark.range(3).selectExpr("concat('text of term', id, '7 and more') text")
    size = lambda n: len(df.select(find_terms("text", [f"term{i}" for i in range(n)]))._jdf.queryExecution().toString())
    assert abs(size(20_000) - size(10)) < 50
    got = df.select(find_terms("text", [f"term{i}" for i in range(20_000)]).alias("f")).collect()
    assert [[x.term for x in r.f] for r in got] == [[f"term{i}", f"term{i}7"] if i else ["term0"] for i in range(3)]
    assert df.select(find_terms("text", [])).first()[0] == []

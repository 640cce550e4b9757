"""The field against enumeration of all label sequences, and held-out accuracy."""

import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaarlens.llm import language_crf
from bazaarlens.llm.language_crf import Labeller, features, fit, forward_backward, keep_languages, predict_languages, sample, train


def test_forward_backward_sums_over_all_labellings():
    rng = np.random.default_rng(3)
    lengths, k = np.array([3, 1, 5, 3]), 3
    scores, begin, step = rng.normal(size=(12, k)), rng.normal(size=k), rng.normal(size=(k, k))
    got, expected = forward_backward(scores, lengths, begin, step, transitions=True)
    want, moves, at = np.zeros((12, k)), np.zeros((k, k)), 0
    for n in lengths:
        chances = {
            y: np.exp(begin[y[0]] + sum(scores[at + i, y[i]] for i in range(n)) + sum(step[a, b] for a, b in zip(y, y[1:])))
            for y in itertools.product(range(k), repeat=int(n))
        }
        total = sum(chances.values())
        for y, c in chances.items():
            for i, label in enumerate(y):
                want[at + i, label] += c / total
            for a, b in zip(y, y[1:]):
                moves[a, b] += c / total
        at += n
    assert np.allclose(got, want) and np.allclose(expected, moves)


def test_features_of_a_word_do_not_depend_on_its_neighbours():
    one, of, whole = features(["ab", "éa", "ab"])
    alone, _, single = features(["éa"])
    assert sorted(one[of == 1]) == sorted(alone) and whole[1] == single[0]
    assert whole[0] == whole[2] != whole[1] and sorted(one[of == 0]) == sorted(one[of == 2])


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_held_out_accuracy(spark, folder):
    from bazaarlens.llm.queries import op9_language_crf

    docs = {r.doc_id: r for r in spark.read.parquet(f"/root/testdata/{folder}/documents.parquet").collect()}
    rows = op9_language_crf(spark, f"/root/testdata/{folder}").collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    right = sum(r.lang_pred == docs[r.doc_id].lang for r in held)
    assert right >= 0.98 * len(held), (right, len(held))


def test_words_of_code_switched_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labeller = Labeller(train(docs))
    by_lang = {r.lang: r.text for r in docs.filter("n_chars between 400 and 700").dropDuplicates(["lang"]).collect()}
    a, b = by_lang["de"].split()[:40], by_lang["es"].split()[:40]
    (n,), chance = labeller.word_chances([" ".join(a + b)])
    got = [labeller.field.labels[i] for i in chance.argmax(1)]
    half = sum(len(language_crf._WORDS.findall(w)) for w in a)
    assert sum(x == "de" for x in got[:half]) > 0.9 * half and sum(x == "es" for x in got[half:]) > 0.9 * (n - half)
    assert np.allclose(chance.sum(1), 1)


def test_only_the_allowed_rows_are_learned_from(spark):
    docs = spark.createDataFrame([(i, "aaa bbb ccc " * 50, "x" if i % 2 else None) for i in range(40)], "doc_id long, text string, lang string")
    got = sample(docs, per_language=5)
    assert len(got) == 5 and all(label == "x" for label, _ in got)
    held = docs.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
    assert sample(held) == [] and fit([]) is None


def test_odd_rows(spark):
    texts = [(1, "the cat and the dog", "en"), (2, "el gato y el perro", "es")] * 30
    rows = [(i, t, x) for i, (_, t, x) in enumerate(texts)]
    field = train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    odd = [(1, None, "a"), (2, "", "b"), (3, "12 ² !? __", "c"), (None, "the dog", None), (5, "perro " * 300_000, "z"), (6, "the" * 9000, "z"), (3, "el gato", "c")]
    docs = spark.createDataFrame([(*x, True, 1.5) for x in odd], "doc_id long, text string, lang string, held_out boolean, score double")
    got = predict_languages(docs, field).collect()
    assert [(r.doc_id, r.lang_pred) for r in got if r.lang_pred == "und"] == [(1, "und"), (2, "und"), (3, "und")]
    assert {(r.doc_id, r.lang_pred) for r in got} >= {(None, "en"), (5, "es"), (3, "es")}
    assert keep_languages(docs, field).columns == docs.columns and keep_languages(docs, field).count() <= 4
    assert predict_languages(docs.limit(0), field).count() == 0
    assert {(r.lang_pred, r.score) for r in predict_languages(docs, None).collect()} == {("und", 0.0)}


def test_every_letter_of_a_long_run_counts(spark):
    rows = [(i, x, y) for i in range(30) for x, y in ((f"the cat and the dog {'abab' * 40}", "en"), (f"el gato y el perro {'xyxy' * 40}", "es"))]
    rows = [(i, t, x) for i, (_, t, x) in enumerate(rows)]
    labeller = Labeller(train(spark.createDataFrame(rows, "doc_id long, text string, lang string")))
    long = "a" + "ab" * 20 + "xy" * 50_000 + "ab" * 20
    (n,), chance = labeller.word_chances([long])
    assert n == -(-len(long) // 64)
    assert labeller.predict([long])[0][0] == "es" and labeller.predict([long.replace("xy", "ab")])[0][0] == "en"


def test_labels_with_only_long_runs_are_learned(spark):
    rows = [(i, ("abc" if i % 2 else "xyz") * 200, "p" if i % 2 else "q") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = sample(docs)
    assert all(len(w) <= 64 and "".join(s) in t for (label, slices) in learned for s in slices for w in s for t in ["abc" * 200 if label == "p" else "xyz" * 200])
    field = fit(learned)
    assert field.labels == ["p", "q"]
    assert [x for x, _ in Labeller(field).predict(["abc" * 5000, "xyz" * 5000])] == ["p", "q"]


def test_the_sample_has_the_smallest_hashes(spark):
    docs = spark.range(20_000).selectExpr("id doc_id", "concat('word', char(97 + cast(id % 7 as int)), ' text') text", "if(id % 3 = 0, 'a', concat('l', id % 5)) lang")
    for k in (1, 50, 5000):
        got = sorted(map(tuple, language_crf._least_hashes(docs.select("lang", "doc_id"), k).collect()))
        want = docs.selectExpr("lang", "doc_id", "row_number() over (partition by lang order by xxhash64(doc_id), doc_id) n").filter(F.col("n") <= k)
        assert got == sorted((r.lang, r.doc_id) for r in want.collect())


def test_too_many_labels_are_refused(spark, monkeypatch):
    monkeypatch.setattr(language_crf, "MAX_LABELS", 3)
    docs = spark.range(40).selectExpr("id doc_id", "'some text' text", "concat('l', id % 5) lang")
    with pytest.raises(ValueError, match="5 labels"):
        sample(docs)

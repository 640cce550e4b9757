"""SimHash: fingerprints by definition, trees and components by brute force."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from bazaarlens.llm.components import components
from bazaarlens.llm.simhash import BKTree, _masks, close_links, drop_near_duplicates, fingerprint, near_duplicates, star


def plain(text: str, n: int = 3) -> int:
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values: list[int], radius: int) -> dict[int, int]:
    """The least member of every value's group, by comparing all."""
    root = {v: v for v in values}
    changed = True
    while changed:
        changed = False
        for a in root:
            for b in root:
                if (a ^ b).bit_count() <= radius and root[b] < root[a]:
                    root[a], changed = root[b], True
    return root


def near(seed: int, n: int, flips: int = 4) -> list[int]:
    """Crowded fingerprints: a few centres with some flipped bits."""
    pick = random.Random(seed)
    centres = [pick.getrandbits(64) for _ in range(4)]
    return sorted({pick.choice(centres) ^ sum(1 << b for b in pick.sample(range(64), pick.randrange(flips + 1))) for _ in range(n)})


@pytest.mark.parametrize("text", ["", " \n", "One", "a b", "A b c d É é \x1c x", "x y z " * 70_000, "a\x0bb\x85c d"])
def test_fingerprint(text):
    assert fingerprint(text) == plain(text)


def test_fingerprint_agrees_with_spark(spark):
    got = spark.sql("SELECT xxhash64('one two three') AS h").first().h
    assert fingerprint("One two THREE") == got & (1 << 64) - 1


def test_tree_finds_all_within_the_radius():
    values = near(1, 300)
    tree = BKTree()
    for v in values + values[:9]:
        tree.add(v)
    for q in values[:60] + [0, (1 << 64) - 1]:
        assert sorted(tree.values[i] for i in tree.within(q, 3)) == [v for v in values if (v ^ q).bit_count() <= 3]


def test_star_keeps_groups():
    values = near(2, 250)
    links = star(values, 2)
    root = groups(values, 2)
    assert all(root[a] == root[b] for a, b in links)
    assert len(links) == len(values) - len(set(root.values()))


def test_every_close_pair_shares_a_shard_of_every_level():
    pick = random.Random(4)
    for level in (1, 2, 3):
        masks = [m for m, _ in _masks(level, 2)]
        assert len(masks) == 3**level
        for _ in range(200):
            a = pick.getrandbits(64)
            b = a ^ sum(1 << i for i in pick.sample(range(64), 2))
            assert any(a & m == b & m for m in masks)


@pytest.mark.parametrize("shard", [60, 1024])
def test_links_connect_what_brute_force_connects(spark, shard):
    values = near(3, 400)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    links = close_links(spark.createDataFrame(signed, "fp long"), 2, shard)
    found = {r.node: r.root for r in components(links).collect()}
    want = groups(values, 2)
    for (x,), v in zip(signed, values):
        same = {y for (y,), w in zip(signed, values) if want[w] == want[v]}
        assert found.get(x, x) == min(same)


def test_components_of_long_chains(spark):
    n = 60
    chain = [(i, i + 1) for i in range(0, n)] + [(i, 5000) for i in range(1000, 1400)] + [(7, 7), (None, 3), (2, 1)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, **{i: 1000 for i in range(1000, 1400)}, 5000: 1000}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_query(spark, folder):
    from bazaarlens.llm.queries import op7_simhash

    docs = spark.read.parquet(f"/root/testdata/{folder}/documents.parquet").select("doc_id", "text").collect()
    fps = {r.doc_id: plain(r.text or "") for r in docs}
    root = groups(sorted(set(fps.values())), 2)
    least: dict[int, int] = {}
    for doc_id, fp in fps.items():
        least[root[fp]] = min(least.get(root[fp], doc_id), doc_id)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op7_simhash(spark, f"/root/testdata/{folder}").collect()}
    assert got == {i: (f"{fp:016x}", least[root[fp]]) for i, fp in fps.items()}


def test_odd_rows(spark):
    rows = [(4, None), (2, ""), (9, " \t\n"), (None, "a b c d"), (7, "A b  c\nd"), (7, "A b c d"), (8, "w " * 100_000), (None, "alone here")]
    docs = spark.createDataFrame([(*r, 5, "x") for r in rows], "doc_id long, text string, fp long, component_id string")
    got = near_duplicates(docs).collect()
    assert sorted((r.doc_id, r.component_id) for r in got if r.doc_id) == [(2, 2), (4, 2), (7, 7), (7, 7), (8, 8), (9, 2)]
    assert sorted(str(r.component_id) for r in got if r.doc_id is None) == ["7", "None"]
    assert near_duplicates(docs.limit(0)).count() == 0
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert kept.filter(F.col("doc_id").isin(4, 9)).count() == 0 and kept.filter("doc_id is null").count() == 2


def test_rows_are_dropped_one_by_one(spark):
    one, two, three = "a b c d e f", "u v w x y z unlike", "k l m n o p other"
    rows = [(3, one, 0), (7, one.upper(), 1), (7, two, 2), (5, three, 3), (5, three.upper(), 4), (5, three, 5), (8, three, 6)]
    rows += [(None, "only rows without id", 7), (None, "only rows WITHOUT id", 8), (None, "only rows without id", 9)]
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, row_key int, key string")
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    got = sorted((str(r.doc_id), r.text.lower()) for r in kept.collect())
    assert got == [("3", one), ("5", three), ("7", two), ("None", "only rows without id")]
    assert set(kept.collect()) <= set(docs.collect())
    assert drop_near_duplicates(docs.limit(0)).count() == 0

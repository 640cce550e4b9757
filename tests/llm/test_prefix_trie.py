"""The trie of conversations against one that is built turn by turn."""

import hashlib
import random
import re
import zlib

import pytest

from bazaarlens.llm.prefix_trie import prefix_trie
from bazaarlens.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, depth string, n boolean"


def rebuilt(rows, group, most):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most if most else 0
        base = abs(c) // group * group * (1 if c > 0 else -1)
        out[c] = own.get(base, [])[:h] + turns[h:] if most else turns
    return out


def expected(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = set()
    for prefix, cs in members.items():
        below = [p for p in members if p[: len(prefix)] == prefix]
        children = [p for p in below if len(p) == len(prefix) + 1]
        leaves = sum(not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below) for p in below)
        saved = sum((len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in below if p)
        ends = ",".join(str(c) for c in sorted(c for c in cs if len(convs[c]) == len(prefix)))
        parent = min(members[prefix[:-1]]) if prefix else None
        out.add((min(cs), len(prefix), parent, len(cs), len(children), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    assert len(out) == len(members)
    return out


def got(df):
    rows = [tuple(r)[:8] for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(QUERIES["op12_prefix_trie"](spark, folder)) == expected(rebuilt(rows, 20, 4))


@pytest.mark.parametrize("shard", [1, 3, 1000])
@pytest.mark.parametrize("most", [0, 4])
def test_random_conversations(spark, shard, most):
    rng = random.Random(shard * 10 + most)
    rows = []
    for c in range(-45, 80):
        if c % 23 == 0:
            continue  # also some group that has no first conversation
        for t in range(rng.choice([0, 1, 2, 3, 4, 12])):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["a b", "c", "", "x y z"])))
    df = spark.createDataFrame([(*r, "d", True) for r in rows], SCHEMA)
    assert got(prefix_trie(df, 20, most, shard)) == expected(rebuilt(rows, 20, most))


def test_copies_and_odd_rows(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(40) for t in range(3)]  # one large group of copies
    rows += [(100, None, None, None), (100, 0, "user", "turn 0"), (101, 5, None, "long " * 50_000), (101, None, "", ""), (None, 0, "user", "lost")]
    rows += [(102, 0, "user", "again"), (102, 0, "user", "again"), (103, 0, "user", "again"), (-7, 9, "us", "erx"), (-8, 9, "use", "rx")]
    for shard in (2, 1000):
        df = spark.createDataFrame([(*r, "d", True) for r in rows], SCHEMA)
        assert got(prefix_trie(df, shard=shard)) == expected(rebuilt(rows, 1, 0))
    root = prefix_trie(df).filter("depth = 0").first()
    assert (root.conv_id, root.parent_conv_id, root.n_convs) == (-8, None, 46)
    assert prefix_trie(df.limit(0)).count() == 0


def test_deep_conversations(spark):
    rows = [(c, t, "user", "same" if c < 3 else f"{c}") for c in range(4) for t in range(700)]
    assert got(prefix_trie(spark.createDataFrame([(*r, "d", True) for r in rows], SCHEMA))) == {
        *((0, d, 0, 3, int(d < 700), 1, 2 * (701 - d), hashlib.sha256(b"0,1,2" if d == 700 else b"").hexdigest()) for d in range(1, 701)),
        *((3, d, 0 if d == 1 else 3, 1, int(d < 700), 1, 0, hashlib.sha256(b"3" if d == 700 else b"").hexdigest()) for d in range(1, 701)),
        (0, 0, None, 4, 2, 2, 1400, hashlib.sha256(b"").hexdigest()),
    }


def test_lists_of_ending_ids_are_cut_into_pieces(spark, monkeypatch):
    monkeypatch.setattr("bazaarlens.llm.prefix_trie.PIECE", 7)
    df = spark.range(3000).selectExpr("id conv_id", "0 turn", "'user' role", "'hello' text")
    leaf = prefix_trie(df).filter("depth = 1").first()
    assert leaf.n_convs == 3000 and leaf.ends_sha256 == hashlib.sha256(",".join(map(str, range(3000))).encode()).hexdigest()

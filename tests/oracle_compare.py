"""Run registered queries next to their check SQL in DuckDB.

usage: python tests/oracle_compare.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "float": "FLOAT", "tinyint": "TINYINT",
}


SPENT: dict[str, float] = {}


def connect(sf: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def cell(v):
    if v is None:
        return "~"
    if isinstance(v, float):
        return "~nan" if math.isnan(v) else repr(v + 0.0)
    return str(v)


def compare(spark, con, name, fn, sql, sf, need_rows=True) -> str | None:
    """None when equal, else what differs."""
    df = fn(spark, sf)
    cols = sorted(df.columns)
    got = df.select(*[f"`{c}`" for c in cols])
    rel = con.sql(sql)
    theirs = dict(zip(rel.columns, [str(t) for t in rel.types]))
    if sorted(theirs) != cols:
        return f"columns {cols} vs {sorted(theirs)}"
    types = {c: KINDS.get(t, t) for c, t in got.dtypes}
    bad = {c: (types[c], theirs[c]) for c in cols if types[c] != theirs[c]}
    if bad:
        return f"types {bad}"
    start = time.time()
    mine = sorted(tuple(cell(v) for v in row) for row in got.collect())
    SPENT[name] = time.time() - start
    want = sorted(
        tuple(cell(v) for v in row) for row in con.sql(f"SELECT {', '.join(chr(34) + c + chr(34) for c in cols)} FROM ({sql})").fetchall()
    )
    if len(mine) != len(want):
        return f"rows {len(mine)} vs {len(want)}; extra {list(set(mine) - set(want))[:2]} missing {list(set(want) - set(mine))[:2]}"
    if mine != want:
        diff = [(a, b) for a, b in zip(mine, want) if a != b]
        return f"{len(diff)} rows differ: {diff[:2]}"
    if need_rows and not mine:
        return "no rows"
    return None


def main(argv) -> int:
    from bazaarlens.session import local_session
    import __spark_entry__ as entry

    args = argv[1:]
    sf = "/root/testdata/sf0.01"
    if args and args[0].startswith("/"):
        sf = args.pop(0)
    spark = local_session("check")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    queries, oracle = entry.queries(), entry.oracle_sql()
    names = [n for n in queries if not args or any(n.startswith(p) for p in args)]
    bad = 0
    for n in names:
        start = time.time()
        try:
            if n in oracle:
                why = compare(spark, con, n, queries[n], oracle[n], sf)
                note = "ok" if why is None else f"BAD {why}"
                bad += why is not None
            else:
                note = f"rows {queries[n](spark, sf).count()}"
        except Exception as e:  # noqa: BLE001
            bad += 1
            note = "ERR " + str(e)[:1500]
        print(f"{time.time() - start:6.2f}s (Spark {SPENT.get(n, 0):.2f}s) {n}: {note}", flush=True)
    print(f"{len(names)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv))

"""Operators that SQL can express: against their SQL, and on rows that the tables do not hold."""

import base64
import gzip
import hashlib
import random
import struct

import numpy as np
import pytest
from oracle_compare import compare, connect
from pyspark.sql import functions as F

from bazaarlens.llm import warc
from bazaarlens.llm.block_neighbours import Tiles, nearest
from bazaarlens.llm.exact_dedup import drop_duplicates, duplicates
from bazaarlens.llm.licence_rules import licences
from bazaarlens.llm.preference import edited_preferences, preferences, records, swapped_answers
from bazaarlens.llm.queries import ORACLE, QUERIES
from bazaarlens.llm.warc import Archive, parse, read_archive, read_archives, record, write_archives

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLE))
def test_query(spark, name):
    assert compare(spark, connect(SF), name, QUERIES[name], ORACLE[name], SF) is None


@pytest.mark.parametrize("name", ["op2_licence_rules", "op4_preference", "op10_exact_dedup"])
def test_native_plans(spark, name):
    text = QUERIES[name](spark, SF)._jdf.queryExecution().toString()
    assert not any(x in text for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))


def test_records_have_what_the_standard_requires(spark, tmp_path):
    import zstandard

    pages = spark.createDataFrame([(1, "http://a", "x" * 2000), (2, "http://b\r\nX-Bad: 1", "x" * 2000), (2, "http://c", "y"), (2, "http://c", "y"), (None, None, None)], "page_id long, url string, html string")
    manifest = write_archives(pages.coalesce(1), str(tmp_path), date="2026-01-02T03:04:05Z")
    data = open(manifest.first().path.removeprefix("file:"), "rb").read()
    size = struct.unpack("<I", data[4:8])[0]
    unpress, at, heads = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size])), data[8 + size :], []
    while at:
        frame = unpress.decompressobj()
        heads.append(frame.decompress(at).partition(b"\r\n\r\n")[0].decode().split("\r\n"))
        at = frame.unused_data
    fields = [dict(line.split(": ", 1) for line in h[1:]) for h in heads]
    assert len(fields) == 5 and all(h[0] == "WARC/1.1" for h in heads)
    for f in fields:
        assert {"WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length", "Content-Type"} <= set(f) and f["WARC-Date"] == "2026-01-02T03:04:05Z" and "X-Bad" not in f
    assert len({f["WARC-Record-ID"] for f in fields}) == 5 and all(f["WARC-Record-ID"].startswith("<urn:uuid:") for f in fields)
    (revisit,) = [f for f in fields if f["WARC-Type"] == "revisit"]
    assert revisit["WARC-Refers-To-Target-URI"] == "http://bX-Bad: 1" and revisit["X-Refers-To-Page-ID"] == "2" and "WARC-Profile" in revisit


# exact duplicates


def test_duplicates_of_odd_rows(spark):
    rows = [(1, "a b"), (2, "ab"), (3, "a  b"), (4, None), (5, " \n"), (None, "a  b"), (7, "x"), (7, "x"), (8, "é 🙂")]
    docs = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, group_size int, keep_id string")
    got = sorted((str(r.doc_id), r.keep_id, r.group_size, r.kept) for r in duplicates(docs).collect())
    assert got == sorted(
        [("1", 3, 4, False), ("2", 3, 4, False), ("3", 3, 4, True), ("None", 3, 4, False), ("4", 5, 2, False), ("5", 5, 2, True),
         ("7", 7, 2, True), ("7", 7, 2, True), ("8", 8, 1, True)]
    )
    kept = drop_duplicates(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [3, 5, 7, 7, 8]
    assert duplicates(docs.limit(0)).count() == 0


def test_frequent_texts_are_split_off(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"))
    got = duplicates(docs, support=0.05)
    assert got.filter("kept").count() == 2001
    assert got.filter("group_size = 1000 and keep_id = 0").count() == 1000


# nearest neighbours


@pytest.mark.parametrize("block,query_block", [(16, 7), (4096, 8192)])
def test_neighbours_of_an_id_with_many_vectors(spark, block, query_block):
    rng = np.random.default_rng(block)
    whole = lambda n, wide: np.rint(rng.normal(size=(n, 6)) * wide).tolist()
    rows = [(20, v) for v in whole(30, 900)] + [(100 + i, v) for i, v in enumerate(whole(101, 99))] + [(201 + i % 3, v) for i, v in enumerate(whole(30, 500))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in nearest(frame, every=20, k=20, query_block=query_block, block=block).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == {20, 100, 120, 140, 160, 180, 200}
    for q, found in got.items():
        score = lambda a, b: sum(x * y for x, y in zip(a, b))
        ranked = sorted((-score(v, w), i) for p, v in rows if p == q for i, w in rows if i != q)[:20]
        assert sorted(found) == [(n, i, -s) for n, (s, i) in enumerate(ranked, 1)]


@pytest.mark.parametrize("block", [16, 4096])
def test_nearest_against_all_pairs(spark, block):
    rng = np.random.default_rng(block)
    x = np.round(rng.normal(size=(300, 8)) * 3).astype(np.float32)
    x[50:90] = x[50]  # one common vector
    ids = [*range(299), 298]
    odd = [(500, None), (501, []), (502, [0.0] * 8), (503, [None, *[1.0] * 7]), (504, [float("nan")] * 8), (505, [float("inf")] * 8), (None, [1.0] * 8), (520, [1.0, 2.0]), (540, [3.0, 4.0])]
    rows = [(i, [float(c) for c in v]) for i, v in zip(ids, x)] + [(3, [float(c) for c in x[3]])] + odd
    frame = spark.createDataFrame([(*r, 1.0, "c") for r in rows], "vec_id long, embedding array<float>, score double, dim string")
    got = {}
    for r in nearest(frame, every=20, k=5, query_block=7, block=block).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = {}
    for q, v in {(i, tuple(v)) for i, v in rows if i is not None and i % 20 == 0 and i not in (500, 501, 502, 503, 504, 505)}:
        found = {(i, w) for i, w in ((i, tuple(w)) for i, w in rows if i is not None and i != q and w and len(w) == len(v)) if None not in w and any(w) and all(map(np.isfinite, w))}
        ranked = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in found))[:5]
        want[q] = [(n, i, -s) for n, (s, i) in enumerate(ranked, 1)]
    assert {q: sorted(r) for q, r in got.items()} == want
    assert nearest(frame.limit(0)).count() == 0


def test_tiles_compute_few_pairs_again():
    rng = np.random.default_rng(1)
    q, y = rng.normal(size=(40, 64)), rng.normal(size=(2000, 64))
    tiles, seen = Tiles(q, np.arange(40) - 100, 10), []
    import bazaarlens.llm.block_neighbours as module

    original = module.inner
    module.inner = lambda a, b: seen.append(len(a)) or original(a, b)
    try:
        tiles.add(y, np.ones(2000, np.int64), np.arange(2000))
    finally:
        module.inner = original
    assert sum(seen) < 40 * 30
    best = np.argsort(-(q @ y.T), axis=1)[:, :10]
    assert all({-i for _, i in h} == set(b.tolist()) for h, b in zip(tiles.heaps, best))


# WARC


def test_archives_of_odd_rows(spark, tmp_path):
    long = "<p>é</p>" * 200
    rows = [(1, "http://a/\r\nX: y", long), (2, "http://b", long), (9, None, long), (3, "u", None), (4, "u", "short"), (5, "u", "short"), (None, "u", long), (6, "u", ""), (7, "u", "z" * 3_000_000), (9, "again", long)]
    pages = spark.createDataFrame([(*r, 1, "s") for r in rows], "page_id long, url string, html string, refers_to int, digest string")
    got = read_archives(write_archives(pages, str(tmp_path)), with_payload=True).collect()
    seen = sorted((str(r.page_id), r.record_type, r.refers_to) for r in got)
    assert seen == sorted(
        [("1", "revisit", 9), ("2", "revisit", 9), ("9", "response", None), ("9", "response", None), ("None", "revisit", 9)]
        + [(str(i), "response", None) for i in (3, 4, 5, 6, 7)]
    )
    by_id = {r.page_id: r for r in got}
    for page_id, _, html in rows:
        data = (html or "").encode()
        assert by_id[page_id].payload_bytes == len(data) and by_id[page_id].payload_digest == hashlib.sha1(data).hexdigest()
        assert by_id[page_id].payload in (data, None)
    assert read_archives(write_archives(pages.limit(0), str(tmp_path))).count() == 0


def test_archive_layout(tmp_path):
    """A dictionary frame first, then one frame a record, each of which can be read alone."""
    import zstandard

    pick = random.Random(1)
    archive = Archive(str(tmp_path))
    wanted = []
    for i in range(900):
        payload = ("<html>" + " ".join(pick.choice(["alpha", "beta", "gamma", str(i)]) for _ in range(900))).encode()
        wanted.append(record(i, f"http://x/{i}", payload, hashlib.sha1(payload).digest(), None))
        archive.add(wanted[-1])
    archive.close()
    data = open(archive.path, "rb").read()
    magic, size = struct.unpack_from("<II", data)
    assert magic == 0x184D2A5D
    unpress = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size]))
    found = list(read_archive(archive.path, step=777))
    assert [r["page_id"] for _, r in found] == list(range(900))
    for i in (0, 417, 899):
        assert unpress.decompressobj().decompress(data[found[i][0] :]) == wanted[i]
    assert len(data) < len(gzip.compress(b"".join(wanted))) * 2
    fields = parse(wanted[5])
    assert base64.b32encode(bytes.fromhex(fields["payload_digest"])).decode() in wanted[5].decode()
    with pytest.raises(ValueError):
        parse(wanted[5].replace(b"alpha", b"alphx", 1))


# licences


def test_licences_of_odd_rows(spark):
    apache = "Licensed under the Apache License, Version 2.0.\nYou may not use this file except in compliance with the License."
    rows = [
        (1, "text here.\nReleased under the MIT License."), (2, None), (3, ""), (4, apache), (5, apache + " Released under the MIT license! All rights reserved"),
        (6, "You may not use this file except in compliance with the License."), (7, "released under the MIT License. " * 3), (8, "x " * 500_000 + ".\nLicensed under CC BY-NC 4.0."), (None, "no licence"),
        (9, "Licensed under the Apache License, Version 2.0. Released under the MIT License. You may not use this file except in compliance with the License."),
    ]
    docs = spark.createDataFrame([(*r, "i", "a") for r in rows], "doc_id long, text string, ids string, all string")
    got = {r.doc_id: (r.sentence_ids, r.licences, r.unmatched) for r in licences(docs).collect()}
    assert got == {
        1: ("mit_name", "MIT", ""), 2: ("", "", ""), 3: ("", "", ""), None: ("", "", ""),
        4: ("apache_name,apache_compliance", "Apache-2.0", ""), 5: ("apache_name,apache_compliance,mit_name,reserved", "Apache-2.0,MIT,Proprietary", ""),
        6: ("apache_compliance", "", "apache_compliance"), 7: ("mit_name,mit_name,mit_name", "MIT", ""), 8: ("ccbync4_name", "CC-BY-NC-4.0", ""),
        9: ("apache_name,mit_name,apache_compliance", "MIT,Apache-2.0", "apache_compliance"),
    }
    assert licences(docs.limit(0)).count() == 0


WRAPPED = {
    "MIT": """MIT License

Copyright (c) 2020 A. Body. All rights reserved.

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS BE LIABLE""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law""",
    "GPL-3.0-or-later": """Foo is made of words

    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope""",
    "GPL-2.0-or-later": """This program is free software; you can redistribute it and/or
modify it under the terms of the GNU General Public License
as published by the Free Software Foundation; either version 2
of the License, or (at your option) any later version.""",
    "BSD-2-Clause": """Copyright (c) 2020, A Body
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL""",
    "GPL-3.0-only": "This work is licensed under the GNU\nGeneral Public License, version 3.",
    "CC-BY-NC-4.0": "This work is licensed under a Creative Commons\nAttribution-NonCommercial 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons\nAttribution-ShareAlike 4.0 International License.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution\n4.0 International License.",
    "Proprietary": "Copyright 2020 A Body\nAll rights\nreserved.",
}
WRAPPED["BSD-3-Clause"] = WRAPPED["BSD-2-Clause"].replace("THIS SOFTWARE IS", """3. Neither the name of A Body nor the names of its contributors may be used to
   endorse or promote products derived from this software without specific
   prior written permission.

THIS SOFTWARE IS""")


@pytest.mark.parametrize("begin,leader,end", [("", "", ""), ("/*\n", " * ", "\n */"), ("", "# ", ""), ("", ";; ", ""), ("x = 1\r\n", "// ", ""), ("dnl\n", "dnl ", "")])
def test_wrapped_licences(spark, begin, leader, end):
    rows = [(name, begin + "\n".join(leader + line for line in text.split("\n")).replace("\n", "\r\n" if "\r" in begin else "\n") + end) for name, text in WRAPPED.items()]
    rows += [(f"{name} ", "some words without an end |\n" + text + "\nmore words") for name, text in rows]
    docs = spark.createDataFrame(list(enumerate(t for _, t in rows)), "doc_id long, text string")
    got = {rows[r.doc_id][0]: (r.licences, r.unmatched) for r in licences(docs).collect()}
    assert got == {name: (name.strip(), "") for name, _ in rows}


NOTICES = {
    "This project is licensed under the terms of the MIT license.": "MIT",
    "// SPDX-License-Identifier: MIT": "MIT",
    "/* SPDX-License-Identifier: GPL-2.0-or-later */": "GPL-2.0-or-later",
    "Released under the BSD 3-Clause License.": "BSD-3-Clause",
    "This software is distributed under the\nBoost Software License, Version 1.0.": "BSL-1.0",
    """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.""": "LGPL-2.1-or-later",
    """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU Affero General Public License as published
    by the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.""": "AGPL-3.0-or-later",
    """ * This program is free software; you can redistribute it and/or modify
 * it under the terms of the GNU General Public License version 2 as
 * published by the Free Software Foundation.""": "GPL-2.0-only",
    """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.""": "MPL-2.0",
    """Copyright (c) 2020 A Body

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.""": "ISC",
    "This is free and unencumbered software released into the public domain.": "Unlicense",
    """This software is provided 'as-is', without any express or implied warranty.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:""": "Zlib",
    # a known end is found however many words stand before it
    WRAPPED["BSD-3-Clause"].replace("name of A Body", "name of A Body " + "and another body " * 200): "BSD-3-Clause",
    "Neither " + "word " * 100_000 + "is licensed": "",
}


def test_notices(spark):
    docs = spark.createDataFrame(list(enumerate(NOTICES)), "doc_id long, text string")
    got = {list(NOTICES)[r.doc_id]: (r.licences, r.unmatched) for r in licences(docs).collect()}
    assert got == {text: (licence, "") for text, licence in NOTICES.items()}


def test_sentences_end_at_marks_and_blank_lines(spark):
    texts = ["Released under.\nThe MIT License", "Released\n\nunder the MIT License", "# Released\n#\n# under the MIT License", "not released under the MIT License"]
    texts += ["é。" * 300_000 + "a", "a\n" * 300_000, "; " * 300_000, "a " * 300_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {(r.sentence_ids, r.licences) for r in licences(docs).collect()} == {("", "")}


# preferences


def test_preferences(spark):
    schema = "pair_id long, turn long, role string, text string, part string"
    good = [(1, 0, "user", "q"), (1, 1, "assistant", "yes"), (2, 0, "user", "q"), (2, 1, "assistant", "a"), (2, 2, "user", "same"), (3, 0, "user", None), (3, None, "system", "s"), (4, 0, "user", "only"), (None, 0, "user", "x"), (1, 0, "user", "q"), (5, 0, "user", "a"), (5, 0, "user", "b")]
    bad = [(1, 0, "user", "q"), (1, 1, "assistant", "no"), (1, 2, "user", "more"), (2, 0, "user", "q"), (2, 1, "assistant", "b"), (2, 2, "user", "same"), (3, 0, "user", None), (3, None, "system", "s"), (5, 0, "user", "a"), (5, 0, "user", "c")]
    frame = lambda rows: spark.createDataFrame([(*r, "p") for r in rows], schema)
    turns = preferences(frame(good), frame(bad)).cache()
    got = {r.pair_id: r for r in records(turns).collect()}
    say = lambda role, text: f"<|im_start|>{role}\n{text}<|im_end|>\n"
    q = say("user", "q")
    assert (got[1].prompt, got[1].chosen, got[1].rejected) == (q, say("assistant", "yes"), say("assistant", "no") + say("user", "more"))
    assert (got[2].chosen, got[2].rejected) == (say("assistant", "a") + say("user", "same"), say("assistant", "b") + say("user", "same"))
    assert (got[3].prompt, got[3].chosen, got[3].rejected) == (say("system", "s") + say("user", ""), "", "")
    assert (got[4].prompt, got[4].chosen, got[4].rejected) == ("", say("user", "only"), "")
    assert (got[5].prompt, got[5].chosen, got[5].rejected) == (say("user", "a"), say("user", "b"), say("user", "c"))
    assert set(got) == {1, 2, 3, 4, 5}
    for r in got.values():
        for side, spans in ((r.chosen, r.chosen_trained), (r.rejected, r.rejected_trained)):
            whole = r.prompt + side
            assert all(whole[s.start : s.end].startswith("<|im_start|>assistant") for s in spans)
    assert preferences(frame(good[:0]), frame(bad[:0])).count() == 0


def _paired_by_hand(good, bad):
    """Rows of both sides (pair_id, turn, role, text), turn by turn."""
    order = lambda r: (r[1], r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")
    out = set()
    for pair in {r[0] for r in good + bad if r[0] is not None}:
        sides = []
        for rows in (good, bad):
            own = sorted({(p, -1 if t is None else t, role, text) for p, t, role, text in rows if p == pair}, key=order)
            at, placed = 0, []
            for i, (_, turn, role, text) in enumerate(own):
                rendered = f"<|im_start|>{role or ''}\n{text or ''}<|im_end|>\n"
                copy = 1 + sum(x[1] == turn for x in own[:i])
                placed.append((pair, turn, copy, role, rendered, at, at + len(rendered), text))
                at += len(rendered)
            sides.append(placed)
        same = 0
        while same < min(map(len, sides)) and sides[0][same] == sides[1][same]:
            same += 1
        out |= {("prompt", *x[:-1], False) for x in sides[0][:same]}
        for name, side in zip(("chosen", "rejected"), sides, strict=True):
            out |= {(name, *x[:-1], x[3] == "assistant") for x in side[same:]}
    return out


@pytest.mark.parametrize("seed", range(3))
def test_preferences_by_hand(spark, seed, monkeypatch):
    pick = random.Random(seed)
    monkeypatch.setattr("bazaarlens.llm.preference.STRETCH", 4)
    some = lambda n: [(pick.choice([None, 0, 1, 2, 3]), pick.choice([None, *range(-2, 12)]), pick.choice([None, "user", "assistant"]), pick.choice([None, "", "a", "b é"])) for _ in range(n)]
    good, changes = some(60), some(6)
    # ids far from the others are on one side only
    good, bad = good + [(7, 1, "user", "x")], good + changes + [(8, 2, "assistant", "y")] * 2
    schema = "pair_id long, turn long, role string, text string, part string, n long"
    frame = lambda rows: spark.createDataFrame([(*r, "p", 1) for r in rows], schema)
    read = lambda out: [(r.part, r.pair_id, r.turn, r.copy, r.role, r.rendered, r.char_start, r.char_end, r.trained) for r in out.collect()]
    rows = read(preferences(frame(good), frame(bad)))
    assert len(rows) == len(set(rows)) and set(rows) == _paired_by_hand(good, bad)
    # edits: the same as both sides written out
    at = lambda r: (r[0], -1 if r[1] is None else r[1], r[2])
    gone = {at(r) for r in changes}
    rows = read(edited_preferences(frame(good), frame(changes)))
    assert len(rows) == len(set(rows)) and set(rows) == _paired_by_hand(good, [r for r in good if at(r) not in gone] + changes)


def test_swapped_answers(spark):
    rows = [(0, 0, "user", "q"), (0, 1, "assistant", "a"), (0, 3, "assistant", "b"), (1, 5, "assistant", "c"), (1, 5, "assistant", "d"), (1, 5, "assistant", "d")]
    rows += [(2, 0, "assistant", "alone"), (None, 0, "assistant", "x"), (4, None, "assistant", "no turn"), (5, 0, "assistant", "y"), (-1, 0, "assistant", None), (-2, 0, "assistant", "z")]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn int, role string, text string, pair_id int")
    want = {(0, 3, "assistant", "d"), (1, 5, "assistant", "b"), (-1, 0, "assistant", "z"), (-2, 0, "assistant", "")}
    got = [tuple(r) for r in swapped_answers(frame).collect()]
    assert set(got) == want and len(got) == len(want)
    assert swapped_answers(frame.limit(0)).count() == 0


def test_long_conversations(spark):
    one = spark.range(1500).select(F.lit(1).alias("pair_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("t"), "id").alias("text"))
    other = one.withColumn("text", F.when(F.col("turn") == 1000, "changed").otherwise(F.col("text")))
    rows = preferences(one, other).collect()
    assert sum(r.part == "prompt" for r in rows) == 1000 and sum(r.part == "chosen" for r in rows) == sum(r.part == "rejected" for r in rows) == 500
    for part in ("chosen", "rejected"):
        at = 0
        for r in sorted((r for r in rows if r.part in ("prompt", part)), key=lambda r: r.turn):
            assert (r.char_start, r.char_end) == (at, at + len(r.rendered))
            at = r.char_end


def test_dictionary_comes_from_the_records(tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "SAMPLE_BYTES", 1 << 30)  # never enough: the records themselves are the dictionary
    archive = Archive(str(tmp_path))
    archive.add(record(1, "u", b"x", hashlib.sha1(b"x").digest(), None))
    archive.close()
    assert [r["payload"] for _, r in read_archive(archive.path)] == [b"x"]

"""Licences of texts by sentences: normalised sentences get identifiers, and ordered rules match their sequences.

All in SQL functions: a text is brought to words and breaks, one pattern finds the known sentences between breaks, and
the rules, longest first, take their sequences out of what is left. Texts without a known sentence stop after the search.

A line break is soft: a known sentence may begin or end at it, and may also run over it, as wrapped texts do.
"""

from __future__ import annotations

import json
import re
from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Known sentences, normalised: identifier by text. Behind a star at the begin, other words of the sentence may stand first.
SENTENCES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit_grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit_notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "as_is_software",
    "licensed under the apache license version 2 0": "apache_name",
    "licensed under the apache license version 2 0 the license": "apache_name",
    "you may not use this file except in compliance with the license": "apache_compliance",
    "you may obtain a copy of the license at": "apache_copy",
    "http www apache org licenses license 2 0": "apache_link",
    "https www apache org licenses license 2 0": "apache_link",
    "this work is licensed under the gnu general public license version 3": "gpl3_name",
    "licensed under the gnu general public license version 3": "gpl3_name",
    "this program is free software": "gpl_free",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl_redistribute",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl2_redistribute",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3_redistribute",
    "either version 2 of the license or at your option any later version": "gpl2_or_later",
    "either version 3 of the license or at your option any later version": "gpl3_or_later",
    "licensed under cc by nc 4 0": "ccbync4_name",
    "licensed under cc by 4 0": "ccby4_name",
    "licensed under cc by sa 4 0": "ccbysa4_name",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "ccbync4_name",
    "this work is licensed under a creative commons attribution 4 0 international license": "ccby4_name",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "ccbysa4_name",
    "this work is licensed under the creative commons attribution noncommercial 4 0 international license": "ccbync4_name",
    "this work is licensed under the creative commons attribution 4 0 international license": "ccby4_name",
    "this work is licensed under the creative commons attribution sharealike 4 0 international license": "ccbysa4_name",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd_grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd_source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd_binary",
    "* nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd_endorse",
    "this software is provided by the copyright holders and contributors as is": "bsd_as_is",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "bsd_as_is",
    "all rights reserved": "reserved",
}

#: Fixed wording of further licences.
SENTENCES |= {
    "this library is free software": "gpl_free",
    "this software is free software": "gpl_free",
    "you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation": "gpl2_name",
    "you can redistribute it and or modify it under the terms of the gnu general public license version 2 only as published by the free software foundation": "gpl2_name",
    "you can redistribute it and or modify it under the terms of the gnu general public license version 3 as published by the free software foundation": "gpl3_name",
    "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0": "mpl2_name",
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0": "mpl2_name",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc_name",
    "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc_name",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "0bsd_name",
    "this is free and unencumbered software released into the public domain": "unlicense_name",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "zlib_name",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0": "epl2_name",
    "this program and the accompanying materials are made available under the terms of the eclipse public license v 2 0 which is available at https www eclipse org legal epl 2 0": "epl2_name",
}

#: Licences by name: identifier, licence, its key in tags, and its names in notices.
NAMED = [
    ("mit_name", "MIT", "mit", ("mit license",)),
    ("apache_name", "Apache-2.0", "apache 2 0", ("apache license version 2 0", "apache license 2 0")),
    ("gpl2_name", "GPL-2.0-only", "gpl 2 0 only", ("gnu general public license version 2",)),
    ("gpl2_later", "GPL-2.0-or-later", "gpl 2 0 or later", ("gnu general public license version 2 or later",)),
    ("gpl3_name", "GPL-3.0-only", "gpl 3 0 only", ("gnu general public license version 3",)),
    ("gpl3_later", "GPL-3.0-or-later", "gpl 3 0 or later", ("gnu general public license version 3 or later",)),
    ("lgpl21_name", "LGPL-2.1-only", "lgpl 2 1 only", ("gnu lesser general public license version 2 1",)),
    ("lgpl21_later", "LGPL-2.1-or-later", "lgpl 2 1 or later", ("gnu lesser general public license version 2 1 or later",)),
    ("lgpl3_name", "LGPL-3.0-only", "lgpl 3 0 only", ("gnu lesser general public license version 3",)),
    ("lgpl3_later", "LGPL-3.0-or-later", "lgpl 3 0 or later", ("gnu lesser general public license version 3 or later",)),
    ("agpl3_name", "AGPL-3.0-only", "agpl 3 0 only", ("gnu affero general public license version 3",)),
    ("agpl3_later", "AGPL-3.0-or-later", "agpl 3 0 or later", ("gnu affero general public license version 3 or later",)),
    ("mpl2_name", "MPL-2.0", "mpl 2 0", ("mozilla public license version 2 0", "mozilla public license 2 0")),
    ("isc_name", "ISC", "isc", ("isc license",)),
    ("0bsd_name", "0BSD", "0bsd", ()),
    ("bsd2_name", "BSD-2-Clause", "bsd 2 clause", ("bsd 2 clause license",)),
    ("bsd3_name", "BSD-3-Clause", "bsd 3 clause", ("bsd 3 clause license",)),
    ("zlib_name", "Zlib", "zlib", ("zlib license",)),
    ("bsl_name", "BSL-1.0", "bsl 1 0", ("boost software license version 1 0",)),
    ("epl2_name", "EPL-2.0", "epl 2 0", ("eclipse public license 2 0", "eclipse public license version 2 0")),
    ("unlicense_name", "Unlicense", "unlicense", ("unlicense",)),
    ("cc0_name", "CC0-1.0", "cc0 1 0", ()),
    ("ccbync4_name", "CC-BY-NC-4.0", "cc by nc 4 0", ()),
    ("ccbysa4_name", "CC-BY-SA-4.0", "cc by sa 4 0", ()),
    ("ccby4_name", "CC-BY-4.0", "cc by 4 0", ()),
]
_THINGS = ("project", "software", "program", "library", "package", "code", "file", "work")
_VERBS = ("licensed", "released", "distributed")
_OPENINGS = [f"{v} under" for v in _VERBS] + [f"this {t} is {v} under" for t in _THINGS for v in _VERBS]
for _id, _, _tag, _names in NAMED:
    SENTENCES[f"spdx license identifier {_tag}"] = _id
    SENTENCES |= {f"{o} {the} {n}": _id for o in _OPENINGS for the in ("the", "the terms of the") for n in _names}

#: Licences of one family: identifiers' begin, name in the grant, and versions with the licence they give.
_FAMILIES = [
    ("lgpl", "gnu lesser general public license", {"2 1": "LGPL-2.1-or-later", "3": "LGPL-3.0-or-later"}),
    ("agpl", "gnu affero general public license", {"3": "AGPL-3.0-or-later"}),
]
_GRANT = "you can redistribute it and or modify it under the terms of the {} as published by the free software foundation"
_LATER = "either version {} of the license or at your option any later version"
SENTENCES[_LATER.format("2 1")] = "gpl21_or_later"
for _id, _name, _versions in _FAMILIES:
    SENTENCES[_GRANT.format(_name)] = f"{_id}_redistribute"
    SENTENCES |= {f"{_GRANT.format(_name)} {_LATER.format(v)}": f"{_id}{v.replace(' ', '')}_redistribute" for v in _versions}

#: Rules in the order in which they are tried: licence and the identifiers that must follow each other.
RULES: list[tuple[str, tuple[str, ...]]] = [
    ("MIT", ("mit_grant", "mit_notice", "as_is_software")),
    ("Apache-2.0", ("apache_name", "apache_compliance", "apache_copy", "apache_link")),
    ("GPL-3.0-or-later", ("gpl_free", "gpl_redistribute", "gpl3_or_later")),
    ("GPL-2.0-or-later", ("gpl_free", "gpl_redistribute", "gpl2_or_later")),
    ("GPL-3.0-or-later", ("gpl_free", "gpl3_redistribute")),
    ("GPL-2.0-or-later", ("gpl_free", "gpl2_redistribute")),
    ("GPL-3.0-or-later", ("gpl_redistribute", "gpl3_or_later")),
    ("GPL-2.0-or-later", ("gpl_redistribute", "gpl2_or_later")),
    ("GPL-3.0-or-later", ("gpl3_redistribute",)),
    ("GPL-2.0-or-later", ("gpl2_redistribute",)),
    *[
        (licence, (*free, *ids))
        for family, _, versions in _FAMILIES
        for v, licence in versions.items()
        for n in [v.replace(" ", "")]
        for free in (("gpl_free",), ())
        for ids in ((f"{family}_redistribute", f"gpl{n}_or_later"), (f"{family}{n}_redistribute",))
    ],
    ("GPL-2.0-only", ("gpl_free", "gpl2_name")),
    ("GPL-3.0-only", ("gpl_free", "gpl3_name")),
    ("BSD-3-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_endorse", "bsd_as_is")),
    ("BSD-2-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_as_is")),
    ("Apache-2.0", ("apache_name", "apache_compliance")),
    ("MIT", ("mit_grant", "mit_notice")),
    *[(licence, (name,)) for name, licence, _, _ in NAMED],
    ("Proprietary", ("reserved",)),
]
# reserved rights right before a licence are of its copyright line
RULES[:-1] = [(name, x) for name, ids in RULES[:-1] for x in (("reserved", *ids), ids)]

#: Ends of unwrapped sentences, for the check SQL: a line, or a mark before a blank.
ENDS = r"[.;:!?][ \t\r\n]+|[\r\n]+"
#: What does not count in a sentence, for the check SQL.
MARKS = r"[^a-z0-9]+"
#: What lines begin with in comments and lists.
LEADERS = r"(^|\n)[^a-z0-9\n]*(?:(?:dnl|rem)\b[^a-z0-9\n]*)?(?:[0-9a-z]{1,2}\)[ \t]+)?"
#: A tag and its licence are one sentence, though a colon stands between them.
TAG, ONE_TAG = "spdx-license-identifier: ", "spdx license identifier "
#: Ends that no sentence runs over become this, which is not in lower case; others stay line breaks.
HARD = "A"


def _words(text: Column) -> Column:
    """Words with one blank, line break or hard end between them."""
    lines = F.regexp_replace(F.regexp_replace(F.replace(F.lower(text), F.lit(TAG), F.lit(ONE_TAG)), r"\r\n?", "\n"), LEADERS, "$1")
    ends = F.regexp_replace(lines, r"[.;:!?][ \t\n]|\n\n", HARD)
    blanks = F.trim(F.regexp_replace(ends, rf"[^a-z0-9{HARD}\n]+", " "))
    return F.regexp_replace(F.regexp_replace(blanks, rf"[ \n]*{HARD}[ \n{HARD}]*", HARD), r" ?\n[ \n]*", "\n")


def _either(sentences: Collection[str]) -> str:
    """One of the sentences, the longest that fits: a tree of their words, so that common beginnings are read once."""
    tree: dict = {}
    for sentence in sentences:
        node = tree
        for word in sentence.split(" "):
            node = node.setdefault(word, {})
        node[""] = {}

    def then(node: dict) -> str:
        words = sorted(w for w in node if w)
        if not words:
            return ""
        after = [re.escape(w) + then(node[w]) for w in words]
        rest = r"[ \n]" + (after[0] if len(after) == 1 else f"(?:{'|'.join(after)})")
        return f"(?:{rest})?" if "" in node else rest

    return "|".join(re.escape(w) + then(tree[w]) for w in sorted(tree)) or "(?!)"


def _pattern(sentences: Collection[str]) -> str:
    """A break and a sentence, or a blank inside a sentence and a known end, up to a break."""
    whole = _either([s for s in sentences if not s.startswith("* ")])
    tails = _either([s[2:] for s in sentences if s.startswith("* ")])
    return rf"(?:(?:^|[{HARD}\n])(?:{whole})|(?<=[a-z0-9])[ \n](?:{tails}))(?=[{HARD}\n]|\z)"


def _sequence(ids: Sequence[str]) -> str:
    return "".join(f" {i}," for i in ids)


def licences(
    docs: DataFrame, sentences: Mapping[str, str] = SENTENCES, rules: Sequence[tuple[str, Sequence[str]]] = RULES
) -> DataFrame:
    """doc_id, sentence_ids, licences, unmatched for every row of ``docs``.

    ``sentence_ids`` are the identifiers of the known sentences in the text's order, ``licences`` those of the rules
    that matched, in rule order and each once, ``unmatched`` the identifiers that no rule took; all joined by commas and
    empty if there are none. Other sentences do not interrupt a sequence. A rule takes all its occurrences, so later
    (shorter) rules only see what is left. Sentences may be
    wrapped, and stand in comments; blank lines and marks before a blank end them. NULL texts are empty; rows are independent, so repeated rows give repeated
    results; an empty table gives no rows; other columns, whatever their names, are not read.
    """
    # one constant, however many sentences there are
    known = F.from_json(F.lit(json.dumps({s.removeprefix("* "): i for s, i in sentences.items()})), "map<string,string>")
    found = F.regexp_extract_all(_words(F.coalesce(docs["text"], F.lit(""))), F.lit(_pattern(sentences)), 0)
    ids = F.transform(found, lambda s: F.try_element_at(known, F.trim(F.translate(s, f"\n{HARD}", "  "))))
    steps = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(_sequence(ids_)).alias("ids")) for name, ids_ in rules])
    start = F.struct(F.col("all").alias("rest"), F.array().cast("array<string>").alias("names"))
    # what a rule took leaves a bar, so that no sequence is put together across it
    took = F.aggregate(
        steps,
        start,
        lambda state, rule: F.struct(
            F.replace(state["rest"], rule["ids"], F.lit("|")).alias("rest"),
            F.when(F.contains(state["rest"], rule["ids"]), F.array_append(state["names"], rule["name"])).otherwise(state["names"]).alias("names"),
        ),
    )
    found = docs.select(docs["doc_id"].cast("long").alias("doc_id"), ids.alias("ids")).select(
        "doc_id", "ids", F.array_join(F.transform("ids", lambda i: F.concat(F.lit(" "), i, F.lit(","))), "").alias("all")
    )
    return found.select("doc_id", "ids", F.when(F.col("all") != "", took).alias("took")).select(
        "doc_id",
        F.array_join("ids", ",").alias("sentence_ids"),
        F.coalesce(F.array_join(F.array_distinct("took.names"), ","), F.lit("")).alias("licences"),
        F.coalesce(F.translate(F.trim(F.translate("took.rest", "|,", "")), " ", ","), F.lit("")).alias("unmatched"),
    )


def check_sql() -> str:
    """The definition in SQL, one step for each rule."""
    known = "map([" + ", ".join(f"'{s}'" for s in SENTENCES) + "], [" + ", ".join(f"'{i}'" for i in SENTENCES.values()) + "])"
    sql = f"""
        SELECT doc_id, ids, array_to_string(list_transform(ids, lambda i: ' ' || i || ','), '') AS r0
        FROM (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(replace(lower(coalesce(text, '')), '{TAG}', '{ONE_TAG}'), '{ENDS}'),
            lambda s: {known}[trim(regexp_replace(s, '{MARKS}', ' ', 'g'))]), lambda i: i IS NOT NULL) AS ids FROM documents)
    """
    seen: dict[str, list[int]] = {}
    names = []
    for n, (name, ids) in enumerate(rules := RULES, 1):
        sql = f"SELECT *, contains(r{n - 1}, '{_sequence(ids)}') AS h{n}, replace(r{n - 1}, '{_sequence(ids)}', '|') AS r{n} FROM ({sql})"
        new = " AND ".join([f"h{n}", *[f"NOT h{m}" for m in seen.get(name, [])]])
        seen.setdefault(name, []).append(n)
        names.append(f"CASE WHEN {new} THEN '{name}' END")
    return f"""
        SELECT doc_id, array_to_string(ids, ',') AS sentence_ids,
            array_to_string(list_filter([{", ".join(names)}], lambda x: x IS NOT NULL), ',') AS licences,
            replace(trim(replace(replace(r{len(rules)}, '|', ''), ',', '')), ' ', ',') AS unmatched
        FROM ({sql})
    """

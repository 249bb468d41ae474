"""Licence recognition by sentence rules.

Texts are cut into sentences in two ways (line breaks end a sentence; line breaks are blanks and
only punctuation or an empty line ends one, for wrapped licence texts). Normalised sentences map to the identifiers of
known licence sentences, which are cut as the texts are; the identifiers of a text, in text order and without the
unknown sentences between, are matched against ordered rules, each the identifier sequence of a licence notice, text
or tag. At a place where a longer rule matches, the shorter ones inside it do not. A licence found
under either cutting is reported. The catalogue of sentences and rules is a parameter.

Everything runs inside the scan: no shuffle, and no row leaves its task. Sentences are only cut in
texts that hold one of the catalogue's anchors; every known sentence holds one (checked when it is made).

Nulls: null text has no sentences. Repeated rows get equal results; an empty table gives none.
"""
from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, table

# fixed values: wording of public licence notices
SENTENCES: dict[int, str] = {
    1: "Licensed under the Apache License, Version 2.0.",
    2: "Licensed under the Apache License, Version 2.0 (the \"License\");",
    3: "you may not use this file except in compliance with the License.",
    4: "You may obtain a copy of the License at",
    5: "Unless required by applicable law or agreed to in writing, software distributed under the License is "
       "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    6: "See the License for the specific language governing permissions and limitations under the License.",
    10: "Released under the MIT License.",
    11: "Licensed under the MIT License.",
    12: "The MIT License (MIT)",
    13: "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    14: "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software.",
    15: "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED "
        "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    20: "This work is licensed under the GNU General Public License, version 3.",
    21: "This work is licensed under the GNU General Public License, version 2.",
    22: "This program is free software:",
    23: "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
        "Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    24: "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    25: "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    26: "See the GNU General Public License for more details.",
    30: "Licensed under CC BY-NC 4.0.",
    31: "Licensed under CC BY 4.0.",
    32: "Licensed under CC BY-SA 4.0.",
    33: "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    34: "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    35: "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    40: "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:",
    41: "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer.",
    42: "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution.",
    43: "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
    50: "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    60: "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    70: "This is free and unencumbered software released into the public domain.",
    80: "SPDX-License-Identifier: Apache-2.0",
    81: "SPDX-License-Identifier: MIT",
    82: "SPDX-License-Identifier: GPL-3.0-or-later",
    83: "SPDX-License-Identifier: BSD-3-Clause",
    84: "SPDX-License-Identifier: MPL-2.0",
}
# fixed values: licence -> identifier sequences, any of which tells it
RULES: dict[str, list[tuple[int, ...]]] = {
    "Apache-2.0": [(1,), (80,), (2, 3), (3, 4, 5, 6)],
    "BSD-2-Clause": [(40, 41, 42)],
    "BSD-3-Clause": [(40, 41, 42, 43), (83,)],
    "CC-BY-4.0": [(31,), (33,)],
    "CC-BY-NC-4.0": [(30,), (34,)],
    "CC-BY-SA-4.0": [(32,), (35,)],
    "GPL-2.0-only": [(21,)],
    "GPL-3.0-only": [(20,)],
    "GPL-3.0-or-later": [(22, 23), (23, 24, 25), (82,)],
    "ISC": [(60,)],
    "MIT": [(10,), (11,), (81,), (13, 14), (12, 13)],
    "MPL-2.0": [(50,), (84,)],
    "Unlicense": [(70,)],
}
ANCHORS = ("licen", "permission", "redistribut", "warrant", "free software", "unencumbered", "copyright", "mozilla")
END = r"([.!?:;])[\x20\x09-\x0D]+"            # where texts, and known sentences alike, are cut


def normal(sentence: str) -> str:
    return re.sub(r"[^a-z0-9]+", " ", sentence.lower()).strip()


def cut(sentence: str) -> list[str]:
    """The normalised parts of a sentence as a text is cut."""
    return [p for p in map(normal, re.sub(END, "\\1\n", sentence.lower()).split("\n")) if p]


class Catalogue:
    """Known sentences, cut as texts are (a tag like ``SPDX-License-Identifier: MIT`` is two parts), and the rules as
    sequences of the parts' identifiers."""

    def __init__(self, sentences: dict[int, str], rules: dict[str, list[tuple[int, ...]]], anchors=ANCHORS):
        self.anchors = tuple(anchors)
        self.known: dict[str, int] = {}
        self.parts = {i: tuple(self.known.setdefault(p, len(self.known) + 1) for p in cut(s)) for i, s in sentences.items()}
        self.rules = {name: [sum((self.parts[i] for i in run), ()) for run in runs] for name, runs in sorted(rules.items())}
        if not all(self.parts.values()) or len(set(self.parts.values())) != len(sentences):
            raise ValueError("known sentences must be distinct and have a letter or digit")
        if not all(any(a in s.lower() for a in self.anchors) for s in sentences.values()):
            raise ValueError("known sentences must hold an anchor")

    def longer(self, run: tuple[int, ...]) -> list[tuple[int, ...]]:
        """Sequences of rules that hold ``run`` and more, the longest first: at their places it is not told."""
        return sorted({r for runs in self.rules.values() for r in runs if len(r) > len(run) and key(run) in key(r)},
                      key=lambda r: (-len(r), r))


def key(run) -> str:
    """Identifiers as text in which no two of them share a comma."""
    return "".join(f",{i}," for i in run)


DEFAULT = Catalogue(SENTENCES, RULES)


def _ids(sentences: Column, known: dict[str, int]) -> Column:
    """Identifiers of the known sentences, in text order."""
    ids = F.create_map(*[x for p, i in known.items() for x in (F.lit(p), F.lit(i))])
    clean = F.transform(sentences, lambda s: F.trim(F.regexp_replace(s, "[^a-z0-9]+", " ")))
    return F.transform(F.filter(clean, lambda s: s.isin(list(known))), lambda s: ids[s])


def _licenses(seq: Column, book: Catalogue) -> Column:
    """Names of the rules found in a sequence as :func:`key` writes it; the longest rule at a place is the one found."""
    return F.flatten(F.array(*[
        F.when(_any(seq, runs, book), F.array(F.lit(name))).otherwise(F.expr("cast(array() as array<string>)"))
        for name, runs in book.rules.items()]))


def _any(seq: Column, runs, book: Catalogue) -> Column:
    found = F.lit(False)
    for run in runs:
        rest = seq
        for more in book.longer(run):
            rest = F.replace(rest, F.lit(key(more)), F.lit(key([0])))
        found = found | rest.contains(key(run))
    return found


def scan(docs: DataFrame, out: str = "licence", book: Catalogue = DEFAULT) -> DataFrame:
    """``docs`` plus struct ``out``: by_line, by_sentence (known identifiers under each cutting) and
    licenses (sorted names)."""
    low, a, b = (fresh(docs, f"__{c}") for c in ("low", "by_line", "by_sentence"))
    none = F.expr("cast(array() as array<int>)")
    some = F.col(low).rlike("|".join(map(re.escape, book.anchors)))
    lines = F.split(F.regexp_replace(F.col(low), END, "$1\n"), "\n")
    flat = F.translate(F.regexp_replace(F.col(low), r"\n[\x20\t\r]*\n", "\x01"), "\n", " ")
    sentences = F.split(F.regexp_replace(flat, END, "$1\x01"), "\x01")
    df = (docs.withColumn(low, F.lower(F.coalesce(F.col("text"), F.lit(""))))
          .withColumn(a, F.when(some, _ids(lines, book.known)).otherwise(none))
          .withColumn(b, F.when(some, _ids(sentences, book.known)).otherwise(none)))
    seqs = [F.concat(F.lit(","), F.array_join(F.col(c).cast("array<string>"), ",,"), F.lit(",")) for c in (a, b)]
    names = F.array_sort(F.array_union(_licenses(seqs[0], book), _licenses(seqs[1], book)))
    return df.withColumn(out, F.struct(F.col(a).alias("by_line"), F.col(b).alias("by_sentence"),
                                       names.alias("licenses"))).drop(low, a, b)


def query(spark, sf_dir):
    s, r = scan(table(spark, sf_dir, "documents").select("doc_id", "text")), F.col("licence")
    join = lambda c: F.array_join(r[c].cast("array<string>"), ",")
    return s.select("doc_id", join("by_line").alias("line_ids"), join("by_sentence").alias("sentence_ids"),
                    join("licenses").alias("licenses"), F.size(r["licenses"]).cast("long").alias("n_licenses"))


def oracle(book: Catalogue = DEFAULT) -> str:
    known = ", ".join(f"('{p}', {i})" for p, i in book.known.items())

    def told(run):
        rest = "(',' || replace(q, ',', ',,') || ',')"
        for more in book.longer(run):
            rest = f"replace({rest}, '{key(more)}', ',0,')"
        return f"contains({rest}, '{key(run)}')"

    names = ", ".join(f"CASE WHEN bool_or({' OR '.join(map(told, runs))}) THEN '{name}' END" for name, runs in book.rules.items())
    return rf"""
WITH known(s, id) AS (VALUES {known}),
t AS (SELECT doc_id, lower(coalesce(text, '')) AS x FROM documents),
cut AS (SELECT doc_id, 'l' AS how, string_split(regexp_replace(x, '([.!?:;])[\x20\x09-\x0D]+', '\1' || chr(10), 'g'), chr(10)) AS ss FROM t
        WHERE regexp_matches(x, '{"|".join(book.anchors)}')
        UNION ALL
        SELECT doc_id, 's', string_split(regexp_replace(replace(regexp_replace(x, '\n[\x20\t\r]*\n', chr(1), 'g'), chr(10), ' '),
               '([.!?:;])[\x20\x09-\x0D]+', '\1' || chr(1), 'g'), chr(1)) FROM t WHERE regexp_matches(x, '{"|".join(book.anchors)}')),
one AS (SELECT doc_id, how, unnest(range(1, len(ss) + 1)) AS i, trim(regexp_replace(unnest(ss), '[^a-z0-9]+', ' ', 'g')) AS s FROM cut),
seq AS (SELECT doc_id, how, string_agg(id, ',' ORDER BY i) AS q FROM one JOIN known USING (s) GROUP BY ALL),
lic AS (SELECT doc_id, list_filter([{names}], lambda x: x IS NOT NULL) AS l FROM seq GROUP BY doc_id)
SELECT d.doc_id, coalesce(a.q, '') AS line_ids, coalesce(b.q, '') AS sentence_ids, coalesce(array_to_string(l, ','), '') AS licenses,
       coalesce(len(l), 0)::BIGINT AS n_licenses
FROM documents d LEFT JOIN (SELECT * FROM seq WHERE how = 'l') a ON a.doc_id = d.doc_id
LEFT JOIN (SELECT * FROM seq WHERE how = 's') b ON b.doc_id = d.doc_id LEFT JOIN lic ON lic.doc_id = d.doc_id
"""

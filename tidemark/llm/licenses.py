"""License scans: known sentences become identifiers, and their sequence is matched with ordered rules.

A text is cut into sentences twice: with line breaks as ends, and with single line breaks as white space, for
texts wrapped at a margin. An SPDX tag and its value are one sentence; the names in an SPDX expression, up to the end of it, each count.
A holder's name where a known sentence says "the copyright holder" is a slot. Normalised sentences are looked up among the known
ones; the identifiers found, in order, hold a license if one of its rules occurs in them with nothing known in between, and not as the
beginning of another license's longer rule. All in column expressions, so no rows move.

``NOTICES`` and ``NOTICE_RULES`` add to ``SENTENCES`` and ``RULES`` what notices look like once they are cut.

Edge cases: a null, empty or blank text has no sentence and no license. A very long text is scanned whole.
Licenses are listed once each in alphabetical order, whatever their number in the text. A result depends on
the text alone, so ties, repeated rows and other columns change nothing.
"""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sentences of licenses, normalised (lower case, other characters than letters and digits as one space).
SENTENCES = {
    "mit-name": ["released under the mit license", "licensed under the mit license", "the mit license mit", "the mit license", "this project is licensed under the mit license"],
    "mit-grant": [
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software "
        "without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software "
        "and to permit persons to whom the software is furnished to do so subject to the following conditions",
    ],
    "mit-notice": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"],
    "as-is": ["the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"],
    "apache-name": ["licensed under the apache license version 2 0", "licensed under the apache license version 2 0 the license", "released under the apache license version 2 0"],
    "apache-comply": ["you may not use this file except in compliance with the license"],
    "apache-copy": ["you may obtain a copy of the license at http www apache org licenses license 2 0", "you may obtain a copy of the license at"],
    "gpl3-name": ["this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 3", "released under the gnu general public license version 3"],
    "gpl-free": ["this program is free software", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "gpl3-terms": ["you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "gpl2-terms": ["you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"],
    "gpl-hope": ["this program is distributed in the hope that it will be useful but without any warranty"],
    "bsd-grant": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "bsd-source": ["redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"],
    "bsd-binary": ["redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"],
    "bsd-names": ["neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"],
    "cc-by-nc": ["licensed under cc by nc 4 0", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"],
    "cc-by": ["licensed under cc by 4 0", "this work is licensed under a creative commons attribution 4 0 international license"],
    "cc-by-sa": ["licensed under cc by sa 4 0", "this work is licensed under a creative commons attribution sharealike 4 0 international license"],
    "cc0": ["licensed under cc0 1 0", "to the extent possible under law the author has waived all copyright and related rights to this work"],
    "mpl-name": ["this source code form is subject to the terms of the mozilla public license v 2 0", "this source code form is subject to the terms of the mozilla public license"],
    "spdx-mit": ["spdx license identifier mit"],
    "spdx-apache": ["spdx license identifier apache 2 0"],
    "spdx-gpl3": ["spdx license identifier gpl 3 0 or later", "spdx license identifier gpl 3 0 only"],
    "spdx-bsd3": ["spdx license identifier bsd 3 clause"],
    "reserved": ["all rights reserved"],
}
# Identifier sequences of each license, and what it allows.
RULES = [
    ("MIT", ["mit-name"]),
    ("MIT", ["mit-grant", "mit-notice", "as-is"]),
    ("MIT", ["spdx-mit"]),
    ("Apache-2.0", ["apache-name"]),
    ("Apache-2.0", ["apache-comply", "apache-copy"]),
    ("Apache-2.0", ["spdx-apache"]),
    ("GPL-3.0", ["gpl3-name"]),
    ("GPL-3.0", ["gpl-free", "gpl3-terms"]),
    ("GPL-3.0", ["gpl-free", "gpl-hope"]),
    ("GPL-3.0", ["spdx-gpl3"]),
    ("GPL-2.0", ["gpl-free", "gpl2-terms"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("BSD-3-Clause", ["spdx-bsd3"]),
    ("CC-BY-NC-4.0", ["cc-by-nc"]),
    ("CC-BY-4.0", ["cc-by"]),
    ("CC-BY-SA-4.0", ["cc-by-sa"]),
    ("CC0-1.0", ["cc0"]),
    ("MPL-2.0", ["mpl-name"]),
    ("All-Rights-Reserved", ["reserved"]),
]
# Further sentences as the cut yields them, SPDX values, and an identifier of its own for the GPL 3 notice in one sentence.
_GPL_TERMS = "you can redistribute it and or modify it under the terms of the gnu general public license"
NOTICES = {
    "gpl3-whole": [f"this program is free software {_GPL_TERMS} as published by the free software foundation either version 3 of the license or at your option any later version"],
    "gpl-terms": [f"{_GPL_TERMS} as published by the free software foundation"],
    "gpl2-version": ["either version 2 of the license or at your option any later version", "version 2 of the license"],
    "gpl3-version": ["either version 3 of the license or at your option any later version", "version 3 of the license"],
    "gpl2-terms": [f"{_GPL_TERMS} version 2 as published by the free software foundation", f"{_GPL_TERMS} as published by the free software foundation version 2 of the license"],
    "gpl3-terms": [f"{_GPL_TERMS} version 3 as published by the free software foundation", f"{_GPL_TERMS} as published by the free software foundation version 3 of the license"],
    "mpl-name": ["this source code form is subject to the terms of the mozilla public license v"],
    "cc0": ["to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"],
    "spdx-gpl3": ["spdx license identifier gpl 3 0"],
    "spdx-gpl2": ["spdx license identifier gpl 2 0", "spdx license identifier gpl 2 0 or later", "spdx license identifier gpl 2 0 only"],
    "spdx-bsd2": ["spdx license identifier bsd 2 clause"],
    "spdx-mpl": ["spdx license identifier mpl 2 0"],
    "spdx-cc0": ["spdx license identifier cc0 1 0"],
    "spdx-cc-by": ["spdx license identifier cc by 4 0"],
    "spdx-cc-by-sa": ["spdx license identifier cc by sa 4 0"],
    "spdx-cc-by-nc": ["spdx license identifier cc by nc 4 0"],
    "library-free": ["this library is free software"],
    "lgpl-terms": ["you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"],
    "lgpl21-version": ["either version 2 1 of the license or at your option any later version"],
    "lgpl3-terms": ["you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "lgpl21-terms": ["you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version"],
    "agpl-terms": ["you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "isc-grant": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
    "apache-head": ["apache license"],
    "apache-date": ["version 2 0 january 2004"],
    "apache-title": ["apache license version 2 0 january 2004"],
    "gpl-head": ["gnu general public license"],
    "lgpl-head": ["gnu lesser general public license"],
    "agpl-head": ["gnu affero general public license"],
    "gpl2-date": ["version 2 june 1991"],
    "gpl3-date": ["version 3 29 june 2007"],
    "lgpl21-date": ["version 2 1 february 1999"],
    "agpl-date": ["version 3 19 november 2007"],
    "mpl-title": ["mozilla public license version 2 0"],
}
NOTICE_RULES = [
    ("GPL-3.0", ["gpl3-whole"]),
    ("GPL-3.0", ["gpl-free", "gpl-terms", "gpl3-version"]),
    ("GPL-3.0", ["spdx-gpl3"]),
    ("GPL-2.0", ["gpl-free", "gpl-terms", "gpl2-version"]),
    ("GPL-2.0", ["spdx-gpl2"]),
    ("BSD-2-Clause", ["spdx-bsd2"]),
    ("MPL-2.0", ["spdx-mpl"]),
    ("CC0-1.0", ["spdx-cc0"]),
    ("CC-BY-4.0", ["spdx-cc-by"]),
    ("CC-BY-SA-4.0", ["spdx-cc-by-sa"]),
    ("CC-BY-NC-4.0", ["spdx-cc-by-nc"]),
    ("LGPL-2.1", ["library-free", "lgpl-terms", "lgpl21-version"]),
    ("LGPL-2.1", ["library-free", "lgpl21-terms"]),
    ("LGPL-3.0", ["library-free", "lgpl-terms", "gpl3-version"]),
    ("LGPL-3.0", ["library-free", "lgpl3-terms"]),
    ("LGPL-3.0", ["gpl-free", "lgpl3-terms"]),
    ("AGPL-3.0", ["gpl-free", "agpl-terms"]),
    ("ISC", ["isc-grant"]),
    ("Unlicense", ["unlicense"]),
    ("Apache-2.0", ["apache-head", "apache-date"]),
    ("Apache-2.0", ["apache-title"]),
    ("GPL-2.0", ["gpl-head", "gpl2-date"]),
    ("GPL-3.0", ["gpl-head", "gpl3-date"]),
    ("LGPL-2.1", ["lgpl-head", "lgpl21-date"]),
    ("LGPL-3.0", ["lgpl-head", "gpl3-date"]),
    ("AGPL-3.0", ["agpl-head", "agpl-date"]),
    ("MPL-2.0", ["mpl-title"]),
]
# Names in SPDX expressions, in lower case, by license.
SPDX = {
    "MIT": ["mit"],
    "Apache-2.0": ["apache-2.0"],
    "GPL-2.0": ["gpl-2.0", "gpl-2.0+", "gpl-2.0-only", "gpl-2.0-or-later"],
    "GPL-3.0": ["gpl-3.0", "gpl-3.0+", "gpl-3.0-only", "gpl-3.0-or-later"],
    "LGPL-2.1": ["lgpl-2.1", "lgpl-2.1+", "lgpl-2.1-only", "lgpl-2.1-or-later"],
    "LGPL-3.0": ["lgpl-3.0", "lgpl-3.0+", "lgpl-3.0-only", "lgpl-3.0-or-later"],
    "AGPL-3.0": ["agpl-3.0", "agpl-3.0-only", "agpl-3.0-or-later"],
    "BSD-2-Clause": ["bsd-2-clause"],
    "BSD-3-Clause": ["bsd-3-clause"],
    "ISC": ["isc"],
    "Unlicense": ["unlicense"],
    "MPL-2.0": ["mpl-2.0"],
    "CC0-1.0": ["cc0-1.0"],
    "CC-BY-4.0": ["cc-by-4.0"],
    "CC-BY-SA-4.0": ["cc-by-sa-4.0"],
    "CC-BY-NC-4.0": ["cc-by-nc-4.0"],
}
#: An SPDX expression after its tag: names joined by AND, OR and WITH; a comment's end or other words end it.
_NAME = r"[(]*[A-Za-z0-9][A-Za-z0-9.+-]*[)]*"
EXPRESSION = rf"(?i)SPDX-License-Identifier:[ \t]*({_NAME}(?:[ \t]+(?:AND|OR|WITH)[ \t]+{_NAME})*)"
#: A holder's name in the clause of names.
HOLDER = r"(?i)(either the names? of )[^\n]{1,120}?([ \t\r\n]+nor[ \t\r\n])"
#: Says nothing of the version: any GPL notice has both sentences.
UNSURE = ("GPL-3.0", ["gpl-free", "gpl-hope"])
ALL_SENTENCES = {name: [*SENTENCES.get(name, []), *NOTICES.get(name, [])] for name in [*SENTENCES, *(n for n in NOTICES if n not in SENTENCES)]}
# of a sentence with two names, that in NOTICES
ALL_SENTENCES |= {name: [s for s in texts if name == "gpl3-whole" or s not in NOTICES["gpl3-whole"]] for name, texts in ALL_SENTENCES.items()}
ALL_RULES = [*(r for r in RULES if r != UNSURE), *(r for r in NOTICE_RULES if r not in RULES)]
RESTRICTED = ["All-Rights-Reserved", "CC-BY-NC-4.0"]
COPYLEFT = ["AGPL-3.0", "CC-BY-SA-4.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0"]
#: Every known sentence has one of these words, so a text without them is not cut up.
ANCHORS = ["licen", "permission", "copyright", "warrant", "redistribut", "rights", "software"]


def sentences(text: Column) -> Column:
    """The normalised sentences of a text, in order."""
    slotted = F.regexp_replace(text, HOLDER, "$1the copyright holder$2")
    ended = F.regexp_replace(slotted, r"([.!?;]|(?<!(?i:SPDX-License-Identifier)):)[ \t\r\n]+", "$1\n")
    lines = F.split(ended, "\n")
    return F.transform(lines, lambda s: F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " ")))


def identifiers(text: Column, known: dict[str, str]) -> Column:
    """The identifiers of the known sentences of a text, in order."""
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    return F.filter(F.transform(sentences(text), lambda s: table[s]), lambda x: x.isNotNull())


def spdx_names(text: Column) -> Column:
    """The licenses that the SPDX expressions of a text name; null entries for unknown names."""
    table = F.create_map(*[F.lit(x) for name, listed in SPDX.items() for own in listed for x in (own, name)])
    names = F.flatten(F.transform(F.regexp_extract_all(text, F.lit(EXPRESSION), 1), lambda e: F.regexp_extract_all(F.lower(e), F.lit("[a-z0-9][a-z0-9.+-]*"), 0)))
    return F.transform(names, lambda name: table[name])


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def held(ids: Column, rules: Sequence[tuple[str, Sequence[str]]]) -> Column:
    """The licenses with a rule that occurs in the identifiers as an unbroken sequence; null entries for the others.
    What begins another license's longer rule and is followed by its rest counts for that license only."""
    written = lambda rule: "".join(f",{x}," for x in rule)
    line = F.concat(F.lit(","), F.array_join(ids, ",,"), F.lit(","))

    def has(x: Column, name: str, rule: Sequence[str]) -> Column:
        for other, longer in rules:
            if other != name and len(longer) > len(rule) and list(longer[: len(rule)]) == list(rule):
                x = F.replace(x, F.lit(written(longer)), F.lit(",,"))
        return F.contains(x, F.lit(written(rule)))

    return _let(line, lambda x: F.array(*[F.when(has(x, name, rule), F.lit(name)) for name, rule in rules]))


def scan(text: Column, sentence_table: dict[str, Sequence[str]] = ALL_SENTENCES, rules: Sequence[tuple[str, Sequence[str]]] = ALL_RULES, anchors: Sequence[str] = ANCHORS) -> Column:
    """struct(sentences, licenses): identifiers found, by lines, and licenses in alphabetical order."""
    known = {s: name for name, texts in sentence_table.items() for s in texts}
    joined = F.regexp_replace(text, r"([^\n])\n(?=[^\n])", "$1 ")
    both = F.struct(identifiers(text, known).alias("lines"), identifiers(joined, known).alias("joined"))

    def result(ids: Column) -> Column:
        found = F.concat(held(ids["lines"], rules), held(ids["joined"], rules), spdx_names(text))
        return F.struct(ids["lines"].alias("sentences"), F.array_sort(F.array_compact(F.array_distinct(found))).alias("licenses"))

    nothing = F.array().cast("array<string>")
    return F.when(_has_any(text, anchors), _let(both, result)).otherwise(F.struct(nothing.alias("sentences"), nothing.alias("licenses")))


def _has_any(text: Column, anchors: Sequence[str]) -> Column:
    def one(lower: Column) -> Column:
        out = F.lit(False)
        for word in anchors:
            out |= F.contains(lower, F.lit(word))
        return out

    return F.coalesce(_let(F.lower(text), one), F.lit(False))


def terms(licenses: Column) -> Column:
    """The strictest of what the licenses allow: restricted, copyleft, permissive, or none."""
    one_of = lambda names: F.arrays_overlap(licenses, F.array(*[F.lit(n) for n in names]))
    return F.when(one_of(RESTRICTED), "restricted").when(one_of(COPYLEFT), "copyleft").when(F.size(licenses) > 0, "permissive").otherwise("none")


def _string(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def oracle() -> str:
    """The scan of ``documents`` as one DuckDB statement, by the same sentences and rules."""
    known = ", ".join(f"({_string(s)}, {_string(name)})" for name, texts in ALL_SENTENCES.items() for s in texts)
    written = lambda rule: _string("".join(f",{x}," for x in rule))

    def has(name: str, rule: Sequence[str]) -> str:
        line = "line"
        for other, longer in ALL_RULES:
            if other != name and len(longer) > len(rule) and list(longer[: len(rule)]) == list(rule):
                line = f"replace({line}, {written(longer)}, ',,')"
        return f"CASE WHEN contains({line}, {written(rule)}) THEN {_string(name)} END"

    spdx = ", ".join(f"({_string(own)}, {_string(name)})" for name, listed in SPDX.items() for own in listed)
    rules = ",\n    ".join(has(name, rule) for name, rule in ALL_RULES)
    slotted = f"regexp_replace(text, {_string(HOLDER.removeprefix('(?i)'))}, '\\1the copyright holder\\2', 'gi')"
    tagged = f"regexp_replace({slotted}, '(SPDX-License-Identifier):', '\\1' || chr(1), 'gi')"
    cut = f"string_split(regexp_replace({tagged}, '([.!?;:])[ \\t\\r\\n]+', '\\1' || chr(10), 'g'), chr(10))"
    return f"""
WITH known(sentence, id) AS (VALUES {known}),
numbered AS (SELECT doc_id, text, row_number() OVER () AS rowid FROM documents),
versions AS (
  SELECT doc_id, rowid AS r, 0 AS way, text FROM numbered
  UNION ALL SELECT doc_id, rowid, 1, regexp_replace(text, '([^\\n])\\n([^\\n])', '\\1 \\2', 'g') FROM numbered
),
cut AS (SELECT r, way, unnest({cut}) AS s, generate_subscripts({cut}, 1) AS i FROM versions),
ids AS (
  SELECT r, way, i, id FROM cut JOIN known ON known.sentence = trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'))
),
lines AS (SELECT r, way, ',' || string_agg(id, ',,' ORDER BY i) || ',' AS line, count(*) AS n FROM ids GROUP BY r, way),
spdx_known(name, license) AS (VALUES {spdx}),
expressions AS (SELECT rowid AS r, unnest(regexp_extract_all(text, {_string(EXPRESSION)}, 1)) AS e FROM numbered),
names AS (SELECT r, unnest(regexp_extract_all(lower(e), '[a-z0-9][a-z0-9.+-]*')) AS name FROM expressions),
licensed AS (
  SELECT r, unnest([
    {rules}]) AS license FROM lines
  UNION ALL SELECT r, license FROM names JOIN spdx_known USING (name)
),
found AS (SELECT r, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses FROM licensed WHERE license IS NOT NULL GROUP BY r)
SELECT d.doc_id, coalesce(l.n, 0)::BIGINT AS n_sentences, coalesce(licenses, '') AS licenses,
  CASE WHEN {" OR ".join(f"contains(',' || licenses || ',', ',{n},')" for n in RESTRICTED)} THEN 'restricted'
       WHEN {" OR ".join(f"contains(',' || licenses || ',', ',{n},')" for n in COPYLEFT)} THEN 'copyleft'
       WHEN licenses IS NOT NULL THEN 'permissive' ELSE 'none' END AS terms
FROM numbered d LEFT JOIN lines l ON l.r = d.rowid AND l.way = 0 LEFT JOIN found f ON f.r = d.rowid
"""

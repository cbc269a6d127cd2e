"""License scan by sentence rules, in DataFrame functions only.

A text is cut into sentences at line ends and after ``.``, ``!`` or ``?`` that
white space or the end follows; a sentence is normalised to ASCII lower case
with every other run of characters than ``a-z0-9`` as one space. Normalised
sentences that are known map to sentence identifiers. A known sentence may be wrapped:
it runs from the start of a line or sentence to the end of one, over any line ends
and comment leaders between (punctuation, ``rem`` or ``dnl``), and may be cut at a
full stop of its own (``v. 2.0``). Neighbours of a rule may also stand in one
sentence. ``n_sentences`` counts the pieces of the cut.

A notice is a part of a sentence that names a license: words of licensing and a name
("is released under the terms of the MIT License", "licensed under either MIT or
Apache 2.0"), an SPDX tag, or a name that stands alone as a title. Each name has the
identifier of its license. Names are built from families, versions and spellings. A
notice is taken as it stands: what a sentence says around it isn't read.

A rule is a sequence of identifiers; it matches where they stand next to each other
among the text's known sentences and notices. Rules are ordered: the first that matches is the text's
``license``, all that match are its ``licenses``.

One projection without shuffle: nothing depends on how often a text, sentence
or license occurs. Null and empty texts have no sentences and no license, an empty
table gives no rows, equal rows are scanned each on its own, null ids are kept, and other columns than doc_id
and text are not read, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Known license sentences, normalised, by identifier.
SENTENCES = {
    1: "licensed under the apache license version 2 0",
    2: "licensed under the apache license version 2 0 the license",
    3: "you may not use this file except in compliance with the license",
    4: "you may obtain a copy of the license at",
    5: "see the license for the specific language governing permissions and limitations under the license",
    10: "released under the mit license",
    11: "licensed under the mit license",
    12: "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    13: "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    20: "this work is licensed under the gnu general public license version 3",
    21: "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    22: "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    23: "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    24: "see the gnu general public license for more details",
    30: "licensed under cc by nc 4 0",
    31: "licensed under cc by 4 0",
    32: "licensed under cc by sa 4 0",
    33: "this work is licensed under a creative commons attribution 4 0 international license",
    34: "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    35: "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    40: "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    41: "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    42: "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    50: "this source code form is subject to the terms of the mozilla public license v 2 0",
    51: "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    60: "this is free and unencumbered software released into the public domain",
    70: "all rights reserved",
    14: "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    25: "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    26: "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    27: "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    28: "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation version 2",
    43: "all advertising materials mentioning features or use of this software must display the following acknowledgement",
    44: "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    52: "the contents of this file are subject to the mozilla public license version 1 1 the license",
    80: "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    81: "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    82: "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    83: "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following",
    84: "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed",
    85: "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
}

# Licenses without families of versions, by their names.
NAMES = {
    "MIT": ("mit", "expat"),
    "MIT-0": ("mit 0", "mit no attribution"),
    "BSD-2-Clause": ("bsd 2 clause", "2 clause bsd", "simplified bsd", "freebsd"),
    "BSD-3-Clause": ("bsd 3 clause", "3 clause bsd", "new bsd", "modified bsd", "revised bsd"),
    "BSD-4-Clause": ("bsd 4 clause", "4 clause bsd"),
    "0BSD": ("0bsd", "zero clause bsd", "bsd zero clause"),
    "ISC": ("isc",),
    "Zlib": ("zlib",),
    "Unlicense": ("unlicense",),
    "WTFPL": ("wtfpl", "do what the fuck you want to public"),
    "PostgreSQL": ("postgresql",),
    "NCSA": ("ncsa", "university of illinois ncsa open source"),
    "CC0-1.0": ("cc0", "cc0 1 0", "cc0 1 0 universal", "creative commons zero v1 0 universal"),
}
# Families with versions: stems of their names, versions, whether "or later" is a license of its own.
FAMILIES = {
    "GPL": (("gnu general public license", "gnu gpl", "gpl"), ("2.0", "3.0"), True),
    "LGPL": (("gnu lesser general public license", "gnu library general public license", "gnu lgpl", "lgpl"), ("2.0", "2.1", "3.0"), True),
    "AGPL": (("gnu affero general public license", "affero general public license", "gnu agpl", "agpl"), ("3.0",), True),
    "Apache": (("apache license", "apache software license", "apache"), ("1.1", "2.0"), False),
    "MPL": (("mozilla public license", "mpl"), ("1.1", "2.0"), False),
    "EPL": (("eclipse public license", "epl"), ("1.0", "2.0"), False),
    "BSL": (("boost software license", "bsl"), ("1.0",), False),
    "EUPL": (("european union public licence", "european union public license", "eupl"), ("1.1", "1.2"), False),
    "Artistic": (("artistic license", "artistic"), ("1.0", "2.0"), False),
    "CDDL": (("common development and distribution license", "cddl"), ("1.0", "1.1"), False),
}
# Parts of Creative Commons licenses, short and long.
COMMONS = {"BY": "attribution", "NC": "noncommercial", "SA": "sharealike", "ND": "noderivatives"}
# Words before a license's name.
LEADS = (
    "(?:licen[sc]ed|released|distributed|redistributed|available|published|provided|offered|covered) under (?:either )?(?:of )?(?:the |a |an )?"
    "(?:terms of (?:either )?(?:the )?)?(?:open source )?|subject to the terms of (?:the )?|governed by (?:the )?|spdx license identifier "
)

# Rules in order: license and its sentences. Longer texts come before notices that they contain.
RULES = (
    ("GPL-3.0-or-later", (21, 23, 24)),
    ("GPL-2.0-or-later", (22, 23, 24)),
    ("BSD-3-Clause", (40, 41, 42)),
    ("BSD-2-Clause", (40, 41)),
    ("MPL-2.0", (50, 51)),
    ("MIT", (12, 13)),
    ("Apache-2.0", (2, 3)),
    ("LGPL-2.1-or-later", (25,)),
    ("LGPL-3.0-or-later", (26,)),
    ("AGPL-3.0-or-later", (27,)),
    ("BSD-4-Clause", (40, 41, 43)),
    ("ISC", (80,)),
    ("0BSD", (81,)),
    ("Zlib", (82,)),
    ("BSL-1.0", (83,)),
    ("WTFPL", (84,)),
    ("CC0-1.0", (85,)),
    ("MPL-1.1", (52,)),
    ("MIT", (14,)),
    ("GPL-2.0-only", (28,)),
    ("GPL-3.0-or-later", (21,)),
    ("GPL-2.0-or-later", (22,)),
    ("GPL-3.0-only", (20,)),
    ("Apache-2.0", (1,)),
    ("Apache-2.0", (2,)),
    ("MIT", (10,)),
    ("MIT", (11,)),
    ("MPL-2.0", (50,)),
    ("CC-BY-NC-4.0", (30,)),
    ("CC-BY-NC-4.0", (34,)),
    ("CC-BY-SA-4.0", (32,)),
    ("CC-BY-SA-4.0", (35,)),
    ("CC-BY-4.0", (31,)),
    ("CC-BY-4.0", (33,)),
    ("Unlicense", (60,)),
    ("LicenseRef-all-rights-reserved", (70,)),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEADER = "(?:(?:rem|dnl) )?"


def _spaced(name: str) -> str:
    return " ".join(name.lower().replace("-", " ").replace(".", " ").split())


def notice_names() -> dict[str, str]:
    """License by normalised name: every spelling of the fixed names, families and Creative Commons licenses."""
    out: dict[str, str] = {}
    for license, names in NAMES.items():
        for name in (_spaced(license), *names):
            out |= {name: license, f"{name} license": license, f"{name} licence": license}
    for family, (stems, versions, later) in FAMILIES.items():
        for version in versions:
            number = [_spaced(version)] + [version[0]] * version.endswith(".0")
            for stem in stems:
                for v in number:
                    for name in (f"{stem} version {v}", f"{stem} v {v}", f"{stem} v{v}", f"{stem} {v}", *([f"{stem}v{v}"] if " " not in stem else [])):
                        only = f"{family}-{version}-only" if later else f"{family}-{version}"
                        out |= {name: only, f"{name} license": only}
                        if later:
                            out[f"{name} only"] = only
                            for more in (" or later", " or any later version", " or at your option any later version"):
                                out[name + more] = f"{family}-{version}-or-later"
    for parts in (("BY",), ("BY", "SA"), ("BY", "NC"), ("BY", "ND"), ("BY", "NC", "SA"), ("BY", "NC", "ND")):
        for version in ("3.0", "4.0"):
            license = f"CC-{'-'.join(parts)}-{version}"
            short, long = _spaced(license), f"creative commons {' '.join(COMMONS[p] for p in parts)} {_spaced(version)}"
            out |= {name: license for name in (short, f"{short} license", long, f"{long} license", f"{long} international license", f"{long} international public license")}
    return out


def rules_with_notices(rules=RULES) -> tuple[tuple[str, tuple[int, ...]], ...]:
    """The rules, and one for the identifier of each license that notices name; claims of all rights come last."""
    numbers = notice_ids()
    last = tuple(r for r in rules if r[0].startswith("LicenseRef"))
    return (*(r for r in rules if r not in last), *((name, (number,)) for name, number in numbers.items()), *last)


def notice_ids() -> dict[str, int]:
    """Identifier by license that notices name, from 101."""
    return {license: 101 + i for i, license in enumerate(dict.fromkeys(notice_names().values()))}


def sentences(text: Column) -> Column:
    """Normalised sentences of a text that aren't empty, in order."""
    lines = F.regexp_replace(F.translate(text, UPPER, LOWER), "([.!?])[ \t\r\n\f]+", "$1\n")
    plain = F.regexp_replace(F.regexp_replace(lines, "[^a-z0-9\n]+", " "), " *\n[ \n]*", "\n")
    return F.filter(F.transform(F.split(plain, "\n"), lambda s: F.trim(s)), lambda s: s != "")


def _phrases(known: dict[int, str], rules) -> dict[str, list[int]]:
    """Identifiers by text: of the known sentences, and of a rule's neighbours without a sentence end between."""
    runs = {rule[a:b] for _, rule in rules for a in range(len(rule)) for b in range(a + 2, len(rule) + 1)}
    out = {" ".join(known[n] for n in run): list(run) for run in sorted(runs)}
    return out | {text: [number] for number, text in known.items()}


def _any(texts) -> str:
    return "(?:" + "|".join(sorted(texts, key=lambda t: (-len(t), t))) + ")"


def patterns(known: dict[int, str], rules) -> tuple[str, str]:
    """(known sentences and notices, names), for a text's sentences, each between two line ends of its own.

    Both engines of the library's queries and their SQL read these: no look-around, longer texts first.
    """
    wrapped = lambda t: t.replace(" ", f"(?: |\n\n{LEADER})")
    names = notice_names()
    name = _any(names)
    title = "(?:the )?" + _any(n for n in names if "licen" in n)
    whole = f"\n{LEADER}(?:{wrapped(_any(_phrases(known, rules)))}|{wrapped(title)})\n"
    notice = rf"(?:{LEADS}){name}(?: (?:or|and) (?:the )?{name})*"
    # a notice begins behind a space or line end, which few positions of a text pass
    return whole + "|[ \n]" + wrapped(notice) + r"\b", rf"\b{name}\b"


def scan_licenses(docs: DataFrame, known: dict[int, str] = SENTENCES, rules=RULES) -> DataFrame:
    """(doc_id, n_sentences, sentence_ids, license, licenses) of every document.

    ``sentence_ids`` and ``licenses`` are arrays in text order and rule order.
    """
    table = lambda d: F.create_map(*[x for t, n in d.items() for x in (F.lit(t), F.lit(n) if isinstance(n, int) else F.array(*map(F.lit, n)))])
    numbers = notice_ids()
    phrases = table(_phrases(known, rules))
    by_name = table({name: numbers[license] for name, license in notice_names().items()})
    pattern, name = patterns(known, rules)

    def identifiers(found: Column) -> Column:
        t = F.regexp_replace(F.regexp_replace(found, f"\n\n{LEADER}", " "), f"^\n{LEADER}", "")
        t = F.trim(F.translate(t, "\n", ""))
        return F.coalesce(
            F.try_element_at(phrases, t),
            F.transform(F.regexp_extract_all(t, F.lit(name), F.lit(0)), lambda x: F.try_element_at(by_name, x)),
        )

    lines = F.concat(F.lit("\n"), F.array_join("s", "\n\n"), F.lit("\n"))
    found = docs.select(
        F.col("doc_id").cast("long"), F.coalesce(sentences(F.col("text").cast("string")), F.array().cast("array<string>")).alias("s")
    ).select(
        "doc_id", F.size("s").cast("long").alias("n_sentences"),
        F.flatten(F.transform(F.regexp_extract_all(lines, F.lit(pattern), F.lit(0)), identifiers)).alias("sentence_ids"),
    )
    chain = F.concat(F.lit(","), F.array_join(F.col("sentence_ids").cast("array<string>"), ","), F.lit(","))
    ordered = F.array(*[
        F.struct(F.lit("," + ",".join(map(str, rule)) + ",").alias("key"), F.lit(name).alias("name")) for name, rule in rules_with_notices(rules)
    ])
    matched = F.array_distinct(F.transform(F.filter(ordered, lambda r: F.contains(chain, r["key"])), lambda r: r["name"]))
    # a text without known sentences, as most are, needs no rule
    licenses = F.when(F.size("sentence_ids") > 0, matched).otherwise(F.array().cast("array<string>"))
    return found.select("doc_id", "n_sentences", "sentence_ids", licenses.alias("licenses")).select(
        "doc_id", "n_sentences", "sentence_ids", F.get("licenses", F.lit(0)).alias("license"), "licenses"
    )


def scan_sql(known: dict[int, str] = SENTENCES, rules=RULES) -> str:
    """DuckDB SQL for the scan with ``sentence_ids`` and ``licenses`` joined to text."""
    numbers = notice_ids()
    phrases = "map {" + ", ".join(f"'{t}': {n}" for t, n in _phrases(known, rules).items()) + "}"
    by_name = "map {" + ", ".join(f"'{t}': {numbers[name]}" for t, name in notice_names().items()) + "}"
    ordered = "[" + ", ".join(f"{{'k': ',{','.join(map(str, rule))},', 'n': '{name}'}}" for name, rule in rules_with_notices(rules)) + "]"
    pattern, name = patterns(known, rules)
    return f"""
WITH lines AS (
  SELECT doc_id, regexp_replace(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '([.!?])[ \\t\\r\\n\\f]+', '\\1' || chr(10), 'g') AS t
  FROM documents
), parts AS (
  SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(t, '[^a-z0-9\\n]+', ' ', 'g'), chr(10)), lambda s: trim(s)), lambda s: s <> '') AS s
  FROM lines
), found AS (
  SELECT doc_id, len(s) AS n_sentences, list_transform(
    regexp_extract_all(chr(10) || array_to_string(s, chr(10) || chr(10)) || chr(10), '{pattern}'),
    lambda f: trim(replace(regexp_replace(regexp_replace(f, '\n\n{LEADER}', ' ', 'g'), '^\n{LEADER}', ''), chr(10), ''))
  ) AS found FROM parts
), known AS (
  SELECT doc_id, n_sentences, flatten(list_transform(found, lambda t: coalesce(
    {phrases}[t], list_transform(regexp_extract_all(t, '{name}'), lambda x: {by_name}[x])
  ))) AS ids FROM found
), chains AS (
  SELECT *, ',' || coalesce(array_to_string(ids, ','), '') || ',' AS chain FROM known
), matched AS (
  SELECT *, list_transform(list_filter({ordered}, lambda r: contains(chain, r.k)), lambda r: r.n) AS names FROM chains
), distinct_names AS (
  SELECT *, list_filter(names, lambda x, i: list_position(names, x) = i) AS licenses FROM matched
)
SELECT doc_id, CAST(n_sentences AS BIGINT) AS n_sentences, coalesce(array_to_string(ids, ','), '') AS sentence_ids, licenses[1] AS license,
  coalesce(array_to_string(licenses, ';'), '') AS licenses
FROM distinct_names
"""

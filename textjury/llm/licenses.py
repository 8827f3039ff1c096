"""License scans by sentence rules.

Sentences are normalised and looked up among known licence sentences; the identifiers
that a document shows, in order, are matched against rules: licences as ordered lists of
identifiers. Only built-in functions are used, inside the row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textjury.functions.arrays import bind
from textjury.llm.common import lower_ascii

#: Identifiers of known sentences, as normalised: fixed values from the public texts of the licences.
SENTENCES = {
    "mit-released": ["released under the mit license", "licensed under the mit license", "this project is licensed under the mit license", "distributed under the mit license", "spdx license identifier mit"],
    "mit-grant": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"],
    "mit-notice": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"],
    "mit-warranty": ["the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"],
    "mit-liability": ["in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"],
    "apache-2-licensed": ["licensed under the apache license version 2.0", "licensed under the apache license version 2.0 the license", "released under the apache license version 2.0", "this project is licensed under the apache license version 2.0", "spdx license identifier apache 2.0"],
    "apache-2-compliance": ["you may not use this file except in compliance with the license"],
    "apache-2-copy": ["you may obtain a copy of the license at http www.apache.org licenses license 2.0", "you may obtain a copy of the license at https www.apache.org licenses license 2.0"],
    "apache-2-as-is": ["unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"],
    "gpl-3-licensed": ["this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 3", "this program is licensed under the gnu general public license version 3", "spdx license identifier gpl 3.0 only"],
    "gpl-2-licensed": ["this work is licensed under the gnu general public license version 2", "licensed under the gnu general public license version 2", "spdx license identifier gpl 2.0 only"],
    "gpl-free": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "gpl-2-free": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"],
    # Parts of GPL sentences, as their public texts are cut at ';'.
    "gpl-terms": ["you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"],
    "gpl-3-later": ["either version 3 of the license or at your option any later version"],
    "gpl-2-later": ["either version 2 of the license or at your option any later version"],
    "gpl-warranty": ["this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose", "this program is distributed in the hope that it will be useful but without any warranty"],
    "gpl-implied": ["without even the implied warranty of merchantability or fitness for a particular purpose"],
    "gpl-copy": ["you should have received a copy of the gnu general public license along with this program"],
    "lgpl-3-licensed": ["licensed under the gnu lesser general public license version 3", "spdx license identifier lgpl 3.0 only"],
    "agpl-3-licensed": ["licensed under the gnu affero general public license version 3", "spdx license identifier agpl 3.0 only"],
    "mpl-2-subject": ["this source code form is subject to the terms of the mozilla public license v", "licensed under the mozilla public license version 2.0", "spdx license identifier mpl 2.0"],
    "bsd-grant": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "bsd-source": ["redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"],
    "bsd-binary": ["redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"],
    "bsd-endorse": ["neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"],
    "bsd-3-released": ["released under the bsd 3 clause license", "licensed under the bsd 3 clause license", "spdx license identifier bsd 3 clause"],
    "bsd-2-released": ["released under the bsd 2 clause license", "licensed under the bsd 2 clause license", "spdx license identifier bsd 2 clause"],
    "isc-grant": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"],
    "isc-released": ["released under the isc license", "licensed under the isc license", "spdx license identifier isc"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
    "cc0": ["licensed under cc0 1.0", "released under cc0 1.0", "spdx license identifier cc0 1.0"],
    "cc-by-4": ["licensed under cc by 4.0", "this work is licensed under cc by 4.0", "this work is licensed under a creative commons attribution 4.0 international license"],
    "cc-by-sa-4": ["licensed under cc by sa 4.0", "this work is licensed under cc by sa 4.0", "this work is licensed under a creative commons attribution sharealike 4.0 international license"],
    "cc-by-nc-4": ["licensed under cc by nc 4.0", "this work is licensed under cc by nc 4.0", "this work is licensed under a creative commons attribution noncommercial 4.0 international license"],
    "cc-by-nd-4": ["licensed under cc by nd 4.0", "this work is licensed under cc by nd 4.0", "this work is licensed under a creative commons attribution noderivatives 4.0 international license"],
    "cc-by-nc-sa-4": ["licensed under cc by nc sa 4.0", "this work is licensed under cc by nc sa 4.0"],
    "all-rights": ["all rights reserved"],
}

#: A licence and the identifiers that show it, in this order; other sentences may lie between.
RULES = [
    ("MIT", ["mit-released"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("Apache-2.0", ["apache-2-licensed"]),
    ("Apache-2.0", ["apache-2-compliance", "apache-2-copy"]),
    ("GPL-3.0-only", ["gpl-3-licensed"]),
    ("GPL-2.0-only", ["gpl-2-licensed"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-warranty"]),
    ("GPL-2.0-or-later", ["gpl-2-free", "gpl-warranty"]),
    ("GPL-3.0-or-later", ["gpl-terms", "gpl-3-later", "gpl-warranty"]),
    ("GPL-2.0-or-later", ["gpl-terms", "gpl-2-later", "gpl-warranty"]),
    ("LGPL-3.0-only", ["lgpl-3-licensed"]),
    ("AGPL-3.0-only", ["agpl-3-licensed"]),
    ("MPL-2.0", ["mpl-2-subject"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("BSD-3-Clause", ["bsd-3-released"]),
    ("BSD-2-Clause", ["bsd-2-released"]),
    ("ISC", ["isc-grant"]),
    ("ISC", ["isc-released"]),
    ("Unlicense", ["unlicense"]),
    ("CC0-1.0", ["cc0"]),
    ("CC-BY-4.0", ["cc-by-4"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4"]),
    ("CC-BY-ND-4.0", ["cc-by-nd-4"]),
    ("CC-BY-NC-SA-4.0", ["cc-by-nc-sa-4"]),
    ("LicenseRef-all-rights-reserved", ["all-rights"]),
]
#: A licence that is not reported where a rule of the other one holds, as that one's text contains it.
WITHIN = {"BSD-2-Clause": "BSD-3-Clause"}

#: Every known sentence has one of these, so a text without any has no known sentence. They are
#: single words, as blanks of any kind and number, hyphens and line ends may stand between words.
CUES = ["licen", "permi", "copyright", "released", "warrant", "redistribut", "contributors", "domain", "reserved"]
CUE = "(?i)" + "|".join(CUES)

ENDS = r"([.!?;])[ \t\r\n]+"
SEPARATORS = r"[^a-z0-9.]+"
EDGES = r"^[ .]+|[ .]+$"
#: An empty line, or one with nothing but the marks of a comment.
BREAK = r"\n[ \t]*[*/#;%-]*[ \t\r]*\n"
#: Beginnings of grants, which may follow a copyright line without any mark when a notice is on one line.
OPENINGS = "(permission is hereby granted|permission to use copy|redistribution and use in source)"
READINGS = 3


def normalised(sentence: str) -> str:
    """What the columns below do, for one sentence on the driver."""
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), sentence).replace("licence", "license")
    return re.sub(EDGES, "", re.sub(SEPARATORS, " ", lowered))


def rule_pattern(ids: list[str]) -> str:
    """Matches ',a,b,c,' where the identifiers occur in this order."""
    return "," + ",(?:[^,]*,)*".join(map(re.escape, ids)).replace("\\-", "-") + ","


def _sentences(lowered: Column) -> Column:
    """Sentences of single lines; those that run over line ends within a paragraph; those that end at a colon too.

    A sentence ends at . ! ? ; before white space, and at an empty line. In the last reading
    also at : before white space, at a line with nothing but comment marks and before a
    grant, as in a notice that is written on one line or in a block of comments.
    """
    by_line = F.split(F.regexp_replace(lowered, ENDS, "$1\n"), "\n")
    whole = F.regexp_replace(F.regexp_replace(lowered, r"\n[ \t\r]*\n", "\u0001"), "[ \t\r\n]+", " ")
    by_paragraph = F.split(F.regexp_replace(whole, r"([.!?;]) ", "$1\u0001"), "\u0001")
    whole = F.regexp_replace(F.regexp_replace(lowered, BREAK, "\u0001"), "[ \t\r\n]+", " ")
    whole = F.regexp_replace(whole, OPENINGS, "\u0001$1")
    by_colon = F.split(F.regexp_replace(whole, r"([.!?;:]) ", "$1\u0001"), "\u0001")
    return F.array(by_line, by_paragraph, by_colon)


def _identified(sentences: Column) -> Column:
    """',id,id,' of the known ones among ``sentences``, in order; ',' if there is none."""
    known = F.create_map(
        *[F.lit(x) for name, wordings in SENTENCES.items() for wording in wordings for x in (wording, name)]
    )
    clean = F.transform(
        sentences, lambda s: F.regexp_replace(F.regexp_replace(s, SEPARATORS, " "), EDGES, "")
    )
    names = F.transform(clean, lambda s: F.try_element_at(known, s))
    return F.concat(F.lit(","), F.array_join(F.transform(F.filter(names, lambda n: n.isNotNull()), lambda n: F.concat(n, F.lit(","))), ""))


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, sentence_ids, licenses), one row per input row.

    ``sentence_ids`` is an array of the known sentences found on single lines, in order,
    then of those found only across line ends, then of those found only between colons;
    ``licenses`` the sorted array of licences with a rule whose identifiers occur in order,
    in one of these readings. Null and empty
    texts, and texts without a known sentence, have empty arrays. Null ids are kept,
    repeated rows come out each, an empty table gives no rows, other columns are ignored.
    """
    lowered = F.replace(lower_ascii(F.col(text)), F.lit("licence"), F.lit("license"))
    nothing_seen = F.array(*[F.lit(",")] * READINGS)
    readings = F.when(F.col(text).rlike(CUE), F.transform(_sentences(lowered), _identified)).otherwise(nothing_seen)
    found = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(readings, nothing_seen).alias("seen"))

    def holds(ids: list[str]) -> Column:
        pattern = rule_pattern(ids)
        return F.get("seen", 0).rlike(pattern) | F.get("seen", 1).rlike(pattern) | F.get("seen", 2).rlike(pattern)

    by_name: dict[str, list[list[str]]] = {}
    for name, ids in RULES:
        by_name.setdefault(name, []).append(ids)
    shown = {name: [holds(ids) for ids in rules] for name, rules in by_name.items()}
    any_of = lambda conditions: conditions[0] if len(conditions) == 1 else conditions[0] | any_of(conditions[1:])
    names = []
    for name in sorted(by_name):
        condition = any_of(shown[name])
        if name in WITHIN:
            condition = condition & ~any_of(shown[WITHIN[name]])
        names.append(F.when(condition, F.lit(name)))
    ids = lambda at: F.filter(F.split(F.get("seen", at), ","), lambda x: x != "")
    add = lambda at, more: lambda known: more(F.concat(known, F.filter(ids(at), lambda x: ~F.array_contains(known, x))))
    both = bind(ids(0), add(1, lambda known: bind(known, add(2, lambda every: every))))
    none = F.array().cast("array<string>")
    nothing = F.forall("seen", lambda s: s == ",")
    return found.select(
        "doc_id",
        F.when(nothing, none).otherwise(both).alias("sentence_ids"),
        F.when(nothing, none).otherwise(F.filter(F.array(*names), lambda x: x.isNotNull())).alias("licenses"),
    )


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def licenses_sql() -> str:
    """The same scan in DuckDB's SQL; arrays as comma-joined text."""
    known = ", ".join(
        f"({_quoted(wording)}, {_quoted(name)})" for name, wordings in SENTENCES.items() for wording in wordings
    )
    by_name: dict[str, list[str]] = {}
    for name, ids in RULES:
        pattern = _quoted(rule_pattern(ids))
        by_name.setdefault(name, []).append(" OR ".join(f"regexp_matches({x}, {pattern})" for x in "abc"))
    cases = []
    for name in sorted(by_name):
        condition = f"({' OR '.join(by_name[name])})"
        if name in WITHIN:
            condition += f" AND NOT ({' OR '.join(by_name[WITHIN[name]])})"
        cases.append(f"CASE WHEN {condition} THEN {_quoted(name)} END")
    seen = lambda lines: (
        f"(SELECT ',' || coalesce(string_agg(k.name || ',', '' ORDER BY u.i), '') FROM (SELECT unnest({lines}) AS s, "
        f"unnest(range(len({lines}))) AS i) u JOIN known k ON k.wording = "
        f"regexp_replace(regexp_replace(u.s, '{SEPARATORS}', ' ', 'g'), '{EDGES}', '', 'g'))"
    )
    return f"""
WITH known(wording, name) AS (VALUES {known}),
lowered AS (
    SELECT row_number() OVER () AS r, doc_id,
           replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), 'licence', 'license') AS t
    FROM documents),
cut AS (
    SELECT r, doc_id, string_split(regexp_replace(t, '{ENDS}', '\\1' || chr(10), 'g'), chr(10)) AS la,
           string_split(regexp_replace(regexp_replace(regexp_replace(t, '\\n[ \\t\\r]*\\n', chr(1), 'g'), '[ \\t\\r\\n]+', ' ', 'g'),
                                       '([.!?;]) ', '\\1' || chr(1), 'g'), chr(1)) AS lb,
           string_split(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
                           t, '{BREAK}', chr(1), 'g'), '[ \\t\\r\\n]+', ' ', 'g'), '{OPENINGS}', chr(1) || '\\1', 'g'),
                                       '([.!?;:]) ', '\\1' || chr(1), 'g'), chr(1)) AS lc
    FROM lowered),
seen AS (SELECT r, doc_id, {seen('la')} AS a, {seen('lb')} AS b, {seen('lc')} AS c FROM cut),
lists AS (
    SELECT doc_id, a, b, c, list_filter(string_split(a, ','), lambda x: x <> '') AS xa,
           list_filter(string_split(b, ','), lambda x: x <> '') AS xb,
           list_filter(string_split(c, ','), lambda x: x <> '') AS xc
    FROM seen)
SELECT doc_id, array_to_string(list_concat(xa, list_filter(xb, lambda x: NOT list_contains(xa, x)),
           list_filter(xc, lambda x: NOT list_contains(xa, x) AND NOT list_contains(xb, x))), ',') AS sentence_ids,
       array_to_string(list_filter([{', '.join(cases)}], lambda x: x IS NOT NULL), ',') AS licenses
FROM lists
"""

"""Licence scan by sentence rules.

A text is cut into sentences; a sentence is normalised (lower case, letters and
digits only).  A known licence sentence may hold cuts itself ("Identifier: MIT",
"v. 2.0") or be wrapped over lines: it is found wherever it fills one or several
neighbouring sentences from end to end, and mapped to its identifier.  The
identifiers of a document, in order, are matched against ordered licence
rules: the first rule that fits takes its sentences, so that a longer licence
is recognised before the shorter one that it contains.  More than ``GAP``
unknown sentences break a sequence.

Scale: one pass of built-in expressions inside each row, no shuffle.  A text
without any anchor word (every known sentence has one) is not taken apart.

``oracle`` is SQL that knows only sentences without a cut inside and writes the
identifiers "apache2-use" and "bsd-source" without their "u", so that no rule
with them fits there; results equal it on texts without such sentences.

Defined cases: null and empty texts have no licence; repeated sentences count
each time, a licence found twice is named once; an empty table gives an empty
result; other columns pass through.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.shared import let, own_name

GAP = 3
# Words of which every known sentence has one.
ANCHORS = ["licen", "permission is hereby", "redistribut", "warrant", "spdx", "liable", "copyright notice", "endorse", "public domain"]

# Known licence sentences, normalised, by identifier.
SENTENCES = {
    "apache2": ["licensed under the apache license version 2 0", "licensed under the apache license version 2 0 the license",
                "released under the apache license version 2 0", "spdx license identifier apache 2 0"],
    "apache2-use": ["you may not use this file except in compliance with the license"],
    "apache2-copy": ["you may obtain a copy of the license at http www apache org licenses license 2 0"],
    "as-is-basis": ["unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
                    "without warranties or conditions of any kind either express or implied"],
    "apache2-see": ["see the license for the specific language governing permissions and limitations under the license"],
    "mit": ["released under the mit license", "licensed under the mit license", "spdx license identifier mit"],
    "mit-grant": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software "
                  "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense "
                  "and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"],
    "mit-notice": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"],
    "mit-warranty": ["the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of "
                     "merchantability fitness for a particular purpose and noninfringement"],
    "bsd-intro": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "bsd-source": ["redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"],
    "bsd-binary": ["redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the "
                   "documentation and or other materials provided with the distribution"],
    "bsd-endorse": ["neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
                    "software without specific prior written permission"],
    "bsd3": ["spdx license identifier bsd 3 clause", "licensed under the bsd 3 clause license"],
    "bsd2": ["spdx license identifier bsd 2 clause", "licensed under the bsd 2 clause license"],
    "lgpl3": ["this work is licensed under the gnu lesser general public license version 3", "spdx license identifier lgpl 3 0 or later"],
    "gpl3": ["this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 3",
             "spdx license identifier gpl 3 0 only"],
    "gpl2": ["this work is licensed under the gnu general public license version 2", "licensed under the gnu general public license version 2",
             "spdx license identifier gpl 2 0 only"],
    "gpl-free": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
                 "free software foundation either version 3 of the license or at your option any later version"],
    "gpl2-free": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
                  "free software foundation either version 2 of the license or at your option any later version"],
    "gpl-warranty": ["this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of "
                     "merchantability or fitness for a particular purpose"],
    "mpl2": ["this source code form is subject to the terms of the mozilla public license v 2 0", "spdx license identifier mpl 2 0"],
    "cc0": ["dedicated to the public domain under cc0 license 1 0", "spdx license identifier cc0 1 0"],
    "proprietary": ["redistribution of this text is not permitted without a license"],
}
SENTENCES |= {f"cc-{kind.replace(' ', '-')}-{version[0]}": [f"licensed under cc {kind} {version}", f"this work is licensed under cc {kind} {version}",
                                                              f"spdx license identifier cc {kind} {version}"]
              for kind in ("by", "by sa", "by nc", "by nd", "by nc sa", "by nc nd") for version in ("3 0", "4 0")}

# Ordered rules, licence and the identifiers of its sentences in order.
RULES = [
    ("Apache-2.0", ["apache2", "apache2-use", "apache2-copy", "as-is-basis", "apache2-see"]),
    ("Apache-2.0", ["apache2", "apache2-use"]),
    ("Apache-2.0", ["apache2"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-warranty"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("MIT", ["mit"]),
    ("BSD-3-Clause", ["bsd-intro", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-2-Clause", ["bsd-intro", "bsd-source", "bsd-binary"]),
    ("BSD-3-Clause", ["bsd3"]),
    ("BSD-2-Clause", ["bsd2"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-warranty"]),
    ("GPL-3.0-or-later", ["gpl-free"]),
    ("GPL-2.0-or-later", ["gpl2-free", "gpl-warranty"]),
    ("GPL-2.0-or-later", ["gpl2-free"]),
    ("LGPL-3.0", ["lgpl3"]),
    ("GPL-3.0", ["gpl3"]),
    ("GPL-2.0", ["gpl2"]),
    ("MPL-2.0", ["mpl2"]),
    ("CC0-1.0", ["cc0"]),
    ("Proprietary", ["proprietary"]),
]
RULES += [(f"CC-{i[3:-2].upper()}-{i[-1]}.0", [i]) for i in SENTENCES if i.startswith("cc-")]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def has_anchor(text: Column) -> Column:
    return F.coalesce(text.rlike("(?i)" + "|".join(a.replace(" ", "[^A-Za-z0-9]+") for a in ANCHORS)), F.lit(False))


def sentences(text: Column) -> Column:
    """Normalised sentences: cut at line ends and after . ! ? ; : before white space."""
    cut = F.split(F.regexp_replace(text, r"([.!?;:])[\x20\x09-\x0D]+", "$1\n"), "\n")
    return F.transform(cut, lambda s: F.trim(F.regexp_replace(F.translate(s, UPPER, LOWER), "[^a-z0-9]+", " ")))


def identifiers(text: Column) -> Column:
    """Identifiers of the known sentences in order, as ``<a><b>``, with ``|`` where more than ``GAP`` unknown ones stand between two."""
    known = F.create_map(*[F.lit(x) for i, forms in SENTENCES.items() for form in forms for x in (form, f"<{i}>")])
    forms = sorted((form for fs in SENTENCES.values() for form in fs), key=len, reverse=True)
    pattern = r"(?<=\n)(?:" + "|".join(form.replace(" ", r"[ \n]+") for form in forms) + r")(?=\n)"

    def build(found: Column, rest: Column) -> Column:
        unknown = lambda g: F.replace(F.regexp_replace(g, r"[^\n]+", "~"), F.lit("\n"), F.lit(""))
        name = lambda i: F.coalesce(F.try_element_at(known, F.regexp_replace(F.get(found, i), r"\n+", " ")), F.lit(""))
        return F.array_join(F.transform(rest, lambda g, i: F.concat(unknown(g), name(i))), "")

    lines = F.concat(F.lit("\n"), F.array_join(sentences(text), "\n"), F.lit("\n"))
    marks = let(lines, lambda x: let(F.regexp_extract_all(x, F.lit(pattern), 0), lambda found: let(F.split(x, pattern), lambda rest: build(found, rest))))
    # No identifier holds the mark of an unknown sentence.
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(marks, f"~{{{GAP + 1},}}", "|"), "~+", ""), r"^\|+|\|+$", "")


def _rule(names: list[str]) -> str:
    return "".join(f"<{n}>" for n in names)


def licences(ids: Column) -> Column:
    """Names of the licences of a sequence of identifiers, in the order of the rules."""
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(_rule(names)).alias("pattern")) for name, names in RULES])
    start = F.struct(ids.alias("rest"), F.array().cast("array<string>").alias("names"))

    def fold(state: Column, rule: Column) -> Column:
        return F.when(F.contains(state["rest"], rule["pattern"]), F.struct(
            F.replace(state["rest"], rule["pattern"], F.lit("|")).alias("rest"), F.array_append(state["names"], rule["name"]).alias("names"))).otherwise(state)

    return F.array_distinct(F.aggregate(rules, start, fold, lambda state: state["names"]))


def scan(docs: DataFrame, text: str = "text", ids: str = "sentence_ids", names: str = "licences") -> DataFrame:
    """``docs`` with the sequence of known licence sentences of each text and the licences found."""
    found = F.when(has_anchor(F.col(text)), identifiers(F.col(text))).otherwise("")
    step = own_name(docs, "license_step")
    out = docs.withColumn(step, let(found, lambda i: F.struct(i.alias("ids"), F.when(i == "", F.array().cast("array<string>")).otherwise(licences(i)).alias("names"))))
    return out.select(*docs.columns, F.col(step)["ids"].alias(ids), F.col(step)["names"].alias(names))


def oracle(table: str = "documents") -> str:
    """DuckDB SQL for doc_id, sentence_ids, licences (joined with commas) over a table (doc_id, text)."""
    forms = ", ".join(f"('{form}', '<{i}>')" for i, fs in SENTENCES.items() for form in fs)
    anchors = "|".join(a.replace(" ", r"[\x20\x09-\x0D]+") for a in ANCHORS)
    hits, steps = [], []
    for k, (name, names) in enumerate(RULES):
        steps.append(f"s{k + 1} AS (SELECT *, contains(r{k}, '{_rule(names)}') AS h{k}, replace(r{k}, '{_rule(names)}', '|') AS r{k + 1} FROM s{k})")
        hits.append(f"CASE WHEN h{k} THEN '{name}' END")
    names_sql = ", ".join(hits)
    return rf"""
WITH rows AS (SELECT row_number() OVER () AS rn, doc_id, coalesce(text, '') AS text FROM {table}),
cut AS (
  SELECT rn, unnest(parts) AS s, generate_subscripts(parts, 1) AS i
  FROM (SELECT rn, string_split(regexp_replace(text, '([.!?;:])[\x20\x09-\x0D]+', '\1' || chr(10), 'g'), chr(10)) AS parts
        FROM rows WHERE regexp_matches(text, '(?i){anchors}'))),
plain AS (SELECT rn, i, trim(regexp_replace(translate(s, '{UPPER}', '{LOWER}'), '[^a-z0-9]+', ' ', 'g')) AS s FROM cut),
known(form, id) AS (VALUES {forms}),
marked AS (SELECT rn, string_agg(coalesce(id, CASE WHEN s = '' THEN '' ELSE 'u' END), '' ORDER BY i) AS marks FROM plain LEFT JOIN known ON s = form GROUP BY rn),
s0 AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(coalesce(marks, ''), 'u{{{GAP + 1},}}', '|', 'g'), 'u+', '', 'g'), '^\|+|\|+$', '', 'g') AS r0
       FROM rows LEFT JOIN marked USING (rn)),
{", ".join(steps)}
SELECT doc_id, r0 AS sentence_ids,
       coalesce((SELECT string_agg(x, ',' ORDER BY k) FROM (SELECT x, min(k) AS k FROM (SELECT unnest([{names_sql}]) AS x, unnest(range({len(RULES)})) AS k) WHERE x IS NOT NULL GROUP BY x)), '') AS licences
FROM s{len(RULES)}"""
